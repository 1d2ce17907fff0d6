"""A work queue as a table: every command is a function from items to items and the event to log.

Items: ``id, source_file, report_file, status, batch_id, started_at, completed_at, error, agent_id``.
``present`` has a row (``report_file``, ``size``) for each report file there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.scalars import batch_id, or_else
from corpusloom.operators.merge import domain

#: States, bytes from which a report counts, size of a batch, the error of a failure without one.
STATUSES = ("pending", "in_progress", "complete", "failed", "skipped")
REPORT_BYTES, BATCH, UNKNOWN_ERROR = 500, 30, "unknown error"
MARKS = ("complete", "failed", "pending", "skipped")
COLUMNS = ("id", "source_file", "report_file", "status", "batch_id", "started_at", "completed_at", "error", "agent_id")


def meta(items: DataFrame, now: Column, step: str, model: str, prompt_file: str, batch_size: int = BATCH) -> DataFrame:
    """The one row that describes a queue: ``step, model, batch_size, prompt_file, created_at, total``."""
    lit = lambda v: F.lit(v)
    return items.agg(F.count("*").alias("total")).select(lit(step).alias("step"), lit(model).alias("model"), lit(batch_size).alias("batch_size"), lit(prompt_file).alias("prompt_file"), now.alias("created_at"), "total")


def report_name(name: Column) -> Column:
    return F.concat(F.lit("run-"), name)


def init(sources: DataFrame, present: DataFrame, now: Column, report_dir: str = "") -> DataFrame:
    """Items for ``sources`` (``id``, ``name``): complete where the report is there, else pending."""
    none = F.lit(None).cast("string")
    items = sources.select("id", F.col("name").alias("source_file"), F.concat(F.lit(report_dir), report_name(F.col("name"))).alias("report_file"))
    items = _with_done(items, present)
    return items.select(
        "id", "source_file", "report_file", F.when(F.col("_done"), "complete").otherwise("pending").alias("status"),
        none.alias("batch_id"), none.alias("started_at"), F.when(F.col("_done"), now).alias("completed_at"), none.alias("error"), none.alias("agent_id"),
    )


def _with_done(items: DataFrame, present: DataFrame) -> DataFrame:
    done = present.filter(F.col("size") >= REPORT_BYTES).select("report_file").distinct().withColumn("_done", F.lit(True))
    return items.join(done, "report_file", "left").withColumn("_done", F.coalesce("_done", F.lit(False)))


def sync(items: DataFrame, present: DataFrame, now: Column, only: bool = False) -> DataFrame:
    """Whatever is not complete and has a report becomes complete, its error cleared; nothing goes back.  ``only``: the items that change."""
    flagged = _with_done(items, present)
    hit = F.col("_done") & (F.col("status") != "complete")
    return _set(flagged, hit, {"status": F.lit("complete"), "error": F.lit(None).cast("string"), "completed_at": or_else(F.col("completed_at"), now)}, only)


def reset_stale(items: DataFrame, present: DataFrame, now: Column, only: bool = False) -> DataFrame:
    """What is in progress becomes complete if its report is there (the error stays), else pending and nobody's.  ``only``: the items that change."""
    flagged = _with_done(items, present)
    busy = F.col("status") == "in_progress"
    if only:
        flagged = flagged.filter(busy)
    done, lost = busy & F.col("_done"), busy & ~F.col("_done")
    none = F.lit(None).cast("string")
    out = flagged.withColumns({
        "completed_at": F.when(done, or_else(F.col("completed_at"), now)).otherwise(F.col("completed_at")),
        **{c: F.when(lost, none).otherwise(F.col(c)) for c in ("batch_id", "started_at", "agent_id")},
        "status": F.when(done, "complete").when(lost, "pending").otherwise(F.col("status")),
    })
    return out.select(*COLUMNS)


def pending(items: DataFrame, size: int = BATCH) -> DataFrame:
    """The first ``size`` pending items."""
    if size < 0:
        raise ValueError("size of a batch is negative")
    return items.filter(F.col("status") == "pending").orderBy("id").limit(size or BATCH)


def begin(batch: DataFrame, now: Column) -> DataFrame:
    """The items of a batch, in progress."""
    return _set(batch, F.lit(True), {"status": F.lit("in_progress"), "batch_id": batch_id(now), "started_at": now})


def next_batch(items: DataFrame, now: Column, size: int = BATCH) -> tuple[DataFrame, DataFrame]:
    """Items with the first ``size`` pending ones in progress, and those.  0 means the default; a negative size is refused."""
    batch = pending(items, size)
    chosen = batch.select("id").withColumn("_done", F.lit(True))
    flagged = items.join(chosen, "id", "left")
    out = _set(flagged, F.coalesce("_done", F.lit(False)), {"status": F.lit("in_progress"), "batch_id": batch_id(now), "started_at": now})
    return out, batch.select("id", "source_file", "report_file")


def mark(items: DataFrame, item: int, status: str, now: Column, error: str | None = None, agent: str | None = None) -> DataFrame:
    if status not in MARKS:
        raise ValueError(f"an item is not marked {status}")
    hit = F.col("id") == item
    values = {"status": F.lit(status)}
    if status == "complete":
        values |= {"completed_at": now, "error": F.lit(None).cast("string")}
    elif status == "failed":
        values |= {"completed_at": now, "error": F.lit(error or UNKNOWN_ERROR)}
    if agent:
        values["agent_id"] = F.lit(agent)
    return _set(items, hit, values)


def mark_all(items: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """The items that ``results`` (``id, status, error, agent_id``) names, marked as :func:`mark` does; of several rows for an item the last one by status and error."""
    last = results.groupBy("id").agg(F.max(F.struct("status", "error", "agent_id")).alias("_new"))
    new, was = F.col("_new.status"), {c: F.col(c) for c in COLUMNS}
    ended = new.isin("complete", "failed")
    values = {
        "completed_at": F.when(ended, now).otherwise(was["completed_at"]),
        "error": F.when(new == "complete", F.lit(None).cast("string")).when(new == "failed", or_else(F.col("_new.error"), F.lit(UNKNOWN_ERROR))).otherwise(was["error"]),
        "agent_id": or_else(F.col("_new.agent_id"), was["agent_id"]),
        "status": new,
    }
    return items.join(last, "id").withColumns(values).select(*COLUMNS)


def _set(items: DataFrame, hit: Column, values: dict[str, Column], only: bool = False) -> DataFrame:
    # The status last: the others are set by what it was.
    out = items.withColumn("_hit", hit)
    if only:
        out = out.filter("_hit")
    return out.withColumns({c: F.when(F.col("_hit"), v).otherwise(F.col(c)) for c, v in values.items()}).select(*COLUMNS)


def histogram(items: DataFrame, statuses: tuple[str, ...] = STATUSES) -> DataFrame:
    """``status, n`` for every known status, 0 where there is none, and for others that are there."""
    counts = items.groupBy("status").agg(F.count("*").alias("n"))
    known = domain(items.sparkSession, "status", statuses).select("status")
    return known.join(counts, "status", "full").select("status", F.coalesce("n", F.lit(0)).alias("n"))


def progress(items: DataFrame) -> DataFrame:
    """``done, total, percent``: complete and skipped of all, null of none."""
    done = F.count_if(F.col("status").isin("complete", "skipped"))
    return items.agg(done.alias("done"), F.count("*").alias("total"), F.round(F.try_divide(100.0 * done, F.count("*")), 1).alias("percent"))


def event(kind: str, now: Column, **fields: Column) -> list[Column]:
    """Columns of a line of the run log."""
    return [now.alias("ts"), F.lit(kind).alias("event"), *[v.alias(k) for k, v in fields.items()]]


def latest(events: DataFrame, item: str = "id", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """The last event of each item: what the fold over the log comes to."""
    from corpusloom.operators.match import last_by

    return last_by(events, [item], *order)
