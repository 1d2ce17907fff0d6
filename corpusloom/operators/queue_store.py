"""The work queue kept in a folder, for any number of writers at once.

A command reads the last version, writes the items that it changes and commits the next version (:mod:`sources.commits`).
Where another writer was faster it reads again and decides again, so no item is given out twice and no change is lost.
A version names a snapshot of all items and the changes since, which are merged on read; every ``merge`` changes a command
writes a new snapshot instead.  The event of a command is part of its version: the run log has it if and only if it happened.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import naming, work_queue
from corpusloom.operators.match import last_by
from corpusloom.sources.commits import Commits
from corpusloom.sources.files import settle

ITEMS = "id long, " + ", ".join(f"{c} string" for c in work_queue.COLUMNS[1:])
META = "step string, model string, batch_size int, prompt_file string, created_at string, total long"


class QueueStore:
    def __init__(self, spark: SparkSession, path: str, now: Column | None = None, keep: int = 5, about: tuple[str, str, str] = ("step3", "", ""), merge: int = 20) -> None:
        """``about``: step, model and prompt file for the row that describes the queue; ``keep``: versions that stay readable, ``merge``: changes to a snapshot."""
        self.about, self.keep, self.merge = about, keep, merge
        self.spark, self.path = spark, path.rstrip("/")
        self.commits = Commits(spark, path)
        self._clock = now

    def now(self) -> str:
        """One time for all that a command does."""
        if self._clock is None:
            return datetime.now(UTC).isoformat(timespec="seconds")
        return self.spark.range(1).select(self._clock).first()[0]

    def versions(self) -> list[int]:
        return self.commits.versions()

    def _items(self, content: dict) -> DataFrame:
        read = lambda place: self.spark.read.schema(ITEMS).parquet(f"{self.path}/{place}")
        snapshot = read(content["snapshot"])
        if not content["changes"]:
            return snapshot
        changes = None
        for n, place in enumerate(content["changes"]):
            own = read(place).withColumn("_n", F.lit(n))
            changes = own if changes is None else changes.unionByName(own)
        last = last_by(changes, ["id"], "_n").drop("_n")
        return snapshot.join(last.select("id"), "id", "left_anti").unionByName(last)

    def _last(self, content: dict) -> dict:
        if not content:
            raise FileNotFoundError(f"no queue in {self.path}; init first")
        return content

    def items(self) -> DataFrame:
        return self._items(self._last(self.commits.latest()[1]))

    def log(self) -> DataFrame:
        """A row for each command, in their order: ``version``, ``ts``, ``event`` and what else it has to say."""
        lines = self.spark.read.json(f"{self.path}/commits")
        return lines.select("version", "event.*")

    def _commit(self, decide: Callable[[DataFrame, dict], tuple[DataFrame | None, dict] | None]) -> dict | None:
        """``decide``: from the items, and what else the version says, to those that change, in their new state (None: none does), and the event; None: there is nothing to do."""

        def make(version: int, content: dict) -> dict | None:
            items = self._items(self._last(content))
            found = decide(items, content)
            if found is None:
                return None
            changed, event = found
            new = {**content, "version": version + 1, "event": event}
            if changed is not None and len(content["changes"]) + 1 < self.merge:
                place = self.commits.new_place("changes")
                changed.select(*work_queue.COLUMNS).coalesce(1).write.parquet(f"{self.path}/{place}")
                new["changes"] = [*content["changes"], place]
            elif changed is not None:
                place = self.commits.new_place("items")
                items.join(changed.select("id"), "id", "left_anti").unionByName(changed.select(*items.columns)).write.parquet(f"{self.path}/{place}")
                new |= {"snapshot": place, "changes": []}
            return new

        done = self.commits.change(make)
        if done is None:
            return None
        self._sweep(*done)
        return done[1]["event"]

    def _sweep(self, version: int, content: dict) -> None:
        """After a new snapshot: data that none of the last versions names goes."""
        if content["changes"]:
            return
        numbers = [v for v in self.versions() if v <= version]
        named = {p for v in numbers[-self.keep :] for c in [self.commits.read(v)] for p in [c["snapshot"], *c["changes"]]}
        for v in numbers[-self.keep - self.merge : -self.keep]:
            old = self.commits.read(v)
            for place in {old["snapshot"], *old["changes"]} - named:
                self.commits.delete(place)

    def init(self, names: DataFrame, present: DataFrame, force: bool = False, report_dir: str = "") -> None:
        """Items for files (``name``), numbered by name.  Refuses to replace a queue unless forced, and to make an empty one."""
        if self.versions() and not force:
            raise FileExistsError(f"there is a queue in {self.path}")
        total = names.count()
        if not total:
            raise ValueError("no source files")
        now = self.now()
        sources = naming.number_by_name(names.select("name"), "name").select("id", "name")
        place = self.commits.new_place("items")
        work_queue.init(sources, present, F.lit(now), report_dir).select(*work_queue.COLUMNS).write.parquet(f"{self.path}/{place}")
        meta = work_queue.meta(self.spark.read.parquet(f"{self.path}/{place}"), F.lit(now), *self.about).first().asDict()
        event = {"ts": now, "event": "init", "total": total}

        def make(version: int, content: dict) -> dict:
            if content and not force:
                raise FileExistsError(f"there is a queue in {self.path}")
            return {"version": version + 1, "snapshot": place, "changes": [], "meta": meta, "event": event}

        self.commits.change(make)

    def meta(self) -> DataFrame:
        return self.spark.createDataFrame([tuple(self._last(self.commits.latest()[1])["meta"].values())], META)

    def _settle(self, change: Callable[[DataFrame, Column], DataFrame], kind: str, count: str, counted: str) -> int:
        """A command that changes any number of items; the event counts those whose new status is ``counted``."""
        now = self.now()

        def decide(items: DataFrame, content: dict):
            changed = settle(change(items, F.lit(now)))
            n, hits = changed.agg(F.count("*"), F.count_if(F.col("status") == counted)).first()
            return changed if n else None, {"ts": now, "event": kind, count: hits}

        return self._commit(decide)[count]

    def sync(self, present: DataFrame) -> int:
        return self._settle(lambda items, now: work_queue.sync(items, present, now, only=True), "sync", "marked_complete", "complete")

    def reset_stale(self, present: DataFrame) -> int:
        """Items put back to pending; those whose report is there become complete and do not count."""
        return self._settle(lambda items, now: work_queue.reset_stale(items, present, now, only=True), "reset_stale", "reset_to_pending", "pending")

    def next_batch(self, size: int = 0) -> list:
        """The items taken, at most ``size`` (0: the queue's size of a batch); none leaves the queue and the log as they are."""
        taken: list = []
        now = self.now()

        def decide(items: DataFrame, content: dict):
            nonlocal taken
            taken = work_queue.pending(items, size or content["meta"]["batch_size"]).collect()  # a batch
            if not taken:
                return None
            rows = self.spark.createDataFrame([tuple(r[c] for c in work_queue.COLUMNS) for r in taken], ITEMS)
            return work_queue.begin(rows, F.lit(now)), {"ts": now, "event": "next_batch", "batch_id": "batch-" + now.replace("-", "").replace(":", ""), "size": len(taken), "ids": [r.id for r in taken]}

        return taken if self._commit(decide) else []

    def mark_all(self, results: DataFrame) -> int:
        """Mark many items at once; ``results``: ``id, status, error, agent_id``, a row for an item.  One change, one event; returns the number of items.

        An id that is not there is an error, and so is a status that an item is not marked with: then nothing changes.
        """
        now = self.now()
        wrong = results.filter(~F.coalesce(F.col("status").isin(*work_queue.MARKS), F.lit(False))).limit(1).collect()
        if wrong:
            raise ValueError(f"an item is not marked {wrong[0]['status']}")
        total = results.select("id").distinct().count()

        def decide(items: DataFrame, content: dict):
            changed = settle(work_queue.mark_all(items, results, F.lit(now)))
            by_status = {r["status"]: r["count"] for r in changed.groupBy("status").count().collect()}  # a row for each status
            if (n := sum(by_status.values())) < total:
                raise KeyError(f"no item {results.join(items, 'id', 'left_anti').first()['id']}")
            return (changed, {"ts": now, "event": "mark_all", "marked": n, "statuses": by_status}) if n else None

        event = self._commit(decide)
        return event["marked"] if event else 0

    def mark(self, item: int, status: str, error: str | None = None, agent: str | None = None) -> None:
        now = self.now()

        def decide(items: DataFrame, content: dict):
            own = work_queue.mark(items.filter(F.col("id") == item), item, status, F.lit(now), error, agent).collect()
            if not own:
                raise KeyError(f"no item {item}")
            return self.spark.createDataFrame([tuple(r[c] for c in work_queue.COLUMNS) for r in own], ITEMS), {"ts": now, "event": "mark", "id": item, "status": status, "error": error, "agent_id": agent}

        self._commit(decide)

    def status(self) -> tuple[DataFrame, DataFrame]:
        return work_queue.histogram(self.items()), work_queue.progress(self.items())
