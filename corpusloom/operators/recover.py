"""Second attempts at failed documents, and the logs before and after."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.match import last_by

#: The reasons that logs give.
NOT_FOUND, STUB, EXISTS, UNRESOLVED = "Row not found in CSV", "index_or_stub_entry", "file_exists", "No alternate source found"


def plan(failed: DataFrame, catalog: DataFrame, skip_links: list[str], present: DataFrame | None = None) -> DataFrame:
    """Failed entries with their catalog row and what is to be done: ``action`` is retry, skipped or still_failed, with ``reason``.

    Of catalog rows with one link the last counts.  ``present``: files (``file``) that are there already.
    """
    rows = last_by(catalog, ["link"], "row_pos").withColumn("_found", F.lit(True))
    out = failed.select("file", "link").join(rows, "link", "left")
    there = F.lit(False)
    if present is not None:
        out = out.join(present.select("file").distinct().withColumn("_there", F.lit(True)), "file", "left")
        there = F.coalesce("_there", F.lit(False))
    stub = F.col("link").isin(skip_links) if skip_links else F.lit(False)
    missing = F.col("_found").isNull()
    action = F.when(missing, "still_failed").when(stub | there, "skipped").otherwise("retry")
    reason = F.when(missing, NOT_FOUND).when(stub, STUB).when(there, EXISTS)
    return out.withColumns({"action": action, "reason": reason}).drop("_found", "_there")


def still_failed(failed: DataFrame, recovered: DataFrame, skipped: DataFrame) -> DataFrame:
    done = recovered.select("file").unionByName(skipped.select("file")).distinct()
    return failed.join(done, "file", "left_anti")


def with_recovered(success: DataFrame, recovered: DataFrame) -> DataFrame:
    """Successes and what was recovered of other files; repeats among the recovered stay."""
    new = recovered.join(success.select("file").distinct(), "file", "left_anti").withColumn("recovered", F.lit(True))
    return success.unionByName(new, allowMissingColumns=True)


def outcome_counts(log: DataFrame, outcome: str = "outcome") -> DataFrame:
    return log.groupBy(outcome).agg(F.count("*").alias("n"))
