"""Reports found as a stream of files: each once, over restarts, instead of a listing at every command."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.files import base_name

FILE = "path string, modificationTime timestamp, length long, content binary"


def new_reports(spark: SparkSession, folder: str, pattern: str = "*.md", at_once: int | None = None) -> DataFrame:
    """A stream of ``report_file, size`` of the files that come into a folder; their contents are not read.

    Files count once, by their path: they are to be moved into the folder whole.  ``at_once``: files of a batch at most.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", pattern)
    if at_once:
        reader = reader.option("maxFilesPerTrigger", at_once)
    return reader.load(folder).select(base_name(F.col("path")).alias("report_file"), F.col("length").alias("size"))


def follow(spark: SparkSession, folder: str, checkpoint: str, found: Callable[[DataFrame, int], None], pattern: str = "*.md", at_once: int | None = None) -> None:
    """Hand every file that is new since the last time, in batches, to ``found`` (rows, number of the batch), and end.

    A batch that was cut short is handed over again, under the same number.
    """
    stream = new_reports(spark, folder, pattern, at_once).writeStream.foreachBatch(found).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()


def sync_queue(store, folder: str, checkpoint: str, at_once: int | None = None) -> int:
    """Sync the queue with reports that are new; returns how many items became complete.  Syncing twice with a report does no harm."""
    done = 0

    def found(rows: DataFrame, number: int) -> None:
        nonlocal done
        done += store.sync(rows)

    follow(store.spark, folder, checkpoint, found, at_once=at_once)
    return done
