"""The work queue from its log as a stream: events by item, folded into the item's state.

An extension: the same fold as :func:`corpusloom.operators.work_queue.latest`, kept up to date as events arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def follow(events: DataFrame) -> DataFrame:
    """``events``: a stream of ``id, event_id, status``; a row for each item that a batch touches, in update mode.

    The status is that of the event of greatest number, whatever order events come in.  The state is an aggregate of
    Spark's own, a row an item.
    """
    return events.groupBy("id").agg(F.max_by("status", "event_id").alias("status"), F.count("*").alias("n_events"), F.max("event_id").alias("last_event"))


def run_to_end(spark: SparkSession, events: DataFrame, table: str, checkpoint: str) -> DataFrame:
    """Drive the stream over what is there and return the state of every item."""
    query = follow(events).writeStream.outputMode("update").foreachBatch(lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("append").parquet(table)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.parquet(table)
    return rows.groupBy("id").agg(F.max(F.struct("n_events", "status", "last_event")).alias("s")).select("id", "s.status", "s.n_events", "s.last_event")
