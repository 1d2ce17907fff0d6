"""A session with the settings the library counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "corpusloom", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive execution on, times in UTC.  Sizes (shuffle partitions, memory) are the cluster's to set."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Spark's own bound of a batch to Python, and ours: texts are long, and a task holds a batch, its strings and what is made of them.
SPARK_BATCH, BATCH = f"{64 << 20}b", "4m"


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch to Python, unless the session has a bound of its own; for applications, operators leave the session alone."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == SPARK_BATCH:
        spark.conf.set(key, BATCH)
