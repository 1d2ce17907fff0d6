"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts that are turned into Python objects at once; bounds the memory of a worker.
SLICE = 256


def checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder in ``spark.checkpoint.dir``; set one of our own only where none is set, in local mode.

    On a cluster a folder of one machine would not do, so one that is not set is an error there.
    """
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(os.path.join(tempfile.gettempdir(), "corpusloom-checkpoints"))


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder: cuts its lineage and survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark's own bound of a batch to Python, and ours: texts are long, and several batches of a task are in memory at once.
SPARK_BATCH, BATCH = f"{64 << 20}b", "4m"


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch to Python, unless the session has a bound of its own; for applications, operators leave the session alone."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == SPARK_BATCH:
        spark.conf.set(key, BATCH)


#: Rows and bytes of strings up to which a table of a few columns is broadcast; beyond them joins go by exchange.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20


def checked_broadcast(small: DataFrame, rows: int, strings: int = 0) -> DataFrame:
    """``small`` to be broadcast, if its rows and the bytes of its ``strings`` are few enough; numbers need no second check."""
    return F.broadcast(small) if rows <= BROADCAST_ROWS and strings <= BROADCAST_BYTES else small


def broadcast_texts(small: DataFrame, *columns: str) -> DataFrame:
    """As :func:`checked_broadcast`, for a materialised table whose strings have no bound of their own."""
    bytes_ = F.coalesce(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0))), F.lit(0))
    n, strings = small.agg(F.count("*"), bytes_).first()
    return checked_broadcast(small, n, strings)


#: A key is hot if it has more rows than this share of what a partition holds on average.
HOT_SHARE = 0.25


def join_hot(large: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """``large`` with the columns of ``small``, which has a row for each key of ``large``; null is a key like others.

    A key of ``large`` can hold any share of its rows.  ``small`` is broadcast if a count proves it short.  Else rows of
    hot keys meet a broadcast of the few rows of ``small`` that have these keys, at most partitions / ``HOT_SHARE`` of
    them, and all other keys are joined by exchange.  Both tables should be written: each is read up to three times.
    """
    small = materialise(small)
    right = small.withColumnRenamed(key, fresh("_key", large, small))
    same = F.col(key).eqNullSafe(F.col(right.columns[small.columns.index(key)]))
    key_ = right.columns[small.columns.index(key)]
    n = small.count()
    if n <= BROADCAST_ROWS:
        return large.join(F.broadcast(right), same, "left").drop(key_)
    parts = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max(1, int(HOT_SHARE * large.count() / parts))
    hot = materialise(large.groupBy(key).count().filter(F.col("count") > least).select(F.col(key).alias(key_)))
    few = F.broadcast(hot)  # at most parts / HOT_SHARE rows
    mine = F.col(key).eqNullSafe(F.col(key_))
    heavy = large.join(few, mine, "left_semi").join(F.broadcast(right.join(few.withColumnRenamed(key_, key), F.col(key_).eqNullSafe(F.col(key)), "left_semi")), same, "left").drop(key_)
    return heavy.unionByName(large.join(few, mine, "left_anti").join(right, same, "left").drop(key_))


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, longer if it has to be, so that no frame has a column of it."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tidy(run: Callable) -> Callable:
    """``run`` on batches; at its end the worker, which waits for other tasks, gives memory back to the machine."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # not every C library has it
                pass

    return tidied


def map_texts(df: DataFrame, id_col: str, text_col: str, make: Callable[[], Callable], fields: Iterable[T.StructField]) -> DataFrame:
    """One row for each row of ``df``: its id, then ``make()(text)``, a tuple with a value for each of ``fields``.

    ``make`` runs once in each task.  Other columns are not read, so their names cannot clash.
    """
    fields = list(fields)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), *fields])

    def run(batches):
        each = make()
        to_arrow = schema_types(fields)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                rows = [each(t) for t in part.column(1).to_pylist()]
                cols = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, t) for c, t in zip(cols, to_arrow, strict=True))],
                    names=[id_col, *(f.name for f in fields)],
                )

    return df.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(tidy(run), schema)


def schema_types(fields: Iterable[T.StructField]) -> list[pa.DataType]:
    """Arrow types of Spark fields, as far as this subpackage uses them."""

    def of(t: T.DataType) -> pa.DataType:
        if isinstance(t, T.ArrayType):
            return pa.list_(of(t.elementType))
        if isinstance(t, T.StructType):
            return pa.struct([(f.name, of(f.dataType)) for f in t.fields])
        return {
            "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
            "boolean": pa.bool_(), "binary": pa.binary(),
        }[t.simpleString()]

    return [of(f.dataType) for f in fields]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph, by alternating large-star and small-star rounds.

    ``edges`` has two bigint columns, ``a`` and ``b``; loops, repeats and either direction are allowed.  Returns
    ``node``, ``root`` (the smallest node reachable) for each node of an edge between two different nodes.  Every
    round only aggregates by node with partial sums and joins on node, so no component is gathered in one task.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = materialise(e)
    n = e.count()
    for _ in range(max_rounds):
        # Large star: join every larger neighbour of a node to the node's smallest neighbour (or itself).
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # Small star: join every smaller neighbour of a node, and the node, to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        before, last = e, n
        e = materialise(small.filter("u <> v").distinct())
        n = e.count()
        # Settled when a round changes no edge: as many as before, and none that was not there.
        if n == last and not e.join(before, ["u", "v"], "left_anti").limit(1).count():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
