"""Vector code compression: product codes of vectors, with codebooks trained by whole-number k-means.

Vectors become whole numbers and are packed into blocks that hold a column of numbers for each dimension.  A round of
training is a ``treeAggregate`` over the RDD of blocks: distances to a codebook accumulate dimension by dimension,
``np.add.at`` adds parts to tensors of sums and counts, and the tensors, whose size hangs on the codebooks alone, merge
through a tree of reductions.  All is done in whole numbers, so no result hangs on the order in which anything merges.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import join_hot, materialise, tidy

#: Components stand for multiples of 1 / SCALE.
SCALE = 1024
#: Vectors in a block, and vectors compared with a codebook at once.
BLOCK, STEP = 4096, 512


def most(dimensions: int) -> int:
    """Whole numbers up to which squared distances over so many dimensions, and sums of 2**34 rows, stay within 64 bits; components beyond saturate."""
    return 1 << min(28, (62 - dimensions.bit_length()) // 2 - 1)


def whole(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with ``dimensions`` components, all finite, as whole numbers, and which rows these are."""
    column = column.cast(pa.list_(pa.float64()))
    values, ends = column.values, column.offsets.to_numpy()
    flat = values.to_numpy(zero_copy_only=False) if not values.null_count else np.where(values.is_valid().to_numpy(zero_copy_only=False), values.fill_null(0).to_numpy(zero_copy_only=False), np.nan)
    at = np.flatnonzero((np.diff(ends) == dimensions) & column.is_valid().to_numpy(zero_copy_only=False))
    found = flat[ends[at][:, None] + np.arange(dimensions)]
    ok = np.isfinite(found).all(1)
    with np.errstate(over="ignore"):  # what is beyond all numbers saturates, too
        return np.clip(np.floor(found[ok] * SCALE), -most(dimensions), most(dimensions)).astype(np.int64), at[ok]


def narrow(x: np.ndarray) -> np.ndarray:
    """In 32 bits where all values fit."""
    return x.astype(np.int32) if not x.size or max(-int(x.min()), int(x.max())) < 1 << 31 else x


def nearest(columns: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For parts given as a column for each dimension: their nearest entry of the codebook, lowest in a tie, and the squared distance."""
    d, n = columns.shape
    reach = max(np.abs(columns).max(initial=0), np.abs(book).max(initial=0))
    kind = np.int32 if d * (2 * int(reach)) ** 2 < 1 << 31 else np.int64
    columns, book = columns.astype(kind), np.ascontiguousarray(book.T.astype(kind))
    at, far = np.empty(n, np.int64), np.empty(n, np.int64)
    for lo in range(0, n, STEP):
        part = columns[:, lo : lo + STEP]
        total = np.zeros((part.shape[1], book.shape[1]), kind)
        for j in range(d):
            step = part[j][:, None] - book[j][None, :]
            step *= step
            total += step
        best = total.argmin(1)
        at[lo : lo + STEP], far[lo : lo + STEP] = best, total[np.arange(len(best)), best]
    return at, far


def unpack(data: bytes, dimensions: int, parts: int) -> np.ndarray:
    """A block as parts, dimensions of a part, vectors."""
    wide = data[:1] == b"8"
    return np.frombuffer(data, "<i8" if wide else "<i4", offset=1).reshape(parts, dimensions // parts, -1)


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """A row for each vector that is kept: the id, ``code`` (two hex digits a part), ``error``, ``label_error``, ``codebooks_sha256``.

    A component x becomes floor(1024 x).  The codebooks start as the parts of the ``entries`` (up to 256) smallest ids and
    are trained in ``rounds``: every part goes to its nearest entry, ties to the lower one, then an entry becomes the mean
    of its parts, rounded down; an entry without parts stays.  ``error``: squared distances of the last assignment, summed
    over parts; ``label_error``: errors summed over rows of an equal label, null labels together.

    Dropped are vectors that are null, empty or hold null or non-finite components, vectors of other lengths than the one of
    the smallest id that is kept, and vectors that ``parts`` doesn't divide.  Components beyond 2**27 or so (:func:`most`) saturate.  Rows that repeat an id are vectors of
    their own, in the order of their components where the order matters; null ids come last.  An empty table gives no
    rows; other columns are ignored, whatever their names.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    fit = F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = f"`{id_col}` bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
    # One row, then one row for each entry: the order of components settles which of rows that share an id come first.
    one = rows.filter(fit).orderBy(F.col("id").asc_nulls_last(), "v").select(F.size("v")).first()
    if one is None:
        return spark.createDataFrame([], out)
    dimensions = one[0]
    first = rows.filter(fit & (F.size("v") == dimensions)).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start, _ = whole(pa.array([r["v"] for r in first], pa.list_(pa.float64())), dimensions)
    books = start.reshape(len(start), parts, dimensions // parts).transpose(1, 0, 2)  # part, entry, dimension

    def pack(batches):
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                own = b.slice(lo, BLOCK)
                x, at = whole(own.column(2), dimensions)
                x = narrow(np.ascontiguousarray(x.T))
                head = b"8" if x.dtype == np.int64 else b"4"
                take = pa.array(at)
                ids, labels = (pa.array([c.take(take).to_pylist()], pa.list_(c.type)) for c in (own.column(0), own.column(1)))
                if len(at):
                    yield pa.RecordBatch.from_arrays([ids, labels, pa.array([head + x.astype(x.dtype.newbyteorder("<")).tobytes()], pa.binary())], names=["ids", "labels", "data"])

    kind = rows.schema["label"].dataType.simpleString()
    blocks = materialise(rows.mapInArrow(tidy(pack), f"ids array<bigint>, labels array<{kind}>, data binary"))
    packed = blocks.select("data").rdd.map(lambda r: bytes(r["data"]))

    def add(books: np.ndarray):
        def one(total, data):
            x = unpack(data, dimensions, parts)
            sums, counts = total or (np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64))
            for p in range(parts):
                at, _ = nearest(x[p], books[p])
                np.add.at(sums[p], at, x[p].T)
                np.add.at(counts[p], at, 1)
            return sums, counts

        return one

    def merge(a, b):
        return a and b and (a[0] + b[0], a[1] + b[1]) or a or b

    for _ in range(rounds):
        sums, counts = packed.treeAggregate(None, add(books), merge, depth=3)
        used = counts > 0
        books = np.where(used[..., None], sums // np.maximum(counts, 1)[..., None], books)

    def encode(batches):
        for b in batches:
            for ids, labels, data in zip(b.column(0), b.column(1), b.column(2), strict=True):
                found = [nearest(x, books[p]) for p, x in enumerate(unpack(data.as_py(), dimensions, parts))]
                codes = np.stack([at for at, _ in found], 1).astype(np.uint8).tobytes().hex()
                code = [codes[i : i + 2 * parts] for i in range(0, len(codes), 2 * parts)]
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(code), pa.array(sum(far for _, far in found))], names=["id", "label", "code", "error"])

    coded = materialise(blocks.mapInArrow(tidy(encode), f"id bigint, label {kind}, code string, error bigint"))
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    named = join_hot(coded, by_label, "label")
    return named.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
