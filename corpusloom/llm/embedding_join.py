"""Embedding near-duplicates: an exact metric range join over cells around pivots.

Vectors are scaled to length one, where a cosine of t is a distance of sqrt(2 - 2t).  Each vector lives in the cell of
its nearest pivot.  It is also sent to every other cell that can hold a vector within the radius: the triangle
inequality, against the pivots and against the cell's own radius, rules the others out.  Every cell then finds all
links of the vectors that live in it by itself.  Cells in which many live are cut once more, around pivots of their own,
by the same rule; what is large even then is dealt to blocks that each see the whole cell.
Links of a vector are counted where it lives and never listed; for components a block sends on a spanning set.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import tidy


#: Cells there are at least, and what the driver and every task can hold of them.
LEAST_PIVOTS, MOST_PIVOTS = 12, 2048
#: Blocks of vectors from which a cell is cut again, pivots inside all cells, vectors sampled for each of these and for all of them, at most.
LARGE, MOST_SUBS, SUB_SAMPLE, SAMPLED = 4, 32_768, 16, 1 << 17


def rows_of(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector as a numpy array; None for null, zero, empty, or with a null or non-finite component."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values, offsets = column.values, column.offsets.to_numpy()
    flat = values.to_numpy(zero_copy_only=False).astype(values.type.to_pandas_dtype(), copy=False) if not values.null_count else np.where(
        values.is_valid().to_numpy(zero_copy_only=False), values.fill_null(0).to_numpy(zero_copy_only=False), np.nan
    ).astype(values.type.to_pandas_dtype())
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    out = []
    for ok, a, b in zip(valid, offsets[:-1], offsets[1:], strict=True):
        v = flat[a:b] + 0.0  # no negative zeros
        out.append(v if ok and b > a and np.isfinite(v).all() and v.any() else None)
    return out


def unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max()
    return v / np.sqrt(v @ v)


def spread_pivots(sample: list[np.ndarray], n: int) -> np.ndarray:
    """Up to ``n`` vectors of the sample, each the farthest from those before it."""
    x = np.stack(sample)
    chosen = [0]
    far = 2 - 2 * (x @ x[0])
    while len(chosen) < n:
        at = int(np.argmax(far))
        if far[at] < 1e-9:
            break
        chosen.append(at)
        far = np.minimum(far, 2 - 2 * (x @ x[at]))
    return x[chosen]


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """In double precision, each sum rounded once."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


class Pivots:
    """Pivots of a cell (or of all vectors of a length), and which cells around them a vector lives in or visits."""

    def __init__(self, centres: np.ndarray) -> None:
        self.centres = centres
        self.between = np.sqrt(np.maximum(1e-18, 2 - 2 * (centres @ centres.T)))

    def distances(self, units: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * (units @ self.centres.T)))

    def visits(self, d: np.ndarray, reach: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each vector, and the cells that can hold a vector within the radius of it; ``reach``: how far from its pivot anything lives in a cell."""
        eps = 1e-9
        home = d.argmin(1)
        near = d[np.arange(len(d)), home]
        # Distance to the plane between two pivots; distance to the farthest vector that lives in the cell.
        return home, ((d**2 - near[:, None] ** 2) / (2 * self.between[home]) <= radius + eps) & (d <= reach + radius + eps)


def cell_id(size: int, cell: int, sub: int = -1) -> int:
    return size << 32 | cell << 16 | sub + 1


class Block:
    """The vectors that live in a block of a cell, against streams of vectors."""

    def __init__(self, keys, ids, copies, raw, threshold: float) -> None:
        from corpusloom.llm.simhash import Union

        self.keys, self.ids, self.raw, self.t = keys, ids, raw, threshold
        self.copies = np.array(copies, np.int64)
        self.units = np.stack([unit(v) for v in raw]).astype(np.float32)
        self.links = np.zeros(len(ids), np.int64)
        self.sets = Union()
        self.sets.grow(len(ids))
        self.edges: list[tuple[int, int]] = []

    def meet(self, keys, ids, copies, raw, same: bool = False, step: int = 512) -> None:
        slack = max(1e-5, len(raw[0]) * 2.4e-7)  # the error of a product in single precision is less
        for lo in range(0, len(ids), step):
            part = self.units[lo : lo + step] if same else np.stack([unit(v) for v in raw[lo : lo + step]]).astype(np.float32)
            s = part @ self.units.T
            hit = s >= self.t
            for j, i in zip(*np.nonzero(np.abs(s - self.t) <= slack), strict=True):
                hit[j, i] = cosine(raw[lo + j], self.raw[i]) >= self.t
            if same:
                hit[np.arange(len(part)), lo + np.arange(len(part))] = False
            self.links += np.array(copies[lo : lo + step], np.int64) @ hit
            j, i = np.nonzero(hit)
            if not len(j):
                continue
            new = np.flatnonzero(np.concatenate(([True], j[1:] != j[:-1])))
            first = np.repeat(i[new], np.diff(np.concatenate((new, [len(j)]))))
            for pair in np.unique(first * len(self.ids) + i).tolist():
                self.sets.join(*divmod(pair, len(self.ids)))
            if same:
                for jj, ii in zip(j[new].tolist(), i[new].tolist(), strict=True):
                    self.sets.join(lo + jj, ii)
            else:
                self.edges += [(ids[lo + jj], self.ids[ii]) for jj, ii in zip(j[new].tolist(), i[new].tolist(), strict=True)]

    def rows(self) -> list[tuple]:
        """Key and number of links of each vector; then the ids of spanning links."""
        out = [(k, int(n) + int(m) - 1, None, None) for k, n, m in zip(self.keys, self.links, self.copies, strict=True)]
        out += [(None, None, self.ids[i], self.ids[self.sets.root(i)]) for i in range(len(self.ids)) if self.sets.root(i) != i]
        return out + [(None, None, a, b) for a, b in self.edges]


def range_join(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, pivots: int | None = None, sample: int | None = None, block: int = 4096) -> DataFrame:
    """One row for each vector: the id, ``n_links`` (other vectors of cosine ``threshold`` or more), ``component_id``, ``kept``.

    Vectors that are null, zero, empty or hold null or non-finite components link with nothing, and neither do rows
    with a null id or vectors of different lengths; their component is their own id.  Equal vectors are compared once
    and count as often as they stand.  Different vectors that share an id are one node of a component.  An empty table gives no
    rows; other columns are ignored, whatever their names.  A cosine of exactly ``threshold``, each sum rounded once, links.
    ``pivots``: cells, one for each ``block`` different vectors unless given, from ``LEAST_PIVOTS`` to ``MOST_PIVOTS``; they
    are taken from ``sample`` vectors, sixteen for a pivot.  Cells of over ``LARGE`` blocks are cut again, around pivots
    of their own; what has more vectors than a block even then is dealt to blocks, so the result depends on none of this.
    """
    from corpusloom.llm.common import components, join_hot, materialise

    spark = df.sparkSession
    if df.schema[vector_col].dataType.simpleString() not in ("array<float>", "array<double>"):
        df = df.withColumn(vector_col, F.col(vector_col).cast("array<double>"))
    single = df.schema[vector_col].dataType.simpleString() == "array<float>"
    dtype = np.dtype("<f4" if single else "<f8")

    def read(batches):
        for b in batches:
            found = rows_of(b.column(1))
            raw = [None if v is None or i is None else v.astype(dtype).tobytes() for v, i in zip(found, b.column(0).to_pylist(), strict=True)]
            keys = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], names=["id", "key", "raw"])

    rows = materialise(df.select(F.col(id_col).cast("bigint"), vector_col).mapInArrow(tidy(read), "id bigint, key binary, raw binary"))
    distinct = materialise(rows.filter("key is not null").groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("raw").alias("raw")))
    if pivots is None:
        pivots = min(MOST_PIVOTS, max(LEAST_PIVOTS, -(-distinct.count() // block)))
    if sample is None:
        sample = max(2000, 16 * pivots)
    picked = distinct.select("raw").orderBy(F.xxhash64("key")).limit(sample).collect()  # bounded by sample
    by_length: dict[int, list[np.ndarray]] = {}
    for (r,) in picked:
        by_length.setdefault(len(r), []).append(unit(np.frombuffer(r, dtype)))
    tops = {n: Pivots(spread_pivots(v, pivots)) for n, v in by_length.items()}
    subs: dict[tuple[int, int], Pivots] = {}
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))

    def homes_of(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, cell inside it (-1 where it isn't cut), and distance from its pivot."""
        cell, sub, far = np.zeros(len(raw), np.int32), np.full(len(raw), -1, np.int32), np.zeros(len(raw))
        for n in {len(r) for r in raw}:
            own = np.array([i for i, r in enumerate(raw) if len(r) == n])
            if n not in tops:
                continue
            units = np.stack([unit(np.frombuffer(raw[i], dtype)) for i in own])
            d = tops[n].distances(units)
            cell[own], far[own] = d.argmin(1), d.min(1)
            for c in np.unique(cell[own]).tolist():
                if (n, c) in subs:
                    at = np.flatnonzero(cell[own] == c)
                    d = subs[n, c].distances(units[at])
                    sub[own[at]], far[own[at]] = d.argmin(1), d.min(1)
        return cell, sub, far

    def homes(batches):
        for b in batches:
            raw = b.column(0).to_pylist()
            cell, sub, far = homes_of(raw)
            size = pa.array([len(r) for r in raw], pa.int32())
            yield pa.RecordBatch.from_arrays([size, pa.array(cell), pa.array(sub), pa.array(far)], names=["size", "cell", "sub", "far"])

    def counted() -> list:
        """A row for each cell, of both levels: lengths times pivots bound them."""
        return distinct.select("raw").mapInArrow(tidy(homes), "size int, cell int, sub int, far double").groupBy("size", "cell", "sub").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()

    found = counted()
    large = {(r["size"], r["cell"]): -(-2 * r["n"] // block) for r in found if r["n"] > LARGE * block and r["size"] in tops}
    if large:
        # Two pivots for each block of a cell, in proportion if these are too many; a sample of each cell for them.
        share = min(1.0, MOST_SUBS / sum(large.values()))
        wanted = {k: max(2, int(n * share)) for k, n in large.items()}
        scale = 1 << 20
        most = int(min(SAMPLED, SUB_SAMPLE * sum(wanted.values())))
        rate = min(scale, max(1, int(scale * most / (block / 2 * sum(large.values())))))

        def sampled(batches):
            for b in batches:
                raw = b.column(0).to_pylist()
                cell, _, _ = homes_of(raw)
                at = [i for i, r in enumerate(raw) if (len(r), int(cell[i])) in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(cell[at], pa.int32()), b.column(0).take(pa.array(at, pa.int64()))], names=["cell", "raw"])

        few = distinct.filter(F.pmod(F.xxhash64("key", F.lit(11)), F.lit(scale)) < rate).select("raw").mapInArrow(tidy(sampled), "cell int, raw binary")
        by_cell: dict[tuple[int, int], list[np.ndarray]] = {}
        for r in few.orderBy(F.xxhash64("raw")).limit(2 * SAMPLED).collect():
            by_cell.setdefault((len(r["raw"]), r["cell"]), []).append(unit(np.frombuffer(bytes(r["raw"]), dtype)))
        subs.update({k: Pivots(spread_pivots(v, wanted[k])) for k, v in by_cell.items() if len(v) > 1})
        found = counted()
    cells = {cell_id(r["size"], r["cell"], r["sub"]): (r["far"], max(1, -(-r["n"] // block))) for r in found}
    top_reach: dict[tuple[int, int], float] = {}
    for n, top in tops.items():
        for c in range(len(top.centres)):
            # A cut cell reaches as far as what lives in the cells inside it, measured from its own pivot.
            inner = [cells[cell_id(n, c, k)][0] + float(top.distances(p[None])[0, c]) for k, p in enumerate(subs[n, c].centres) if cell_id(n, c, k) in cells] if (n, c) in subs else []
            top_reach[n, c] = max(inner, default=-10.0) if (n, c) in subs else cells.get(cell_id(n, c), (-10.0, 1))[0]
    sub_reach = {k: np.array([cells.get(cell_id(*k, i), (-10.0, 1))[0] for i in range(len(p.centres))]) for k, p in subs.items()}

    def deal(batches):
        for b in batches:
            raw = b.column(3).to_pylist()
            places: list[tuple[np.ndarray, int, np.ndarray]] = []  # rows, their cell, whether they live there
            for n in {len(r) for r in raw}:
                own = np.array([i for i, r in enumerate(raw) if len(r) == n])
                if n not in tops:
                    places.append((own, cell_id(n, 0), np.ones(len(own), bool)))
                    continue
                units = np.stack([unit(np.frombuffer(raw[i], dtype)) for i in own])
                home, go = tops[n].visits(tops[n].distances(units), np.array([top_reach[n, c] for c in range(len(tops[n].centres))]), radius)
                go[np.arange(len(own)), home] = True
                for c in np.flatnonzero(go.any(0)).tolist():
                    at = np.flatnonzero(go[:, c])
                    lives = home[at] == c
                    if (n, c) not in subs:
                        places.append((own[at], cell_id(n, c), lives))
                        continue
                    inside, into = subs[n, c].visits(subs[n, c].distances(units[at]), sub_reach[n, c], radius)
                    into[np.flatnonzero(lives), inside[lives]] = True
                    for k in np.flatnonzero(into.any(0)).tolist():
                        i = np.flatnonzero(into[:, k])
                        places.append((own[at[i]], cell_id(n, c, k), lives[i] & (inside[i] == k)))
            take, cell, part, guest = [], [], [], []
            for rows_, c, lives in places:
                parts = cells.get(c, (0.0, 1))[1]
                for i, here in zip(rows_.tolist(), lives.tolist(), strict=True):
                    mine = int.from_bytes(hashlib.blake2b(raw[i], digest_size=4).digest(), "little") % parts if here else -1
                    for s in range(parts):
                        take.append(i)
                        cell.append(c)
                        part.append(s)
                        guest.append(s != mine)
            idx = pa.array(take, pa.int64())
            for lo in range(0, len(take), 4096):
                i = idx.slice(lo, 4096)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[lo : lo + 4096], pa.int64()), pa.array(part[lo : lo + 4096], pa.int32()), pa.array(guest[lo : lo + 4096], pa.bool_()), *(c.take(i) for c in b.columns)],
                    names=["cell", "part", "guest", "key", "rep", "copies", "raw"],
                )

    dealt = distinct.select("key", "rep", "copies", "raw").mapInArrow(tidy(deal), "cell bigint, part int, guest boolean, key binary, rep bigint, copies bigint, raw binary")
    dealt = dealt.repartition("cell", "part").sortWithinPartitions("cell", "part", "guest")

    def compare(batches):
        at, block_, own = None, None, ([], [], [], [])

        def start():
            got = Block(*own, threshold)
            got.meet(*own, same=True)
            return got

        def out(rows):
            key, n, a, b = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), *(pa.array(c, pa.int64()) for c in (n, a, b))], names=["key", "n", "a", "b"])

        for batch in batches:
            cell, part, guest, keys, rep, copies, raw = (c.to_pylist() for c in batch.columns)
            lo = 0
            while lo < len(cell):
                hi = lo + 1
                while hi < len(cell) and (cell[hi], part[hi], guest[hi]) == (cell[lo], part[lo], guest[lo]):
                    hi += 1
                if at != (cell[lo], part[lo]):
                    if own[0]:
                        yield out((block_ or start()).rows())
                    at, block_, own = (cell[lo], part[lo]), None, ([], [], [], [])
                vectors = [np.frombuffer(r, dtype) for r in raw[lo:hi]]
                if not guest[lo]:
                    for kept, new in zip(own, (keys[lo:hi], rep[lo:hi], copies[lo:hi], vectors), strict=True):
                        kept.extend(new)
                elif own[0]:
                    block_ = block_ or start()
                    block_.meet(keys[lo:hi], rep[lo:hi], copies[lo:hi], vectors)
                lo = hi
        if own[0]:
            yield out((block_ or start()).rows())

    found = materialise(dealt.mapInArrow(tidy(compare), "key binary, n bigint, a bigint, b bigint"))
    counts = found.filter("n is not null").select("key", F.col("n").alias("n_links"))
    roots = components(found.filter("b is not null").select("a", "b")).select(F.col("node").alias("rep"), "root")
    by_key = distinct.select("key", "rep").join(counts, "key", "left").join(roots, "rep", "left")
    by_key = by_key.select("key", "n_links", F.coalesce("root", "rep").alias("root"))
    out = join_hot(rows.select("id", "key"), by_key, "key")  # equal vectors can be any share of the rows
    component = F.coalesce("root", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
