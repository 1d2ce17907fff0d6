"""SimHash near-duplicates: fingerprints of word shingles, linked within a Hamming radius by BK-trees.

Two fingerprints within the radius agree on all bits outside at most ``radius`` of the blocks that a fingerprint is cut
into, so each choice of the other blocks is a shard key, and links only run inside shards.  There are more blocks, and so
more bits in a key, the more fingerprints there are.  A shard is a BK-tree: children are keyed by their integer Hamming
distance to the parent, and a search follows only the edges within the radius.  The trees of many shards are kept as one
set of arrays (:class:`Forest`).

While all trees together take no more than ``TREE_BYTES``, a bound that is checked first, they are broadcast and every task
searches for its own fingerprints.  All trees together grow with the corpus: beyond the bound a tree goes to the task
that holds the searches of its shard.  There shards of more than ``tree_nodes`` fingerprints are dealt to several trees,
and every search of the shard visits each of them.
"""

from __future__ import annotations

import itertools
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import windows as W
from corpusloom.llm.common import checked_broadcast, tidy

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text: str | None, k: int) -> list[bytes]:
    """Runs of ``k`` words, ASCII letters lower-cased, joined by blanks; all words if there are fewer; repeats stay."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= k:
        return [joined]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [joined[a:b] for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]


def votes_to_fingerprint(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed number of 64 bits; 0 for no hash."""
    votes = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[lo : lo + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.uint32)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, k: int = 3, seed: int = 42) -> int:
    from xxhash import xxh64_intdigest

    return votes_to_fingerprint(np.array([xxh64_intdigest(s, seed) for s in shingles(text, k)], np.uint64))


#: Bytes that broadcast trees may take, and what a node takes at most: fingerprint, node, edge, child, and its share of a shard.
TREE_BYTES, NODE_BYTES = 64 << 20, 44


class Forest:
    """BK-trees of shards of integers under Hamming distance, as arrays: an edge is a parent, a distance and a child."""

    def __init__(self, shard: np.ndarray, prints: np.ndarray) -> None:
        """``prints``: a row of 64-bit numbers for each item; ``shard``: where it belongs.  Items are added in their order."""
        self.prints, self.span = prints, 64 * prints.shape[1] + 1
        self.shards, self.roots = np.unique(shard, return_index=True)
        self.same = np.arange(len(shard))  # the item in the tree with this print
        place = np.searchsorted(self.shards, shard)
        self.size = np.bincount(place, minlength=len(self.shards))
        at = self.roots[place]
        todo = np.flatnonzero(at != np.arange(len(shard)))
        at = at[todo]
        keys, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(todo):
            d = self.distance(prints[todo], prints[at])
            self.same[todo[d == 0]] = at[d == 0]
            todo, key = todo[d > 0], (at * self.span + d)[d > 0]
            order = np.argsort(key, kind="stable")
            todo, key = todo[order], key[order]
            new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
            keys.append(key[new])
            children.append(todo[new])
            at, todo = todo[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))][~new], todo[~new]
        self.key, self.child = np.concatenate(keys), np.concatenate(children)
        order = np.argsort(self.key)
        self.key, self.child = self.key[order], self.child[order]

    @staticmethod
    def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(a ^ b).sum(1, dtype=np.int64)

    def near(self, shard: np.ndarray, prints: np.ndarray, radius: int, visits: int | None = None):
        """Pairs of a query and an item of its shard within the radius, some queries at a time; equal items count as one."""
        if not len(self.shards):
            return
        visits = visits or (1 << 20) // prints.shape[1]  # bounds the memory of a step
        place = np.minimum(np.searchsorted(self.shards, shard), len(self.shards) - 1)
        known = np.flatnonzero(self.shards[place] == shard)
        root, most = self.roots[place[known]], np.cumsum(self.size[place[known]])
        lo = 0
        while lo < len(known):
            hi = max(lo + 1, int(np.searchsorted(most, (most[lo - 1] if lo else 0) + visits, side="right")))
            q, at, found = known[lo:hi], root[lo:hi], []
            while len(q):
                d = self.distance(prints[q], self.prints[at])
                hit = d <= radius
                found.append((q[hit], at[hit]))
                a = np.searchsorted(self.key, at * self.span + np.maximum(d - radius, 1))
                n = np.searchsorted(self.key, at * self.span + np.minimum(d + radius, self.span - 1), side="right") - a
                q, at = np.repeat(q, n), self.child[W.ranges(a, n)]
            yield tuple(np.concatenate(c) for c in zip(*found, strict=True))
            lo = hi


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of each pair; ``label`` leads every place to the least of its set, before and after."""
    a, b = label[a], label[b]
    while True:
        apart = np.flatnonzero(a != b)
        if not len(apart):
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]
        a, b = label[a], label[b]


def tree_links(shard: np.ndarray, node: np.ndarray, prints: np.ndarray, own: np.ndarray, guest: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of rows of some shards: trees of the rows ``own``, searched for the rows ``guest``."""
    at, ask = np.flatnonzero(own), np.flatnonzero(guest)
    forest, label = Forest(shard[at], prints[at]), np.arange(len(shard))
    unite(label, at, at[forest.same])
    for q, found in forest.near(shard[ask], prints[ask], radius):
        unite(label, ask[q], at[found])
    led = np.flatnonzero(label != np.arange(len(label)))
    return node[led], node[label[led]]


class Union:
    def __init__(self) -> None:
        self.up: list[int] = []

    def grow(self, n: int) -> None:
        self.up.extend(range(len(self.up), n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def shard_keys(fp, n: int, radius: int, per_shard: int = 16) -> list:
    """Keys of a 64-bit fingerprint: of ``m`` blocks any ``m - radius``, the fewest blocks for which ``n`` values leave a shard ``per_shard`` on average."""
    m = radius + 1
    while n > per_shard << (64 * (m - radius) // m) and m < radius + 8:
        m += 1
    edges = [64 * i // m for i in range(m + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    # A hash of the bits is key enough: whatever meets by chance is told apart by its distance.
    return [F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(signed(sum(own))))) for i, own in enumerate(itertools.combinations(blocks, m - radius))]


def link(prints: DataFrame, col: str = "fp", radius: int = 3, tree_nodes: int = 1024, tree_bytes: int = TREE_BYTES) -> DataFrame:
    """Spanning links (``a``, ``b``) of the graph on distinct fingerprints within the radius; no link between sets is lost."""
    fp = F.col(col)
    raw = F.unhex(F.lpad(F.hex(fp), 16, "0"))
    keys = shard_keys(fp, prints.count(), radius)
    return link_keyed(prints.select(fp.alias("node"), raw.alias("fp"), F.explode(F.array(*keys)).alias("key")), radius, 64, tree_nodes, tree_bytes)


def hex_print(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, seed: int = 42, radius: int = 3, tree_nodes: int = 1024, tree_bytes: int = TREE_BYTES) -> DataFrame:
    """Fingerprint and component of each row: the id, ``fingerprint`` (hex) and ``component_id``.

    ``component_id`` is the smallest id that links reach.  A null or blank text has fingerprint zero, and zero links
    like any other.  Rows with a null id take part and get the smallest id there is in their component, or null.
    Repeated rows give repeated results; an empty table gives no rows.  A text of any length is taken whole.  A bit that
    exactly half of the hashes have is 0.  Other columns are ignored, whatever their names.
    """
    from corpusloom.llm.common import components, join_hot, map_texts, materialise

    prints = map_texts(df, id_col, text_col, lambda: lambda t: (fingerprint(t, k, seed),), [T.StructField("_fp", T.LongType())])
    prints = materialise(prints)
    classes = materialise(prints.groupBy("_fp").agg(F.min(id_col).alias("_least")))
    roots = components(link(classes, "_fp", radius, tree_nodes, tree_bytes)).select(F.col("node").alias("_fp"), F.col("root").alias("_root"))
    rooted = classes.join(roots, "_fp", "left").withColumn("_root", F.coalesce("_root", "_fp"))
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    member = rooted.select("_fp", "_root").join(least, "_root").select("_fp", "component_id")
    # A fingerprint, zero above all, can be that of any share of the rows.
    return join_hot(prints, member, "_fp").select(F.col(id_col), hex_print(F.col("_fp")).alias("fingerprint"), "component_id")


def similarity_radius(similarity: float, bits: int, spread: float = 3.0) -> int:
    """Bits that may differ at this Jaccard similarity: as many as are expected, and ``spread`` standard deviations."""
    p = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    return int(bits * p + spread * (bits * p * (1 - p)) ** 0.5)


def long_fingerprint(text: str | None, k: int, bits: int, seed: int, block: int, flips: int, small: int = 0) -> tuple[bytes, list[int], int, list[int] | None]:
    """A fingerprint of ``bits`` bits over the distinct shingles, its shard keys, a hash of the set of shingles, and a set of up to ``small`` itself.

    A key is a block of ``block`` bits.  Each block also gives the keys with any of its ``flips`` bits of the closest
    votes turned over: those are the bits in which near copies differ first.
    """
    from xxhash import xxh64_intdigest

    from corpusloom.llm.windows import mix

    hashes = np.unique(np.array([xxh64_intdigest(s, seed) for s in shingles(text, k)], np.uint64))
    votes = np.zeros(bits, np.int64)
    for w in range(bits // 64):
        own = mix(hashes + np.uint64((w * 0x9E3779B97F4A7C15) % (1 << 64)))
        for lo in range(0, len(own), 1 << 16):
            part = np.unpackbits(own[lo : lo + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes[64 * w : 64 * w + 64] += part.sum(0, dtype=np.uint32)
    lead = 2 * votes - len(hashes)
    blocks = bits // block
    on = (lead > 0)[: blocks * block].reshape(blocks, block)
    values = on @ (np.int64(1) << np.arange(block, dtype=np.int64))
    near = np.argsort(np.abs(lead)[: blocks * block].reshape(blocks, block), axis=1, kind="stable")[:, :flips]
    keys = values[:, None]
    for j in range(flips):
        keys = np.concatenate((keys, keys ^ (np.int64(1) << near[:, j : j + 1].astype(np.int64))), axis=1)
    keys = keys + (np.arange(len(values), dtype=np.int64) << 32)[:, None]
    return np.packbits(lead > 0).tobytes(), keys.ravel().tolist(), int(np.uint64(xxh64_intdigest(hashes.tobytes())).view(np.int64)), hashes.view(np.int64).tolist() if len(hashes) <= small else None


def in_parts(rows: DataFrame, key: str, by: str, most: int) -> DataFrame:
    """Adds ``lo, hi, own``: keys of over ``most`` rows are dealt to parts, and each row goes to every pair of parts with its own."""
    from corpusloom.llm.common import materialise

    hot = materialise(rows.groupBy(key).count().filter(F.col("count") > most).select(key, F.ceil(F.col("count") / most).cast("int").alias("parts")))
    n = hot.count()
    if not n:
        return rows.withColumns({"lo": F.lit(0), "hi": F.lit(0), "own": F.lit(0)})
    dealt = rows.join(checked_broadcast(hot, n), key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64(by, F.lit(3)), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return dealt.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("parts", "other")


def grouped(batches, n_key: int):
    """Rows of sorted batches as Python values, a list for each run of equal first ``n_key`` columns."""
    at, own = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if row[:n_key] != at:
                if own:
                    yield at, own
                at, own = row[:n_key], []
            own.append(row[n_key:])
    if own:
        yield at, own


def pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def prints_of(column: pa.Array, bits: int) -> np.ndarray:
    """Fingerprints of equal length as rows of 64-bit numbers."""
    lo = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
    return np.frombuffer(column.buffers()[2], np.uint8)[lo : lo + len(column) * bits // 8].view("<u8").reshape(-1, bits // 64) if len(column) else np.zeros((0, bits // 64), np.uint64)


def whole_shards(batches, bits: int, rows: int = 1 << 18):
    """Sorted rows ``key, lo, hi, own, node, fp`` as arrays, many shards at once, a shard never split: a number for each shard, then own or guest, node, print."""
    held: list[tuple[np.ndarray, ...]] = []
    n = 0

    def joined():
        key, lo, hi, own, node, fp = (np.concatenate(c) for c in zip(*held, strict=True))
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
        return np.cumsum(new) - 1, new, (key, lo, hi, own, node, fp)

    for b in batches:
        if not b.num_rows:
            continue
        held.append((*(b.column(i).to_numpy(zero_copy_only=False) for i in range(5)), prints_of(b.column(5), bits)))
        n += b.num_rows
        if n >= rows:
            shard, new, cols = joined()
            cut = int(np.flatnonzero(new)[-1])  # the last shard may go on
            if cut:
                yield shard[:cut], *(c[:cut] for c in cols[1:])
            held = [tuple(c[cut:].copy() for c in cols)]
            n = len(shard) - cut
            rows = max(rows, 2 * n)
    if n:
        shard, _, cols = joined()
        yield shard, *cols[1:]


def edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def link_keyed(keyed: DataFrame, radius: int, bits: int, tree_nodes: int = 1024, tree_bytes: int = TREE_BYTES) -> DataFrame:
    """Spanning links (``a``, ``b``) among ``node`` whose ``fp`` (binary, of ``bits`` bits) is within the radius and that share a ``key``."""
    keyed = keyed.select("key", "node", "fp")
    n = keyed.count()
    if n * (NODE_BYTES + bits // 8 - 8) <= tree_bytes:
        return link_by_broadcast(keyed, radius, bits)
    dealt = in_parts(keyed, "key", "fp", tree_nodes).select("key", "lo", "hi", "own", "node", "fp")
    shards = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "own", "node")

    def run(batches):
        for shard, lo, hi, own, node, prints in whole_shards(batches, bits):
            yield edge_batch(*tree_links(shard, node, prints, own == lo, (lo == hi) | (own != lo), radius))

    return shards.mapInArrow(tidy(run), "a bigint, b bigint")


def link_by_broadcast(keyed: DataFrame, radius: int, bits: int) -> DataFrame:
    """As :func:`link_keyed`, for trees that may be broadcast: built where their shards meet, searched wherever a fingerprint lies."""
    spark = keyed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("key", F.lit(9)), F.lit(parts)).cast("int")
    # A shard of one fingerprint has no links.
    rows = keyed.withColumn("part", part)

    def build(batches):
        for number, own in itertools.groupby((r for b in batches for r in slices(b)), key=lambda r: r[0]):
            key, node, prints = (np.concatenate(c) for c in zip(*(r[1:] for r in own), strict=True))
            _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
            some = count[inverse] > 1
            if some.any():
                forest = Forest(key[some], prints[some])
                forest.same = None
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([pickle.dumps((forest, node[some]))], pa.binary())], names=["part", "trees"])

    def slices(b: pa.RecordBatch):
        number = b.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(number)) + 1
        prints = prints_of(b.column(3), bits)
        for lo, hi in itertools.pairwise([0, *cuts.tolist(), len(number)]):
            if hi > lo:
                yield int(number[lo]), b.column(1).to_numpy()[lo:hi], b.column(2).to_numpy()[lo:hi], prints[lo:hi]

    built = rows.select("part", "key", "node", "fp").repartitionById(parts, F.col("part")).sortWithinPartitions("part", "node").mapInArrow(tidy(build), "part int, trees binary")
    trees = spark.sparkContext.broadcast({r["part"]: bytes(r["trees"]) for r in built.collect()})  # tree_bytes bound it

    def search(batches):
        forests = {p: pickle.loads(x) for p, x in trees.value.items()}
        for b in batches:
            number, key, node, prints = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(), prints_of(b.column(3), bits)
            found = []
            for p in np.unique(number).tolist():
                if p in forests:
                    forest, names = forests[p]
                    own = np.flatnonzero(number == p)
                    found += [(node[own[q]], names[at]) for q, at in forest.near(key[own], prints[own], radius)]
            if found:
                a, c = (np.concatenate(x) for x in zip(*found, strict=True))
                names, places = np.unique(np.concatenate((a, c)), return_inverse=True)
                label = np.arange(len(names))
                unite(label, places[: len(a)], places[len(a) :])
                led = np.flatnonzero(label != np.arange(len(label)))
                yield edge_batch(names[led], names[label[led]])

    return rows.select("part", "key", "node", "fp").mapInArrow(tidy(search), "a bigint, b bigint")


def alike(wanted: list[np.ndarray], among: list[np.ndarray], similarity: float, same: bool):
    """For each set its fellows of Jaccard similarity or more, exactly, from one inverted index; of the same list only those before it."""
    sizes = np.array([len(s) for s in among])
    keys = np.concatenate(among)
    owner = np.repeat(np.arange(len(among)), sizes)
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    for i, s in enumerate(wanted):
        lo, hi = np.searchsorted(keys, s, "left"), np.searchsorted(keys, s, "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(among))
        found = np.flatnonzero(common >= similarity * (len(s) + sizes - common) - 1e-9)
        yield i, found[found < i] if same else found


def spanning(own: list[tuple[int, np.ndarray]], guests: list[tuple[int, np.ndarray]] | None, similarity: float) -> list[tuple[int, int]]:
    """A spanning set of the links of the similarity among ``own`` (nodes and sets), or between ``guests`` and ``own`` unless they are None; exact."""
    same = guests is None
    wanted = own if same else guests
    if not own or not wanted:
        return []
    names, out, union = [n for n, _ in own], [], Union()
    union.grow(len(names))
    for i, found in alike([s for _, s in wanted], [s for _, s in own], similarity, same):
        for j in found.tolist():
            union.join(found[0], j)
        if len(found):
            if same:
                union.join(int(found[0]), i)
            else:
                out.append((wanted[i][0], names[found[0]]))
    return out + [(names[j], names[union.root(j)]) for j in range(len(names)) if union.root(j) != j]


def small_links(sets: DataFrame, similarity: float, block: int = 1024) -> DataFrame:
    """Spanning links of ``node`` whose sets of hashes, ``_small``, have the similarity; exact, none is missed.

    Sets of the similarity share one of their first ``size - ceil(similarity * size) + 1`` hashes in any order that all
    sets keep; hashes of over ``block`` sets come last in it.  Sets that share such a hash are compared; those of a hash
    of over ``block`` sets are dealt to parts, and each pair of parts is compared.
    """
    from corpusloom.llm.common import materialise

    sets = sets.select("node", "_small").filter("size(_small) > 0")
    each = sets.select("node", "_small", F.explode("_small").alias("s"))
    hot = materialise(each.groupBy("s").count().filter(F.col("count") > block).select("s", F.lit(1).alias("hot")))
    n = hot.count()
    if n:
        each = each.join(checked_broadcast(hot, n), "s", "left")
        sets = each.groupBy("node", "_small").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("hot", F.lit(0)).alias("hot"), "s"))).alias("o")).select("node", "_small", F.col("o.s").alias("o"))
    else:
        sets = sets.withColumn("o", F.sort_array("_small"))
    first = F.slice("o", F.lit(1), (F.size("o") - F.ceil(F.size("o") * similarity - 1e-9) + 1).cast("int"))
    dealt = in_parts(sets.select("node", "_small", F.explode(first).alias("key")), "key", "node", block).select("key", "lo", "hi", "own", "node", "_small")

    def run(batches):
        out = []
        for (_, lo, hi), rows in grouped(batches, 3):
            sides: list[list[tuple[int, np.ndarray]]] = [[], []]
            for part, node, hashes in rows:
                sides[part != lo].append((node, np.array(hashes, np.int64)))
            out += spanning(sides[0], None if lo == hi else sides[1], similarity)
            if len(out) > 10_000:
                yield pairs_batch(out)
                out = []
        yield pairs_batch(out)

    return dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "own", "node").mapInArrow(tidy(run), "a bigint, b bigint")


def verified(members: DataFrame, texts: DataFrame, k: int, similarity: float, block: int = 512) -> DataFrame:
    """Spanning links within groups, of pairs whose sets of shingles have the similarity, exactly.

    ``members``: ``node, root``, materialised; ``texts``: ``_id, _text``.  Texts of members travel compressed to the
    task of their group; groups of over ``block`` members are dealt to parts, and each pair of parts is one task.
    """
    n = members.count()
    own = texts.join(checked_broadcast(members, n), F.col("_id") == F.col("node")).select("root", "node", "_text")

    def squeeze(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3)
        for b in batches:
            data = [pack.compress((t or "").encode("utf-8", "surrogatepass")) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(data, pa.binary())], names=["root", "node", "data"])

    sent = own.mapInArrow(tidy(squeeze), "root bigint, node bigint, data binary")
    sizes = members.groupBy("root").count()
    hot = sizes.filter(F.col("count") > block).select("root", F.ceil(F.col("count") / block).cast("int").alias("parts"))
    n_hot = hot.count()
    if n_hot:
        sent = sent.join(checked_broadcast(hot, n_hot), "root", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    else:
        sent = sent.withColumn("parts", F.lit(1))
    sent = sent.withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sent = sent.select("root", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "data")
    sent = sent.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi", "own", "node")

    def run(batches):
        import zstandard
        from xxhash import xxh64_intdigest

        unpack = zstandard.ZstdDecompressor()
        out = []
        for (_, lo, hi), rows in grouped(batches, 3):
            sets: list[dict[int, np.ndarray]] = [{}, {}]
            for part, node, data in rows:
                side = sets[part != lo]
                if node not in side:  # repeated rows are one
                    text = unpack.decompress(data).decode("utf-8", "surrogatepass")
                    side[node] = np.unique(np.array([xxh64_intdigest(s) for s in shingles(text, k)], np.uint64))
            out += spanning(list(sets[0].items()), None if lo == hi else list(sets[1].items()), similarity)
            if len(out) > 10_000:
                yield pairs_batch(out)
                out = []
        yield pairs_batch(out)

    return sent.mapInArrow(tidy(run), "a bigint, b bigint")


#: Bits of a block and closest votes turned over in it, for any number of documents: what such shards miss doesn't hang on the corpus.
SHARD = (20, 3)


def drop_near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, similarity: float = 0.8, bits: int = 256, block: int = SHARD[0], flips: int = SHARD[1], seed: int = 42, tree_nodes: int = 1024, small: int = 48
) -> DataFrame:
    """The rows of ``df`` without near copies: of each group linked at ``similarity`` or more the smallest id stays.

    Similarity is the Jaccard similarity of sets of ``k``-word shingles.  Fingerprints of ``bits`` bits find groups in
    which it may be reached, with a radius three standard deviations beyond what is expected at the threshold; an exact
    check of the sets follows inside each group.  Shards hold ``block`` bits, with the ``flips`` closest votes turned over,
    the same at every size of the corpus.  With 256 bits such shards and the radius miss fewer than one pair in 100 at 0.8
    of sets of over 48 shingles.
    Smaller sets would lose more (9 against 9 shingles
    about 3 %): pairs with a set of up to ``small`` shingles are found by an exact index instead, so none is missed.  Documents of one set of shingles are copies of each other; different sets of one
    fingerprint are a group, in which the exact check takes every set.  Texts without a word, null ones too, are one set.
    A row with a null id always stays.  Of repeated rows one stays.  A text of any length is taken whole.  All columns of
    ``df`` are returned, whatever their names; an empty table gives no rows.
    """
    from corpusloom.llm.common import components, fresh, join_hot, map_texts, materialise

    # Batches are bounded by map_texts, and so are those of the check.
    fields = [T.StructField("_fp", T.BinaryType()), T.StructField("_keys", T.ArrayType(T.LongType())), T.StructField("_set", T.LongType()), T.StructField("_small", T.ArrayType(T.LongType()))]
    most = int(small / similarity + 1e-9)  # the largest set that a small one can be similar to
    base = df.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    prints = map_texts(base, "_id", "_text", lambda: lambda t: long_fingerprint(t, k, bits, seed, block, flips, most), fields)
    prints = materialise(prints)
    # Equal sets are one node, named by the least id; all sets of a fingerprint are in its group, which has the keys of each.
    sets = materialise(prints.filter("_id is not null").groupBy("_fp", "_set").agg(F.min("_id").alias("node"), F.first("_keys").alias("_keys"), F.first("_small").alias("_small")))
    classes = materialise(sets.groupBy("_fp").agg(F.min(F.struct("node", "_set", "_keys")).alias("least"), F.count("*").alias("n")))
    keyed = classes.select(F.col("least.node").alias("node"), F.col("_fp").alias("fp"), F.explode("least._keys").alias("key"))
    several = classes.filter("n > 1")
    n = several.count()
    if n:
        further = sets.join(checked_broadcast(several, n), "_fp").filter(F.col("_set") != F.col("least._set"))
        keyed = keyed.unionByName(further.select(F.col("least.node").alias("node"), F.col("_fp").alias("fp"), F.explode(F.array_except("_keys", "least._keys")).alias("key")).distinct())
    links = link_keyed(keyed, similarity_radius(similarity, bits), bits, tree_nodes)
    if n:
        links = links.unionByName(further.select(F.col("node").alias("a"), F.col("least.node").alias("b")))
    groups = materialise(components(links))
    near = verified(groups, base, k, similarity)
    few = sets.filter("size(_small) > 0")
    if few.limit(2).count() > 1:
        near = near.unionByName(small_links(few, similarity, tree_nodes))
    roots = components(near)
    # Ids that go: of each set all but the least, and sets that are not the least of their group.
    least = sets.select("_fp", "_set", "node").join(roots.filter("node <> root").select("node").withColumn("_late", F.lit(True)), "node", "left")
    of = F.struct("_fp", "_set").alias("_of")  # texts without a word are one set, and may be any share of the rows
    gone = join_hot(prints.filter("_id is not null").select("_id", of), least.select(of, "node", "_late"), "_of").filter("_late or _id <> node")
    out_id = fresh("_gone", df)
    gone = materialise(gone.select(F.col("_id").alias(out_id)).distinct())
    # An id that stays with one text and goes with another is kept apart by no column; it goes.
    out = df.join(checked_broadcast(gone, gone.count()), F.col(id_col).cast("bigint") == F.col(out_id), "left_anti")
    repeated = prints.filter("_id is not null").groupBy("_id").count().filter("count > 1").select(F.col("_id").alias(out_id))
    n = repeated.count()
    if not n:
        return out
    twice = F.col(id_col).cast("bigint") == F.col(out_id)
    once = checked_broadcast(repeated, n)
    return out.join(once, twice, "left_anti").unionByName(out.join(once, twice, "left_semi").dropDuplicates([id_col]))
