"""Ranked lexical search over a clustered index, with exact results.

Recursive graph bisection reorders the documents: the bipartite graph of documents and terms is split in halves, and
documents are swapped between these while that lowers the cost of the terms' gaps.  The upper levels are fitted on a
bounded sample of texts and route every document; the lower ones run in every block of the index, on all its documents.
Blocks are even in size, however many documents fall to one leaf: leaves are dealt to as many blocks as it takes.

A block's documents, in their new order, are cut into shards.  The index has a row for each block and term: places,
impacts, and the best impact in each shard.  A query's bound on a shard sums its terms' best impacts there.  Shards are
visited by falling bound, in rounds, until no bound reaches the score of the last document that would be returned;
shards whose bound equals it are visited, too, for ties go to the smaller document.  Places lead back to documents by a
row of each block.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import broadcast_texts, checked_broadcast, materialise, tidy

#: Letters to lower case and all that is in no term to a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Texts in the sample, terms of each that are looked at (those of least check value), and how long these may be.
SAMPLE, SKETCH, LONGEST = 2048, 64, 64
#: Terms of the sample that route documents, at most.
MODEL_TERMS = 1 << 15
#: Postings and documents of a block, at most on average, and documents of a shard.
POSTINGS, DOCUMENTS, SHARD = 1_000_000, 8192, 256
#: The term of the rows that lead places back to documents; no term is empty.
DOCS = ""


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def bisect(doc: np.ndarray, term: np.ndarray, n_docs: int, n_terms: int, levels: int, rounds: int = 4) -> tuple[np.ndarray, list[np.ndarray]]:
    """Recursive graph bisection of postings: the part of each document, parts in order, and for each level the parts' weights of terms.

    A weight is what a document with the term saves by being in the first half.  In each round the documents of the
    halves of a part are paired by falling gain, and pairs that gain together change places; all parts of a level go in step.
    """
    logs = np.log2(np.maximum(1, np.arange(n_docs + 3)))
    part, weights = np.zeros(n_docs, np.int64), []
    for level in range(levels):
        parts = 1 << level
        size = np.bincount(part, minlength=parts)
        order = np.argsort(part, kind="stable")
        rank = np.empty(n_docs, np.int64)
        rank[order] = np.arange(n_docs) - (np.cumsum(size) - size)[part[order]]
        side = (rank >= (size[part] + 1) // 2).astype(np.int64)
        for turn in range(rounds + 1):
            half = 2 * part + side
            n = np.bincount(half, minlength=2 * parts)
            degree = np.bincount(half[doc] * n_terms + term, minlength=2 * parts * n_terms)
            if turn == rounds:
                break
            here = half[doc]
            a, b = degree[here * n_terms + term], degree[(here ^ 1) * n_terms + term]
            na, nb = logs[n[here]], logs[n[here ^ 1]]
            gain = np.bincount(doc, a * (na - logs[a + 1]) + b * (nb - logs[b + 1]) - (a - 1) * (na - logs[a]) - (b + 1) * (nb - logs[b + 2]), minlength=n_docs)
            by = np.lexsort((-gain, half))
            first = np.cumsum(n) - n
            rank[by] = np.arange(n_docs) - first[half[by]]
            mate = by[np.minimum(first[half ^ 1] + rank, n_docs - 1)]
            swap = (rank < n[half ^ 1]) & (gain + gain[mate] > 1e-9)
            if not swap.any():
                break
            side[swap] ^= 1
        d, n = degree.reshape(parts, 2, n_terms), logs[n].reshape(parts, 2)[..., None]
        more, now = (d + 1) * (n - logs[d + 2]), d * (n - logs[d + 1])
        weights.append(((now[:, 0] + more[:, 1]) - (more[:, 0] + now[:, 1])).astype(np.float32))
        part = 2 * part + side
    return part, weights


class Router:
    """The upper levels, fitted on a sample: the leaf of any document by the weights of its terms."""

    def __init__(self, sample: list[list[bytes]], levels: int) -> None:
        seen = Counter(t for own in sample for t in own)
        often = sorted((t for t, n in seen.items() if n > 1), key=lambda t: (-seen[t], t))[:MODEL_TERMS]
        self.place = {t: i for i, t in enumerate(often)}
        pairs = [(d, self.place[t]) for d, own in enumerate(sample) for t in own if t in self.place]
        self.levels = levels if pairs else 0
        if self.levels:
            doc, term = (np.array(c, np.int64) for c in zip(*pairs, strict=True))
            _, weights = bisect(doc, term, len(sample), len(often), levels, rounds=12)
            self.weights = np.ascontiguousarray(np.concatenate(weights).T)  # a row for each term

    def __call__(self, terms) -> int:
        if not self.levels:
            return 0
        known = [p for p in map(self.place.get, terms) if p is not None]
        gain = self.weights[known].sum(0).tolist()
        node = 0
        for _ in range(self.levels):
            node = 2 * node + (1 if gain[node] >= 0 else 2)
        return node - len(gain)


def sample_terms(docs: DataFrame, n: int) -> list[list[bytes]]:
    """Sketches of up to ``SAMPLE`` different texts, drawn by the hash of the text, so that copies count once."""
    scale = 1 << 20
    share = min(scale, -(-scale * 4 * SAMPLE // max(1, n)))
    h = F.xxhash64("text", F.lit(29))

    def sketch(batches):
        seen = set()
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if key not in seen:
                    seen.add(key)
                    own = sorted({t for t in terms_of(text.as_py()) if len(t) <= LONGEST}, key=lambda t: (zlib.crc32(t), t))[:SKETCH]
                    if own:
                        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([own], pa.list_(pa.binary()))], names=["key", "terms"])

    picked = docs.select(h.alias("key"), "text").filter(F.pmod(F.xxhash64("key"), F.lit(scale)) < share)
    found = picked.mapInArrow(tidy(sketch), "key bigint, terms array<binary>").groupBy("key").agg(F.first("terms").alias("terms"))
    return [[bytes(t) for t in r["terms"]] for r in found.orderBy(F.xxhash64("key", F.lit(3)), "key").limit(SAMPLE).collect()]


def counts_bytes(counts: list[int]) -> bytes:
    return bytes(counts) if max(counts) < 256 else np.array(counts, "<u4").tobytes()


def route(docs: DataFrame, router: Router) -> DataFrame:
    """A row for each document with a term: its leaf, id, number of terms with repeats, different terms and how often each occurs."""

    def run(batches):
        names, types = ["leaf", "id", "n", "postings", "terms", "counts"], [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                own, rows = b.slice(lo, 256), []
                for i, text in zip(own.column(0).to_pylist(), own.column(1).to_pylist(), strict=True):
                    found = Counter(terms_of(text))
                    if found:
                        rows.append((router(found), i, found.total(), len(found), b" ".join(found), counts_bytes(list(found.values()))))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return docs.mapInArrow(tidy(run), "leaf int, id bigint, n bigint, postings bigint, terms binary, counts binary")


INDEX = "block bigint, term string, docs array<bigint>, places array<int>, impacts array<int>, shards array<int>, best array<int>"


def lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), pa.array(values, kind))


def block_index(total: int, words: int, shard: int):
    """The index of a block; ``total``: documents with a term, ``words``: their terms with repeats."""

    def build(table: pa.Table) -> pa.Table:
        ids, n = table.column("id").to_pylist(), np.array(table.column("n").to_pylist(), np.int64)
        first = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, n[i]))  # any order will do, but the same each time
        number: dict[bytes, int] = {}
        term, size, count = [], [], []
        terms, counts = table.column("terms"), table.column("counts")
        for i in first:
            own, raw = terms[i].as_py().split(b" "), counts[i].as_py()
            term += [number.setdefault(t, len(number)) for t in own]
            size.append(len(own))
            count.append(np.frombuffer(raw, np.uint8 if len(raw) == len(own) else "<u4").astype(np.int64))
        term, tf, doc = np.array(term, np.int64), np.concatenate(count), np.repeat(np.arange(len(first)), size)
        n = n[first]
        levels = max(0, -(-len(first) // shard) - 1).bit_length()
        several = np.bincount(term, minlength=len(number)) > 1
        at = several[term]
        part, _ = bisect(doc[at], (np.cumsum(several) - 1)[term[at]], len(first), int(several.sum()), levels) if levels and at.any() else (np.zeros(len(first), np.int64), None)
        # The new order; shards are the parts.
        order = np.argsort(part, kind="stable")
        place = np.empty(len(first), np.int64)
        place[order] = np.arange(len(first))
        m = 10 + 90 * n * total // words
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
        by = np.lexsort((place[doc], term))
        term, doc, impact = term[by], doc[by], impact[by]
        starts = np.searchsorted(term, np.arange(len(number)))
        own = part[doc]
        new = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (own[1:] != own[:-1]))))
        of_term = np.searchsorted(term[new], np.arange(len(number)))
        found = pa.table({
            "block": pa.array(np.full(len(number), table.column("block")[0].as_py()), pa.int64()), "term": pa.array([t.decode() for t in number], pa.string()), "docs": pa.nulls(len(number), pa.list_(pa.int64())),
            "places": lists(place[doc], starts, pa.int32()), "impacts": lists(impact, starts, pa.int32()), "shards": lists(own[new], of_term, pa.int32()), "best": lists(np.maximum.reduceat(impact, new), of_term, pa.int32()),
        })
        none = pa.nulls(1, pa.list_(pa.int32()))
        # Places lead back to documents, and to the shards they are in.
        back = pa.table({
            "block": table.column("block").slice(0, 1).combine_chunks(), "term": pa.array([DOCS]), "docs": pa.array([[ids[first[i]] for i in order]], pa.list_(pa.int64())), "places": none, "impacts": none,
            "shards": pa.array([part[order].tolist()], pa.list_(pa.int32())), "best": none,
        })
        return pa.concat_tables([found, back])

    return build


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", leaves: int = 64, shard: int = SHARD) -> DataFrame:
    """The index of all documents, a row for each block and term; see the module for what is in it.

    Terms are the longest runs of digits, letters and characters beyond ASCII, with A-Z lower-cased.  ``leaves`` (a power
    of two) and ``shard`` change the cost, not results.  A text of any length is taken whole; a null text or one without a
    term is in no row.  Rows that repeat an id are documents of their own; a null id is one, too.  An empty table gives an
    empty index; other columns are ignored, whatever their names.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    router = Router(sample_terms(docs, docs.count()), max(0, leaves.bit_length() - 1))
    routed = materialise(route(docs, router))
    by_leaf = routed.groupBy("leaf").agg(F.count("*").alias("docs"), F.sum("n").alias("words"), F.sum("postings").alias("postings")).collect()  # at most leaves rows
    total, words, postings = (sum(r[c] for r in by_leaf) for c in ("docs", "words", "postings"))
    # No block is larger than the mean leaf would be: a leaf that has a third of all documents is a third of all blocks.
    most_docs, most_postings = max(1, min(DOCUMENTS, total // leaves)), max(1, min(POSTINGS, postings // leaves))
    blocks = [1] * max(1, leaves)
    for r in by_leaf:
        blocks[r["leaf"]] = max(-(-r["docs"] // most_docs), -(-r["postings"] // most_postings))
    first = np.cumsum([0, *blocks[:-1]]).tolist()
    at = F.col("leaf") + 1
    # The number of the row, too: rows that are all alike are dealt like any others.  They are written, so it stays.
    deal = F.pmod(F.xxhash64("id", "n", F.monotonically_increasing_id()), F.element_at(F.array(*map(F.lit, blocks)), at).cast("bigint"))
    dealt = routed.withColumn("block", F.element_at(F.array(*map(F.lit, first)), at).cast("bigint") + deal).drop("leaf", "postings")
    return dealt.groupBy("block").applyInArrow(block_index(total, words, shard), INDEX)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                own = b.slice(lo, 256)
                found = [[t.decode() for t in sorted(set(terms_of(x)))] for x in own.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array(found, pa.list_(pa.string()))], names=["item", "terms"])

    named = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("item"), F.col(text_col).cast("string"))
    return named.mapInArrow(tidy(run), "item bigint, terms array<string>").select("item", F.explode("terms").alias("term")).distinct()


SCORED = "item bigint, doc bigint, score bigint"


def score_block(k: int):
    """Documents of visited shards of a block, for each item at most ``k``: those of highest score, smaller ids first among equals."""

    def score(hits: pd.DataFrame, work: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(work):
            rows = {t: (np.asarray(p), np.asarray(i, np.int64)) for t, p, i in zip(hits["term"], hits["places"], hits["impacts"], strict=True) if t != DOCS}
            docs, shards = next((pd.Series(list(d), dtype="Int64"), np.asarray(s)) for t, d, s in zip(hits["term"], hits["docs"], hits["shards"], strict=True) if t == DOCS)
            known, ids = docs.notna().to_numpy(), docs.fillna(0).to_numpy(np.int64)
            for item, terms, weights, visited, least in zip(work["item"], work["terms"], work["weights"], work["visited"], work["least"], strict=True):
                total = np.zeros(len(ids), np.int64)
                for t, w in zip(terms, weights, strict=True):
                    if t in rows:
                        place, impact = rows[t]
                        total[place] += w * impact  # a place stands once among those of a term
                at = np.flatnonzero((total >= least) & np.isin(shards, visited))
                at = at[np.lexsort((ids[at], ~known[at], -total[at]))[:k]]
                out += [(item, int(ids[i]) if known[i] else None, int(total[i])) for i in at]
        found = pd.DataFrame(out, columns=["item", "doc", "score"])
        return found.astype({"item": "int64", "doc": "Int64", "score": "int64"})

    return score


def search(index: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text", first: int = 16, factor: int = 16) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: its id, ``rank`` (from 1), ``doc_id``, ``score``.

    Equal scores go by ascending document, null last.  ``first`` shards are visited in the first round, ``factor``
    times as many up to the end of the next; this changes the cost, not the result.  A null text, or one without a term of the index, finds
    nothing.  Items that share an id are one item with the terms of all; items with a null id are left out.
    """
    spark = index.sparkSession
    asked = materialise(item_terms(items, id_col, text_col))
    wanted = materialise(asked.select("term").unionByName(spark.range(1).select(F.lit(DOCS).alias("term"))).distinct())
    hits = materialise(index.join(broadcast_texts(wanted, "term"), "term", "left_semi"))
    n = hits.filter(F.col("term") == DOCS).agg(F.coalesce(F.sum(F.size("docs")), F.lit(0))).first()[0]
    found = hits.filter(F.col("term") != DOCS)
    df = found.groupBy("term").agg(F.sum(F.size("places")).alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = materialise(asked.join(df, "term").select("item", "term", weight.alias("w")))
    shards = found.select("block", "term", F.explode(F.arrays_zip("shards", "best")).alias("s")).select("block", "term", "s.shards", "s.best")
    bounds = shards.join(broadcast_texts(weighted, "term"), "term").groupBy("item", "block", "shards").agg(F.sum(F.col("w") * F.col("best")).alias("bound")).filter("bound > 0")
    by_bound = Window.partitionBy("item").orderBy(F.col("bound").desc(), "block", "shards")
    bounds = materialise(bounds.withColumn("place", F.row_number().over(by_bound)))
    terms = materialise(weighted.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("tw")).select("item", F.col("tw.term").alias("terms"), F.col("tw.w").alias("weights")))
    n_items = terms.count()
    by_score = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    best = spark.createDataFrame([], SCORED).withColumn("rank", F.lit(1))
    done, upto = 0, first
    while True:
        least = best.filter(F.col("rank") == k).select("item", F.col("score").alias("least"))
        here = bounds.filter((F.col("place") > done) & (F.col("place") <= upto)).join(checked_broadcast(least, n_items), "item", "left")
        # Bounds fall: an item with no shard to visit in a round has none to visit later.
        visits = materialise(here.filter("bound >= coalesce(least, 1)").groupBy("block", "item").agg(F.collect_list("shards").alias("visited"), F.first(F.coalesce("least", F.lit(1))).alias("least")))
        if visits.isEmpty():
            break
        work = visits.join(terms, "item").withColumnRenamed("block", "of")
        scored = hits.groupBy("block").cogroup(work.groupBy("of")).applyInPandas(score_block(k), SCORED)
        best = materialise(best.drop("rank").unionByName(scored).withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k))
        done, upto = upto, upto * factor
    return best.select(F.col("item").alias(id_col), F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score")
