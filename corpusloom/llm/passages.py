"""Repeated passages over a corpus: the rounds that substring dedup and suffix-array dedup share.

0. Runs of tokens that many texts of a sample share are ranked last as anchors.
1. Every task cuts its texts into stretches (see :mod:`windows`) and sends their hashes to buckets by anchor.  Equal
   stretches of a task's gather travel as one, with a list of the others: the operator's method decides on it in the task,
   as a combiner does.
2. A bucket names the candidates: stretches that stand more than once and stretches whose anchor also stands in others.
   For each different one it asks the text of its least owner for the tokens, and notes the other owners.
3. Blocks of texts answer; a text nobody asks for stays where it lies.
4. The bucket runs the operator's method on the tokens, each different stretch once, counted as often as it has owners.
   A window is removed only where the method says that it repeats.
5. Texts with marks lose the marked tokens.

Hashes of tokens only find candidates.  Equal stretches are told by 56 bits of BLAKE2b of their bytes, under a salt drawn
anew for every run and told to no one, beside their anchor: nobody can write a text that collides.  What repeats is decided in ``resolve``
(rounds 1 and 4), on the bytes, and nowhere else.

What is sent travels as packed arrays.  A row holds what one gather of a task has for one bucket or block, at least one
stretch or mark: there are never more rows than stretches and marks, so rows grow with the corpus alone.  Rows of a few
stretches are not compressed.  Buckets and blocks are numbers modulo ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

import itertools
import secrets
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import BROADCAST_ROWS, materialise, tidy
from corpusloom.llm import windows as W

#: Stretches a task gathers before it sends them; bounds its memory.
GATHER = 300_000
#: Bytes of text or tokens a task gathers before it sends them.
GATHER_BYTES = 12_000_000
#: Kinds of rows, in the order in which a bucket or block reads them.
COVERED, OWNERS, REQUEST, CONTENT, TEXT = range(5)


@dataclass(frozen=True)
class Plan:
    window: int
    k: int
    #: Tokens of a text as hashes.
    tokens: Callable[[bytes], np.ndarray]
    #: The bytes that the method is run on.
    content: Callable[[bytes], np.ndarray]
    #: Where the tokens of some content begin, and its end; None if every byte is a token.
    edges: Callable[[np.ndarray], np.ndarray] | None
    #: Whether a window that starts earlier in the same text counts.
    same_text: bool
    #: The method: (rank, least documents, first starts, lengths in tokens, owners, content of all records) to two masks
    #: of windows, one for each token: those that stand more than once, and those that also start earlier than the least owner's.
    resolve: Callable[[W.Rank, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    rank: W.Rank = W.Rank(np.zeros(0, np.uint64))
    #: Of the hashes that tell equal stretches.
    key: bytes = b""

    def spans(self, content: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and lengths in bytes of spans of tokens."""
        if self.edges is None:
            return start, length
        edges = self.edges(content)
        return edges[start], edges[start + length] - edges[start]

    def cut(self, content: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The bytes of spans of tokens, one span after the other."""
        return content[W.ranges(*self.spans(content, start, length))]

    def count(self, content: np.ndarray) -> int:
        return len(content) if self.edges is None else len(self.edges(content)) - 1

    def digests(self, content: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Of spans of tokens, by their bytes."""
        raw, (at, size) = content.tobytes(), self.spans(content, start, length)
        return np.frombuffer(b"".join([blake2b(raw[a : a + n], digest_size=8, salt=self.key).digest() for a, n in zip(at.tolist(), size.tolist(), strict=True)]), np.uint64)


KINDS = ("u1", "u2", "u4", "u8", "i8")
#: Arrays of fewer bytes are not worth a compressor's frame.
PLAIN = 512


def squeeze(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as bytes: the bytes of equal rank together, so that high bytes that are zero shrink to nothing."""
    import zstandard

    arrays = [np.ascontiguousarray(a) for a in arrays]
    head = struct.pack("<B", len(arrays)) + b"".join([struct.pack("<BI", KINDS.index(a.dtype.str[1:]), len(a)) for a in arrays])
    body = b"".join([a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if a.itemsize > 1 else a.tobytes() for a in arrays])
    return b"\0" + head + body if len(body) < PLAIN else b"\1" + head + zstandard.ZstdCompressor(level=level).compress(body)


def unsqueeze(data: bytes) -> list[np.ndarray]:
    import zstandard

    n = data[1]
    heads = [struct.unpack_from("<BI", data, 2 + 5 * i) for i in range(n)]
    body = data[2 + 5 * n :]
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(body) if data[0] else body, np.uint8)
    out, at = [], 0
    for kind, size in heads:
        dtype = np.dtype(KINDS[kind])
        end = at + size * dtype.itemsize
        part = body[at:end]
        out.append(np.ascontiguousarray(part.reshape(dtype.itemsize, size).T).reshape(-1).view(dtype) if dtype.itemsize > 1 and size else part.view(dtype))
        at = end
    return out


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    return (W.mix(ids.astype(np.uint64) + np.uint64(1)) % np.uint64(blocks)).astype(np.int64)


def table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids as differences, and the place of each id among them."""
    distinct, place = np.unique(ids, return_inverse=True)
    return np.diff(distinct, prepend=0), place.astype(np.uint32)


def untable(ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.cumsum(ids)[place] if len(place) else np.zeros(0, np.int64)


def rows(part: list[int], kind: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(data, pa.binary())], names=["part", "kind", "data"])


ROW = "part int, kind int, data binary"


def dealt(groups: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The rows of each group, groups in order, rows as they stood."""
    order = np.argsort(groups, kind="stable")
    groups, arrays = groups[order], [a[order] for a in arrays]
    cuts = np.flatnonzero(np.diff(groups)) + 1
    for lo, hi in itertools.pairwise([0, *cuts.tolist(), len(groups)]):
        if hi > lo:
            yield int(groups[lo]), [a[lo:hi] for a in arrays]


def texts_of(batches) -> Iterator[tuple[int | None, bytes | None]]:
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part = b.slice(lo, 256)
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                yield i, None if t is None else t.encode("utf-8", "surrogatepass")


def by_part(batches) -> Iterator[tuple[int, Iterator[tuple[int, bytes]]]]:
    """Rows sorted by part: each part and its kinds and data, read as they come."""
    stream = ((p, k, d) for b in batches for p, k, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True))
    for part, own in itertools.groupby(stream, key=lambda x: x[0]):
        yield part, ((k, d.as_py()) for _, k, d in own)


def owned_spans(window: int, record: np.ndarray, first: np.ndarray, last: np.ndarray, owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of tokens of each owner, ``owner``: its record, ``start``: where it stands; ``record`` rises.  Returns the owner's number, start and end."""
    lo, hi = np.searchsorted(record, owner, "left"), np.searchsorted(record, owner, "right")
    at = W.ranges(lo, hi - lo)
    who = np.repeat(np.arange(len(owner)), hi - lo)
    return who, start[who] + first[at], start[who] + last[at] + window


def send_stretches(plan: Plan, buckets: int):
    """Round 1.  A row for each bucket: heads (anchor, stretch, document, first, windows), repeats of a head in its own text, covered spans."""

    def flush(docs: list[int], found: list[tuple]) -> pa.RecordBatch:
        order = sorted(range(len(docs)), key=docs.__getitem__)
        found = [found[i] for i in order]
        h = np.concatenate([x[0] for x in found])
        s = np.concatenate([x[1] for x in found]) >> np.uint64(8)
        first = np.concatenate([x[2] for x in found])
        n = np.concatenate([x[3] for x in found])
        sizes = [len(x[0]) for x in found]
        doc = np.repeat(np.array([docs[i] for i in order], np.int64), sizes)
        begin = np.repeat(np.cumsum([0] + [x[5] for x in found[:-1]]), sizes)  # where the text of each stretch begins in all tokens
        by = np.argsort(s, kind="stable")  # rows stand by document and place, and so they do among equals
        h, s, first, n, doc, begin = h[by], s[by], first[by], n[by], doc[by], begin[by]
        head = np.concatenate(([True], (s[1:] != s[:-1]) | (h[1:] != h[:-1])))
        at = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
        other = ~head & ((doc != doc[at]) | (first != first[at]))  # what is left are repeated rows
        late = other & ((doc != doc[at]) | plan.same_text)
        twin = other & ~late
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        none = np.zeros(0, np.int64)
        # The method decides on stretches that stand more than once here, each different one once.
        via: dict[int, tuple] = {}
        if late.any():
            own, weight = np.unique(at[late], return_counts=True)
            length = n[own] - 1 + plan.window
            everything = np.concatenate([x[4] for x in found])
            repeats, _ = plan.resolve(plan.rank, doc[own], first[own], length, weight + 1, plan.cut(everything, begin[own] + first[own], length))
            mine = np.flatnonzero(late)
            who, f, e = owned_spans(plan.window, *W.mask_spans(repeats, length), np.searchsorted(own, at[late]), first[mine])
            # Covered spans can pass through any bucket; whose they are spreads them evenly.
            for doc_, (f, e) in dealt(doc[mine][who], f, e):
                f, e = W.merge_spans(f, e)
                via.setdefault(doc_ % buckets, []).append((np.full(len(f), doc_), f, e))
        key = np.flatnonzero(head)
        key = key[np.lexsort((h[key], bucket[key]))]
        where = np.zeros(len(head), np.int64)  # the place of a head among those of its bucket
        starts = np.flatnonzero(np.concatenate(([True], np.diff(bucket[key]) != 0)))
        where[key] = np.arange(len(key)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(key)]))))
        twins = dict(dealt(bucket[twin], where[at[twin]], first[twin])) if twin.any() else {}
        heads = dict(dealt(bucket[key], h[key], s[key], doc[key], first[key], n[key]))
        out: dict[int, bytes] = {}
        for b in sorted({*heads, *via}):
            hh, ss, dd, ff, nn = heads.get(b, (np.zeros(0, np.uint64), np.zeros(0, np.uint64), none, none, none))
            tt, tf = twins.get(b, (none, none))
            cd, cf, ce = (np.concatenate(x) for x in zip(*via[b], strict=True)) if b in via else (none, none, none)
            out[b] = squeeze(
                np.diff(hh >> np.uint64(24), prepend=np.uint64(0)), ss, *table(dd), ff.astype(np.uint32), nn.astype(np.uint16),
                tt.astype(np.uint32), tf.astype(np.uint32), *table(cd), cf.astype(np.uint32), ce.astype(np.uint32),
            )
        return rows(list(out), [COVERED] * len(out), list(out.values()))

    def run(batches):
        docs, found, n, size = [], [], 0, 0
        for i, text in texts_of(batches):
            if i is None or not text:
                continue
            tokens = plan.tokens(text)
            if len(tokens) < plan.window:
                continue
            runs = W.Spans(tokens, 3).runs(plan.k)
            anchor, first, last = W.stretches(plan.rank(runs), plan.window, plan.k)
            docs.append(i)
            content = plan.content(text)
            found.append((runs[anchor], plan.digests(content, first, last - first + plan.window), first, last - first + 1, content, len(tokens)))
            n += len(anchor)
            size += content.nbytes
            if n >= GATHER or size >= 2 * GATHER_BYTES:
                yield flush(docs, found)
                docs, found, n, size = [], [], 0, 0
        if docs:
            yield flush(docs, found)

    return run


def to_blocks(kind: int, blocks: int, doc: np.ndarray, first: np.ndarray, end: np.ndarray, *more: np.ndarray, head: tuple = ()) -> Iterator[tuple[int, int, bytes]]:
    """Spans of documents, with more columns, as rows for their blocks."""
    if len(doc):
        for block, (d, f, e, *x) in dealt(block_of(doc, blocks), doc, first, end, *more):
            yield block, kind, squeeze(*table(d), f.astype(np.uint32), (e - f).astype(np.uint32), *(c.astype(np.uint32) for c in x), *head)


def read_spans(data: bytes) -> tuple[np.ndarray, ...]:
    ids, place, first, length, *more = unsqueeze(data)
    return untable(ids, place), first.astype(np.int64), first.astype(np.int64) + length, *more


def find_candidates(plan: Plan, blocks: int):
    """Round 2, for each bucket: requests for the tokens of each different candidate, its other owners, and the covered spans that pass through."""

    def run(batches):
        for bucket, own in by_part(batches):
            cols: list[list[np.ndarray]] = [[] for _ in range(5)]
            twin_cols: list[list[np.ndarray]] = [[], []]
            out = []
            low = 0
            for _, data in own:
                h, s, ids, place, first, n, tt, tf, cids, cplace, cf, ce = unsqueeze(data)
                for c, v in zip(cols, (np.cumsum(h, dtype=np.uint64), s, untable(ids, place), first.astype(np.int64), n.astype(np.int64)), strict=True):
                    c.append(v)
                for c, v in zip(twin_cols, (tt.astype(np.int64) + low, tf.astype(np.int64)), strict=True):
                    c.append(v)
                low += len(h)
                out += to_blocks(COVERED, blocks, untable(cids, cplace), cf.astype(np.int64), ce.astype(np.int64))
            h, s, doc, first, n = map(np.concatenate, cols)
            tt, tf = map(np.concatenate, twin_cols)
            if len(h):
                by = np.argsort(s, kind="stable")
                new = np.flatnonzero(np.concatenate(([True], (s[by][1:] != s[by][:-1]) | (h[by][1:] != h[by][:-1]))))
                size = np.diff(np.concatenate((new, [len(h)])))
                _, inverse, count = np.unique(h[by][new], return_inverse=True, return_counts=True)
                wanted = (size > 1) | (count[inverse] > 1)
                group = np.full(len(h), -1)
                group[by] = np.repeat(np.where(wanted, np.cumsum(wanted) - 1, -1), size)
                at = np.flatnonzero(group >= 0)
                at = at[np.lexsort((first[at], doc[at], group[at]))]
                lead = np.concatenate(([True], np.diff(group[at]) != 0)) if len(at) else np.zeros(0, bool)
                least, others = at[lead], at[~lead]
                if len(least):
                    out += to_blocks(REQUEST, blocks, doc[least], first[least], first[least] + n[least] - 1 + plan.window, np.arange(len(least)), head=(np.array([bucket]),))
                t = group[tt] >= 0
                idx = np.concatenate((group[others], group[tt[t]]))
                if len(idx):
                    d, f = np.concatenate((doc[others], doc[tt[t]])), np.concatenate((first[others], tf[t]))
                    order = np.argsort(idx, kind="stable")
                    out.append((bucket, OWNERS, squeeze(np.diff(idx[order], prepend=0).astype(np.uint32), *table(d[order]), f[order].astype(np.uint32))))
            if out:
                yield rows(*map(list, zip(*out, strict=True)))

    return run


def send_texts(blocks: int):
    """Texts as they are, many to a row, by block.  Null ids go to block 0, after the others, without a place in any window."""

    def flush(ids, texts):
        known = np.array([0 if i is None else i for i in ids], np.int64)
        block = np.where([i is None for i in ids], 0, block_of(known, blocks))
        out = []
        for b, (at,) in dealt(block, np.arange(len(ids))):
            own = [texts[i] for i in at.tolist()]
            flags = np.array([(ids[i] is None) + 2 * (texts[i] is None) for i in at.tolist()], np.uint8)
            data = np.frombuffer(b"".join(t or b"" for t in own), np.uint8)
            out.append((b, TEXT, squeeze(known[at], flags, np.array([len(t or b"") for t in own], np.int64), data, level=3)))
        return rows(*map(list, zip(*out, strict=True)))

    def run(batches):
        ids, texts, n = [], [], 0
        for i, t in texts_of(batches):
            ids.append(i)
            texts.append(t)
            n += len(t or b"") + 64
            if n >= GATHER_BYTES:
                yield flush(ids, texts)
                ids, texts, n = [], [], 0
        if ids:
            yield flush(ids, texts)

    return run


def read_texts(data: bytes) -> Iterator[tuple[int | None, bytes | None]]:
    ids, flags, lengths, body = unsqueeze(data)
    body, at = body.tobytes(), 0
    for i, f, n in zip(ids.tolist(), flags.tolist(), lengths.tolist(), strict=True):
        yield (None if f & 1 else i), (None if f & 2 else body[at : at + n])
        at += n


def sorted_spans(own: list[tuple]) -> tuple[np.ndarray, ...]:
    cols = [np.concatenate(c) for c in zip(*own, strict=True)]
    by = np.argsort(cols[0], kind="stable")
    return tuple(c[by] for c in cols)


def answer_requests(plan: Plan):
    """Round 3, for each block: the tokens that buckets ask for."""

    def flush(found: list[tuple]) -> pa.RecordBatch:
        bucket, idx, doc, first, length, content = (np.concatenate(c) for c in zip(*found, strict=True))
        begin = np.cumsum(length) - length
        out = []
        for b, (at,) in dealt(bucket, np.arange(len(bucket))):
            at = at[np.argsort(idx[at], kind="stable")]
            out.append((b, CONTENT, squeeze(
                np.diff(idx[at], prepend=0), *table(doc[at]), first[at].astype(np.uint32), length[at].astype(np.uint32), plan.cut(content, begin[at], length[at]), level=4,
            )))
        return rows(*map(list, zip(*out, strict=True)))

    def run(batches):
        gathered, size = [], 0
        for _, own in by_part(batches):
            asked, cols = [], None
            for kind, data in own:
                if kind == REQUEST:
                    doc, first, end, idx, bucket = read_spans(data)
                    asked.append((doc, first, end, idx.astype(np.int64), np.full(len(doc), bucket[0])))
                    continue
                if not asked:
                    continue
                cols = cols or sorted_spans(asked)
                for i, text in read_texts(data):
                    if i is None or not text:
                        continue
                    lo, hi = np.searchsorted(cols[0], [i, i + 1])
                    if lo == hi:
                        continue
                    content = plan.content(text)
                    first, end, idx, bucket = (c[lo:hi] for c in cols[1:])
                    there = end <= plan.count(content)
                    if not there.all():  # asked of another text of the same id
                        first, end, idx, bucket = (c[there] for c in (first, end, idx, bucket))
                    gathered.append((bucket, idx, np.full(len(idx), i), first, end - first, plan.cut(content, first, end - first)))
                    size += gathered[-1][-1].nbytes + 40 * len(idx)
                    if size >= GATHER_BYTES:
                        yield flush(gathered)
                        gathered, size = [], 0
        if gathered:
            yield flush(gathered)

    return run


def decide(plan: Plan, blocks: int):
    """Round 4, for each bucket: the method on its records, and the spans of every owner that it says are repeated."""

    def run(batches):
        none = np.zeros(0, np.int64)
        for _, own in by_part(batches):
            owner, owner_doc, owner_start, records = none, none, none, []
            for kind, data in own:
                if kind == OWNERS:
                    idx, ids, place, first = unsqueeze(data)
                    owner, owner_doc, owner_start = np.cumsum(idx, dtype=np.int64), untable(ids, place), first.astype(np.int64)
                else:
                    idx, ids, place, first, length, content = unsqueeze(data)
                    records.append((np.cumsum(idx, dtype=np.int64), untable(ids, place), first.astype(np.int64), length.astype(np.int64), content))
            idx, doc, first, length, content = (np.concatenate(c) for c in zip(*records, strict=True))
            records.clear()
            order = np.argsort(idx, kind="stable")
            order = order[np.concatenate(([True], np.diff(idx[order]) != 0))]  # repeated rows answer twice
            begin = np.cumsum(length) - length
            idx, doc, first, length, content = idx[order], doc[order], first[order], length[order], plan.cut(content, begin[order], length[order])
            known = np.isin(owner, idx)
            owner, owner_doc, owner_start = np.searchsorted(idx, owner[known]), owner_doc[known], owner_start[known]
            weight = 1 + np.bincount(owner, minlength=len(idx))
            repeats, late = plan.resolve(plan.rank, doc, first, length, weight, content)
            del content
            # The least owner, and its twins in the same text, lose what starts earlier elsewhere; other owners what repeats.
            twin = (owner_doc == doc[owner]) & (not plan.same_text)
            own_late, own_all = W.mask_spans(late, length), W.mask_spans(repeats, length)
            found = []
            for spans, who, docs, start in ((own_late, np.arange(len(idx)), doc, first), (own_late, owner[twin], owner_doc[twin], owner_start[twin]), (own_all, owner[~twin], owner_doc[~twin], owner_start[~twin])):
                at, f, e = owned_spans(plan.window, *spans, who, start)
                found.append((docs[at], f, e))
            out = list(to_blocks(COVERED, blocks, *(np.concatenate(c) for c in zip(*found, strict=True))))
            if out:
                yield rows(*map(list, zip(*out, strict=True)))

    return run


def apply_marks(id_col: str, kind: pa.DataType, cut: Callable[[bytes, np.ndarray, np.ndarray], tuple], types: list[tuple[str, pa.DataType]]):
    """Round 5: ``cut(text, starts, ends)`` for each text and its disjoint covered spans, in tokens."""

    def run(batches):
        none = np.zeros(0, np.int64)
        for _, own in by_part(batches):
            found, cols = [], None
            for mark, data in own:
                if mark == COVERED:
                    found.append(read_spans(data)[:3])
                    continue
                if found and cols is None:
                    cols = sorted_spans(found)
                ids, out = [], []
                for i, text in read_texts(data):
                    f, e = none, none
                    if cols is not None and i is not None:
                        lo, hi = np.searchsorted(cols[0], [i, i + 1])
                        f, e = W.merge_spans(cols[1][lo:hi], cols[2][lo:hi])
                    ids.append(i)
                    out.append(cut(text or b"", f, e))
                yield cut_batch(id_col, kind, types, pa.array(ids, kind), out)

    return run


def cut_batch(id_col: str, kind: pa.DataType, types: list[tuple[str, pa.DataType]], ids: pa.Array, out: list[tuple]) -> pa.RecordBatch:
    cols = zip(*out, strict=True) if out else [()] * len(types)
    return pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, (_, t) in zip(cols, types, strict=True))], names=[id_col, *(n for n, _ in types)])


def leave_whole(id_col: str, kind: pa.DataType, cut: Callable[[bytes, np.ndarray, np.ndarray], tuple], types: list[tuple[str, pa.DataType]]):
    """Texts without marks, where they lie."""

    def run(batches):
        none = np.zeros(0, np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                out = [cut((t or "").encode("utf-8", "surrogatepass"), none, none) for t in part.column(1).to_pylist()]
                yield cut_batch(id_col, kind, types, part.column(0).cast(kind), out)

    return run


#: Texts sampled for runs that many texts share, the share of them that makes a run common, and how many are kept.
SAMPLE, COMMON, COMMON_RUNS = 1500, 0.01, 1 << 16


def common_runs(base: DataFrame, plan: Plan) -> W.Rank:
    """Ranks by the runs that stand in many of about ``SAMPLE`` texts, counted where the texts lie; any ranks give the same result in the end."""
    scale, n = 1 << 20, max(1, base.count())
    share = min(scale, -(-scale * SAMPLE // n))

    def runs(batches):
        for _, text in texts_of(batches):
            tokens = plan.tokens(text or b"")
            own = np.unique(W.runs_of(tokens, plan.k, 3)) if len(tokens) >= plan.window else np.zeros(0, np.uint64)
            for lo in range(0, len(own), 1 << 16):
                part = own[lo : lo + (1 << 16)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(part)], names=["run"])

    picked = base.filter(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(scale)) < share).select("id", "text")
    often = picked.mapInArrow(tidy(runs), "run bigint").groupBy("run").count().filter(F.col("count") >= max(8, int(COMMON * min(n, SAMPLE))))
    found = often.orderBy(F.col("count").desc(), "run").limit(COMMON_RUNS).collect()
    return W.Rank(np.array([r["run"] for r in found], np.int64).view(np.uint64)) if found else plan.rank


def ids_in(spans: DataFrame, kind: int) -> DataFrame:
    """The documents that rows of spans name."""

    def run(batches):
        for b in batches:
            for data in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(np.cumsum(unsqueeze(data.as_py())[0]))], names=["marked"])

    return spans.filter(F.col("kind") == kind).select("data").mapInArrow(tidy(run), "marked bigint").distinct()


def remove_repeats(df: DataFrame, plan: Plan, cut, types: list[tuple[str, pa.DataType]], ddl: str, id_col: str, text_col: str) -> DataFrame:
    """The rounds; a row for each row of ``df``: its id and what ``cut`` returns."""
    out, _, whole = cut_repeats(df, plan, cut, types, ddl, id_col, text_col)
    if whole is None:
        return out
    return out.unionByName(whole.mapInArrow(tidy(leave_whole(id_col, pa.int64(), cut, types)), f"`{id_col}` bigint, {ddl}"))


def cut_repeats(df: DataFrame, plan: Plan, cut, types: list[tuple[str, pa.DataType]], ddl: str, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """What ``cut`` returns for texts with marks, the ids of these (``marked``), and ``id, text`` of the others; None for both if the ids are too many to be broadcast, and then all texts are cut."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Several buckets a partition lessen what is in memory at once.  Blocks are read as they come and can be larger.
    buckets, blocks = 4 * parts, -(-parts // 2)
    base = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    plan = replace(plan, rank=common_runs(base, plan), key=secrets.token_bytes(16))

    def deal(x: DataFrame) -> DataFrame:
        return x.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind")

    first = materialise(deal(base.mapInArrow(tidy(send_stretches(plan, buckets)), ROW)).mapInArrow(tidy(find_candidates(plan, blocks)), ROW))
    # Texts nobody asks for and texts without marks need not travel, if the list of the others is short enough to be broadcast.
    def parted(ids: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
        ids = materialise(ids)
        if ids.count() > BROADCAST_ROWS:
            return base, None, None
        named = lambda how: base.join(F.broadcast(ids), F.col("id") == F.col("marked"), how)
        return named("left_semi"), ids, named("left_anti")

    texts = lambda x: x.mapInArrow(tidy(send_texts(blocks)), ROW)
    asked, _, _ = parted(ids_in(first, REQUEST))
    answers = deal(first.filter(F.col("kind") == REQUEST).unionByName(texts(asked))).mapInArrow(tidy(answer_requests(plan)), ROW)
    second = materialise(deal(first.filter(F.col("kind") == OWNERS).unionByName(answers)).mapInArrow(tidy(decide(plan, blocks)), ROW))
    marks = first.filter(F.col("kind") == COVERED).unionByName(second)
    marked, ids, whole = parted(ids_in(marks, COVERED))
    schema = f"`{id_col}` bigint, {ddl}"
    out = deal(marks.unionByName(texts(marked))).mapInArrow(tidy(apply_marks(id_col, pa.int64(), cut, types)), schema)
    return out, ids, whole
