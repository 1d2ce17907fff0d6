"""Suffix-array dedup: bytes that repeat from documents of smaller id go; suffixes are ordered by deep-shallow sorting.

Suffixes are first put in buckets, by the anchor of their window and its offset.  A multikey quicksort, eight bytes to
a character and all buckets at once, orders them to a shallow depth of 24 bytes.  Every group that still shares a prefix
is ordered by a blind trie, whatever its size.  A node of a blind trie holds only the first bit in which its strings
differ, never the strings; what they share is skipped.  The tries of all groups are built in step, from the roots down:
each string is compared once with the first of its node, the least bit that differs is the node's, and its two sides
are the next nodes.  Leaves from left to right are the order, and a leaf holds equal strings.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh
from corpusloom.llm import windows as W
from corpusloom.llm.passages import Plan, cut_repeats, remove_repeats


def word_at(data: np.ndarray) -> np.ndarray:
    """For every place the eight bytes from there as a number, zeros behind the end; numbers compare as strings do."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    rows = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    return np.ascontiguousarray(rows).view(">u8").ravel().astype(np.uint64)


def big_words(at_place: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """The ``window`` bytes from each place as words of eight bytes, zeros behind them; ``at_place``: of :func:`word_at`."""
    n = -(-window // 8)
    out = at_place[np.minimum(at[:, None] + 8 * np.arange(n), len(at_place) - 1)]
    if spare := 8 * n - window:
        out[:, -1] &= np.uint64((1 << 64) - (1 << 8 * spare))
    return out


def boundaries(group: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, np.int64)


def multikey_quicksort(key: np.ndarray, order: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order each group by ``key``: ternary partition around a pivot, in all groups at once.

    ``order``: items, by group; ``group``: a number for each of them that rises along the order.  Returns the order and
    groups of equal keys, numbered along the order.
    """
    order, group = order.copy(), group.copy()
    n = len(order)
    final = np.zeros(n, bool)  # a group starts here
    final[boundaries(group)] = True
    todo = np.arange(n)
    if len(todo):
        begin = boundaries(group[todo])
        size = np.diff(np.concatenate((begin, [len(todo)])))
        todo = todo[np.repeat(size > 1, size)]
    while len(todo):
        items = order[todo]
        begin = boundaries(group[todo])
        size = np.diff(np.concatenate((begin, [len(todo)])))
        k = key[items]
        a, b, c = k[begin], k[begin + size // 2], k[begin + size - 1]
        pivot = np.repeat(np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c)), size)  # the median of three
        below, above = k < pivot, k > pivot
        # Each part keeps its order: items go to the start of their part, and on by those of the part before them.
        nb, na = np.add.reduceat(below.astype(np.int64), begin), np.add.reduceat(above.astype(np.int64), begin)
        seen_b, seen_a = np.cumsum(below), np.cumsum(above)
        seen_e = np.arange(1, len(todo) + 1) - seen_b - seen_a
        zero = lambda seen: np.concatenate(([0], seen))[begin]
        spot = np.where(
            below, seen_b + np.repeat(begin - zero(seen_b), size),
            np.where(above, seen_a + np.repeat(begin + size - na - zero(seen_a), size), seen_e + np.repeat(begin + nb - zero(seen_e), size)),
        ) - 1
        order[todo[spot]] = items
        middle, top = begin + nb, begin + size - na
        final[todo[middle]] = True  # the pivot itself is there
        final[todo[top[na > 0]]] = True
        group[todo] = todo[np.repeat(begin, size)]
        place = np.arange(len(todo))
        mid, hi = np.repeat(middle, size), np.repeat(top, size)
        group[todo] = todo[np.where(place < mid, np.repeat(begin, size), np.where(place < hi, mid, np.minimum(hi, len(todo) - 1)))]
        todo = todo[((place < mid) & np.repeat(nb > 1, size)) | ((place >= hi) & np.repeat(na > 1, size))]
    return order, np.cumsum(final) - 1


def first_bits(words: np.ndarray, items: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The place of the first bit in which each item differs from the other; the number of all bits if it doesn't."""
    n_words = words.shape[1]
    out = np.full(len(items), 64 * n_words)
    left = np.arange(len(items))
    for w in range(n_words):
        x = words[items[left], w] ^ words[others[left], w]
        hit = np.flatnonzero(x)
        if len(hit):
            x = x[hit]
            # The highest bit set, from the exponent of what is left when all lower bits are cleared.
            for s in (1, 2, 4, 8, 16, 32):
                x = x | (x >> np.uint64(s))
            out[left[hit]] = 64 * w + 63 - np.log2((x ^ (x >> np.uint64(1))).astype(np.float64)).astype(np.int64)
            left = np.delete(left, hit)
        if not len(left):
            break
    return out


@dataclass
class BlindTries:
    """Nodes of blind tries: the bit a node looks at, its strings along the order, and where those with the bit set begin."""

    bit: list[np.ndarray]
    low: list[np.ndarray]
    middle: list[np.ndarray]
    high: list[np.ndarray]


def blind_tries(words: np.ndarray, order: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, BlindTries]:
    """Order each group by the strings in ``words``: one trie a group, all groups in step, a level of nodes a round.

    Returns the order, groups of equal strings numbered along it, and the inner nodes by level.
    """
    order = order.copy()
    tries = BlindTries([], [], [], [])
    starts = np.zeros(len(order), bool)
    begin = boundaries(group)
    starts[begin] = True
    size = np.diff(np.concatenate((begin, [len(order)])))
    begin, size = begin[size > 1], size[size > 1]
    while len(begin):
        at = W.ranges(begin, size)
        items = order[at]
        edge = np.cumsum(size) - size
        bit = np.minimum.reduceat(first_bits(words, items, np.repeat(items[edge], size)), edge)
        inner = bit < 64 * words.shape[1]  # the others are leaves of equal strings
        keep = np.repeat(inner, size)
        at, items, begin, size, bit = at[keep], items[keep], begin[inner], size[inner], bit[inner]
        if not len(begin):
            break
        edge = np.cumsum(size) - size
        each = np.repeat(bit, size)
        one = ((words[items, each >> 6] >> (np.uint64(63) - (each & 63).astype(np.uint64))) & np.uint64(1)).astype(np.int64)
        ones = np.add.reduceat(one, edge)
        seen = np.cumsum(one)
        before = seen - one - np.repeat(seen[edge] - one[edge], size)  # ones of the node before each string
        place = np.arange(len(items)) - np.repeat(edge, size)
        spot = np.where(one == 1, np.repeat(size - ones, size) + before, place - before)
        order[np.repeat(begin, size) + spot] = items
        middle = begin + size - ones
        starts[middle] = True
        for kept, new in zip((tries.bit, tries.low, tries.middle, tries.high), (bit, begin, middle, begin + size), strict=True):
            kept.append(new)
        begin, size = np.stack((begin, middle), 1).ravel(), np.stack((size - ones, ones), 1).ravel()
        begin, size = begin[size > 1], size[size > 1]
    return order, np.cumsum(starts) - 1, tries


def deep_shallow_sort(words: np.ndarray, group: np.ndarray | None = None, shallow: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Order strings (rows of big-endian words), within groups if given; returns the order and classes of equal strings along it."""
    order = np.arange(len(words)) if group is None else np.argsort(group, kind="stable")
    group = np.zeros(len(words), np.int64) if group is None else group[order]
    for w in range(min(shallow, words.shape[1])):
        order, group = multikey_quicksort(words[:, w], order, group)
    if shallow < words.shape[1] and len(order):
        order, group, _ = blind_tries(words, order, group)
    return order, group


def sort_windows(window: int, k: int, salt: int = 3, at_once: int = 200_000):
    """The method on bytes: windows that stand more than once, and those that start in a document of smaller id, from the sorted suffixes."""

    def resolve(rank: W.Rank, doc: np.ndarray, first: np.ndarray, length: np.ndarray, owners: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = np.cumsum(length) - length
        n = length - window + 1
        record = np.repeat(np.arange(len(doc)), n)
        at = W.ranges(begin, n)
        # All windows of a record have one anchor: the run of k bytes of least rank in its first window.
        runs = rank(W.runs_of(W.byte_tokens(data), k, salt))
        reach = window - k + 1
        anchor = np.empty(len(doc), np.int64)
        for lo in range(0, len(doc), 8192):
            anchor[lo : lo + 8192] = runs[begin[lo : lo + 8192, None] + np.arange(reach)].argmin(1)
        anchor += begin
        key = W.mix(runs[anchor][record] + (anchor[record] - at).astype(np.uint64))
        del runs, anchor
        repeats, late = np.zeros(len(data), bool), np.zeros(len(data), bool)
        # Suffixes alone in their bucket are in order; the others are taken some at a time, a bucket never split.
        by = np.argsort(key)
        starts = boundaries(key[by])
        size = np.diff(np.concatenate((starts, [len(by)])))
        single = by[starts[size == 1]]
        repeats[at[single]] = owners[record[single]] > 1
        by, size = by[np.repeat(size > 1, size)], size[size > 1]
        ends = np.cumsum(size)
        at_place = word_at(data)
        lo = 0
        while lo < len(ends):
            base = ends[lo] - size[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, base + at_once, side="right")))
            own = by[base : ends[hi - 1]]
            group = np.repeat(np.arange(hi - lo), size[lo:hi])
            order, equal = deep_shallow_sort(big_words(at_place, at[own], window), group)
            own = own[order]
            edge = boundaries(equal)
            source = doc[record[own]]
            repeats[at[own]] = (np.add.reduceat(owners[record[own]], edge) > 1)[equal]
            late[at[own]] = source > np.minimum.reduceat(source, edge)[equal]
            lo = hi
        return repeats, late

    return resolve


def plan_of(window: int, k: int) -> Plan:
    return Plan(window, k, W.byte_tokens, lambda t: np.frombuffer(t, np.uint8), None, False, sort_windows(window, k))


def cut_bytes(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple:
    kept, last, removed = [], 0, 0
    for f, e in zip(start.tolist(), end.tolist(), strict=True):
        kept.append(text[last:f])
        removed += e - f
        last = e
    kept.append(text[last:])
    spans = [{"start": f, "end": e} for f, e in zip(start.tolist(), end.tolist(), strict=True)]
    return len(text), removed, len(start), spans, b"".join(kept)


def remove_repeated_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, k: int = 16) -> DataFrame:
    """Each text, as UTF-8, without the bytes in a string of ``window`` bytes that also starts in a document of smaller id.

    Strings are judged on the input and never cross documents.  Returns the id (bigint), ``n_bytes``, ``n_removed``,
    ``n_spans``, ``spans`` (removed bytes, half-open) and ``kept`` (binary; a cut can split a character).  ``k``: bytes
    in a sampled run; it changes the cost, not the result.  A null text counts as empty.  A text of any length is taken
    whole; a task holds one whole text at a time.  Strings that repeat in one document only stay.  A document with a null
    id stays as it is and makes no other lose a byte.  Rows that repeat a document, id and text, get the result of one of
    them.  An empty table gives no rows.  Other columns are ignored, whatever their names.
    """
    plan = plan_of(window, k)
    types = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]
    return remove_repeats(df, plan, cut_bytes, types, "n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start:bigint,end:bigint>>, kept binary", id_col, text_col)


def digest(removed: DataFrame) -> DataFrame:
    """The result with a SHA-256 in place of the texts."""
    id_col = removed.columns[0]
    return removed.select(id_col, "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def cut_text(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple:
    """The text that is left; characters that a cut splits are dropped."""
    return ((cut_bytes(text, start, end)[-1] if len(start) else text).decode("utf-8", "ignore"),)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", window: int = 50, k: int = 16) -> DataFrame:
    """The rows of ``df`` with their texts after :func:`remove_repeated_bytes`; ``length_col``, if there, is counted anew.

    Characters that a cut splits are dropped.  Null texts and rows with a null id stay as they are; rows that share an
    id and lose something get the text of one of them.  Rows that lose nothing stay where they are, if the ids of the
    others are few enough to be broadcast; the other columns are joined back by id, so a text travels once.  An empty
    table gives no rows; columns of any name are passed through.
    """
    id_, kept, none = fresh("_id", df), fresh("_kept", df), fresh("_none", df)
    named = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias(id_), F.col(text_col).alias(kept))
    texts, ids, _ = cut_repeats(named, plan_of(window, k), cut_text, [(kept, pa.string())], f"`{kept}` string", id_, kept)
    texts = texts.dropDuplicates([id_])
    marked, whole = df.filter(F.col(id_col).isNotNull()), df.filter(F.col(id_col).isNull())
    if ids is not None:
        ids = F.broadcast(ids.withColumnRenamed("marked", id_))
        marked, whole = (df.join(ids, F.col(id_col).cast("bigint") == F.col(id_), how) for how in ("left_semi", "left_anti"))
    rest = marked.withColumn(none, F.col(text_col).isNull()).drop(text_col)
    out = rest.join(texts, F.col(id_col).cast("bigint") == F.col(id_)).withColumn(text_col, F.when(~F.col(none), F.col(kept)))
    if length_col in df.columns:
        kind = df.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(F.col(none), F.col(length_col)).otherwise(F.length(text_col).cast(kind)))
        if ids is not None:
            known = F.col(id_col).isNotNull() & F.col(text_col).isNotNull()
            whole = whole.withColumn(length_col, F.when(known, F.length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return out.select(*df.columns).unionByName(whole)
