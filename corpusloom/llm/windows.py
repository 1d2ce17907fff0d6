"""Sampled windows: how repeated passages are found without a row for every position.

Tokens (words or bytes) are hashed to 64 bits.  Of the ``window - k + 1`` runs of ``k`` tokens in a window, the one of
least hash, leftmost in a tie, is the window's anchor: equal windows have equal anchors at equal offsets.  Windows next
to each other that share an anchor form a stretch; on average one stretch stands for about ``(window - k + 2) / 2``
windows.  Equal stretches (same tokens from the first window's start to the last window's end) hold equal windows.
"""

from __future__ import annotations

import numpy as np

_M1, _M2, _BASE = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_S = np.uint64(33)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit of the input moves every bit of the output."""
    h = (h ^ (h >> _S)) * _M1
    h = (h ^ (h >> _S)) * _M2
    return h ^ (h >> _S)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_POWERS = {}


def powers(n: int, salt: int = 0) -> np.ndarray:
    """Powers of an odd number modulo 2**64; grows by doubling and is kept."""
    got = _POWERS.get(salt)
    if got is None or len(got) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        base = np.uint64(int(mix(np.array([salt + 77], np.uint64))[0]) | 1)
        got = _POWERS[salt] = np.multiply.accumulate(np.full(size, base, np.uint64))
    return got[:n]


_INVERSE = {}


def inverse_powers(n: int, salt: int = 0) -> np.ndarray:
    got = _INVERSE.get(salt)
    if got is None or len(got) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        base = int(powers(1, salt)[0])
        got = _INVERSE[salt] = np.multiply.accumulate(np.full(size, pow(base, -1, 1 << 64), np.uint64))
    return got[:n]


class Spans:
    """Hashes of any spans of a token array, from sums of ``token * base ** position``."""

    def __init__(self, tokens: np.ndarray, salt: int = 0) -> None:
        self.salt, n = salt, len(tokens)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(tokens * powers(n, salt), out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * inverse_powers(len(self.sums), self.salt)[start]
        return mix(raw + (end - start).astype(np.uint64) * _BASE)

    def runs(self, k: int) -> np.ndarray:
        """Hashes of all spans of ``k`` tokens."""
        n = len(self.sums) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        raw = (self.sums[k:] - self.sums[:-k]) * inverse_powers(n + 1, self.salt)[: n - k + 1]
        return mix(raw + np.uint64(k * int(_BASE) % (1 << 64)))


def runs_of(tokens: np.ndarray, k: int, salt: int, step: int = 1 << 17) -> np.ndarray:
    """Hashes of all runs of ``k`` tokens, of any number of tokens in bounded memory: a run's hash hangs on its tokens alone."""
    n = len(tokens) - k + 1
    return np.concatenate([Spans(tokens[lo : lo + step + k - 1], salt).runs(k)[: n - lo] for lo in range(0, n, step)]) if n > 0 else np.zeros(0, np.uint64)


def byte_tokens(data: bytes | np.ndarray) -> np.ndarray:
    return _BYTE[np.frombuffer(data, np.uint8)]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words between blanks and the control characters 9 to 13."""
    b = np.frombuffer(data, np.uint8)
    inside = np.ones(len(b) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = (b != 32) & ((b < 9) | (b > 13))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


_LOW = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def word_keys(data: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first and the second eight bytes of each word as numbers, zeros behind its end, and its length: all there is of a word of up to 16 bytes."""
    padded = np.frombuffer(data + bytes(16), np.uint8)
    rows = np.lib.stride_tricks.as_strided(padded, (len(data) + 9, 8), (1, 1))
    size = end - start
    first = rows[start].view("<u8").ravel() & _LOW[np.minimum(size, 8)]
    second = rows[np.minimum(start + 8, len(data))].view("<u8").ravel() & _LOW[np.clip(size - 8, 0, 8)]
    return first, second, size


def word_hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of words: mixed from their bytes up to 16 of them, XXH3 of longer ones."""
    from xxhash import xxh3_64_intdigest

    first, second, size = word_keys(data, start, end)
    out = mix(mix(first) ^ (mix(second) + size.astype(np.uint64) * _BASE))
    long = np.flatnonzero(size > 16)
    if len(long):
        out[long] = np.fromiter((xxh3_64_intdigest(data[a:b]) for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)), np.uint64, len(long))
    return out


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 64-bit hashes in any order: a place of each different one, and for each the number of its place.

    High bits of a hash and its place share a number, which sorts faster than places by hashes do; should two hashes
    agree in the high bits alone, they are sorted whole.
    """
    n = len(hashes)
    bits = np.uint64(max(1, n - 1).bit_length())
    keys = np.sort(hashes >> bits << bits | np.arange(n, dtype=np.uint64))
    at = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    high, whole = keys >> bits, hashes[at]
    new = np.ones(n, bool)
    new[1:] = high[1:] != high[:-1]
    if n and (new[1:] != (whole[1:] != whole[:-1])).any():
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        return first, inverse
    inverse = np.empty(n, np.int64)
    inverse[at] = np.cumsum(new) - 1
    return at[new], inverse


def distinct_words(data: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different word, and for each word the number of its place: by their bytes.  Hashes only sort them; where two words share one, bytes tell them apart."""
    first, inverse = distinct(word_hashes(data, start, end))
    like = first[inverse]
    same = np.ones(len(start), bool)
    for key in word_keys(data, start, end):
        same &= key == key[like]
    for i in np.flatnonzero((end - start > 16) & same & (like != np.arange(len(like)))).tolist():
        same[i] = data[start[i] : end[i]] == data[start[like[i]] : end[like[i]]]
    if not same.all():
        number: dict[bytes, int] = {}
        inverse = np.fromiter((number.setdefault(data[a:b], len(number)) for a, b in zip(start.tolist(), end.tolist(), strict=True)), np.int64, len(start))
        _, first = np.unique(inverse, return_index=True)
    return first, inverse


def word_tokens(data: bytes) -> np.ndarray:
    """Hashes of the words."""
    return word_hashes(data, *word_spans(data))


def sliding_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """For each window of ``w`` values the place of the least, leftmost in a tie."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at, size = h, np.arange(len(h)), 1
    while size < w:
        step = min(size, w - size)
        a, b = best[:-step], best[step:]
        right = b < a
        best, at = np.where(right, b, a), np.where(right, at[step:], at[:-step])
        size += step
    return at[:n]


class Rank:
    """What runs are compared by for anchors: their hash, but runs in ``common`` come after all others.

    A run that very many texts share would else be the anchor of very many different stretches.  Whatever is in
    ``common``, the rank hangs on the run alone, so equal windows still have equal anchors.
    """

    def __init__(self, common: np.ndarray) -> None:
        self.common = np.sort(common.astype(np.uint64))
        self.some = np.zeros(1 << 20, bool)
        self.some[(self.common >> np.uint64(44)).astype(np.int64)] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = h >> np.uint64(1)
        if len(self.common):
            at = np.flatnonzero(self.some[(h >> np.uint64(44)).astype(np.int64)])
            found = self.common[np.minimum(np.searchsorted(self.common, h[at]), len(self.common) - 1)] == h[at]
            out[at[found]] |= np.uint64(1 << 63)
        return out


def stretches(ranks: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows: place of the anchor, first and last window start of each stretch.  ranks: of runs of k."""
    at = sliding_argmin(ranks, window - k + 1)
    if not len(at):
        z = np.zeros(0, np.int64)
        return z, z, z
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return at[new], new, np.concatenate((new[1:], [len(at)])) - 1


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans, sorted and disjoint; spans that touch become one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    return start[first], end[np.concatenate((first[1:], [len(start)])) - 1]


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places of spans, one span after the other."""
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def mask_spans(mask: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of true values that do not cross records of the given lengths: the record, first and last offset in it."""
    at = np.flatnonzero(mask)
    begin = np.cumsum(length) - length
    record = np.searchsorted(begin, at, side="right") - 1
    offset = at - begin[record]
    new = np.flatnonzero(np.concatenate(([True], (record[1:] != record[:-1]) | (offset[1:] != offset[:-1] + 1)))) if len(at) else at
    return record[new], offset[new], offset[np.concatenate((new[1:], [len(at)])) - 1] if len(at) else at
