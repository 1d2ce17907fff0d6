"""Byte-level BPE encoding and decoding with sentencepiece.

A sentencepiece model is serialised directly from a rank file: every token is a piece, its bytes mapped to printable
characters, scored by its negative rank; normalisation is the identity.  sentencepiece then merges the pair of highest
score, leftmost first, which is the merge of lowest rank.  Decoding maps ids to pieces and their characters to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

FIELDS = [
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType()),
]
DIGEST_FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

#: Runs that the split pattern never crosses: a blank and what is no white space, or white space.  \s is spelled out
#: because Python's takes in four separators that Unicode does not call white space.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_RUNS = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")


def byte_chars() -> list[str]:
    """The character of each byte: itself where it is printable and no blank, else the next from U+0100 on."""
    out, extra = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _int(tag: int, n: int) -> bytes:
    return _varint(tag << 3) + _varint(n & (1 << 64) - 1)


def _bytes(tag: int, b: bytes) -> bytes:
    return _varint(tag << 3 | 2) + _varint(len(b)) + b


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks, which must run from 0 without a gap."""
    with open(path, "rb") as f:
        ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, f)}
    return [ranks[i] for i in range(len(ranks))]


def model_bytes(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model; the id of a piece is its rank, the unknown piece comes last."""
    chars = byte_chars()
    out = [
        _bytes(1, _bytes(1, "".join(chars[b] for b in t).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(i)) + _int(3, 1))
        for i, t in enumerate(tokens)
    ]
    out.append(_bytes(1, _bytes(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _int(3, 2)))
    trainer = _int(3, 2) + _int(4, len(tokens) + 1) + _int(40, len(tokens)) + _int(41, -1) + _int(42, -1) + _int(43, -1)
    normalizer = _bytes(1, b"identity") + _int(3, 0) + _int(4, 0) + _int(5, 0)
    return b"".join(out) + _bytes(2, trainer) + _bytes(3, normalizer)


class Kept:
    """What was computed for a key: two generations of at most ``keep`` entries, the older one dropped as the younger is full."""

    def __init__(self, keep: int) -> None:
        self.keep, self.young, self.old = keep, {}, {}

    def all(self, keys: list, learn) -> list:
        """The value of each key; ``learn`` gets the keys that are new, without repeats, and returns their values."""
        got = list(map(self.young.get, keys))
        if all(got):
            return got
        # An empty value counts as missing and is learned again; that is rare.
        missing = dict.fromkeys([k for k, v in zip(keys, got, strict=True) if not v])
        if len(self.young) + len(missing) > self.keep:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        if old:
            for k in missing:
                missing[k] = old.get(k)
        new = [k for k, v in missing.items() if not v]
        missing.update(zip(new, learn(new), strict=True))
        young.update(missing)
        return [v or missing[k] for k, v in zip(keys, got, strict=True)]


class Codec:
    """Encodes each match of ``pattern`` by itself.  Encodings of runs and of matches are kept, at most ``keep`` of either and generation."""

    def __init__(self, tokens: list[bytes], pattern: str, keep: int = 600_000) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(tokens))
        chars = byte_chars()
        self.to_chars = dict(enumerate(chars))
        to_byte = {c: b for b, c in enumerate(chars)}
        # Inverse mapping: the characters of each piece back to bytes.
        self.bytes_of = [bytes(to_byte[c] for c in p) for p in self.model.id_to_piece(list(range(len(tokens))))]
        self.whole = {t: i for i, t in enumerate(tokens)}
        self.pattern = regex.compile(pattern)
        self.runs, self.parts = Kept(keep), Kept(keep)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def _encode_parts(self, parts: list[str]) -> list[list[int]]:
        raw = [p.encode() for p in parts]
        merge = [r.decode("latin-1").translate(self.to_chars) for r in raw if r not in self.whole]
        merged = iter(self.model.encode(merge, out_type=int, num_threads=1))
        return [[self.whole[r]] if r in self.whole else next(merged) for r in raw]

    def _encode_runs(self, runs: list[str]) -> list[tuple[str, int, bytes]]:
        found = [self.pattern.findall(r) for r in runs]
        ids = iter(self.parts.all([p for own in found for p in own], self._encode_parts))
        out = []
        for own in found:
            got = [i for _ in own for i in next(ids)]
            out.append((" ".join(map(str, got)), len(got), self.decode(got)))
        return out

    def entries(self, text: str) -> list[tuple[str, int, bytes]]:
        """For each run its ids as decimals, their number, and what they decode to."""
        return self.runs.all(_RUNS.findall(text), self._encode_runs)

    def encode(self, text: str) -> list[int]:
        return [int(i) for e in self.entries(text) for i in e[0].split()]


def _full(path: str, pattern: str):
    codec = Codec(read_ranks(path), pattern)

    def each(text):
        ids = codec.encode(text or "")
        return ids, codec.decode(ids)

    return each


def _digests(path: str, pattern: str):
    codec = Codec(read_ranks(path), pattern)

    def each(text):
        got = codec.entries(text or "")
        ids = " ".join([e[0] for e in got])
        return sum([e[1] for e in got]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(b"".join([e[2] for e in got])).hexdigest()

    return each


def encode_texts(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Encode each whole text and decode its ids again: columns ``ids`` and ``decoded``, or their digests.

    ``path``: a rank file on every machine, ``pattern``: what splits a text before the merges.  A null text counts as
    empty: no ids.  A text of any length is encoded whole.  Of pairs of one rank the leftmost is merged first.  Repeated
    rows give repeated results; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    from corpusloom.llm.common import map_texts

    return map_texts(df, id_col, text_col, lambda: (_digests if digests else _full)(path, pattern), DIGEST_FIELDS if digests else FIELDS)
