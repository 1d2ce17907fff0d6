"""Packing of tokenised documents into sequences of bounded length.

Documents are tokenised where they lie; what is longer than a sequence is cut into full sequences and a rest.  The
rests are dealt to randomised groups of bounded expected size, and every group is packed by itself, first-fit
decreasing: a tournament tree over the free room of its bins finds the leftmost bin with room for a piece.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import tidy
from corpusloom.llm.byte_bpe import Kept
from corpusloom.llm.windows import distinct_words, word_spans


#: Fixed value: a pattern under which a word of letters, or of letters and one stop, needs no search.
LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


_STOP = np.isin(np.arange(256), list(b",.;:!?"))
_WIDE_SPACE = regex.compile(r"[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def little(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned numbers of 32 bits."""
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


class WordTokenizer:
    """Ids of a tokenizer whose words never cross white space, as little-endian bytes; encodings of words are kept."""

    #: White space to Python's split() but not to the tokenizer, or strings that are tokens of their own.
    ODD = ("\x1c", "\x1d", "\x1e", "\x1f")

    def __init__(self, path: str, keep: int = 600_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.odd = self.ODD + tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.words, self.parts = Kept(keep), Kept(keep)
        spec = json.loads(self.tokenizer.to_str())
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        # If matches of a pattern are all that is kept of a word, they can be encoded one by one.
        split = steps[0]["pattern"]["Regex"] if steps and steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"] else None
        self.pattern = split and regex.compile(split)
        self.plain = split == LETTER_RUNS
        self.lowers = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]

    def _encode(self, parts: list[str]) -> list[bytes]:
        out = []
        for lo in range(0, len(parts), 512):
            own = parts[lo : lo + 512]
            # Blanks between keep the parts apart; ids are dealt out again by the word they belong to.
            e = self.tokenizer.encode(" ".join(own), add_special_tokens=False)
            cuts = np.flatnonzero(np.diff(np.array(e.word_ids, np.int64), prepend=-1)).tolist()
            if len(cuts) == len(own):
                raw = little(e.ids)
                out += [raw[4 * i : 4 * j] for i, j in zip(cuts, [*cuts[1:], len(e.ids)], strict=True)]
            else:
                out += [little(x.ids) for x in self.tokenizer.encode_batch_fast(own, add_special_tokens=False)]
        return out

    def _parts(self, word: str) -> list[str]:
        if self.plain:
            if word.isalpha():
                return [word]
            if word[-1] in ",.;:!?" and word[:-1].isalpha():
                return [word[:-1], word[-1]]
        return self.pattern.findall(word)

    def _encode_words(self, raw: list[bytes]) -> list[bytes]:
        words = [w.decode() for w in raw]
        if not self.pattern:
            return [little(x.ids) for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        found = list(map(self._parts, words))
        # A word of one part is kept as a word; parts of others are kept as parts.
        single = iter(self._encode([own[0] for own in found if len(own) == 1]))
        several = iter(self.parts.all([p for own in found if len(own) > 1 for p in own], self._encode))
        return [next(single) if len(own) == 1 else b"".join([next(several) for _ in own]) for own in found]

    def _normal(self, text: str) -> str | None:
        """The text lower-cased, or null if that is not all its normal form takes, or a neighbour matters."""
        if "\u03a3" in text or not unicodedata.is_normalized("NFC", text) or any(x in text for x in self.odd):
            return None
        low = text.lower()
        return low if low.isascii() or unicodedata.is_normalized("NFC", low) else None

    def _spans(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of words; a stop after a letter stands alone, if the pattern never has the two together."""
        start, end = word_spans(data)
        if not self.plain or not len(start):
            return start, end
        b = np.frombuffer(data, np.uint8)
        before = b[np.maximum(end - 2, 0)]
        cut = (end - start > 1) & _STOP[b[end - 1]] & (before >= 97) & (before <= 122)
        pieces = 1 + cut
        word = np.repeat(np.arange(len(start)), pieces)
        second = np.ones(len(word), bool)
        second[np.cumsum(pieces) - pieces] = False
        stop = end[word] - 1
        return np.where(second, stop, start[word]), np.where(cut[word] & ~second, stop, end[word])

    def _together(self, texts: list[str]) -> list[bytes]:
        """Ids of normal texts with no white space but ASCII: each different word of them is looked up once."""
        raw = [t.encode() for t in texts]
        data = b"\n".join(raw)
        start, end = self._spans(data)
        first, inverse = distinct_words(data, start, end)
        found = self.words.all([data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)], self._encode_words)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        length = size[inverse]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        out = ids[np.repeat((np.cumsum(size) - size)[inverse] - (ends - length), length) + np.arange(total)].tobytes()
        # Ids up to the end of each text.
        stops = np.cumsum([len(r) + 1 for r in raw])
        upto = np.concatenate(([0], ends))[np.searchsorted(start, stops)].tolist()
        return [out[4 * i : 4 * j] for i, j in zip([0, *upto[:-1]], upto, strict=True)]

    def all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; normal ones are looked up together, texts that are not in normal form go the slow way."""
        out: list[bytes] = [b""] * len(texts)
        fast = []
        for i, text in enumerate(texts):
            low = self._normal(text) if self.pattern and self.lowers else None
            if low is None:
                out[i] = little(self.tokenizer.encode(text, add_special_tokens=False).ids)
            elif low.isascii() or not _WIDE_SPACE.search(low):
                fast.append((i, low))
            else:
                out[i] = b"".join(self.words.all([w.encode() for w in low.split()], self._encode_words))
        if fast:
            for (i, _), ids in zip(fast, self._together([t for _, t in fast]), strict=True):
                out[i] = ids
        return out

    def __call__(self, text: str) -> bytes:
        return self.all([text])[0]


class Tournament:
    """Free room of bins; the leftmost bin with room for a piece is found from the root down."""

    def __init__(self, bins: int, room: int) -> None:
        self.size = 1 << max(0, bins - 1).bit_length()
        self.best = [room] * (2 * self.size)

    def take(self, length: int) -> tuple[int, int]:
        """Put a piece into the leftmost bin that has room; returns the bin and the room it had before."""
        best, at = self.best, 1
        while at < self.size:
            at *= 2
            if best[at] < length:
                at += 1
        room = best[at]
        best[at] = room - length
        bin_ = at - self.size
        while at > 1:
            at //= 2
            best[at] = max(best[2 * at], best[2 * at + 1])
        return bin_, room


def first_fit_decreasing(lengths, room: int) -> list[tuple[int, int]]:
    """Bin and offset of each piece, in the order given; pieces are placed by falling length, then by that order."""
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    tree = Tournament(max(1, len(lengths)), room)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        bin_, left = tree.take(lengths[i])
        out[i] = (bin_, room - left)
    return out


PIECES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def tokenise(df: DataFrame, path: str, end_id: int, room: int, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    """One row for each piece: a full sequence, or the rest of a document; with its ids if asked for."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        tok, end = WordTokenizer(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                take, rows = [], []
                for i, ids in enumerate(tok.all([t or "" for t in part.column(1).to_pylist()])):
                    ids += end
                    n = len(ids) // 4
                    for a in range(0, n, room):
                        own = ids[4 * a : 4 * min(n, a + room)]
                        take.append(i)
                        rows.append((a, len(own) // 4, zlib.crc32(own), n, own))
                cols = list(zip(*rows, strict=True)) or [()] * 5
                arrays = [part.column(0).take(pa.array(take, pa.int64())), *(pa.array(c, pa.int64()) for c in cols[:4])]
                names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    arrays.append(pa.array(cols[4], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(tidy(run), f"`{id_col}` {kind}, {PIECES}" + ", ids binary" * with_ids)


def pack(df: DataFrame, path: str, room: int = 2048, end_id: int = 1, group: int = 4096, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``room`` ids; one row for each piece.

    Returns the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` (and ``ids``,
    little-endian, if ``with_ids``).  ``group``: rests in a randomised group, on average.  A null text counts as empty
    and gives one piece, the end id.  A text of any length is tokenised whole and cut into full sequences and a rest.
    Rests of one length are placed by id and start.  Rows that repeat a document are documents of their own, dealt to
    groups like any others; a null id is one, too.  An empty table gives no rows; other columns are ignored, whatever
    their names.  Sequence ids are unique but have gaps.
    """
    from corpusloom.llm.common import materialise

    pieces = materialise(tokenise(df, path, end_id, room, id_col, text_col, with_ids))
    n = pieces.filter(F.col("length") < room).count()
    groups = max(1, -(-n // group))
    # The number of the row, too: rows that are all alike are dealt like any others.  Pieces are written, so it stays.
    row = F.monotonically_increasing_id()
    salted = pieces.withColumn("_group", F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), "start", "doc_tokens", "ids_crc32", row), F.lit(groups)))
    # A full sequence needs no bin; it takes ids from a range of its own, by partition and row.
    full = salted.filter(F.col("length") >= room).withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")}).drop("_group")
    rest = salted.filter(F.col("length") < room)
    out = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        by = [c for c in (id_col, "start", "ids_crc32") if c in pdf]
        pdf = pdf.sort_values(by, kind="stable", na_position="first").reset_index(drop=True)
        placed = first_fit_decreasing(pdf["length"].tolist(), room)
        pdf["sequence_id"] = [(int(pdf["_group"].iloc[0]) << 32) + b for b, _ in placed]
        pdf["offset"] = [o for _, o in placed]
        return pdf[[f.name for f in out.fields]]

    return full.unionByName(rest.groupBy("_group").applyInPandas(fit, out))
