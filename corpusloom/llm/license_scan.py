"""License scans: exact phrases, and fuzzy search for short notices.

A notice that may hold k edits is cut into k + 1 seeds; whatever matches it with k edits or fewer holds one of them
unchanged (pigeonhole).  One automaton finds all seeds of all notices in a pass; only the text around a seed goes to
the bounded-error matching of the regex library, which verifies the edits and reports the span.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.windows import ranges

#: Phrases that count wherever their words stand consecutively.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Short notices: label, words, number of edits (characters) that are allowed.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    ("mit", "the software is provided as is without warranty of any kind", 5),
    ("mit", "released under the mit license", 2),
    ("apache", "licensed under the apache license version 2 0", 3),
    ("apache", "you may not use this file except in compliance with the license", 5),
    ("gpl", "under the terms of the gnu general public license", 4),
    ("lgpl", "gnu lesser general public license", 3),
    ("bsd", "redistribution and use in source and binary forms with or without modification", 6),
    ("mpl", "subject to the terms of the mozilla public license", 4),
    ("cc", "licensed under a creative commons attribution", 4),
    ("reserved", "copyright all rights reserved", 2),
)

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

SPAN = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("edits", T.LongType()),
]))
FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("spans", SPAN),
]


def normal(text: str | None) -> str:
    """ASCII letters lower-cased, words (runs of ASCII letters, digits and characters beyond ASCII) joined by one space, a space at either end."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split(b" ")
    return " " + "".join(w + " " for w in b" ".join(words).decode("utf-8", "surrogatepass").split(" ") if w)


@dataclass(frozen=True)
class Seed:
    notice: int
    offset: int
    text: str


def seeds_of(notice: int, text: str, edits: int) -> list[Seed]:
    cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
    return [Seed(notice, a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


#: Characters of a gram, and times a notice's length from which a stretch is looked at by grams before it is matched.
GRAM, LONG = 3, 3


def grams(text: str) -> np.ndarray:
    """Each run of three characters as a number, one to one."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:] if len(c) >= GRAM else np.zeros(0, np.uint64)


class Scanner:
    def __init__(self, phrases: dict[str, str], notices) -> None:
        import ahocorasick
        import regex

        self.phrases = [(re.compile(f"(?= {re.escape(p)} )"), label) for p, label in phrases.items()]
        self.notices = notices
        self.verify = [regex.compile(f"(?b)(?:{regex.escape(text)}){{e<={k}}}") for _, text, k in notices]
        self.grams = []
        for _, text, _ in notices:
            own = grams(text)
            order = np.argsort(own, kind="stable")
            self.grams.append((own[order], order))
        self.seeds = ahocorasick.Automaton()
        found: dict[str, list[Seed]] = {}
        for i, (_, text, k) in enumerate(notices):
            for s in seeds_of(i, text, k):
                found.setdefault(s.text, []).append(s)
        for text, own in found.items():
            self.seeds.add_word(text, own)
        self.seeds.make_automaton()

    def fuzzy(self, norm: str) -> list[tuple[str, int, int, int]]:
        """Label, span in characters of the normal form, edits; spans of one notice do not overlap, and no match is left between them."""
        near: dict[int, list[tuple[int, int]]] = {}
        for end, own in self.seeds.iter(norm):
            for s in own:
                _, text, k = self.notices[s.notice]
                lo = end + 1 - len(s.text) - s.offset - k
                near.setdefault(s.notice, []).append((lo, lo + len(text) + 2 * k))
        windows: dict[int, list[list[int]]] = {}
        for notice, found in near.items():
            at = windows.setdefault(notice, [])
            for lo, hi in sorted(found):
                if at and lo <= at[-1][1]:
                    at[-1][1] = max(hi, at[-1][1])
                else:
                    at.append([lo, hi])
        out = []
        for notice, spans in windows.items():
            label, text, k = self.notices[notice]
            # Blocks of bounded length keep the work of the matcher linear.  Only matches that start in the block count; the
            # rest is so long that nothing beyond it changes them: a match gives way to one of fewer edits only, k times at most.
            step, ahead = 40 * len(text), (k + 2) * (len(text) + 2 * k)
            for lo, hi in (x for lo, hi in spans for x in self.likely(notice, norm, max(0, lo), min(hi, len(norm)))):
                a = lo
                while a < min(hi, len(norm)):
                    own = [m for m in self.matches(notice, norm, a, min(len(norm), a + step + ahead, hi)) if m[0] < a + step]
                    out += [(label, *m) for m in own]
                    a = max([a + step, *(m[1] for m in own)])
        return sorted(out, key=lambda x: (x[1], x[2], x[0]))

    def likely(self, notice: int, norm: str, lo: int, hi: int) -> list[tuple[int, int]]:
        """The parts of a stretch in which a match can lie; a short stretch is one.

        An edit breaks at most three of a notice's grams, and moves those behind it by one place: a match with k edits
        has all grams but 3 k of the notice, no more than k places from where they would stand without edits.  Beginnings of a
        notice over and over have seeds but never so many grams, and so never reach the matcher.
        """
        _, text, k = self.notices[notice]
        least = len(text) - GRAM + 1 - GRAM * k
        if hi - lo <= LONG * len(text) or least <= 0:
            return [(lo, hi)]
        sorted_, order = self.grams[notice]
        own = grams(norm[lo:hi])
        left = np.searchsorted(sorted_, own, "left")
        n = np.searchsorted(sorted_, own, "right") - left
        # Where the notice would begin, for each gram of the text that it has.
        start = np.repeat(np.arange(len(own)), n) - order[ranges(left, n)] + len(text)
        count = np.bincount(start, minlength=len(own) + len(text) + 2 * k + 1)
        upto = np.concatenate(([0], np.cumsum(count)))
        width = 2 * k + 1
        at = np.flatnonzero(upto[width:] - upto[:-width] >= least) - len(text)
        out: list[list[int]] = []
        for a in (at + lo).tolist():
            if out and a <= out[-1][1]:
                out[-1][1] = a + len(text) + 3 * k
            else:
                out.append([a, a + len(text) + 3 * k])
        return [(max(lo, a), min(hi, b)) for a, b in out]

    def matches(self, notice: int, norm: str, lo: int, hi: int) -> list[tuple[int, int, int]]:
        """Start, end, edits: the match of fewest edits, then those of the stretches before and after it, until none is left."""
        _, text, k = self.notices[notice]
        out, todo = [], [(lo, hi)]
        while todo:
            a, b = todo.pop()
            if b - a < max(1, len(text) - k):
                continue
            m = self.verify[notice].search(norm, a, b)
            if m and m.end() > m.start():
                out.append((m.start(), m.end(), sum(m.fuzzy_counts)))
                todo += [(a, m.start()), (m.end(), b)]
        return out

    def __call__(self, text: str | None) -> tuple:
        norm = normal(text)
        n_words = norm.count(" ") - 1
        starts, base = [], set()
        for pattern, label in self.phrases:
            for m in pattern.finditer(norm):
                starts.append(m.start())
                base.add(label)
        spans = self.fuzzy(norm)
        first = norm.count(" ", 0, min(starts)) if starts else None
        last = norm.count(" ", 0, max(starts)) if starts else None
        best = max((1 - e / max(1, b - a) for _, a, b, e in spans), default=0.0)
        return (
            n_words, len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(base | {s[0] for s in spans})),
            1.0 if starts else max(0.0, min(1.0, best)), [dict(zip(("label", "start", "end", "edits"), s, strict=True)) for s in spans],
        )


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=None, notices=NOTICES) -> DataFrame:
    """Exact phrases and fuzzy notices of each whole text; one result for each row.

    ``spans`` has the fuzzy matches in characters of the normal form (see :func:`normal`).  A null text counts as
    empty: no words, no labels, score 0.  A text of any length is searched whole, in blocks of bounded length.  Matches of
    fewest edits are taken first, the leftmost of equal ones; notices that match the same place are all reported.
    Repeated rows give repeated results; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    from corpusloom.llm.common import map_texts

    phrases = PHRASES if phrases is None else phrases
    return map_texts(df, id_col, text_col, lambda: Scanner(phrases, notices), FIELDS)


def digest(scanned: DataFrame) -> DataFrame:
    return scanned.select(*[c for c in scanned.columns if c != "spans"], F.to_json("spans").alias("spans_json"))
