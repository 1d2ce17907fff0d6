"""Substring dedup by level-wise doubling: words that repeat earlier in the corpus go.

Single words that repeat are extended to windows of twice that length, those that still repeat are extended again, and
so on to the target length; a window that does not repeat at one length is no candidate at the next.  Which stretches of
text can repeat at all is found by sampling (:mod:`passages`); what goes, doubling decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import windows as W
from corpusloom.llm.passages import Plan, remove_repeats


def classes_of(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each key, equal for equal keys, and whether the weights of its class sum to more than one."""
    _, inverse = np.unique(keys, return_inverse=True)
    return inverse, np.bincount(inverse, weight)[inverse] > 1


def doubling(window: int):
    """The method on words: lengths 1, 2, 4 and so on; the last step reaches exactly ``window``.

    Words are numbered by their bytes.  Two windows of a length are equal if their halves (overlapping ones in the last
    step) are, so classes are numbered by pairs of classes and nothing hangs on a hash.  A window that stands alone at a
    length is no candidate later.
    """

    def resolve(rank: W.Rank, doc: np.ndarray, first: np.ndarray, length: np.ndarray, owners: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = content.tobytes()
        _, tokens = W.distinct_words(data, *W.word_spans(data))
        n = len(tokens)
        record = np.repeat(np.arange(len(length)), length)
        end = np.cumsum(length)[record]  # where the record of each token ends
        weight = owners.astype(np.float64)
        at = np.arange(n)
        kind, more = classes_of(tokens, weight[record])
        at, kind, size = at[more], kind[more], 1
        of = np.full(n, -1)
        while size < window and len(at):
            step = min(2 * size, window)
            of[:] = -1
            of[at] = kind
            at = at[at + step <= end[at]]
            half = of[at + step - size]
            at, half = at[half >= 0], half[half >= 0]
            kind, more = classes_of(of[at] * n + half, weight[record[at]])
            at, kind, size = at[more], kind[more], step
        repeats, late = np.zeros(n, bool), np.zeros(n, bool)
        repeats[at] = True
        # The earliest of equal windows stays.
        place = first[record[at]] + at - (end - length[record])[at]
        owner = doc[record[at]]
        by = np.lexsort((place, owner, kind))
        at, kind, place, owner = at[by], kind[by], place[by], owner[by]
        new = np.concatenate(([True], kind[1:] != kind[:-1])) if len(at) else np.zeros(0, bool)
        lead = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        late[at[(owner != owner[lead]) | (place != place[lead])]] = True
        return repeats, late

    return resolve


def one_blank(text: bytes) -> np.ndarray:
    """The words, a blank after each."""
    return np.frombuffer(b" ".join([*text.split(), b""]), np.uint8)


def word_ends(content: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero(content == 32) + 1))


def plan_of(window: int, k: int) -> Plan:
    return Plan(window, k, W.word_tokens, one_blank, word_ends, True, doubling(window))


def cut_words(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple:
    words = text.split()
    kept, last = [], 0
    for f, e in zip(start.tolist(), end.tolist(), strict=True):
        kept += words[last:f]
        last = e
    kept += words[last:]
    spans = [{"start": f, "end": e} for f, e in zip(start.tolist(), end.tolist(), strict=True)]
    return len(words), len(words) - len(kept), spans, b" ".join(kept).decode("utf-8", "surrogatepass")


def remove_repeated_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, start: int = 5) -> DataFrame:
    """Each text without the words that lie in a window of ``window`` words that also starts earlier.

    Earlier: in a document of smaller id, or before in the same one; windows are judged on the input.  Words stand
    between blanks and the control characters 9 to 13.  ``start``: words in a sampled run; it changes the cost, not the
    result.  Returns the id (bigint), ``n_words``, ``n_removed``, ``spans`` (removed words, half-open) and ``kept``
    (words joined by one blank).  A null or blank text has no words.  A text of any length is taken whole; a task holds
    one whole text at a time.  Of equal windows the one of smallest id and start stays, so there are no ties.  A document
    with a null id stays as it is and makes no other lose a word.  Rows that repeat a document, id and text, get the
    result of one of them.  An empty table gives no rows.  Other columns are ignored, whatever their names.
    """
    plan = plan_of(window, min(start, window))
    types = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())]
    return remove_repeats(df, plan, cut_words, types, "n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept string", id_col, text_col)


def digest(removed: DataFrame) -> DataFrame:
    """The result with a SHA-256 in place of the texts."""
    id_col = removed.columns[0]
    return removed.select(id_col, "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
