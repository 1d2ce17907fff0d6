"""Language identification with error-correcting output codes.

Every language has a codeword.  A binary classifier on character n-grams predicts each bit; decoding weighs the loss
of every bit's margin and takes the codeword of least loss, which is flagged where another one is about as near.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import broadcast_texts, checked_broadcast, materialise, tidy

FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
DIM_BITS = 13
_DIGITS = re.compile(r"[\W\d_]+")


def features(text: str) -> np.ndarray:
    """Square roots of hashed counts of n-grams of 1 to 3 characters of the whole text, letters only, as a unit vector."""
    c = np.frombuffer(_DIGITS.sub(" ", f" {text.lower()} ").encode("utf-32-le", "surrogatepass"), np.uint32)
    h1 = c * np.uint32(2654435761)
    h2 = (h1[:-1] ^ (c[1:] + np.uint32(0x9E3779B9))) * np.uint32(2246822519)
    h3 = (h2[:-1] ^ (c[2:] + np.uint32(0x85EBCA6B))) * np.uint32(3266489917)
    out = np.zeros(1 << DIM_BITS, np.float32)
    for h in (h1, h2, h3):
        out += np.bincount(h >> np.uint32(32 - DIM_BITS), minlength=1 << DIM_BITS)
    out = np.sqrt(out)
    return out / max(1e-9, float(np.linalg.norm(out)))


def sparse(f: np.ndarray) -> bytes:
    """Places and values of what is not zero."""
    at = np.flatnonzero(f)
    return at.astype("<u2").tobytes() + f[at].astype("<f4").tobytes()


def dense(data: bytes) -> np.ndarray:
    out, n = np.zeros(1 << DIM_BITS, np.float32), len(data) // 6
    out[np.frombuffer(data, "<u2", n)] = np.frombuffer(data, "<f4", n, 2 * n)
    return out


def codewords(k: int, seed: int = 5) -> np.ndarray:
    """A row of -1 and 1 for each of ``k`` classes: every split in two for up to six classes, else random columns, the best of some draws."""
    if k <= 6:
        cols = [(1, *bits) for bits in itertools.product((1, -1), repeat=k - 1) if -1 in bits]
        return np.array(cols, float).T.reshape(k, len(cols))
    rng, best = np.random.default_rng(seed), (-1, None)
    bits = max(31, 4 * int(np.ceil(np.log2(k))))
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (k, bits))
        code = code[:, np.abs(code.sum(1 - 1)) < k]
        if k > 2000:  # too many pairs to compare; rows that all differ are enough
            if len(np.unique(code, axis=0)) == k:
                return code
            continue
        near = int(code.shape[1] - (code @ code.T)[np.tril_indices(k, -1)].max()) // 2
        if near > best[0]:
            best = (near, code)
    if best[1] is None:
        raise ValueError(f"no codewords for {k} classes")
    return best[1]


@dataclass
class LanguageModel:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    margin: float = 0.1

    @classmethod
    def fit(cls, texts: list[str], langs: list[str], rounds: int = 150, ridge: float = 1e-4) -> LanguageModel:
        return cls.fit_features([features(t) for t in texts], langs, rounds, ridge)

    @classmethod
    def fit_features(cls, rows: list[np.ndarray], langs: list[str], rounds: int = 150, ridge: float = 1e-4) -> LanguageModel:
        names = sorted(set(langs))
        code = codewords(len(names)) if len(names) > 1 else np.zeros((len(names), 0))
        w, b = np.zeros((1 << DIM_BITS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
        if code.shape[1]:
            x = np.stack(rows)
            place = {v: i for i, v in enumerate(names)}
            y = code[[place[v] for v in langs]].astype(np.float32)
            # Adagrad on the logistic loss, all bits at once.
            gw, gb = np.full_like(w, 1e-8), np.full_like(b, 1e-8)
            for _ in range(rounds):
                pull = -y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30))) / len(x)
                dw, db = x.T @ pull + ridge * w / len(x), pull.sum(0)
                gw, gb = gw + dw**2, gb + db**2
                w, b = w - 0.5 * dw / np.sqrt(gw), b - 0.5 * db / np.sqrt(gb)
        return cls(names, code, w, b)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.langs or text is None or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        f = features(text) @ self.weights + self.bias
        loss = np.logaddexp(0, -self.code * f).sum(1)
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        at = int(np.argmax(share))
        second = np.sort(share)[-2] if len(share) > 1 else 0.0
        return self.langs[at], float(min(1.0, share[at])), bool(share[at] - second < self.margin)


def held_out(id_col: str):
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_rows: int = 2000, model: LanguageModel | None = None) -> DataFrame:
    """Predict the language of each whole text: ``held_out``, ``lang_pred``, ``score``, ``ambiguous``.

    Learns from about ``train_rows`` labelled rows, an equal share for each language, chosen by a hash of the id among
    rows that are not held out; every value of the column is learned, from one row at least, at 32 KB of the driver's
    memory for a row.  A text that is null or has no letter is ``und`` with score 0, and so is every text if
    no row is labelled.  A text of any length is read whole.  Of two languages of equal loss the first by name is
    taken, and flagged as ambiguous.  A null id is never held out.  Repeated rows give repeated results; an empty table
    gives no rows; other columns are ignored, whatever their names.
    """
    from corpusloom.llm.common import map_texts

    if model is None:
        model = fit_language_model(df, id_col, text_col, lang_col, train_rows)
    shared = df.sparkSession.sparkContext.broadcast(model)  # its size is fixed by the number of bits
    return map_texts(df, id_col, text_col, lambda: shared.value.predict, FIELDS).withColumn("held_out", held_out(id_col))


def fit_language_model(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_rows: int = 2000) -> LanguageModel:
    base = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("_lang"))
    base = base.filter("_lang is not null and _text is not null").filter(~held_out("_id"))
    # Languages are few; should a column hold very many values, all are learned, and each has a row at least.
    counts = materialise(base.groupBy("_lang").agg(F.count("*").alias("_n")))
    k = counts.count()
    if not k:
        return LanguageModel.fit([], [])
    share, place = max(1, train_rows // k), F.xxhash64("_id", F.lit(11))
    scale = 1 << 20
    wanted = counts.select("_lang", F.least(F.lit(scale), F.ceil(F.lit(scale * share) / F.col("_n"))).alias("_keep"))
    picked = base.join(broadcast_texts(wanted, "_lang"), "_lang").filter(F.pmod(place, F.lit(scale)) < F.col("_keep")).select(place.alias("_at"), "_text", "_lang")
    # Bounded by train_rows and the languages; texts stay where they are, features of bounded size go to the driver.
    rows = with_features(picked).orderBy("_at", "_lang", "_feature").limit(2 * max(train_rows, k)).collect()
    if lost := k - len({r["_lang"] for r in rows}):
        # The hash may pass over a language with few rows: its least row by the hash stands for it.
        seen = checked_broadcast(df.sparkSession.createDataFrame([(v,) for v in sorted({r["_lang"] for r in rows})], "_lang string"), k - lost)
        least = base.join(seen, "_lang", "left_anti").groupBy("_lang").agg(F.min(F.struct(place.alias("_at"), "_text")).alias("m"))
        rows += with_features(least.select("m._at", "m._text", "_lang")).orderBy("_lang").collect()
    return LanguageModel.fit_features([dense(bytes(r["_feature"])) for r in rows], [r["_lang"] for r in rows])


def with_features(texts: DataFrame) -> DataFrame:
    """``_at, _text, _lang`` with the text's features, of a size that its length does not change, in place of the text."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            got = [sparse(features(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(got, pa.binary())], names=["_at", "_lang", "_feature"])

    return texts.mapInArrow(tidy(run), "_at bigint, _lang string, _feature binary")


def drop_unidentified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_rows: int = 2000) -> DataFrame:
    """The rows of ``df`` whose language can be told: neither ``und`` nor ambiguous; all their columns.

    A null text, one without a letter and one between two languages go.  With no labelled row to learn from no language
    can be told, so every row goes, and a warning says so.  Repeated rows all stay or all go; null ids and labels only
    keep a row from being learned from.  An empty table gives no rows.  A text of any length is read whole.  Columns of
    any name are passed through.
    """
    import warnings

    import pyarrow as pa

    model = fit_language_model(df, id_col, text_col, lang_col, train_rows)
    if not model.langs:
        warnings.warn(f"no row has a text and a value of {lang_col} to learn from: no language can be told, all rows go", stacklevel=2)
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches):
        model = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                got = [model.predict(t) for t in part.column(at).to_pylist()]
                yield part.filter(pa.array([lang != "und" and not unsure for lang, _, unsure in got], pa.bool_()))

    return df.mapInArrow(tidy(run), df.schema)
