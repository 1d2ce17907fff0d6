"""Quality rules: rules on the text of a document, and verdicts on hosts from how often their documents break them.

All of it is DataFrame operations.  Rule failures are summed by host, the rate of each host is shrunk by a beta prior
that is fitted to all hosts, and the verdict on the host is joined back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, spelled for Java's patterns.
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def let(value: Column, body) -> Column:
    """``body(value)``, the value computed once however often the body has it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more."""

    def covered(starts: Column) -> Column:
        # Sorted starts: each covers three words, or as many as lie before the next one.
        gaps = F.zip_with(starts, F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0), lambda s, g: s + g)

    def starts(hashes: Column) -> Column:
        keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(keyed, lambda k: F.sort_array(F.array_compact(F.transform(
            k, lambda x, j: F.when((x["h"] == F.get(k, j - 1)["h"]) | (x["h"] == F.get(k, j + 1)["h"]), x["i"])
        ))))

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(starts(hashes), covered))

    windows = F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return let(windows, count)


def text_measures(text: Column) -> Column:
    """A struct of the counts the rules are made of; a null text counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))

    def measures(words: Column, text: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
            repeated_words(words).cast("bigint").alias("n_repeat_words"),
        )

    return let(text, lambda t: let(F.array_remove(F.split(t, GAP, -1), ""), lambda w: measures(w, t)))


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", worst_rate: float = 0.8, min_words: int = 50) -> DataFrame:
    """Counts of each whole text, ``base_failed``, the shrunken failure rate of its host, and ``kept``.

    A document fails if it has fewer than ``min_words`` words or more than half of them repeat.  A host is rejected,
    and all its documents with it, if its failure rate, shrunk by the prior, is above ``worst_rate``.  A null text
    counts as empty; documents of a null host have no host rate and are judged alone.  Repeated rows count as often
    as they stand and give repeated results; an empty table gives no rows; other columns are ignored, whatever their
    names.  A text of any length is measured whole, as arrays of its words in one row.  A rate of exactly ``worst_rate``
    is kept.
    """
    from corpusloom.llm.common import broadcast_texts, materialise

    own = df.select(F.col(id_col).alias("_id"), F.col(host_col).cast("string").alias("_host"), text_measures(F.col(text_col)).alias("m"))
    own = own.select("_id", "_host", "m.*")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    own = materialise(own.withColumn("base_failed", failed))  # counts only: the texts are read once
    hosts = own.filter("_host is not null").groupBy("_host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("int")).alias("bad"))
    a, b = beta_prior(hosts)
    hosts = hosts.select("_host", ((F.col("bad") + a) / (F.col("n") + a + b)).alias("host_rate"))
    joined = own.join(broadcast_texts(materialise(hosts), "_host"), "_host", "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("host_rate") <= worst_rate, F.lit(True))
    return joined.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "host_rate",
    )


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Beta parameters by the moments of the hosts' rates, weighted by their documents; two numbers reach the driver."""
    rate = F.col("bad") / F.col("n")
    s = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("n") * rate * rate).alias("sq"), F.count("*").alias("k")).first()
    if not s["n"] or s["k"] < 2:
        return 1.0, 1.0
    mean = min(0.99, max(0.01, s["bad"] / s["n"]))
    spread = max(1e-6, s["sq"] / s["n"] - (s["bad"] / s["n"]) ** 2)
    strength = min(1000.0, max(2.0, mean * (1 - mean) / spread - 1))
    return mean * strength, (1 - mean) * strength


def drop_rejected(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", worst_rate: float = 0.8, min_words: int = 50) -> DataFrame:
    """The rows of ``df`` that :func:`judge` keeps, with all their columns.

    Texts are measured once; what is kept of a row is its id, a hash of its text, its host and whether it failed, and the
    rows to drop are joined back by these.  A null text has no words and goes; a null host is judged by its documents
    alone; a null id is an id like any other here.  Repeated rows all stay or all go.  An empty table gives no rows.
    Columns of any name are passed through.
    """
    from corpusloom.llm.common import checked_broadcast, fresh, materialise

    id_, text, host = fresh("_rejected_id", df), fresh("_rejected_text", df), fresh("_rejected_host", df)
    digest, source = F.xxhash64(F.col(text_col).cast("string")), F.col(host_col).cast("string")
    failed = let(text_measures(F.col(text_col)), lambda x: (x["n_words"] < min_words) | (100 * x["n_repeat_words"] > 50 * x["n_words"]))
    own = materialise(df.select(F.col(id_col).alias(id_), digest.alias(text), F.xxhash64(source).alias(host), source.isNotNull().alias("_known"), failed.alias("_failed")))
    # Hosts are told apart by a hash: their names have no bound.
    hosts = materialise(own.filter("_known").groupBy(host).agg(F.count("*").alias("n"), F.sum(F.col("_failed").cast("int")).alias("bad")))
    a, b = beta_prior(hosts)
    bad = materialise(hosts.filter((F.col("bad") + a) / (F.col("n") + a + b) > worst_rate).select(host))
    poor = own.join(checked_broadcast(bad, bad.count()), host, "left_semi").filter("_known").unionByName(own.filter("_failed"))
    poor = materialise(poor.select(id_, text).distinct())
    same = F.col(id_col).eqNullSafe(F.col(id_)) & (digest == F.col(text))
    return df.join(checked_broadcast(poor, poor.count()), same, "left_anti")
