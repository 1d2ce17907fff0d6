"""Finding a document by its title in an index of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.scalars import normal_title, title_words


def score(title: Column, words: Column, text: Column, text_words: Column) -> Column:
    """Words in common; 10 more if the text holds the title, else 3 more if it begins with the title's first word."""
    first = F.get(F.split(title, " "), F.lit(0))
    common = F.size(F.array_intersect(words, text_words))
    return common + F.when(text.contains(title), 10).when(text.startswith(first), 3).otherwise(0)


#: Lengths of the runs of characters by which titles are looked for inside texts; the first for titles too short for the second.
RUNS = (3, 6)


def _runs(text: Column, n: int) -> Column:
    """The different runs of ``n`` characters."""
    at = F.sequence(F.lit(1), F.length(text) - (n - 1))
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(at, lambda i: F.substr(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def _beginnings(word: Column) -> Column:
    return F.when(F.length(word) > 0, F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.substr(word, F.lit(1), i))).otherwise(F.array().cast("array<string>"))


def best_matches(wanted: DataFrame, index: DataFrame, key: str = "link", author: str = "pope", title: str = "title") -> DataFrame:
    """For each wanted row the link of its author with the highest score: ``url``, ``score``; the first in the index wins ties.

    A match needs a score of 2, or 1 if the title has one word; rows without a match are left out.  Equal titles, and
    equal texts of an author, are compared once.  A title meets only texts that share a word with it other than the word
    of it that most texts have, and texts that hold the rarest run of characters of it.  What scores lower than these, one
    common word or its beginning alone, needs only the first such text, which is an aggregate.  Texts are a line long: a row
    is made for each run of characters in them.
    """
    left = wanted.select(F.col(key).alias("_key"), F.col(author).alias("_author"), normal_title(F.col(title)).alias("_title"))
    titles = left.filter("_author is not null").select("_author", "_title").distinct().withColumn("_words", title_words(F.col("_title"))).filter(F.size("_words") > 0)
    titles = titles.withColumn("_first", F.get(F.split("_title", " "), F.lit(0)))
    right = index.select(F.col(author).alias("_author"), "pos", "url", normal_title(F.col("text")).alias("_text")).filter("_author is not null and _text is not null")
    # The first place is the greatest when turned over.
    right = right.groupBy("_author", "_text").agg(F.max(F.struct((-F.col("pos")).alias("p"), "url")).alias("_at"))
    right = right.withColumn("_text_words", title_words(F.col("_text")))

    def keyed(kind: str, keys: Column) -> Column:
        return F.transform(keys, lambda k: F.concat(F.lit(kind), k))

    # Keys of texts, and in how many texts of the author each stands.
    keys = F.concat(keyed("w", F.col("_text_words")), *[keyed(str(n), _runs(F.col("_text"), n)) for n in RUNS])
    texts = right.select("*", F.explode(keys).alias("_by"))
    often = texts.groupBy("_author", "_by").agg(F.count("*").alias("_n"))
    run = F.when(F.length("_title") >= RUNS[1], keyed(str(RUNS[1]), _runs(F.col("_title"), RUNS[1]))).otherwise(keyed(str(RUNS[0]), _runs(F.col("_title"), RUNS[0])))
    own = titles.select("*", F.explode(F.concat(keyed("w", F.col("_words")), run)).alias("_by"))
    own = own.join(often, ["_author", "_by"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    word = F.col("_by").startswith("w")
    top, rare = F.max(F.when(word, F.struct("_n", "_by"))), F.min(F.when(~word, F.struct("_n", "_by")))
    titles = own.groupBy("_author", "_title", "_first", "_words").agg(top.alias("_top"), rare.alias("_rare"))
    titles = titles.withColumns({"_top": F.col("_top._by"), "_rare": F.when(F.col("_rare._n") > 0, F.col("_rare._by"))})

    # Two common words or more, or the whole title: these pairs are scored.
    asks = F.array_compact(F.concat(F.array_remove(keyed("w", F.col("_words")), F.col("_top")), F.array("_rare")))
    s = score(F.col("_title"), F.col("_words"), F.col("_text"), F.col("_text_words"))
    pairs = titles.select("*", F.explode(asks).alias("_by")).join(texts, ["_author", "_by"]).select("_author", "_title", s.alias("score"), "_at")

    # Less than that: the first text with the beginning and the word, with the beginning, or with the word.
    begin = right.select("_author", "_at", "_text_words", F.explode(_beginnings(F.get(F.split("_text", " "), F.lit(0)))).alias("_first"))
    both = begin.select("_author", "_first", "_at", F.explode(keyed("w", F.col("_text_words"))).alias("_top"))
    words = texts.filter(F.col("_by").startswith("w")).select("_author", F.col("_by").alias("_top"), "_at")
    firsts = None
    for value, rows, by in ((4, both, ["_author", "_first", "_top"]), (3, begin, ["_author", "_first"]), (1, words, ["_author", "_top"])):
        found = titles.join(rows.groupBy(*by).agg(F.max("_at").alias("_at")), by).select("_author", "_title", F.lit(value).alias("score"), "_at")
        firsts = found if firsts is None else firsts.unionByName(found)

    scored = pairs.filter("score > 0").unionByName(firsts)
    best = scored.groupBy("_author", "_title").agg(F.max(F.struct("score", "_at")).alias("b"))
    good = (F.col("b.score") >= 2) | ((F.size(title_words(F.col("_title"))) == 1) & (F.col("b.score") >= 1))
    best = best.filter(good).select("_author", "_title", F.col("b._at.url").alias("url"), F.col("b.score").alias("score"))
    return left.join(best, ["_author", "_title"]).select(F.col("_key").alias(key), "url", "score")


def resolve(wanted: DataFrame, index: DataFrame, overrides: DataFrame, key: str = "link") -> DataFrame:
    """``url`` and ``method``: a manual override, else the best match, else null."""
    manual = overrides.select(F.col("link").alias(key), F.col("url").alias("_manual"))
    fuzzy = best_matches(wanted, index, key).select(key, F.col("url").alias("_fuzzy"))
    out = wanted.join(manual, key, "left").join(fuzzy, key, "left")
    method = F.when(F.col("_manual").isNotNull(), "manual").when(F.col("_fuzzy").isNotNull(), "title_match")
    return out.withColumns({"url": F.coalesce("_manual", "_fuzzy"), "method": method}).drop("_manual", "_fuzzy")


def first_by(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in the given order: an aggregate, so a task sends one row for each key it has."""
    return _end_by(df, keys, F.min_by, order)


def last_by(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    return _end_by(df, keys, F.max_by, order)


def _end_by(df: DataFrame, keys: list[str], end, order) -> DataFrame:
    by = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{i}") for i, c in enumerate(order)])
    return df.groupBy(*keys).agg(end(F.struct(*[F.col(f"`{c}`") for c in df.columns]), by).alias("_row")).select("_row.*")
