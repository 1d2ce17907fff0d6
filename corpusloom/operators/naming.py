"""Names for documents: unique stems in input order, and numbers by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.scalars import ddmmyyyy, file_part, url_stem


def base_stem(date: Column, author: Column, title: Column, strip_html: bool = False) -> Column:
    return F.concat_ws("_", ddmmyyyy(date), file_part(author, strip_html=strip_html), file_part(title, strip_html=strip_html))


#: Rows of a base name up to which a task numbers them by itself.
MOST_ROWS = 1_000_000


def unique_stems(df: DataFrame, pos: str = "row_pos", date: str = "published_date", author: str = "pope", title: str = "title", link: str = "link", strip_html: bool = False, most: int = MOST_ROWS) -> DataFrame:
    """Adds ``stem``: the first row of a base name has it, later ones get the stem of their link and a number.

    ``pos`` is different in every row.  Rows are named in its order, and no two get one name: numbers count from 2 for each
    base and link stem, past names that an earlier row has, whether as its base or made up (:func:`repair`).  Where no base
    has over ``most`` rows they are numbered where they meet, in one exchange; else by ranges of the sorted names, so a name
    that very many rows share is no single task.
    """
    slug = file_part(url_stem(F.col(link)), strip_html=strip_html)
    named = df.withColumns({"_base": base_stem(F.col(date), F.col(author), F.col(title), strip_html), "_slug": slug})
    # A row for each base and link stem says how large a base is, and whether a made-up name can be met at all.
    from corpusloom.sources.files import settle

    keys = settle(named.groupBy("_base", "_slug").count())
    largest = keys.groupBy("_base").agg(F.sum("count").alias("n")).agg(F.max("n")).first()[0] or 0
    numbered = _by_window(named, pos) if largest <= most else _by_ranges(named, pos)
    stem = F.when(F.col("_nth").isNull(), F.col("_base")).otherwise(made_up(F.col("_nth") + 1))
    numbered = numbered.withColumn("stem", stem).drop("_nth")
    return (repair(numbered, pos) if _may_meet(keys) else numbered).drop("_base", "_slug")


def _may_meet(keys: DataFrame) -> bool:
    """Whether two bases and link stems make up the same names, or a base looks like a name made up for another."""
    starts = keys.select(F.concat_ws("_", "_base", "_slug").alias("_start"))
    like = keys.filter(F.col("_base").rlike("_[0-9]+$")).select(F.regexp_extract("_base", "^(.*)_[0-9]+$", 1).alias("_start")).distinct()
    return not (starts.groupBy("_start").count().filter("count > 1").isEmpty() and like.join(sorted_side(starts), "_start", "left_semi").isEmpty())


def sorted_side(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the rows: never sent whole, though Spark takes names put together from narrow columns for small."""
    return df.hint("merge")


def made_up(number: Column) -> Column:
    return F.concat_ws("_", "_base", "_slug", number.cast("string"))


def _by_window(named: DataFrame, pos: str) -> DataFrame:
    """Adds ``_nth``: the place of a row among those of its base and slug, without the first of its base, which has null."""
    first = F.col(pos) == F.min(pos).over(Window.partitionBy("_base"))
    # Both windows are dealt by the base.
    nth = F.row_number().over(Window.partitionBy("_base", "_slug", "_first").orderBy(pos))
    return named.withColumn("_first", first).withColumn("_nth", F.when(~F.col("_first"), nth)).drop("_first")


def _by_ranges(named: DataFrame, pos: str) -> DataFrame:
    least = named.groupBy("_base").agg(F.min(pos).alias("_least"), F.count("*").alias("_rows"))
    later = named.select("_base", "_slug", pos).join(sorted_side(least.filter("_rows > 1")), "_base").filter(F.col(pos) > F.col("_least")).select("_base", "_slug", pos)
    nth = nth_in_key(later, ["_base", "_slug"], pos, "_nth").select(F.col(pos).alias("_pos"), "_nth")
    return named.join(sorted_side(nth), F.col(pos) == F.col("_pos"), "left").drop("_pos")


def repair(named: DataFrame, pos: str, most_rounds: int = 100) -> DataFrame:
    """No two rows of one name: each has the first of its candidates (base, then numbers from 2) that no row before it has.

    In a round every row looks at the names that rows before it have just now; names up to the first wrong one stay as they
    are, so the names that a round no longer changes are the ones that naming row by row would give.  Without a clash nothing
    is done but to look for one.
    """
    from corpusloom.sources.files import settle

    def clash(x: DataFrame) -> DataFrame:
        risky = x.filter((F.col("stem") != F.col("_base")) | F.col("_base").rlike("_[0-9]+$"))
        return risky.groupBy("stem").count().filter("count > 1")

    if clash(named).isEmpty():
        return named
    now = settle(named.select(pos, "_base", "_slug", "stem"))
    for _ in range(most_rounds):
        # Names that a row may meet: the least place at which each stands, and the next one, for the row's own does not count.
        taken = now.groupBy(F.col("stem").alias("_name")).agg(F.min(pos).alias("_at"))
        others = taken.join(sorted_side(now).select(F.col(pos).alias("_at"), F.col("_base").alias("_of_base"), F.col("_slug").alias("_of_slug"), F.col("stem").alias("_of")), "_at")
        # A base is taken if the first to have this name stands before the row.
        based = now.join(sorted_side(taken), F.col("_base") == F.col("_name")).select(pos, "_base", "_slug", "stem", (F.col("_at") < F.col(pos)).alias("_taken"))
        base_free = now.join(sorted_side(taken), F.col("_base") == F.col("_name"), "left_anti").select(pos, "_base", "_slug", "stem", F.lit(False).alias("_taken"))
        rows = based.unionByName(base_free)
        # Numbers of a base and slug that rows of others have, and since when.
        prefix, number = F.regexp_extract("_name", "^(.*)_[0-9]+$", 1), F.regexp_extract("_name", "_([1-9][0-9]{0,17})$", 1)
        numbers = others.select(prefix.alias("_prefix"), F.when(number != "", number.cast("long")).alias("_number"), "_at", "_of_base", "_of_slug", "_of").filter("_number >= 2")
        keys = rows.filter("_taken").select("_base", "_slug").distinct().withColumn("_prefix", F.concat_ws("_", "_base", "_slug"))
        foreign = keys.join(sorted_side(numbers), "_prefix").filter((F.col("_base") != F.col("_of_base")) | (F.col("_slug") != F.col("_of_slug")) | (F.col("_of") == F.col("_of_base")))
        blocked = foreign.groupBy("_base", "_slug").agg(F.sort_array(F.collect_list(F.struct("_number", "_at"))).alias("_blocked"))
        later = _nth_of(rows.filter("_taken"), pos).join(sorted_side(blocked), ["_base", "_slug"], "left")
        # Each number that is taken and not above the row's moves it on by one.
        free = F.aggregate(
            F.coalesce("_blocked", F.array().cast("array<struct<_number:bigint,_at:bigint>>")), (F.col("_nth") + 1).cast("long"),
            lambda n, x: F.when((x["_number"] <= n) & (x["_at"] < F.col(pos)), n + 1).otherwise(n),
        )
        new = later.select(pos, "_base", "_slug", F.concat_ws("_", "_base", "_slug", free.cast("string")).alias("_new"), "stem")
        new = settle(new.unionByName(rows.filter("not _taken").select(pos, "_base", "_slug", F.col("_base").alias("_new"), "stem")))
        changed = new.filter("_new <> stem").limit(1).count()
        now = new.select(pos, "_base", "_slug", F.col("_new").alias("stem"))
        if not changed:
            return named.drop("stem").join(sorted_side(now).select(F.col(pos).alias("_pos"), "stem"), F.col(pos) == F.col("_pos")).drop("_pos")
    raise RuntimeError(f"names did not settle in {most_rounds} rounds")


def _nth_of(rows: DataFrame, pos: str) -> DataFrame:
    return nth_in_key(rows, ["_base", "_slug"], pos, "_nth")


def nth_in_key(df: DataFrame, keys: list[str], pos: str, out: str) -> DataFrame:
    """Numbers from 1 in each key by ``pos``, which is different in every row: ranges are numbered, then offset by what stands before them."""
    from corpusloom.sources.files import settle

    ranged = settle(df.repartitionByRange(*keys, pos).withColumn("_part", F.spark_partition_id()))
    own = ranged.withColumn(out, F.row_number().over(Window.partitionBy("_part", *keys).orderBy(pos)))
    sizes = ranged.groupBy("_part", *keys).count()
    before = F.sum("count").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # Keys that go on from one range to the next: no more than there are ranges.
    goes_on = sizes.withColumn("_before", before).filter("_before > 0").drop("count")
    return own.join(F.broadcast(goes_on), ["_part", *keys], "left").withColumn(out, F.col(out) + F.coalesce("_before", F.lit(0))).drop("_part", "_before")


def clashes(named: DataFrame) -> DataFrame:
    """Stems that stand more than once; :func:`unique_stems` leaves none."""
    return named.groupBy("stem").count().filter("count > 1")


def number_by_name(df: DataFrame, name: str, out: str = "id") -> DataFrame:
    """Numbers from 1 in the order of names, without a window over all rows: ranges are sorted, then offset by their sizes."""
    ranged = df.repartitionByRange(name).sortWithinPartitions(name).withColumn("_part", F.spark_partition_id())
    from corpusloom.sources.files import settle

    ranged = settle(ranged.withColumn("_row", F.monotonically_increasing_id() - F.shiftleft(F.col("_part").cast("bigint"), 33)))
    sizes = ranged.groupBy("_part").count()  # a row for each range
    before = sizes.withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    return ranged.join(F.broadcast(before), "_part").withColumn(out, F.col("_before") + F.col("_row") + 1).drop("_part", "_row", "_before")
