"""Enrichment reports merged onto a catalog, and counts of what was found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import extract
from corpusloom.functions.scalars import text_or_empty, theme_bucket
from corpusloom.operators.match import first_by

#: Columns of a catalog in their order, columns that enrichment sets, order of the tiers and of buckets.
BASE_COLUMNS = ("pope", "title", "subtitle", "published_date", "doc_type", "format", "link", "source", "pope_url", "notes")
ANALYSIS_COLUMNS = ("category", "summary", "reflective_saturation", "reflective_density", "prescriptive_saturation", "prescriptive_density")
TIERS = ("gemini", "perplexity", "deep-research")
BUCKETS = ("Social", "Mixed", "Mixed-variant", "Spiritual", "empty", "other")


def ordered_columns(columns: list[str]) -> list[str]:
    """Base columns that are there, then unknown ones as they stand, then all enrichment columns."""
    if not columns:
        return [*BASE_COLUMNS, *ANALYSIS_COLUMNS]
    known = set(BASE_COLUMNS) | set(ANALYSIS_COLUMNS)
    return [c for c in BASE_COLUMNS if c in columns] + [c for c in columns if c not in known] + list(ANALYSIS_COLUMNS)


def report_keys(name: Column) -> Column:
    """Stems a report file can stand for, with the priority of each: ``run-stem.md``, ``run-stem.md.md``, ``stem.md``."""
    def key(pattern: str, priority: int) -> Column:
        stem = F.regexp_extract(name, pattern, 1)
        return F.when(stem != "", F.struct(stem.alias("stem"), F.lit(priority).alias("priority")))

    return F.array_compact(F.array(key(r"^run-(.+)\.md$", 1), key(r"^run-(.+)\.md\.md$", 2), key(r"^(.+)\.md$", 3)))


def reports_by_stem(files: DataFrame, name: str = "name") -> DataFrame:
    """The report of each stem: of its possible names the one of least priority."""
    keyed = files.withColumn("_key", F.explode(report_keys(F.col(name)))).select("*", "_key.*").drop("_key")
    return first_by(keyed, ["stem"], "priority", name)


def theme_fields(reports: DataFrame, text: str = "text") -> DataFrame:
    return reports.select("stem", extract.key_theme(F.col(text)).alias("category"), extract.summary(F.col(text)).alias("summary"))


def first_tier(reports: DataFrame, text: str = "text", tiers: tuple[str, ...] = TIERS) -> DataFrame:
    """For each stem the gradient of the first tier that has a valid one that is not empty: ``stem, tier, block``, whole.

    ``reports`` has ``stem, tier`` and the text, a row for each stem and tier.
    """
    rank = F.array_position(F.array(*map(F.lit, tiers)), F.col("tier"))
    valid = reports.select("stem", "tier", rank.alias("_rank"), extract.gradient_json(F.col(text)).alias("block"))
    valid = valid.filter(F.col("block").isNotNull() & ~F.col("block").rlike(r"^\{\s*\}$") & (F.col("_rank") > 0))
    best = valid.groupBy("stem").agg(F.min(F.struct("_rank", "tier", "block")).alias("b"))
    return best.select("stem", "b.tier", "b.block")


def first_tier_by_turns(reports: DataFrame, stems: DataFrame, text: str = "text", tiers: tuple[str, ...] = TIERS) -> tuple[DataFrame, dict[str, int]]:
    """As :func:`first_tier`, for ``stems``; a tier is parsed only for stems that the tiers before have left open.

    What is left open after a tier is written down, and the next tier's reports are cut to it before any text is parsed.  Returns the
    rows and how many reports of each tier were parsed, observed on their way to the parser; a tier after the last open
    stem is not read.
    """
    from corpusloom.sources.files import settle

    left, found, parsed = settle(stems.select("stem").distinct()), None, {}
    for tier in tiers:
        if left.isEmpty():
            break
        watch = Observation()
        # The observation also keeps the parser's filter from moving before the join.
        own = reports.filter(F.col("tier") == tier).select("stem", "tier", text).join(left, "stem", "left_semi").observe(watch, F.count("*").alias("n"))
        block = extract.gradient_json(F.col(text))
        valid = own.select("stem", "tier", block.alias("block")).filter(F.col("block").isNotNull() & ~F.col("block").rlike(r"^\{\s*\}$"))
        best = settle(valid.groupBy("stem").agg(F.min(F.struct("tier", "block")).alias("b")).select("stem", "b.tier", "b.block"))
        parsed[tier] = watch.get["n"]
        found = best if found is None else found.unionByName(best)
        left = settle(left.join(best, "stem", "left_anti"))
    if found is None:
        found = reports.sparkSession.createDataFrame([], "stem string, tier string, block string")
    return found, parsed


def enrich(catalog: DataFrame, themes: DataFrame, gradients: DataFrame) -> DataFrame:
    """Left joins on the stem; all six columns are set anew, to empty where there is no report."""
    g = gradients.select("stem", F.col("tier").alias("_tier"), extract.gradient(F.col("block")).alias("_g")).select("stem", "_tier", "_g.*")
    keep = catalog.drop(*ANALYSIS_COLUMNS)
    joined = keep.join(themes.withColumn("_has_report", F.lit(True)), "stem", "left").join(g, "stem", "left")
    out = joined.withColumns({c: text_or_empty(c) for c in ANALYSIS_COLUMNS})
    return out.withColumn("_has_report", F.coalesce("_has_report", F.lit(False)))


def projected(enriched: DataFrame) -> DataFrame:
    return enriched.select(*ordered_columns([c for c in enriched.columns if not c.startswith("_") and c != "stem"]))


def has_any() -> Column:
    """A saturation is there; a density alone does not count."""
    return (F.col("reflective_saturation") != "") | (F.col("prescriptive_saturation") != "")


def has_full() -> Column:
    out = F.lit(True)
    for c in ANALYSIS_COLUMNS[2:]:
        out = out & (F.col(c) != "")
    return out


def counters(tiers: tuple[str, ...] = TIERS) -> list[Column]:
    """Counts of an enriched catalog; a tier counts only where a saturation is there."""
    return [
        F.count("*").alias("rows"),
        F.count_if(F.col("category") != "").alias("category"),
        F.count_if(F.col("summary") != "").alias("summary"),
        F.count_if(has_any()).alias("gradients"),
        F.count_if(has_full()).alias("gradients_full"),
        *[F.count_if(has_any() & (F.col("_tier") == t)).alias("gradients_" + t.replace("-", "_")) for t in tiers],
        F.count_if(~F.col("_has_report")).alias("missing_reports"),
    ]


def coverage(enriched: DataFrame, tiers: tuple[str, ...] = TIERS) -> DataFrame:
    """One row of counts."""
    return enriched.agg(*counters(tiers))


def observed(enriched: DataFrame, tiers: tuple[str, ...] = TIERS) -> tuple[DataFrame, Observation]:
    """The catalog, and what is counted of it while it is written: the counts of :func:`coverage`, and for each bucket ``total_`` and ``full_``.

    The observation has its counts when the first action on the catalog is over; rows are read once for both.
    """
    bucket = theme_bucket(F.col("category"))
    by = [c for b in BUCKETS for c in (F.count_if(bucket == b).alias(f"total_{b}"), F.count_if((bucket == b) & has_full()).alias(f"full_{b}"))]
    watch = Observation("coverage")
    return enriched.observe(watch, *counters(tiers), *by), watch


def observed_buckets(counts: dict) -> list[tuple[int, str, int, int]]:
    """``pos, bucket, total, gradients_full`` of buckets that are there, from what was observed."""
    return [(i, b, counts[f"total_{b}"], counts[f"full_{b}"]) for i, b in enumerate(BUCKETS, 1) if counts[f"total_{b}"]]


def by_bucket(enriched: DataFrame) -> DataFrame:
    """Rows and full gradients for each bucket of themes that is there, in the fixed order: ``pos, bucket, total, gradients_full``."""
    pos = F.array_position(F.array(*map(F.lit, BUCKETS)), F.col("bucket")).cast("int")
    grouped = enriched.groupBy(theme_bucket(F.col("category")).alias("bucket")).agg(F.count("*").alias("total"), F.count_if(has_full()).alias("gradients_full"))
    return grouped.select(pos.alias("pos"), "bucket", "total", "gradients_full").orderBy("pos")


def domain(spark: SparkSession, name: str, values: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{name} string, pos int")
