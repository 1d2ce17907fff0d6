"""Queries on the driver's tables, one or more for each operator, and SQL for those that SQL can express.

The tables hold no reports, catalogs or logs, so the queries put such texts together from their columns, in the same
way in Spark and in SQL.
"""

from __future__ import annotations

import functools
import os

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import extract, regex_html, scalars
from corpusloom.functions import html as html_functions
from corpusloom.operators import catalog, match, merge, naming, prompt, provider, recover, work_queue
from corpusloom.session import bound_batches
from corpusloom.sources import files

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
NOW = "2026-01-01T00:00:00+00:00"


def query(sql: str | None = None):
    def add(f):
        @functools.wraps(f)
        def bounded(spark: SparkSession, d: str) -> DataFrame:
            bound_batches(spark)
            return f(spark, d)

        QUERIES[f.__name__] = bounded
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# HTML -----------------------------------------------------------------------------------------------------------

@query(r"""SELECT page_id, length(regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1)) AS main_chars,
  html LIKE '%<article%' AS has_main FROM pages""")
def html_main_extract(spark, d):
    return t(spark, d, "pages").select("page_id", F.length(regex_html.article(F.col("html"))).cast("bigint").alias("main_chars"), F.col("html").contains("<article").alias("has_main"))


_NOISE_SQL = "html"
for _tag in html_functions.NOISE_TAGS:
    _NOISE_SQL = f"regexp_replace({_NOISE_SQL}, '(?is)<{_tag}[ >].*?</{_tag}>', ' ', 'g')"


@query(rf"""SELECT page_id, trim(regexp_replace(regexp_replace({_NOISE_SQL}, '(?s)<!--.*?-->|<[^>]*>', ' ', 'g'), '[\s]+', ' ', 'g')) AS text FROM pages""")
def strip_noise_text(spark, d):
    return t(spark, d, "pages").select("page_id", regex_html.plain(regex_html.without_noise(F.col("html"))).alias("text"))


@query()
def html_markdown_body(spark, d):
    """Content of each page as markdown, or why there is none."""
    return t(spark, d, "pages").select("page_id", html_functions.page_body(F.col("html"), F.col("url")).alias("b")).select("page_id", "b.*")


@query()
def html_simple_body(spark, d):
    return t(spark, d, "pages").select("page_id", html_functions.simple_body(F.col("html")).alias("b")).select("page_id", "b.*")


@query()
def html_link_scrape(spark, d):
    """Links of each page; the pages' own relative links are made ones to ``.html`` pages first."""
    pages = t(spark, d, "pages")
    html = F.regexp_replace("html", r'href="(/[^"]*)"', 'href="$1.html"')
    links = pages.select("page_id", F.posexplode(html_functions.html_links(html, F.col("url"))).alias("pos", "link"))
    return match.first_by(links.select("page_id", "pos", "link.text", "link.url"), ["page_id", "url"], "pos")


@query(r"""SELECT page_id, host FROM (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host, row_number() OVER (
  PARTITION BY lower(regexp_extract(u, '^([^/]*)', 1)) || substr(u, length(regexp_extract(u, '^([^/]*)', 1)) + 1) ORDER BY page_id) AS n
  FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM pages)) WHERE n = 1""")
def url_dedupe(spark, d):
    kept = catalog.dedupe_urls(t(spark, d, "pages"), "url", "page_id")
    return kept.select("page_id", F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"))


@query(r"""SELECT page_id, CASE WHEN stem = '' THEN 'doc' ELSE stem END AS stem FROM (SELECT page_id,
  regexp_replace(regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1), '^(.+)\.[^.]+$', '\1') AS stem FROM pages)""")
def url_stem(spark, d):
    return t(spark, d, "pages").select("page_id", scalars.url_stem(F.col("url")).alias("stem"))


@query(r"""SELECT host, count(*) AS pages, min(page_id) AS first_page FROM (
  SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host, length(regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1)) AS n FROM pages)
  WHERE n >= 100 GROUP BY host""")
def page_hosts(spark, d):
    pages = t(spark, d, "pages").select("page_id", F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), F.length(regex_html.article(F.col("html"))).alias("n"))
    return pages.filter("n >= 100").groupBy("host").agg(F.count("*").alias("pages"), F.min("page_id").alias("first_page"))


# Names ----------------------------------------------------------------------------------------------------------

def day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


@query("SELECT o_orderkey, strftime(o_orderdate, '%d%m%Y') AS date_part FROM orders")
def date_stem(spark, d):
    return t(spark, d, "orders").select("o_orderkey", scalars.ddmmyyyy(day("o_orderdate")).alias("date_part"))


@query(r"""SELECT doc_id, rtrim(substr(trim(regexp_replace(regexp_replace(text, '[\\/:*?"<>|]', '', 'g'), '\s+', ' ', 'g')), 1, 100), ' .') AS name FROM documents""")
def filename_sanitize(spark, d):
    return t(spark, d, "documents").select("doc_id", scalars.file_part(F.col("text")).alias("name"))


_NAMED = r"""SELECT o_orderkey, strftime(o_orderdate, '%d%m%Y') || '_' || o_orderpriority || '_' || c_mktsegment AS base,
  o_orderstatus || CAST(o_orderkey % 3 AS VARCHAR) AS slug FROM orders JOIN customer ON o_custkey = c_custkey"""


@query(f"""SELECT o_orderkey, CASE WHEN k = 1 THEN base ELSE base || '_' || slug || '_' || CAST(n + 1 AS VARCHAR) END AS stem FROM (
  SELECT *, row_number() OVER (PARTITION BY base, slug, k = 1 ORDER BY o_orderkey) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY base ORDER BY o_orderkey) AS k FROM ({_NAMED})))""")
def collision_naming(spark, d):
    rows = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("row_pos"), day("o_orderdate").alias("published_date"), F.col("o_orderpriority").alias("pope"), F.col("c_mktsegment").alias("title"),
        F.concat(F.lit("https://x.example/"), "o_orderstatus", (F.col("o_orderkey") % 3).cast("string"), F.lit(".html")).alias("link"),
    )
    return naming.unique_stems(rows).select(F.col("row_pos").alias("o_orderkey"), "stem")


@query("SELECT c_name, row_number() OVER (ORDER BY c_name) AS id FROM customer")
def number_by_name(spark, d):
    return naming.number_by_name(t(spark, d, "customer").select("c_name"), "c_name").select("c_name", "id")


# Reports --------------------------------------------------------------------------------------------------------

THEMES = ("Social", "Spiritual", "Mixed", "Spiritual | Mixed", "mixed", "Not stated", "")
_THEME_SQL = "list_value(" + ", ".join(f"'{x}'" for x in THEMES) + ")[CAST(doc_id % 7 AS INT) + 1]"
_REPORT_SQL = rf"""'---' || chr(10) || 'source_file: f' || doc_id || '.md' || chr(10) || 'pass: step: 3' || chr(10) || '---' || chr(10) || chr(10) ||
  '- **Key theme:** ' || {_THEME_SQL} || chr(10) || '- **Summary:** ' || lang || ' from ' || source || '  ' || chr(10) || '- **Response to:** x' || chr(10)"""


def theme_report(themes: tuple[str, ...] = THEMES) -> Column:
    theme = F.element_at(F.array(*map(F.lit, themes)), (F.col("doc_id") % len(themes)).cast("int") + 1)
    return F.concat(
        F.lit("---\nsource_file: f"), F.col("doc_id").cast("string"), F.lit(".md\npass: step: 3\n---\n\n- **Key theme:** "), theme,
        F.lit("\n- **Summary:** "), "lang", F.lit(" from "), "source", F.lit("  \n- **Response to:** x\n"),
    )


def theme_reports(spark, d) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("stem"), theme_report().alias("text"), "lang", "source")


_KEY = r"trim(regexp_extract(report, '(?im)^\s*-\s*\*\*Key theme:\*\*\s*(.+?)\s*$', 1))"
_SUM = r"trim(regexp_extract(report, '(?ims)^\s*-\s*\*\*Summary:\*\*\s*(.+?)\s*$', 1))"


@query(f"SELECT doc_id, {_KEY} AS category, {_SUM} AS summary FROM (SELECT doc_id, {_REPORT_SQL} AS report FROM documents)")
def theme_extract(spark, d):
    return theme_reports(spark, d).select("doc_id", extract.key_theme(F.col("text")).alias("category"), extract.summary(F.col("text")).alias("summary"))


_BUCKET = """CASE WHEN trim(category) = '' THEN 'empty' WHEN trim(category) IN ('Social', 'Spiritual', 'Mixed') THEN trim(category)
  WHEN contains(category, 'Mixed') THEN 'Mixed-variant' ELSE 'other' END"""
_FIELDS_SQL = f"SELECT doc_id, {_KEY} AS category, {_SUM} AS summary FROM (SELECT doc_id, {_REPORT_SQL} AS report FROM documents)"


@query(f"SELECT bucket, count(*) AS total FROM (SELECT {_BUCKET} AS bucket FROM ({_FIELDS_SQL})) GROUP BY bucket")
def theme_bucket_stats(spark, d):
    themes = theme_reports(spark, d).select(extract.key_theme(F.col("text")).alias("category"))
    return themes.groupBy(scalars.theme_bucket(F.col("category")).alias("bucket")).agg(F.count("*").alias("total"))


#: Shapes that a gradient takes, some of them invalid; %d is the document's number modulo 10.
SHAPES = (
    '{"reflective": {"saturation": %d, "density": -12}, "prescriptive": {"saturation": 4, "density": 5}}',
    '{"prospective": {"saturation": %d, "density": 5}}',
    '{"prescriptive": {}, "prospective": {"saturation": %d}}',
    '{"reflective_saturation": %d, "prescriptive_density": 2}',
    '{"reflective": {"saturation": %d,,}}',
    "{}",
)


def _gradient_sql(n: str) -> str:
    shape = "list_value(" + ", ".join("'" + s + "'" for s in SHAPES) + f")[CAST(({n}) % 6 AS INT) + 1]"
    return f"'# T' || chr(10) || '## Gradients' || chr(10) || '```json' || chr(10) || replace({shape}, '%d', CAST(({n}) % 10 AS VARCHAR)) || chr(10) || '```' || chr(10)"


def gradient_report(n: Column) -> Column:
    shape = F.element_at(F.array(*map(F.lit, SHAPES)), (n % 6).cast("int") + 1)
    return F.concat(F.lit("# T\n## Gradients\n```json\n"), F.replace(shape, F.lit("%d"), (n % 10).cast("string")), F.lit("\n```\n"))


_BLOCK = r"regexp_extract(report, '(?is)## Gradients\s*\n+(?:.*?\n+)?```json\s*\n(\{.*?\})\s*\n```', 1)"


def _valid_sql(source: str) -> str:
    return f"SELECT *, CASE WHEN json_valid({_BLOCK}) THEN {_BLOCK} END AS block FROM ({source})"


def _axis_sql(axis: str, part: str) -> str:
    names = extract.AXES[axis]
    cases = []
    for n in names:
        cases.append(f"WHEN json_type(block, '$.{n}') = 'OBJECT' THEN json_extract_string(block, '$.{n}.{part}')")
        cases.append(f"WHEN coalesce(json_extract_string(block, '$.{n}_saturation'), json_extract_string(block, '$.{n}_density')) IS NOT NULL THEN json_extract_string(block, '$.{n}_{part}')")
    return f"coalesce(CASE {' '.join(cases)} END, '') AS {axis}_{part}"


_AXES_SQL = ", ".join(_axis_sql(a, p) for a in extract.AXES for p in extract.PARTS)


@query(f"SELECT doc_id, {_AXES_SQL} FROM ({_valid_sql('SELECT doc_id, ' + _gradient_sql('doc_id') + ' AS report FROM documents')})")
def gradient_extract(spark, d):
    docs = t(spark, d, "documents").select("doc_id", extract.gradient_json(gradient_report(F.col("doc_id"))).alias("block"))
    return docs.select("doc_id", extract.gradient(F.col("block")).alias("g")).select("doc_id", "g.*")


def tier_reports(spark, d) -> DataFrame:
    """A report of each tier for some documents: which ones, and of what shape, hangs on the number."""
    docs = t(spark, d, "documents").select("doc_id")
    out = None
    for i, (tier, every) in enumerate(zip(merge.TIERS, (2, 3, 1), strict=True)):
        own = docs.filter(F.col("doc_id") % every == 0).select(F.col("doc_id").cast("string").alias("stem"), F.lit(tier).alias("tier"), gradient_report(F.col("doc_id") + i).alias("text"))
        out = own if out is None else out.unionByName(own)
    return out


_TIERS_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{tier}' AS tier, {i} AS rank, {_gradient_sql(f'doc_id + {i}')} AS report FROM documents WHERE doc_id % {every} = 0"
    for i, (tier, every) in enumerate(zip(merge.TIERS, (2, 3, 1), strict=True))
)
_FIRST_SQL = f"SELECT doc_id, tier, block FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY rank) AS n FROM ({_valid_sql(_TIERS_SQL)}) WHERE block IS NOT NULL AND block <> '{{}}') WHERE n = 1"


@query(f"SELECT CAST(doc_id AS VARCHAR) AS stem, tier, block FROM ({_FIRST_SQL})")
def tier_first_match(spark, d):
    return merge.first_tier(tier_reports(spark, d))


def report_files(spark, d) -> DataFrame:
    """Theme reports under names of all three kinds, some documents with two."""
    base = t(spark, d, "documents").select("doc_id", theme_report().alias("text"))
    first = base.select(F.concat(F.lit("run-"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, ".md.md").otherwise(".md")).alias("name"), "text")
    second = base.filter(F.col("doc_id") % 3 == 0).select(F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("name"), F.lit("- **Key theme:** never\n").alias("text"))
    return first.unionByName(second)


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS stem, category, summary FROM ({_FIELDS_SQL})
  UNION ALL SELECT 'run-' || doc_id, category, summary FROM ({_FIELDS_SQL}) WHERE doc_id % 2 <> 0
  UNION ALL SELECT doc_id || '.md', category, summary FROM ({_FIELDS_SQL}) WHERE doc_id % 2 = 0
  UNION ALL SELECT 'run-' || doc_id || '.md', category, summary FROM ({_FIELDS_SQL}) WHERE doc_id % 2 = 0""")
def report_lookup(spark, d):
    """Every stem a file can stand for, and the report it gets."""
    return merge.theme_fields(merge.reports_by_stem(report_files(spark, d)))


def enriched(spark, d) -> DataFrame:
    docs = t(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("stem"), F.lit("old").alias("category"))
    themes = theme_reports(spark, d).filter(F.col("doc_id") % 5 != 0)
    return merge.enrich(docs, merge.theme_fields(themes), merge.first_tier(tier_reports(spark, d)))


_ENRICHED_SQL = f"""SELECT d.doc_id, coalesce(f.category, '') AS category, coalesce(f.summary, '') AS summary, g.tier, f.doc_id IS NOT NULL AS has_report, {', '.join(f"coalesce(g.{c}, '') AS {c}" for c in merge.ANALYSIS_COLUMNS[2:])}
  FROM documents d LEFT JOIN (SELECT * FROM ({_FIELDS_SQL}) WHERE doc_id % 5 <> 0) f ON d.doc_id = f.doc_id
  LEFT JOIN (SELECT doc_id, tier, {_AXES_SQL} FROM ({_FIRST_SQL})) g ON d.doc_id = g.doc_id"""


@query(f"SELECT doc_id, {', '.join(merge.ANALYSIS_COLUMNS)} FROM ({_ENRICHED_SQL})")
def catalog_enrich(spark, d):
    return merge.projected(enriched(spark, d))


_ANY = "(reflective_saturation <> '' OR prescriptive_saturation <> '')"
_FULL = "(" + " AND ".join(f"{c} <> ''" for c in merge.ANALYSIS_COLUMNS[2:]) + ")"


@query(f"""SELECT count(*) AS rows, count(*) FILTER (category <> '') AS category, count(*) FILTER (summary <> '') AS summary,
  count(*) FILTER {_ANY} AS gradients, count(*) FILTER {_FULL} AS gradients_full,
  {', '.join(f"count(*) FILTER ({_ANY} AND tier = '{x}') AS gradients_{x.replace('-', '_')}" for x in merge.TIERS)},
  count(*) FILTER (NOT has_report) AS missing_reports FROM ({_ENRICHED_SQL})""")
def conditional_stats(spark, d):
    return merge.coverage(enriched(spark, d))


@query(f"""SELECT list_position(list_value({', '.join(f"'{b}'" for b in merge.BUCKETS)}), bucket) AS pos, bucket, count(*) AS total, count(*) FILTER {_FULL} AS gradients_full
  FROM (SELECT *, {_BUCKET} AS bucket FROM ({_ENRICHED_SQL})) GROUP BY bucket""")
def bucket_order(spark, d):
    return merge.by_bucket(enriched(spark, d))


@query(rf"""SELECT doc_id, 'f' || doc_id || '.md' AS source_file, 'step: 3' AS pass FROM documents""")
def front_matter_map(spark, d):
    r = theme_reports(spark, d)
    return r.select("doc_id", extract.front_value(F.col("text"), "source_file").alias("source_file"), extract.front_value(F.col("text"), "pass").alias("pass"))


@query(f"SELECT doc_id, 'Response to' AS label, 'x' AS value FROM documents UNION ALL SELECT doc_id, 'Summary', summary FROM ({_FIELDS_SQL})")
def bullet_fields(spark, d):
    r = theme_reports(spark, d)
    fields = F.array(*[F.struct(F.lit(x).alias("label"), extract.bullet(F.col("text"), x).alias("value")) for x in ("Response to", "Summary", "Tension")])
    return r.select("doc_id", F.explode(fields).alias("f")).select("doc_id", "f.*").filter("value <> ''")


@query("""SELECT doc_id, list_value('Context', 'Citations')[i] AS heading, list_value(2, 3)[i] AS level, list_value(lang, source)[i] AS body
  FROM documents, (SELECT unnest([1, 2]) AS i)""")
def section_split(spark, d):
    text = F.concat(F.lit("# Title\nintro\n## Context\n"), "lang", F.lit("\n\n### Citations\n"), "source", F.lit("\n"))
    return t(spark, d, "documents").select("doc_id", F.explode(extract.sections(text)).alias("s")).select("doc_id", "s.heading", "s.level", "s.body")


@query("""SELECT doc_id, i AS pos, list_value('media', 'archival')[i + 1] AS source_type, list_value(source, lang)[i + 1] AS citation, CAST(n_chars AS VARCHAR) AS note
  FROM documents, (SELECT unnest([0, 1]) AS i)""")
def citation_parse(spark, d):
    row = lambda kind, c: F.concat(F.lit(f"| {kind} | "), c, F.lit(" | "), F.col("n_chars").cast("string"), F.lit(" |\n"))
    text = F.concat(F.lit("### Citations\n| Source Type | Citation | Note |\n| :--- | --- | ---: |\n"), row("media", F.col("source")), row("archival", F.col("lang")))
    cells = t(spark, d, "documents").select("doc_id", F.posexplode(extract.citations(text)).alias("pos", "c"))
    return cells.select("doc_id", "pos", F.col("c")[0].alias("source_type"), F.col("c")[1].alias("citation"), F.col("c")[2].alias("note"))


# Joins, logs ----------------------------------------------------------------------------------------------------

_SUCCESS, _RECOVERED = "SELECT doc_id, quality FROM labels WHERE toxic = 0", "SELECT doc_id, n_chars FROM documents WHERE n_chars > 1500"


@query(f"""SELECT d.doc_id, 'left' AS outcome FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) AND n_chars <= 1500
  UNION ALL SELECT doc_id, 'success' FROM labels WHERE toxic = 0
  UNION ALL SELECT doc_id, 'recovered' FROM documents d WHERE n_chars > 1500 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 0)""")
def anti_recover(spark, d):
    """What is still failed, and successes with what was recovered."""
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("file"), "n_chars")
    labels = t(spark, d, "labels").select(F.col("doc_id").alias("file"), "quality", "toxic")
    recovered = docs.filter("n_chars > 1500")
    left = recover.still_failed(docs, recovered, labels.filter("quality = 1")).select("file", F.lit("left").alias("outcome"))
    both = recover.with_recovered(labels.filter("toxic = 0").select("file"), recovered.select("file"))
    both = both.select("file", F.when(F.coalesce("recovered", F.lit(False)), "recovered").otherwise("success").alias("outcome"))
    return left.unionByName(both).select(F.col("file").alias("doc_id"), "outcome")


@query("""WITH w AS (SELECT *, list_distinct(list_filter(string_split(p_name, ' '), lambda x: length(x) > 2)) AS words FROM part),
  s AS (SELECT a.p_partkey AS link, b.p_partkey AS pos, len(list_intersect(a.words, b.words)) + CASE WHEN contains(b.p_name, a.p_name) THEN 10
    WHEN starts_with(b.p_name, string_split(a.p_name, ' ')[1]) THEN 3 ELSE 0 END AS score, len(a.words) AS n FROM w a JOIN w b ON a.p_brand = b.p_brand)
  SELECT link, 'p' || pos AS url, CAST(score AS INTEGER) AS score FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY score DESC, pos) AS k FROM s WHERE score > 0) WHERE k = 1 AND (score >= 2 OR n = 1)""")
def fuzzy_match(spark, d):
    part = t(spark, d, "part")
    wanted = part.select(F.col("p_partkey").alias("link"), F.col("p_brand").alias("pope"), F.col("p_name").alias("title"))
    index = part.select(F.col("p_brand").alias("pope"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("text"), F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("url"))
    return match.best_matches(wanted, index)


@query("""SELECT p_partkey, list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower(p_type || ' ' || p_name), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: length(x) > 2))) AS words FROM part""")
def title_words(spark, d):
    title = scalars.normal_title(F.concat("p_type", F.lit(" "), "p_name"))
    return t(spark, d, "part").select("p_partkey", F.array_sort(scalars.title_words(title)).alias("words"))


@query("""SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'manual' ELSE 'none' END AS method, CASE WHEN c_nationkey = 3 THEN 'u3' ELSE '' END AS url
  FROM customer WHERE c_nationkey NOT IN (5, 7)""")
def override_lookup(spark, d):
    """Overrides come first, blocked keys go; both sides are small by definition and join by value."""
    overrides = spark.createDataFrame([(3, "u3")], "c_nationkey int, url string")
    rows = t(spark, d, "customer").filter(~F.col("c_nationkey").isin(5, 7)).join(overrides, "c_nationkey", "left")
    return rows.select("c_custkey", F.when(F.col("url").isNotNull(), "manual").otherwise("none").alias("method"), F.coalesce("url", F.lit("")).alias("url"))


@query("""SELECT o_orderkey, CASE WHEN c.c_custkey IS NULL THEN 'still_failed' WHEN c.c_mktsegment = 'MACHINERY' THEN 'skipped' ELSE 'retry' END AS action,
  CASE WHEN c.c_custkey IS NULL THEN 'Row not found in CSV' WHEN c.c_mktsegment = 'MACHINERY' THEN 'index_or_stub_entry' END AS reason
  FROM orders LEFT JOIN (SELECT max(c_custkey) AS c_custkey, c_mktsegment FROM customer GROUP BY c_mktsegment) c
  ON c.c_mktsegment = list_value('MACHINERY', 'BUILDING', 'nowhere')[CAST(o_orderkey % 3 AS INT) + 1]""")
def recover_plan(spark, d):
    """Failed entries looked up in the catalog, whose last row of a link counts."""
    failed = t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("file"), F.element_at(F.array(*map(F.lit, ("MACHINERY", "BUILDING", "nowhere"))), (F.col("o_orderkey") % 3).cast("int") + 1).alias("link"))
    rows = t(spark, d, "customer").select(F.col("c_mktsegment").alias("link"), F.col("c_custkey").alias("row_pos"))
    return recover.plan(failed, rows, ["MACHINERY"]).select(F.col("file").cast("bigint").alias("o_orderkey"), "action", "reason")


@query("SELECT event_type AS outcome, count(*) AS n FROM events GROUP BY 1")
def outcome_counts(spark, d):
    return recover.outcome_counts(t(spark, d, "events").withColumnRenamed("event_type", "outcome"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def runlog_json(spark, d):
    return t(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT o_custkey AS pope, count(*) AS n, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders GROUP BY 1")
def catalog_summary(spark, d):
    return catalog.author_summary(t(spark, d, "orders").select(F.col("o_custkey").alias("pope"), F.col("o_orderdate").alias("published_date")))


@query("""SELECT url, kind FROM (SELECT *, row_number() OVER (PARTITION BY lower(url) ORDER BY k, id) AS n FROM (
  SELECT p_name AS url, 'part' AS kind, 0 AS k, p_partkey AS id FROM part UNION ALL SELECT c_mktsegment, 'customer', 1, c_custkey FROM customer)) WHERE n = 1""")
def union_listings(spark, d):
    a = t(spark, d, "part").select(F.col("p_name").alias("url"), F.lit("part").alias("kind"), F.col("p_partkey").alias("pos"))
    b = t(spark, d, "customer").select(F.col("c_mktsegment").alias("url"), F.lit("customer").alias("kind"), F.col("c_custkey").alias("pos"))
    return catalog.union_listings(a, b).select("url", "kind")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN y < 0 THEN 'before' WHEN y < 1 THEN '1y' WHEN y < 5 THEN '5y' WHEN y < 10 THEN '10y' ELSE 'later' END AS span FROM (
  SELECT l_orderkey, l_linenumber, floor(date_diff('day', o_orderdate, l_shipdate) / 365.25) AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def span_buckets(spark, d):
    rows = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", catalog.span_bucket(F.col("o_orderdate"), F.col("l_shipdate")).alias("span"))


# Queue ----------------------------------------------------------------------------------------------------------

STATES = {"signup": "pending", "click": "in_progress", "view": "complete", "purchase": "skipped", "error": "failed"}
_STATE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATES.items()) + " END"
_DONE_SQL = "(SELECT doc_id FROM documents WHERE octet_length(encode(text)) >= 500)"


def state() -> Column:
    out = None
    for k, v in STATES.items():
        out = F.when(F.col("event_type") == k, v) if out is None else out.when(F.col("event_type") == k, v)
    return out


def items(spark, d) -> DataFrame:
    e = t(spark, d, "events")
    id_ = F.col("event_id").cast("string")
    none = F.lit(None).cast("string")
    return e.select(
        F.col("event_id").alias("id"), F.concat(F.lit("f"), id_, F.lit(".md")).alias("source_file"), F.concat(F.lit("run-f"), id_, F.lit(".md")).alias("report_file"), state().alias("status"),
        F.lit("b0").alias("batch_id"), F.lit("s0").alias("started_at"), F.when(F.col("event_id") % 2 == 0, "c0").alias("completed_at"), F.when(F.col("event_type") == "error", "bad").alias("error"), F.lit("a0").alias("agent_id"),
    )


def present(spark, d) -> DataFrame:
    docs = t(spark, d, "documents")
    return docs.select(F.concat(F.lit("run-f"), F.col("doc_id").cast("string"), F.lit(".md")).alias("report_file"), F.octet_length("text").alias("size"))


@query(f"""SELECT s.status, count(e.event_id) AS n FROM (SELECT unnest([{', '.join(f"'{s}'" for s in work_queue.STATUSES)}]) AS status) s
  LEFT JOIN events e ON {_STATE_SQL} = s.status GROUP BY s.status""")
def queue_status(spark, d):
    return work_queue.histogram(items(spark, d))


@query(f"SELECT count(*) FILTER (s IN ('complete', 'skipped')) AS done, count(*) AS total, round(100.0 * count(*) FILTER (s IN ('complete', 'skipped')) / count(*), 1) AS percent FROM (SELECT {_STATE_SQL} AS s FROM events)")
def queue_progress(spark, d):
    return work_queue.progress(items(spark, d))


@query(f"""SELECT doc_id AS id, CASE WHEN octet_length(encode(text)) >= 500 THEN 'complete' ELSE 'pending' END AS status,
  CASE WHEN octet_length(encode(text)) >= 500 THEN '{NOW}' END AS completed_at FROM documents""")
def queue_init(spark, d):
    sources = t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.lit(".md")).alias("name"))
    return work_queue.init(sources, present(spark, d), F.lit(NOW)).select("id", "status", "completed_at")


@query(f"""SELECT event_id AS id, CASE WHEN hit THEN 'complete' ELSE s END AS status, CASE WHEN hit OR event_type <> 'error' THEN NULL ELSE 'bad' END AS error,
  CASE WHEN event_id % 2 = 0 THEN 'c0' WHEN hit THEN '{NOW}' END AS completed_at FROM (
  SELECT *, {_STATE_SQL} AS s, event_id IN {_DONE_SQL} AND {_STATE_SQL} <> 'complete' AS hit FROM events)""")
def queue_sync(spark, d):
    return work_queue.sync(items(spark, d), present(spark, d), F.lit(NOW)).select("id", "status", "error", "completed_at")


@query(f"""SELECT event_id AS id, CASE WHEN NOT busy THEN s WHEN done THEN 'complete' ELSE 'pending' END AS status, CASE WHEN busy AND NOT done THEN NULL ELSE 'b0' END AS batch_id,
  CASE WHEN event_id % 2 = 0 THEN 'c0' WHEN busy AND done THEN '{NOW}' END AS completed_at FROM (
  SELECT *, {_STATE_SQL} AS s, {_STATE_SQL} = 'in_progress' AS busy, event_id IN {_DONE_SQL} AS done FROM events)""")
def queue_reset_stale(spark, d):
    return work_queue.reset_stale(items(spark, d), present(spark, d), F.lit(NOW)).select("id", "status", "batch_id", "completed_at")


@query(f"""SELECT event_id AS id, CASE WHEN b.i IS NOT NULL THEN 'in_progress' ELSE {_STATE_SQL} END AS status, CASE WHEN b.i IS NOT NULL THEN 'batch-20260101T000000+0000' ELSE 'b0' END AS batch_id
  FROM events LEFT JOIN (SELECT event_id AS i FROM events WHERE {_STATE_SQL} = 'pending' ORDER BY event_id LIMIT 30) b ON b.i = event_id""")
def queue_next_batch(spark, d):
    return work_queue.next_batch(items(spark, d), F.lit(NOW))[0].select("id", "status", "batch_id")


@query(f"""SELECT event_id AS id, CASE WHEN event_id = 7 THEN 'failed' ELSE {_STATE_SQL} END AS status, CASE WHEN event_id = 7 THEN 'unknown error' WHEN event_type = 'error' THEN 'bad' END AS error FROM events""")
def queue_mark(spark, d):
    return work_queue.mark(items(spark, d), 7, "failed", F.lit(NOW)).select("id", "status", "error")


@query(f"SELECT user_id AS id, status FROM (SELECT user_id, {_STATE_SQL} AS status, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def queue_latest(spark, d):
    e = t(spark, d, "events").select(F.col("user_id").alias("id"), "event_id", state().alias("status"))
    return work_queue.latest(e, order=("event_id",)).select("id", "status")


@query(f"SELECT user_id AS id, count(*) AS n_events, max(event_id) AS last_event, arg_max({_STATE_SQL}, event_id) AS status FROM events GROUP BY user_id")
def streaming_queue(spark, d):
    """M*: the queue from its log as a stream, driven over all events there are."""
    from corpusloom.streaming.queue_stream import run_to_end

    shared = files.scratch(spark)
    where = os.path.join(shared, f"queue-{uuid.uuid4().hex}")
    events = _event_stream(spark, d).select(F.col("user_id").alias("id"), "event_id", state().alias("status"))
    return run_to_end(spark, events, f"{where}/rows", f"{where}/state")


#: Events up to an hour before the last one, an item in progress for twelve hours goes back.
_DELAY_MS, _STALE_MS = 3_600_000, 43_200_000
_OLD_SQL = f"(a.status = 'in_progress' AND x.since - a.since >= {_STALE_MS})"
_OK_SQL = f"(x.status <> 'in_progress' OR a.status = 'pending' OR {_OLD_SQL})"
_FIELDS_SQL = "applied := 0::BIGINT, refused := 0::BIGINT, stale := 0::BIGINT"


@query(f"""WITH e AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms, {_STATE_SQL} AS status FROM events), h AS (SELECT max(ms) - {_DELAY_MS} AS upto FROM e),
l AS (SELECT user_id, list_prepend(struct_pack(status := 'pending', since := 0::BIGINT, {_FIELDS_SQL}),
  list(struct_pack(status := status, since := ms, {_FIELDS_SQL}) ORDER BY ms, event_id)) AS es FROM e, h WHERE ms <= upto GROUP BY user_id),
r AS (SELECT user_id, list_reduce(es, lambda a, x: struct_pack(
  status := CASE WHEN {_OK_SQL} THEN x.status WHEN {_OLD_SQL} THEN 'pending' ELSE a.status END, since := CASE WHEN {_OK_SQL} THEN x.since WHEN {_OLD_SQL} THEN a.since + {_STALE_MS} ELSE a.since END,
  applied := a.applied + CASE WHEN {_OK_SQL} THEN 1::BIGINT ELSE 0::BIGINT END, refused := a.refused + CASE WHEN {_OK_SQL} THEN 0::BIGINT ELSE 1::BIGINT END, stale := a.stale + CASE WHEN {_OLD_SQL} THEN 1::BIGINT ELSE 0::BIGINT END)) AS s FROM l)
SELECT user_id AS id, CASE WHEN old THEN 'pending' ELSE s.status END AS status, CASE WHEN old THEN s.since + {_STALE_MS} ELSE s.since END AS since, s.applied AS applied, s.refused AS refused,
  s.stale + CASE WHEN old THEN 1 ELSE 0 END AS stale FROM (SELECT user_id, s, s.status = 'in_progress' AND upto - s.since >= {_STALE_MS} AS old FROM r, h)""")
def streaming_rules(spark, d):
    """M3 to M6: the queue as a stream with rules; events in order of their time, illegal ones refused, stale items put back by a timer."""
    from corpusloom.streaming.queue_rules import run_to_end

    where = os.path.join(files.scratch(spark), f"rules-{uuid.uuid4().hex}")
    # Times without a zone, as they stand.
    ts = F.expr("timestamp_millis(timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts))")
    events = _event_stream(spark, d).select(F.col("user_id").alias("id"), "event_id", ts.alias("ts"), state().alias("status"))
    return run_to_end(spark, events, f"{where}/rows", f"{where}/state", f"{_DELAY_MS} milliseconds", _STALE_MS)


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    name = f"{d}/events.parquet"
    schema = spark.read.parquet(name).schema
    # A stream reads folders; a table may be one file of a folder.
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d) if not _is_folder(spark, name) else spark.readStream.schema(schema).parquet(name)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


# Texts ----------------------------------------------------------------------------------------------------------

@query(r"""SELECT d.doc_id, concat_ws(chr(10), '# ' || lang, '', '---', 'pope: ' || source, 'title: ' || lang, CASE WHEN l.quality IS NOT NULL THEN 'published_date: ' || l.quality END,
  'doc_type: document', 'source: ' || source, '---', '', trim(text), '') AS document FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def document_assemble(spark, d):
    rows = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left")
    row = {"title": F.col("lang"), "subtitle": F.lit(""), "pope": F.col("source"), "published_date": F.col("quality").cast("string"), "doc_type": F.lit("document"), "source": F.col("source")}
    return rows.select("doc_id", prompt.document(row, F.col("text")).alias("document"))


@query(r"""SELECT d.doc_id, concat_ws(chr(10), '# Research request', '', '## Document', '- Pope: ' || source, '- Title: ' || lang, '- Published: Unknown', '- Primary URL: l' || d.doc_id,
  '- Source file: f', '- Step 3 theme report: r', '', 'q' || quality, '', 'template', 'reminder') AS request FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def prompt_assemble(spark, d):
    rows = t(spark, d, "documents").select("doc_id", F.col("source").alias("pope"), F.col("lang").alias("title"), F.lit("").alias("published_date"), F.concat(F.lit("l"), F.col("doc_id").cast("string")).alias("link"), F.lit("f").alias("source_file"))
    themes = t(spark, d, "labels").select("doc_id", F.lit("r").alias("theme_report"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("theme_text"))
    return prompt.research_request(rows, themes, "template", "reminder", "doc_id").select("doc_id", "request")


@query("SELECT doc_id, lang AS title, CAST(n_chars AS VARCHAR) AS published FROM documents")
def query_metadata(spark, d):
    text = F.concat(F.lit("# Request\n\n## Document\n- Title: "), "lang", F.lit("\n- Published: "), F.col("n_chars").cast("string"), F.lit("\n"))
    return t(spark, d, "documents").select("doc_id", extract.query_value(text, "Title").alias("title"), extract.query_value(text, "Published").alias("published"))


@query(f"SELECT f.doc_id FROM documents f WHERE f.doc_id NOT IN (SELECT doc_id FROM ({_FIRST_SQL}))")
def extend_remaining(spark, d):
    """U4: documents without a valid gradient in any tier."""
    themes = t(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("stem"))
    return prompt.remaining(themes, merge.first_tier(tier_reports(spark, d))).select("doc_id")


@query()
def llm_stub(spark, d):
    """V1, V2: calls of a provider; the stub answers from the text alone."""
    return provider.call(t(spark, d, "documents"), "text", "doc_id")


from corpusloom import flow_queries  # noqa: E402, F401  (adds its queries to those above)
