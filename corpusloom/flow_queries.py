"""Queries for files, fetching, HTML trees and providers; pages and files are put together from columns, in the same way in Spark and in SQL.

What is written goes to a folder of its own in the shared one (:func:`files.scratch`) and is read back.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import extract, html, scalars, tables
from corpusloom.operators import catalog, match, merge, naming, provider, work_queue
from corpusloom.operators.queue_store import QueueStore
from corpusloom.plans import flows
from corpusloom.queries import NOW, ORACLES, enriched, query, t, tier_reports
from corpusloom.sources import files, web
from corpusloom.streaming import report_stream as report_streams


def place(spark, name: str) -> str:
    return f"{files.scratch(spark)}/{name}-{uuid.uuid4().hex}"


def key_text(c: str):
    return F.col(c).cast("string")


def by_key(key: str, *values: str):
    """The value at the key modulo their number."""
    return F.element_at(F.array(*map(F.lit, values)), (F.col(key) % len(values)).cast("int") + 1)


# Files ----------------------------------------------------------------------------------------------------------

@query("""SELECT CAST(p_partkey AS VARCHAR) AS link, p_name AS title, '' AS doc_type, 'html' AS format, '"a", ' || p_type || chr(10) || 'b' AS note FROM part""")
def csv_roundtrip(spark, d):
    """A catalog written and read; columns that are not there are empty, quotes and line ends stay."""
    path = place(spark, "csv")
    rows = t(spark, d, "part").select(F.col("p_brand").alias("pope"), F.col("p_name").alias("title"), key_text("p_partkey").alias("link"), F.concat(F.lit('"a", '), "p_type", F.lit("\nb")).alias("note"), "p_size")
    files.write_csv(rows, path, ["pope", "title", "link", "note"])
    return files.read_catalog(spark, path).select("link", "title", "doc_type", "format").join(files.read_csv(spark, path).select("link", "note"), "link")


@query("SELECT n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS region FROM nation")
def json_roundtrip(spark, d):
    """A JSON document for each row, indented, read with a schema."""
    path = place(spark, "json")
    nation = t(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("region"))
    files.export_markdown(nation.select(F.concat(key_text("n_nationkey"), F.lit(".json")).alias("filename"), files.pretty(nation).alias("text")), path)
    return files.read_json(spark, path, "n_nationkey bigint, n_name string, region bigint").withColumn("n_nationkey", F.col("n_nationkey").cast(nation.schema["n_nationkey"].dataType))


@query("SELECT kind, CAST(n AS BIGINT) AS n FROM (SELECT 'sync' AS kind, n_nationkey AS n FROM nation UNION ALL SELECT 'mark', n_regionkey FROM nation)")
def jsonl_append(spark, d):
    """K4: a log that two commands append to."""
    path = place(spark, "log")
    for kind, c in (("sync", "n_nationkey"), ("mark", "n_regionkey")):
        files.append_events(t(spark, d, "nation").select(F.lit(kind).alias("kind"), F.col(c).cast("bigint").alias("n")), path)
    return spark.read.json(path).select("kind", "n")


@query("SELECT n_name || '.md' AS name, CAST(length(n_name) + 4 AS BIGINT) AS size, '# ' || n_name || chr(10) || 'x' AS text FROM nation")
def markdown_folder(spark, d):
    """A file for each row, listed by size and read whole."""
    path = place(spark, "md")
    files.export_markdown(t(spark, d, "nation").select(F.concat("n_name", F.lit(".md")).alias("filename"), F.concat(F.lit("# "), "n_name", F.lit("\nx")).alias("text")), path)
    return files.list_files(spark, path).join(files.read_texts(spark, path), "name")


@query("SELECT r_regionkey, false AS written FROM region")
def dry_run_writes(spark, d):
    """K6: a dry run leaves no file."""
    path = place(spark, "dry")
    region = t(spark, d, "region")
    files.write_csv(region, f"{path}/csv", ["r_name"], dry_run=True)
    files.write_json(region, f"{path}/json", dry_run=True)
    return region.select("r_regionkey", F.lit(files.exists(spark, f"{path}/csv") or files.exists(spark, f"{path}/json")).alias("written"))


@query("SELECT n_nationkey, n_name FROM nation")
def index_cache(spark, d):
    """Built once, read from then on."""
    path = place(spark, "index")
    web.cached_index(spark, path, lambda: t(spark, d, "nation").select("n_nationkey", "n_name"))

    def again():
        raise AssertionError("built twice")

    return web.cached_index(spark, path, again)


# Fetching -------------------------------------------------------------------------------------------------------

@query(f"""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'api' WHEN 1 THEN 'page' END AS via, CASE c_custkey % 5 WHEN 0 THEN 200 WHEN 1 THEN 40 ELSE 0 END AS n_chars,
  CASE WHEN c_custkey % 5 IN (2, 3) THEN '{web.NO_PDF}' WHEN c_custkey % 5 = 4 THEN '404 ' || c_custkey END AS error FROM customer""")
def api_pages(spark, d):
    """The interface first, the page if its content is short; what fails is an error in its row."""
    host = f"https://www.{web.API_HOST}"

    def get(url: str) -> tuple[str, str]:
        slug = url.rsplit("=", 1)[-1]
        if url.startswith("http://api/"):
            return "application/json", json.dumps([{"content": {"rendered": "c" * (200 if slug.startswith("long") else 50)}}])
        if "/typed" in url:
            return "application/pdf", "x"
        if "/gone" in url:
            raise OSError("404 " + url.rsplit("/gone", 1)[1])
        return "text/html", "p" * 40

    link = F.concat(by_key("c_custkey", f"{host}/a/long", f"{host}/a/short", "http://h/doc", "http://h/typed", "http://h/gone"), "c_custkey", F.when(F.col("c_custkey") % 5 == 2, ".PDF?x=1").when(F.col("c_custkey") % 5 < 2, ".htm").otherwise(""))
    got = web.fetch(t(spark, d, "customer").select("c_custkey", link.alias("link")), key="c_custkey", get=get, api_base="http://api", pause=0)
    return got.select("c_custkey", "via", F.coalesce(F.length("html"), F.lit(0)).alias("n_chars"), "error")


@query("""SELECT CASE c_custkey % 4 WHEN 0 THEN 'skipped' WHEN 1 THEN 'success' WHEN 2 THEN 'failed' ELSE 'failed' END AS outcome,
  '00000000_' || c_mktsegment || '_' || c_name || '.md' AS file, 'http://h/' || (c_custkey % 4) || '/' || c_custkey AS link,
  CASE c_custkey % 4 WHEN 2 THEN 'Extracted body too short (' || length('short ' || c_custkey) || ' chars)' WHEN 3 THEN 'Could not find main content' END AS error FROM customer""")
def fetch_outcomes(spark, d):
    """Documents that are there are not asked for, others end as success or failed with a reason."""

    def get(url: str) -> tuple[str, str]:
        kind, key = url.rsplit("/", 2)[1:]
        if kind == "0":
            raise AssertionError("asked for a document that is there")
        return "text/html", {"1": "<body><p>" + "long enough " * 12 + "</p></body>", "2": f"<body><p>short {key}</p></body>", "3": "<p>no body</p>"}[kind]

    customer = t(spark, d, "customer")
    rows = customer.select(F.col("c_custkey").alias("row_pos"), F.col("c_mktsegment").alias("pope"), F.col("c_name").alias("title"), F.concat(F.lit("http://h/"), F.col("c_custkey") % 4, F.lit("/"), "c_custkey").alias("link"), *[F.lit("").alias(c) for c in ("published_date", "subtitle", "doc_type")])
    there = customer.filter("c_custkey % 4 < 2").select(F.concat(F.lit("00000000_"), "c_mktsegment", F.lit("_"), "c_name", F.lit(".md")).alias("name"), F.when(F.col("c_custkey") % 4 == 0, 900).otherwise(files.FETCHED_BYTES).alias("size"))
    return flows.fetch_missing(rows, there, get=get, pause=0)[1]


def _posts_of(counts: dict[int, int], told: dict[int, int]):
    """An interface that has ``counts`` posts in each category, and says that it has ``told``."""

    def get(url: str) -> tuple[str, str]:
        path, _, options = url.partition("?")
        q = dict(x.split("=") for x in options.split("&"))
        lo, size = (int(q["page"]) - 1) * int(q["per_page"]), int(q["per_page"])
        if path.endswith("/categories"):
            found = [{"id": c, "slug": f"s{c}", "name": f"n{c}", "count": told[c]} for c in sorted(told)[lo : lo + size]]
        else:
            c = int(q["categories"])
            found = [{"link": f"l{c}-{i}", "title": {"rendered": f"t{i}"}, "date": None} for i in range(lo, min(counts[c], lo + size))]
        return "application/json", json.dumps(found)

    return get


@query("""SELECT n AS category, CAST(1 + i // 100 AS INTEGER) AS page, CAST(i % 100 AS INTEGER) AS pos, 'l' || n || '-' || i AS link, c_custkey
  FROM (SELECT CAST(c_nationkey AS INTEGER) AS n, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i FROM customer)""")
def listing_pages(spark, d):
    """A data source with a partition for each page of each category; a category for each nation, a post for each of its customers.

    The interface counts too few posts in every third category and too many in every other third.
    """
    customer = t(spark, d, "customer")
    counts = {r["c_nationkey"]: r["count"] for r in customer.groupBy("c_nationkey").count().collect()}  # a row for each nation
    told = {c: max(0, n - 250) if c % 3 == 0 else n + 250 if c % 3 == 1 else n for c, n in counts.items()}
    found = web.listing(spark, "http://api", _posts_of(counts, told), tuple(sorted(counts)), pause=0)
    number = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1
    named = customer.select(F.concat(F.lit("l"), "c_nationkey", F.lit("-"), number).alias("link"), "c_custkey")
    return found.join(named, "link").select("category", "page", "pos", "link", "c_custkey")


@query("""SELECT CASE n_regionkey % 2 WHEN 0 THEN 'posts' ELSE 'pages' END AS kind, r_name AS pope, 'N' || n_nationkey AS title, CASE WHEN n_regionkey % 2 = 0 THEN 'encyclical' WHEN n_nationkey % 2 = 0 THEN 'apostolic_letter' ELSE 'other' END AS doc_type,
  CASE n_nationkey % 5 WHEN 0 THEN 'pdf' ELSE 'html' END AS format, 'https://www.vatican.va/' || n_nationkey || CASE n_nationkey % 5 WHEN 0 THEN '.pdf' ELSE '.html' END AS link FROM nation JOIN region ON n_regionkey = r_regionkey""")
def crawl_catalog(spark, d):
    """The registry, posts of categories, documents below the headings of pages; an author for each region, a document for each nation."""
    region, nation = (t(spark, d, x) for x in ("region", "nation"))
    regions = [(r[0], r[1]) for r in region.select("r_regionkey", "r_name").orderBy("r_regionkey").collect()]  # regions and nations have 5 and 25 rows at any scale
    nations = [(r[0], r[1]) for r in nation.select("n_nationkey", "n_regionkey").orderBy("n_nationkey").collect()]

    def get(url: str) -> tuple[str, str]:
        path, _, options = url.partition("?")
        q = dict(x.split("=") for x in options.split("&"))
        link = lambda n: f"https://www.vatican.va/{n}" + (".pdf" if n % 5 == 0 else ".html")
        if path.endswith("/categories"):
            found = [{"id": 10 + r, "slug": f"c{r}", "name": name, "count": 0} for r, name in regions] if q["page"] == "1" else []
        elif path.endswith("/posts"):
            found = [{"link": link(n), "title": {"rendered": f"<i>N{n}</i>"}, "date": "1900-01-01T00:00:00"} for n, r in nations if 10 + r == int(q["categories"]) and q["page"] == "1"]
        elif q["slug"] == "popelist":
            found = [{"link": "http://h/popelist", "title": {"rendered": "x"}, "content": {"rendered": "".join(f'<p><a href="/{f"category/c{r}" if r % 2 == 0 else f"p{r}"}">{name}</a></p>' for r, name in regions)}}]
        else:
            own = [n for n, r in nations if f"p{r}" == q["slug"]]
            lists = [("Apostolic Letters", [n for n in own if n % 2 == 0]), ("Speeches", [n for n in own if n % 2]), ("Additional Links", [1000])]
            found = [{"link": "http://h/" + q["slug"], "title": {"rendered": "x"}, "content": {"rendered": "".join(f"<h3>{h}</h3><ul>" + "".join(f'<li><a href="{link(n)}?again=1">N{n}</a></li><li><a href="{link(n)}">N{n}</a></li>' for n in ns) + "</ul>" for h, ns in lists)}}]
        return "application/json", json.dumps(found)

    rows, _ = flows.crawl(spark, "http://api", get, pause=0)
    return rows.select(F.when(F.col("published_date") == "", "pages").otherwise("posts").alias("kind"), "pope", "title", "doc_type", "format", F.regexp_replace("link", r"\?again=1$", "").alias("link"))


@query("SELECT c_custkey, 'page' AS via, true AS apart FROM customer")
def paced_site(spark, d):
    """One site over many tasks; no document begins less than a pause after the one before it, whatever their tasks."""
    pause = 0.0004
    links = t(spark, d, "customer").select("c_custkey", F.concat(F.lit("http://h/"), "c_custkey").alias("link"))
    got = files.settle(web.fetch(links, key="c_custkey", get=lambda url: ("text/html", url), pause=pause, per_lane=100, lanes=4, stamps=True))
    got = got.withColumn("second", F.floor("started"))
    # The one before is of the same second or the last of the second before; a second without any is a pause by itself.
    last = got.groupBy((F.col("second") + 1).alias("second")).agg(F.max("started").alias("last"))
    before = F.coalesce(F.lag("started").over(Window.partitionBy("second").orderBy("started")), "last")
    return got.join(last, "second", "left").select("c_custkey", "via", F.coalesce(F.col("started") - before >= pause, F.lit(True)).alias("apart"))


@query("SELECT o_custkey, 'https://h/' || o_orderkey AS link, o_orderstatus AS title FROM orders")
def listing_json(spark, d):
    """Posts of a page of an interface, as JSON, to rows."""
    posts = t(spark, d, "orders").groupBy("o_custkey").agg(F.to_json(F.collect_list(F.struct(F.concat(F.lit("https://h/"), "o_orderkey").alias("link"), F.struct(F.col("o_orderstatus").alias("rendered")).alias("title")))).alias("posts"))
    return posts.select("o_custkey", F.explode(web.page_listing(F.col("posts"))).alias("p")).select("o_custkey", "p.link", F.col("p.title.rendered").alias("title"))


# HTML trees -----------------------------------------------------------------------------------------------------

_NOISE = '<nav>n</nav><div class="my-sidebar">s</div><h1 class="entry-title">t</h1><a href="#">Continue reading</a><script>1 < 2</script>'
_TREES = (
    ("https://www.vatican.va/x", '<body><div class="testo">', "</div></body>", '<div class="testo">', "</div>"),
    ("https://www.vatican.va/y", '<body><div class="documento a">', "</div></body>", '<div class="documento a">', "</div>"),
    ("https://www.vatican.va/z", "<body>", "</body>", "<body>", "</body>"),
    ("https://h/x", '<body><article class="other">no</article><article class="post">', "</article></body>", '<article class="post">', "</article>"),
    ("https://h/y", '<body><article> </article><div class="entry-content">', "</div></body>", '<div class="entry-content">', "</div>"),
    ("https://h/z", "<body><main>", "</main></body>", "<main>", "</main>"),
    ("https://h/none", "<section>", "</section>", None, None),
)


@query("SELECT c_custkey, CASE c_custkey % 7 " + " ".join(f"WHEN {i} THEN '{x[3]}<p>' || c_name || '</p>{x[4]}'" for i, x in enumerate(_TREES) if x[3])
       + " END AS content, CASE c_custkey % 7 WHEN 6 THEN 'Could not find main content' END AS error FROM customer")
def tree_content(spark, d):
    """The element with the content by host, without noise and repeated titles."""
    page = F.concat(by_key("c_custkey", *[x[1] + _NOISE + "<p>" for x in _TREES]), "c_name", by_key("c_custkey", *["</p>" + x[2] for x in _TREES]))
    return t(spark, d, "customer").select("c_custkey", html.content_html(page, by_key("c_custkey", *[x[0] for x in _TREES])).alias("c")).select("c_custkey", F.col("c.value").alias("content"), "c.error")


@query("SELECT c_custkey, '# t ' || c_custkey || chr(10) || chr(10) || c_name AS body FROM customer")
def tree_simple(spark, d):
    """The body, or all there is, without noise, as markdown."""
    inner = F.concat(F.lit('<nav>n</nav><h1 class="x">t '), "c_custkey", F.lit('</h1><div class="share">s</div><p>'), "c_name", F.lit("</p>"))
    page = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("<html><body>"), inner, F.lit("</body></html>"))).otherwise(inner)
    return t(spark, d, "customer").select("c_custkey", html.simple_body(page).alias("b")).select("c_custkey", F.col("b.value").alias("body"))


@query("""SELECT c_custkey, concat_ws(chr(10) || chr(10), '## t', 'a **' || c_name || '** _i_ [l](<u>)', '  * one' || chr(10) || '  * two', '  1. x', '> q', '* * *') AS markdown FROM customer""")
def tree_markdown(spark, d):
    """A fragment as markdown."""
    fragment = F.concat(F.lit("<h2>t</h2><p>a <b>"), "c_name", F.lit('</b> <em>i</em> <a href="u">l</a></p><ul><li>one</li><li>two</li></ul><ol><li>x</li></ol><blockquote><p>q</p></blockquote><hr>'))
    return t(spark, d, "customer").select("c_custkey", html.html_markdown(fragment).alias("markdown"))


@query("""SELECT c_custkey, CASE WHEN n >= 100 THEN n ELSE 0 END AS n_chars, CASE WHEN n < 100 THEN 'Extracted body too short (' || n || ' chars)' END AS error
  FROM (SELECT c_custkey, 95 + c_custkey % 10 AS n FROM customer)""")
def body_minimum(spark, d):
    """A body needs 100 characters."""
    page = F.concat(F.lit("<body><p>"), F.repeat(F.lit("x"), (95 + F.col("c_custkey") % 10).cast("int")), F.lit("</p></body>"))
    return t(spark, d, "customer").select("c_custkey", html.page_body(page, F.lit("http://h/")).alias("b")).select("c_custkey", F.coalesce(F.length("b.value"), F.lit(0)).cast("bigint").alias("n_chars"), "b.error")


@query("""SELECT c_custkey, 0 AS pos, c_name AS text, 'http://h/p/' || c_custkey || '.html' AS url FROM customer
  UNION ALL SELECT c_custkey, 1, 'two words', 'http://h/d/b/' || c_custkey || '.html' FROM customer""")
def tree_links(spark, d):
    """Links to pages whose text is long enough, against the address of the page."""
    page = F.concat(F.lit('<a href="/p/'), "c_custkey", F.lit('.html"> '), "c_name", F.lit(' </a><a href="q.html">abc</a><a href="x.htm">long text</a><a href="b/'), "c_custkey", F.lit('.html"><b>two</b> <i>words</i></a>'))
    return t(spark, d, "customer").select("c_custkey", F.posexplode(html.html_links(page, F.lit("http://h/d/i.html"))).alias("pos", "l")).select("c_custkey", "pos", "l.text", "l.url")


@query("""SELECT c_mktsegment AS pope, min(c_custkey) << 32 AS pos, arg_min('link ' || c_custkey, c_custkey) AS text, 'http://h/' || (c_custkey % 50) || '.html' AS url FROM customer GROUP BY c_mktsegment, c_custkey % 50""")
def index_first(spark, d):
    """Of one address of an author the first in the index stays."""
    page = F.concat(F.lit('<a href="/'), F.col("c_custkey") % 50, F.lit('.html">link '), "c_custkey", F.lit("</a>"))
    return web.index_links(t(spark, d, "customer").select(F.col("c_mktsegment").alias("pope"), F.col("c_custkey").alias("page_pos"), F.lit("http://h/").alias("base"), page.alias("html")))


# Titles ---------------------------------------------------------------------------------------------------------

_WANTED = "SELECT p_partkey AS k, p_brand AS b, CASE WHEN p_partkey % 10 = 0 THEN string_split(p_name, ' ')[1] WHEN p_partkey % 10 = 2 THEN 'zz qq' ELSE p_name END AS title, p_size FROM part"


@query(f"""WITH w AS (SELECT *, list_distinct(list_filter(string_split(title, ' '), lambda x: length(x) > 2)) AS words FROM ({_WANTED})),
  i AS (SELECT p_partkey AS pos, p_brand AS b, text, list_distinct(list_filter(string_split(text, ' '), lambda x: length(x) > 2)) AS words FROM (SELECT *, array_to_string(string_split(p_name, ' ')[2:], ' ') || ' of ' || p_type AS raw, lower(raw) AS text FROM part)),
  s AS (SELECT k, pos, len(list_intersect(w.words, i.words)) + CASE WHEN contains(text, title) THEN 10 WHEN starts_with(text, string_split(title, ' ')[1]) THEN 3 ELSE 0 END AS score, len(w.words) AS n FROM w JOIN i ON w.b = i.b WHERE len(w.words) > 0),
  m AS (SELECT k, 'i' || pos AS url FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, pos) AS r FROM s WHERE score > 0) WHERE r = 1 AND (score >= 2 OR n = 1))
  SELECT CAST(w.k AS VARCHAR) AS link, CASE WHEN p_size < 4 THEN 'm' || w.k ELSE m.url END AS url, CASE WHEN p_size < 4 THEN 'manual' WHEN m.url IS NOT NULL THEN 'title_match' END AS method
  FROM w LEFT JOIN m ON w.k = m.k""")
def title_resolve(spark, d):
    """An override, else the best title of another table, else nothing; ties, misses and titles of one word are among them."""
    part = t(spark, d, "part")
    words = F.split("p_name", " ")
    title = F.when(F.col("p_partkey") % 10 == 0, words[0]).when(F.col("p_partkey") % 10 == 2, "zz qq").otherwise(F.col("p_name"))
    wanted = part.select(key_text("p_partkey").alias("link"), F.col("p_brand").alias("pope"), title.alias("title"))
    text = F.concat(F.array_join(F.slice(words, 2, 100), " "), F.lit(" of "), "p_type")
    index = part.select(F.col("p_brand").alias("pope"), F.col("p_partkey").alias("pos"), text.alias("text"), F.concat(F.lit("i"), key_text("p_partkey")).alias("url"))
    overrides = part.filter("p_size < 4").select(key_text("p_partkey").alias("link"), F.concat(F.lit("m"), key_text("p_partkey")).alias("url"))
    return match.resolve(wanted, index, overrides).select("link", "url", "method")


@query("SELECT n_nationkey, regexp_replace(lower(n_name), '[^a-z0-9]+', ' ', 'g') || ' cafe fi' AS title FROM nation")
def title_accents(spark, d):
    """Accents, ligatures and tags go."""
    return t(spark, d, "nation").select("n_nationkey", scalars.normal_title(F.concat(F.lit("<i>"), F.regexp_replace("n_name", "A", "Á"), F.lit("</i> Café! ﬁ"))).alias("title"))


# Scalars --------------------------------------------------------------------------------------------------------

@query("SELECT c_custkey, list_value('http://h/x', 'http://h/a/y', 'http://h/a/b/z', 'http://h/a/b/c.html?q=1', 'http://o/k', 'http://h/a/b/c.html')[CAST(c_custkey % 6 AS INT) + 1] AS url FROM customer")
def relative_urls(spark, d):
    """X9"""
    return t(spark, d, "customer").select("c_custkey", scalars.join_url(F.lit("http://h/a/b/c.html"), by_key("c_custkey", "/x", "../y", "z", "?q=1", "http://o/k", "")).alias("url"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS rest FROM customer")
def prefix_rest(spark, d):
    """X11"""
    return t(spark, d, "customer").select("c_custkey", scalars.after_prefix(F.concat(by_key("c_custkey", "dco:", "DCO:"), "c_name")).alias("rest"))


@query("SELECT c_custkey, 'the TITLE of ' || c_name || '  end' AS text FROM customer")
def converted_cleanup(spark, d):
    """X12"""
    raw = F.concat(F.lit("junk before the TITLE of "), "c_name", F.lit(' HYPERLINK "http://x" end '))
    return t(spark, d, "customer").select("c_custkey", scalars.clean_converted(raw, "The title").alias("text"))


@query("SELECT o_orderkey, strftime(make_timestamp(o_orderkey * 1000000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS stamp FROM orders")
def utc_stamps(spark, d):
    """X7, with a clock that is given."""
    return t(spark, d, "orders").select("o_orderkey", scalars.utc_stamp(F.timestamp_seconds(F.col("o_orderkey") * 1000)).alias("stamp"))


@query("SELECT n_nationkey FROM nation WHERE n_nationkey % 3 <> 0")
def link_sections(spark, d):
    """F8"""
    return catalog.content_sections(t(spark, d, "nation").withColumn("heading", by_key("n_nationkey", " Additional Links ", "Links", "Additional"))).select("n_nationkey")


# Queue and providers --------------------------------------------------------------------------------------------

@query(f"SELECT 'step3' AS step, 'm' AS model, 30 AS batch_size, 'p.md' AS prompt_file, '{NOW}' AS created_at, count(*) AS total FROM documents")
def queue_meta(spark, d):
    """The row that describes a queue."""
    return work_queue.meta(t(spark, d, "documents"), F.lit(NOW), "step3", "m", "p.md")


@query("""SELECT s_suppkey, CASE WHEN n = 3 THEN 'failed' WHEN n <= 7 THEN 'complete' ELSE 'pending' END AS status, CASE WHEN n = 3 THEN 'refused' END AS error, CASE WHEN n <= 7 AND n <> 3 THEN upper(s_name) END AS report
  FROM (SELECT s_suppkey, s_name, row_number() OVER (ORDER BY 'd' || s_suppkey || '.md') AS n FROM supplier)""")
def remaining_run(spark, d):
    """A queue of all suppliers; stale items reset, a run with a limit passed through, in turn, and what it leaves."""
    path = place(spark, "run")
    supplier = t(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("d"), "s_suppkey", F.lit(".md")).alias("filename"), "s_name")
    third = supplier.orderBy("filename").limit(3).agg(F.max("s_name")).first()[0]  # the provider refuses the text of the third item
    files.export_markdown(supplier.select("filename", F.col("s_name").alias("text")), f"{path}/docs")
    store = QueueStore(spark, f"{path}/queue")
    none = spark.createDataFrame([], "report_file string, size long")
    store.init(supplier.select(F.col("filename").alias("name")), none)
    store.next_batch(2)  # taken and never finished: stale

    def answer(text: str) -> str:
        if text == third:
            raise ValueError("refused")
        return text.upper()

    def run(name: str, options: dict) -> int:
        if name == "reset_stale":
            store.reset_stale(none)
        elif name == "run":
            flows.run_rest(store, f"{path}/docs", f"{path}/reports", answer, size=5, limit=options["limit"], concurrency=options["concurrency"])
        else:
            store.status()[1].collect()
        return 0

    flows.run_commands(flows.remaining_commands(limit=7), run)
    reports = files.read_texts(spark, f"{path}/reports").select(F.col("name").alias("report_file"), F.col("text").alias("report"))
    left = store.items().join(reports, "report_file", "left")
    return left.join(supplier, F.col("source_file") == F.col("filename")).select("s_suppkey", "status", "error", "report")


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Social' WHEN 1 THEN 'Spiritual' ELSE 'Mixed' END AS theme, '4 words' AS summary, CAST(NULL AS VARCHAR) AS error FROM customer""")
def theme_stub(spark, d):
    """A stub's report, and its fields."""
    text = F.concat(by_key("c_custkey", "Labour JUSTICE prayer ", "Faith grace work ", "state church x "), F.regexp_replace("c_name", " ", ""))
    got = provider.call(t(spark, d, "customer").select("c_custkey", text.alias("text")), "text", "c_custkey")
    return got.select("c_custkey", extract.bullet(F.col("report"), "Key theme").alias("theme"), extract.summary(F.col("report")).alias("summary"), "error")


@query("""SELECT c_custkey, tier, CAST(CASE WHEN tier = 'b' AND c_custkey % 2 = 0 THEN -1 WHEN c_custkey % 3 = 0 THEN 0.5 WHEN c_custkey % 3 = 1 THEN 0.25 ELSE 0 END AS DOUBLE) AS saturation,
  CASE WHEN tier = 'b' AND c_custkey % 2 = 0 THEN 'no answer' END AS error FROM customer, (SELECT unnest(['a', 'b']) AS tier)""")
def research_stub(spark, d):
    """Two tiers of research reports with a block of gradients; a tier that fails says so."""

    def second(text: str) -> str:
        if text.endswith("even"):
            raise ValueError("no answer")
        return provider.stub_gradient(text)

    text = F.concat(by_key("c_custkey", "labour justice x ", "state y y ", "y y y "), by_key("c_custkey", "even", "odd"))
    got = provider.research(t(spark, d, "customer").select("c_custkey", text.alias("text")), "text", "c_custkey", {"a": provider.stub_gradient, "b": second})
    saturation = extract.axis_value(extract.gradient_json(F.col("report")), "reflective", "saturation")
    number = F.coalesce(F.nullif(saturation, F.lit("")).cast("double"), F.lit(-1.0))
    return got.select("c_custkey", "tier", number.alias("saturation"), "error")


# Table functions, observed counts, publishing, files as a stream ------------------------------------------------

@query(ORACLES["tree_links"])
def lateral_links(spark, d):
    """As ``tree_links``, by a table function: links leave a page one by one."""
    page = F.concat(F.lit('<a href="/p/'), "c_custkey", F.lit('.html"> '), "c_name", F.lit(' </a><a href="q.html">abc</a><a href="x.htm">long text</a><a href="b/'), "c_custkey", F.lit('.html"><b>two</b> <i>words</i></a>'))
    pages = t(spark, d, "customer").select("c_custkey", page.alias("html"))
    return pages.lateralJoin(tables.HtmlLinks(F.col("html").outer(), F.lit("http://h/d/i.html"))).select("c_custkey", "pos", "text", "url")


@query(ORACLES["section_split"])
def lateral_sections(spark, d):
    """As ``section_split``, by a table function in SQL."""
    tables.register(spark)
    t(spark, d, "documents").select("doc_id", F.concat(F.lit("# Title\nintro\n## Context\n"), "lang", F.lit("\n\n### Citations\n"), "source", F.lit("\n")).alias("text")).createOrReplaceTempView("section_texts")
    return spark.sql("SELECT doc_id, heading, level, body FROM section_texts, LATERAL md_sections(text)")


@query("""SELECT doc_id, CAST(i AS INTEGER) AS pos, CASE i WHEN 0 THEN '1' ELSE '' END AS number, list_value('media', 'archival')[i + 1] AS type, CASE i WHEN 0 THEN source ELSE '' END AS author,
  list_value('T ' || lang, lang)[i + 1] AS title, CASE i WHEN 0 THEN CAST(n_chars AS VARCHAR) ELSE '' END AS year, list_value('http://h/' || doc_id, 'note')[i + 1] AS url FROM documents, (SELECT unnest([0, 1]) AS i)""")
def citation_table(spark, d):
    """Tables of six columns, and of three, by a table function; rules and headings are no rows."""
    c = lambda x: F.col(x).cast("string")
    six = F.concat(F.lit("| 1 | media | "), c("source"), F.lit(" | T "), c("lang"), F.lit(" | "), c("n_chars"), F.lit(" | http://h/"), c("doc_id"), F.lit(" |\n"))
    text = F.concat(F.lit("### 5. Citations Table\n| # | Type | Author/Outlet | Title | Year | URL |\n|---|---|---|---|---|---|\n"), six, F.lit("text\n| archival | "), c("lang"), F.lit(" | note |\n| a | b |\n"))
    return t(spark, d, "documents").select("doc_id", text.alias("text")).lateralJoin(tables.CitationTable(F.col("text").outer())).drop("text")


@query(ORACLES["conditional_stats"])
def observed_stats(spark, d):
    """A3, K5, K2: the counts of ``conditional_stats``, taken while the catalog is published."""
    rows, watch = merge.observed(enriched(spark, d))
    files.publish_csv(rows.select("stem", *merge.ANALYSIS_COLUMNS), place(spark, "published"), ["stem", *merge.ANALYSIS_COLUMNS])
    counts = watch.get
    names = [k for k in counts if not k.startswith(("total_", "full_"))]
    return spark.createDataFrame([tuple(counts[k] for k in names)], ", ".join(f"`{k}` long" for k in names))


@query(ORACLES["bucket_order"])
def observed_buckets(spark, d):
    """A4, A5: the counts of ``bucket_order``, taken while the catalog is written."""
    rows, watch = merge.observed(enriched(spark, d))
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(merge.observed_buckets(watch.get), "pos int, bucket string, total long, gradients_full long")


@query("SELECT CAST(p_partkey AS VARCHAR) AS link, p_name AS title, CAST(p_size + 1 AS VARCHAR) AS note FROM part")
def published_catalog(spark, d):
    """K2: a catalog published onto the folder it was read from; readers see the last whole version."""
    path = place(spark, "catalog")
    files.publish_csv(t(spark, d, "part").select(key_text("p_partkey").alias("link"), F.col("p_name").alias("title"), key_text("p_size").alias("note")), path, ["link", "title", "note"])
    again = files.read_published(spark, path).withColumn("note", (F.col("note").cast("int") + 1).cast("string"))
    files.publish_csv(again, path, ["link", "title", "note"])
    return files.read_published(spark, path).select("link", "title", "note")


@query(ORACLES["tier_first_match"])
def tier_by_turns(spark, d):
    """As ``tier_first_match``, a tier parsed only for documents that the tiers before have left open."""
    return merge.first_tier_by_turns(tier_reports(spark, d), t(spark, d, "documents").select(key_text("doc_id").alias("stem")))[0]


@query("SELECT 'run-' || s_suppkey || '.md' AS report_file, CAST(600 + s_suppkey % 7 AS BIGINT) AS size, 1 AS found FROM supplier")
def report_stream(spark, d):
    """M3, C4: reports found as a stream of files; after a restart only those that came since."""
    path = place(spark, "reports")
    rows = t(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("run-"), "s_suppkey", F.lit(".md")).alias("filename"), F.repeat(F.lit("x"), (600 + F.col("s_suppkey") % 7).cast("int")).alias("text"))
    for part in (0, 1):
        files.export_markdown(rows.filter(F.col("s_suppkey") % 2 == part), f"{path}/in")
        report_streams.follow(spark, f"{path}/in", f"{path}/state", lambda df, n, part=part: df.withColumn("run", F.lit(part)).write.mode("append").parquet(f"{path}/found"))
    return spark.read.parquet(f"{path}/found").groupBy("report_file", "size").agg(F.count("*").cast("int").alias("found"))


@query("""SELECT c_custkey, list_value(b, b || '_s_2', b || '_s_2_s_2', CASE c_custkey % 2 WHEN 0 THEN b || '_s_3' ELSE b || '_s_2_s_3' END)[k + 1] AS stem, CAST(k AS INTEGER) AS k
  FROM (SELECT c_custkey, '00000000_' || c_mktsegment || '_' || c_custkey AS b FROM customer), (SELECT unnest(range(4)) AS k)""")
def collision_repair(spark, d):
    """Bases that equal names made up for rows before them."""
    k = F.col("k")
    again = (k == 2) | ((k == 3) & (F.col("c_custkey") % 2 == 1))
    rows = t(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("pope"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k")).select(
        "c_custkey", "k", "pope", (F.col("c_custkey") * 4 + k).alias("row_pos"), F.lit("").alias("published_date"),
        F.concat(key_text("c_custkey"), F.when(again, "_s_2").otherwise("")).alias("title"), F.lit("http://h/s.html").alias("link"),
    )
    return naming.unique_stems(rows).select("c_custkey", "stem", "k")


@query("""SELECT n_nationkey, CAST(i AS INTEGER) AS pos, list_value('pope', 'title', 'link', 'zeta', 'alpha', 'category', 'summary', 'reflective_saturation', 'reflective_density', 'prescriptive_saturation', 'prescriptive_density')[i + 1] AS name,
  list_value(r_name, n_name, 'l' || n_nationkey, 'z', CAST(n_regionkey AS VARCHAR), 'c', '', '', '', '', '')[i + 1] AS value FROM nation JOIN region ON n_regionkey = r_regionkey, (SELECT unnest(range(11)) AS i)""")
def ordered_columns(spark, d):
    """Columns of a catalog in their order, then unknown ones as they stand, then those of enrichment, set anew."""
    joined = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = joined.select(F.lit("z").alias("zeta"), F.lit("old").alias("summary"), F.concat(F.lit("l"), "n_nationkey").alias("link"), F.col("n_regionkey").cast("string").alias("alpha"), F.col("n_name").alias("title"), F.col("r_name").alias("pope"), "n_nationkey")
    themes = rows.select(F.col("link").alias("stem"), F.lit("c").alias("category"), F.lit(None).cast("string").alias("summary"))
    none = spark.createDataFrame([], "stem string, tier string, block string")
    out = merge.projected(merge.enrich(rows.drop("n_nationkey").withColumn("stem", F.col("link")), themes, none))
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in out.columns])
    return out.select(F.substring("link", 2, 9).cast("int").alias("n_nationkey"), F.posexplode(cells).alias("pos", "c")).select("n_nationkey", "pos", "c.name", "c.value")
