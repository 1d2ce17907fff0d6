"""Tiers by turns, counts in flight, publishing, table functions, reports as a stream."""

import random
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import extract, html, tables
from corpusloom.operators import merge
from corpusloom.operators.queue_store import QueueStore
from corpusloom.plans import flows
from corpusloom.sources import files
from corpusloom.streaming import report_stream

GRADIENT = '# R\n\n## Gradients\n\n```json\n{"reflective": {"saturation": %d}}\n```\n'


def test_later_tiers_are_parsed_for_open_stems_only(spark):
    """All stems have all tiers; the first is valid for most, so the others are parsed for the rest alone."""
    def text(stem, tier):
        if tier == 0 and stem % 10 == 0:
            return "no gradients" if stem % 20 else '## Gradients\n```json\n{}\n```\n'
        if tier == 1 and stem % 30 == 0:
            return "## Gradients\n```json\n{broken\n}\n```\n"
        return GRADIENT % stem if stem != 60 else "never"

    reports = spark.createDataFrame([(str(s), tier, text(s, k)) for s in range(200) for k, tier in enumerate(merge.TIERS)], "stem string, tier string, text string").repartition(4)
    stems = spark.createDataFrame([(str(s),) for s in range(200)] + [("not there",), ("7",)], "stem string")
    got, parsed = merge.first_tier_by_turns(reports, stems)
    assert parsed == {"gemini": 200, "perplexity": 20, "deep-research": 7}
    want = merge.first_tier(reports)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() == 199
    got, parsed = merge.first_tier_by_turns(reports, stems.filter("stem = '3'"))
    assert parsed == {"gemini": 1} and got.count() == 1
    got, parsed = merge.first_tier_by_turns(reports, stems.limit(0))
    assert parsed == {} and got.count() == 0


def catalog(spark, n=40):
    rows = [(i, "P", f"T{i}", "1900-01-02", f"http://h/{i}.htm", "mine") for i in range(n)]
    cat = spark.createDataFrame(rows, "row_pos long, pope string, title string, published_date string, link string, extra string")
    stem = lambda i: f"02011900_P_T{i}"
    kinds = ("Social", "Spiritual", "Mixed", "Mixed (x)", "", "Other")
    themes = spark.createDataFrame([(f"run-{stem(i)}.md", f"- **Key theme:** {kinds[i % 6]}\n- **Summary:** s{i}\n") for i in range(n) if i % 4], "name string, text string")
    tiers = spark.createDataFrame([(merge.TIERS[i % 3], f"run-{stem(i)}.md.md", GRADIENT % i) for i in range(0, n, 3)], "tier string, name string, text string")
    return cat, themes, tiers


@pytest.mark.parametrize("dry_run", [True, False])
def test_counts_are_taken_while_the_catalog_is_written(spark, tmp_path, dry_run):
    cat, themes, tiers = catalog(spark)
    rows, stats, buckets = flows.enrich_catalog(cat, themes, tiers)
    counts, by_bucket = flows.enrich_and_publish(cat, themes, tiers, str(tmp_path / "out"), dry_run)
    assert counts == stats.first().asDict() and by_bucket == [tuple(r) for r in buckets.collect()] and counts["rows"] == 40
    assert (tmp_path / "out").exists() is not dry_run
    if not dry_run:
        written = files.read_published(spark, str(tmp_path / "out")).drop("row_pos")
        assert sorted(map(tuple, written.collect())) == sorted(map(tuple, rows.drop("row_pos").select(*written.columns).collect()))


def test_one_scan_for_rows_and_counts(spark, tmp_path):
    """The catalog's rows are read once: an accumulator in a function on them counts each row once."""
    seen = spark.sparkContext.accumulator(0)
    cat, themes, tiers = catalog(spark)

    def watch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    enriched = merge.enrich(cat.withColumn("stem", F.concat(F.lit("02011900_P_"), "title")), merge.theme_fields(merge.reports_by_stem(themes)), spark.createDataFrame([], "stem string, tier string, block string")).mapInArrow(watch, merge.enrich(cat.withColumn("stem", F.lit("")), merge.theme_fields(merge.reports_by_stem(themes)), spark.createDataFrame([], "stem string, tier string, block string")).schema)
    rows, counts = merge.observed(enriched)
    merge.projected(rows).write.csv(str(tmp_path / "x"))
    assert counts.get["rows"] == 40 == seen.value


WRITER = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from corpusloom.sources import files
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.memory", "1g").getOrCreate()

@F.udf("string")
def slow(x):
    import time
    print("writing", flush=True)
    time.sleep(60)
    return x

files.publish_csv(s.range(4).select(slow(F.col("id").cast("string")).alias("a")), sys.argv[2], ["a"])
"""


def test_a_killed_writer_leaves_the_old_catalog(spark, tmp_path):
    path = str(tmp_path / "cat")
    with pytest.raises(FileNotFoundError):
        files.read_published(spark, path)
    assert files.publish_csv(spark.createDataFrame([("old", "1")], "a string, b string"), path, ["a", "b"])[0] == 1
    log = tmp_path / "log"
    with log.open("w") as out:
        p = subprocess.Popen([sys.executable, "-c", WRITER, str(Path(__file__).resolve().parents[1]), path], stdout=out, stderr=out)
        for _ in range(600):
            if "writing" in log.read_text() or p.poll() is not None:
                break
            time.sleep(0.1)
        # Some of the new data lies there by now.
        assert p.poll() is None and len(list((tmp_path / "cat" / "data").iterdir())) == 2
        p.kill()
        p.wait()
    assert [(r.a, r.b) for r in files.read_published(spark, path).collect()] == [("old", "1")]
    for k in range(2, 6):
        number, written = files.publish_csv(files.read_published(spark, path).withColumn("b", F.lit(str(k))), path, ["a", "b"])
        assert number == k and written.first().b == str(k)
    assert files.read_published(spark, path).first().b == "5"
    assert len(list((tmp_path / "cat" / "data").iterdir())) == 4  # three versions and what the killed writer left


def test_table_functions_are_the_array_functions(spark):
    rng = random.Random(1)
    pages, texts = [], []
    for k in range(40):
        pages.append((k, None if k == 3 else "".join(rng.choice(('<a href="x.html">long text</a>', '<a href="/b/y.html?q"> a </a>', '<h3>H<b>x</b></h3>', '<a href="z.html"><i>two</i> words</a>', "<p>", '<a href="">none</a>', "text")) for _ in range(rng.randrange(9))), None if k == 5 else "http://h/d/"))
        texts.append((k, None if k == 3 else "\n".join(rng.choice(("## A ", "### b", "# no", "####  no", " text ", "", "| a | b |", "|---|:-:|", "| 1 | x | y | z | 1900 | u |", " | c|", "##")) for _ in range(rng.randrange(14)))))
    p = spark.createDataFrame(pages, "k int, html string, base string")
    d = spark.createDataFrame(texts, "k int, text string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(p.lateralJoin(tables.HtmlLinks(F.col("html").outer(), F.col("base").outer())).select("k", "pos", "text", "url")) == rows(p.select("k", F.posexplode(html.html_links("html", "base")).alias("pos", "x")).select("k", "pos", "x.text", "x.url"))
    assert rows(p.lateralJoin(tables.HtmlSections(F.col("html").outer(), F.col("base").outer())).select("k", "pos", F.coalesce("heading", F.lit("-")), "text", "url")) == rows(p.select("k", F.posexplode(html.html_sections("html", "base")).alias("pos", "x")).select("k", "pos", F.coalesce("x.heading", F.lit("-")), "x.text", "x.url"))
    assert rows(d.lateralJoin(tables.MarkdownSections(F.col("text").outer())).select("k", "pos", "level", "heading", "body")) == rows(d.select("k", F.posexplode(extract.sections(F.col("text"))).alias("pos", "x")).select("k", "pos", "x.level", "x.heading", "x.body"))
    assert rows(d.lateralJoin(tables.Citations(F.col("text").outer())).select("k", "pos", "cells")) == rows(d.select("k", F.posexplode(extract.citations(F.col("text"))).alias("pos", "cells")))
    tables.register(spark)
    d.createOrReplaceTempView("texts_of_test")
    assert spark.sql("SELECT k, year FROM texts_of_test, LATERAL md_citation_table(text) WHERE number = '1'").filter("year <> '1900'").count() == 0


def test_each_report_is_found_once(spark, tmp_path):
    """A queue synced from a stream of files: over restarts, with a batch that fails, with files that are no reports."""
    box, state = tmp_path / "reports", str(tmp_path / "state")
    box.mkdir()
    put = lambda name, n: ((tmp_path / "new").write_text("x" * n), (tmp_path / "new").rename(box / name))  # noqa: E731  (moved in whole)
    store = QueueStore(spark, str(tmp_path / "q"))
    store.init(spark.createDataFrame([(f"{c}.md",) for c in "abcdef"], "name string"), spark.createDataFrame([], "report_file string, size long"))
    for c, n in (("a", 500), ("b", 499), ("c", 900)):
        put(f"run-{c}.md", n)
    put("run-d.txt", 900)
    assert report_stream.sync_queue(store, str(box), state, at_once=2) == 2
    assert report_stream.sync_queue(store, str(box), state) == 0
    put("run-e.md", 700)

    def fails(rows, number):
        raise RuntimeError("cut short")

    with pytest.raises(Exception, match="cut short"):
        report_stream.follow(spark, str(box), state, fails)
    seen = []
    report_stream.follow(spark, str(box), state, lambda rows, number: seen.append((number, [r.report_file for r in rows.collect()])))
    assert seen == [(2, ["run-e.md"])]
    put("run-f.md", 700)
    assert report_stream.sync_queue(store, str(box), state) == 1
    assert {r.source_file for r in store.items().filter("status = 'complete'").collect()} == {"a.md", "c.md", "f.md"}
