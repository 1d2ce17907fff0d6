import pytest
from pyspark.sql import functions as F

from corpusloom.functions import extract, html, scalars


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(make(F.col("c")).alias("x")).first()[0]


@pytest.mark.parametrize(("value", "want"), [
    ("1891-05-15", "15051891"), ("", "00000000"), ("1891", "00000000"), (None, "00000000"), ("1891-05-15T10:00", "15051891"), ("1891/05/15", None),
])
def test_date(spark, value, want):
    assert one(spark, value, scalars.ddmmyyyy) == want


@pytest.mark.parametrize(("value", "want"), [
    ('A: "B" / C?  ', "A B C"), ("x" * 99 + " .y", "x" * 99), ("...", ""), ("Tab\tand nbsp", "Tab and nbsp"), (None, ""),
])
def test_file_part(spark, value, want):
    assert one(spark, value, scalars.file_part) == want


@pytest.mark.parametrize(("value", "want"), [
    ("https://a.net/leo13/l13.htm", "l13"), ("https://a.net/leo14/", "leo14"), ("https://a.net/x?y=1.2", "x?y=1"), ("", "doc"), (None, "doc"), ("https://a.net/.htm", ".htm"),
])
def test_url_stem(spark, value, want):
    assert one(spark, value, scalars.url_stem) == want


def test_slug(spark):
    assert one(spark, "https://a.net/b/c-d.htm?x=1/2", scalars.url_path_stem) == "c-d"


@pytest.mark.parametrize(("value", "want"), [("Cælestis Patér—I", "c lestis pater i"), ("Celebationem Magni!", "celebrationem magni"), ("ﬁdes № 5", "fides no 5"), ("<i>De</i> R&amp;B", "de r b"), (None, "")])
def test_title(spark, value, want):
    assert one(spark, value, scalars.normal_title) == want


@pytest.mark.parametrize(("value", "want"), [
    ("Social", "Social"), ("Mixed (Spiritual and Social)", "Mixed-variant"), ("Spiritual | Mixed", "Mixed-variant"), ("mixed", "other"), ("Not stated in text", "other"), ("", "empty"), (None, "empty"),
])
def test_bucket(spark, value, want):
    assert one(spark, value, scalars.theme_bucket) == want


def test_small_scalars(spark):
    assert one(spark, "2026-06-24T10:40:58+00:00", scalars.batch_id) == "batch-20260624T104058+0000"
    assert one(spark, "dco:http://x", scalars.after_prefix) == "http://x"
    assert one(spark, "http://x", scalars.after_prefix) is None
    assert one(spark, 'junk Title HYPERLINK "u" text', lambda c: scalars.clean_converted(c, "Title")).split() == ["Title", "text"]
    assert one(spark, "", lambda c: scalars.or_else(c, F.lit("now"))) == "now"
    got = spark.createDataFrame([("http://a.b/c/d.html", "../e.html")], "a string, b string").select(scalars.join_url("a", "b")).first()[0]
    assert got == "http://a.b/e.html"
    assert one(spark, "2020-01-02", scalars.iso_to_date).isoformat() == "2020-01-02"
    assert one(spark, "2020-13-02", scalars.iso_to_date) is None


@pytest.mark.parametrize(("text", "theme"), [("- **key THEME:**  Mixed  \n", "Mixed"), ("nothing", ""), (None, "")])
def test_key_theme(spark, text, theme):
    assert one(spark, text, extract.key_theme) == theme


@pytest.mark.parametrize(("text", "want"), [("- **Summary:** one\ntwo", "one"), ("- **Summary:**\n- **Response to:** x", "- **Response to:** x")])
def test_summary(spark, text, want):
    assert one(spark, text, extract.summary) == want


def fenced(s):
    return f"## Gradients\n\nsome words\n```json\n{s}\n```\n"


@pytest.mark.parametrize(("block", "want"), [
    ('{"reflective":{"saturation":7,"density":-12},"prescriptive":{"saturation":4,"density":5}}', ("7", "-12", "4", "5")),
    ('{"prospective":{"saturation":4,"density":5}}', ("", "", "4", "5")),
    ('{"prescriptive":{},"prospective":{"saturation":4}}', ("", "", "", "")),
    ('{"reflective_saturation":0}', ("0", "", "", "")),
    ('{"reflective":{"saturation":8.0,"note":"x"}}', ("8.0", "", "", "")),
])
def test_gradient(spark, block, want):
    assert tuple(one(spark, fenced(block), lambda c: extract.gradient(extract.gradient_json(c)))) == want


@pytest.mark.parametrize("text", ["no heading", fenced("{broken}"), fenced("[1, 2]"), None])
def test_no_gradient(spark, text):
    assert one(spark, text, extract.gradient_json) is None


def test_front_matter(spark):
    text = '# T\n\n---\npope: A\nurl: http://x:1\ntitle: "Q"\n---\n\nbody'
    assert one(spark, text, lambda c: extract.front_value(c, "url")) == "http://x:1"
    assert one(spark, text, lambda c: extract.front_value(c, "title")) == "Q"
    assert one(spark, text, lambda c: extract.front_value(c, "none")) is None


PAGE = """<html><body><nav>menu</nav><article class="post"><h1 class="entry-title">T</h1><p>One <b>two</b> <a href="x.html">three</a></p>
<div class="Authority">gone</div><a href="m">Continue reading</a><img src="i"><ul><li>a</li><li>b</li></ul><h2>Kept</h2><script>no</script></article></body></html>"""


def test_content():
    assert html.markdown(html.content(PAGE, "http://a.net")) == "One **two** [three](<x.html>)\n\n  * a\n  * b\n\n## Kept"
    assert html.content('<body><div class="documento">d</div><div class="testo">t</div></body>', "http://www.vatican.va/x").text() == "t"
    with pytest.raises(ValueError, match="main content"):
        html.content("no body", "http://a.net")


def test_links():
    assert html.links('<a href="b.html"> A <i>long</i> one</a><a href="c.html">abc</a><a href="d.pdf">long</a>', "http://h/x/") == [("A long one", "http://h/x/b.html")]


def test_body_errors(spark):
    rows = [(PAGE, "u"), (None, "u"), ("", "u"), ("<body><p>" + "word " * 40 + "</p></body>", "u"), ("<div>" * 3000, None)]
    got = spark.createDataFrame(rows, "h string, u string").select(html.page_body("h", "u").alias("b")).select("b.*").collect()
    assert [r.value is not None for r in got] == [False, False, False, True, False]
    assert all((r.value is None) != (r.error is None) for r in got)


def test_pages_go_to_python_in_small_batches(spark, tmp_path, monkeypatch):
    """A batch of pages has a bound in bytes, however long they are; a bound of the session's own stays."""
    import pandas as pd

    from corpusloom import queries

    @F.pandas_udf(html.OUTCOME)
    def characters(page: pd.Series, url: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"value": [str(page.str.len().sum())] * len(page), "error": None})

    monkeypatch.setattr(queries.html_functions, "page_body", characters)
    spark.range(300).select(F.col("id").alias("page_id"), F.lit("http://h/").alias("url"), F.repeat(F.lit("x"), 100_000).alias("html")).coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    largest = lambda: queries.QUERIES["html_markdown_body"](spark, str(tmp_path)).agg(F.max(F.col("value").cast("long"))).first()[0]
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        assert 100_000 <= largest() <= 5_000_000
        spark.conf.set(key, "1m")
        assert largest() <= 1_500_000
    finally:
        spark.conf.set(key, before)
