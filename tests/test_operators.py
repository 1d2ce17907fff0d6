import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import catalog, match, merge, naming, prompt, provider, recover, work_queue
from corpusloom.plans import flows
from corpusloom.sources import files, web

def now():
    return F.lit("2026-01-01T00:00:00+00:00")


def test_names_follow_input_order(spark):
    rng = random.Random(3)
    rows = [(i, "", rng.choice("AB"), "t", f"http://x/{rng.choice('ab')}.htm") for i in range(60)]
    used, want = set(), {}
    for pos, _, author, title, link in rows:
        base = f"00000000_{author}_{title}"
        name, n = base, 2
        while name in used:
            name = f"{base}_{link[-5]}_{n}"
            n += 1
        used.add(name)
        want[pos] = name
    df = spark.createDataFrame(rows, "row_pos int, published_date string, pope string, title string, link string")
    named = naming.unique_stems(df.repartition(3))
    got = {r.row_pos: r.stem for r in named.collect()}
    # Numbers count by base and link stem, as the fixtures have it: base_a_2, base_b_2.
    for author in "AB":
        own = [r for r in rows if r[2] == author]
        assert got[own[0][0]] == want[own[0][0]]
        seen = Counter()
        for r in own[1:]:
            slug = r[4][-5]
            seen[slug] += 1
            assert got[r[0]] == f"00000000_{author}_t_{slug}_{seen[slug] + 1}"
    assert naming.clashes(named).count() == 0


def one_by_one(rows):
    """Row by row, as a loop over a set of used names does it."""
    used, out = set(), {}
    for pos, _, author, title, link in sorted(rows):
        base, slug = f"00000000_{author}_{title}", link.rsplit("/", 1)[1].rsplit(".", 1)[0]
        name, n = base, 2
        while name in used:
            name, n = f"{base}_{slug}_{n}", n + 1
        used.add(name)
        out[pos] = name
    return out


@pytest.mark.parametrize(("seed", "most"), [(1, 1000), (2, 3)])
def test_made_up_names_meet_others(spark, seed, most):
    """Bases that equal names made up for other rows, before and after these, and made-up names that meet each other."""
    rng = random.Random(seed)
    titles, slugs = ("t", "t_a_2", "t_a_2_a_2", "t_b_3", "t_a", "t_2_2", "t_a_007", "t_a_3"), ("a", "b", "2", "a_2", "a_2_a")
    rows = [(i * 7, "", "A", rng.choice(titles), f"http://x/{rng.choice(slugs)}.htm") for i in range(120)]
    df = spark.createDataFrame(rows, "row_pos int, published_date string, pope string, title string, link string").repartition(4)
    named = naming.unique_stems(df, most=most)
    got = {r.row_pos: r.stem for r in named.collect()}
    assert got == one_by_one(rows)
    assert len(set(got.values())) == 120 and set(named.columns) == {*df.columns, "stem"}


def test_names_without_clashes_are_left(spark, monkeypatch):
    """Where no name is met nothing is repaired, and an empty table has no names."""
    df = spark.createDataFrame([(i, "", "A", f"t{i % 5}", "http://x/a.htm") for i in range(50)], "row_pos int, published_date string, pope string, title string, link string")
    monkeypatch.setattr(naming, "repair", lambda df, pos: pytest.fail("repaired"))
    assert naming.clashes(naming.unique_stems(df)).count() == 0
    assert naming.unique_stems(df.limit(0)).count() == 0


def test_repairs_broadcast_no_names(spark, monkeypatch):
    """Names are put together from narrow columns, so Spark takes them for small: only what has a row for each range may be sent whole."""
    from corpusloom.sources import files

    plans = []

    def settle(df, own=files.settle):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return own(df)

    monkeypatch.setattr(files, "settle", settle)
    title = F.concat(F.lit("T"), F.floor(F.col("id") / 4), F.when(F.col("id") % 4 == 2, "_s_2").otherwise(""))
    rows = spark.range(20).select(F.col("id").alias("row_pos"), F.lit("").alias("published_date"), F.lit("P").alias("pope"), title.alias("title"), F.lit("http://h/s").alias("link"))
    named = naming.unique_stems(rows)
    plans.append(named._jdf.queryExecution().executedPlan().toString())
    assert naming.clashes(named).count() == 0 and named.count() == 20
    joins = [line for plan in plans for line in plan.splitlines() if "Join" in line]
    assert any("SortMergeJoin" in x for x in joins) and not [x for x in joins if "Broadcast" in x and "_part" not in x]


def test_numbers(spark):
    names = [f"n{i * 37 % 101:03}" for i in range(101)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    assert {r.name: r.id for r in naming.number_by_name(df, "name").collect()} == {n: i for i, n in enumerate(sorted(names), 1)}


def test_match_rules(spark):
    index = spark.createDataFrame([("P", 0, "Rerum something", "u0"), ("P", 1, "rerum novarum here", "u1"), ("P", 2, "Rerum Novarum here", "u2"), ("Q", 0, "rerum novarum", "u3")], "pope string, pos int, text string, url string")
    wanted = spark.createDataFrame([("a", "P", "Rerum Novarum"), ("b", "P", "Rerum"), ("c", "P", "Rerum aliud"), ("d", "P", "Other thing"), ("e", "P", ""), ("f", "P", None)], "link string, pope string, title string")
    got = {r.link: (r.url, r.score) for r in match.best_matches(wanted, index).collect()}
    assert got["a"] == ("u1", 12)
    assert got["b"] == ("u0", 11)
    assert got["c"][0] == "u0"  # one word and the first word in front: 4
    assert not {"d", "e", "f"} & set(got)
    overrides = spark.createDataFrame([("a", "m")], "link string, url string")
    assert {r.link: r.method for r in match.resolve(wanted, index, overrides).collect()}["a"] == "manual"


def test_matches_are_the_best_of_all_pairs(spark):
    rng = random.Random(3)
    words = ["a", "on", "the", "then", "other", "cat", "catalog", "cats", "faith", "and"]

    def line():
        return " ".join(rng.choice(words) for _ in range(rng.choice((0, 1, 1, 2, 3, 4))))

    wanted = [(i, rng.choice("PPQ"), line()) for i in range(300)] + [(300, None, "faith"), (301, "P", None), (302, "R", "faith"), (303, "S", "on faith")]
    index = [(rng.choice("PPQ"), i, line(), f"u{i}") for i in range(120)] + [(None, 120, "faith", "u120"), ("P", 121, None, "u121"), ("S", 122, "cat faith", "u122")]
    want = {}
    for key, author, title in wanted:
        own, best = {w for w in (title or "").split() if len(w) > 2}, (0, 1, "")
        for who, pos, text, url in index:
            if own and author is not None and who == author:
                bonus = 10 if title in (text or "") else 3 if (text or "").startswith(title.split()[0]) else 0
                best = max(best, (len(own & {w for w in (text or "").split() if len(w) > 2}) + bonus, -pos, url))
        if best[0] >= (1 if len(own) == 1 else 2):
            want[key] = (best[2], best[0])
    left = spark.createDataFrame(wanted, "link long, pope string, title string")
    right = spark.createDataFrame(index, "pope string, pos long, text string, url string")
    assert {r.link: (r.url, r.score) for r in match.best_matches(left, right).collect()} == want
    assert {v[1] for v in want.values()} >= {1, 2, 3, 4, 11, 12}
    assert match.best_matches(left.limit(0), right).count() == match.best_matches(left, right.limit(0)).count() == 0


def test_reports_and_tiers(spark):
    names = [("run-s.md", "1"), ("s.md", "2"), ("run-t.md.md", "3")]
    got = {r.stem: r.text for r in merge.reports_by_stem(spark.createDataFrame(names, "name string, text string")).collect()}
    assert got["s"] == "1" and got["t"] == "3"
    block = "## Gradients\n```json\n%s\n```\n"
    tiers = [("s", "gemini", block % "{broken}"), ("s", "perplexity", block % "{}"), ("s", "deep-research", block % '{"reflective_saturation": 3}'), ("x", "gemini", "none")]
    assert [(r.stem, r.tier) for r in merge.first_tier(spark.createDataFrame(tiers, "stem string, tier string, text string")).collect()] == [("s", "deep-research")]


def test_columns():
    assert merge.ordered_columns([]) == [*merge.BASE_COLUMNS, *merge.ANALYSIS_COLUMNS]
    assert merge.ordered_columns(["z", "link", "pope", "summary"]) == ["pope", "link", "z", *merge.ANALYSIS_COLUMNS]


def test_density_alone_does_not_count(spark):
    rows = [("", "1", "", "1"), ("0", "", "", ""), ("1", "2", "3", "4")]
    df = spark.createDataFrame(rows, "reflective_saturation string, reflective_density string, prescriptive_saturation string, prescriptive_density string")
    assert [tuple(r) for r in df.select(merge.has_any(), merge.has_full()).collect()] == [(False, False), (True, False), (True, True)]


def test_enrich_flow(spark):
    cat = spark.createDataFrame([(0, "P", "T", "1891-05-15", "http://x/a.htm", "keep", "stale")], "row_pos long, pope string, title string, published_date string, link string, extra string, category string")
    themes = spark.createDataFrame([("run-15051891_P_T.md", "- **Key theme:** Mixed\n- **Summary:** s\n")], "name string, text string")
    tiers = spark.createDataFrame([("perplexity", "run-15051891_P_T.md.md", '## Gradients\n```json\n{"reflective": {"saturation": 1, "density": 2}}\n```')], "tier string, name string, text string")
    rows, stats, buckets = flows.enrich_catalog(cat, themes, tiers)
    assert rows.columns == ["pope", "title", "published_date", "link", "row_pos", "extra", *merge.ANALYSIS_COLUMNS]
    assert rows.first()["category"] == "Mixed" and rows.first()["reflective_density"] == "2"
    assert stats.first()["gradients_perplexity"] == 1 and stats.first()["missing_reports"] == 0
    assert [tuple(r)[1:] for r in buckets.collect()] == [("Mixed", 1, 0)]


def items(spark, *rows):
    full = [(i, f"f{i}", f"run-f{i}", s, "b", "s", None, e, "a") for i, s, e in rows]
    return spark.createDataFrame(full, "id long, source_file string, report_file string, status string, batch_id string, started_at string, completed_at string, error string, agent_id string")


def present(spark, *rows):
    return spark.createDataFrame([(f"run-f{i}", n) for i, n in rows], "report_file string, size long")


def state(df):
    return {r.id: r for r in df.collect()}


def test_sync_and_reset(spark):
    q = items(spark, (1, "failed", "x"), (2, "skipped", None), (3, "in_progress", "y"), (4, "in_progress", "z"), (5, "complete", None))
    p = present(spark, (1, 500), (2, 499), (3, 500))
    s = state(work_queue.sync(q, p, now()))
    assert (s[1].status, s[1].error, s[2].status, s[5].status) == ("complete", None, "skipped", "complete")
    r = state(work_queue.reset_stale(q, p, now()))
    assert (r[3].status, r[3].error, r[3].batch_id) == ("complete", "y", "b")
    assert (r[4].status, r[4].error, r[4].batch_id, r[4].started_at, r[4].agent_id) == ("pending", "z", None, None, None)
    assert r[1].status == "failed"


def test_mark_and_batch(spark):
    q = items(spark, (1, "pending", None), (2, "pending", None), (3, "in_progress", None))
    m = state(work_queue.mark(q, 3, "failed", now(), agent="z"))
    assert (m[3].status, m[3].error, m[3].agent_id) == ("failed", "unknown error", "z") and m[3].completed_at
    with pytest.raises(ValueError, match="marked"):
        work_queue.mark(q, 3, "in_progress", now())
    with pytest.raises(ValueError, match="negative"):
        work_queue.next_batch(q, now(), -1)
    after, batch = work_queue.next_batch(q, now(), 1)
    assert [r.id for r in batch.collect()] == [1]
    assert {i: r.status for i, r in state(after).items()} == {1: "in_progress", 2: "pending", 3: "in_progress"}
    none = q.filter("id < 0")
    assert {r.status: r.n for r in work_queue.histogram(none).collect()} == dict.fromkeys(work_queue.STATUSES, 0)
    assert work_queue.progress(none).first()["percent"] is None


def test_recovery(spark):
    cat = spark.createDataFrame([(0, "P", "Rerum Novarum", "l1"), (1, "P", "New Title", "l1"), (2, "P", "x", web.SKIP_LINKS[0])], "row_pos long, pope string, title string, link string")
    failed = spark.createDataFrame([("f1", "l1"), ("f2", "gone"), ("f3", web.SKIP_LINKS[0])], "file string, link string")
    index = spark.createDataFrame([("P", 0, "the new title", "u")], "pope string, pos int, text string, url string")
    got = {r.file: (r.action, r.reason, r.url) for r in flows.recover_failed(cat, failed, index, spark).collect()}
    assert got == {"f1": ("retry", None, "u"), "f2": ("still_failed", recover.NOT_FOUND, None), "f3": ("skipped", recover.STUB, None)}


def test_log_reconciliation(spark):
    s = spark.createDataFrame([("a",)], "file string")
    r = spark.createDataFrame([("a",), ("b",), ("b",)], "file string")
    assert sorted(x.file for x in recover.with_recovered(s, r).collect()) == ["a", "b", "b"]


def test_catalog(spark):
    df = spark.createDataFrame([(0, "http://A.x/b/?q"), (1, "https://a.x/b"), (2, "https://a.x/B")], "pos int, url string")
    assert sorted(r.pos for r in catalog.dedupe_urls(df).collect()) == [0, 2]


def test_fetch(spark):
    def get(url):
        if "posts?slug=good" in url:
            return "application/json", '[{"content": {"rendered": "' + "<p>word</p>" * 30 + '"}}]'
        if "posts?slug" in url:
            return "application/json", "[]"
        if "pdf" in url:
            return "application/pdf", ""
        if "bad" in url:
            raise OSError("404")
        return "text/html", "<body><p>" + "page " * 50 + "</p></body>"

    links = ["http://papalencyclicals.net/good.htm", "http://papalencyclicals.net/other.htm", "http://h/x.pdf", "http://h/bad", None]
    df = spark.createDataFrame([(link,) for link in links], "link string")
    got = {r.link: (r.via, r.error) for r in web.fetch(df, get=get, api_base="http://api", pause=0).collect()}
    assert got[links[0]] == ("api", None) and got[links[1]] == ("page", None)
    assert got[links[2]] == (None, web.NO_PDF) and got[links[3]] == (None, "404")


def test_fetch_flow(spark):
    cat = spark.createDataFrame([(i, "P", f"T{i}", "", "", "d", "html", f"l{i}", "") for i in range(4)], "row_pos long, pope string, title string, subtitle string, published_date string, doc_type string, format string, link string, source string")
    there = spark.createDataFrame([("00000000_P_T0.md", 201), ("00000000_P_T1.md", 200)], "name string, size long")
    page = "<body><p>" + "word " * 40 + "</p></body>"
    pages = spark.createDataFrame([("l1", page, "page", None), ("l2", "<body>short</body>", "page", None), ("l3", None, None, "404")], "link string, html string, via string, error string")
    documents, log = flows.fetch_catalog(cat, there, pages)
    assert {r.link: r.outcome for r in log.collect()} == {"l0": "skipped", "l1": "success", "l2": "failed", "l3": "failed"}
    text = documents.first()["text"]
    assert text.startswith("# T1\n\n---\npope: P\ntitle: T1\ndoc_type: d\nsource: l1\n---\n\nword word")


def test_files(spark, tmp_path):
    (tmp_path / "c.csv").write_text('pope,title,link,notes\nA,"x, ""y""\nz",l,\n', encoding="utf-8")
    row = files.read_catalog(spark, str(tmp_path / "c.csv")).first()
    assert (row.title, row.format, row.subtitle) == ('x, "y"\nz', "html", "")
    assert files.read_csv(spark, str(tmp_path / "c.csv")).columns == ["row_pos", "pope", "title", "link", "notes"]
    (tmp_path / "bad.csv").write_text("pope,title\nA,b\n")
    with pytest.raises(KeyError, match="link"):
        files.read_catalog(spark, str(tmp_path / "bad.csv"))
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a b+c'.md").write_bytes(b"x\r\ny")
    assert [tuple(r) for r in files.read_texts(spark, str(docs)).collect()] == [("a b+c'.md", "x\ny")]
    assert [tuple(r) for r in files.list_files(spark, str(docs)).collect()] == [("a b+c'.md", 4)]
    files.append_events(spark.createDataFrame([("t", "init", 3)], "ts string, event string, total int"), str(tmp_path / "log"))
    files.append_events(spark.createDataFrame([("u", "sync")], "ts string, event string"), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    files.write_csv(spark.range(2).toDF("a"), str(tmp_path / "out"), ["a"])
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 2
    files.write_json(spark.range(1).toDF("a"), str(tmp_path / "dry"), dry_run=True)
    assert not (tmp_path / "dry").exists()


def test_cached_index(spark, tmp_path):
    pages = spark.createDataFrame([("P", 0, "http://h/", '<a href="x.html">long one</a><a href="x.html">again x</a>')], "pope string, page_pos int, base string, html string")
    calls = []

    def build():
        calls.append(1)
        return web.index_links(pages)

    for _ in range(2):
        assert [(r.text, r.url) for r in web.cached_index(spark, str(tmp_path / "i"), build).collect()] == [("long one", "http://h/x.html")]
    assert len(calls) == 1


def test_provider_errors(spark):
    def bad(text):
        raise RuntimeError("down")

    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, text string")
    assert {r.id: r.error for r in provider.call(df, "text", "id", bad).collect()} == {1: "down", 2: "no text"}


def test_commands():
    assert [c for c, _ in flows.remaining_commands(dry_run=True)] == ["reset_stale", "run"]
    assert flows.remaining_commands(limit=3)[1][1]["limit"] == 3 and "limit" not in flows.remaining_commands()[1][1]


def test_request_has_no_alternate(spark):
    cat = spark.createDataFrame([("s", "P", "T", "", "l", "f", "alt")], "stem string, pope string, title string, published_date string, link string, source_file string, alternate_url string")
    th = spark.createDataFrame([("s", "r", "THEME")], "stem string, theme_report string, theme_text string")
    text = prompt.research_request(cat, th, "tpl").first()["request"]
    assert "- Alternate URL: alt" in text and "- Published: Unknown" in text and text.endswith("THEME\n\ntpl")
