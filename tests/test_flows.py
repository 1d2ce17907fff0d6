"""Fetching, listing, exports and runs of the queue, with getters that count."""

import json
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom import cli
from corpusloom.functions import extract
from corpusloom.operators import provider
from corpusloom.operators.queue_store import QueueStore
from corpusloom.plans import flows
from corpusloom.sources import files, posts, web

PAGE = "<html><body><article><p>" + "word " * 60 + "</p></article></body></html>"


def counting_getter(folder):
    """A getter that leaves a line for each call; tasks may run in other processes."""

    def get(url):
        with open(f"{folder}/calls", "a") as f:
            f.write(url + "\n")
        if "bad" in url:
            raise ValueError("404")
        return "text/html", PAGE

    return get


def test_only_missing_documents_are_fetched(spark, tmp_path):
    rows = [(i, "P", f"T{i}", f"http://h/{'bad' if i == 3 else 'x'}{i}.html", "1900-01-02") for i in range(5)] + [(5, "P", "again", "http://h/x1.html", "1900-01-03")]
    cat = spark.createDataFrame(rows, "row_pos long, pope string, title string, link string, published_date string").selectExpr("*", "'' AS subtitle", "'' AS doc_type")
    there = spark.createDataFrame([("02011900_P_T0.md", 900), ("02011900_P_T1.md", 10)], "name string, size long")
    documents, log = flows.fetch_missing(cat, there, get=counting_getter(tmp_path), pause=0)
    got = {r.file: (r.outcome, r.error) for r in log.collect()}
    assert got["02011900_P_T0.md"] == ("skipped", None) and got["02011900_P_T3.md"] == ("failed", "404") and len(got) == 6
    assert documents.count() == 4 and log.count() == 6
    assert sorted((tmp_path / "calls").read_text().split()) == [f"http://h/{x}.html" for x in ("bad3", "x1", "x2", "x4")]


def test_a_site_is_paced(spark, tmp_path):
    def sleep(s):
        with open(f"{tmp_path}/slept", "a") as f:
            f.write("x\n")

    links = [(f"http://{h}/{i}",) for h in ("a.org", "www.a.org", "b.org") for i in range(4)]
    df = spark.createDataFrame(links, "link string").repartition(4)
    assert web.fetch(df, get=counting_getter(tmp_path), pause=30, sleep=sleep).count() == 12
    assert len((tmp_path / "slept").read_text().split()) == 7 + 3


@pytest.fixture()
def site():
    """An interface on this machine that counts what it is asked for."""
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
    from urllib.parse import parse_qs, urlparse

    asked, posts = [], {4: 1503, 9: 100, 11: 0, 12: 7}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            u = urlparse(self.path)
            q = {k: v[0] for k, v in parse_qs(u.query).items()}
            asked.append((u.path, *sorted(q.items())))
            size, page = int(q.get("per_page", 10)), int(q.get("page", 1))
            code, found = 200, []
            if u.path == "/wp/categories":
                found = [{"id": c, "slug": f"s{c}", "name": f"n{c}", "count": {4: 1203, 9: 100, 11: 0, 12: 450}[c]} for c in posts][(page - 1) * size : page * size]
            elif u.path == "/wp/posts":
                numbers = [(c, i) for c in posts if str(c) == q.get("categories", str(c)) for i in range(posts[c])]
                if page > 1 and (page - 1) * size >= len(numbers):
                    code, found = 400, {"code": "rest_post_invalid_page_number"}
                else:
                    found = [{"link": f"l{c}-{i}", "title": {"rendered": "t"}, "date": "d"} for c, i in numbers[(page - 1) * size : page * size]]
            elif u.path == "/endless/posts":
                found = [{"link": f"l{i}"} for i in range(size)]
            elif u.path == "/wp/pages":
                found = [{"link": f"http://h/{q['slug']}", "title": {"rendered": q["slug"]}, "content": {"rendered": "<p>x</p>"}}] if q["slug"] != "none" else []
            else:
                code = 404
            body = json.dumps(found).encode()
            self.send_response(code)
            self.send_header("Content-Type", "application/json")
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked
    server.shutdown()


def test_every_post_of_a_listing(spark, site):
    """1503 posts where the interface counts 1203, 7 where it counts 450; each page is asked for once, and a partition is a page."""
    base, asked = site
    got = web.listing(spark, f"{base}/wp", categories=(4, 9, 11, 12), pause=0)
    assert got.rdd.getNumPartitions() == 13 + 1 + 1 + 5
    asked.clear()
    rows = got.collect()
    assert {(r.category, r.page, r.pos): r.link for r in rows} == {(c, i // 100 + 1, i % 100): f"l{c}-{i}" for c, n in ((4, 1503), (9, 100), (12, 7)) for i in range(n)}
    pages = [x for x in asked if x[0] == "/wp/posts"]
    assert len(pages) == len(set(pages)) and len([p for p in pages if ("categories", "4") in p]) == 16
    all_ = web.listing(spark, f"{base}/wp", pause=0)
    assert all_.count() == 1610 and all_.filter("category is null").count() == 1610
    with pytest.raises(Exception, match="repeats the page before"):
        web.listing(spark, f"{base}/endless", pause=0).count()
    with pytest.raises(Exception, match="404"):
        web.listing(spark, f"{base}/nowhere", pause=0).count()


def test_lanes_of_a_listing(spark, site):
    """With a pause pages are dealt to lanes, and requests are apart whoever makes them."""
    base, asked = site
    got = web.listing(spark, f"{base}/wp", categories=(4, 9, 12), pause=0.05, lanes=3)
    assert got.rdd.getNumPartitions() == 3
    began = time.time()
    assert got.count() == 1610
    n = len([x for x in asked if x[0] == "/wp/posts"])
    assert time.time() - began >= 0.05 * (n - 1)


def test_pages_and_categories(spark, site):
    base, _ = site
    read = lambda **o: spark.read.format(posts.register(spark)).option("base", f"{base}/wp").options(**o).load()
    assert sorted(tuple(r) for r in read(resource="pages", slugs="leo14,none,franc").select("slug", "link", "content").collect()) == [("franc", "http://h/franc", "<p>x</p>"), ("leo14", "http://h/leo14", "<p>x</p>")]
    assert sorted(tuple(r) for r in read(resource="categories").collect()) == [(4, "s4", "n4", 1203), (9, "s9", "n9", 100), (11, "s11", "n11", 0), (12, "s12", "n12", 450)]
    assert read(categories="*").count() == 1610


def test_a_large_site_is_paced_over_tasks(spark):
    """Ten thousand documents of one site, four tasks: all of them used, and no two documents begin closer than the pause."""
    pause = 0.001
    links = spark.range(10_000).selectExpr("concat('http://a.org/', id) AS link")
    got = web.fetch(links, get=lambda url: ("text/html", "x"), pause=pause, per_lane=2500, lanes=4, stamps=True)
    rows = got.withColumn("task", F.spark_partition_id()).collect()
    began = sorted(r.started for r in rows)
    assert len(rows) == 10_000 and min(b - a for a, b in zip(began, began[1:], strict=False)) >= pause
    assert len({r.task for r in rows}) >= 2


def test_lanes_that_meet_in_a_task_share_their_slots(spark):
    """One task has all lanes of a site: it takes each slot that comes, not only those of the lane of its next document."""
    pause = 0.002
    links = spark.range(1000).selectExpr("concat('http://a.org/', id) AS link")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        rows = web.fetch(links, get=lambda url: ("text/html", "x"), pause=pause, per_lane=250, lanes=4, stamps=True).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    began = sorted(r.started for r in rows)
    assert len(rows) == 1000 and min(b - a for a, b in zip(began, began[1:], strict=False)) >= pause
    assert began[-1] - began[0] < 1.8 * 1000 * pause * 1.25


def test_a_slow_document_holds_up_its_own_lane_only():
    """Turns of four lanes by a clock of our own: slots never meet, and a lane that comes late skips to its next one."""
    from corpusloom.sources.pacing import Lane

    now, starts = [1000.0], []

    def sleep(s):
        now[0] += s + 0.01  # sleeps overrun

    lanes = [Lane(1.0, k, 4, sleep, lambda: now[0]) for k in range(4)]
    for k in (0, 1, 2, 3, 0, 0, 2, 1, 3, 3):
        starts.append((lanes[k].wait(), k))
        now[0] += 7.3 if k == 2 else 0.1
    assert all(round(t / 1.25 - 0.1, 0) % 4 == k for t, k in starts)
    assert all(b[0] - a[0] >= 1 for a, b in zip(starts, starts[1:], strict=False))


def begins_of(own: list[tuple], lanes: int, pause: float, n: int, late: float) -> list[float]:
    """When ``n`` documents of each task begin that take no time; ``own``: the lanes of each.  Sleeps overrun, a look at the clock takes time."""
    from corpusloom.sources.pacing import Lane

    began = []
    for task in own:
        now, sleeps = [1_800_000_000.0123], []

        def sleep(s, now=now, sleeps=sleeps):
            sleeps.append(s)
            assert len(sleeps) <= 2 * n, "turns are missed again and again"
            now[0] += s + late

        def clock(now=now):
            now[0] += 1e-6
            return now[0]

        lane = Lane(pause, task[0], lanes, sleep, clock)
        for k in task[1:]:
            lane.add(k)
        began += [lane.wait() for _ in range(n)]
    return sorted(began)


def test_short_pauses_cost_their_slack_once_a_turn():
    """Documents of four lanes at 0.4 ms: a pause apart, in little more time than their pauses, though each sleep is late."""
    pause = 0.0004
    began = begins_of([(0,), (1,), (2,), (3,)], 4, pause, 1200, 0.00001)
    assert min(b - a for a, b in zip(began, began[1:], strict=False)) >= pause
    assert began[-1] - began[0] < 1.15 * 4800 * pause
    late = begins_of([(0,), (1,), (2,), (3,)], 4, pause, 120, 0.0003)  # later than the slack
    assert min(b - a for a, b in zip(late, late[1:], strict=False)) >= pause


def test_turns_of_one_task_that_follow_each_other_are_one():
    """A task with all lanes, and one with two that are neighbours: no slack where the next turn is the same task's."""
    for pause in (0.0004, 1.0):
        began = begins_of([(0, 1, 2, 3)], 4, pause, 1000, 0)
        assert min(b - a for a, b in zip(began, began[1:], strict=False)) >= pause
        assert began[-1] - began[0] < 1.02 * 1000 * pause
        shared = begins_of([(0, 1), (2,), (3,)], 4, pause, 400, 0)
        assert min(b - a for a, b in zip(shared, shared[1:], strict=False)) >= pause


def test_paced_site_compares_beginnings(spark, monkeypatch):
    """The query tells every document that begins too close to the one before it, in its second or the one before, and no other."""
    from corpusloom import flow_queries

    stamps = [100.0, 100.00045, 100.00084, 100.9998, 101.0001, 101.0006, 103.0]  # 0.45, 0.39 ms, ..., 0.3 ms over the second's end
    monkeypatch.setattr(flow_queries, "t", lambda spark, d, name: spark.range(len(stamps)).select(F.col("id").alias("c_custkey")))
    monkeypatch.setattr(web, "fetch", lambda links, **_: links.select("c_custkey", F.lit("page").alias("via"), F.element_at(F.array(*map(F.lit, stamps)), F.col("c_custkey").cast("int") + 1).alias("started")))
    got = {r.c_custkey: r.apart for r in flow_queries.paced_site(spark, "").collect()}
    assert got == {0: True, 1: True, 2: False, 3: True, 4: False, 5: True, 6: True}


def test_registry_and_sections(spark):
    html = '<p><a href="/category/saints/leo13/">Leo XIII</a> <a href="/franc">Francis</a><a href="">none</a><a href="https://h/jp02/?x=1"></a></p>'
    got = web.registry(spark.createDataFrame([(html, "https://h/popelist")], "content string, link string")).collect()
    assert [(r.pope, r.pope_url, r.category, r.page) for r in got] == [("Leo XIII", "https://h/category/saints/leo13/", "leo13", None), ("Francis", "https://h/franc", None, "franc")]
    page = '<a href="/before">no heading</a><h3>Encyclicals</h3><ul><li><a href="http://www.vatican.va/a.html">A <b>b</b></a></li></ul><h3>Motu  Proprio</h3><a href="c.PDF?x">C</a><h3> Additional Links </h3><a href="/d">D</a><h3>Speeches</h3><a href="/e">E</a>'
    rows = web.section_rows(spark.createDataFrame([("P", page, "https://h/p"), ("Q", None, "https://h/q")], "pope string, content string, link string")).orderBy("pos").collect()
    assert [(r.title, r.doc_type, r.format, r.link, r.source) for r in rows] == [
        ("A b", "encyclical", "html", "http://www.vatican.va/a.html", "vatican"), ("C", "motu_proprio", "pdf", "https://h/c.PDF?x", "papalencyclicals"), ("E", "other", "html", "https://h/e", "papalencyclicals"),
    ]



def test_export(spark, tmp_path):
    df = spark.createDataFrame([(f"d{i}.md", f"text {i}\nline") for i in range(7)], "filename string, text string").repartition(3)
    assert files.export_markdown(df, str(tmp_path / "out")) == 7
    assert {(r.name, r.text) for r in files.read_texts(spark, str(tmp_path / "out")).collect()} == {(f"d{i}.md", f"text {i}\nline") for i in range(7)}
    with pytest.raises(ValueError):
        files.export_markdown(df, str(tmp_path / "out"), most=6)


def test_run_remaining(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    for i in range(7):
        (src / f"s{i}.md").write_text("labour and prayer " * 60 if i else "bad")
    parse = cli.parser().parse_args
    args = [str(tmp_path / "q"), "--sources", str(src), "--reports", str(tmp_path / "rep")]

    def answer(text):
        if text == "bad":
            raise ValueError("no answer")
        return provider.stub_gradient(text)

    assert cli.run_remaining(spark, parse(["run-remaining", *args, "--init", "--dry-run"])) == ["reset_stale", "run"]
    store = cli.QueueStore(spark, str(tmp_path / "q"))
    assert store.items().filter("status = 'pending'").count() == 7
    assert store.meta().select("step", "batch_size", "total").first() == ("step3", 30, 7)
    assert cli.run_remaining(spark, parse(["run-remaining", *args, "--limit", "3"]), answer) == ["reset_stale", "run", "status"]
    assert store.items().filter("status = 'pending'").count() == 4
    cli.run_remaining(spark, parse(["run-remaining", *args]), answer)
    assert {r.source_file: (r.status, r.error) for r in store.items().collect()} == {f"s{i}.md": ("complete", None) if i else ("failed", "no answer") for i in range(7)}
    got = files.read_texts(spark, str(tmp_path / "rep")).select(extract.gradient(extract.gradient_json("text")).alias("g")).select("g.*").distinct().collect()
    assert len(got) == 1 and float(got[0]["reflective_saturation"]) > 0.3 and float(got[0]["prescriptive_density"]) > 0.3


def test_command_that_fails_ends_the_run():
    with pytest.raises(RuntimeError):
        flows.run_commands([("a", {}), ("b", {})], lambda name, options: int(name == "a"))


def test_braces_in_a_string_are_no_object(spark):
    from pyspark.sql import functions as F

    block = '{"prescriptive": "{no object", "prospective": {"saturation": 2, "density": 3}}'
    text = f"## Gradients\n\n```json\n{block}\n```\n"
    row = spark.createDataFrame([(text,)], "t string").select(extract.gradient(extract.gradient_json(F.col("t"))).alias("g")).select("g.*").first()
    assert row["prescriptive_saturation"] == "2" and row["prescriptive_density"] == "3"


def test_calls_of_a_whole_job_are_bounded(spark, tmp_path):
    """A provider that writes down when it begins and ends: never more than five calls at once, however many tasks there are."""

    def slow(text):
        began = time.time()
        time.sleep(0.02)
        with open(f"{tmp_path}/calls", "a") as f:
            f.write(f"{began} {time.time()}\n")
        if text == "7":
            raise ValueError("no")
        return text

    df = spark.range(120).selectExpr("id", "CASE WHEN id = 5 THEN null ELSE cast(id AS string) END AS text").repartition(12)
    got = {r.id: (r.report, r.error) for r in provider.call(df, "text", "id", slow, concurrency=5).collect()}
    assert got == {i: (None, "no text") if i == 5 else (None, "no") if i == 7 else (str(i), None) for i in range(120)}
    calls = [tuple(map(float, line.split())) for line in (tmp_path / "calls").read_text().splitlines()]
    at_once = [sum(a <= t < b for a, b in calls) for t, _ in calls]
    assert len(calls) == 119 and 2 <= max(at_once) <= 5
    assert provider.call(df, "text", "id", slow, concurrency=7, tasks=3).rdd.getNumPartitions() == 3
    with pytest.raises(ValueError, match="no calls"):
        provider.call(df, "text", "id", slow, concurrency=0)


def test_long_texts_are_called_for_in_rounds(spark, tmp_path, monkeypatch):
    """More text than the tasks may have: no task gets more than its share, calls stay bounded, every row has its answer once."""
    monkeypatch.setattr(provider, "TASK_BYTES", 1000, raising=False)

    def slow(text):
        from pyspark import TaskContext

        began = time.time()
        time.sleep(0.01)
        with open(f"{tmp_path}/calls", "a") as f:
            f.write(f"{began} {time.time()} {TaskContext.get().taskAttemptId()}\n")
        if text.startswith("7 "):
            raise ValueError("no")
        return text[:3]

    df = spark.range(120).selectExpr("id AS `a key`", "CASE WHEN id = 5 THEN null ELSE rpad(concat(id, ' '), 100, 'x') END AS text").repartition(3)
    got = [(r["a key"], r.report, r.error) for r in provider.call(df, "text", "a key", slow, concurrency=3, tasks=2).collect()]
    assert sorted(got) == [(i, None, "no text") if i == 5 else (i, None, "no") if i == 7 else (i, f"{i} xx"[:3], None) for i in range(120)]
    calls = [(float(a), float(b), task) for a, b, task in map(str.split, (tmp_path / "calls").read_text().splitlines())]
    assert len(calls) == 119 and max(sum(a <= t < b for a, b, _ in calls) for t, _, _ in calls) <= 3
    assert max(Counter(task for _, _, task in calls).values()) <= 15


def test_a_batch_is_marked_once(spark, tmp_path):
    docs, out = tmp_path / "docs", tmp_path / "reports"
    docs.mkdir()
    for k in range(7):
        (docs / f"d{k}.md").write_text("bad" if k == 3 else f"text {k}")
    store = QueueStore(spark, str(tmp_path / "q"))
    store.init(spark.createDataFrame([(f"d{k}.md",) for k in range(8)], "name string"), spark.createDataFrame([], "report_file string, size long"))

    def answer(text):
        if text == "bad":
            raise ValueError("refused")
        return "" if text == "text 5" else text.upper()

    assert flows.run_rest(store, str(docs), str(out), answer, size=5) == 8
    state = {r.source_file: (r.status, r.error) for r in store.items().collect()}
    assert state == {f"d{k}.md": ("failed", "refused") if k == 3 else ("failed", "no source") if k == 7 else ("complete", None) for k in range(8)}
    assert [r.event for r in store.log().orderBy("version").collect()] == ["init", "next_batch", "mark_all", "next_batch", "mark_all"]
    assert (out / "run-d1.md").read_text() == "TEXT 1" and not (out / "run-d3.md").exists()


def test_a_service_behind_an_address(spark):
    """Answers read from a field, errors in their rows, another try where the service says so."""
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            text = body["messages"][1]["content"]
            asked.append((text, self.headers["X-Key"], body["model"]))
            code = 400 if text == "bad" else 503 if text == "down" else 429 if text == "busy" and [a[0] for a in asked].count("busy") < 3 else 200
            self.send_response(code)
            if code == 429:
                self.send_header("Retry-After", "0")
            self.end_headers()
            if code == 200:
                self.wfile.write(json.dumps({"choices": [{"message": {"content": text.upper() if text != "empty" else None}}]} if text != "odd" else {"choices": []}).encode())

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        body = {"model": "m", "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": None}]}
        service = provider.HttpProvider(f"http://127.0.0.1:{server.server_port}/x", "choices.0.message.content", body, {"X-Key": "k"}, pause=0.01)
        df = spark.createDataFrame([(t,) for t in ("one", "bad", "down", "busy", "empty", "odd", "é")], "text string")
        got = {r.key: (r.report, r.error) for r in provider.call(df.withColumn("key", F.col("text")), "text", "key", service).collect()}
    finally:
        server.shutdown()
    assert got["one"] == ("ONE", None) and got["busy"] == ("BUSY", None) and got["é"] == ("É", None)
    assert "400" in got["bad"][1] and "503" in got["down"][1] and got["empty"][1] == "no text in choices.0.message.content" and got["odd"][1] == "no choices.0.message.content in the answer"
    times = [a[0] for a in asked]
    assert (times.count("bad"), times.count("down"), times.count("busy")) == (1, 3, 3) and {a[1:] for a in asked} == {("k", "m")}
