import pytest
from pyspark.sql import functions as F

from corpusloom import cli
from corpusloom.operators.queue_store import QueueStore


def reports(spark, *rows):
    return spark.createDataFrame([(f"run-{n}", s) for n, s in rows], "report_file string, size long")


def test_life_of_a_queue(spark, tmp_path):
    store = QueueStore(spark, str(tmp_path / "q"), F.lit("2026-06-24T10:40:58+00:00"), keep=2)
    with pytest.raises(FileNotFoundError):
        store.items()
    names = spark.createDataFrame([("c.md",), ("a.md",), ("b.md",)], "name string")
    with pytest.raises(ValueError, match="no source"):
        store.init(names.limit(0), reports(spark, ("x", 1)))
    store.init(names, reports(spark, ("b.md", 500), ("c.md", 499)))
    with pytest.raises(FileExistsError):
        store.init(names, reports(spark, ("x", 1)))
    state = lambda: {r.source_file: (r.id, r.status) for r in store.items().collect()}
    assert state() == {"a.md": (1, "pending"), "b.md": (2, "complete"), "c.md": (3, "pending")}
    assert [r.id for r in store.next_batch(5)] == [1, 3]
    assert store.next_batch(5) == []
    store.mark(1, "failed")
    with pytest.raises(KeyError):
        store.mark(9, "failed")
    assert store.sync(reports(spark, ("a.md", 700))) == 1
    assert store.reset_stale(reports(spark, ("a.md", 700))) == 1
    assert state() == {"a.md": (1, "complete"), "b.md": (2, "complete"), "c.md": (3, "pending")}
    counts, progress = store.status()
    assert {r.status: r.n for r in counts.collect()} == {"pending": 1, "complete": 2, "failed": 0, "skipped": 0, "in_progress": 0}
    assert tuple(progress.first()) == (2, 3, 66.7)
    events = store.log().collect()
    assert [r.event for r in sorted(events, key=lambda r: r.version)] == ["init", "next_batch", "mark", "sync", "reset_stale"]
    assert next(r for r in events if r.event == "next_batch").batch_id == "batch-20260624T104058+0000"
    assert store.meta().first().batch_size == 30 and store.meta().first().total == 3


def test_changes_are_merged_and_swept(spark, tmp_path):
    """A command writes what it changes; every third one a snapshot; what no late version names is deleted."""
    q = tmp_path / "q"
    store = QueueStore(spark, str(q), F.lit("2026-06-24T10:40:58+00:00"), keep=2, merge=3)
    store.init(spark.range(40).selectExpr("lpad(id, 3, '0') AS name"), reports(spark, ("x", 1)))
    taken, sizes = [], []
    for _ in range(9):
        taken += [r.id for r in store.next_batch(3)]
        sizes.append((len(list((q / "items").iterdir())), len(list((q / "changes").iterdir())) if (q / "changes").exists() else 0))
    assert taken == list(range(1, 28))
    assert {r.id: r.status for r in store.items().collect()} == {i: "in_progress" if i <= 27 else "pending" for i in range(1, 41)}
    assert max(a for a, _ in sizes) <= 3 and max(b for _, b in sizes) <= 6
    assert len(store.versions()) == 10
    assert [r.size for r in store.log().orderBy("version").collect()] == [None, *[3] * 9]


def test_many_marks_are_one_change(spark, tmp_path):
    store = QueueStore(spark, str(tmp_path / "q"))
    store.init(spark.range(30).selectExpr("lpad(id, 3, '0') AS name"), reports(spark, ("x", 1)))
    taken = store.next_batch(20)
    results = [(r.id, "failed" if r.id % 5 == 0 else "complete", "why" if r.id == 5 else None, "me" if r.id == 1 else None) for r in taken]
    before = len(store.versions())
    assert store.mark_all(spark.createDataFrame(results, "id long, status string, error string, agent_id string")) == 20
    assert len(store.versions()) == before + 1
    got = {r.id: r for r in store.items().collect()}
    assert {i: (got[i].status, got[i].error, got[i].agent_id) for i in (1, 5, 10, 21)} == {1: ("complete", None, "me"), 5: ("failed", "why", None), 10: ("failed", "unknown error", None), 21: ("pending", None, None)}
    for wrong, error in ((99, KeyError), (1, ValueError)):
        with pytest.raises(error):
            store.mark_all(spark.createDataFrame([(wrong, "complete" if wrong == 99 else "in_progress", None, None)], "id long, status string, error string, agent_id string"))
    assert len(store.versions()) == before + 1


def test_a_faster_writer(spark, tmp_path, monkeypatch):
    """Another writer commits between reading and claiming, more than once: the batch is chosen anew, nothing is lost."""
    store, other = (QueueStore(spark, str(tmp_path / "q")) for _ in range(2))
    store.init(spark.range(9).selectExpr("lpad(id, 3, '0') AS name"), reports(spark, ("x", 1)))
    real, taken = store.commits.claim, []

    def late(version, content):
        if len(taken) < 2:
            taken.append([r.id for r in other.next_batch(2)])
        return real(version, content)

    monkeypatch.setattr(store.commits, "claim", late)
    assert [r.id for r in store.next_batch(3)] == [5, 6, 7] and taken == [[1, 2], [3, 4]]
    assert sorted(r.id for r in store.items().filter("status = 'in_progress'").collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert [r.event for r in store.log().orderBy("version").collect()] == ["init", *["next_batch"] * 3]


WRITER = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from corpusloom.operators.queue_store import QueueStore
s = SparkSession.builder.master("local[1]").config("spark.sql.shuffle.partitions", "1").config("spark.ui.enabled", "false").config("spark.driver.memory", "1g").getOrCreate()
store = QueueStore(s, sys.argv[2], merge=8)
while taken := store.next_batch(1):
    print("took", *[r.id for r in taken], flush=True)
"""


def test_two_processes_take_disjoint_batches(spark, tmp_path):
    """A hundred rounds between two processes: each item is given out once, by one of them."""
    import subprocess
    import sys
    from pathlib import Path

    q = str(tmp_path / "q")
    QueueStore(spark, q).init(spark.range(100).selectExpr("lpad(id, 3, '0') AS name"), reports(spark, ("x", 1)))
    root = str(Path(__file__).resolve().parents[1])
    procs = [subprocess.Popen([sys.executable, "-c", WRITER, root, q], stdout=subprocess.PIPE, text=True) for _ in range(2)]
    outs = [p.communicate(timeout=600)[0] for p in procs]
    took = [[int(x) for line in out.splitlines() if line.startswith("took") for x in line.split()[1:]] for out in outs]
    assert all(p.returncode == 0 for p in procs) and all(took)
    assert sorted(took[0] + took[1]) == list(range(1, 101))
    log = QueueStore(spark, q).log().filter("event = 'next_batch'").orderBy("version").collect()
    assert [r.ids for r in log] == [[i] for i in range(1, 101)]


def test_claims_of_many_threads(spark, tmp_path):
    """Eight threads, a hundred versions: each number is claimed once, and no change is lost."""
    from concurrent.futures import ThreadPoolExecutor

    from corpusloom.sources.commits import Commits

    def run(k):
        own = Commits(spark, str(tmp_path / "c"))
        for _ in range(13):
            own.change(lambda version, content: {"seen": [*content.get("seen", []), k]}, tries=1000)

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(run, range(8)))
    last = Commits(spark, str(tmp_path / "c"))
    assert last.versions() == list(range(1, 105))
    assert sorted(last.latest()[1]["seen"]) == sorted(list(range(8)) * 13)
    assert list((tmp_path / "c" / "drafts").iterdir()) == []


def test_cli(spark, tmp_path, capsys):
    docs, out = tmp_path / "docs", tmp_path / "reports"
    for folder, name, text in ((docs, "a.md", "x"), (out, "run-a.md", "y" * 600)):
        folder.mkdir()
        (folder / name).write_text(text)
    where = str(tmp_path / "q")
    assert cli.main(["queue", where, "init", "--sources", str(docs), "--reports", str(out)]) == 0
    assert cli.main(["queue", where, "init", "--sources", str(docs), "--reports", str(out)]) == 1
    assert cli.main(["queue", where, "next-batch"]) == 0
    assert "nothing is pending" in capsys.readouterr().out
    (tmp_path / "c.csv").write_text("pope,title,published_date,link,mine\nP,T,1891-05-15,http://x/a.htm,m\n")
    themes, tier = tmp_path / "themes", tmp_path / "gemini"
    themes.mkdir()
    tier.mkdir()
    (themes / "run-15051891_P_T.md").write_text("- **Key theme:** Social\n- **Summary:** s\n")
    (tier / "run-15051891_P_T.md.md").write_text('## Gradients\n```json\n{"reflective": {"saturation": 7, "density": -2}}\n```\n')
    args = ["enrich", str(tmp_path / "c.csv"), str(themes), f"gemini={tier}", "--out", str(tmp_path / "out")]
    assert cli.main([*args, "--dry-run"]) == 0 and not (tmp_path / "out").exists()
    assert cli.main(args) == 0
    row = spark.read.csv(str(tmp_path / "out"), header=True).first()
    assert (row.mine, row.category, row.reflective_density) == ("m", "Social", "-2")
