"""The queue as a stream: rules, timers, restarts."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import work_queue
from corpusloom.streaming import queue_rules

STALE, DELAY = 1000, 500
KINDS = ("pending", "in_progress", "complete", "failed", "skipped")


def fold(events, upto):
    """One event after the other, by hand."""
    out = {}
    for item, own in itertools.groupby(sorted(e for e in events if e[2] <= upto), key=lambda e: e[0]):
        status, since, applied, refused, stale = "pending", 0, 0, 0, 0
        for _, _, at, new in [*sorted(own, key=lambda e: (e[2], e[1])), (item, 0, upto, None)]:
            if status == "in_progress" and at - since >= STALE:
                status, since, stale = "pending", since + STALE, stale + 1
            if new == "in_progress" and status != "pending":
                refused += 1
            elif new:
                status, since, applied = new, at, applied + 1
        out[item] = (status, since, applied, refused, stale)
    return out


def events(n, seed):
    rng = random.Random(seed)
    return [(rng.randrange(12), k, 10_000 + k * 40, rng.choice((*KINDS, "in_progress", "pending"))) for k in range(n)]


def files_of(spark, folder, rows, name):
    df = spark.createDataFrame(rows, "id long, event_id long, ms long, status string").select("id", "event_id", F.timestamp_millis("ms").alias("ts"), "status")
    df.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def run(spark, folder, out):
    source = spark.readStream.schema("id long, event_id long, ts timestamp, status string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
    got = queue_rules.run_to_end(spark, source, f"{out}/rows", f"{out}/state", f"{DELAY} milliseconds", STALE)
    return {r.id: tuple(r)[1:] for r in got.collect()}


def test_rules_are_those_of_a_fold(spark, tmp_path):
    """Events out of order within the delay, in several files, over a restart of the stream."""
    rows = events(300, 1)
    rng = random.Random(2)
    mixed = sorted(rows, key=lambda e: e[2] + rng.randrange(DELAY - 100))  # no event is later than the delay
    for k in range(3):
        files_of(spark, f"{tmp_path}/in", mixed[k * 60 : k * 60 + 60], f"f{k}")
    # A file is one batch; what is later than the watermark of the batch before would be dropped.
    want = fold(mixed[:180], max(e[2] for e in mixed[:180]) - DELAY)
    got = run(spark, tmp_path, tmp_path)
    assert got == want and any(s[3] for s in got.values()) and any(s[4] for s in got.values())
    files_of(spark, f"{tmp_path}/in", mixed[180:], "f9")
    assert run(spark, tmp_path, tmp_path) == fold(rows, max(e[2] for e in rows) - DELAY)


def test_stale_items_go_back_as_the_command_has_it(spark, tmp_path):
    """What the timer puts back is what ``reset_stale`` puts back of items without a report, taken at the same time."""
    rows = [(i, i, 10_000 + 100 * i, "in_progress") for i in range(20)] + [(99, 99, 30_000, "failed")]
    rows += [(3, 50, 10_350, "complete"), (4, 51, 10_450, "failed")]
    files_of(spark, f"{tmp_path}/in", sorted(rows, key=lambda e: e[2]), "f")
    got = run(spark, tmp_path, tmp_path)
    items = spark.createDataFrame([(i, f"s{i}", f"r{i}", got[i][0] if got[i][4] == 0 else "in_progress", "b", "t", None, None, "a") for i in range(20)], "id long, source_file string, report_file string, status string, batch_id string, started_at string, completed_at string, error string, agent_id string")
    reset = work_queue.reset_stale(items, spark.createDataFrame([], "report_file string, size long"), F.lit("n"))
    assert {r.id: r.status for r in reset.collect()} == {i: got[i][0] for i in range(20)}
    assert {i for i in range(20) if got[i][4] == 1} == set(range(20)) - {3, 4} and got[5][1] == 10_500 + STALE


@pytest.mark.parametrize(("state", "at", "status", "want"), [
    (("pending", 0, 0, 0, 0), 5, "in_progress", ("in_progress", 5, 1, 0, 0)),
    (("complete", 3, 1, 0, 0), 5, "in_progress", ("complete", 3, 1, 1, 0)),
    (("in_progress", 5, 1, 0, 0), 1004, "in_progress", ("in_progress", 5, 1, 1, 0)),
    (("in_progress", 5, 1, 0, 0), 1005, "in_progress", ("in_progress", 1005, 2, 0, 1)),
    (("in_progress", 5, 1, 0, 0), 5000, None, ("pending", 1005, 1, 0, 1)),
    (("failed", 5, 1, 0, 0), 6, "pending", ("pending", 6, 2, 0, 0)),
])
def test_transitions(state, at, status, want):
    assert queue_rules.advance(state, at, status, STALE) == want
