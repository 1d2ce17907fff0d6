"""Near copies among the documents of the test table, against all pairs; keys that hold most rows."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import common, embedding_join, simhash

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def texts(spark):
    """Texts of the table, and copies of some with as many words changed as the similarity allows, or nearly."""
    found = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 1500 and text is not null").select("doc_id", "text").collect()}
    rng = random.Random(6)
    for i, t in sorted(found.items()):
        w = t.split()
        if len(w) >= 60 and i % 3 == 0:
            for k in rng.sample(range(len(w)), max(1, int(len(w) / 45 * rng.choice((0.5, 0.8, 1.0))))):
                w[k] = f"new{rng.randrange(10**6)}"
            found[10_000 + i] = " ".join(w)
    return found


@pytest.fixture(scope="module")
def pairs(texts):
    """All pairs of different sets of shingles of similarity 0.8 or more, by an inverted index."""
    sets, index, out = {}, defaultdict(list), []
    for i, t in sorted(texts.items()):
        w = t.lower().split()
        own = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
        common_ = Counter(j for s in own for j in index[s])
        out += [(j, i) for j, n in common_.items() if n >= 0.8 * (len(own) + len(sets[j]) - n) - 1e-9]
        sets[i] = own
        for s in own:
            index[s].append(i)
    return [(a, b) for a, b in out if sets[a] != sets[b]], [(a, b) for a, b in out if sets[a] == sets[b]]


@pytest.mark.parametrize(("block", "flips", "small"), [(*simhash.SHARD, 48), (*simhash.SHARD, 0), (16, 2, 0), (24, 5, 0)])
def test_recall_of_shards(spark, texts, pairs, block, flips, small):
    """Of different texts of the similarity nearly no pair stays whole, whatever finds them: no setting hangs on the number of documents."""
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    kept = {r.doc_id for r in simhash.drop_near_duplicates(df, block=block, flips=flips, small=small).select("doc_id").collect()}
    near, equal = pairs
    assert len(near) > 100 and equal
    missed = sum(a in kept and b in kept for a, b in near)
    assert missed <= 0.1 * len(near) if small == 0 else missed <= 0.02 * len(near)
    assert not any(a in kept and b in kept for a, b in equal)
    linked = {x for p in near + equal for x in p}
    assert kept >= set(texts) - linked  # what is near nothing stays


def test_most_rows_of_one_fingerprint(spark, monkeypatch):
    """40,000 blank texts; beyond what is broadcast, their rows stay where they lie."""
    df = spark.range(44_000).selectExpr("id AS doc_id", "CASE WHEN id % 11 = 0 THEN concat('w', id, ' x', id, ' y', id, ' z', id) ELSE ' ' END AS text").repartition(8)
    want = Counter(r.component_id for r in simhash.near_duplicates(df).collect())
    assert want[1] == 40_000
    monkeypatch.setattr(common, "BROADCAST_ROWS", 100)
    out = simhash.near_duplicates(df)
    assert Counter(r.component_id for r in out.collect()) == want
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 3 * 44_000 / 8


def test_most_rows_of_one_vector(spark, monkeypatch):
    """Nearly six thousand equal vectors, some others, some of them null."""
    v = "CASE WHEN id % 22 = 1 THEN null WHEN id % 11 = 0 THEN array(sin(id), cos(id), sin(id * 1.7), cos(id * 3.1)) ELSE array(1.0D, 2.0D, 3.0D, 4.0D) END"
    df = spark.range(6600).selectExpr("id AS vec_id", f"{v} AS embedding").repartition(8)
    want = sorted(tuple(r) for r in embedding_join.range_join(df).collect())
    assert max(Counter(component for _, _, component, _ in want).values()) >= 5700 and max(n for _, n, _, _ in want) >= 5699
    monkeypatch.setattr(common, "BROADCAST_ROWS", 100)
    out = embedding_join.range_join(df)
    assert sorted(tuple(r) for r in out.collect()) == want
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 3 * 6600 / 8
