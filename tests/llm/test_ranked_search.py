import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    total, words = len(own), sum(c.total() for _, c in own)
    df = Counter(t for _, c in own for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, q in asked.items():
        found = []
        for d, c in own:
            m = 10 + 90 * c.total() * total // words
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in q if t in c)
            if s:
                found.append((-s, d is None, d or 0, d))
        out += [(i, n + 1, d, -s) for n, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out)


def result(spark, docs, items, leaves=8, shard=8, **how):
    d = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], "doc_id long, text string, term string, block int, docs string").repartition(4)
    q = spark.createDataFrame([(i, t, 1, "z") for i, t in items], "item_id long, text string, score int, term string")
    return sorted(tuple(r) for r in rs.search(rs.build_index(d, leaves=leaves, shard=shard), q, **how).collect())


def corpus(n, seed):
    rng = random.Random(seed)
    topics = [[f"{c}{k}" for k in range(40)] for c in ("alpha", "Beta", "ga-mma", "delté", "5")]
    docs = []
    for i in range(n):
        if docs and rng.random() < 0.4:
            docs.append((i, docs[0][1] if rng.random() < 0.7 else rng.choice(docs)[1]))  # a third are copies of one text
        else:
            own = rng.choice(topics)
            docs.append((i, " ".join(rng.choice(own if rng.random() < 0.8 else rng.choice(topics)) + rng.choice((" ", ",", "\n", "A ")) for _ in range(rng.choice((1, 5, 40, 90))))))
    docs += [(None, docs[3][1]), (None, docs[3][1]), (3, docs[3][1]), (7, "other words"), (n, None), (n + 1, ""), (n + 2, "-- \x1c !"), (n + 3, " ".join(f"w{rng.randrange(4000)}" for _ in range(20_000)) + " Alpha1")]
    rng.shuffle(docs)
    items = [(k, " ".join(rng.choice(own) for _ in range(6))) for k, own in enumerate(topics * 3)]
    items += [(90, None), (91, ""), (92, "nowhere"), (93, docs[0][1]), (1, "delté3 Alpha1"), (None, "alpha1"), (94, "w1 w2 W3")]
    return docs, items


@pytest.mark.parametrize(("seed", "leaves", "shard", "how"), [(1, 8, 8, {}), (2, 1, 1, {"first": 1, "factor": 2}), (3, 16, 300, {"k": 3, "first": 1}), (4, 4, 4, {"k": 1, "first": 2, "factor": 3})])
def test_against_brute_force(spark, seed, leaves, shard, how):
    docs, items = corpus(160, seed)
    assert result(spark, docs, items, leaves, shard, **how) == brute(docs, items, how.get("k", 10))


def test_empty_tables(spark):
    docs, items = corpus(20, 9)
    assert result(spark, [], items) == []
    assert result(spark, docs, []) == []
    assert result(spark, [(1, None), (2, " .")], items) == []
    assert result(spark, [(2, "one two"), (1, "one two")], [(1, "ONE")]) == brute([(2, "one two"), (1, "one two")], [(1, "one")])


def test_search_stops_early(spark, monkeypatch):
    """A few documents match far better than all others: shards whose bound is below theirs are not visited."""
    rng = random.Random(5)
    docs = [(i, " ".join(f"c{rng.randrange(30)}" for _ in range(20))) for i in range(400)]
    docs += [(1000 + i, "needle thread haystack c1") for i in range(12)]
    seen = []
    monkeypatch.setattr(rs, "materialise", lambda df, real=rs.materialise: seen.append(real(df)) or seen[-1])
    got = result(spark, docs, [(1, "needle thread haystack c1")], leaves=4, shard=16, first=2, factor=4)
    assert got == brute(docs, [(1, "needle thread haystack c1")])
    visited = sum(len(r["visited"]) for df in seen if "visited" in df.columns for r in df.collect())
    bounds = next(df for df in seen if "bound" in df.columns).count()
    assert visited < bounds / 2


def test_bisection_brings_topics_together():
    """Documents of two kinds, mixed at first, end in halves of one kind; every document is in one part; parts are even."""
    rng = np.random.default_rng(1)
    kind = rng.permutation(np.repeat([0, 1], 64))
    doc = np.repeat(np.arange(128), 12)
    term = (rng.integers(0, 40, 128 * 12) + 40 * kind[doc]).astype(np.int64)
    part, weights = rs.bisect(doc, term, 128, 80, 3, rounds=12)
    assert np.bincount(part).tolist() == [16] * 8
    assert all(len(set(kind[part == p])) == 1 for p in range(8))
    assert [w.shape for w in weights] == [(1, 80), (2, 80), (4, 80)]
    side = part[kind == 0][0] // 4
    assert np.sign(weights[0][0, :40].sum()) == (1 if side == 0 else -1)


def test_router_sends_topics_to_their_own_leaves():
    rng = random.Random(2)
    topics = [[f"{c}{k}".encode() for k in range(30)] for c in "abcd"]
    router = rs.Router([rng.sample(rng.choice(topics), 12) for _ in range(200)], 2)
    leaves = [Counter(router(rng.sample(own, 12)) for _ in range(30)) for own in topics]
    assert all(max(x.values()) >= 27 for x in leaves)
    assert len({max(x, key=x.get) for x in leaves}) >= 3


def test_hot_leaf_is_dealt_to_even_blocks(spark):
    """Nine tenths of the rows are one text, ids and all: no block has more than a few times the mean."""
    docs = [(5, "same old words again")] * 1800 + [(i, f"rare{i % 50} other{i % 7} more{i % 11}") for i in range(200)]
    index = rs.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), leaves=16)
    sizes = [len(r.docs) for r in index.filter("term = ''").collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 3 * 2000 / 16
