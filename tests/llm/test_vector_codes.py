import hashlib
import math

import numpy as np
import pytest

from corpusloom.llm import common, vector_codes
from corpusloom.llm.vector_codes import compress


def brute(rows, parts=4, entries=256, rounds=4):
    """Plain Python, a vector at a time."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    d = size // parts
    cut = [[r[1][p * d : p * d + d] for p in range(parts)] for r in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign(p, x):
        far = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for c in cut:
                own.setdefault(assign(p, c[p])[0], []).append(c[p])
            for k, xs in own.items():
                books[p][k] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[assign(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(f for _, f in row) for row in found]
    by = {}
    for r, e in zip(kept, errors, strict=True):
        by[r[2]] = by.get(r[2], 0) + e
    return sorted(((r[0], "".join(f"{a:02x}" for a, _ in row), e, by[r[2]], digest) for r, row, e in zip(kept, found, errors, strict=True)), key=str)


def got(spark, rows, **how):
    df = spark.createDataFrame([(i, v, lab, "k", 1, b"d") for i, v, lab in rows], "vec_id long, embedding array<double>, label int, id string, code int, data binary").repartition(5)
    return sorted((tuple(r) for r in compress(df, **how).collect()), key=str)


def vectors(n, d, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.standard_normal(d) * scale).tolist(), [None, 1, 2, 7][int(rng.integers(4))]) for i in range(n)]


@pytest.mark.parametrize(("n", "d", "how"), [(150, 16, {"entries": 20}), (300, 8, {}), (40, 4, {"entries": 7, "rounds": 9}), (60, 12, {"parts": 3, "entries": 5, "rounds": 0})])
def test_against_brute_force(spark, n, d, how):
    rows = vectors(n, d, n)
    assert got(spark, rows, **how) == brute(rows, **how)


def test_odd_rows(spark):
    rows = vectors(30, 8, 3)
    rows += [(3, rows[4][1], 1), (3, rows[3][1], 1), (None, rows[5][1], None), (90, None, 1), (91, [], 1), (92, [1.0, None] * 4, 1), (93, [float("nan")] * 8, 2), (94, [float("inf")] * 8, 2), (95, [1.0] * 12, 1), (96, [1.0] * 7, 1)]
    assert got(spark, rows, entries=6) == brute(rows, entries=6)
    assert got(spark, []) == []
    assert got(spark, [(1, None, 2)]) == []
    same = [(i, [0.5, -0.25, 0.0, 1.0], 1) for i in range(10)]  # ties go to the first entry, others stay as they are
    assert got(spark, same) == brute(same)
    assert {r[1] for r in got(spark, same)} == {"00000000"}


def test_large_components(spark):
    """Components that need 64 bits are exact; beyond the limit they saturate."""
    rows = vectors(50, 8, 5, 20_000.0)
    assert got(spark, rows, entries=9) == brute(rows, entries=9)
    most = vector_codes.most(8)
    far = got(spark, [(1, [1e300] * 8, 1), (2, [-1e300] * 8, 1), (3, [0.0] * 8, 1)], entries=1, rounds=0)
    assert {r[0]: r[2] for r in far} == {1: 0, 2: 8 * (2 * most) ** 2, 3: 8 * most**2}


def test_join_hot(spark, monkeypatch):
    """Beyond what is broadcast: the rows of a hot key, of null and of rare keys find theirs, each once."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", 3)
    large = spark.createDataFrame([(i, None if i % 5 == 0 else 0 if i % 2 else i) for i in range(2000)], "i long, label long").repartition(6)
    small = large.groupBy("label").count()
    want = {r["label"]: r["count"] for r in small.collect()}
    out = common.join_hot(common.materialise(large), small, "label").collect()
    assert sorted(r["i"] for r in out) == list(range(2000))
    assert all(r["count"] == want[r["label"]] for r in out)
