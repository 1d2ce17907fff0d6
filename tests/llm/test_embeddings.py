import numpy as np
import pytest
from pyspark.accumulators import AccumulatorParam

from corpusloom.llm import embedding_join
from corpusloom.llm.embedding_join import range_join


def brute(rows, t=0.9):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    linked = {k: [] for k in range(len(ok))}
    for a in range(len(ok)):
        for b in range(a):
            x, y = ok[a][1], ok[b][1]
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= t:
                linked[a].append(b)
                linked[b].append(a)
    label = {i: i for i, _ in ok}
    for _ in range(len(ok)):
        for a, own in linked.items():
            for b in own:
                label[ok[a][0]] = label[ok[b][0]] = min(label[ok[a][0]], label[ok[b][0]])
    out = [(i, len(linked[k]), label[i], label[i] == i) for k, (i, _) in enumerate(ok)]
    seen = {id(v) for _, v in ok}
    rest = [i for i, v in rows if not (i is not None and v and None not in v and np.isfinite(v).all() and np.any(v))]
    assert seen is not None
    return sorted(out + [(i, 0, i, True) for i in rest], key=str)


def vectors(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, 16))
    rows = []
    for i in range(n):
        kind = rng.random()
        v = rng.standard_normal(16) if kind < 0.4 else centres[rng.integers(6)] + rng.standard_normal(16) * rng.choice([0.05, 0.3, 0.4])
        if kind > 0.9 and rows:
            v = np.array(rows[int(rng.integers(len(rows)))][1]) * (1 if kind > 0.95 else 3)
        rows.append((i, [float(np.float32(x)) for x in v]))
    return rows


@pytest.mark.parametrize(("kind", "pivots", "block"), [("float", 5, 4096), ("double", 3, 7), ("float", 1, 20)])
def test_join(spark, kind, pivots, block):
    rows = vectors(160, pivots)
    rows += [(500, None), (501, [0.0] * 16), (502, [1.0, None] * 8), (503, [float("nan")] * 16), (504, [float("inf")] * 16), (505, []), (506, [1.0, 2.0]), (507, [2.0, 4.0]), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, 1, "k", b"r") for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, key string, raw binary").repartition(3)
    got = sorted((tuple(r) for r in range_join(df, pivots=pivots, block=block).collect()), key=str)
    assert got == brute(rows)


def test_empty_and_repeats(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert range_join(df).count() == 0
    same = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (3, [1.0, 0.01])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r)[:3] for r in range_join(same).collect())
    assert got == [(1, 3, 1), (1, 3, 1), (2, 3, 1), (3, 0, 1), (3, 3, 1)]


def test_planted_threshold(spark):
    """A cosine just at the threshold links, one just below does not."""
    rows = [(1, [1.0, 0.0]), (2, [0.9, float(np.sqrt(1 - 0.81)) * 0.9999999]), (3, [-0.9, float(np.sqrt(1 - 0.81)) * 1.0000001]), (4, [-1.0, 0.0])]
    got = {r.vec_id: r.n_links for r in range_join(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 0}


def test_cells_of_clusters_meet_few_vectors(spark):
    """Clustered vectors: with pivots in proportion to the table most vectors go to one cell only, and the links are all found."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(40, 32))
    v = centres[np.arange(1600) % 40] + 0.05 * rng.normal(size=(1600, 32))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(4)
    got = range_join(df, block=40).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(i, 39, i % 40) for i in range(1600)}


@pytest.mark.parametrize(("block", "large", "most"), [(4, 1, 1000), (7, 2, 9), (3, 1, 40)])
def test_cells_inside_cells(spark, monkeypatch, block, large, most):
    """Few pivots at the top, so every cell is cut again: the links are those of all pairs, vectors of several lengths among them."""
    monkeypatch.setattr(embedding_join, "LARGE", large)
    monkeypatch.setattr(embedding_join, "MOST_SUBS", most)
    rows = vectors(220, block) + [(1000 + i, [float(np.cos(i / 9)), float(np.sin(i / 9))]) for i in range(60)] + [(2000, [1.0, 2.0, 3.0]), (2001, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((tuple(r) for r in range_join(df, pivots=2, block=block).collect()), key=str)
    assert got == brute(rows)


def test_visits_stay_few_as_clusters_grow_in_number(spark, monkeypatch):
    """With a bound on the pivots at the top, four times the clusters make no vector meet more vectors: pivots inside cells see to that."""
    for name, value in (("MOST_PIVOTS", 4), ("LEAST_PIVOTS", 4), ("LARGE", 1)):
        monkeypatch.setattr(embedding_join, name, value)
    rng = np.random.default_rng(3)
    real, dealt = embedding_join.tidy, None

    def counting(run):
        if run.__name__ != "deal":
            return real(run)
        into = dealt

        def counted(batches):
            for b in run(batches):
                for key in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                    into.add({key: 1})
                yield b

        return counted

    monkeypatch.setattr(embedding_join, "tidy", counting)

    class Counts(AccumulatorParam):
        def zero(self, value):
            return {}

        def addInPlace(self, a, b):  # noqa: N802
            for k, n in b.items():
                a[k] = a.get(k, 0) + n
            return a

    seen = []
    for clusters in (30, 120):
        centres = rng.normal(size=(clusters, 32))
        v = centres[np.arange(clusters * 40) % clusters] + 0.02 * rng.normal(size=(clusters * 40, 32))
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(4)
        dealt = spark.sparkContext.accumulator({}, Counts())
        got = range_join(df, block=40).collect()
        assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(i, 39, i % clusters) for i in range(clusters * 40)}
        # What lives in a part of a cell meets all that are there.
        seen.append(sum(n * (n + dealt.value.get((cell, part, True), 0)) for (cell, part, guest), n in dealt.value.items() if not guest) / len(v))
    # All pairs would be 1200 and 4800; a cluster is 40.
    assert seen[0] < 100 and seen[1] < 100
