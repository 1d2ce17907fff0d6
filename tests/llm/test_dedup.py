"""Substring, suffix-array and SimHash dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from common_docs import frame
from xxhash import xxh64_intdigest

from corpusloom.llm import passages, simhash, substring_dedup, suffix_dedup, windows


def brute_words(rows, w=20):
    seen, out = {}, {}
    for i, t in sorted({(i, t or "") for i, t, *_ in rows if i is not None}):
        words, gone = t.encode().split(), set()
        for s in range(len(words) - w + 1):
            k = tuple(words[s : s + w])
            if seen.setdefault(k, (i, s)) != (i, s):
                gone |= set(range(s, s + w))
        out[i] = (len(words), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(words) if j not in gone)).hexdigest())
    return out


def brute_bytes(rows, w=50):
    seen, out = {}, {}
    for i, t in sorted({(i, t or "") for i, t, *_ in rows if i is not None}):
        b, gone = t.encode(), np.zeros(len(t.encode()), bool)
        for s in range(len(b) - w + 1):
            if seen.setdefault(b[s : s + w], i) != i:
                gone[s : s + w] = True
        runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
        out[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


@pytest.mark.parametrize("gather", [200, 1_000_000])
def test_substring(docs, rows, monkeypatch, gather):
    monkeypatch.setattr(passages, "GATHER", gather)
    got = substring_dedup.digest(substring_dedup.remove_repeated_words(docs)).collect()
    assert len(got) == len(rows)
    want = brute_words(rows)
    assert {r[0]: tuple(r[1:]) for r in got if r[0] is not None} == want
    assert sum(v[1] for v in want.values()) > 500
    assert [r.n_removed for r in got if r[0] is None] == [0]


@pytest.mark.parametrize(("gather", "size"), [(150, 2000), (1_000_000, 24_000_000)])
def test_suffix(docs, rows, monkeypatch, gather, size):
    monkeypatch.setattr(passages, "GATHER", gather)
    monkeypatch.setattr(passages, "GATHER_BYTES", size)
    got = suffix_dedup.digest(suffix_dedup.remove_repeated_bytes(docs)).collect()
    assert len(got) == len(rows)
    assert {r[0]: tuple(r[1:]) for r in got if r[0] is not None} == brute_bytes(rows)


@pytest.mark.parametrize("gather", [60, 5000])
def test_low_entropy(spark, monkeypatch, gather):
    """Few different words: most windows repeat, within documents and across."""
    monkeypatch.setattr(passages, "GATHER", gather)
    rng = random.Random(gather)
    rows = [(i, " ".join(rng.choice(("a", "b")) * rng.choice((1, 2)) for _ in range(rng.randrange(120))) if i % 4 else "ab " * 60, "en", "s") for i in range(60)]
    df = frame(spark, rows, 4)
    assert {r[0]: tuple(r[1:]) for r in substring_dedup.digest(substring_dedup.remove_repeated_words(df)).collect()} == brute_words(rows)
    assert {r[0]: tuple(r[1:]) for r in suffix_dedup.digest(suffix_dedup.remove_repeated_bytes(df)).collect()} == brute_bytes(rows)
    short = {r[0]: r.n_removed for r in substring_dedup.remove_repeated_words(df, window=12, start=3).collect()}
    assert short == {i: v[1] for i, v in brute_words(rows, 12).items()}


def test_common_runs_change_nothing(spark, monkeypatch):
    """A passage in most documents is ranked last, and the result is the same."""
    monkeypatch.setattr(passages, "COMMON", 0.2)
    rng = random.Random(8)
    passage = " ".join(f"p{rng.randrange(30)}" for _ in range(60))
    rows = [(i, " ".join(f"{rng.choice('abcdef')}{rng.randrange(40)}" for _ in range(30)) + " " + passage + " " + " ".join(f"z{rng.randrange(9)}" for _ in range(30)), "en", "s") for i in range(40)]
    df = frame(spark, rows, 4)
    base = df.selectExpr("doc_id AS id", "text")
    for plan in (suffix_dedup.plan_of(50, 16), substring_dedup.plan_of(20, 5)):
        common = passages.common_runs(base, plan).common
        assert len(common) >= 40
        runs = windows.Spans(plan.tokens(passage.encode()), 3).runs(plan.k)
        assert np.isin(runs, common).all()
    assert {r[0]: tuple(r[1:]) for r in substring_dedup.digest(substring_dedup.remove_repeated_words(df)).collect()} == brute_words(rows)
    assert {r[0]: tuple(r[1:]) for r in suffix_dedup.digest(suffix_dedup.remove_repeated_bytes(df)).collect()} == brute_bytes(rows)


def test_empty(none):
    assert substring_dedup.remove_repeated_words(none).count() == 0
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0
    assert suffix_dedup.without_repeats(none).columns == none.columns
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0


def test_spans_and_texts(docs, rows):
    texts = {i: t for i, t, *_ in rows}
    for r in suffix_dedup.remove_repeated_bytes(docs).collect():
        b = (texts[r[0]] or "").encode()
        assert bytes(r.kept) == b"".join(b[x:y] for x, y in zip([0, *[s.end for s in r.spans]], [*[s.start for s in r.spans], len(b)], strict=True))
    kept = suffix_dedup.without_repeats(docs)
    assert kept.columns == docs.columns
    assert kept.filter("n_chars <> length(coalesce(text, ''))").count() == 0
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, *_ in rows)


def test_sort():
    rng = np.random.default_rng(1)
    for t in range(150):
        n = int(rng.integers(1, 150))
        data = rng.integers(97, 97 + int(rng.integers(1, 4)), n + 60).astype(np.uint8)
        at, group = rng.integers(0, n, n), rng.integers(0, 3, n) if t % 2 else np.zeros(n, int)
        words = suffix_dedup.big_words(suffix_dedup.word_at(data), at, 50)
        order, equal = suffix_dedup.deep_shallow_sort(words, group, shallow=int(rng.integers(0, 8)))
        keys = [(int(g), bytes(data[a : a + 50])) for g, a in zip(group, at, strict=True)]
        assert [keys[i] for i in order] == sorted(keys)
        assert all((keys[a] == keys[b]) == (x == y) for a, b, x, y in zip(order, order[1:], equal, equal[1:], strict=False))


def test_large_groups_go_to_tries():
    """Thousands of strings with one long common prefix, many of them equal: every one is ordered by a trie."""
    rng = np.random.default_rng(4)
    words = np.zeros((6000, 7), np.uint64)
    words[:, 5] = rng.integers(0, 900, 6000)
    order, equal, tries = suffix_dedup.blind_tries(words, np.arange(6000), np.zeros(6000, int))
    assert (np.diff(words[order, 5].astype(int)) >= 0).all() and ((np.diff(equal) == 0) == (np.diff(words[order, 5].astype(int)) == 0)).all()
    assert sum(map(len, tries.bit)) == len(np.unique(words[:, 5])) - 1 and min(b.min() for b in tries.bit) >= 5 * 64


@pytest.mark.parametrize("method", ["words", "bytes"])
def test_nothing_bypasses_the_method(docs, rows, monkeypatch, method):
    """With a method that finds nothing, nothing is removed."""
    from dataclasses import replace

    module, run = (substring_dedup, substring_dedup.remove_repeated_words) if method == "words" else (suffix_dedup, suffix_dedup.remove_repeated_bytes)
    real = module.plan_of
    none = lambda rank, doc, first, length, owners, content: (np.zeros(len(content), bool),) * 2
    assert run(docs).filter("n_removed > 0").count() > 10
    monkeypatch.setattr(module, "plan_of", lambda *a: replace(real(*a), resolve=none))
    assert run(docs).filter("n_removed > 0").count() == 0


def test_many_buckets(monkeypatch):
    """More buckets than 2 ** 15: repeats of a stretch in its own text still name the right stretch."""
    plan = suffix_dedup.plan_of(50, 16)
    rng = random.Random(3)
    piece = "".join(rng.choice("abcdefghijklmnop") for _ in range(800))
    text = piece + "".join(rng.choice("abcdefghijklmnop") for _ in range(200)) + piece
    got = list(passages.send_stretches(plan, 40_000)([pa.RecordBatch.from_arrays([pa.array([7]), pa.array([text])], names=["id", "text"])]))
    twins = 0
    for b in got:
        for part, data in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            h, s, ids, place, first, n, tt, tf, *_ = passages.unsqueeze(data)
            assert 0 <= part < 40_000 and (tt < len(h)).all()
            for t, f in zip(tt.tolist(), tf.tolist(), strict=True):
                size = int(n[t]) + 49
                assert text[f : f + size] == text[int(first[t]) : int(first[t]) + size]
                twins += 1
    assert twins > 5


def thue_morse(n, letters):
    return "".join(letters[i.bit_count() & 1] for i in range(n))


@pytest.mark.parametrize("n", [16, 17, 512, 1024, 2048, 4096])
def test_long_words_are_told_apart(spark, n):
    """Words that sums of powers cannot tell apart."""
    a, b = thue_morse(n, "ab"), thue_morse(n, "ba")
    assert len(set(windows.word_tokens(f"{a} {b} {a}x {a[:-1]}".encode()).tolist())) == 4
    filler = [f"f{i}" for i in range(19)]
    rows = [(1, " ".join([*filler, a]), "en", "s"), (2, " ".join([*filler, b]), "en", "s"), (3, " ".join([*filler, a]), "en", "s")]
    got = {r[0]: tuple(r[1:]) for r in substring_dedup.digest(substring_dedup.remove_repeated_words(frame(spark, rows, 2))).collect()}
    assert got == brute_words(rows) and [got[i][1] for i in (1, 2, 3)] == [0, 0, 20]


def test_packed_arrays():
    arrays = [np.array([], np.int64), np.array([1, 5, 2**40]), np.array([3, 2], np.uint16), np.frombuffer(b"abc", np.uint8), np.arange(500)]
    assert all(a.dtype == b.dtype and (a == b).all() for a, b in zip(arrays, passages.unsqueeze(passages.squeeze(*arrays)), strict=True))


def test_anchors_are_shared():
    rng = np.random.default_rng(2)
    x = windows.mix(rng.integers(0, 4, 400).astype(np.uint64))
    anchor, first, last = windows.stretches(windows.Spans(x, 3).runs(5), 20, 5)
    assert first[0] == 0 and last[-1] == 380 and (first[1:] == last[:-1] + 1).all()
    assert ((anchor >= last - 0) | (anchor >= first)).all() and (anchor + 5 <= first + 20).all()


# SimHash --------------------------------------------------------------------------------------------------------

def brute_print(text, k=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    runs = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    votes = [0] * 64
    for r in runs:
        h = xxh64_intdigest(r.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(runs))


def brute_components(prints, radius=3):
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [least.get(root(i)) for i in range(len(prints))]


@pytest.mark.parametrize("tree_bytes", [0, simhash.TREE_BYTES])
@pytest.mark.parametrize("nodes", [3, 1024])
def test_simhash(docs, rows, nodes, tree_bytes):
    prints = [(i, brute_print(t)) for i, t, *_ in rows]
    want = Counter((i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints), strict=True))
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs, tree_nodes=nodes, tree_bytes=tree_bytes).collect()) == want


def test_hash_is_sparks(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a bé c",)], "s string")
    assert df.select(F.xxhash64("s")).first()[0] & (1 << 64) - 1 == xxh64_intdigest("a bé c".encode(), 42)


def test_forest_is_a_bk_tree():
    """Children hang on their distance to the parent, and a search finds what brute force finds."""
    rng = np.random.default_rng(7)
    for words in (1, 4):
        prints = rng.integers(0, 2**63, (12, words)).astype(np.uint64)[rng.integers(0, 12, 400)] ^ (np.uint64(1) << rng.integers(0, 64, (400, words)).astype(np.uint64))
        shard = rng.integers(0, 9, 400)
        forest = simhash.Forest(shard, prints)
        parent, d = np.divmod(forest.key, forest.span)
        assert (simhash.Forest.distance(prints[parent], prints[forest.child]) == d).all() and (shard[parent] == shard[forest.child]).all() and (np.diff(forest.key) > 0).all()
        assert len(forest.child) + 9 == len(np.unique(forest.same))
        for radius in (0, 3, 40):
            found = {(int(q), int(x)) for a, b in forest.near(shard, prints, radius, visits=300) for q, x in zip(a, b, strict=True)}
            assert found == {(i, j) for i in range(400) for j in np.flatnonzero((shard == shard[i]) & (forest.same == np.arange(400))).tolist() if np.bitwise_count(prints[i] ^ prints[j]).sum() <= radius}


def test_keys_follow_the_number_of_fingerprints(spark):
    """With any number of blocks, two values within the radius share a key."""
    from pyspark.sql import functions as F

    rng = random.Random(2)
    pairs = []
    for _ in range(300):
        v = rng.getrandbits(64)
        w = v ^ sum({1 << rng.randrange(64) for _ in range(3)})
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (v, w)))
    df = spark.createDataFrame(pairs, "v long, w long")
    for n, keys in ((1000, 4), (10**8, 10), (10**10, 20)):
        v, w = (simhash.shard_keys(F.col(c), n, 3) for c in "vw")
        assert len(v) == keys and df.filter(F.arrays_overlap(F.array(*v), F.array(*w))).count() == 300


@pytest.mark.parametrize("nodes", [8, 1024])
def test_links_within_radius(spark, nodes):
    rng = random.Random(nodes)
    base = [rng.getrandbits(64) for _ in range(15)]
    values = list({v ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (1 << 64) - 1 for v in base for _ in range(12)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.link(spark.createDataFrame([(v,) for v in signed], "fp long"), tree_nodes=nodes, tree_bytes=0).collect()
    mask = (1 << 64) - 1
    up = {v: v for v in signed}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    for e in edges:
        up[root(e.a)] = root(e.b)
    brute = brute_components([(i, v) for i, v in enumerate(values)])
    groups = {}
    for v, c in zip(signed, brute, strict=True):
        assert groups.setdefault(c, root(v)) == root(v)
    assert len(set(groups.values())) == len(groups) and all(isinstance(e.a & mask, int) for e in edges)


def shingle_set(text, k=5):
    return set(simhash.shingles(text, k))


def test_drop_near_duplicates(docs, rows):
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    left = [r.doc_id for r in kept.collect()]
    texts = {i: t for i, t, *_ in rows}
    assert left.count(None) == 1 and len(left) == len(set(left))
    sets = {i: shingle_set(texts[i]) for i in left if i is not None}
    near = lambda a, b: len(a & b) / max(1, len(a | b))
    assert not [(i, j) for i in sets for j in sets if i < j and len(sets[i]) > 20 and near(sets[i], sets[j]) >= 0.8]
    # Nothing goes that has no near copy at all, kept or gone itself.
    every = {i: shingle_set(t) for i, t in texts.items() if i is not None}
    for i, own in every.items():
        if i not in sets and len(own) > 20:
            assert max(near(own, s) for j, s in every.items() if j != i) >= 0.8


def test_sets_of_one_fingerprint_are_all_checked(spark):
    """A third text at 0.8 to the second of two different texts of one fingerprint, and less to the first."""
    rng = random.Random(6)
    of = lambda words: simhash.long_fingerprint(" ".join(words), 1, 64, 42, 16, 2)
    while True:
        first = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        extra = f"x{rng.randrange(10**6)}"
        third = [*rng.sample(first, 160), extra]
        a, b, c = of(first), of([*first, extra]), of(third)
        if len(set(first)) == 200 and a[0] == b[0] and (int.from_bytes(a[0], "big") ^ int.from_bytes(c[0], "big")).bit_count() <= 15 and set(a[1]) & set(b[1]) & set(c[1]):
            break
    near = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y))
    assert near(first, third) < 0.8 <= near([*first, extra], third)
    texts = {1: first, 2: [*first, extra], 3: third, 4: [f"y{i}" for i in range(50)]}
    df = frame(spark, [(i, " ".join(w), "en", "s") for i, w in texts.items()], 2)
    assert {r.doc_id for r in simhash.drop_near_duplicates(df, k=1, bits=64).collect()} == {1, 4}
    assert {r.doc_id for r in simhash.drop_near_duplicates(df.filter("doc_id <> 2"), k=1, bits=64).collect()} == {1, 3, 4}


@pytest.mark.parametrize("nodes", [6, 1024])
def test_near_copies_of_short_texts(spark, nodes):
    """All links of small sets are found, also where a shingle is in most of them."""
    rng = random.Random(nodes)
    texts = []
    for i in range(240):
        if i % 3 == 0:
            n = rng.randrange(4, 60)
            base = [f"w{rng.randrange(10**6)}" for _ in range(n)] + ["common"] * (i % 2)
        most = max(1, len(base) // 10)
        texts.append((i, " ".join([w for w in base if rng.random() > 0.04] + [f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(most + 1))])))
    sets = {i: shingle_set(t, 1) for i, t in texts}
    want = brute_links(list(sets), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9)
    kept = simhash.drop_near_duplicates(frame(spark, [(i, t, "en", "s") for i, t in texts], 4), k=1, tree_nodes=nodes, small=80)
    assert {r.doc_id for r in kept.collect()} == set(want.values()) and 80 < len(set(want.values())) < 200
    # Pairs at the threshold itself, of 9 and 9 shingles and of 4 and 5; fingerprints alone lose some.
    pairs = []
    for i in range(150):
        w = [f"p{i}w{j}" for j in range(9)]
        pairs += [(4 * i, w), (4 * i + 1, [*w[:8], "z"]), (4 * i + 2, w[4:8] + ["q"]), (4 * i + 3, w[4:8])]
        pairs[-2:] = [(n, [f"s{x}" for x in w]) for n, w in pairs[-2:]]
    kept = simhash.drop_near_duplicates(frame(spark, [(i, " ".join(w), "en", "s") for i, w in pairs], 4), k=1, tree_nodes=nodes)
    assert {r.doc_id for r in kept.collect()} == set(brute_links_of(dict(pairs)).values())


def test_verified_links_are_exact(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(400)}" for _ in range(60)] for _ in range(4)]
    texts = []
    for i in range(90):
        w = list(base[i % 4])
        for _ in range(rng.randrange(4)):
            w[rng.randrange(60)] = f"x{rng.randrange(9)}"
        texts.append((i, " ".join(w)))
    members = spark.createDataFrame([(i, i % 2) for i, _ in texts], "node long, root long")
    sets = {i: shingle_set(t) for i, t in texts}
    want = brute_links([i for i, _ in texts], lambda a, b: a % 2 == b % 2 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    for block in (7, 512):
        edges = simhash.verified(members, spark.createDataFrame(texts, "_id long, _text string"), 5, 0.8, block).collect()
        assert brute_links([i for i, _ in texts], lambda a, b, e={(x.a, x.b) for x in edges}: (a, b) in e or (b, a) in e) == want
    assert len(set(want.values())) < 90


def brute_links_of(words, similarity=0.8):
    sets = {i: set(w) for i, w in words.items()}
    return brute_links(list(sets), lambda a, b: len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9)


def brute_links(nodes, linked):
    label = {n: n for n in nodes}
    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {n: new if v == old else v for n, v in label.items()}
    return label


def test_components_on_chains(spark):
    from corpusloom.llm.common import components

    n = 60
    edges = [(i, i + 1) for i in range(0, n)] + [(1000 - i, 1000) for i in range(1, 30)] + [(7, 7), (3, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(n + 1), 0) | dict.fromkeys(range(971, 1001), 971)


def test_runs_in_steps():
    rng = np.random.default_rng(3)
    for n in (0, 3, 4, 50, 333):
        x = windows.mix(rng.integers(0, 9, n).astype(np.uint64))
        assert (windows.runs_of(x, 4, 3, step=7) == windows.Spans(x, 3).runs(4)).all()


def test_distinct_hashes():
    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 5, 300):
        for h in (rng.integers(0, 2**63, n).astype(np.uint64)[rng.integers(0, max(1, n // 3), n)] if n else np.zeros(0, np.uint64), np.uint64(5) << np.uint64(60) | rng.integers(0, 4, n).astype(np.uint64)):
            first, inverse = windows.distinct(h)
            assert len(first) == len(np.unique(h)) and (h[first][inverse] == h).all()
