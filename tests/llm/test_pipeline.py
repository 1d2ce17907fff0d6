"""Every stage on the smallest table, against what it must keep and what it must drop."""

import corpus_pipeline
from common_docs import frame

from corpusloom.llm import simhash

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    columns = docs.columns
    seen = [set(texts)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        rows = docs.collect()
        seen.append({r.doc_id for r in rows})
        assert len(rows) == len(seen[-1]) and seen[-1] <= seen[-2], name
    assert len(seen[1]) < len(seen[0]) and seen[2] and len(seen[3]) < len(seen[2]) and seen[4] == seen[3]
    # Only what has a near copy goes at the third stage.
    sets = {i: set(simhash.shingles(texts[i], 5)) for i in seen[2]}
    for i in seen[2] - seen[3]:
        assert max(len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for j in seen[2] if j != i) >= 0.8
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == seen[4]
    assert all(r.offset + r.length <= 2048 for r in packed)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_odd_rows(spark, docs, none, rows):
    for table in (docs, none, frame(spark, [(None, None, None, None)] * 3)):
        x = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            x = stage(spark, x, SF)
            assert x.columns == table.columns
            x = x.cache()
            x.count()
        corpus_pipeline.STAGES[-1][1](spark, x, SF).count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() >= 0, name


def test_dedup_stages_against_brute_force(spark):
    """Ids that near-dedup keeps and texts that suffix dedup leaves, in both directions."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, SF)
    docs = docs.cache()
    sets = {r.doc_id: set(simhash.shingles(r.text, 5)) for r in docs.collect()}
    holders = {}
    for i, own in sets.items():
        for x in own:
            holders.setdefault(x, []).append(i)
    near = {(a, b) for own in holders.values() for a in own for b in own if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    label = {i: i for i in sets}
    for _ in sets:
        new = dict(label)
        for a, b in near:
            new[a] = new[b] = min(new[a], new[b])
        if new == label:
            break
        label = new
    kept = corpus_pipeline.near_dedup(spark, docs, SF).cache()
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows) == sorted(set(label.values())) and len(rows) < len(sets)
    want, seen = {}, {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        b = (r.text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if seen.setdefault(b[i : i + 50], r.doc_id) != r.doc_id:
                gone[i : i + 50] = b"\1" * 50
        want[r.doc_id] = bytes(x for x, g in zip(b, gone, strict=True) if not g)
    got = {r.doc_id: r.text for r in corpus_pipeline.substring_dedup(spark, kept, SF).collect()}
    assert got == {i: b.decode("utf-8", "ignore") for i, b in want.items()}
    assert sum(map(len, want.values())) < sum(len((r.text or "").encode()) for r in rows)
