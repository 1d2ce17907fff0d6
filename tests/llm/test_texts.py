"""Packing, license scans, byte-level BPE, quality rules, URL filters, language ID."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from common_docs import WORDS, frame

from corpusloom.llm import byte_bpe, language_id, license_scan, packing, quality, url_filter

WORD_FILE, RANK_FILE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")


# Packing --------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("room", [64, 2048])
def test_pack(docs, rows, room):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORD_FILE)
    want = Counter()
    for i, t, *_ in rows:
        want[i, tuple([*tok.encode(t or "", add_special_tokens=False).ids, 1])] += 1
    got = packing.pack(docs, WORD_FILE, room=room, group=40, with_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0 and zlib.crc32(r.ids) == r.ids_crc32
        by_doc[r.doc_id].append((r.start, tuple(ids.tolist()), r.doc_tokens))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= room
    for i, own in by_doc.items():
        texts = [ids for (d, ids), n in want.items() if d == i for _ in range(n)]
        if len(texts) == 1:
            assert tuple(x for _, ids, _ in sorted(own) for x in ids) == texts[0] and own[0][2] == len(texts[0])
    total = sum(len(ids) * n for (_, ids), n in want.items())
    assert sum(r.length for r in got) == total
    assert len(by_sequence) * room <= total * 1.15 + 4 * room


def test_first_fit_decreasing():
    rng = np.random.default_rng(1)
    for _ in range(40):
        lengths = rng.integers(1, 100, int(rng.integers(1, 60))).tolist()
        bins, want = [], [None] * len(lengths)
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            b = next((b for b, used in enumerate(bins) if used + lengths[i] <= 100), None)
            if b is None:
                b = len(bins)
                bins.append(0)
            want[i] = (b, bins[b])
            bins[b] += lengths[i]
        assert packing.first_fit_decreasing(lengths, 100) == want


# Byte-level BPE -------------------------------------------------------------------------------------------------

ODD = ["a  b\n\n c\t\x1cd can't  ", "İΣς ﬁ \u3000x y", "  ", "\n \n", "'s'll ''re", "日本語テキスト１２３ 🤗👩‍👩‍👧", "\x00\x01 \x1f\x85x", "don't I'M 12345 $$$%%%", "", " a", " ́a", "Ä Å ΑΣ Σα ϴ K", "a<|endoftext|>b"]


def tiktoken_encoding():
    import tiktoken

    with open(RANK_FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(docs, rows):
    enc = tiktoken_encoding()
    want = Counter()
    for i, t, *_ in rows:
        ids = enc.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in byte_bpe.encode_texts(docs, RANK_FILE, P.PATTERN, digests=True).collect()) == want
    full = byte_bpe.encode_texts(docs.limit(20), RANK_FILE, P.PATTERN).collect()
    texts = {i: t or "" for i, t, *_ in rows}
    assert all(r.ids == enc.encode_ordinary(texts[r.doc_id]) and bytes(r.decoded).decode() == texts[r.doc_id] for r in full)


def test_bpe_odd_texts():
    enc, codec = tiktoken_encoding(), byte_bpe.Codec(byte_bpe.read_ranks(RANK_FILE), P.PATTERN, keep=4)
    for t in ODD * 2:
        assert codec.encode(t) == enc.encode_ordinary(t), t
        assert codec.decode(codec.encode(t)) == t.encode()


def test_word_tokenizer_odd_texts():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(WORD_FILE), packing.WordTokenizer(WORD_FILE, keep=4)
    for t in ODD * 2:
        assert own(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


# License scans --------------------------------------------------------------------------------------------------

def brute_license(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    hits, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                hits.append(i)
                labels.add(label)
    return len(words), len(hits), min(hits, default=None), max(hits, default=None), ",".join(sorted(labels))


def test_license(docs, rows):
    want = Counter((i, *brute_license(t)) for i, t, *_ in rows)
    got = license_scan.scan_licenses(docs).collect()
    assert Counter(tuple(r)[:6] for r in got) == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert any(r.n_base for r in got)


def test_fuzzy_notices():
    import regex

    scan = license_scan.Scanner(license_scan.PHRASES, license_scan.NOTICES)
    notice = license_scan.NOTICES[0][1]
    for edits, found in ((0, True), (6, True), (12, False)):
        t = list(notice)
        for k in range(edits):
            t[3 + 5 * k] = "q"
        text = "Words before. " + "".join(t) + " words after."
        spans = scan(text)[7]
        assert bool(spans) == found
        if found:
            assert spans[0]["edits"] == edits and license_scan.normal(text)[spans[0]["start"] : spans[0]["end"]] == "".join(t)
    # No match is lost for want of a seed.
    rng = np.random.default_rng(3)
    for _ in range(60):
        label, text, k = license_scan.NOTICES[int(rng.integers(len(license_scan.NOTICES)))]
        t = list(text)
        for _ in range(int(rng.integers(0, k + 3))):
            at = int(rng.integers(len(t)))
            t[at : at + 1] = [[], ["z"], [t[at], "z"]][int(rng.integers(3))]
        body = "some words " + "".join(t) + " more words"
        norm = license_scan.normal(body)
        if regex.search(f"(?:{regex.escape(text)}){{e<={k}}}", norm):
            assert label in scan(body)[5].split(",")


def edits_within(text, norm, k):
    """Ends of the substrings of ``norm`` within ``k`` edits of ``text``."""
    row = [0] * (len(norm) + 1)
    for i, c in enumerate(text):
        new = [i + 1]
        for j, d in enumerate(norm):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return [j for j, e in enumerate(row) if e <= k]


def test_all_copies_side_by_side():
    notices = license_scan.NOTICES
    scan = license_scan.Scanner(license_scan.PHRASES, notices)
    text = notices[0][1]
    near = text.replace("granted", "grqnted")
    for copies in ([near] * 20 + [text], [near, text], [text, near], [near, text] * 60, [near] * 100 + [text] * 3):
        at, want = 1, []
        for c in copies:
            want.append(("mit", at, at + len(c), int(c != text)))
            at += len(c) + 1
        assert scan.fuzzy(license_scan.normal(" ".join(copies))) == want
    rng = np.random.default_rng(4)
    for t in range(60):
        label, text, k = notices[t % len(notices)]
        scan = license_scan.Scanner({}, [(label, text, k)])
        parts = []
        for _ in range(int(rng.integers(2, 7))):
            c = list(text)
            for _ in range(int(rng.integers(0, k + 2))):
                at = int(rng.integers(len(c)))
                c[at : at + 1] = [[], ["z"], [c[at], "z"]][int(rng.integers(3))]
            parts += ["".join(c)] + ["words between"] * int(rng.integers(2))
        norm = license_scan.normal(" ".join(parts))
        spans = scan.fuzzy(norm)
        # Nothing that matches is left before, between or after the spans, and their edits are those of the texts.
        cuts = [0, *(x for s in spans for x in s[1:3]), len(norm)]
        assert cuts == sorted(cuts) and not any(edits_within(text, norm[a:b], k) for a, b in zip(cuts[::2], cuts[1::2], strict=True))
        for _, a, b, e in spans:
            assert e <= k and b - a in edits_within(text, norm[a:b], e) and not edits_within(text, norm[a:b], e - 1)


# Quality rules --------------------------------------------------------------------------------------------------

def brute_quality(text):
    t = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(runs)
    covered = {j for i, r in enumerate(runs) if count[r] > 1 for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    out = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)
    return *out, out[0] < 50 or 100 * out[4] > 50 * out[0]


def test_quality(spark, docs, rows):
    got = quality.judge(docs).collect()
    assert Counter(tuple(r)[:7] for r in got) == Counter((i, *brute_quality(t)) for i, t, *_ in rows)
    assert all(not (r.base_failed and r.kept) for r in got)
    bad = frame(spark, [(i, "x", "en", "bad") for i in range(100)] + [(200, " ".join(f"w{j}" for j in range(80)), "en", "bad"), (201, " ".join(f"w{j}" for j in range(80)), "en", "good")] + [(300 + i, " ".join(f"v{i}{j}" for j in range(80)), "en", "good") for i in range(50)])
    verdict = {r.doc_id: (r.base_failed, r.kept) for r in quality.judge(bad).collect()}
    assert verdict[200] == (False, False) and verdict[201] == (False, True)
    kept = quality.drop_rejected(bad)
    assert kept.columns == bad.columns and {r.doc_id for r in kept.collect()} == {i for i, (_, k) in verdict.items() if k}


def test_quality_is_native(docs):
    plan = quality.judge(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_quality_empty(none):
    assert quality.judge(none).count() == 0 and quality.drop_rejected(none).count() == 0


# URL filters ----------------------------------------------------------------------------------------------------

def brute_url(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, default=(0, None, None))[1:]


URLS = [None, "", "no scheme", "http://", "http://A.Example.COM/en/7x?q#f", "https://b.com/en/1", "x://y.net/de/8", "https://q.example.net/de/81", "https://example.net?/de/8", "s://org/es/", "a://b://c.org/es/x", "http://ünï.net/de/\nx", "http://h.org/fr/" + "9" * 5000, "http://xcom/en/1", "http://com/en/"]


def test_urls(spark):
    rows = [(i, u, "html", "h", "p") for i, u in enumerate(URLS * 8)]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string, host string, p_block string")).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, (rule, verdict) = brute_url(URLS[r.page_id % len(URLS)])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict) and (r.p_block is None) == (rule is not None)
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(empty).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")).collect()} == {"allow"}


def test_trees_learn():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(1200):
        spam = rng.random() < 0.5
        host = f"w{rng.integers(99)}.{'biz' if spam else 'edu'}"
        path = "/" + "/".join(str(rng.integers(10 ** (6 if spam else 2))) for _ in range(int(rng.integers(1, 4))))
        rows.append((f"http://{host}{path}", host, path, spam))
    y = np.array([r[3] for r in rows])
    model = url_filter.UrlModel().fit([r[:3] for r in rows[:800]], y[:800])
    assert ((model.predict(model.features([r[:3] for r in rows[800:]])) > 0.5) == y[800:]).mean() > 0.95
    # Without the suffix statistics the other features have to tell.
    model = url_filter.UrlModel().fit([(u, "", p) for u, _, p, _ in rows[:800]], y[:800])
    assert ((model.predict(model.features([(u, "", p) for u, _, p, _ in rows[800:]])) > 0.5) == y[800:]).mean() > 0.85


def test_trees_on_held_out_pages(spark):
    """Labels are the rules' own; half of the ruled URLs train, the others are judged without their rule."""
    urls = sorted({r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url").collect() if r.url})
    ruled = [(u, *brute_url(u)) for u in urls]
    ruled = [((u, h, p), v == "block") for u, h, p, (_, v) in ruled if v]
    train, rest = ruled[::2], ruled[1::2]
    model = url_filter.UrlModel().fit([r for r, _ in train], np.array([b for _, b in train]))
    right = (model.predict(model.features([r for r, _ in rest])) >= 0.5) == np.array([b for _, b in rest])
    most = max(np.mean([b for _, b in rest]), 1 - np.mean([b for _, b in rest]))
    assert len(rest) > 30 and right.mean() >= 0.9 and right.mean() >= most, (len(rest), right.mean(), most)


def test_suffix_statistics_do_not_hold_a_rows_own_label():
    """Every suffix stands once and labels are tossed: only features with the label in them could fit it."""
    rng = np.random.default_rng(1)
    rows = [(f"http://a.s{i}/", f"a.s{i}", "/") for i in range(400)]
    y = rng.random(400) < 0.5
    model = url_filter.UrlModel().fit(rows, y)
    for k in range(2):
        assert all(set(tree[0][tree[0] >= 0]) & {url_filter.N_STATIC + 2 * k} == set() for tree in model.trees)


# Language ID ----------------------------------------------------------------------------------------------------

def test_language(docs, rows):
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows)
    texts = {i: (t, lang) for i, t, lang, _ in rows}
    right = total = 0
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        t, lang = texts[r.doc_id]
        if t is None or not any(map(str.isalpha, t)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.held_out and lang in WORDS and len(t) > 100 and not re.search(r"[#\d]", t):
            total += 1
            right += r.lang_pred == lang
        assert 0 <= r.score <= 1
    assert total > 10 and right / total > 0.75


def test_language_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang_pred <> 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.9


def test_codewords():
    for k in (2, 3, 4, 6, 7, 12):
        c = language_id.codewords(k)
        apart = min(int((c[i] != c[j]).sum()) for i in range(k) for j in range(i))
        assert c.shape[0] == k and set(np.unique(c)) == {-1.0, 1.0} and apart >= (1 if k == 2 else c.shape[1] // 3 if k > 6 else 2 ** (k - 2))


def test_language_edges(spark, none):
    assert language_id.identify(none).count() == 0
    one = frame(spark, [(i, "the house", "en", "s") for i in range(9)])
    assert {r.lang_pred for r in language_id.identify(one).collect()} == {"en"}
    unlabelled = frame(spark, [(1, "the house", None, "s")])
    assert [(r.lang_pred, r.score) for r in language_id.identify(unlabelled).collect()] == [("und", 0.0)]
    assert language_id.drop_unidentified(unlabelled).count() == 0


def test_map_operators_empty(none):
    assert packing.pack(none, WORD_FILE).count() == 0
    assert license_scan.scan_licenses(none).count() == 0
    assert byte_bpe.encode_texts(none, RANK_FILE, P.PATTERN).count() == 0


def test_every_language_is_learned(spark):
    rows = [(i, f"wort{i % 230} und satz{i % 230} " * 3, f"l{i % 230}", "s") for i in range(230 * 6)]
    want = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1}
    assert len(want) > 200
    for train_rows in (100, 400):
        assert set(language_id.fit_language_model(frame(spark, rows, 4), train_rows=train_rows).langs) == want


def test_codewords_differ():
    for k in (7, 40, 3000):
        code = language_id.codewords(k)
        assert len(np.unique(code, axis=0)) == k


def test_equal_rows_are_dealt_to_many_groups(spark):
    """Forty thousand equal documents: at the usual size of a group they need about ten."""
    import public_tokenizers

    df = spark.range(40_000).selectExpr("1L AS doc_id", "'some words that are all the same' AS text").repartition(4)
    got = packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).selectExpr("sequence_id >> 32 AS g", "length").groupBy("g").count().collect()
    assert len(got) >= 9 and max(r["count"] for r in got) < 6000


def test_long_words_keep_their_ids():
    """Words that sums of powers cannot tell apart have ids of their own."""
    import public_tokenizers

    tok = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    for n in (512, 1024, 4096):
        words = ["".join(letters[i.bit_count() & 1] for i in range(n)) for letters in ("ab", "ba")]
        assert [tok(w) for w in words] == tok.all(words) == [packing.little(tok.tokenizer.encode(w, add_special_tokens=False).ids) for w in words]
        assert tok(" ".join(words)) == tok(words[0]) + tok(words[1])


def test_license_grams_change_nothing(monkeypatch):
    """Notices whole, edited, cut and in heaps: the same spans with the look at grams as without it; and beginnings over and over cost little."""
    import random
    import time

    rng = random.Random(7)
    scan = license_scan.Scanner({}, license_scan.NOTICES)
    found = 0
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(1, 20)):
            _, text, k = rng.choice(license_scan.NOTICES)
            kind = rng.random()
            if kind < 0.5:
                own = list(text)
                for _ in range(rng.randrange(k + 2)):
                    own[rng.randrange(len(own))] = rng.choice(("", "x", "a ", "é"))
                parts.append("".join(own))
            else:
                parts.append(text[: rng.randrange(len(text))] if kind < 0.8 else f"w{rng.randrange(9)} 日本")
        norm = license_scan.normal(" ".join(parts))
        got = scan.fuzzy(norm)
        monkeypatch.setattr(license_scan, "LONG", 10**9)
        assert got == scan.fuzzy(norm)
        monkeypatch.undo()
        found += len(got)
    assert found > 300
    for text in ("redistribution and use in source and binary forms ", "permission is hereby "):
        norm = license_scan.normal(text * (500_000 // len(text)))
        began = time.perf_counter()
        assert scan.fuzzy(norm) == []
        assert time.perf_counter() - began < 5


def test_a_frequent_url_is_one_of_the_sample(spark, monkeypatch):
    """One URL on most rows: the trees see it once, and as many others as they may."""
    seen = []
    monkeypatch.setattr(url_filter.UrlModel, "fit", lambda self, urls, y, real=url_filter.UrlModel.fit: seen.append([u[0] for u in urls]) or real(self, urls, y))
    often = "http://a.com/en/x"
    df = spark.range(6000).selectExpr("id AS page_id", f"CASE WHEN id % 10 < 8 THEN '{often}' WHEN id % 20 < 10 THEN concat('http://b.net/de/', id) ELSE concat('http://h', id, '.example.com/en/7', id) END AS url")
    got = url_filter.filter_urls(df, train_rows=500)
    assert got.count() == 6000
    assert len(seen[0]) == len(set(seen[0])) == 500
