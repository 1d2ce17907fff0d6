"""Words and stretches that share a hash are still told apart."""

import random
from hashlib import blake2b

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import packing, substring_dedup, suffix_dedup, windows

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
#: A pair found once by inverting the mix.
KNOWN = (b"abcdefghijklmnop", b"oevob3ki5'w\\8@:2")


def unmix(h):
    s = np.uint64(33)
    for m in (windows._M2, windows._M1):
        h = h ^ (h >> s)
        h = h * np.uint64(pow(int(m), -1, 1 << 64))
    return h ^ (h >> s)


def colliding(word, seed):
    """Another word of 16 printable characters with the hash of ``word``, without capitals."""
    rng = np.random.default_rng(seed)
    allowed = np.array([c for c in range(33, 127) if not 65 <= c <= 90], np.uint8)
    a, b = np.frombuffer(word, "<u8")
    size = np.array([16], np.uint64) * windows._BASE
    want = windows.mix(np.array([a])) ^ (windows.mix(np.array([b])) + size)
    while True:
        tail = allowed[rng.integers(0, len(allowed), (1 << 16, 8))].view("<u8").ravel()
        head = unmix(want ^ (windows.mix(tail) + size))
        ok = np.isin(head.view(np.uint8).reshape(-1, 8), allowed).all(1)
        if ok.any():
            i = int(np.flatnonzero(ok)[0])
            return head[i].tobytes() + tail[i].tobytes()


def pairs():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(16)).encode() for _ in range(3)]
    return [KNOWN, *((w, colliding(w, k)) for k, w in enumerate(words))]


@pytest.mark.parametrize("pair", pairs())
def test_words_of_one_hash(spark, pair):
    a, b = pair
    data = a + b" " + b + b" " + a
    spans = windows.word_spans(data)
    h = windows.word_hashes(data, *spans)
    assert h[0] == h[1] == h[2] and a != b
    assert windows.distinct_words(data, *spans)[1].tolist() == [0, 1, 0]
    # op1: windows that differ in this word alone are different; the same word repeats.
    rest = [f"w{k}" for k in range(19)]
    texts = [" ".join([*rest[:9], x.decode(), *rest[9:]]) for x in (a, b, a)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.n_removed for r in substring_dedup.remove_repeated_words(df).collect()} == {0: 0, 1: 0, 2: 20}
    one = spark.createDataFrame([(0, "\n".join(texts[:2]) + " x " + texts[0])], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup.remove_repeated_words(one).collect()] == [20]
    # op2: each word gets its own ids.
    tok, own = Tokenizer.from_file(WORD_FILE), packing.WordTokenizer(WORD_FILE)
    text = f"{a.decode()} {b.decode()} {a.decode()}"
    assert own.all([text]) == [packing.little(tok.encode(text, add_special_tokens=False).ids)]


def test_long_words_of_one_hash(monkeypatch):
    """Words beyond 16 bytes share a hash if all of them do: bytes tell them apart."""
    monkeypatch.setattr(windows, "word_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    words = [b"x" * 20, b"x" * 19 + b"y", b"x" * 20, b"x" * 21, b"ab", b"ab", b"b"]
    data = b" ".join(words)
    first, inverse = windows.distinct_words(data, *windows.word_spans(data))
    assert inverse.tolist() == [0, 1, 0, 2, 3, 3, 4]
    assert first.tolist() == [0, 1, 3, 4, 6]


@pytest.mark.parametrize("method", ["words", "bytes"])
def test_stretches_of_one_sum(spark, monkeypatch, method):
    """Sums of powers can be forged (words arranged as the Thue-Morse sequence has them); the digests of bytes can't."""
    morse = "".join("ab"[bin(k).count("1") % 2] for k in range(4096))
    other = "".join("ab"[1 - bin(k).count("1") % 2] for k in range(4096))
    rng = random.Random(4)
    letters = {c: "".join(rng.choice("klmnopq") for _ in range(6)) for c in "ab"}
    run = substring_dedup.remove_repeated_words if method == "words" else suffix_dedup.remove_repeated_bytes
    split = " " if method == "words" else ""
    df = spark.createDataFrame([(k, f"u{k}v " * 3 + split.join(letters[c] if method == "words" else c for c in t) + f" y{k}z" * 3) for k, t in enumerate((morse, other))], "doc_id long, text string")
    from test_dedup import brute_bytes, brute_words

    rows = [tuple(r) for r in df.collect()]
    want = (brute_words if method == "words" else brute_bytes)(rows)
    module = substring_dedup if method == "words" else suffix_dedup
    assert {r[0]: tuple(r)[1:] for r in module.digest(run(df)).collect()} == want


def test_digests_are_of_the_bytes_under_a_key():
    """A digest hangs on the bytes of a span and on the key, not on what stands around it, nor on blanks between words."""
    from dataclasses import replace

    plan = replace(substring_dedup.plan_of(3, 1), key=b"k" * 16)
    a, b = plan.content(b"x  one\ttwo three"), plan.content(b"one two three y")
    of = lambda c, at: plan.digests(c, np.array([at]), np.array([3]))[0]
    assert of(a, 1) == of(b, 0) == np.frombuffer(blake2b(b"one two three ", digest_size=8, salt=b"k" * 16).digest(), np.uint64)[0]
    assert of(a, 0) != of(b, 0)
    assert replace(plan, key=b"l" * 16).digests(b, np.array([0]), np.array([3]))[0] != of(b, 0)


@pytest.mark.parametrize("method", ["words", "bytes"])
def test_method_alone_finds_every_repeat(rows, method):
    """Without counts of owners: each stretch a record of its own, and the method tells from the bytes what repeats."""
    from test_dedup import brute_bytes, brute_words

    plan = substring_dedup.plan_of(20, 5) if method == "words" else suffix_dedup.plan_of(50, 16)
    texts = [(i, t) for i, t in sorted({i: t for i, t, *_ in rows if i is not None and t}.items()) if len(t) < 2000 and plan.count(plan.content(t.encode())) >= plan.window][:60]
    records, content = [], []
    for i, t in texts:
        _, first, last = windows.stretches(plan.rank(windows.Spans(plan.tokens(t.encode()), 3).runs(plan.k)), plan.window, plan.k)
        length = last - first + plan.window
        records += zip([i] * len(first), first.tolist(), length.tolist(), strict=True)
        content.append(plan.cut(plan.content(t.encode()), first, length))
    doc, first, length = (np.array(c, np.int64) for c in zip(*records, strict=True))
    _, late = plan.resolve(plan.rank, doc, first, length, np.ones(len(doc), np.int64), np.concatenate(content))
    want = (brute_words if method == "words" else brute_bytes)(texts)
    gone = {i: np.zeros(want[i][0], bool) for i, _ in texts}
    begin = np.cumsum(length) - length
    for i, f, n, lo in zip(doc.tolist(), first.tolist(), length.tolist(), begin.tolist(), strict=True):
        for s in np.flatnonzero(late[lo : lo + n]).tolist():
            gone[i][f + s : f + s + plan.window] = True
    assert {i: int(g.sum()) for i, g in gone.items()} == {i: want[i][1] for i, _ in texts}
