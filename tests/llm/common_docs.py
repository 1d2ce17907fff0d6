"""Small corpora with what operators must stand: nulls, blanks, a very long text, copies, repeated rows, odd characters, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, part int, kind int, data string, node long, a string, _host string, h string, _node string, _id string, _text string, _bad_host string, _kept string"

#: Words of a language each; the smallest the tests need.
WORDS = {
    "en": "the house was built near a river where many people walk with their dogs every morning while birds sing above trees".split(),
    "de": "das haus wurde nahe einem fluss gebaut wo viele leute jeden morgen mit ihren hunden spazieren während vögel über bäumen singen".split(),
    "fr": "la maison était construite près d'une rivière où beaucoup de gens marchent avec leurs chiens chaque matin quand les oiseaux chantent".split(),
    "es": "la casa fue construida cerca del río donde mucha gente camina con sus perros cada mañana mientras los pájaros cantan sobre árboles".split(),
}


def corpus(n: int = 120, seed: int = 1) -> list[tuple[int | None, str | None, str | None, str | None]]:
    rng = random.Random(seed)
    rows: list[tuple] = []
    passage = " ".join(rng.choice(WORDS["en"]) + str(rng.randrange(50)) for _ in range(70))
    for i in range(n):
        lang = rng.choice(list(WORDS))
        words = [rng.choice(WORDS[lang]) + ("" if rng.random() < 0.4 else rng.choice("abcdefgh") + rng.choice("xyz")) for _ in range(rng.choice((3, 30, 80, 160)))]
        text = " ".join(words)
        kind = rng.random()
        if kind < 0.15 and rows:
            text, lang = rng.choice([r[1:3] for r in rows if r[1]])  # an exact copy
        elif kind < 0.3 and rows:
            text, lang = rng.choice([r[1:3] for r in rows if r[1]])
            w = text.split(" ")
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)  # a near copy
        elif kind < 0.45:
            text = text + "\n" + passage + "\t" + text[:20]
        elif kind < 0.5:
            text = "again and " * 40
        rows.append((i, text, lang, f"src{rng.randrange(4) if i % 3 else 0}"))
    rows += [
        (n, None, None, None), (n + 1, "", "en", "src1"), (n + 2, " \n\t ", None, "src1"), (n + 3, "日本語 テキスト é\u0301 🤗 \x1c x\u00a0y İΣΑΣ", "xx", None),
        (n + 4, " ".join(rng.choice(WORDS["en"]) + str(rng.randrange(900)) for _ in range(30_000)), "en", "src2"), (None, passage, "en", "src3"), (5, rows[5][1], rows[5][2], rows[5][3]),
        (n + 5, "#$%&|<>* " * 30, "en", "src3"), (n + 6, "MIT License. mit-license\nGeneral Public  License apache", "en", "src0"),
    ]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, parts: int = 3):
    full = [(i, t, lang, src, len(t or ""), "k", 1, 2, "d", 3, "a", "host", "h", "n", "i", "t", "b", "k") for i, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts) if full else spark.createDataFrame([], SCHEMA)
