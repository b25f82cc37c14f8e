"""Small documents that hold the awkward cases, with columns whose names the operators use inside."""

from __future__ import annotations

import random

CLASHING = ("row", "id", "fp", "score", "h", "name", "key", "part", "bin", "offset", "length", "line", "kept", "tokens")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
SYLLABLES = "an er th ou ti on re st le in ka mo".split()


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


def awkward(seed: int = 5, more: int = 60) -> list[tuple]:
    """(doc_id, text): nulls, empty and blank texts, very long ones, copies, near copies, repeated rows."""
    rng = random.Random(seed)
    texts = [None, "", " ", "\n\n", "\x1c", "a", "a b", "A B", "a  b", "a b", "é" * 50, "漢字 かな\nカナ", "x" * 5000,
             sentence(rng, 9000), "\n".join(sentence(rng, 12) for _ in range(300))]
    base = [sentence(rng, rng.randint(5, 80)) for _ in range(more)]
    for t in base:
        words = t.split()
        texts.append(t)
        kind = rng.randint(0, 5)
        if kind == 0:
            texts.append(t.replace(" ", "\n", 3))
        elif kind == 1:
            words[rng.randrange(len(words))] = "zz"
            texts.append(" ".join(words))
        elif kind == 2:
            texts.append(t.upper())
        elif kind == 3:
            texts += [t] * 3
        elif kind == 4:
            texts.append(t + rng.choice(["x", ".", ""]))
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], (21, "another text of one id"), (None, texts[16]), (None, None), (-5, texts[15])]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    full = [(i, t, "en", "src0", None if t is None else len(t), *[f"{c}!" for c in CLASHING]) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3).cache()
