"""Small awkward inputs for the training-data operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size string, score string, start int"


def words(n: int, seed: int, vocabulary: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def awkward() -> list[tuple]:
    """Nulls, empty and long texts, white space alone, exact and near copies, shared passages, repeats inside one text."""
    base, passage = words(300, 1), words(60, 2)
    texts = [
        None, "", "   \t\n ", "one", "two words", " ".join(base), " ".join(base), " ".join(base[:150] + ["x"] + base[151:]),
        " ".join(words(80, 3) + passage + words(30, 4)), " ".join(words(40, 5) + passage + words(90, 6)), " ".join(passage),
        "a" * 700, "ab" * 300, " ".join(["same"] * 400), "ÀÉ é ñ " * 60, "Zeile\x0beins\x0c" * 40, " ".join(words(20_000, 7)),
        " ".join(base[10:70]), "UPPER Case. " + " ".join(base[100:160]).upper(), "don't <|endoftext|> stop! #1 x 漢字かな 123",
    ]
    for i in range(30):  # near copies of each other
        edited = list(base)
        for j in random.Random(i).sample(range(300), 1 + i % 4):
            edited[j] = f"edit{i}"
        texts.append(" ".join(edited))
    rows = [(i, t, "en", f"s{i % 4}" if i % 5 else None, len(t or ""), "k", "big", "high", i) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[1], (3, "another text under a known id", None, None, None, None, None, None, None)]


def frame(spark, rows: list[tuple] | None = None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
