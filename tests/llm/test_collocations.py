"""Collocation mining against a count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import llm_fixtures as fixtures
import numpy as np
import pytest

from rosterline.llm import collocations


def brute_force(rows: list[tuple], least: int, top: int, covered: int) -> list[tuple]:
    counts: dict[str, Counter] = defaultdict(Counter)
    for text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 5):
                counts[lang or "und"].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and p[i:j] in candidates and 100 * a >= covered * candidates[p[i:j]]}
        scored = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        n = sum(a for p, a in f.items() if len(p) == 1)
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def mined(docs, **options) -> list[tuple]:
    return sorted(map(tuple, collocations.mine(docs, **options).collect()))


def random_rows(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    words = ["the", "of", "The", "Ábc", "x y", "é", "a-b", "ſ", "漢字", "q"] + [f"w{i}" for i in range(8)]
    ends = [" "] * 12 + [". ", ", ", "\n", "\t", " ! ", "\x0b"]
    return [("".join(rng.choice(words[:rng.choice([3, 6, 18])]) + rng.choice(ends) for _ in range(rng.randrange(0, 60))), rng.choice(["en", "de", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize(("least", "top", "covered", "budget"), [(3, 10_000, 80, 1 << 16), (5, 7, 80, 40), (2, 10_000, 50, 8), (30, 2000, 80, 100)])
def test_against_all_phrases(spark, least, top, covered, budget):
    rows = random_rows(300, budget)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    got = mined(docs, least=least, top=top, covered=covered, budget=budget)
    assert got == brute_force(rows, least, top, covered)
    assert least == 30 or len(got) > 10


def test_awkward_rows(spark):
    docs = fixtures.frame(spark)
    rows = [(r.text, r.lang) for r in docs.collect()]
    for budget in (50, 1 << 16):
        assert mined(docs, least=30, top=50, covered=80, budget=budget) == brute_force(rows, 30, 50, 80)
    assert mined(fixtures.frame(spark, [])) == []
    assert mined(fixtures.frame(spark, [(1, None, None, *[None] * 6), (2, " \t.\n", "en", *[None] * 6)])) == []


def test_one_phrase_in_most_places(spark):
    rows = [("common phrase of all rows", "en")] * 500 + random_rows(100, 3)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    assert mined(docs, least=4, top=300, covered=80, budget=20) == brute_force(rows, 4, 300, 80)


def test_every_prefix_is_in_one_group():
    rng = np.random.default_rng(1)
    stream = rng.integers(0, 6, 4000)
    suffixes = collocations.suffixes_of(stream)
    partition = collocations.Partition(6, [np.array([1, 2]), np.array([1 * 6 + 1, 2 * 6 + 2]), np.array([0 * 6 + 1])],
                                       [np.array([3, 5]), np.array([1 * 6 + 2, 2 * 6 + 1]), np.array([0 * 6 + 2, 1 * 6 + 1])])
    at = np.concatenate([a for a, _ in partition.groups(suffixes)])
    assert len(at) == len(set(at.tolist()))
    left = np.setdiff1d(np.arange(suffixes.shape[1]), at)
    # what no group gets: pairs that end below a heavy pair, and what is below the heavy triple
    a, b, c, _ = suffixes[:, left]
    assert (((a == b) & (a <= 2)) & ((c == 0) | ((a == 1) & (c == 1)))).all()


def test_columns_round_trip():
    columns = [np.array([0, 5, 1 << 60, -3]), np.arange(4)]
    assert (collocations.unpacked(collocations.packed(*columns), 2) == np.stack(columns)).all()
