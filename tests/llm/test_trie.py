"""The conversation trie against its definition."""

from __future__ import annotations

import random

import pytest

from rosterline.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n_convs int"


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def nodes(spark, rows: list[tuple], **options) -> list[tuple]:
    return sorted(map(tuple, trie.conversation_trie(frame(spark, rows).repartition(4), **options).drop("n_ends").collect()), key=str)


def wanted(rows: list[tuple]) -> list[tuple]:
    return sorted(trie.brute_force(rows), key=str)


def random_rows(seed: int, convs: int = 250, texts: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    ids = rng.sample(range(0, 900), convs) + [-5, -100, 10**15 + 7]
    rows = []
    for c in ids:
        for i in range(rng.choice([1, 2, 3, 5, 9, 30])):
            rows.append((c, rng.choice([i, i, i, None, 3]), rng.choice(["user", "assistant", None]), rng.choice(["é", "ab", "", None, "漢字" * 5][:texts + 1])))
    rows += [(None, 1, "user", "x"), (None, None, None, None), rows[0], rows[0]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "options"), [
    (1, {}), (2, {"shard": 50, "band": 3, "queue": 4}), (3, {"shard": 1, "band": 2, "queue": 1}), (4, {"shard": 200, "band": 1, "queue": 2}), (5, {"shard": 0, "band": 4})])
def test_by_definition(spark, seed, options):
    rows = random_rows(seed)
    assert nodes(spark, rows, **options) == wanted(rows)


def test_long_conversations_and_one_path(spark):
    long = [(5, i, "user", f"t{i % 3}") for i in range(2500)] + [(6, i, "user", f"t{i % 3}") for i in range(2400)] + [(200, i, "user", "t0") for i in range(3)]
    for options in ({}, {"shard": 100, "band": 64, "queue": 10}):
        assert nodes(spark, long, **options) == wanted(long)


def test_many_equal_conversations(spark):
    rows = [(c, i, "user", "same") for c in range(3000) for i in range(2)]
    assert nodes(spark, rows, shard=500) == wanted(rows)


def test_turnless_conversations_belong_to_the_root(spark):
    rows = [(c, 1, "user", "only") for c in range(101, 140)]  # no conversation 100
    got = nodes(spark, rows)
    assert got == wanted(rows)
    assert [r[3] for r in got if r[1] == 0] == [39]


def test_empty_table(spark):
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 1, "user", "x")]) == []


def test_queue_spills_and_merges():
    rng = random.Random(1)
    entries = [tuple(rng.randrange(-9, 9) for _ in range(5)) for _ in range(5000)]
    queue, out = trie.SpillingQueue(most=7), []
    for i, e in enumerate(entries):
        queue.push(e)
        if i % 3 == 2:
            assert queue.first() == min(set_left(entries[:i + 1], out)) if i < 300 else True
            out.append(queue.pop())
    while queue.first() is not None:
        out.append(queue.pop())
    assert sorted(out) == sorted(entries)


def set_left(entries, out):
    left = list(entries)
    for e in out:
        left.remove(e)
    return left
