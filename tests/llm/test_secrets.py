"""Secret scans: the base rules against their definition, and the models on held-out strings."""

from __future__ import annotations

import base64
import hashlib
import random

import llm_fixtures as fixtures
import pyarrow as pa
import pytest

from rosterline.llm import secrets

ODD = [
    'token = "abcdef1"', "token=abcde", "PassWord: 'x9/+_.=-'", "passwd  :  hunter22", "api_key==deadbeef", "APIKEY:tooth.pick", "secret = é123456",
    "token: ſecret", "Key apiKey = 123456789", "AKIA" + "Z" * 15, "AKIA" + "Z9" * 8, "xAKIAAKIA" + "B" * 20, "0" * 24, "f" * 23, "A" + "a" * 24 + "g",
    "é" * 30 + " token = " + "0123456789abcdef" * 2, "token = " * 4 + "abcdef", "secret\n= abcdefgh", "password=" + "a" * 50_000, 'token"=\'abcdefg\'',
    "secret:token:password:abcdef0", "tok\0en = abcdefg", "api-key: abcdefg", "漢字AKIA" + "Q" * 16 + "漢字" + "0" * 30,
]


def rows_of_digest(digest) -> list[tuple]:
    return sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in digest.collect()), key=str)


def rows_of(found) -> list[tuple]:
    return rows_of_digest(secrets.digest(found))


def wanted(docs: list[tuple]) -> list[tuple]:
    return sorted(((*row, hashlib.sha256(spans.encode()).hexdigest()) for *row, spans in secrets.brute_force(docs)), key=str)


def test_base_rules_by_definition(spark):
    texts = [*ODD, None, "", *(" ".join(ODD[i:i + 3]) for i in range(len(ODD)))]
    rows = [(i, t, "en", None, None, "k", "s", "x", i) for i, t in enumerate(texts)] + [fixtures.awkward()[0], (None, ODD[0], *[None] * 7), (3, ODD[3], *[None] * 7)]
    docs = fixtures.frame(spark, rows)
    assert rows_of(secrets.find_secrets(docs)) == wanted([r[:2] for r in rows])


def test_base_rules_on_random_texts(spark):
    rng = random.Random(5)
    parts = ["token", "Secret", "api_key", "passwd", "=", ":", " ", '"', "'", "AKIA", "ABC0", "abc0", "0123456789ab", "é", ".", "\n", "-"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(60))) for i in range(400)]
    got = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got) == wanted(rows)


def test_awkward_rows_and_empty_table(spark):
    docs = fixtures.frame(spark)
    assert rows_of(secrets.find_secrets(docs)) == wanted([(r.doc_id, r.text) for r in docs.collect()])
    assert secrets.digest(secrets.find_secrets(fixtures.frame(spark, []))).count() == 0


def samples(spark, seed: int):
    rng = random.Random(seed)
    word = lambda: rng.choice(["read", "write", "index", "count", "total", "record", "stream", "batch", "value", "table", "group", "merge"])
    plain = ["_".join(word() for _ in range(rng.randrange(3, 6))) for _ in range(400)]
    raw = [rng.randbytes(24) for _ in range(400)]
    strange = [base64.b64encode(r).decode() if i % 2 else r.hex() for i, r in enumerate(raw)]
    return spark.createDataFrame([(p, False) for p in plain] + [(s, True) for s in strange] + [(None, True), ("", False), ("x", None)], "value string, random boolean")


def test_models_part_held_out_strings(spark):
    model = secrets.train(samples(spark, 1))
    held = [r for r in samples(spark, 2).collect() if r.random is not None and r.value]
    ratio = secrets.ratios(pa.array([r.value for r in held]), model)
    right = [(x > secrets.THRESHOLD) == r.random for x, r in zip(ratio, held)]
    assert sum(right) / len(right) > 0.99


def test_random_runs_are_spans(spark):
    secret = base64.b64encode(hashlib.sha256(b"1").digest()).decode().rstrip("=")
    text = f"é the key {secret}, and read_write_index_count"
    found = secrets.find_secrets(spark.createDataFrame([(1, text), (2, "read_write_index_count"), (3, "token = " + secret)], "doc_id long, text string"), samples(spark, 1))
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in found.collect()}
    assert spans == {1: [("random", 10, 10 + len(secret))], 2: [], 3: [("assign", 0, 8 + len(secret))]}


def test_no_samples_find_nothing_more(spark):
    none = samples(spark, 1).limit(0)
    found = secrets.find_secrets(spark.createDataFrame([(1, "x" * 40)], "doc_id long, text string"), none)
    assert found.first().spans == []


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_by_definition(spark, sf):
    from rosterline.llm import queries

    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op11_secret_scan(spark, f"/root/testdata/{sf}")
    assert rows_of_digest(got) == wanted([tuple(r) for r in docs])
