"""Registered training-data queries against their oracle SQL, and the pipeline stage by stage against brute force."""

from __future__ import annotations

from collections import Counter

import check
import llm_fixtures as fixtures
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rosterline.llm import common, jaccard, mixing, packing, queries, suffixes

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    ok, message, _ = check.compare(spark, SF, name, queries.QUERIES[name], queries.ORACLES[name], check.duck(SF))
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_reads_every_document(spark, name):
    got = queries.QUERIES[name](spark, SF)
    assert got.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "jaccard_join", "suffix_array_dedup", "source_mixing", "best_fit_packing"]
    good = common.materialise(stages["quality_classifier"](spark, docs, SF))
    judged = queries.op8_quality_classifier(spark, SF)
    assert good.columns == columns
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in judged.where("predicted = 1").collect()}
    one = common.materialise(stages["jaccard_join"](spark, good, SF))
    classes = jaccard.brute_force([(r.doc_id, r.text) for r in good.collect()])
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for _, _, c in classes})
    cut = common.materialise(stages["suffix_array_dedup"](spark, one, SF))
    want = {d: n - gone for d, n, gone, _, _ in suffixes.brute_force([(r.doc_id, r.text) for r in one.collect()])}
    assert cut.columns == columns
    for r in cut.collect():  # a cut may break a character at each end of a span
        assert want[r.doc_id] - 12 <= len(r.text.encode()) <= want[r.doc_id] and r.n_chars == len(r.text)
    mixed = common.materialise(stages["source_mixing"](spark, cut, SF))
    copies = {r.doc_id: r.copies for r in mixing.mix_documents(cut).collect()}
    assert mixed.columns == columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({d: n for d, n in copies.items() if n})
    packed = stages["best_fit_packing"](spark, mixed, SF)
    assert packed.agg(F.sum("length")).first()[0] == packing.pieces(mixed).agg(F.sum("length")).first()[0]


def test_pipeline_on_awkward_rows(spark):
    docs = fixtures.frame(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = common.materialise(stage(spark, rows, SF))
        assert rows.columns[:2] == ["doc_id", "piece"]


def test_pipeline_leaves_clashing_columns_alone(spark):
    docs = fixtures.frame(spark).select("doc_id", "text", "lang", "source", "n_chars")
    names = ["key", "size", "copy", "copies", "target", "root", "start", "kept", "carried", "predicted", "odd name"]
    own = F.concat(F.col("doc_id").cast("string"), F.lit("|"), F.coalesce("text", F.lit("")))
    rows = docs.select("*", *[F.concat(F.lit(c + "|"), F.sha2(own, 256)).alias(c) for c in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, rows = common.materialise(stage(spark, rows.select(*docs.columns), SF)), common.materialise(stage(spark, rows, SF))
        assert rows.columns == [*docs.columns, *names], name
        assert Counter(map(tuple, rows.select(*docs.columns).collect())) == Counter(map(tuple, plain.collect())), name
        for r in rows.collect():
            assert len({r[c].split("|")[1] for c in names}) == 1 and all(r[c].startswith(c + "|") for c in names), name


def test_near_copies_leave_one_row(spark):
    docs = fixtures.frame(spark).select("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, SF).collect()
    classes = jaccard.brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id for r in kept} == {c for _, _, c in classes}
    assert max(Counter((r.doc_id, r.text) for r in kept).values()) == 1


def test_near_copies_keep_every_class_of_a_shared_id(spark):
    one, two = " ".join(fixtures.words(60, 1)), " ".join(fixtures.words(60, 2))
    rows = [(3, one), (3, two), (4, one + " more"), (5, two + " more"), (6, None), (6, ""), (3, None), (None, one + " again"), (3, one)]
    docs = fixtures.frame(spark, [(d, t, "en", None, None, None, None, None, None) for d, t in rows]).select(
        "doc_id", "text", "lang", "source", "n_chars")
    kept = Counter((r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_near_copies(spark, docs, SF).collect())
    # the row without doc_id is in the class of ``one``, whose smallest doc_id is 3
    assert kept == Counter([(3, one), (3, two), (6, None), (6, ""), (3, None)])


def test_nothing_else_imports_the_subpackage():
    import pathlib

    root = pathlib.Path(corpus_pipeline.__file__).parent / "rosterline"
    for path in root.rglob("*.py"):
        assert path.parent.name == "llm" or "llm" not in path.read_text(), path
