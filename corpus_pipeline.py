"""A training corpus from ``documents``: quality classifier, near-duplicate join, suffix-array dedup, source mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows it gets; all but the last return the columns of documents.  Columns that
no stage knows stay as they are, whatever their names.  An empty table gives an empty one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm import common, jaccard, mixing, packing, quality, substrings, suffixes


def _carried(docs: DataFrame, *apart: str) -> Column:
    """The columns of ``docs`` but for ``apart`` as one column ``carried``, beyond the reach of the names that operators use."""
    return F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in apart]).alias("carried")


def _restored(docs: DataFrame, **apart: Column) -> list[Column]:
    """The columns of ``docs`` out of ``carried``, those set ``apart`` from their expressions."""
    return [(apart[c] if c in apart else F.col(f"carried.c{i}")).alias(c) for i, c in enumerate(docs.columns)]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good; it learns from the labelled ones that are not held out.  A null text is
    judged as an empty one, a row without doc_id like any other."""
    rows = docs.select("doc_id", "text", _carried(docs, "doc_id", "text"))
    judged = quality.classify(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.where("predicted = 1").select(*_restored(docs, doc_id=F.col("doc_id"), text=F.col("text")))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each class of near copies; one row of rows that are equal.

    Documents without words and rows without doc_id stay, unless they repeat a row."""
    classes = jaccard.near_components(substrings.keyed(docs))
    linked = F.col("root").isNotNull() & F.col("component_id").isNotNull()
    # a component_id is no class: rows of one doc_id with different texts may be in several
    kept = classes.where(linked & (F.col("doc_id") == F.col("component_id"))).groupBy("root").agg(F.min("key").alias("key"))
    keys = kept.select("key").unionByName(classes.where(~linked).select("key")).distinct()
    rows = docs.select(common.row_key("doc_id", "text").alias("key"), _carried(docs))
    return rows.join(keys, "key").dropDuplicates(["key"]).select(*_restored(docs))


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the strings of 200 bytes or more that also stand elsewhere; a null text becomes an empty one."""
    rows = docs.select("doc_id", "text", _carried(docs, "doc_id", "text", "n_chars"))
    done = suffixes.remove_repeats(rows, keep=("doc_id", "carried"), as_text=True)
    return done.select(*_restored(docs, doc_id=F.col("doc_id"), text=F.col("kept"), n_chars=F.char_length("kept").cast("long")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; null sources are one source, null texts have no words."""
    mixed = mixing.mix(docs.select("doc_id", "source", common.count_words(F.col("text")).alias("size"), _carried(docs)))
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.where("copies > 0").select("carried", times).select(*_restored(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("jaccard_join", keep_one_of_near_copies),
    ("suffix_array_dedup", cut_repeated_strings),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: The classifier, the tokenizer and byte-level cuts are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
