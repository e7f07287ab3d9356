"""One registered query for each operator of this subpackage, with its oracle SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, fingerprints, jaccard, lm, mixing, packing, planes, quality, secrets, substrings, suffixes, topk, trie
from .common import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = substrings.keyed(table(spark, sf_dir, "documents"))
    return jaccard.near_components(docs).select("doc_id", "n_shingles", "component_id")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op9_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled good; background: all documents."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op10_plane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return planes.read_planes(planes.write_planes(docs, shared_dir(spark)), docs.schema["doc_id"].dataType.simpleString())


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations")).drop("n_ends")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_substring_dedup, op2_source_mixing, op3_best_fit_packing, op4_suffix_array_dedup, op5_order_minhash, op6_pivot_top_k,
        op7_jaccard_join, op8_quality_classifier, op9_cross_entropy_difference, op10_plane_files,
        op11_secret_scan, op12_collocations, op13_conversation_trie)}

ORACLES: dict[str, str] = {
    "op2_source_mixing": mixing.SQL, "op6_pivot_top_k": topk.SQL, "op12_collocations": collocations.SQL, "op13_conversation_trie": trie.SQL}
