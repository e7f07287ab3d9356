"""Name jobs over whole tables: standardise, triage, explode, bridge remarks, extract original scripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import constants as K
from ..functions import names as N
from ..functions import remarks as R
from ..functions.rows import explode_once

# The label and the field heads that end an original-script value.
SCRIPT_LABEL = r"original\s*(?:script|scipt)\s*[：:][\s\u3000]*"
FIELD_HEADS = [
    "(a.k.a", "（a.k.a", "(f.k.a", "（f.k.a", "(n.k.a", "（n.k.a",
    "称号：", "称号:", "役職：", "役職:", "生年月日：", "生年月日:", "出生地：", "出生地:",
    "国籍：", "国籍:", "旅券番号：", "旅券番号:", "ＩＤ番号：", "ＩＤ番号:", "所在地：", "所在地:",
    "国連制裁委員会",
]
# Arabic, Cyrillic, CJK and kana, Hangul, Hebrew, Devanagari, Greek
NATIVE_SCRIPT = (
    r"[؀-ۿݐ-ݿࢠ-ࣿﭐ-﷿ﹰ-﻿"
    r"Ѐ-ԯⷠ-ⷿꙀ-ꚟ"
    r"぀-ヿ㐀-䶿一-鿿豈-﫿"
    r"가-힯ᄀ-ᇿ֐-׿ऀ-ॿͰ-Ͽ]"
)


def standardise_names(names: DataFrame, raw: str = "raw", order: str = "ord") -> DataFrame:
    """Identity key, relaxed key and spelling counts per key.

    Equal spellings are counted map-side first, so key folding (and the Python step for non-ASCII
    names) runs once per distinct spelling and a hot name costs one partial row per task.
    """
    spellings = names.groupBy(F.col(raw).alias("raw")).agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("ord"))
    spellings = spellings.withColumn("display", N.canonical_display_name(F.col("raw")))
    keyed = N.with_identity_key(spellings, "display")
    return (
        keyed.filter(F.col("match_key") != "")
        .groupBy("match_key")
        .agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_spellings"),
             F.min_by("display", "ord").alias("first_display"))
        .withColumn("relaxed_key", N.relaxed_key(F.col("match_key")))
    )


def triage_names(names: DataFrame, raw: str = "raw") -> DataFrame:
    """Totals per verdict: INVALID (reason), REVIEW (reason) or OK."""
    spellings = names.groupBy(F.col(raw).alias("raw")).agg(F.count(F.lit(1)).alias("n"))
    shown = spellings.select("n", N.canonical_display_name(F.col("raw")).alias("name"))
    flagged = shown.select(
        "n", N.invalid_reason(F.col("name")).alias("invalid"), N.review_reason(F.col("name")).alias("review"))
    verdict = F.when(F.col("invalid").isNotNull(), "INVALID").when(F.col("review").isNotNull(), "REVIEW").otherwise("OK")
    reason = F.regexp_replace(F.coalesce("invalid", "review", F.lit("")), "（.*）$", "")
    return (
        flagged.groupBy(verdict.alias("verdict"), reason.alias("reason"))
        .agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_spellings"))
    )


def explode_aliases(records: DataFrame, record_id: str = "ord", raw: str = "raw") -> DataFrame:
    """One row per alias of a cell, first spelling kept per (record, identity key), with the fan-out."""
    cells = N.with_aliases(records.select(record_id, raw), raw)
    pieces = explode_once(cells, [record_id], F.col("aliases"), "piece", "pos")
    pieces = pieces.withColumn("alias", N.canonical_display_name(F.col("piece"))).drop("piece")
    keyed = N.with_identity_key(pieces, "alias").filter("match_key <> ''")
    # one shuffle on the record serves the de-duplication and the fan-out count
    keyed = keyed.repartition(F.col(record_id))
    unique = keyed.groupBy(record_id, "match_key").agg(
        F.min_by("alias", "pos").alias("alias"), F.min("pos").alias("pos"))
    return unique.withColumn("fan_out", F.count(F.lit(1)).over(W.partitionBy(record_id)))


def bridge_remarks(rows: DataFrame, remark: str = "remark") -> DataFrame:
    """(source, category) pairs behind remark texts with the rows and texts of each pair."""
    texts = rows.groupBy(F.col(remark).alias("remark")).agg(F.count(F.lit(1)).alias("n"))
    pairs = explode_once(texts, ["n"], R.parse_remark_multi(F.col("remark")), "p")
    return pairs.groupBy(F.col("p.source").alias("source"), F.col("p.category").alias("category")).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_remarks"))


def original_script_values(notice) -> object:
    """Labelled values with an explicit end; overlapping labels are seen by the look-ahead."""
    heads = "|".join("".join("\\" + ch if ch in "()." else ch for ch in h) for h in FIELD_HEADS)
    pattern = rf"(?is){SCRIPT_LABEL}(?=(.*?)(?:[)）]|{heads}))"
    found = F.regexp_extract_all(N.clean_name(notice), F.lit(pattern), F.lit(1))

    def tidy(v):
        v = F.btrim(N.clean_name(v), F.lit(" \t\r\n;；,，、:："))
        v = N.strip(F.ltrim(v, F.lit("(（")))
        return N.strip(F.rtrim(v, F.lit(")）")))

    n = F.char_length
    return F.filter(F.transform(found, tidy), lambda v: ~v.rlike("(?i)^" + SCRIPT_LABEL)
                    & (n(v) > 0) & v.rlike(NATIVE_SCRIPT) & ~v.isin(K.NULLISH))


def extract_original_scripts(records: DataFrame, record_id: str, notice: str) -> DataFrame:
    """Original-script names of notice texts, one row per (record, identity key)."""
    hit = records.filter(F.col(notice).rlike("(?i)original"))
    found = explode_once(hit, [record_id], original_script_values(F.col(notice)), "name", "pos")
    keyed = N.with_identity_key(found, "name").filter("match_key <> ''")
    return keyed.groupBy(record_id, "match_key").agg(
        F.min_by("name", "pos").alias("name"), F.min("pos").alias("pos"))
