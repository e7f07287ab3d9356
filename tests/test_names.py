"""Spelling cases, the non-ASCII ones included, that the SQL oracles cannot express."""

import pytest
from pyspark.sql import functions as F

from rosterline.functions import names as N
from rosterline.functions import remarks as R
from rosterline.operators import naming


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw,key", [
    ("HANIYAH, Ismail Abdul Salah", "ismailabdulsalahhaniyah"),
    ("7 MAKARA PHARY CO., LTD.", "7makarapharyco.,ltd."),
    ("ＡＢＣ　Trading", "abctrading"),
    ("ｱﾙｶｲﾀﾞ", "アルカイダ"),
    ("“Straße”", "strasse"),
    ("'Abd al-Malik", "abdal-malik"),
    ("O’BRIEN – X", "o'brien-x"),
    ("A​B﻿C", "abc"),
    ("", ""),
])
def test_identity_key(spark, raw, key):
    df = spark.createDataFrame([(raw,)], "name string")
    assert N.with_identity_key(df, "name").first()["match_key"] == key


@pytest.mark.parametrize("raw,shown", [
    ("「株式会社SRIEMI」", "株式会社SRIEMI"), ('"“X Y”"', "X Y"), ("'Abd al-Malik", "'Abd al-Malik"), ('""', '""'), ("　A \r\n B\t", "A B"),
])
def test_display_name(spark, raw, shown):
    assert one(spark, raw, N.canonical_display_name) == shown


@pytest.mark.parametrize("raw,parts", [
    ("（別名1）A、B、C", ["A", "B", "C"]),
    ("（別称、IAP RAS）IAP RAS", ["IAP RAS"]),
    ("X (a.k.a. Y; a.k.a. Z)", ["X", "Y", "Z"]),
    ("Chelyabinsk-70， a.k.a. Y", ["Chelyabinsk-70", "Y"]),
    ("MS ANGIA (a.k.a. GATHER VIEW) (T7AX8) Crude Oil Tanker San Marino flag", ["MS ANGIA", "GATHER VIEW"]),
    ("“ズベイル、アブ”", ["“ズベイル、アブ”"]),
    ("Abdifatah Abubakar Abdi", ["Abdifatah Abubakar Abdi"]),
    ("（Whole Name）", ["Whole Name"]),
    ("  ", []),
])
def test_alias_cells(spark, raw, parts):
    assert one(spark, raw, N.split_aliases) == parts
    df = spark.createDataFrame([(raw,)], "raw string")
    assert N.with_aliases(df, "raw").first()["aliases"] == parts


@pytest.mark.parametrize("raw,parts", [("A; B；C", ["A", "B", "C"]), ("A (x; y); B", ["A (x; y)", "B"]), ("A) ; B", ["A)", "B"]), ("", [])])
def test_split_top_level(spark, raw, parts):
    assert one(spark, raw, N.split_top_level) == parts


def test_strip_descriptor(spark):
    assert one(spark, "サイフ・アル・アドル（生年月日1963/4/11、出生地エジプト、国籍エジプト）", N.strip_descriptor) == "サイフ・アル・アドル"
    assert one(spark, "Name (Trading)", N.strip_descriptor) == "Name (Trading)"


@pytest.mark.parametrize("raw,invalid,review", [
    ("45123", "Excel", None), ("1234567", "数字のみ", None), ("***", "記号のみ", None), ("李", None, "1文字"), ("张伟", None, None),
    ("AB", None, "2文字"), ("X a.k.a. Y", None, "別名マーカー"), ("X" * 121, None, "121文字"), ("ABC不明", "不明", None), ("Normal Name", None, None),
])
def test_triage(spark, raw, invalid, review):
    got = one(spark, raw, N.invalid_reason)
    assert (got is None) == (invalid is None) and (invalid or "") in (got or "")
    if invalid is None:
        got = one(spark, raw, N.review_reason)
        assert (got is None) == (review is None) and (review or "") in (got or "")


@pytest.mark.parametrize("text,pairs", [
    ("制裁リスト（財務省：タリバーン関係者等／OFAC：SDN）", [("財務省", "タリバーン関係者等"), ("OFAC", "SDN")]),
    ("30.ロシア連邦(特定銀行）", [("財務省", "ロシア連邦(特定銀行)")]), ("財務諸表　タリバーン関係者", [("財務省", "タリバーン関係者等")]),
    ("外為法 2022", [("legacy", "外為法 2022")]), ("", [("legacy", "")]), ("UK FCDO", [("UK FCDO", "")]),
])
def test_remarks(spark, text, pairs):
    assert [tuple(p) for p in one(spark, text, R.parse_remark_multi)] == pairs


def test_original_scripts_need_label_end_and_native_script(spark):
    rows = [(1, "x (original script: Иван) y"), (2, "original script: Иван"), (3, "(original script: Latin)"), (4, "originalscript: （original script: 李小 ）")]
    got = naming.extract_original_scripts(spark.createDataFrame(rows, "id int, notice string"), "id", "notice").collect()
    assert sorted((r["id"], r["name"]) for r in got) == [(1, "Иван"), (4, "李小")]
