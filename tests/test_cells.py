"""Long cells and the streaming writer."""

from pyspark.sql import functions as F
from rosterline.operators import master as M
from rosterline.sources import sinks


def test_one_key_of_many_spellings(spark):
    """100,000 spellings of one key among small keys: long rows, and one cell at the sink."""
    n = 100_000
    spelling = F.expr(f"CASE WHEN id < {n} THEN 'Acme Trading ' || lpad(bin(id), 17, '0') ELSE 'Solo ' || id END")
    long = spark.range(n + 50).select(F.when(F.col("id") < n, "acme").otherwise(F.col("id").cast("string")).alias("match_key"), spelling.alias("name"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    try:
        got = {r["match_key"]: r["name"] for r in sinks.fold_cells(long, ["match_key"], ["name"], ["name"], "|").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 51
    assert got["acme"] == "|".join(f"Acme Trading {i:017b}" for i in range(n))
    assert got[str(n)] == f"Solo {n}"


def test_fold_cells_nulls_empties_and_order(spark):
    rows = spark.createDataFrame(
        [("a", 1, 2, "y", None), ("a", 1, 1, "x", ""), ("a", 2, 1, "", "q"), (None, 1, 1, "n", "m"), ("", 1, 1, "e", "m"), (None, 1, 0, "o", "l"), ("z", 9, 1, None, None)],
        "k string, start int, i int, one string, two string")
    got = {(r["k"], r["start"]): (r["one"], r["two"]) for r in sinks.fold_cells(rows, ["k", "start"], ["i"], ["one", "two"], "\n").collect()}
    assert got == {("a", 1): ("x\ny", ""), ("a", 2): ("", "q"), (None, 1): ("o\nn", "l\nm"), ("", 1): ("e", "m"), ("z", 9): ("", "")}
    assert sinks.fold_cells(rows.limit(0), ["k"], ["i"], ["one"], "|").count() == 0


def test_write_cells(spark, tmp_path):
    rows = spark.createDataFrame([("a", 'q"1'), ("a", "b"), ("c", "d")], "k string, v string")
    sinks.write_cells(rows, ["k"], ["v"], ["v"], ";", str(tmp_path / "cells"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "cells"))
    assert {(r["k"], r["v"]) for r in back.collect()} == {("a", 'b;q"1'), ("c", "d")}


def test_legacy_spellings_are_the_cells(spark):
    rows = spark.createDataFrame(
        [("Acme Ltd", "[OFAC]SDN", 1, 5, False, 1), ("ACME  LTD", "[OFAC]SDN", 2, 5, False, 2), ("Other (Alias One)", "", 3, 5, True, 3), ("Acme Ltd", "", 4, 5, False, 4)],
        "raw string, remark string, first_ms bigint, last_ms bigint, was_invalid boolean, ord bigint")
    cells = {r["match_key"]: r["variants"] for r in M.cluster_legacy(rows, 9).collect()}
    long = {}
    for r in M.legacy_spellings(rows).collect():
        long.setdefault(r["match_key"], []).append(r["name"])
    assert {k: sorted(v) for k, v in long.items()} == cells
