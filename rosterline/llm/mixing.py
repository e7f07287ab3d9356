"""Mixing sources to target weights by systematic sampling (operator 2).  DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = "mix-1"
#: Parts that a (source, size class) is dealt into by a hash of doc_id; bounds one window group.
PARTS = 32
#: Expected copies are whole billionths, so every sum is exact and reruns agree.
UNIT = 1_000_000_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target.  ``sizes`` has a row for each source: source, source_size.

    Sources in code-point order, null last, take the weights in turn and share the sum of all sizes; a target stops at ``most``
    times its source's size and the excess is shared again by weight.  That fixed point is found in one pass: ordered by
    (cap / weight), the sources before the first one whose fair share stays below its cap are the capped ones."""
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighted = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    weighted = weighted.withColumn("cap", F.col("source_size") * most)
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")), "rank")
    total = F.sum("source_size").over(Window.partitionBy())
    capped_before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    shared = weighted.select("source", "source_size", "weight", "cap", F.row_number().over(by_cap).alias("place"),
                             ((total - capped_before).cast("double") / weight_left).alias("share"))
    fits = F.when(F.col("share") * F.col("weight") <= F.col("cap"), F.struct("place", "share"))
    return (shared.withColumn("cut", F.min(fits).over(Window.partitionBy()))
            .select("source", "source_size",
                    F.when(F.col("place") < F.col("cut.place"), F.col("cap").cast("double"))
                    .otherwise(F.least(F.col("cap").cast("double"), F.col("cut.share") * F.col("weight"))).alias("target")))


def _size_class(size: Column) -> Column:
    """Class of sizes within about an eighth of each other: bit length and the three bits after the first."""
    bits = F.bin(size)
    return F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(bits, 2, 3))


def mix(items: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES,
        parts: int = PARTS) -> DataFrame:
    """``items`` (doc_id, source, size and any other columns) with source_size, target and copies: how often the mix takes each.

    Within a source, documents stand in the order of size class, part and doc_id; a document's expected copies are target /
    source_size; it is taken once for each whole number that the running sum of expected copies, plus one random offset of
    the source, passes there.  So copies are the expected copies rounded down or up and the words of each size class come
    out right.  The running sum is taken in two steps (over blocks, then inside a block), so a hot source spreads over many
    tasks.

    Null sources are one source.  A null size is 0, and comes out as 0.  A source without words has target 0 and no copies.  Rows with one doc_id count each;
    equal rows are interchangeable.  Columns of the results' names give way.  A null doc_id falls into part 0, first.  An empty table gives an empty table."""
    items = items.drop("source_size", "target", "copies").withColumn("size", F.coalesce("size", F.lit(0)))
    keys = ["_source", "_class", "_part"]
    digest = F.coalesce(F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 2), 16, 10).cast("int"), F.lit(0))
    dealt = (items.withColumn("_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
             .withColumn("_class", _size_class(F.col("size"))).withColumn("_part", digest % parts))
    blocks = dealt.groupBy("source", *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    sizes = blocks.groupBy("source", "_source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes.drop("_source"), weights, most).withColumn(
        "_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source")
    expected = F.when(F.col("source_size") > 0, F.least(F.lit(most * UNIT).cast("double"),
                                                         F.floor(F.col("target") / F.col("source_size") * UNIT).cast("double")))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), "_source")), 1, 7), 16, 10).cast("long") % UNIT
    rates = targets.withColumn("_each", F.coalesce(expected, F.lit(0.0)).cast("decimal(12,0)")).withColumn("_shift", offset)
    before = F.sum(F.col("n") * F.col("_each")).over(
        Window.partitionBy("_source").orderBy("_class", "_part").rowsBetween(Window.unboundedPreceding, -1))
    placed = blocks.join(rates, "_source").select(
        *keys, "source_size", "target", "_each",
        (F.coalesce(before, F.lit(0)) + F.col("_shift")).cast("decimal(38,0)").alias("_before"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id", "size"))
    running = dealt.join(placed, keys).withColumn("_place", place)
    upto = F.col("_before") + F.col("_place") * F.col("_each")
    passed = F.expr(f"CAST((_upto DIV {UNIT}) - ((_upto - _each) DIV {UNIT}) AS LONG)")
    return (running.withColumn("_upto", upto.cast("decimal(38,0)")).withColumn("copies", passed)
            .drop(*keys, "_each", "_before", "_place", "_upto"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """Every document's share in the mix: doc_id, size, source_size, target, taken, copies.  Size: words of the whole text."""
    sized = docs.select("doc_id", "source", common.count_words(F.col("text")).alias("size"))
    return mix(sized, **options).select("doc_id", "size", "source_size", "target",
                                        (F.col("size") * F.col("copies")).alias("taken"), "copies")


SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
dealt AS (
  SELECT *, lpad(CAST(length(bin(size)) AS VARCHAR), 2, '0') || substr(bin(size), 2, 3) AS cls,
         coalesce(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 2) AS INT), 0) % {PARTS} AS part
  FROM sized),
ranked AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM dealt GROUP BY source),
weighted AS (SELECT *, 1 + rank % 3 AS weight, source_size * {MOST_COPIES} AS cap FROM ranked),
shared AS (
  SELECT *, row_number() OVER by_cap AS place,
         CAST((SELECT sum(source_size) FROM ranked)
              - coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS share
  FROM weighted WINDOW by_cap AS (ORDER BY CAST(cap AS DOUBLE) / weight, rank)),
cut AS (SELECT place, share FROM shared WHERE share * weight <= cap ORDER BY place LIMIT 1),
targets AS (
  SELECT s.source, s.source_size, CASE WHEN s.place < c.place THEN CAST(s.cap AS DOUBLE)
         ELSE least(CAST(s.cap AS DOUBLE), c.share * s.weight) END AS target
  FROM shared s, cut c),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(least({MOST_COPIES * UNIT}, floor(target / source_size * {UNIT})) AS HUGEINT) ELSE 0 END AS each_,
         CAST('0x' || substr(md5('{SEED}:' || coalesce('s' || source, 'n')), 1, 7) AS BIGINT) % {UNIT} AS shift
  FROM targets),
placed AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.each_,
         r.shift + r.each_ * row_number() OVER (PARTITION BY d.source ORDER BY d.cls, d.part, d.doc_id NULLS FIRST, d.size) AS upto
  FROM dealt d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (upto // {UNIT} - (upto - each_) // {UNIT}) AS BIGINT) AS taken,
       CAST(upto // {UNIT} - (upto - each_) // {UNIT} AS BIGINT) AS copies
FROM placed
"""
