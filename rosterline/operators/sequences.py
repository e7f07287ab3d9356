"""Ordered look-back that does not put a whole partition into one task.

A window over (partition, order) sends every row of a hot partition to one task.  ``look_back`` cuts each
partition into buckets that follow the order, looks back inside a bucket, and hands the last value of
the earlier buckets over through a table with one row per bucket.  Buckets that hold too many rows are split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


#: Rows of a bucket beyond which it is split.
FULL = 100_000


def bucketed(df: DataFrame, part: list[str], bucket: Column, finer: Column, full: int = FULL) -> DataFrame:
    """``df`` with __bucket and __fine: buckets that the data fill with more than ``full`` rows are split by ``finer``, the others
    are whole (__fine is NULL).  Buckets are counted by key first, so the bounds follow the data."""
    df = df.withColumn("__bucket", bucket)
    key = [*part, "__bucket"]
    crowded = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > full).drop("__n").withColumn("__full", F.lit(True))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key]
    met = df.withColumn("__finer", finer).alias("l").join(crowded.alias("r"), same, "left").select("l.*", "r.__full")
    return met.withColumn("__fine", F.when(F.col("__full"), F.col("__finer"))).drop("__finer", "__full")


def look_back(df: DataFrame, part: list[str], bucket: Column, order: list[str], value: Column, out: str, *, inclusive: bool,
              finer: Column | None = None, full: int = FULL) -> DataFrame:
    """Add ``out``: the latest non-NULL ``value`` at or before (``inclusive``) or before the row."""
    return look_backs(df, part, bucket, order, {out: (value, inclusive)}, finer=finer, full=full)


def look_backs(df: DataFrame, part: list[str], bucket: Column, order: list[str], values: dict[str, tuple[Column, bool]], *,
               finer: Column | None = None, full: int = FULL) -> DataFrame:
    """Add one column per entry of ``values`` (name: value, inclusive): the latest non-NULL value of each, independent of the others,
    all in one pass.

    ``bucket`` must not decrease along ``order``, nor ``finer`` inside a bucket; rows of one bucket, or of one value of ``finer`` in a
    bucket that is too full, should fit a task.  "Last value" is associative, so it is scanned three times over ever fewer rows: inside
    a bucket's part, over the tails of the parts of a bucket, and over the tails of the buckets.
    """
    at = range(len(values))
    cols = lambda kind: [f"__{kind}{j}" for j in at]
    df = df.withColumns({f"__value{j}": value for j, (value, _) in enumerate(values.values())})
    df = df.withColumn("__bucket", bucket) if finer is None else bucketed(df, part, bucket, finer, full)
    whole = [*part, "__bucket"]
    key = whole if finer is None else [*whole, "__fine"]
    inside_part = W.partitionBy(*key).orderBy(*order)
    local = [F.last(f"__value{j}", ignorenulls=True).over(inside_part.rowsBetween(W.unboundedPreceding, W.currentRow if inclusive else -1)).alias(f"__local{j}")
             for j, (_, inclusive) in enumerate(values.values())]
    latest = lambda c, place, name: F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(name)
    before = lambda over, name: [
        F.last(f"__tail{j}", ignorenulls=True).over(over.rowsBetween(W.unboundedPreceding, -1)).alias(f"__{name}{j}") for j in at]
    # partition keys may be NULL: such rows are a partition of their own
    same = lambda names: [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in names]
    tails = df.groupBy(*key).agg(*[latest(f"__value{j}", F.struct(*order), f"__tail{j}") for j in at])
    across = W.partitionBy(*part).orderBy("__bucket")
    if finer is None:
        carry = tails.select(*key, *before(across, "carry"))
    else:
        per_bucket = tails.groupBy(*whole).agg(*[latest(f"__tail{j}", F.struct("__fine"), f"__tail{j}") for j in at])
        earlier = per_bucket.select(*whole, *before(across, "earlier"))
        inside = tails.select(*key, *before(W.partitionBy(*whole).orderBy("__fine"), "inside"))
        met = inside.alias("l").join(earlier.alias("r"), same(whole)).select("l.*", *[f"r.{c}" for c in cols("earlier")])
        carry = met.select(*key, *[F.coalesce(f"__inside{j}", f"__earlier{j}").alias(f"__carry{j}") for j in at])
    joined = df.select("*", *local).alias("l").join(carry.alias("r"), same(key), "left").select("l.*", *[f"r.{c}" for c in cols("carry")])
    found = {out: F.coalesce(f"__local{j}", f"__carry{j}") for j, out in enumerate(values)}
    return joined.withColumns(found).drop("__bucket", "__fine", *cols("value"), *cols("local"), *cols("carry"))


def numbered(df: DataFrame, buckets: list[Column], order: list[str], out: str) -> DataFrame:
    """Add ``out``: the place of the row in ``order``, from 1, without sorting everything in one task.

    ``buckets`` are coarse keys that never decrease along ``order``; rows of one bucket should fit a task.  Buckets are counted,
    a running sum over one row per bucket gives the places before each, and rows are numbered inside their bucket.
    """
    names = [f"__bucket{i}" for i in range(len(buckets))]
    df = df.withColumns(dict(zip(names, buckets)))
    counts = df.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    earlier = F.coalesce(F.sum("__n").over(W.orderBy(*names).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    before = counts.select(*names, earlier.alias("__before"))
    inside = F.row_number().over(W.partitionBy(*names).orderBy(*order))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in names]
    joined = df.withColumn("__inside", inside).alias("l").join(before.alias("r"), same).select("l.*", "r.__before")
    return joined.withColumn(out, F.col("__before") + F.col("__inside")).drop(*names, "__before", "__inside")
