"""Helpers of the training-data operators: materialised tables, word and byte hashing in numpy, bounded Arrow batches."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What separates words, everywhere: space and the controls 0x09 to 0x0D.
SEPARATORS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: A Python step works on so many bytes of text at a time; a longer document is a step of its own.
STEP_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors see: below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors, and leaves every later
    shuffle of it to the optimizer, which may split skewed partitions."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """Keeps what Spark hands a Python worker at once within a few MB, however long the texts are."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * STEP_BYTES))
    return df


def in_order(df: DataFrame, order: list[Column], weight: Column, drop: tuple[str, ...] = ()) -> DataFrame:
    """``df``, without the columns ``drop``, with _place (from 1, dense) and _before (the sum of ``weight`` over all earlier rows) in
    ``order``.  Rows are dealt by range and summed inside their partition; only one row for each partition is summed in one place."""
    dealt = df.withColumn("_weight", weight).repartitionByRange(*order).sortWithinPartitions(*order).drop(*drop)
    dealt = materialise(dealt.withColumn("_row", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("_part", F.shiftright("_row", 33))
    inside = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.sum("_weight").alias("w"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in ("n", "w")])
    summed = dealt.withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
    return (summed.join(parts, "_part")
            .withColumn("_place", F.col("_n") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
            .withColumn("_before", F.col("_w") + F.col("_inside")).drop("_part", "_row", "_n", "_w", "_inside", "_weight"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_key(*cols: str) -> Column:
    """A key of the whole row content that matters, so repeated ids never mix."""
    return F.xxhash64(*[F.col(c) for c in cols])


def count_words(text: Column) -> Column:
    """Number of words; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Bits of the bitmap of ``likely``, as a power of two: 64-bit words of it are at most 2**17 rows, 2 MB.
BITMAP_BITS = 23


def likely(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``df`` without most rows whose ``key`` (a 64-bit hash) is not in ``wanted`` (key), before a join shuffles them.

    A bitmap of fixed size goes to every task; it lets some others through, so the join has to follow."""
    word = lambda c: F.shiftright(c.bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)), 6).cast("int")
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), c.bitwiseAND(F.lit(63)).cast("int"))
    words = materialise(wanted.select(word(F.col(key)).alias("_word"), bit(F.col(key)).alias("_bit")).groupBy("_word").agg(
        F.bit_or("_bit").alias("_bits")))
    # at most 2 ** (BITMAP_BITS - 6) rows
    met = df.withColumn("_word", word(F.col(key))).join(F.broadcast(words), "_word")
    return met.where(F.col("_bits").bitwiseAND(bit(F.col(key))) != 0).select(*df.columns)


# --- numpy side ---------------------------------------------------------------------------------------------------------

_U = np.uint64
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x + _U((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_VALUE = mix(np.arange(256, dtype=np.uint64), 7)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Odd multipliers of the polynomial hashes modulo 2**64.
RADIX = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """r**0 .. r**n and their inverses modulo 2**64."""
    held = _POWERS.get(which)
    if held is None or len(held[0]) <= n:
        size = max(n + 1, STEP_BYTES + 64)
        both = []
        for base in (RADIX[which], pow(RADIX[which], -1, 1 << 64)):
            p = np.full(size, _U(base))
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        held = _POWERS[which] = (both[0], both[1])
    return held


class Rolling:
    """Polynomial hash of every stretch of a sequence of 64-bit values, from one prefix sum."""

    def __init__(self, values: np.ndarray, which: int = 0):
        up, self.down = _powers(len(values), which)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def windows(self, length: int) -> np.ndarray:
        """Hash of each stretch of ``length`` values, by its start."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.down[:n] if n > 0 else np.zeros(0, np.uint64)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


class Texts:
    """The bytes of some texts as one array; null texts are empty."""

    def __init__(self, column: pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column.cast(pa.large_binary()).fill_null(b"")
        self.n = len(column)
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + self.n + 1]
        first, last = (int(bounds[0]), int(bounds[-1])) if self.n else (0, 0)
        self.data = np.frombuffer(column.buffers()[2], np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
        self.bounds = bounds - first if self.n else np.zeros(1, np.int64)

    def bytes_of(self, i: int) -> np.ndarray:
        return self.data[self.bounds[i]:self.bounds[i + 1]]

    def byte_values(self) -> np.ndarray:
        return _BYTE_VALUE[self.data]


def word_bounds(data: np.ndarray, bounds: np.ndarray, separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of each word, and the word offsets of the texts; no word crosses two texts.  ``separator`` tells
    which of the 256 byte values part words."""
    inside = ~separator[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)  # a text starts here
    edge[bounds] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, bounds)


class Words:
    """The words of some texts: byte start and end, word offsets by text (``bounds``) and a 64-bit hash of each."""

    def __init__(self, texts: Texts, lower: bool = False):
        data = _LOWER[texts.data] if lower else texts.data
        self.start, self.end, self.bounds = word_bounds(data, texts.bounds)
        self.hash = mix(Rolling(_BYTE_VALUE[data]).spans(self.start, self.end) + (self.end - self.start).astype(np.uint64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by log-many passes."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have:]) if have < width else x


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), then start[1], ..."""
    total = int(count.sum())
    shift = np.repeat(start - (np.cumsum(count) - count), count)
    return shift + np.arange(total, dtype=np.int64)


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, cut into steps of at most ``size`` bytes of text or of one row."""
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column(column).cast(pa.large_binary())).fill_null(0))
        done, total = 0, 0
        ends = np.cumsum(sizes)
        while done < batch.num_rows:
            upto = max(done + 1, int(np.searchsorted(ends, total + size, "right")))
            yield batch.slice(done, upto - done)
            total, done = int(ends[upto - 1]), upto


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary file of the installed package; ``TOKENIZERS_DIR`` names another folder."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
