"""Document fingerprints by Order MinHash (operator 5).  DataFrame functions only.

k-mers are words; equal k-mers of a text are told apart by an occurrence number.  A hash of (k-mer, occurrence) deals them into
buckets and ranks them there; each bucket keeps its smallest ones, puts them back into text order, and the hash of that tuple of
k-mers is its component.  Two texts share a component where the same k-mers, in the same order, are smallest, which becomes rarer
with every edit and with every move.  (One hash with buckets in place of one hash for each component: one pass over the words.)"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Words in a k-mer, k-mers in a tuple, log2 of the number of buckets.
K, TUPLE, BUCKET_BITS = 2, 2, 6
_LOW32, _LOW31 = (1 << 32) - 1, (1 << 31) - 1
#: Documents in a block of neighbours, and the most blocks.
BLOCK_ROWS, MOST_BLOCKS = 1024, 20_000


def _packed(hash_: Column, position: Column) -> Column:
    """32 bits of a hash above 31 bits of a position: sorts by hash, and is never negative."""
    return F.shiftleft(hash_.bitwiseAND(F.lit(_LOW32)), 31).bitwiseOR(position.cast("long"))


def _starts(values: Column, n: Column, bits: int) -> Column:
    """Where a new value of the bits above ``bits`` begins in a sorted array (indexes from 0)."""
    part = lambda j: F.shiftright(F.get(values, j), bits)
    return F.filter(F.sequence(F.lit(0), n - 1), lambda j: (j == 0) | (part(j) != part(j - 1)))


def fingerprint(text: Column, k: int = K, tuple_: int = TUPLE, bucket_bits: int = BUCKET_BITS) -> Column:
    """Signature of a text as an array of longs: bucket << 32 | 32-bit component, for each bucket that has k-mers, ascending.

    Null is as empty; a text without words is one empty word; a text of fewer than k words has k-mers that run over its end,
    as the last ones of every text do."""
    words = F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r")), common.SEPARATORS)

    def grams(w: Column) -> Column:
        out = w
        for j in range(1, k):
            out = F.zip_with(out, F.slice(w, j + 1, F.greatest(F.size(w) - j, F.lit(0))), lambda a, b: F.xxhash64(a, b))
        return out

    def numbered(s: Column) -> Column:
        """From k-mers sorted by hash: hash of (k-mer, occurrence) with the position."""
        n = F.size(s)

        def of_run(starts: Column) -> Column:
            def one(first: Column, r: Column) -> Column:
                after = F.coalesce(F.get(starts, r + 1), n) - 1
                return F.transform(F.sequence(first, after), lambda j: _packed(
                    F.xxhash64(F.shiftright(F.get(s, j), 31), j - first), F.get(s, j).bitwiseAND(F.lit(_LOW31))))
            return F.flatten(F.transform(starts, one))

        return common.let(_starts(s, n, 31), of_run)

    def components(g: Column, t: Column) -> Column:
        shift = 63 - bucket_bits
        bucket = lambda x: F.shiftright(x, shift)

        def one(j: Column) -> Column:
            first = F.get(t, j)
            least = F.filter(F.slice(t, j + 1, tuple_), lambda x: bucket(x) == bucket(first))
            places = F.array_sort(F.transform(least, lambda x: x.bitwiseAND(F.lit(_LOW31)).cast("int")))
            code = F.aggregate(places, F.lit(0).cast("long"), lambda a, p: F.xxhash64(a, F.get(g, p)))
            return F.shiftleft(bucket(first), 32).bitwiseOR(code.bitwiseAND(F.lit(_LOW32)))

        return F.transform(_starts(t, F.size(t), shift), one)

    return common.let(F.transform(words, lambda w: F.xxhash64(w)), lambda w: common.let(grams(w), lambda g: common.let(
        F.sort_array(F.transform(g, lambda h, i: _packed(h, i))), lambda s: common.let(
            F.sort_array(numbered(s)), lambda t: components(g, t)))))


def likeness(a: Column, b: Column) -> Column:
    """Equal components, of the buckets that either text has: 0 to 1."""
    buckets = lambda x: F.transform(x, lambda v: F.shiftright(v, 32))
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(buckets(a), buckets(b)))


def as_text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda v: F.lower(F.hex(v))), ".")


def with_next(docs: DataFrame, value: str) -> DataFrame:
    """``docs`` (doc_id, text, ``value``) with next_text and the ``value`` of the next document, ascending (doc_id, text); the
    first one follows the last.

    Documents are dealt into blocks of neighbouring ids (bounds by approximate quantiles, at most MOST_BLOCKS numbers on the
    driver), and the first row of each block is also laid, as a marked row, at the end of the block before: one shuffle, no join."""
    count, low, nulls = docs.agg(F.count(F.lit(1)), F.min("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    n = min(MOST_BLOCKS, math.ceil(count / BLOCK_ROWS))
    marks = [i / n for i in range(1, n)]
    bounds = docs.agg(F.percentile_approx("doc_id", marks, 20 * n)).first()[0] if n > 1 and low is not None else []
    bounds = sorted({b for b in bounds or [] if b > low})
    step = max(1, math.isqrt(len(bounds)))
    coarse, fine = F.lit(bounds[::step]).cast("array<long>"), F.lit(bounds).cast("array<long>")
    at_or_below = lambda values: F.size(F.filter(values, lambda b: b <= F.col("doc_id")))

    def place(c: Column) -> Column:
        from_ = F.greatest((c - 1) * step, F.lit(0))
        return from_ + at_or_below(F.slice(fine, from_ + 1, step))

    block = F.when(F.col("doc_id").isNull(), 0).otherwise(common.let(at_or_below(coarse), place)) if bounds else F.lit(0)
    first_of_all = F.col("doc_id").isNull() if nulls else F.col("doc_id") == F.lit(low)
    heads = (docs.where(F.col("doc_id").isin(bounds) | first_of_all).groupBy(block.alias("block")).agg(F.min("text").alias("text"))
             .select(((F.col("block") + len(bounds)) % (len(bounds) + 1)).alias("block"), F.lit(None).cast("long").alias("doc_id"), "text",
                     F.lit(True).alias("mark")))
    rows = docs.select(block.alias("block"), "doc_id", "text", F.lit(False).alias("mark")).unionByName(heads)
    return rows


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, with likenesses: see the contract of the query.

    Null texts are empty.  A null doc_id stands first.  Rows with one doc_id stand in the order of their texts, each with its
    own row.  A single document is its own next one.  An empty table gives an empty table; other columns are ignored."""
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(plain, "fp").withColumn("fp", fingerprint(F.col("text")))
    following = F.lead(F.struct("text", "fp")).over(Window.partitionBy("block").orderBy("mark", "doc_id", "text"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    kept = rows.withColumn("next", following).where(~F.col("mark"))
    edited = kept.select("doc_id", "fp", F.col("next.fp").alias("next_fp"), F.char_length("text").cast("long").alias("n_chars"),
                         F.concat(F.substring("text", F.lit(1), F.char_length("text") - half),
                                  F.substring("next.text", F.lit(1), half)).alias("edited"))
    both = edited.withColumn("edited_fp", fingerprint(F.col("edited")))
    return both.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                       as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
