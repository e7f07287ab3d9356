"""Scoring by cross-entropy difference of two n-gram models (operator 9).

A target and a background bigram model share one vocabulary and one smoothing; a document's score is its loss per token under the
target model minus that under the background model (lower: more like the target).

Every word and every bigram of the corpus is in the models, however rare and at any size; nothing of them is collected or sent to all
tasks.  One pass over the texts makes blocks of about BLOCK_BYTES: the block's words as hashes and its tokens as places in them, which is a
third of the text; only that is kept and moved afterwards.  A block counts its words and bigrams once each (so a hot one is one entry
of a block) and gives them out in buckets of their hash; a bucket adds up what all blocks and the target corpus have, and answers each
block with the sums of just the entries it asked for, in the same order; with them the block scores its documents."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .collocations import packed as pack
from .collocations import unpacked as unpack

#: Weight of the unigram in a bigram estimate, in counts.
SMOOTH = 20.0
#: Bytes of text in a block (a longer document is alone in one), and about as many entries in a bucket; 2 ** BUCKET_BITS buckets at least.
BLOCK_BYTES, BUCKET_ENTRIES, BUCKET_BITS = 8 << 20, 1 << 22, 8
#: Stands for the word before the first one.
START = np.uint64(0x5851F42D4C957F2D)


def packed(values: np.ndarray) -> bytes:
    """The lower 56 bits of ascending hashes of one bucket (which holds the others): their steps, byte by byte, the two highest
    bytes squeezed."""
    value = values & np.uint64((1 << 56) - 1)
    value[1:] -= value[:-1].copy()
    planes = value.view(np.uint8).reshape(-1, 8).T
    high = zlib.compress(planes[5:7].tobytes(), 1)
    return planes[:5].tobytes() + high


def unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = np.zeros((8, n), np.uint8)
    planes[:5] = np.frombuffer(raw, np.uint8, 5 * n).reshape(5, n)
    planes[5:7] = np.frombuffer(zlib.decompress(raw[5 * n:]), np.uint8).reshape(2, n)
    return np.cumsum(planes.T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def word_hashes(texts: common.Texts) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every lower-cased word, and the number of words of every text."""
    w = common.Words(texts, lower=True)
    return w.hash, np.diff(w.bounds)


class Block:
    """The distinct bigrams (``pairs``, hashes, ascending) and words of some texts, START among the words, and how often they occur.
    ``values``: a value of each token, ``tokens``: their number in each text; ``words``: the hashes that the values are places in, if so."""

    def __init__(self, values: np.ndarray, tokens: np.ndarray, words: np.ndarray | None = None):
        self.tokens = tokens
        ends = np.cumsum(tokens)
        first, last = (ends - tokens)[tokens > 0], ends[tokens > 0] - 1
        n = len(values)
        if words is None:
            self.words, at = np.unique(np.concatenate([values, np.full(len(first), START)]), return_inverse=True)
            self.token, start = at[:n], at[n:]
        else:
            self.words, self.token = words, values
            start = np.searchsorted(words, np.full(len(first), START))
            at = np.concatenate([values, start])
        self.n_words = np.bincount(at, minlength=len(self.words))
        self.n_last = np.bincount(self.token[last], minlength=len(self.words))
        self.history = np.empty_like(self.token)
        self.history[1:] = self.token[:-1]
        self.history[first] = start
        hashes = self.words[self.token]
        self.pairs, self.pair = np.unique(common.mix(common.mix(self.words[self.history], 8) + hashes), return_inverse=True)
        self.n_pairs = np.bincount(self.pair, minlength=len(self.pairs))

    @classmethod
    def stored(cls, words: bytes, stream: bytes, tokens: bytes) -> Block:
        return cls(unpack(stream)[0], unpack(tokens)[0], np.cumsum(unpack(words)[0].view(np.uint64), dtype=np.uint64))

    def kept(self) -> tuple[bytes, bytes, bytes]:
        """What ``stored`` makes the block of again: words, stream and tokens."""
        return pack(np.diff(self.words, prepend=np.uint64(0)).view(np.int64)), pack(self.token), pack(self.tokens)

    def parts(self, bits: int) -> Iterator[tuple[int, bytes, bytes]]:
        """(bucket, entries, counts): bigrams in the first 2 ** bits buckets, words (and how often they end a text) in as many more."""
        for base, values, counts in ((0, self.pairs, [self.n_pairs]), (1 << bits, self.words, [self.n_words, self.n_last])):
            edges = np.searchsorted(values >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                i, j = edges[b], edges[b + 1]
                yield base + b, packed(values[i:j]), pack(*[c[i:j] for c in counts])


def _whole_blocks(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """One table for each value of ``key``, from batches in its order."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        value = batch.column(key).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(value[1:] != value[:-1]) + 1).tolist(), batch.num_rows]
        for i, j in zip(edges[:-1], edges[1:]):
            if held and held[0].column(key)[0] != batch.column(key)[i]:
                yield pa.Table.from_batches(held)
                held = []
            if j > i:
                held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of the batches in tables of about BLOCK_BYTES."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > BLOCK_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


STREAM = "words binary, stream binary, tokens binary"


def streams(docs: DataFrame) -> DataFrame:
    """block, doc_ids, words, stream, tokens of ``docs`` (doc_id, text), block by block as the texts come."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for table in _gathered(batches):
            ids = table["doc_id"].combine_chunks()
            kept = Block(*word_hashes(common.Texts(table["text"]))).kept()
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *[pa.array([k], pa.binary()) for k in kept]],
                ["block", "doc_ids", "words", "stream", "tokens"])
            number += 1

    return docs.select("doc_id", "text").mapInArrow(find, f"block long, doc_ids array<{id_type}>, {STREAM}")


PARTS = "bucket int, block long, target boolean, entries binary, counts binary"


def _parts(block: int | None, made: Block, bits: int) -> Iterator[pa.RecordBatch]:
    """bucket, block, target, entries, counts of a block; the target corpus gets no answer, so it has no block."""
    rows, size = [], 0
    for row in made.parts(bits):
        rows.append({"bucket": row[0], "block": block, "target": block is None, "entries": row[1], "counts": row[2]})
        size += len(row[1])
        if size > common.STEP_BYTES:
            yield pa.RecordBatch.from_pylist(rows, _PARTS)
            rows, size = [], 0
    yield pa.RecordBatch.from_pylist(rows, _PARTS)


_PARTS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("target", pa.bool_()), ("entries", pa.binary()), ("counts", pa.binary())])


def asked(kept: DataFrame, bits: int) -> DataFrame:
    """What the blocks (``streams``) ask for."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *raw in zip(*(batch.column(c).to_pylist() for c in ("block", "words", "stream", "tokens"))):
                yield from _parts(block, Block.stored(*raw), bits)

    return kept.select("block", "words", "stream", "tokens").mapInArrow(find, PARTS)


def target_counts(texts: DataFrame, bits: int) -> DataFrame:
    """The words and bigrams of the target corpus (text), in the same form."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            yield from _parts(None, Block(*word_hashes(common.Texts(table["text"]))), bits)

    return texts.select("text").mapInArrow(find, PARTS)


def answered(parts: DataFrame, bits: int) -> DataFrame:
    """bucket, block, sums: for each part of the background the sums of its entries over all of ``parts``, in its order (bigrams:
    background, target; words: background, ending a text, target, ending a text); and for each bucket of words a row without block:
    n_words, n, n_target (START is no word)."""
    kinds = "bucket int, block long, sums binary, n_words long, n long, n_target long"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches, "bucket"):
            bucket, target = table["bucket"][0].as_py(), table["target"].to_numpy()
            columns = 2 if bucket >= 1 << bits else 1
            counts = [unpack(x.as_py(), columns) for x in table["counts"]]
            edges = np.cumsum([0, *(c.shape[1] for c in counts)])
            value, at = np.unique(np.concatenate([unpacked(x.as_py(), c.shape[1]) for x, c in zip(table["entries"], counts)]), return_inverse=True)
            counts = np.concatenate(counts, axis=1)
            of_target = np.repeat(target, np.diff(edges))
            sums = np.zeros((2 * columns, len(value)), np.int64)
            for i, chosen in enumerate((~of_target, of_target)):
                for c in range(columns):
                    sums[i * columns + c] = np.bincount(at[chosen], counts[c][chosen], len(value))
            rows, size = [], 0
            for row in np.flatnonzero(~target).tolist():
                mine = pack(*sums[:, at[edges[row]:edges[row + 1]]])
                rows.append({"bucket": bucket, "block": table["block"][row].as_py(), "sums": mine})
                size += len(mine)
                if size > common.STEP_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, answer)
                    rows, size = [], 0
            if columns == 2:
                word = value != START & np.uint64((1 << 56) - 1) if bucket - (1 << bits) == int(START) >> (64 - bits) else np.ones(len(value), bool)
                rows.append({"bucket": bucket, "n_words": int(word.sum()), "n": int(sums[0, word].sum()), "n_target": int(sums[2, word].sum())})
            yield pa.RecordBatch.from_pylist(rows, answer)

    answer = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("sums", pa.binary()), ("n_words", pa.int64()), ("n", pa.int64()),
                        ("n_target", pa.int64())])
    return parts.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(find, kinds)


def scored(kept: DataFrame, answers: DataFrame, bits: int) -> DataFrame:
    """The scores of the documents of the blocks (``streams``) by what each block was answered."""
    n_words, *n = answers.where("block IS NULL").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_words", "n_target", "n")]).first()
    id_type = kept.schema["doc_ids"].dataType.elementType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches, "block"):
            bucket = table["bucket"].to_numpy()
            split = int(np.searchsorted(bucket, 2 << bits))
            half = int(np.searchsorted(bucket, 1 << bits))
            pairs, words = (
                np.concatenate([np.zeros((c, 0), np.int64), *(unpack(x.as_py(), c) for x in part)], axis=1)
                for c, part in ((2, table["sums"].slice(0, half)), (4, table["sums"].slice(half, split - half))))
            b = Block.stored(*(table[c][split].as_py() for c in ("words", "stream", "tokens")))
            if pairs.shape[1] != len(b.pairs) or words.shape[1] != len(b.words):
                raise ValueError("a block was not answered whole")
            text = np.repeat(np.arange(len(b.tokens)), b.tokens)
            losses = []
            for total, seen, (often, last) in ((n[0], pairs[1], words[2:]), (n[1], pairs[0], words[:2])):
                unigram = (often + 1) / (total + n_words + 1)
                loss = -np.log((seen[b.pair] + SMOOTH * unigram[b.token]) / ((often - last)[b.history] + SMOOTH))
                losses.append(np.bincount(text, loss, len(b.tokens)) / np.maximum(b.tokens, 1))
            ids = table["doc_ids"].slice(split, 1).combine_chunks().flatten()
            out = pa.Table.from_arrays([ids, pa.array(b.tokens), *map(pa.array, losses), pa.array(losses[0] - losses[1])],
                                       ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])
            yield from out.to_batches(max_chunksize=10_000)

    own = ["doc_ids", "words", "stream", "tokens"]
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    both = answers.where("block IS NOT NULL").select("block", "bucket", "sums", *[none(c, kept.schema[c].dataType) for c in own]).unionByName(
        kept.select("block", F.lit(2 << bits).alias("bucket"), none("sums", "binary"), *own))
    return both.repartition("block").sortWithinPartitions("block", "bucket").mapInArrow(
        find, f"doc_id {id_type}, n_tokens long, target_loss double, background_loss double, score double")


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Score every document; the target corpus is the documents whose doc_id is in ``target_ids`` (doc_id).

    Null and empty texts have no tokens and score 0.  Rows with one doc_id count and score each.  A null doc_id is never
    in the target.  Without target documents the target model is uniform.  An empty table gives an empty table."""
    docs = common.small_batches(docs).select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = max(BUCKET_BITS, math.ceil(math.log2(max(1, size / 6 / BUCKET_ENTRIES))))
    # ids grow with the corpus, so they are never broadcast, however few they are here; an inner join, as a semi join would be moved
    # below the bitmap
    ids = common.materialise(target_ids.where("doc_id IS NOT NULL").select(F.xxhash64("doc_id").alias("id"), "doc_id").distinct())
    chosen = common.likely(docs.withColumn("id", F.xxhash64("doc_id")), "id", ids).join(ids.hint("merge"), ["id", "doc_id"])
    kept = common.materialise(streams(docs))
    answers = common.materialise(answered(asked(kept, bits).unionByName(target_counts(chosen, bits)), bits))
    return scored(kept, answers, bits)
