"""Best-fit packing of token sequences (operator 3).

Documents are encoded whole, only those longer than a sequence are cut, and the pieces are packed by bounded-space online
best-fit: a fixed number of open bins, found by one shift of a bitset keyed by free space; when all are in use, the fullest
closes.  Partitions pack on their own, so a piece never waits for another task and memory is the open bins plus one block."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import common, tokens

SEQUENCE = 4096
END_ID = 1
OPEN_BINS = 16384
#: Pieces that are put into decreasing order together before they arrive at the bins.
BLOCK = 32768


def pieces(docs: DataFrame, capacity: int = SEQUENCE, end_id: int = END_ID, path: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32 and, on request, the ids (little-endian bytes).

    Only documents of more than ``capacity`` ids are cut.  Null and empty texts give one piece with the end id; rows with
    the same doc_id give their pieces each; an empty table gives none; other columns are dropped."""
    path = path or common.tokenizer_path()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, offsets in tokens.encoded(batches, path, end_id):
            length = np.diff(offsets)
            count = -(-length // capacity)
            row = np.repeat(np.arange(len(length)), count)
            piece = common.ranges(np.zeros(len(count), np.int64), count)
            start = piece * capacity
            size = np.minimum(capacity, length[row] - start)
            raw = memoryview(ids.astype("<u4").tobytes())
            at = (offsets[row] + start) * 4
            parts = [raw[a:b] for a, b in zip(at.tolist(), (at + size * 4).tolist())]
            out = [rows.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(size),
                   pa.array([zlib.crc32(p) for p in parts], pa.int64())]
            if with_ids:
                out.append(pa.array([p.tobytes() for p in parts], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return common.small_batches(docs).select("doc_id", "text").mapInArrow(cut, schema)


class Bins:
    """Open bins by free space.  ``put`` returns (bin number, place) of the best fit."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.open, self.made, self.free = capacity, most, 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        number = held.pop()
        if not held:
            self.free ^= 1 << free
        self.open -= 1
        return number

    def put(self, length: int) -> tuple[int, int]:
        fits = self.free >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.capacity - free


def pack(items: DataFrame, order: list[str], length: str = "length", capacity: int = SEQUENCE, open_bins: int = OPEN_BINS,
         block: int = BLOCK) -> DataFrame:
    """``items`` with sequence_id and offset.  Deterministic for given partitions: items are dealt and ordered by a hash of
    ``order`` (columns that tell items apart), and arrive in decreasing length block by block.

    Items without a length, of negative length or longer than ``capacity`` get nulls.  Equal items are interchangeable.
    Columns of the results' names give way."""
    items = items.drop("sequence_id", "offset")
    schema = StructType([*items.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    where = items.columns.index(length)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = Bins(capacity, open_bins), TaskContext.get().partitionId() << 33
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            sizes = table.column(where).fill_null(-1).to_numpy(zero_copy_only=False)
            number, place = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            bad = (sizes < 0) | (sizes > capacity)
            for i in np.argsort(-sizes, kind="stable").tolist():
                if not bad[i]:
                    number[i], place[i] = bins.put(int(sizes[i]))
            held.clear()
            return pa.RecordBatch.from_arrays([*table.columns, pa.array(number + base, mask=bad), pa.array(place, mask=bad)],
                                              [*table.schema.names, "sequence_id", "offset"])

        rows = 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block - rows)
                held.append(part)
                rows += part.num_rows
                batch = batch.slice(part.num_rows)
                if rows == block:
                    yield flush()
                    rows = 0
        if rows:
            yield flush()

    key = F.xxhash64(*order)
    return items.repartition(key).sortWithinPartitions(key, *order, length).mapInArrow(deal, schema)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the joined ids (little-endian bytes) of each sequence; needs pieces made ``with_ids``.

    A sequence holds at most its capacity of ids, so a group is bounded."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.where("sequence_id IS NOT NULL").groupBy("sequence_id").agg(ordered.alias("parts"))
            .select("sequence_id", F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"])).alias("ids")))


def pack_documents(docs: DataFrame, capacity: int = SEQUENCE, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Encode, cut and pack every document.  See ``pieces`` and ``pack`` for nulls, repeated rows and empty tables."""
    return pack(pieces(docs, capacity, end_id, path), ["doc_id", "piece", "ids_crc32"], capacity=capacity)
