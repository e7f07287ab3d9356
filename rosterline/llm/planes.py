"""Token ids in binary files of compressed planes (operator 10).

A file holds the ids of consecutive documents in blocks of a fixed number of ids.  A block is transposed into byte planes (all
lowest bytes, then all second bytes, ...) or bit planes, and each plane is compressed by zstandard.  The footer is a chunk
index (place, ids and plane sizes of each block) and a document index (doc_id, n_tokens).

    b"PLN1" | planes of block 0 | planes of block 1 | ... | chunk index | document index | trailer
    trailer: four little-endian 64-bit numbers (place of the chunk index, place of the document index, planes a block,
    ids in a full block), then b"1NLP"
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, tokens

MAGIC, END_MAGIC, TRAILER = b"PLN1", b"1NLP", "<QQQQ4s"
BLOCK_IDS = 1 << 17
END_ID = 1


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Planes of some 32-bit ids, most significant last."""
    cells = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if not bits:
        return [np.ascontiguousarray(cells[:, i]).tobytes() for i in range(4)]
    flags = np.unpackbits(cells, axis=1, bitorder="little")
    return [np.packbits(np.ascontiguousarray(flags[:, i])).tobytes() for i in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        return np.ascontiguousarray(np.stack([np.frombuffer(p, np.uint8) for p in planes], 1)).view("<u4").ravel()
    flags = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], 1)
    return np.packbits(flags, axis=1, bitorder="little").view("<u4").ravel()


class PlaneWriter:
    """Writes one file to an open binary stream; holds one block of ids and the document index."""

    def __init__(self, out, bits: bool = False, block: int = BLOCK_IDS):
        self.out, self.bits, self.block = out, bits, block
        self.press = zstandard.ZstdCompressor(level=1)
        self.index: list[list[int]] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.documents: list[pa.RecordBatch] = []
        out.write(MAGIC)
        self.place = len(MAGIC)

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        self.place += len(data)
        return len(data)

    def _block(self, ids: np.ndarray) -> None:
        place = self.place
        self.index.append([place, len(ids)] + [self._put(self.press.compress(p)) for p in to_planes(ids, self.bits)])

    def add(self, documents: pa.RecordBatch, ids: np.ndarray) -> None:
        """``documents``: doc_id and n_tokens of consecutive documents; ``ids``: theirs, joined."""
        self.documents.append(documents)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.block:
            joined = np.concatenate(self.waiting)
            full = len(joined) // self.block * self.block
            for at in range(0, full, self.block):
                self._block(joined[at:at + self.block])
            self.waiting, self.n_waiting = [joined[full:].copy()], len(joined) - full

    def close(self) -> int:
        """Number of documents."""
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        chunks = self.place
        self._put(np.array(self.index, "<i8").tobytes())
        listed = self.place
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.documents[0].schema) as writer:
            for batch in self.documents:
                writer.write_batch(batch)
        self._put(self.press.compress(sink.getvalue().to_pybytes()))
        self._put(struct.pack(TRAILER, chunks, listed, 32 if self.bits else 4, self.block, END_MAGIC))
        return sum(b.num_rows for b in self.documents)


class PlaneReader:
    """Random access to one file: the document index, and any stretch of ids by the chunk index."""

    def __init__(self, file):
        self.file = file
        size, tail = file.size(), struct.calcsize(TRAILER)
        chunks, listed, planes, self.block, end = struct.unpack(TRAILER, self._bytes(size - tail, tail))
        if end != END_MAGIC:
            raise ValueError("not a complete plane file")
        self.index = np.frombuffer(self._bytes(chunks, listed - chunks), "<i8").reshape(-1, 2 + planes)
        packed = self._bytes(listed, size - tail - listed)
        self.documents = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packed)).read_all()

    def _bytes(self, place: int, n: int) -> bytes:
        self.file.seek(place)
        return self.file.read(n)

    def chunk(self, i: int) -> np.ndarray:
        place, n, *sizes = self.index[i].tolist()
        raw, plain, planes = self._bytes(place, sum(sizes)), zstandard.ZstdDecompressor(), []
        for size in sizes:
            planes.append(plain.decompress(raw[:size]))
            raw = raw[size:]
        return from_planes(planes, n)

    def chunks(self) -> Iterator[np.ndarray]:
        for i in range(len(self.index)):
            yield self.chunk(i)

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the file."""
        if not n:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (start + n - 1) // self.block
        joined = np.concatenate([self.chunk(i) for i in range(first, last + 1)])
        return joined[start - first * self.block:start - first * self.block + n]


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_planes(docs: DataFrame, folder: str, bits: bool = False, block: int = BLOCK_IDS, end_id: int = END_ID,
                 path: str | None = None) -> DataFrame:
    """Encode all documents and write them in ascending doc_id order, a file for each range of ids.  Runs at once and returns
    the manifest (also kept in the folder): part, file, n_docs, n_ids; parts ascend as the ids do.

    A task attempt writes a file of its own name, and only files of the manifest are read, so lost and repeated attempts do no
    harm.  Null texts are empty, a null doc_id sorts first, rows with one doc_id stay apart (ordered by text), an empty table
    gives an empty manifest; other columns are ignored."""
    path = path or common.tokenizer_path()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        writer = None
        for rows, ids, offsets in tokens.encoded(batches, path, end_id):
            if writer is None:
                name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.planes"
                system, place = _filesystem(name)
                system.create_dir(place.rpartition("/")[0])
                out = system.open_output_stream(place)
                writer = PlaneWriter(out, bits, block)
            listed = pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(offsets))], ["doc_id", "n_tokens"])
            writer.add(listed, ids)
        if writer is not None:
            n = writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "file": [name],
                                              "n_docs": pa.array([n], pa.int64()), "n_ids": pa.array([writer.n_ids], pa.int64())})

    sorted_docs = common.small_batches(docs).select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = f"{folder}/manifest"
    sorted_docs.mapInArrow(write, "part int, file string, n_docs long, n_ids long").write.parquet(manifest)
    return docs.sparkSession.read.schema("part int, file string, n_docs long, n_ids long").parquet(manifest)


def read_planes(manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A file is one task, read block by block.  The running sum is over one row per file."""
    starts = manifest.withColumn("first", F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, place = _filesystem(row["file"])
                with system.open_input_file(place) as file:
                    reader = PlaneReader(file)
                    sizes = reader.documents.column("n_tokens").to_numpy()
                    ends = np.cumsum(sizes)
                    sums, doc, running, at = np.zeros(len(sizes), np.int64), 0, 0, 0
                    for chunk in reader.chunks():
                        raw, done = memoryview(chunk.tobytes()), 0
                        while done < len(chunk):
                            upto = min(int(ends[doc]) - at, len(chunk))
                            running = zlib.crc32(raw[done * 4:upto * 4], running)
                            done = upto
                            if at + upto == ends[doc]:
                                sums[doc], running, doc = running, 0, doc + 1
                        at += len(chunk)
                    ids = reader.documents.column("doc_id").combine_chunks()
                    for a in range(0, len(sizes), 65536):
                        b = a + 65536
                        yield pa.RecordBatch.from_arrays(
                            [ids[a:b], pa.array((ends - sizes)[a:b] + (row["first"] or 0)), pa.array(sizes[a:b]), pa.array(sums[a:b])],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = max(1, manifest.count())
    return (starts.select("file", "first").repartition(files)
            .mapInArrow(read, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long"))
