"""Winnowed seeds: where documents can share a stretch of ``window`` symbols (words or bytes) at all.

Every window of ``window`` symbols has one seed: its k-gram of the smallest hash (the rightmost one of equals).  The choice
depends on the window's content alone, so equal windows have equal seeds at the same place.  Neighbouring windows with one seed
occurrence form a run.  A run is (seed, hash of the whole stretch the run covers): runs with a seed of their own hold no repeat,
runs that are equal as a whole are repeats as a whole, and only the others have to be compared by content."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

_LOW = np.uint64(0xFFFFFFFF)


def symbols(texts: common.Texts, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value for each symbol, and the symbol offsets of the texts."""
    if unit == "byte":
        return texts.byte_values(), texts.bounds
    words = common.Words(texts)
    return words.hash, words.bounds


def find_runs(values: np.ndarray, bounds: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, start in the text, windows, seed hash, hash of the stretch) of every run."""
    n = len(values) - window + 1
    none = (np.zeros(0, np.int64),) * 5
    if n <= 0:
        return none
    ends = np.repeat(bounds[1:], np.diff(bounds))  # of the text of each symbol
    roll = common.Rolling(values)
    seeds = common.mix(roll.windows(k))
    places = np.arange(len(seeds), dtype=np.uint64)
    least = common.sliding_min((seeds & ~_LOW) | (_LOW - places), window - k + 1)
    start = np.flatnonzero(ends[:n] - np.arange(n) >= window)
    if not len(start):
        return none
    seed = (_LOW - (least[start] & _LOW)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (seed[1:] != seed[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    start, seed = start[first], seed[first]
    text = np.searchsorted(bounds, start, "right") - 1
    whole = common.mix(roll.spans(start, start + count + window - 1) + count.astype(np.uint64))
    return text, start - bounds[text], count, seeds[seed].view(np.int64), whole.view(np.int64)


def runs(docs: DataFrame, unit: str, window: int, k: int, ids: bool = False) -> DataFrame:
    """key, start, n, seed, whole (and doc_id, on request) of every run of ``docs`` (key, doc_id, text)."""
    names = ["key"] + ["doc_id"] * ids

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.steps(batches):
            text, start, n, seed, whole = find_runs(*symbols(common.Texts(rows.column("text")), unit), window, k)
            row = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [rows.column(c).take(row) for c in names]
                + [pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(seed), pa.array(whole)],
                [*names, "start", "n", "seed", "whole"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return common.small_batches(docs).select(*names, "text").mapInArrow(
        find, "key long, " + f"doc_id {id_type}, " * ids + "start int, n int, seed long, whole long")


def shared_runs(all_runs: DataFrame, needed: Column) -> DataFrame:
    """The runs whose seed passes ``needed``, a condition over the aggregates of the seed's runs.  Kept seeds become a table and
    the runs are no aggregate, so a hot seed's rows can be split by the join."""
    kept = all_runs.groupBy("seed").agg(needed.alias("needed")).where("needed").select("seed")
    return common.materialise(all_runs.join(common.materialise(kept), "seed"))


def window_keys(docs: DataFrame, wanted: DataFrame, unit: str, window: int) -> DataFrame:
    """(h1, h2, doc_id, key, start) of every window of the wanted runs (key, start, n).  A document's runs meet its text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    per_doc = wanted.groupBy("key").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("counts"))
    both = common.likely(docs, "key", wanted).join(per_doc, "key").select("key", "doc_id", "text", "starts", "counts")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.steps(batches):
            values, bounds = symbols(common.Texts(rows.column("text")), unit)
            starts, counts = rows.column("starts"), rows.column("counts")
            row = np.repeat(np.arange(rows.num_rows), np.asarray(pc.list_value_length(starts)))
            start = starts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            count = counts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.unique(common.ranges(start + bounds[row], count))
            if not len(at):
                continue
            text = np.searchsorted(bounds, at, "right") - 1
            where = pa.array(text)
            keys = [pa.array(common.mix(common.Rolling(v, i).spans(at, at + window)).view(np.int64))
                    for i, v in enumerate((values, common.mix(values, 3)))]
            yield pa.RecordBatch.from_arrays(
                [*keys, rows.column("doc_id").take(where), rows.column("key").take(where), pa.array(at - bounds[text], pa.int32())],
                ["h1", "h2", "doc_id", "key", "start"])

    return both.mapInArrow(find, f"h1 long, h2 long, doc_id {id_type}, key long, start int")


def covered(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n places the stretches cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:n]) > 0
