"""Suffix-array dedup by common-prefix intervals (operator 4).

The suffixes that can have an equal prefix of ``window`` bytes elsewhere are brought together by winnowed seeds (``seeds``), as
stretches that hold all windows around a seed; stretches equal as a whole come once, with their count.  A task takes whole seeds,
drops the suffixes whose window has no equal, sorts the rest into a suffix array with common-prefix lengths, and scans it with a
stack: every interval of suffixes with a common prefix of at least the window, whose left neighbours differ, is a maximal repeat
group with all its occurrences.  Seeds with very many different stretches are parted under finer seeds first, and what is still
crowded is compared by window key, which spreads."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, seeds, substrings

#: Bytes in a window, and in a seed.
WINDOW, SEED = 200, 40
#: Different stretches of a seed beyond which it is crowded.
CROWD = 400
#: Windows in a part of a crowded seed's stretch.
PART = 16
#: Bytes of stretches that share a suffix array.
ARRAY_BYTES = 1 << 19


def common_prefixes(roll: common.Rolling, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to ``most``, by bisection on hashes."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = roll.spans(a, a + middle) == roll.spans(b, b + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def suffix_array(data: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share their first ``window`` bytes with another one, in order, and the common prefix of each with the one
    before it.  A suffix ends with its stretch."""
    n = len(data) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    roll = common.Rolling(common._BYTE_VALUE[data])
    start = np.flatnonzero(ends[:n] - np.arange(n) >= window)
    keys = roll.windows(window)[start]
    order = np.sort(keys)
    again = np.unique(order[1:][order[1:] == order[:-1]])
    at = np.searchsorted(again, keys)
    start = start[again[np.minimum(at, len(again) - 1)] == keys] if len(again) else start[:0]
    raw = data.tobytes()
    suffix = [raw[a:b] for a, b in zip(start.tolist(), ends[start].tolist())]
    start = start[np.array(sorted(range(len(suffix)), key=suffix.__getitem__), np.int64)] if len(suffix) else start
    prefix = np.zeros(len(start), np.int64)
    if len(start) > 1:
        a, b = start[:-1], start[1:]
        prefix[1:] = common_prefixes(roll, a, b, np.minimum(ends[a] - a, ends[b] - b))
    return start, prefix


def intervals(prefix: list[int], left: list[int], window: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of every interval of the suffix array whose suffixes share ``length`` >= ``window`` bytes, no more,
    and whose left neighbours (``left``, -1: none) are not all the same.  Inner intervals come before outer ones."""
    stack: list[list[int]] = []  # [length, first, left neighbour or -1 if several]
    n = len(prefix)
    for i in range(1, n + 1):
        now = prefix[i] if i < n else 0
        if now < window:
            now = 0
        first, seen = i - 1, left[i - 1]
        while stack and stack[-1][0] > now:
            length, first, other = stack.pop()
            seen = other if other == seen else -1
            if seen < 0:
                yield length, first, i - 1
        if not now:
            continue
        if stack and stack[-1][0] == now:
            if stack[-1][2] != seen:
                stack[-1][2] = -1
        else:
            stack.append([now, first, seen])


def groups(data: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The suffix array of some stretches and its maximal repeat groups."""
    suffix, prefix = suffix_array(data, bounds, window)
    before = np.where(np.isin(suffix, bounds), -1, data[np.maximum(suffix - 1, 0)].astype(np.int64))
    return suffix, list(intervals(prefix.tolist(), before.tolist(), window))


def _whole_seeds(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Tables of whole seeds, of about ``size`` bytes of stretches, from batches in the order of the seed."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        held.append(batch)
        total += batch.column("stretch").nbytes
        if total < size:
            continue
        table = pa.Table.from_batches(held)
        last = pc.index(table["seed"], table["seed"][-1]).as_py()  # the last seed may go on
        if last:
            yield table.slice(0, last)
        rest = table.slice(last).combine_chunks()
        held, total = rest.to_batches(), rest["stretch"].nbytes if last else 0
    if held:
        yield pa.Table.from_batches(held)


def repeat_groups(stretches: DataFrame, window: int, every: bool) -> DataFrame:
    """group, key, start, length of the occurrences in ``stretches`` (seed, key, start, single, stretch).

    ``every``: all occurrences of every maximal repeat group.  Otherwise each suffix of a single stretch once, with its
    longest group: that is all a cover needs."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_seeds(batches, ARRAY_BYTES):
            table = table.combine_chunks()
            texts = common.Texts(table["stretch"])
            suffix, found = groups(texts.data, texts.bounds, window)
            if not found:
                continue
            lengths, first, last = (np.array(x, np.int64) for x in zip(*found))
            if every:
                size = last - first + 1
                at, number, length = common.ranges(first, size), np.repeat(np.arange(len(found)), size), np.repeat(lengths, size)
            else:
                number = np.full(len(suffix), -1, np.int64)
                for g in range(len(found) - 1, -1, -1):  # inner groups last
                    number[found[g][1]:found[g][2] + 1] = g
                at = np.flatnonzero(number >= 0)
                number = number[at]
                length = lengths[number]
            place = suffix[at]
            row = np.searchsorted(texts.bounds, place, "right") - 1
            if not every:
                single = table["single"].to_numpy(zero_copy_only=False)[row]
                place, row, number, length = place[single], row[single], number[single], length[single]
            start = table["start"].to_numpy()[row] + place - texts.bounds[row]
            seed = table["seed"].to_numpy()[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(common.mix(seed.view(np.uint64) + number.astype(np.uint64)).view(np.int64)),
                 table["key"].combine_chunks().take(pa.array(row)), pa.array(start, pa.int32()), pa.array(length, pa.int32())],
                ["group", "key", "start", "length"])

    return (stretches.repartition("seed").sortWithinPartitions("seed", "key", "start")
            .mapInArrow(scan, "group long, key long, start int, length int"))


def cut_stretches(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """``wanted`` (seed, key, start, n, ...flags) with the bytes of each stretch."""
    fields = [c for c in wanted.columns if c != "key"]
    per_doc = wanted.groupBy("key").agg(F.collect_list(F.struct(*fields)).alias("wanted"))
    both = common.likely(docs, "key", wanted).join(per_doc, "key").select("key", "text", "wanted")
    schema = "key long, stretch binary, " + ", ".join(f"{c} {wanted.schema[c].dataType.simpleString()}" for c in fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.steps(batches):
            texts = common.Texts(rows.column("text"))
            lists = rows.column("wanted")
            row = np.repeat(np.arange(rows.num_rows), np.asarray(pc.list_value_length(lists)))
            flat = lists.flatten()
            start = texts.bounds[row] + pc.struct_field(flat, "start").to_numpy()
            end = start + pc.struct_field(flat, "n").to_numpy() + window - 1
            raw = texts.data.tobytes()
            parts = [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("key").take(pa.array(row)), pa.array(parts, pa.binary()), *[pc.struct_field(flat, c) for c in fields]],
                ["key", "stretch", *fields])

    return both.mapInArrow(cut, schema)


def _windows_by_key(stretches: DataFrame, window: int) -> DataFrame:
    """h1, h2, key, start of every window of the stretches."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.steps(batches, "stretch"):
            texts = common.Texts(rows.column("stretch"))
            values = texts.byte_values()
            n = np.diff(texts.bounds) - window + 1
            row = np.repeat(np.arange(rows.num_rows), n)
            at = common.ranges(texts.bounds[:-1], n)
            keys = [pa.array(common.mix(common.Rolling(v, i).spans(at, at + window)).view(np.int64))
                    for i, v in enumerate((values, common.mix(values, 3)))]
            start = rows.column("start").to_numpy()[row] + at - texts.bounds[row]
            yield pa.RecordBatch.from_arrays([*keys, rows.column("key").take(pa.array(row)), pa.array(start, pa.int32())],
                                             ["h1", "h2", "key", "start"])

    return stretches.select("key", "start", "stretch").mapInArrow(find, "h1 long, h2 long, key long, start int")


def compared(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(stretches that occur twice or more as a whole: key, start, length; different stretches that share a seed, with bytes)."""
    all_runs = common.materialise(seeds.runs(docs, "byte", window, seed))
    shared = seeds.shared_runs(all_runs, F.count(F.lit(1)) > 1)
    contents = common.materialise(shared.groupBy("seed", "whole").agg(
        F.count(F.lit(1)).alias("times"), F.min("key").alias("key"), F.min_by("start", "key").alias("start"), F.min("n").alias("n")))
    # every shared run meets the count of its content: the join gives as many rows as it takes, however often a content occurs
    judged = common.materialise(shared.join(contents.select("seed", "whole", "times"), ["seed", "whole"], "left").select("key", "start", "n", "times"))
    whole = judged.where("times > 1").select("key", "start", (F.col("n") + window - 1).alias("length"))
    per_seed = contents.groupBy("seed").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1")
    wanted = contents.join(common.materialise(per_seed), "seed").select(
        "seed", "key", "start", "n", (F.col("times") == 1).alias("single"), (F.col("contents") > CROWD).alias("crowd"))
    return whole, common.materialise(cut_stretches(docs, wanted, window))


def finer(stretches: DataFrame, window: int, seed: int) -> DataFrame:
    """The stretches of crowded seeds in parts of at most PART windows, under finer seeds: equal windows have their seed at the
    same place, so windows are parted by that place, and a part's new seed is the hash of what all its windows share."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.steps(batches, "stretch"):
            texts = common.Texts(rows.column("stretch"))
            roll = common.Rolling(texts.byte_values())
            hashes = common.mix(roll.windows(seed))
            first, n = texts.bounds[:-1], np.diff(texts.bounds) - window + 1
            # the seed of the first window is its rightmost k-gram of that hash
            row = np.repeat(np.arange(rows.num_rows), window - seed + 1)
            at = common.ranges(first, np.full(rows.num_rows, window - seed + 1))
            hit = hashes[at] == rows.column("seed").to_numpy().view(np.uint64)[row]
            place = np.zeros(rows.num_rows, np.int64)
            np.maximum.at(place, row[hit], (at - first[row])[hit])
            row = np.repeat(np.arange(rows.num_rows), n)
            start = common.ranges(first, n)
            part = (place[row] - (start - first[row])) // PART
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
            edge = np.flatnonzero(new)
            count = np.diff(np.append(edge, len(row)))
            row, start, part = row[edge], start[edge], part[edge]
            # what every window of the part shares, wherever the part begins or ends in this stretch
            low = first[row] + place[row] - part * PART
            shared = roll.spans(low, low + window - PART + 1)
            whole = roll.spans(start, start + count + window - 1)
            raw = texts.data.tobytes()
            stretch = [raw[x:y] for x, y in zip(start.tolist(), (start + count + window - 1).tolist())]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(common.mix(shared + part.astype(np.uint64)).view(np.int64)),
                 pa.array(common.mix(whole + count.astype(np.uint64)).view(np.int64)), rows.column("key").take(take),
                 pa.array(rows.column("start").to_numpy()[row] + (start - first[row]).astype(np.int32), pa.int32()),
                 pa.array(count, pa.int32()), rows.column("single").take(take), pa.array(stretch, pa.binary())],
                ["seed", "whole", "key", "start", "n", "single", "stretch"])

    return stretches.select("seed", "key", "start", "single", "stretch").mapInArrow(
        cut, "seed long, whole long, key long, start int, n int, single boolean, stretch binary")


def repeated_stretches(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """key, start, length (bytes) of stretches whose union is every byte covered by a ``window`` that also starts elsewhere."""
    whole, stretches = compared(docs, window, seed)
    # crowded seeds once more, under finer seeds; what is crowded still is compared by window key
    parts = common.materialise(finer(stretches.where("crowd"), window, seed))
    contents = common.materialise(parts.groupBy("seed", "whole").agg(F.count(F.lit(1)).alias("times"), F.min("key").alias("first")))
    per_seed = contents.groupBy("seed").agg((F.count(F.lit(1)) > CROWD).alias("crowd"), (F.count(F.lit(1)) > 1).alias("varied"))
    judged = common.materialise(parts.join(common.materialise(contents.join(per_seed, "seed")), ["seed", "whole"]))
    again = judged.where("times > 1").select("key", "start", (F.col("n") + window - 1).alias("length"))
    left = judged.where("varied AND (times = 1 OR key = first)").withColumn("single", F.col("single") & (F.col("times") == 1))
    by_array = repeat_groups(
        stretches.where("NOT crowd").select("seed", "key", "start", "single", "stretch").unionByName(
            left.where("NOT crowd").select("seed", "key", "start", "single", "stretch")), window, every=False).select("key", "start", "length")
    windows = common.materialise(_windows_by_key(left.where("crowd"), window))
    twice = common.materialise(windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("h1", "h2"))
    by_key = windows.join(twice, ["h1", "h2"]).select("key", "start", F.lit(window).alias("length"))
    return whole.unionByName(again).unionByName(by_array).unionByName(by_key)


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, keep: tuple[str, ...] = ("doc_id",),
                   as_text: bool = False) -> DataFrame:
    """Documents without the bytes that a repeated window covers: the columns ``keep``, n_bytes, n_removed, kept (binary, or
    with ``as_text`` a string without characters that a cut has broken) and the removed spans (removed: start, end in bytes).

    Strings are judged on the input, in all documents and within one, and never across documents; every occurrence goes.
    Null texts are empty.  Rows with one doc_id are documents each: equal rows repeat one another.  Texts shorter than a window
    stay whole.  An empty table gives an empty table; columns beyond ``keep`` are ignored."""
    # equal rows share a key: their runs still count twice, and both get the stretches
    narrow = docs.select(*keep, "text").withColumn("key", common.row_key("doc_id", "text"))
    both = substrings.with_stretches(narrow, repeated_stretches(narrow, window, seed))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.steps(batches):
            texts = common.Texts(rows.column("text"))
            starts, lengths = rows.column("starts"), rows.column("lengths")
            kept, gone, spans = [], [], []
            for i in range(rows.num_rows):
                data = texts.bytes_of(i)
                if not starts[i].is_valid:
                    kept.append(data.tobytes())
                    gone.append(0)
                    spans.append([])
                    continue
                out = seeds.covered(*substrings.stretches_of(starts[i].values, lengths[i].values), len(data))
                edge = np.diff(np.concatenate([[0], out.view(np.int8), [0]]))
                spans.append([{"start": s, "end": e} for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())])
                gone.append(int(out.sum()))
                kept.append(data[~out].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in keep], pa.array(np.diff(texts.bounds)), pa.array(gone, pa.int64()),
                 pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                [*keep, "n_bytes", "n_removed", "kept", "removed"])

    return both.select(*keep, "text", "starts", "lengths").mapInArrow(
        cut, f"{kinds}, n_bytes long, n_removed long, kept {'string' if as_text else 'binary'}, removed array<struct<start:long,end:long>>")


def brute_force(rows: list[tuple], window: int = WINDOW) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of the kept bytes) of each row, by the definition."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    times = Counter(t[i:i + window] for _, t in texts for i in range(len(t) - window + 1))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if times[t[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
