"""Substring dedup by seed and extend (operator 1).

Documents meet on winnowed anchors (``seeds``).  Around an anchor that several documents have, the match is extended to both
sides as far as a window of the threshold length reaches, and stretches over the threshold are kept.  Extending pair by pair
would give all pairs of a group of copies; here every run around an anchor is compared with its whole group at once: by the hash
of the run, which settles the inside of long matches, and, where runs of one anchor differ, window by window by a 128-bit key."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, seeds

#: Words in a window, and in an anchor.
WINDOW, ANCHOR = 50, 9


def keyed(docs: DataFrame) -> DataFrame:
    """key, doc_id, text; the key tells rows apart by content, so rows with one doc_id stay apart."""
    return docs.select(common.row_key("doc_id", "text").alias("key"), "doc_id", "text")


def repeated_stretches(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """key, start, length (in words) of stretches, each at least ``window`` words long, all of whose windows also start in a
    document with a smaller doc_id.  Their union is the maximal repeats.  ``docs``: key, doc_id, text."""
    all_runs = common.materialise(seeds.runs(docs, "word", window, anchor, ids=True))
    shared = seeds.shared_runs(all_runs, F.min("doc_id") < F.max("doc_id"))
    contents = common.materialise(shared.groupBy("seed", "whole").agg(F.min("doc_id").alias("lo_doc")))
    varied = contents.groupBy("seed").agg((F.count(F.lit(1)) > 1).alias("varied"))
    contents = common.materialise(contents.join(varied, "seed"))
    judged = common.materialise(shared.join(contents, ["seed", "whole"]).select(
        "key", "start", "n", (F.col("doc_id") > F.col("lo_doc")).alias("repeat"), "varied"))
    whole = judged.where("repeat").select("key", "start", (F.col("n") + window - 1).alias("length"))
    # what is left is the earliest document of each content
    left = judged.where("varied AND coalesce(NOT repeat, true)").select("key", "start", "n")
    windows = common.materialise(seeds.window_keys(docs, left, "word", window))
    first = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    single = windows.join(common.materialise(first), ["h1", "h2"]).where("doc_id > lo")
    return whole.unionByName(single.select("key", "start", F.lit(window).alias("length")))


def with_stretches(docs: DataFrame, stretches: DataFrame) -> DataFrame:
    """``docs`` (key, ...) with the lists starts and lengths (null: none); a list holds one document's stretches."""
    per_doc = stretches.groupBy("key").agg(F.collect_list("start").alias("starts"), F.collect_list("length").alias("lengths"))
    return docs.join(per_doc, "key", "left")


def stretches_of(row_starts, row_lengths) -> tuple[np.ndarray, np.ndarray]:
    if row_starts is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.asarray(row_starts, np.int64), np.asarray(row_lengths, np.int64)


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Documents without the words that a window of an earlier document covers: doc_id, n_words, n_removed, kept (words joined
    by one space) and the removed stretches (removed: start, end in words).

    Windows are judged on the input.  Null and empty texts have no words.  Rows with one doc_id are judged each; they are not
    earlier than one another.  A row without doc_id is never earlier and keeps its words.  Shorter texts than a window keep all.
    An empty table gives an empty table; other columns are ignored."""
    docs = keyed(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    both = with_stretches(docs, repeated_stretches(docs, window, anchor)).select("doc_id", "text", "starts", "lengths")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.steps(batches):
            texts = common.Texts(rows.column("text"))
            start, end, bounds = common.word_bounds(texts.data, texts.bounds)
            starts, lengths = rows.column("starts"), rows.column("lengths")
            kept, gone, spans = [], [], []
            raw = texts.data.tobytes()
            for i in range(rows.num_rows):
                a, b = int(bounds[i]), int(bounds[i + 1])
                at, size = stretches_of(starts[i].values if starts[i].is_valid else None,
                                        lengths[i].values if lengths[i].is_valid else None)
                out = seeds.covered(at, size, b - a)
                edge = np.diff(np.concatenate([[0], out.view(np.int8), [0]]))
                spans.append([{"start": s, "end": e} for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())])
                gone.append(int(out.sum()))
                words = np.flatnonzero(~out) + a
                kept.append(b" ".join([raw[s:e] for s, e in zip(start[words].tolist(), end[words].tolist())]).decode())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(bounds)), pa.array(gone, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", "n_words", "n_removed", "kept", "removed"])

    return both.mapInArrow(cut, f"doc_id {id_type}, n_words long, n_removed long, kept string, removed array<struct<start:long,end:long>>")


def brute_force(rows: list[tuple], window: int = WINDOW) -> dict:
    """doc_id -> (n_words, n_removed, sha256 of the kept words), by the definition."""
    import re

    words = {d: re.findall(common.WORD, t or "") for d, t in rows}
    first: dict[tuple, object] = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i:i + window]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out
