"""Secret scans by character Markov models (operator 11).

One pass over the texts finds the spans of the base rules and the other long runs of token characters (``scan``).  Two Markov models of
characters, each conditioned on the two before, are trained from labelled samples (``train``): random strings and ordinary
identifiers.  A run whose log-likelihood ratio under the two passes a threshold is a span too.  In the query the samples are the values that
the base rules found and one encoded digest per row (random), and all other runs (ordinary), so the counts cover every document; the models
have a fixed number of entries whatever the size of the corpus."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# The base rules (letters of ``assign`` in either case), shortest values and the order of kinds
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
SHORTEST_VALUE, SHORTEST_ACCESS, SHORTEST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")
#: Characters of a run, and in the shortest run that is scored.
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
SHORTEST_RUN = 16
#: Log-likelihood ratio (nats) that a run must pass: odds of a million to one.
THRESHOLD = 13.8
#: Weight of the next shorter context in an estimate, in counts; the ratios are whole numbers of 2 ** -SCALE_BITS, so sums are exact.
SMOOTH, SCALE_BITS = 2.0, 20

_CODE = np.zeros(256, np.int64)
_CODE[list(ALPHABET)] = np.arange(1, len(ALPHABET) + 1)
_SIZE = len(ALPHABET) + 1  # 0: before the first character
_NO_RUN = _CODE == 0
_NO_HEX = np.ones(256, bool)
_NO_HEX[list(b"0123456789abcdef")] = False
_ASSIGN, _ACCESS = re.compile(ASSIGN), re.compile(ACCESS)


def base_spans(texts: common.Texts) -> np.ndarray:
    """(text, kind, start, end, start of the value) of the base rules' matches, in bytes of all texts, by text, start and kind."""
    found = []
    raw = texts.data.tobytes()
    lower = common._LOWER[texts.data].tobytes()  # lower-casing A-Z keeps every place
    access = b"AKIA" in raw
    for i, (a, b) in enumerate(zip(texts.bounds[:-1].tolist(), texts.bounds[1:].tolist())):
        found += [(i, 0, *m.span(), m.start(2)) for m in _ASSIGN.finditer(lower, a, b) if m.end(2) - m.start(2) >= SHORTEST_VALUE]
        if access:
            found += [(i, 1, *m.span(), m.start()) for m in _ACCESS.finditer(raw, a, b) if m.end() - m.start() >= SHORTEST_ACCESS]
    start, end, bounds = common.word_bounds(texts.data, texts.bounds, _NO_HEX)
    long = end - start >= SHORTEST_HEX
    text = np.repeat(np.arange(texts.n), np.diff(bounds))[long]
    hexes = np.stack([text, np.full(len(text), 2), start[long], end[long], start[long]], axis=1)
    out = np.concatenate([np.array(found, np.int64).reshape(-1, 5), hexes])
    return out[np.lexsort((out[:, 1], out[:, 2], out[:, 0]))]


def other_runs(texts: common.Texts, base: np.ndarray) -> np.ndarray:
    """(text, start, end) of the runs of token characters of SHORTEST_RUN and more that meet no base span."""
    start, end, bounds = common.word_bounds(texts.data, texts.bounds, _NO_RUN)
    long = end - start >= SHORTEST_RUN
    text, start, end = np.repeat(np.arange(texts.n), np.diff(bounds))[long], start[long], end[long]
    edge = np.zeros(len(texts.data) + 1, np.int64)
    np.add.at(edge, base[:, 2], 1)
    np.add.at(edge, base[:, 3], -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    free = covered[end] == covered[start]
    return np.stack([text[free], start[free], end[free]], axis=1)


def _lists(text: np.ndarray, n: int, *columns: pa.Array) -> list[pa.ListArray]:
    """The rows of each text as its lists; ``text`` ascends."""
    offsets = pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32())
    return [pa.ListArray.from_arrays(offsets, c) for c in columns]


def _stretches(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The ASCII strings between ``start`` and ``end``."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    letters = data[common.ranges(start, size)]
    return pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])


SCANNED = ("kinds array<int>, starts array<long>, ends array<long>, values array<string>, "
           "run_starts array<long>, runs array<string>")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id; kinds, starts, ends (code points) and values of the base spans; run_starts and runs (strings) of the other runs."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.steps(batches):
            texts = common.Texts(rows.column("text"))
            base = base_spans(texts)
            runs = other_runs(texts, base)
            points = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
            place = lambda text, at: pa.array(points[at] - points[texts.bounds[text]])
            kinds = _lists(base[:, 0], texts.n, pa.array(base[:, 1], pa.int32()), place(base[:, 0], base[:, 2]), place(base[:, 0], base[:, 3]),
                           _stretches(texts.data, base[:, 4], base[:, 3]))
            others = _lists(runs[:, 0], texts.n, place(runs[:, 0], runs[:, 1]), _stretches(texts.data, runs[:, 1], runs[:, 2]))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *kinds, *others],
                                             ["doc_id", "kinds", "starts", "ends", "values", "run_starts", "runs"])

    return common.small_batches(docs).select("doc_id", "text").mapInArrow(find, f"doc_id {id_type}, {SCANNED}")


def _contexts(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of (two characters before, character) at every place of the strings, and the strings' bounds.  Characters outside the
    alphabet count as the start."""
    texts = common.Texts(values)
    code = _CODE[texts.data]
    at = np.arange(len(code)) - np.repeat(texts.bounds[:-1], np.diff(texts.bounds))
    one, two = np.zeros_like(code), np.zeros_like(code)
    one[1:], two[2:] = code[:-1], code[:-2]
    one[at < 1] = 0
    two[at < 2] = 0
    return (two * _SIZE + one) * _SIZE + code, texts.bounds


def _log_model(counts: np.ndarray) -> np.ndarray:
    """log P(character | two before), each order smoothed by the next shorter one."""
    counts = counts.reshape(_SIZE, _SIZE, _SIZE).astype(float)
    single = counts.sum((0, 1))
    p = (single + 1) / (single.sum() + _SIZE)
    pairs = counts.sum(0)
    p = (pairs + SMOOTH * p) / (pairs.sum(1, keepdims=True) + SMOOTH)
    return np.log((counts + SMOOTH * p) / (counts.sum(2, keepdims=True) + SMOOTH)).ravel()


def train(samples: DataFrame) -> np.ndarray:
    """The log-likelihood ratio of every character after two others, from labelled ``samples`` (value, random).  Null values are empty, rows
    without label are left out; without samples of a kind its model is uniform.  At most 2 * 67 ** 3 counts reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, _SIZE ** 3), np.int64)
        for batch in batches:
            context, bounds = _contexts(batch.column("value"))
            label = np.repeat(np.asarray(batch.column("random").cast(pa.int8())), np.diff(bounds))
            for i in (0, 1):
                np.add.at(sums[i], context[label == i], 1)
        label, context = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(label == 1), pa.array(context), pa.array(sums[label, context])], ["random", "context", "n"])

    counted = samples.select("value", "random").where("random IS NOT NULL").mapInArrow(count, "random boolean, context long, n long")
    rows = counted.groupBy("random", "context").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros((2, _SIZE ** 3), np.int64)
    sums[rows["random"].to_numpy().astype(np.int64), rows["context"].to_numpy()] = rows["n"].to_numpy()
    ratio = _log_model(sums[1]) - _log_model(sums[0])
    return np.round(ratio * (1 << SCALE_BITS)).astype(np.int32)


def ratios(values: pa.Array, model: np.ndarray) -> np.ndarray:
    """The log-likelihood ratio of every string (nats)."""
    context, bounds = _contexts(values)
    sums = np.concatenate([[0], np.cumsum(model[context].astype(np.int64))])
    return (sums[bounds[1:]] - sums[bounds[:-1]]) / (1 << SCALE_BITS)


def rule_samples(scanned: DataFrame) -> DataFrame:
    """Labelled samples (value, random) from scanned documents.  Random: the values of base spans, and for each row one digest of its doc_id
    in base 16, base 64 or upper-case base 32, whichever its first byte says.  Ordinary: every other run."""
    digest = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256)
    first = F.conv(F.substring(digest, 1, 2), 16, 10).cast("int") % 3
    base32 = F.translate(F.upper(F.substring(digest, 3, 40)), "01", "XZ")
    encoded = F.when(first == 0, digest).when(first == 1, F.rtrim(F.translate(F.base64(F.unhex(digest)), "=", " "))).otherwise(base32)
    found = scanned.select(F.explode("values").alias("value"), F.lit(True).alias("random"))
    other = scanned.select(F.explode("runs").alias("value"), F.lit(False).alias("random"))
    return found.unionByName(scanned.select(encoded.alias("value"), F.lit(True).alias("random"))).unionByName(other)


def find_secrets(docs: DataFrame, samples: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and spans of every row of ``docs`` (doc_id, text): kind, start, end (code points, end exclusive) and the ratio (of random runs),
    by start and kind.  ``samples`` (value, random) train the models; by default they are taken from the documents (``rule_samples``).

    Null and empty texts have no spans; rows with one doc_id stay apart, a null doc_id stays; an empty table gives an empty
    table; other columns are ignored."""
    scanned = common.materialise(scan(docs))
    model = train(rule_samples(scanned) if samples is None else samples)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ratio", pa.float64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            of = lambda c: np.repeat(np.arange(n), np.diff(batch.column(c).offsets.to_numpy()))
            flat = lambda c: batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            runs = batch.column("runs").flatten()
            ratio = ratios(runs, model)
            chosen = ratio > threshold
            start = flat("run_starts")
            end = start + pc.utf8_length(runs).to_numpy(zero_copy_only=False)
            rows = np.concatenate([of("kinds"), of("runs")[chosen]])
            kind = np.concatenate([flat("kinds"), np.full(chosen.sum(), len(KINDS) - 1)])
            start, end = np.concatenate([flat("starts"), start[chosen]]), np.concatenate([flat("ends"), end[chosen]])
            ratio = np.concatenate([np.full(len(rows) - chosen.sum(), np.nan), ratio[chosen]])
            order = np.lexsort((end, kind, start, rows))
            spans = pa.StructArray.from_arrays(
                [pa.array([KINDS[k] for k in kind[order].tolist()], pa.string()), pa.array(start[order]), pa.array(end[order]),
                 pa.array(ratio[order], from_pandas=True)], fields=list(span))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_lists(rows[order], n, spans)], ["doc_id", "spans"])

    return scanned.mapInArrow(judge, f"doc_id {id_type}, spans array<struct<kind:string,start:long,end:long,ratio:double>>")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256 and spans (kind:start:end, comma-joined) of found secrets."""
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != KINDS[-1])
    return found.select("doc_id", *map(count, KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def brute_force(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_assign, n_access, n_hex, base spans) of every row, by the rules as they are written."""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = []
    for doc, text in rows:
        text = text or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= SHORTEST_VALUE]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= SHORTEST_ACCESS]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= SHORTEST_HEX]
        counts = [sum(k == i for _, k, _ in spans) for i in range(3)]
        out.append((doc, *counts, ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))))
    return out
