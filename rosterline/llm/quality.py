"""Quality classifier by Bradley-Terry ranking (operator 8).

A document's strength is linear in features of its whole text.  The weights come from preference pairs (a labelled good document
over a labelled bad one) by logistic loss on the difference of their features; strengths become scores around the quantile of the
training strengths that the share of bad labels names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import common

#: Labelled rows that are learned from, and preference pairs made of them, at most.
LABELLED_ROWS, PAIRS = 20_000, 40_000
CUT = 0.7
RIDGE = 1e-3

_GROUPS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!", "?", "|", "#$%&*", "-_=+~", "/\\",
           "<>{}[]", "()", "@", ":;", "'\"", "\n"]


def _runs(text: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the count of the most frequent one, for each of n texts."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(text)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, text[at], size)
    return np.bincount(text[at], minlength=n), most


def features(texts: common.Texts) -> np.ndarray:
    """A row of features for each text; an empty text has zeros."""
    data, bounds, n = texts.data, texts.bounds, texts.n
    size = np.maximum(np.diff(bounds), 1)
    columns = [np.log1p(np.diff(bounds))]
    owner = np.repeat(np.arange(n), np.diff(bounds))
    kind = np.zeros(256, np.int64)
    for i, group in enumerate(_GROUPS):
        kind[[ord(c) for c in group]] = i + 1
    kind[128:] = len(_GROUPS) + 1
    width = len(_GROUPS) + 2
    counts = np.bincount(owner * width + kind[data], minlength=n * width).reshape(n, width)
    columns += [counts[:, i] / size for i in range(1, width)]
    letters = np.maximum(counts[:, 1] + counts[:, 2], 1)
    columns.append(counts[:, 2] / letters)
    w = common.Words(texts, lower=True)
    many = np.diff(w.bounds)
    some = np.maximum(many, 1)
    word_text = np.repeat(np.arange(n), many)
    length = w.end - w.start
    mean = np.bincount(word_text, length, n) / some
    columns += [mean / 10, np.sqrt(np.maximum(np.bincount(word_text, length * length, n) / some - mean ** 2, 0)) / 10]
    first, last = (data[w.start], data[w.end - 1]) if len(w.start) else (data[:0], data[:0])
    share = lambda flag: np.bincount(word_text, flag, n) / some
    columns += [share(length <= 3), share(length >= 14), share((first >= 65) & (first <= 90)), share(kind[last] == 4), share(kind[last] >= 6)]
    distinct, most = _runs(word_text, w.hash, n)
    columns += [distinct / some, most / some, np.log1p(many)]
    if len(w.hash) > 1:
        pairs = common.mix(w.hash[:-1] * np.uint64(3) + w.hash[1:])
        inside = word_text[:-1] == word_text[1:]
        distinct, most = _runs(word_text[:-1][inside], pairs[inside], n)
    columns += [distinct / some, most / some]
    # lines, as stretches between newlines inside a text
    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([bounds, breaks + 1]))
    start, end = edges[:-1], edges[1:]
    line_text = np.searchsorted(bounds, start, "right") - 1
    hashes = common.mix(common.Rolling(texts.byte_values()).spans(start, end - (data[end - 1] == 10))) if len(start) else np.zeros(0, np.uint64)
    lines = np.maximum(np.bincount(line_text, minlength=n), 1)
    distinct, most = _runs(line_text, hashes, n)
    columns += [distinct / lines, most / lines, np.log1p(size / lines)]
    return np.stack(columns, 1)


class Ranker:
    """Standardised features with hinges, weights, and the strength that scores CUT."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, cut: float = CUT, seed: int = 7):
        self.cut = cut
        good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
        self.mean = rows.mean(0) if len(rows) else np.zeros(1)
        self.scale = np.maximum(rows.std(0), 1e-9) if len(rows) else np.ones(1)
        self.weights, self.middle = None, 0.0
        if not len(good) or not len(bad):
            return
        x = self._spread(rows)
        draw = np.random.default_rng(seed)
        difference = x[draw.choice(good, pairs)] - x[draw.choice(bad, pairs)]
        w = np.zeros(x.shape[1])
        for _ in range(25):  # Newton steps for the mean of log(1 + exp(-difference . w)) + ridge
            p = 1 / (1 + np.exp(np.clip(difference @ w, -30, 30)))
            slope = RIDGE * w - difference.T @ p / pairs
            curve = (difference * (p * (1 - p))[:, None]).T @ difference / pairs
            step = np.linalg.solve(curve + RIDGE * np.eye(len(w)), slope)
            w -= step / max(1.0, np.abs(step).max() / 2)
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w
        strength = x @ w
        self.middle = float(np.quantile(strength, len(bad) / (len(good) + len(bad))))

    def _spread(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, np.maximum(z - 0.5, 0), np.maximum(-z - 0.5, 0), np.maximum(z - 2, 0)], 1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; without both labels every document scores CUT."""
        strength = self._spread(rows) @ self.weights - self.middle if self.weights is not None else np.zeros(len(rows))
        return 1 / (1 + np.exp(np.clip(-strength - np.log(self.cut / (1 - self.cut)), -30, 30)))


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Ranker:
    """A ranker from at most ``rows`` labelled documents that are not held out, those of the smallest hashes.

    Labels other than 0 and 1 and labels without a document are ignored."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "quality").where(~held_out())
    chosen = known.orderBy(F.xxhash64("doc_id"), "quality").limit(rows)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.steps(batches):
            found = features(common.Texts(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("quality"), pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(
                    pa.list_(pa.float64()))], ["doc_id", "quality", "features"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    # at most ``rows`` pairs of ids and labels: bounded, so they may go to every task
    found = docs.select("doc_id", "text").join(F.broadcast(chosen.withColumn("quality", F.col("quality").cast("int"))), "doc_id").mapInArrow(
        find, f"doc_id {id_type}, quality int, features array<double>").toArrow()
    if not found.num_rows:
        return Ranker(np.zeros((0, 1)), np.zeros(0))
    values = found["features"].combine_chunks().flatten().to_numpy().reshape(found.num_rows, -1)
    order = np.lexsort((*values.T, found["quality"].to_numpy(), found["doc_id"].to_numpy()))  # rows come in any order
    return Ranker(values[order], found["quality"].to_numpy()[order])


def score(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """``docs`` with score; columns of the results' names give way.  Null texts are empty; empty texts get a score like any other; repeated rows score alike."""
    docs = docs.drop("score", "held_out", "predicted")
    at = docs.columns.index("text")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for rows in common.steps(iter([part.rename_columns([f"c{i}" for i in range(part.num_columns)])]), f"c{at}"):
                found = ranker.score(features(common.Texts(rows.column(at))))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found)], schema.names)

    return docs.mapInArrow(find, schema)


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``docs`` with held_out, score and predicted (1: score >= ``cut``).  An empty table gives an empty table."""
    ranker = learn(common.small_batches(docs), labels)
    return score(docs, ranker).withColumn("held_out", held_out()).withColumn("predicted", (F.col("score") >= cut).cast("int"))
