"""Exact top-k search by inner product with a pivot table (operator 6).

Candidates and queries meet in tiles.  A tile lifts its vectors by one coordinate, so that all candidates have one length and
the largest inner product is the smallest distance; it keeps the distances of every candidate to its pivots.  For a query, the largest
difference of distances to a pivot is a lower bound of the distance to a candidate; candidates are evaluated in the order of
their bounds until the next bound can no longer reach the k-th best score.  Queries keep k rows a tile, and a window ranks those."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .jaccard import _whole_groups

K, PIVOTS = 10, 48
TILE_CANDIDATES, TILE_QUERIES, CHUNK = 4096, 512, 128
SCALE = 1024


def quantised(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, v: floor(scale * x) of every component; rows without vec_id, null vectors and vectors with null or non-finite
    components take no part."""
    bad = F.exists(vector, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return vectors.where(F.col(vector).isNotNull() & F.col("vec_id").isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))


def tile_top(ids: np.ndarray, points: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
             pivots: int = PIVOTS) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query_id, vec_id, score) of each query's k best candidates of the tile, and how many scores were evaluated."""
    exact = max(np.abs(points).max(initial=0), 1) * max(np.abs(queries).max(initial=0), 1) * max(1, points.shape[1]) < 2 ** 52
    p, q = points.astype(np.float64), queries.astype(np.float64)
    norm, qnorm = (p * p).sum(1), (q * q).sum(1)
    top = norm.max()
    lift = np.sqrt(top - norm)
    chosen = np.unique(np.linspace(0, len(p) - 1, min(pivots, len(p))).astype(int))
    square = lambda s: np.sqrt(np.maximum(s, 0))
    table = square(norm[:, None] + norm[chosen] - 2 * (p @ p[chosen].T) + (lift[:, None] - lift[chosen]) ** 2)
    to_pivot = square(qnorm[:, None] + top - 2 * (q @ p[chosen].T))
    bound = np.zeros((len(q), len(p)))
    for j in range(len(chosen)):
        np.maximum(bound, np.abs(to_pivot[:, j, None] - table[:, j]), out=bound)
    # the largest score a candidate can have; the slack covers rounding
    most = (qnorm[:, None] + top - bound * bound) / 2
    most += 1 + 1e-9 * (qnorm[:, None] + top)
    out_q, out_v, out_s, evaluated = [], [], [], 0
    for i in range(len(q)):
        order = np.argsort(-most[i])
        order = order[ids[order] != query_ids[i]]
        best_v, best_s = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(order), CHUNK):
            if len(best_s) >= k and most[i, order[at]] < best_s[k - 1]:
                break
            part = order[at:at + CHUNK]
            score = (p[part] @ q[i]).astype(np.int64) if exact else points[part] @ queries[i]
            evaluated += len(part)
            best_v, best_s = np.concatenate([best_v, ids[part]]), np.concatenate([best_s, score])
            keep = np.lexsort((best_v, -best_s))[:k]
            best_v, best_s = best_v[keep], best_s[keep]
        out_q.append(np.full(len(best_v), query_ids[i]))
        out_v.append(best_v)
        out_s.append(best_s)
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s), evaluated


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products, ties to the smaller vec_id, never with its
    own vec_id.  Inputs: vec_id, v (array of whole numbers).

    Vectors meet vectors of their own length only.  Rows that repeat a vec_id are candidates each; equal queries are asked
    once.  Fewer than k candidates give fewer rows; no candidates or no queries give none.  Scores must fit in a long."""
    per_length = lambda df, size: df.groupBy(F.size("v").alias("dims")).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("tiles"))
    tiles = per_length(candidates, TILE_CANDIDATES).withColumnRenamed("tiles", "c_tiles").join(
        per_length(queries.distinct(), TILE_QUERIES).withColumnRenamed("tiles", "q_tiles"), "dims")
    side = lambda df: df.withColumn("dims", F.size("v")).join(common.materialise(tiles), "dims")
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = side(candidates).select("dims", place("c_tiles").alias("c"), every("q_tiles").alias("q"), F.lit(False).alias("asks"), "vec_id", "v")
    right = side(queries.distinct()).select("dims", every("c_tiles").alias("c"), place("q_tiles").alias("q"), F.lit(True).alias("asks"), "vec_id", "v")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["dims", "c", "q"]):
            asks = table["asks"].to_numpy(zero_copy_only=False)
            if asks.all() or not asks.any():
                continue
            ids = table["vec_id"].to_numpy()
            values = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), -1)
            q, v, s, _ = tile_top(ids[~asks], values[~asks], ids[asks], values[asks], k, pivots)
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], ["query_id", "vec_id", "score"])

    keys = ["dims", "c", "q"]
    found = (common.small_batches(left.unionByName(right)).repartition(*keys).sortWithinPartitions(*keys, "asks", "vec_id")
             .mapInArrow(search, "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


SQL = f"""
WITH v AS (
  SELECT vec_id, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
