"""Exact n-gram Jaccard join in a metric space (operator 7).

Jaccard distance is a metric, but most documents share nothing and are at distance 1 of any fixed pivot, so regions around random
pivots would hold everything.  Pivots are therefore taken where documents meet: two sets over the threshold share one of the first
shingles of each in any fixed order of all shingles (a fifth of them, and one), so every such shingle makes the smallest set that
has it a pivot, and the pivot's region holds all sets with one of its shingles; a document at the border of several regions is in
each.  Every link lies inside a region.  In the regions, sets meet first in a coarser metric, the distance of their shingle counts by
hash bucket, which is never above the true one: its classes hold every link, and each set is in one class only.  A class is a region
again, around its smallest set, joined exactly: a small one at once; in a large one, the distance to the pivot splits sets into the
ball that links with the pivot, which is one class, and rings as wide as the threshold; by the triangle inequality links only go
within a ring or to the next one, and only sets outside the ball have to look for links.  Rings are dealt into tiles of bounded size that
meet pair by pair.  Tasks give out spanning links, one row for each set they tie in, never all pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WORDS = 5
#: Threshold in percent: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Sets in a tile.
TILE = 512
#: Documents whose common shingles are put last in the order, and how many such shingles at most.  The order decides how much
#: work there is, never the result.
ORDER_SAMPLE, ORDER_TIMES, ORDER_SHINGLES = 5_000, 4, 200_000
#: Hash buckets of a sketch (a power of two).
SKETCH = 512


def shingle_sets(texts: common.Texts, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, joined; and the offsets of the texts in them."""
    w = common.Words(texts, lower=True)
    count = np.diff(w.bounds)
    n = len(w.hash)
    owner = np.repeat(np.arange(texts.n), count)
    roll = common.Rolling(w.hash)
    at = np.arange(n)
    full = np.flatnonzero(np.repeat(w.bounds[1:], count) - at >= words)
    short = np.flatnonzero((count > 0) & (count < words))  # the whole text is one shingle
    start = np.concatenate([full, w.bounds[:-1][short]])
    end = np.concatenate([full + words, w.bounds[1:][short]])
    text = np.concatenate([owner[full], short])
    value = common.mix(roll.spans(start, end) + (end - start).astype(np.uint64), 5)
    order = np.argsort(value)  # then by text, which keeps it
    order = order[np.argsort(text[order], kind="stable")]
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[new], text[new]
    return value, np.searchsorted(text, np.arange(texts.n + 1))


def set_ids(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """An identity of each set, by its content."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(common.mix(values, 6))])
    size = np.diff(bounds)
    return common.mix(sums[bounds[1:]] - sums[bounds[:-1]] + size.astype(np.uint64), 7).view(np.int64)


def set_table(docs: DataFrame, last: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """key, doc_id, n_shingles, set_id, sketch and prefix of every row of ``docs`` (key, doc_id, text).

    ``prefix``: the first shingles of the set, those of ``last`` behind all others; two sets over the threshold share one of them.
    ``sketch``: shingles by hash bucket, a byte each (255: or more)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.steps(batches):
            values, bounds = shingle_sets(common.Texts(rows.column("text")))
            size = np.diff(bounds)
            text = np.repeat(np.arange(len(size)), size)
            ids = set_ids(values, bounds)
            cell = text * SKETCH + (values >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64)
            sketch = np.minimum(np.bincount(cell, minlength=len(size) * SKETCH), 255).astype(np.uint8).tobytes()
            if len(last):  # a stable order by one bit keeps the hashes ascending
                late = last[np.minimum(np.searchsorted(last, values), len(last) - 1)] == values
                values = values[np.argsort(text * 2 + late, kind="stable")]
            take = np.where(size > 0, size - (size * percent + 99) // 100 + 1, 0)
            prefix = values[common.ranges(bounds[:-1], take)].view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(take)]), pa.int32()), pa.array(prefix))
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), rows.column("doc_id"), pa.array(size), pa.array(ids),
                 pa.array([sketch[i * SKETCH:(i + 1) * SKETCH] for i in range(len(size))], pa.binary()), lists],
                ["key", "doc_id", "n_shingles", "set_id", "sketch", "prefix"])

    return docs.mapInArrow(
        find, f"key long, doc_id {id_type}, n_shingles long, set_id long, sketch binary, prefix array<long>")


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles that many documents of a bounded sample share, ascending."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.steps(batches):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(common.Texts(rows.column("text")))[0].view(np.int64))], ["shingle"])

    share = min(1.0, ORDER_SAMPLE / max(1, docs.count()))
    sample = docs.where(F.pmod("key", F.lit(1 << 20)) < int(share * (1 << 20))).select("text")
    often = (sample.mapInArrow(find, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= ORDER_TIMES)
             .orderBy(F.desc("n"), "shingle").limit(ORDER_SHINGLES).select("shingle").collect())
    return np.sort(np.array([r.shingle for r in often], np.int64).view(np.uint64))


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ``wanted`` rows (key, set_id, region, large) with their shingles (bytes of ascending 64-bit hashes)."""
    wanted = common.materialise(wanted)
    both = common.likely(docs, "key", wanted).join(wanted, "key").select("text", "set_id", "region", "large")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.steps(batches):
            values, bounds = shingle_sets(common.Texts(rows.column("text")))
            raw = values.tobytes()
            parts = [raw[a * 8:b * 8] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in ("set_id", "region", "large")], pa.array(parts, pa.binary())],
                                             ["set_id", "region", "large", "shingles"])

    return both.mapInArrow(find, "set_id long, region long, large boolean, shingles binary")


class Forest:
    """Union-find over numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.trees = n

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def tie(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        self.trees -= 1
        return True


def overlaps(shingles: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each set, the size of its intersection with every set of the tile."""
    _, token = np.unique(shingles, return_inverse=True)
    order = np.argsort(token, kind="stable")
    holder = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[order]
    first = np.searchsorted(token[order], np.arange(token.max() + 2 if len(token) else 1))
    for i in range(len(bounds) - 1):
        mine = token[bounds[i]:bounds[i + 1]]
        yield i, np.bincount(holder[common.ranges(first[mine], first[mine + 1] - first[mine])], minlength=len(bounds) - 1)


def tile_links(shingles: np.ndarray, bounds: np.ndarray, ball: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Spanning links of the sets of a tile; those in the ``ball`` are one class already."""
    size = np.diff(bounds)
    forest, out = Forest(len(size)), []
    inside = np.flatnonzero(ball)
    for j in inside[1:].tolist():
        forest.tie(int(inside[0]), j)
    for i, both in overlaps(shingles, bounds):
        if forest.trees == 1:
            break
        if ball[i]:
            continue
        for j in np.flatnonzero((100 * both >= percent * (size + size[i] - both)) & (both > 0)).tolist():
            if forest.tie(i, j):
                out.append((i, j))
    return out


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table for each group of rows that are equal in ``keys``, from batches in the order of the keys."""
    held: list[pa.RecordBatch] = []
    now: tuple | None = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.zeros(batch.num_rows, bool)
        for c in columns:
            cut[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(cut).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != now:
                yield pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def sketch_links(members: DataFrame, tile: int, percent: int = PERCENT) -> DataFrame:
    """a, b: spanning links of the ``members`` (region, set_id, n, sketch) of each region that their sketches allow.

    The distance of two sketches is at most the symmetric difference of the sets, so no link of the sets is missing between the
    trees.  Regions over ``tile`` members are dealt into tiles that meet pair by pair."""
    counts = common.materialise(members.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles")).where("tiles > 1"))
    dealt = members.join(counts, "region", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    dealt = dealt.withColumn("t", F.pmod(F.xxhash64("set_id"), F.col("tiles")).cast("int")).withColumn(
        "u", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    keys = ["region", "t1", "t2"]
    met = dealt.select("region", F.least("t", "u").alias("t1"), F.greatest("t", "u").alias("t2"), "set_id", "n", "sketch")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, keys):
            m = table.num_rows
            order = np.argsort(table["n"].to_numpy(), kind="stable")
            size, ids = table["n"].to_numpy()[order], table["set_id"].to_numpy()[order]
            sketch = common.Texts(table["sketch"]).data.reshape(m, SKETCH)[order].astype(np.int16)
            upto = np.searchsorted(size * percent, size * 100, "right")
            tree, links = np.arange(m), []
            for i in range(m - 1):
                other = i + 1 + np.flatnonzero(tree[i + 1:upto[i]] != tree[i])
                if not len(other):
                    continue
                apart = np.abs(sketch[other] - sketch[i]).sum(1, dtype=np.int64)
                for j in other[(100 + percent) * apart <= (100 - percent) * (size[other] + size[i])].tolist():
                    if tree[j] != tree[i]:
                        tree[tree == tree[j]] = tree[i]
                        links.append((i, j))
            if links:
                x, y = np.array(links).T
                yield pa.RecordBatch.from_arrays([pa.array(ids[x]), pa.array(ids[y])], ["a", "b"])

    return met.repartition(*keys).sortWithinPartitions(*keys, "set_id").mapInArrow(find, "a long, b long")


def join_tiles(members: DataFrame, keys: list[str]) -> DataFrame:
    """a, b: spanning links of each tile of ``members`` (keys, set_id, shingles, ball)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, keys):
            if table.num_rows < 2:
                continue
            texts = common.Texts(table["shingles"])
            links = tile_links(np.frombuffer(texts.data.tobytes(), np.uint64), texts.bounds // 8,
                               table["ball"].to_numpy(zero_copy_only=False))
            if links:
                ids = table["set_id"].to_numpy()
                a, b = np.array(links).T
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    return (members.select(*keys, "set_id", "shingles", "ball").repartition(*keys).sortWithinPartitions(*keys, "set_id")
            .mapInArrow(find, "a long, b long"))


def pivot_distances(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """region, set_id, shingles, ring: 0 in the pivot's ball, else as many thresholds away as the ring says.

    The pivot's set reaches each row by a join of tables, so a hot region is split."""
    r = 100 - percent

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, pivot = batch.column("shingles"), batch.column("pivot")
            rings = []
            for i in range(batch.num_rows):
                a, b = np.frombuffer(mine[i].as_buffer(), np.uint64), np.frombuffer(pivot[i].as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                union = len(a) + len(b) - both
                # distance 1 - both / union, in thresholds, rounded up: 0 or 1 is the ball
                rings.append(max(0, -(-100 * (union - both) // (r * union)) - 1))
            yield pa.RecordBatch.from_arrays([batch.column("region"), batch.column("set_id"), mine, pa.array(rings, pa.int32())],
                                             ["region", "set_id", "shingles", "ring"])

    pivots = members.where("region = set_id").select("region", F.col("shingles").alias("pivot"))
    return members.join(common.materialise(pivots), "region").select("region", "set_id", "shingles", "pivot").mapInArrow(
        find, "region long, set_id long, shingles binary, ring int")


def large_regions(members: DataFrame, tile: int) -> DataFrame:
    """a, b: spanning links of large regions (region, set_id, shingles)."""
    placed = common.materialise(pivot_distances(members))
    star = placed.where("ring = 0 AND set_id <> region").select(F.col("region").alias("a"), F.col("set_id").alias("b"))
    # a band pairs a ring with the next one; ring 0 alone has nothing left to find
    bands = placed.withColumn("band", F.explode(F.expr("CASE WHEN ring = 0 THEN array(0) ELSE array(ring - 1, ring) END")))
    counts = common.materialise(bands.groupBy("region", "band").agg(F.count(F.lit(1)).alias("n"), F.max("ring").alias("most"))
                                .where("most > 0").select("region", "band", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    dealt = bands.join(counts, ["region", "band"]).withColumn("t", F.pmod(F.xxhash64("set_id"), F.col("tiles")).cast("int"))
    # every pair of tiles meets once; a tile meets itself in those pairs, or alone
    pairs = dealt.withColumn("u", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    met = pairs.select("region", "band", F.least("t", "u").alias("t1"), F.greatest("t", "u").alias("t2"), "set_id", "shingles",
                       (F.col("ring") == 0).alias("ball"))
    return star.unionByName(join_tiles(met, ["region", "band", "t1", "t2"]))


def components(links: DataFrame) -> DataFrame:
    """set_id, root of every set in ``links`` (a, b): the smallest id that links reach, by alternating stars: each node ties its
    larger neighbours to its smallest one, then itself and its smaller ones, until nothing changes."""

    def star(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        both = common.materialise(both.distinct())
        least = common.materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")))
        met = both.join(least, "a")
        if larger:
            out = met.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = met.select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        return out.where("a <> b").distinct()

    state, edges = None, common.materialise(links.distinct())
    while True:
        edges = common.materialise(star(star(edges, True), False))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("set_id"), F.col("b").alias("root"))
        state = now


def near_components(docs: DataFrame, tile: int | None = None) -> DataFrame:
    """key, doc_id, n_shingles, component_id, root of every row of ``docs`` (key, doc_id, text): the smallest doc_id that links reach,
    and the set that names the class (classes of one doc_id may share a component_id, never a root; null: no shingles).

    Null and empty texts have the empty set and stay alone.  Rows of equal sets are one class, whatever their text.  Rows with
    one doc_id are linked only by their sets.  An empty table gives an empty table."""
    tile = tile or TILE
    sets = common.materialise(set_table(docs, common_shingles(docs)))
    named_sets = sets.where("n_shingles > 0")
    reps = common.materialise(named_sets.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key")))
    first = sets.select(F.explode("prefix").alias("shingle"), "set_id")
    shared = common.materialise(first.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("shingle"))
    met = common.materialise(common.likely(first, "shingle", shared).join(shared, "shingle").distinct())
    pivots = common.materialise(met.groupBy("shingle").agg(F.min("set_id").alias("region"), F.max("set_id").alias("hi"))
                                .where("region < hi").select("shingle", "region"))
    regions = common.materialise(met.join(pivots, "shingle").select("region", "set_id").distinct())
    sketches = common.materialise(common.likely(named_sets, "set_id", regions).groupBy("set_id").agg(
        F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n")))
    # classes of the coarser metric: each set is in one, and every link is inside one
    coarse = components(common.materialise(sketch_links(common.materialise(regions.join(sketches, "set_id")), 2 * tile)))
    placed = common.materialise(coarse.select("set_id", F.col("root").alias("region")).unionByName(
        coarse.select(F.col("root").alias("set_id"), F.col("root").alias("region")).distinct()))
    sizes = common.materialise(placed.groupBy("region").agg((F.count(F.lit(1)) > tile).alias("large")))
    members = common.materialise(full_sets(docs, placed.join(sizes, "region").join(reps, "set_id").select("key", "set_id", "region", "large")))
    small = join_tiles(members.where("NOT large").withColumn("ball", F.lit(False)), ["region"])
    links = common.materialise(small.unionByName(large_regions(members.where("large"), tile)).where("a <> b"))
    roots = components(links)
    classes = reps.join(roots, "set_id", "left").select("set_id", "doc_id", F.coalesce("root", "set_id").alias("root"))
    least = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = common.materialise(classes.join(least, "root").select("set_id", "component_id", "root"))
    return sets.select("key", "doc_id", "n_shingles", "set_id").join(named, "set_id", "left").select(
        "key", "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "root")


def brute_force(rows: list[tuple], percent: int = PERCENT, words: int = WORDS) -> list[tuple]:
    """(doc_id, n_shingles, component_id) by the definition."""
    import re

    sets = []
    for d, t in rows:
        w = re.findall(common.WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append((d, {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()))
    forest = Forest(len(sets))
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                forest.tie(i, j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(sets):
        r = forest.root(i)
        least[r] = min(least.get(r, d), d)
    return [(d, len(s), least[forest.root(i)]) for i, (d, s) in enumerate(sets)]
