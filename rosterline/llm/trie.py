"""Conversation prefix trie by time-forward processing (operator 13).

Every distinct sequence of first turns is a node.  Turns get their places by a range sort, and a prefix gets a 128-bit key: the XOR of a
hash of each turn and its place, so keys come from running sums in blocks of turns, and the parent's key by taking the last turn out.
Nodes are counted by key.  Totals of subtrees are made by time-forward processing: nodes are externally sorted by reverse level order, each
passes its totals to its parent's place in a priority queue that spills, and takes those of its children from it.  That is done in
shards, for the topmost subtrees of at most SHARD_TURNS turns; the nodes above them are dealt into bands of BAND levels, processed with
the totals of the shard roots below them, then the roots of the bands across each other, then the bands with what comes from below."""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: A conversation takes over the first turns of the first one of its GROUP ids: fewer than HEADS.
GROUP, HEADS = 100, 6
#: Turns below the root of a shard, levels of a band, messages that a queue holds in memory, turns or ids that are summed up together.
SHARD_TURNS, BAND, QUEUE, BLOCK = 1 << 16, 1024, 1 << 17, 1024
KEY = ("depth", "ka", "kb")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """place (dense, over all conversations), conv_id, a, b (hashes of role and text), size (code points of the text)."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    whole = F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256)
    half = lambda place: F.conv(F.substring(whole, place, 15), 16, 10).cast("long")
    hashed = turns.select("conv_id", "turn", "role", "text", half(1).alias("a"), half(16).alias("b"), F.char_length("text").cast("long").alias("size"))
    # rows of one turn number stand in the order of role and text
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    placed = common.in_order(hashed, order, F.lit(1), drop=("turn", "role", "text"))
    return placed.select(F.col("_place").alias("place"), "conv_id", "a", "b", "size")


def with_heads(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after every conversation c took over the first h turns of conversation c - c % ``group``, h being the
    crc32 of its decimal id modulo ``heads``, in place of its own first h: conv_id, depth, length, a, b, size; conv_id, length."""
    convs = common.materialise(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"), F.min("place").alias("first")))
    head = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    lent = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % heads).withColumn("head", head)
    lender = convs.select(F.col("conv_id").alias("head"), F.col("own").alias("there"), F.col("first").alias("lent_from"))
    lent = lent.join(lender, "head", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    lent = common.materialise(lent.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    place = F.col("place") - F.col("first") + 1
    own = turns.join(lent, "conv_id").where(place > F.col("h")).select(
        "conv_id", (place - F.col("h") + F.col("taken")).alias("depth"), "length", "a", "b", "size")
    asked = lent.where("taken > 0").select("conv_id", "length", "lent_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("taken"))).alias("depth"))
    given = turns.where(F.pmod("conv_id", F.lit(group)) == 0).drop("conv_id")
    taken = asked.withColumn("place", F.col("lent_from") + F.col("depth") - 1).join(given, "place").select("conv_id", "depth", "length", "a", "b", "size")
    return own.unionByName(taken), lent.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, depth from 1, length, a, b, size) with the keys of the prefix that ends with each (ka, kb) and of the one before
    (pa, pb).  A long conversation is summed in blocks, and over its blocks."""
    marked = common.materialise(turns.select(
        "conv_id", "depth", "length", "size", F.xxhash64("a", "depth").alias("za"), F.xxhash64("b", "depth", F.lit(1)).alias("zb"),
        F.expr(f"(depth - 1) DIV {BLOCK}").alias("block")))
    blocks = marked.where(F.col("length") > BLOCK).groupBy("conv_id", "block").agg(F.bit_xor("za").alias("ta"), F.bit_xor("zb").alias("tb"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("conv_id", "block", *[F.bit_xor(f"t{i}").over(earlier).alias(f"c{i}") for i in "ab"])
    upto = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = marked.select("*", *[F.bit_xor(f"z{i}").over(upto).alias(f"r{i}") for i in "ab"]).join(carried, ["conv_id", "block"], "left")
    keys = running.select("conv_id", "depth", "length", "size", "za", "zb",
                          *[F.col(f"r{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0).cast("long"))).alias(f"k{i}") for i in "ab"])
    return keys.select("conv_id", "depth", "length", "size", "ka", "kb", *[F.col(f"k{i}").bitwiseXOR(F.col(f"z{i}")).alias(f"p{i}") for i in "ab"])


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, ka, kb, ends_sha256: SHA-256 of the ascending, comma-joined conv_ids of ``ends`` (conv_id, depth, ka, kb) by key.  Ids are
    joined in blocks first, so the one task that a digest takes only reads their pieces."""
    pieces = ends.groupBy(*KEY, F.expr(f"conv_id - pmod(conv_id, {BLOCK})").alias("block")).agg(
        F.array_join(F.sort_array(F.collect_set("conv_id")).cast("array<string>"), ",").alias("piece"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, running = None, None
        for batch in batches:
            rows = []
            for *key, piece in zip(*(batch.column(c).to_pylist() for c in (*KEY, "piece"))):
                if key == last:
                    running.update(b",")
                else:
                    if last is not None:
                        rows.append((*last, running.hexdigest()))
                    last, running = key, hashlib.sha256()
                running.update(piece.encode())
            yield batch_of(rows)
        if last is not None:
            yield batch_of([(*last, running.hexdigest())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], [*KEY, "ends_sha256"])

    return (pieces.repartition("ka", "kb").sortWithinPartitions(*KEY, "block").select(*KEY, "piece")
            .mapInArrow(digest, "depth long, ka long, kb long, ends_sha256 string"))


class SpillingQueue:
    """A priority queue of 5-tuples of 64-bit numbers, the smallest first.  Beyond ``most`` entries it writes sorted runs to unnamed files,
    which vanish with the task, and merges them as they are read."""

    ENTRY = struct.Struct("<5q")

    def __init__(self, most: int = QUEUE):
        self.most, self.heap, self.fronts, self.runs = most, [], [], []

    def _read(self, file, held: int = 1024) -> Iterator[tuple]:
        while raw := file.read(self.ENTRY.size * held):
            yield from self.ENTRY.iter_unpack(raw)
        file.close()

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.most:
            file = tempfile.TemporaryFile()
            self.heap.sort()
            for i in range(0, len(self.heap), 1024):
                file.write(b"".join(self.ENTRY.pack(*e) for e in self.heap[i:i + 1024]))
            file.seek(0)
            self.heap = []
            self.runs.append(self._read(file))
            heapq.heappush(self.fronts, (next(self.runs[-1]), len(self.runs) - 1))

    def first(self) -> tuple | None:
        if self.fronts and (not self.heap or self.fronts[0][0] <= self.heap[0]):
            return self.fronts[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.fronts and (not self.heap or self.fronts[0][0] <= self.heap[0]):
            entry, run = self.fronts[0]
            following = next(self.runs[run], None)
            if following is None:
                heapq.heappop(self.fronts)
            else:
                heapq.heapreplace(self.fronts, (following, run))
            return entry
        return heapq.heappop(self.heap)


_TOTALS = ("n_children", "n_leaves", "saved")


def forward(nodes: DataFrame, queue: int = QUEUE) -> DataFrame:
    """``nodes`` with n_children, n_leaves and saved, the totals of their subtrees.  A node has its shard (sa, sb), whether it is the root of
    the shard (top), its key, its parent's, its own tokens (own) and what it got from outside the shard (children_in, leaves_in,
    saved_in).  A shard must be in one task, which streams it."""
    names = nodes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = SpillingQueue(queue)
        for batch in batches:
            totals = []
            for depth, ka, kb, pa_, pb, top, own, children, leaves, saved in zip(*(batch.column(c).to_pylist() for c in (
                    *KEY, "pa", "pb", "top", "own", "children_in", "leaves_in", "saved_in"))):
                saved += own
                while (message := waiting.first()) is not None and message[:3] == (-depth, ka, kb):
                    waiting.pop()
                    children, leaves, saved = children + 1, leaves + message[3], saved + message[4]
                if not children:
                    leaves = 1
                totals.append((children, leaves, saved))
                if not top:
                    waiting.push((1 - depth, pa_, pb, leaves, saved))
            columns = list(zip(*totals)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in columns)], [*names, *_TOTALS])
        if waiting.first() is not None:
            raise ValueError("a message did not reach its node")

    schema = T.StructType([*nodes.schema.fields, *(T.StructField(c, T.LongType()) for c in _TOTALS)])
    return nodes.repartition("sa", "sb").sortWithinPartitions("sa", "sb", F.desc("depth"), "ka", "kb").mapInArrow(run, schema)


def _outside(**given: Column) -> list[Column]:
    """Nothing from outside the shard, but for what is given."""
    return [given.get(c, F.lit(0)).cast("long").alias(c) for c in ("children_in", "leaves_in", "saved_in")]


def _sent(roots: DataFrame) -> DataFrame:
    """What shard roots send to their parents, by the parents' key."""
    sent = roots.groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))
    return sent.agg(F.count(F.lit(1)).alias("children_in"), F.sum("n_leaves").alias("leaves_in"), F.sum("saved").alias("saved_in"))


def subtree_totals(nodes: DataFrame, rows: DataFrame, shard: int = SHARD_TURNS, band: int = BAND, queue: int = QUEUE) -> DataFrame:
    """``nodes`` (the root included; with weight, the turns of the subtree's members from the node on) with the totals of their subtrees.
    ``rows``: conv_id, depth, ka, kb of every conversation's prefixes, by which a node finds its ancestors."""
    heavy = nodes.where((F.col("weight") > shard) | (F.col("depth") == 0))
    cut = rows.select("conv_id", *KEY).join(heavy.select(*KEY), [*KEY]).groupBy("conv_id").agg(F.max("depth").alias("cut"))
    # the shard of a light node: its highest light ancestor, on the path of the conversation that it has its conv_id from
    tops = rows.select("conv_id", "depth", F.col("ka").alias("sa"), F.col("kb").alias("sb")).join(cut, "conv_id", "left")
    tops = tops.where(F.col("depth") == F.coalesce("cut", F.lit(0)) + 1).select("conv_id", F.col("depth").alias("top_depth"), "sa", "sb")
    light = nodes.where((F.col("weight") <= shard) & (F.col("depth") > 0)).join(tops, "conv_id")
    light = light.withColumn("top", F.col("depth") == F.col("top_depth")).drop("top_depth").select("*", *_outside())
    light = common.materialise(forward(light, queue))
    # the nodes above, in bands: the shard of one is its ancestor at the first level of its band
    up = common.materialise(heavy.withColumn("band", F.expr(f"depth DIV {band}")))
    heads = rows.where(F.col("depth") % band == 0).select(
        "conv_id", F.expr(f"depth DIV {band}").alias("band"), F.col("ka").alias("sa"), F.col("kb").alias("sb"))
    up = up.join(heads, ["conv_id", "band"], "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("sa", "sb")})
    up = up.withColumn("top", F.col("depth") == F.col("band") * band)
    below = _sent(light.where("top"))
    last = up.agg(F.max("band")).first()[0] or 0

    def fed(messages: DataFrame) -> DataFrame:
        fields = [c for c in up.columns if c != "band"]
        return up.select(*fields).join(messages, [*KEY], "left").select(
            *fields, *_outside(**{c: F.coalesce(c, F.lit(0)) for c in ("children_in", "leaves_in", "saved_in")}))

    def added(*messages: DataFrame) -> DataFrame:
        both = messages[0]
        for more in messages[1:]:
            both = both.unionByName(more)
        return both.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in ("children_in", "leaves_in", "saved_in")])

    if last:  # a band's own totals, the band below being a child without anything yet; then what the roots have with all below them
        children = up.where(F.col("top") & (F.col("depth") > 0))
        empty = _sent(children.withColumns({"n_leaves": F.lit(0), "saved": F.lit(0)}))
        alone = forward(fed(added(below, empty)), queue).where("top").select("conv_id", *KEY, "pa", "pb", "n_leaves", "saved")
        above = heads.select("conv_id", (F.col("band") + 1).alias("level"), F.col("sa").alias("ra"), F.col("sb").alias("rb"))
        level = F.expr(f"depth DIV {band}")
        roots = common.materialise(alone.withColumn("level", level)).join(above, ["conv_id", "level"], "left")
        across = forward(roots.select(
            F.col("level").alias("depth"), "ka", "kb", F.coalesce("ra", F.lit(0).cast("long")).alias("pa"), F.coalesce("rb", F.lit(0).cast("long")).alias("pb"),
            (F.col("level") == 0).alias("top"), F.col("saved").alias("own"), F.lit(0).cast("long").alias("sa"), F.lit(0).cast("long").alias("sb"),
            F.col("pa").alias("to_a"), F.col("pb").alias("to_b"), *_outside(children_in=F.lit(1), leaves_in=F.col("n_leaves"))), queue)
        from_bands = _sent(across.where("depth > 0").select(
            (F.col("depth") * band).alias("depth"), F.col("to_a").alias("pa"), F.col("to_b").alias("pb"), "n_leaves", "saved"))
        below = added(below, from_bands)
    up = forward(fed(below), queue)
    return light.unionByName(up)


def prefix_trie(turns: DataFrame, convs: DataFrame, shard: int = SHARD_TURNS, band: int = BAND, queue: int = QUEUE) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, depth, length, a, b, size) of ``convs`` (conv_id, length): conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256 and n_ends."""
    rows = common.materialise(prefixes(turns))
    nodes = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("size").alias("size"), F.min("pa").alias("pa"),
        F.min("pb").alias("pb"), F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.count_if(F.col("length") == F.col("depth")).alias("n_ends"))
    zero = lambda *names: [F.lit(0).cast("long").alias(c) for c in names]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if(F.col("length") == 0).alias("n_ends"))
    nodes = common.materialise(nodes.unionByName(root.where("n_convs > 0").select(*zero(*KEY), "conv_id", "n_convs", *zero("size", "pa", "pb", "weight"), "n_ends")))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    ends = rows.where("length = depth").select("conv_id", *KEY).unionByName(convs.where("length = 0").select("conv_id", *zero(*KEY)))
    known = (nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("size")).join(parents, ["depth", "pa", "pb"], "left")
             .join(end_digests(ends), [*KEY], "left"))
    totals = subtree_totals(common.materialise(known.drop("size")), rows, shard, band, queue)
    return totals.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                         F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "n_ends")


def conversation_trie(conversations: DataFrame, shard: int = SHARD_TURNS, band: int = BAND, queue: int = QUEUE) -> DataFrame:
    """The prefix trie of ``conversations`` (conv_id, turn, role, text), rebuilt with shared heads (``with_heads``).

    Turns stand in the order of turn (null first), then role and text; null roles and texts are empty.  Equal rows count each.  Rows without
    conv_id belong to no conversation.  An empty table has no nodes; other columns are ignored."""
    return prefix_trie(*with_heads(ordered_turns(conversations)), shard, band, queue)


def brute_force(rows: list[tuple], group: int = GROUP, heads: int = HEADS) -> list[tuple]:
    """The nodes by the definition; rows: conv_id, turn, role, text."""
    own: dict[int, list] = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (
            r[0], r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        own.setdefault(c, []).append((role or "", text or ""))
    parent, depth, own_tokens, members, ends = [None], [0], [0], [[]], [[]]
    step: dict[tuple, int] = {}  # (node, turn) -> the node after it
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        node = 0
        members[0].append(c)
        for turn in own.get(c - c % group, [])[:h] + turns[h:]:
            if (node, turn) not in step:
                step[node, turn] = len(parent)
                for column, value in ((parent, node), (depth, depth[node] + 1), (own_tokens, len(turn[1])), (members, []), (ends, [])):
                    column.append(value)
            node = step[node, turn]
            members[node].append(c)
        ends[node].append(c)
    children, leaves, saved = ([0] * len(parent) for _ in range(3))
    for node in range(len(parent) - 1, -1, -1):  # a node comes after its parent
        leaves[node] = leaves[node] or 1
        saved[node] += (len(members[node]) - 1) * own_tokens[node]
        if node:
            children[parent[node]] += 1
            leaves[parent[node]] += leaves[node]
            saved[parent[node]] += saved[node]
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return [(min(m), depth[i], min(members[parent[i]]) if i else None, len(m), children[i], leaves[i], saved[i], digest(ends[i]))
            for i, m in enumerate(members) if own]


SQL = f"""
WITH turns AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, count(*) AS own, c - ((c % {GROUP}) + {GROUP}) % {GROUP} AS head,
    xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
      lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s % 2 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)) % {HEADS} AS h
  FROM turns GROUP BY c),
rebuilt AS (
  SELECT k.c, t.place, t.role, t.text FROM convs k JOIN turns t ON t.c = k.head AND t.place <= k.h
  UNION ALL SELECT k.c, t.place, t.role, t.text FROM convs k JOIN turns t ON t.c = k.c AND t.place > k.h),
paths AS (SELECT k.c, coalesce(list(struct_pack(role := r.role, text := r.text) ORDER BY r.place) FILTER (WHERE r.place IS NOT NULL), []) AS path
  FROM convs k LEFT JOIN rebuilt r ON k.c = r.c GROUP BY k.c),
members AS (SELECT c, unnest(range(len(path) + 1)) AS depth, path FROM paths),
nodes AS (SELECT path[1:depth] AS path, depth, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE depth = len(path)), '') AS ends,
    (count(*) - 1) * coalesce(length(path[1:depth][depth].text), 0) AS own
  FROM members GROUP BY path[1:depth], depth),
children AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
flagged AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.depth = c.depth AND n.path = c.path),
sums AS (SELECT path[1:d] AS path, d, sum(own) AS saved, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM flagged) GROUP BY path[1:d], d)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM flagged n JOIN sums s ON n.depth = s.d AND n.path = s.path LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""
