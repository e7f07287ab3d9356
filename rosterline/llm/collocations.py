"""Phrase collocation mining by vertical partitioning of a word-suffix tree (operator 12).

The corpus is read once and cut into blocks of about BLOCK_BYTES with a word list each; the lists meet in one vocabulary, whose frequent
words get numbers, and every block becomes a string of those numbers (0: a rare word or the end of a piece, which no phrase crosses).
The suffixes of that string, cut off after four words, form a tree.  It is partitioned vertically: word prefixes that occur at most
``budget`` times are put together into groups of less than twice the budget, in the order of the numbers; a prefix over the budget is
extended by one word and its extensions are counted and grouped in the same way, until four words are reached.  A block sends each
group the distinct suffixes below its prefixes with their number, so a very frequent suffix is one entry of a block.  A task builds the
subtree of its group alone: the sorted suffixes are the leaves, and a node's count is the total of its leaves.  Phrases are then scored,
and held against the longer ones that contain them, by joins over the table of counted phrases."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Fewest occurrences of a phrase, phrases listed per language, and the percentage of its count at which a longer phrase covers one.
MIN_COUNT, TOP, COVERED = 30, 2000, 80
#: Words in the longest phrase.
LONGEST = 4
#: Bytes of text in a block; a longer document is a block of its own.
BLOCK_BYTES = 8 << 20
#: Suffixes below the prefixes of a group: the memory of a subtree.  In a corpus of more than BUDGET * MOST_HEAVY words it grows, so that
#: at most MOST_HEAVY prefixes of a length are over it: these, and as many group bounds, are what every task is told (8 MB of each).
BUDGET, MOST_HEAVY = 1 << 16, 1 << 20
NO_LANGUAGE = "und"

_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_ENDS_WORD = _ENDS_PIECE.copy()
_ENDS_WORD[[0x20, 9]] = True


def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length, as compressed byte planes."""
    values = np.concatenate(columns).astype("<i8")
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(raw: bytes, columns: int = 1) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").reshape(columns, -1)


def word_array(texts: common.Texts) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of some texts, and whether a piece begins with each."""
    data = common._LOWER[texts.data]
    start, end, bounds = common.word_bounds(data, texts.bounds, _ENDS_WORD)
    size = np.concatenate([[0], np.cumsum(end - start)])
    letters = data[~_ENDS_WORD[data]]
    ends = np.concatenate([[0], np.cumsum(_ENDS_PIECE[data])])
    first = np.zeros(len(start) + 1, bool)
    first[bounds[:-1]] = True
    first[1:-1] |= ends[start[1:]] != ends[end[:-1]]
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(size), pa.py_buffer(letters)]), first[:-1]


def blocks(docs: DataFrame) -> DataFrame:
    """block, lang, stream (places in ``words`` from 1, in text order, 0 between pieces), words, counts; docs: lang, text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, {}, 0
        for rows in common.steps(batches):
            langs = rows.column("lang").dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                words, first = word_array(common.Texts(rows.column("text").filter(pc.equal(langs.indices, code))))
                if len(words):
                    chunks = held.setdefault(lang, ([], []))
                    chunks[0].append(words)
                    chunks[1].append(first)
            size += rows.column("text").nbytes
            if size >= BLOCK_BYTES:
                for lang, chunks in held.items():
                    yield block_row(number, lang, *chunks)
                    number += 1
                held, size = {}, 0
        for lang, chunks in held.items():
            yield block_row(number, lang, *chunks)
            number += 1

    def block_row(number: int, lang: str, words: list[pa.Array], first: list[np.ndarray]) -> pa.RecordBatch:
        coded = pa.chunked_array(words).dictionary_encode().combine_chunks()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.chunk(0)
        at = coded.indices.to_numpy()
        counts = np.bincount(at, minlength=len(coded.dictionary))
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(1, len(order) + 1)
        stream = np.insert(place[at], np.flatnonzero(np.concatenate(first)), 0)
        listed = coded.dictionary.take(pa.array(order)).cast(pa.large_string()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([lang]), pa.array([packed(stream)], pa.binary()),
             pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), listed),
             pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), pa.array(counts[order], pa.int64()))],
            ["block", "lang", "stream", "words", "counts"])

    text = common.small_batches(docs).select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text")
    return text.mapInArrow(find, "block long, lang string, stream binary, words array<string>, counts array<long>")


@dataclass
class Partition:
    """Where the suffixes of a prefix belong.  A prefix of one word is its number, one of two words is a * base + b, one of three is
    (place of its first two in ``heavy[1]``) * base + c.  ``heavy[i]``: the prefixes of i + 1 words over the budget, ascending;
    ``starts[i]``: the first prefix of every group of such prefixes."""

    base: int
    heavy: list[np.ndarray] = field(default_factory=list)
    starts: list[np.ndarray] = field(default_factory=list)

    def first_group(self, depth: int) -> int:
        return sum(len(s) for s in self.starts[:depth - 1])

    def extended(self, suffixes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Which suffixes (a, b, c, d) have ``depth`` words below a heavy prefix of one word less, and these prefixes of ``depth`` words."""
        at = np.arange(suffixes.shape[1])
        key = suffixes[0]
        for i, heavy in enumerate(self.heavy[:depth - 1]):
            place = np.minimum(np.searchsorted(heavy, key), max(0, len(heavy) - 1))
            known = heavy[place] == key if len(heavy) else np.zeros(len(key), bool)
            at, place = at[known], place[known]
            more = suffixes[i + 1, at] > 0
            at, place = at[more], place[more]
            key = (place if i else heavy[place]) * self.base + suffixes[i + 1, at]
        return at, key

    def groups(self, suffixes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places of suffixes, their groups), for each length of the prefixes."""
        for depth in range(1, min(len(self.starts), LONGEST - 1) + 1):
            at, key = self.extended(suffixes, depth)
            heavy = self.heavy[depth - 1]
            light = ~np.isin(key, heavy) if len(heavy) else np.ones(len(key), bool)
            at, key = at[light], key[light]
            yield at, self.first_group(depth) + np.searchsorted(self.starts[depth - 1], key, "right") - 1


def suffixes_of(stream: np.ndarray) -> np.ndarray:
    """(a, b, c, d) of every suffix of at least two words, 0 after its end."""
    n = len(stream)
    ends = np.concatenate([stream, np.zeros(LONGEST, np.int64)])
    out = np.stack([ends[i:i + n] for i in range(LONGEST)])
    out = out[:, (out[0] > 0) & (out[1] > 0)]
    out[3, out[2] == 0] = 0
    return out


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for raw in batch.column("ids"):
            yield suffixes_of(unpacked(raw.as_py())[0])


def extension_counts(encoded: DataFrame, partition: Partition, depth: int) -> DataFrame:
    """key, n: how often each prefix of ``depth`` words below a heavy one occurs."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for suffixes in _streams(batches):
            key, n = np.unique(partition.extended(suffixes, depth)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], ["key", "n"])

    return encoded.select("ids").mapInArrow(find, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _by_leaf(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct rows of all but the last column, ascending, and the totals of the last."""
    *keys, n = columns
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    return (*[k[first] for k in keys], np.add.reduceat(n[order], first) if len(first) else n[:0])


def leaves(encoded: DataFrame, partition: Partition) -> DataFrame:
    """group, leaves: the distinct suffixes of a block that belong to the group, with their number."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for suffixes in _streams(batches):
            at, group = (np.concatenate(x) for x in zip(*partition.groups(suffixes)))
            suffixes = suffixes[:, at]
            group, front, back, n = _by_leaf(group, suffixes[0] * partition.base + suffixes[1], suffixes[2] * partition.base + suffixes[3],
                                             np.ones(len(at), np.int64))
            edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])) if len(group) else np.zeros(1, np.int64)
            for first in range(0, len(edges) - 1, 4096):
                some = list(zip(edges[first:first + 4096].tolist(), edges[first + 1:first + 4097].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group[[i for i, _ in some]], pa.int64()), pa.array([packed(front[i:j], back[i:j], n[i:j]) for i, j in some], pa.binary())],
                    ["group", "leaves"])

    return encoded.select("ids").mapInArrow(find, "group long, leaves binary")


def subtrees(parts: DataFrame, partition: Partition, least: int) -> DataFrame:
    """a, b, c, d, n: the nodes of two words and more that occur ``least`` times.  A group is built alone; below a heavy pair the pair
    itself is spread over groups and not counted here."""
    base, pairs_split = partition.base, partition.first_group(3)

    def build(table: pa.Table) -> pa.Table:
        front, back, n = np.concatenate([unpacked(x.as_py(), 3) for x in table["leaves"]], axis=1)
        front, back, n = _by_leaf(front, back, n)
        third = back // base
        found = []
        for depth, keys, there in ((2, (front,), np.ones(len(front), bool)), (3, (front, third), third > 0), (4, (front, back), back % base > 0)):
            if depth == 2 and table["group"][0].as_py() >= pairs_split:
                continue
            *keys, total = _by_leaf(*[k[there] for k in keys], n[there])
            often = total >= least
            a, b = np.divmod(keys[0][often], base)
            c, d = np.divmod(keys[1][often], base) if depth == 4 else (keys[1][often] if depth == 3 else a * 0, a * 0)
            found.append(np.stack([a, b, c, d, total[often]]))
        return pa.Table.from_arrays([pa.array(c) for c in np.concatenate(found, axis=1)], ["a", "b", "c", "d", "n"])

    return parts.groupBy("group").applyInArrow(build, "a long, b long, c long, d long, n long")


def vocabulary(listed: DataFrame, least: int) -> DataFrame:
    """id (from 1, the most frequent word first), lang, word, n of the words that occur ``least`` times."""
    counted = listed.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    # rare words tie in great numbers, so they need more than their count to spread over the ranges
    return common.in_order(counted, [F.desc("n"), F.col("word"), F.col("lang")], F.col("n")).select(F.col("_place").alias("id"), "lang", "word", "n", "_before")


def encode(coded: DataFrame, listed: DataFrame, words: DataFrame) -> DataFrame:
    """block, ids: the numbers of the words of each block, 0 for rare words and between pieces."""
    numbers = listed.join(words.select("lang", "word", "id"), ["lang", "word"]).select("block", "place", "id")

    def number(known: pa.Table, streams: pa.Table) -> pa.Table:
        out = []
        for raw in streams["stream"]:
            stream = unpacked(raw.as_py())[0]
            ids = np.zeros(int(stream.max(initial=0)) + 1, np.int64)
            ids[known["place"].to_numpy()] = known["id"].to_numpy()
            ids = ids[stream]
            out.append(packed(ids[(ids > 0) | (np.concatenate([[0], ids[:-1]]) > 0)]))
        return pa.Table.from_arrays([streams["of"], pa.array(out, pa.binary())], ["block", "ids"])

    streams = coded.select(F.col("block").alias("of"), "stream").withColumn("of", F.col("of") + 0)
    return numbers.groupBy("block").cogroup(streams.groupBy("of")).applyInArrow(number, "block long, ids binary")


def prefix_groups(encoded: DataFrame, words: DataFrame, total: int, budget: int) -> tuple[Partition, list[DataFrame]]:
    """The partition of the suffix tree, and the counts of the extensions of heavy prefixes of one, two and three words."""
    partition = Partition(base=(words.agg(F.max("id")).first()[0] or 0) + 1)
    counts = words.select(F.col("id").alias("key"), "n", "_before")
    extended = []
    for depth in range(1, LONGEST + 1):
        heavy = counts.where(F.col("n") > budget).select("key") if depth < LONGEST else None
        if heavy is not None:  # at most total / budget prefixes
            partition.heavy.append(np.sort(np.array([r.key for r in heavy.collect()], np.int64)))
            light = counts.where(F.col("n") <= budget)
            if depth > 1:
                light = common.in_order(light, [F.col("key")], F.col("n"))
            first = light.groupBy(F.expr(f"_before DIV {budget}")).agg(F.min("key").alias("key"))  # as many at most, and one more
            partition.starts.append(np.sort(np.array([r.key for r in first.collect()], np.int64)))
            if not len(partition.heavy[-1]):
                break
            counts = common.materialise(extension_counts(encoded, partition, depth + 1))
            extended.append(counts)
    return partition, extended


def count_phrases(docs: DataFrame, least: int = MIN_COUNT, budget: int = BUDGET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, totals) of ``docs`` (lang, text): a, b, c, d, n of every phrase of two to four words that occurs ``least`` times,
    as numbers of words (0: none); id, lang, word, n; and lang, n of all word occurrences."""
    coded = common.materialise(blocks(docs))
    listed = coded.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "block", "lang", (F.col("pos") + 1).alias("place"), F.col("col.words").alias("word"), F.col("col.counts").alias("n"))
    totals = common.materialise(coded.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n"))
                                .groupBy("lang").agg(F.sum("n").alias("n")))
    total = totals.agg(F.sum("n")).first()[0] or 0
    words = common.materialise(vocabulary(listed, least))
    encoded = common.materialise(encode(coded, listed, words))
    partition, extended = prefix_groups(encoded, words, total, max(budget, total // MOST_HEAVY))
    found = subtrees(leaves(encoded, partition), partition, least)
    for depth, counts in enumerate(extended, 2):  # nodes that are spread over groups, and all of four words below heavy ones
        limit = F.lit(least) if depth == LONGEST else F.lit(max(budget, total // MOST_HEAVY) + 1)
        found = found.unionByName(_named(counts.where(F.col("n") >= limit), partition, depth))
    return common.materialise(found), words.drop("_before"), totals


def _named(counts: DataFrame, partition: Partition, depth: int) -> DataFrame:
    """a, b, c, d, n of counted extensions (key, n)."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, parts = batch.column("key").to_numpy(), []
            for i in range(depth - 1, 0, -1):
                key, last = np.divmod(key, partition.base)
                parts.insert(0, last)
                if i > 1:
                    key = partition.heavy[i - 1][key]
            parts = [key, *parts] + [key * 0] * (LONGEST - depth)
            yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts] + [batch.column("n")], ["a", "b", "c", "d", "n"])

    return counts.select("key", "n").mapInArrow(name, "a long, b long, c long, d long, n long")


_IDS = ["a", "b", "c", "d"]


def _part(*ids: str) -> list[Column]:
    return [F.col(i) for i in ids] + [F.lit(0).cast("long")] * (LONGEST - len(ids))


def uncovered(phrases: DataFrame, covered: int = COVERED) -> DataFrame:
    """The phrases that no longer one contains with ``covered`` percent of their count."""
    part = lambda *ids: F.struct(*[c.alias(f"p{i}") for i, c in zip(_IDS, _part(*ids))])
    inside = F.when(F.col("d") > 0, F.array(*[part(*p) for p in ("ab", "bc", "cd", "abc", "bcd")])).otherwise(F.array(part("a", "b"), part("b", "c")))
    longer = phrases.where("c > 0").select("n", F.explode(inside).alias("p")).groupBy("p").agg(F.max("n").alias("longer"))
    longer = longer.select(*[F.col(f"p.p{i}").alias(i) for i in _IDS], "longer")
    return phrases.join(longer, _IDS, "left").where(F.expr(f"longer IS NULL OR 100 * longer < {covered} * n")).drop("longer")


def scored(candidates: DataFrame, phrases: DataFrame, words: DataFrame) -> DataFrame:
    """a, b, c, d, n of the candidates with lang, score and the l and r of their lowest-scoring cut."""
    cut = lambda k, side, ids: F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), *[c.alias(f"p{i}") for i, c in zip(_IDS, _part(*ids))])
    cuts = lambda ids: F.array(*[x for k in range(1, len(ids)) for x in (cut(k, "l", ids[:k]), cut(k, "r", ids[k:]))])
    asked = candidates.select(*_IDS, "n", F.explode(F.when(F.col("d") > 0, cuts("abcd")).when(F.col("c") > 0, cuts("abc")).otherwise(cuts("ab"))).alias("cut"))
    asked = asked.select(*_IDS, "n", "cut.k", "cut.side", *[F.col(f"cut.p{i}").alias(f"p{i}") for i in _IDS])
    counted = phrases.select(*[F.col(i).alias(f"p{i}") for i in _IDS], F.col("n").alias("f"), F.lit(None).cast("string").alias("lang")).unionByName(
        words.select(F.col("id").alias("pa"), *[F.lit(0).cast("long").alias(f"p{i}") for i in "bcd"], F.col("n").alias("f"), "lang"))
    met = asked.join(counted, [f"p{i}" for i in _IDS])
    is_cut = lambda k, side: (F.col("k") == k) & (F.col("side") == side)
    sums = met.groupBy(*_IDS, "n").agg(
        F.max(F.when(is_cut(1, "l"), F.col("lang"))).alias("lang"),
        *[F.max(F.when(is_cut(k, side), F.col("f"))).alias(f"{side}{k}") for k in range(1, LONGEST) for side in "lr"])
    one = lambda k: F.when(F.col(f"l{k}").isNotNull(), F.struct(
        F.expr(f"CAST((CAST(n AS DECIMAL(20, 0)) * 2000000) DIV (CAST(l{k} AS DECIMAL(20, 0)) + r{k}) AS LONG)").alias("score"),
        F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    return (sums.withColumn("cut", F.array_min(F.array(*[one(k) for k in range(1, LONGEST)])))
            .select("lang", *_IDS, "n", "cut.score", "cut.l", "cut.r"))


def mine(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP, covered: int = COVERED, budget: int = BUDGET) -> DataFrame:
    """The best phrases of each language of ``docs`` (lang, text): lang, rank, phrase, a (its count), l, r (the counts of the two parts of its
    lowest-scoring cut), n (word occurrences of the language), score.

    Null texts are empty; a null lang is ``und``, together with rows that say so.  Equal rows count each.  Texts without words and
    languages without a phrase give no row; an empty table gives an empty table; other columns are ignored."""
    phrases, words, totals = count_phrases(docs, least, budget)
    ranked = common.materialise(scored(uncovered(phrases, covered), phrases, words))
    # rows that tie with the last place stay until their words decide
    near = ranked.withColumn("_rank", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("n")))).where(F.col("_rank") <= top)
    ids = F.filter(F.array(*_IDS), lambda i: i > 0)
    named = near.select("*", F.posexplode(ids).alias("pos", "id")).join(words.select("id", "word"), "id")
    named = named.groupBy("lang", *_IDS, "n", "score", "l", "r").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    named = named.withColumnRenamed("n", "a_")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a_"), "phrase")
    named = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return named.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("a_").alias("a"), "l", "r", "n", "score")


SQL = rf"""
WITH texts AS (SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts)),
grams AS (SELECT lang, g.n, w[g.i:g.i + g.n - 1] AS p
  FROM (SELECT lang, w, unnest(list_transform(range(4 * len(w)), lambda x: {{'n': x // len(w) + 1, 'i': x % len(w) + 1}})) AS g FROM pieces WHERE len(w) > 0)
  WHERE g.i + g.n - 1 <= len(w)),
f AS (SELECT lang, p, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
totals AS (SELECT lang, CAST(count(*) AS BIGINT) AS n FROM grams WHERE n = 1 GROUP BY lang),
c AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1),
inside AS (SELECT lang, p[s.i:s.j] AS p, max(a) AS longer
  FROM (SELECT lang, p, a, unnest([{{'i': 1, 'j': 2}}, {{'i': 2, 'j': 3}}, {{'i': 3, 'j': 4}}, {{'i': 1, 'j': 3}}, {{'i': 2, 'j': 4}}]) AS s FROM c)
  WHERE s.j <= len(p) AND s.j - s.i + 1 < len(p) GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN inside i ON c.lang = i.lang AND c.p = i.p WHERE i.longer IS NULL OR 100 * i.longer < {COVERED} * c.a),
cuts AS (SELECT k.lang, k.p, k.a, x.k, l.f AS l, r.f AS r, 2000000 * k.a // (l.f + r.f) AS score
  FROM kept k, (VALUES (1), (2), (3)) AS x(k), f l, f r
  WHERE x.k < len(k.p) AND l.lang = k.lang AND l.p = k.p[1:x.k] AND r.lang = k.lang AND r.p = k.p[x.k + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT *, array_to_string(p, ' ') AS phrase FROM best)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked) JOIN totals USING (lang)
WHERE rank <= {TOP}
"""
