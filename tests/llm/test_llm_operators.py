"""Each training-data operator against brute force or an exact round trip, on awkward rows, hot groups and empty tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import llm_fixtures as fixtures
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterline.llm import common, fingerprints, jaccard, lm, mixing, packing, planes, quality, queries, substrings, suffixes, topk, tokens


@pytest.fixture(scope="module")
def docs(spark):
    return fixtures.frame(spark).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return fixtures.frame(spark, [])


def plain(docs) -> list[tuple]:
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# --- 1: substring dedup -------------------------------------------------------------------------------------------------

def removed(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256)).collect())


def test_substrings_by_definition(docs):
    rows = [r for r in plain(docs) if r[0] != 3]
    want = substrings.brute_force(rows)
    got = removed(substrings.remove_repeats(docs.where("doc_id <> 3")))
    assert got == sorted((d, *want[d]) for d, _ in rows)


def test_substrings_of_rows_with_one_id_are_no_earlier_than_each_other(spark):
    text = " ".join(fixtures.words(70, 9))
    got = substrings.remove_repeats(spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.n_removed) for r in got.collect()) == [(0, 0), (1, 0), (1, 0), (2, 70)]


def test_substrings_spans_are_maximal(spark):
    w = fixtures.words(200, 10)
    got = substrings.remove_repeats(spark.createDataFrame([(1, " ".join(w)), (2, " ".join(["p"] + w[20:120] + ["q"]))], "doc_id long, text string"))
    assert {r.doc_id: [tuple(s) for s in r.removed] for r in got.collect()} == {1: [], 2: [(1, 101)]}


# --- 2: mixing ----------------------------------------------------------------------------------------------------------

def test_mixing_copies_and_targets(spark):
    rows = [(i, "a b c d e" if i % 3 else "x " * (i % 40), ["src", None, "b", "c"][i % 4] if i % 2 else "hot") for i in range(4000)]
    rows += [(1, "a b c d e", "zero"), (2, None, "empty"), (3, "", "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_documents(df).join(df.select("doc_id", "source").distinct(), "doc_id").collect()
    total = sum(len((t or "").split()) for _, t, _ in rows)
    mixed = mixing.mix(df.withColumn("size", common.count_words(F.col("text")))).collect()
    by = defaultdict(list)
    for r in mixed:
        by[r.source].append(r)
        assert 0 <= r.copies <= 3
    assert sum(v[0].target for v in by.values()) == pytest.approx(total)
    for v in by.values():
        assert v[0].target <= 3 * v[0].source_size + 1e-6
        assert abs(sum(r["size"] * r.copies for r in v) - v[0].target) <= 3 * 40 + 1
    assert len(got) >= len(rows)
    again = mixing.mix(df.repartition(7).withColumn("size", common.count_words(F.col("text")))).collect()
    assert Counter((r.doc_id, r.source, r.copies) for r in again) == Counter((r.doc_id, r.source, r.copies) for r in mixed)


def test_targets_by_repeated_sharing(spark):
    sizes = {"a": 100, "b": 1, "c": 50, "d": 7, "e": 0, None: 30}
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    order = [*sorted(s for s in sizes if s), None]
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    want, open_, left = {}, set(order), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not above:
            want |= share
            break
        for s in above:
            want[s] = 3.0 * sizes[s]
            left -= want[s]
        open_ -= above
    assert got == pytest.approx(want)


def test_mixing_keeps_rows_without_a_size(spark):
    items = spark.createDataFrame([(1, "a", 5), (2, "a", None), (3, None, None)], "doc_id long, source string, size long")
    got = {r.doc_id: (r.size, r.source_size, r.copies) for r in mixing.mix(items).collect()}
    assert set(got) == {1, 2, 3} and got[2][:2] == (0, 5) and got[3] == (0, 0, 0)


def test_mixing_awkward_rows(docs, empty):
    got = mixing.mix_documents(docs).collect()
    assert len(got) == docs.count()
    assert mixing.mix_documents(empty).count() == 0


# --- 3: packing ---------------------------------------------------------------------------------------------------------

def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(common.tokenizer_path())


def token_ids(text) -> list[int]:
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [1]


def test_encoder_equals_the_library():
    texts = [r[1] for r in fixtures.awkward()] + ["Ångstrom İx ǅ", "x.", "'s 't", "!'s a's.b", "\x1c\x1dab\x85cd", "<|ENDOFTEXT|>", "1a2;b3 É.é"]
    ids, offsets = tokens.Encoder(common.tokenizer_path(), 1).encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == token_ids(text), text


def test_encoder_of_another_vocabulary_equals_the_library():
    from tokenizers import Tokenizer

    path = common.tokenizer_path("byte_bpe_50k.json")
    assert tokens.may_be_cut(common.tokenizer_path()) and not tokens.may_be_cut(path)
    texts = [r[1] for r in fixtures.awkward()] + ["Two  spaces\n\nand\tmarks!", "x.", "'s 't", "<|endoftext|>", "UPPER lower", None, ""]
    ids, offsets = tokens.Encoder(path, 50256).encode(pa.array(texts))
    library = Tokenizer.from_file(path)
    assert offsets[0] == 0 and offsets[-1] == len(ids)
    for i, text in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids + [50256], text
    assert tokens.Encoder(path, 50256).encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_encoder_with_a_full_table(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 8)
    encoder = tokens.Encoder(common.tokenizer_path(), 1)
    for seed in range(5):
        text = " ".join(fixtures.words(50, seed))
        assert encoder.encode(pa.array([text]))[0].tolist() == token_ids(text)


def test_packing_round_trip(docs, empty):
    made = packing.pieces(docs, with_ids=True)
    packed = packing.pack(made, ["doc_id", "piece", "ids_crc32"]).cache()
    rows = packed.collect()
    want = Counter()
    for d, t in plain(docs):
        ids = token_ids(t)
        for p in range(0, len(ids), 4096):
            part = ids[p:p + 4096]
            want[(d, p // 4096, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    joined = {r.sequence_id: bytes(r.ids) for r in packing.packed_sequences(packed).collect()}
    for s, parts in by.items():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == list(np.cumsum([0] + [r.length for r in parts])[:-1])
        assert sum(r.length for r in parts) <= 4096
        assert joined[s] == b"".join(bytes(r.ids) for r in parts)
    assert packing.pack_documents(empty).count() == 0


def test_bins_fit_best_and_close_the_fullest():
    bins = packing.Bins(10, 2)
    assert [bins.put(n) for n in (6, 7, 3, 9)] == [(0, 0), (1, 0), (1, 7), (2, 0)]  # 3 fills bin 1
    assert bins.put(8) == (3, 0)  # bin 2 (one free) closes, bin 0 (four free) stays
    assert bins.put(4) == (0, 6)


def test_items_that_cannot_be_packed(spark):
    items = spark.createDataFrame([(1, 5), (2, None), (3, 11), (4, -1), (5, 0), (6, 5)], "id long, length long")
    got = {r.id: r.sequence_id for r in packing.pack(items, ["id"], capacity=10).collect()}
    assert got[2] is got[3] is got[4] is None
    assert got[1] == got[6] and got[5] is not None


# --- 4: suffix arrays ---------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("crowd", [400, 2])
def test_suffixes_by_definition(docs, monkeypatch, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    got = suffixes.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", F.size("removed"), F.sha2("kept", 256)).collect()
    assert Counter(map(tuple, got)) == Counter(suffixes.brute_force(plain(docs)))


def test_suffixes_as_text_have_whole_characters(spark):
    text = "é" * 150
    got = suffixes.remove_repeats(spark.createDataFrame([(1, "z" + text), (2, text)], "doc_id long, text string"), as_text=True).collect()
    assert {r.doc_id: r.kept for r in got} == {1: "z", 2: ""}


def test_maximal_repeat_groups():
    parts = [b"xABCDEFy", b"zABCDEFw", b"qABCDr", b"qABCDs"]
    data = np.frombuffer(b"".join(parts), np.uint8)
    bounds = np.cumsum([0] + [len(p) for p in parts])
    suffix, found = suffixes.groups(data, bounds, 4)
    raw = data.tobytes()
    got = {raw[suffix[a]:suffix[a] + n]: sorted(suffix[a:b + 1].tolist()) for n, a, b in found}
    assert got == {b"ABCDEF": [1, 9], b"ABCD": [1, 9, 17, 23], b"qABCD": [16, 22]}


# --- 5: fingerprints ----------------------------------------------------------------------------------------------------

def test_fingerprints(docs, empty):
    rows = sorted([(d, t or "") for d, t in plain(docs)])
    got = sorted(fingerprints.fingerprint_documents(docs).collect(), key=lambda r: (r.doc_id, r.n_chars))
    assert len(got) == len(rows)
    want = Counter()
    for i, (d, t) in enumerate(rows):
        half = len(t) // 2
        edited = t[:len(t) - half] + rows[(i + 1) % len(rows)][1][:half]
        want[(d, len(t), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    text_of = defaultdict(set)
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        text_of[r.fingerprint].add((r.doc_id, r.n_chars))
    n = len(dict(rows)[6])
    assert any({(5, n), (6, n)} <= v for v in text_of.values())  # equal texts
    assert fingerprints.fingerprint_documents(empty).count() == 0


def test_neighbours_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", 5)
    rows = [(i * i, f"text {i} " + "word " * i) for i in range(60)] + [(None, "none"), (9, "again")]
    got = fingerprints.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = Counter()
    for i, (d, t) in enumerate(ordered):
        half = len(t) // 2
        want[(d, hashlib.sha256((t[:len(t) - half] + ordered[(i + 1) % len(ordered)][1][:half]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in got) == want


def test_order_changes_a_fingerprint(spark):
    w = fixtures.words(200, 11)
    near = w[:100] + ["new"] + w[101:]
    df = spark.createDataFrame([(" ".join(w), " ".join(near), " ".join(reversed(w)), " ".join(fixtures.words(200, 12)))], "a string, b string, c string, d string")
    fp = {c: fingerprints.fingerprint(F.col(c)) for c in "abcd"}
    r = df.select(*[fingerprints.likeness(fp["a"], fp[c]).alias(c) for c in "abcd"]).first()
    assert r.a == 1 and r.b > 0.8 and r.c < 0.2 and r.d < 0.1


# --- 6: top-k -----------------------------------------------------------------------------------------------------------

def test_top_k_by_definition(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE_CANDIDATES", 64)
    monkeypatch.setattr(topk, "TILE_QUERIES", 3)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)], "clash") for i in range(700)]
    rows += [(i, rows[3][1], "clash") for i in range(700, 760)]  # one common vector: ties
    rows += [(800, None, "x"), (900, [1.0, None, *[0.0] * 6], "x"), (1000, [float("nan")] * 8, "x"), (1100, [float("inf")] * 8, "x"), (1200, [1.0, 2.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    v = topk.quantised(df)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(v, v.where("vec_id % 100 = 0")).collect()}
    ints = {i: np.floor(np.array(x) * 1024).astype(int) for i, x, _ in rows[:760]}
    for q in range(0, 760, 100):
        best = sorted(((-int(ints[q] @ x), i) for i, x in ints.items() if i != q))[:10]
        assert [got[(q, k + 1)] for k in range(10)] == [(i, -s) for s, i in best]
    assert len(got) == 80
    assert topk.top_k(v.limit(0), v.limit(0)).count() == 0


def test_pivots_spare_evaluations():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16)) * 5000
    points = np.floor(centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 16)) * 50).astype(np.int64)
    *_, evaluated = topk.tile_top(np.arange(3000), points, np.arange(20), points[:20], 10)
    assert evaluated < 20 * 3000 / 2


# --- 7: Jaccard join ----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("tile", [512, 4])
def test_jaccard_by_definition(docs, tile):
    got = jaccard.near_components(substrings.keyed(docs), tile).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(jaccard.brute_force(plain(docs)))


def test_jaccard_chain_reaches_its_end(spark):
    w = fixtures.words(400, 13)
    rows = [(100 - i, " ".join([f"n{j}" for j in range(i)] + w[i:])) for i in range(0, 60, 6)]
    got = jaccard.near_components(substrings.keyed(spark.createDataFrame(rows, "doc_id long, text string")), 3)
    assert Counter(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect())) == Counter(jaccard.brute_force(rows))


def test_jaccard_empty(empty):
    assert jaccard.near_components(substrings.keyed(empty)).count() == 0


# --- 8: quality ---------------------------------------------------------------------------------------------------------

def test_quality_without_labels_keeps_all(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, none).select("doc_id", "score", "predicted").collect()
    assert len(got) == docs.count() and {r.predicted for r in got} == {1}
    assert quality.classify(empty, none).count() == 0


def test_quality_learns_and_holds_out(spark):
    rows = [(i, " ".join(fixtures.words(60, i)) + (" !!! $$$ " * 30 if i % 3 == 0 else ".")) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1, 0) for i in range(400)] + [(None, 1, 0), (5, None, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(df, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.predicted == (r.doc_id % 3 != 0) for r in got if r.held_out]) > 0.95
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in quality.classify(df, flipped).collect()} == {r.doc_id: r.score for r in got}


def test_quality_on_given_tables(spark):
    d = "/root/testdata/sf0.01"
    got = queries.op8_quality_classifier(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.93


# --- 9: LM scoring ------------------------------------------------------------------------------------------------------

def test_lm_by_definition(spark):
    rows = [(i, " ".join(fixtures.words(40, i, 30))) for i in range(60)] + [(60, None), (61, " "), (2, "W1 w2")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    target = {i for i in range(0, 60, 3)} | {2}
    got = lm.cross_entropy_difference(df, spark.createDataFrame([(i,) for i in target] + [(None,), (3,), (3,)], "doc_id long")).collect()
    target.add(3)
    split = [(d, [w.lower() for w in re.findall(common.WORD, t or "")]) for d, t in rows]
    vocabulary = {w for _, ws in split for w in ws}
    models = []
    for chosen in (target, {d for d, _ in rows}):
        one, two = Counter(), Counter()
        for d, ws in split:
            if d in chosen:
                one.update(ws)
                two.update(zip(["<s>", *ws], ws))
        history = Counter()
        for (h, _), n in two.items():
            history[h] += n
        total, size = sum(one.values()), len(vocabulary) + 1
        models.append(lambda h, w, one=one, two=two, history=history, total=total, size=size: -np.log(
            (two[(h, w)] + lm.SMOOTH * (one[w] + 1) / (total + size)) / (history[h] + lm.SMOOTH)))
    want = []
    for d, ws in split:
        losses = [np.mean([m(h, w) for h, w in zip(["<s>", *ws], ws)]) if ws else 0.0 for m in models]
        want.append((d, len(ws), *np.round([*losses, losses[0] - losses[1]], 9)))
    assert sorted((r.doc_id, r.n_tokens, *np.round([r.target_loss, r.background_loss, r.score], 9)) for r in got) == sorted(want)


def test_lm_knows_rare_words_in_a_large_corpus(spark, monkeypatch):
    # over 10 ** 6 tokens: single words are under 1e-5 and single bigrams under 1e-6 of them
    monkeypatch.setattr(lm, "BLOCK_BYTES", 1 << 18, raising=False)
    rows = [(i, " ".join(fixtures.words(700, i, 40))) for i in range(1600)]
    rows += [(2000, "rare pearl rare pearl"), (2001, "rare pearl"), (2002, "lonely w1 w2"), (2003, "zeal " * 3), (None, "rare"), (2001, "pearl rare")]
    target = {0, 1, 2, 2000, 2003}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = lm.cross_entropy_difference(df, spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()
    split = [(d, t.split()) for d, t in rows]
    size, models = len({w for _, ws in split for w in ws}) + 1, []
    for docs in ([x for x in split if x[0] in target], split):
        one, two, history = Counter(), Counter(), Counter()
        for _, ws in docs:
            one.update(ws)
            two.update(zip(["<s>", *ws], ws))
            history.update(["<s>", *ws][:-1])
        models.append((one, two, history, sum(one.values())))
    want = []
    for d, ws in split:
        losses = [-sum(np.log((two[p] + lm.SMOOTH * (one[p[1]] + 1) / (total + size)) / (history[p[0]] + lm.SMOOTH)) for p in zip(["<s>", *ws], ws)) / len(ws)
                  for one, two, history, total in models]
        want.append((-1 if d is None else d, len(ws), *np.round([*losses, losses[0] - losses[1]], 6)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, *np.round([r.target_loss, r.background_loss, r.score], 6)) for r in got) == sorted(want)


def test_lm_awkward_rows(spark, docs, empty):
    ids = spark.createDataFrame([], "doc_id long")
    assert lm.cross_entropy_difference(docs, ids).count() == docs.count()
    assert lm.cross_entropy_difference(empty, ids).count() == 0


# --- 10: plane files ----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("bits", [False, True])
def test_plane_files_round_trip(spark, docs, bits):
    folder = common.shared_dir(spark)
    manifest = planes.write_planes(docs, folder, bits=bits, block=500)
    got = [tuple(r) for r in planes.read_planes(manifest).orderBy("start").collect()]
    want, start = [], 0
    for d, t in sorted((d, t or "") for d, t in plain(docs)):
        ids = token_ids(t)
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    # null and empty texts of one id may change places, with equal ids
    assert got == want
    from pyarrow import fs

    row = manifest.orderBy("part").first()
    system, place = fs.FileSystem.from_uri(row.file)
    with system.open_input_file(place) as file:
        reader = planes.PlaneReader(file)
        everything = np.concatenate(list(reader.chunks()))
        assert len(everything) == row.n_ids
        assert (reader.ids(490, 30) == everything[490:520]).all()


def test_plane_files_of_nothing(spark, empty):
    manifest = planes.write_planes(empty, common.shared_dir(spark))
    assert manifest.count() == 0 and planes.read_planes(manifest).count() == 0


@pytest.mark.parametrize("bits", [False, True])
def test_planes_are_inverse(bits):
    ids = np.random.default_rng(3).integers(0, 1 << 32, 1001, dtype=np.uint64).astype(np.uint32)
    assert (planes.from_planes(planes.to_planes(ids, bits), len(ids)) == ids).all()
