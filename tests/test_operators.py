"""Rules on hand-made rows: invariants of the merge, histories, diffs, addresses, files and sinks."""

import datetime as dt
import gzip
import random

import pytest
from pyspark.sql import functions as F

from rosterline.functions.addresses import keccak256
from rosterline.functions import constants as K
from rosterline.operators import crypto, history, ledgers, master, monitoring, screening, sequences, snapshots
from rosterline.operators.sequences import look_back
from rosterline.sources import documents, party_xml, sinks, text

MASTER = ("match_key string, display_name string, status string, risk_type string, risk_level string, first_seen_ms bigint, last_updated_ms bigint, "
          "sources array<string>, categories array<string>, remark string, invalid_reason string, review_flag string, variants array<string>")
RECORD = "name string, category string, ord bigint"


def empty_master(spark):
    return spark.createDataFrame([], MASTER)


def merged(spark, base, rows, source="OFAC", ts=1, **kw):
    return master.merge(base, spark.createDataFrame(rows, RECORD), source, ts, **kw)


def fixed(spark, df):
    """Cut lineage between merge rounds the way a job does with a written table."""
    return spark.createDataFrame(master.new_master(df).collect(), MASTER)


def test_merge_twice_changes_nothing_and_keeps_rows(spark):
    rows = [("Alpha One", "SDN", 1), ("ALPHA one", "CONS", 2), ("12345", "SDN", 3), ("AB", "SDN", 4), ("X不明", "SDN", 5)]
    first = fixed(spark, merged(spark, empty_master(spark), rows))
    got = {r["match_key"]: r for r in first.collect()}
    assert set(got) == {"alphaone", "12345", "ab"}
    assert got["alphaone"]["display_name"] == "Alpha One" and got["alphaone"]["remark"] == "制裁リスト（OFAC：CONS、SDN）"
    assert got["12345"]["status"] == K.INACTIVE and got["ab"]["review_flag"].startswith("2文字")
    again = merged(spark, first, rows, ts=9)
    assert again.filter("kind IS NOT NULL").count() == 0
    gone = fixed(spark, merged(spark, first, rows[:1], ts=9))
    assert gone.count() == 3
    ab = gone.filter("match_key = 'ab'").first()
    assert (ab["status"], ab["invalid_reason"], ab["sources"]) == (K.INACTIVE, K.DELISTED, [])
    back = fixed(spark, merged(spark, gone, rows, ts=10)).filter("match_key = 'ab'").first()
    assert (back["status"], back["invalid_reason"], back["sources"]) == (K.ACTIVE, "", ["OFAC"])


def test_merge_leaves_other_sources_alone_and_reports_held_removals(spark):
    base = fixed(spark, merged(spark, empty_master(spark), [("Beta", "X", 1), ("Gamma", "X", 2)], source="財務省"))
    other = fixed(spark, merged(spark, base, [("Beta", "SDN", 1)]))
    assert {r["match_key"]: r["sources"] for r in other.collect()} == {"beta": ["OFAC", "財務省"], "gamma": ["財務省"]}
    held = merged(spark, other, [("Delta", "SDN", 1)], delist=False)
    diff = master.diff_of(held, "OFAC").filter("kind = 'removed'").first()
    assert diff["match_key"] == "beta" and diff["delisted"] is False and diff["before"] == diff["after"]
    labels = [r["kind_label"] for r in master.diff_rows(master.classify_backfill(master.diff_of(held, "OFAC"), base.limit(0))).collect()]
    assert sorted(labels) == ["掲載終了候補（要確認）", "追加"]


def test_diff_text_carries_changed_reason(spark):
    schema = ("source string, kind string, match_key string, name string, delisted boolean, origin string, "
              "before struct<remark:string,invalid_reason:string,review_flag:string>, after struct<remark:string,invalid_reason:string,review_flag:string>")
    df = spark.createDataFrame([("OFAC", "changed", "k", "n", None, None, ("R", "", ""), ("R", "why", ""))], schema)
    row = master.diff_rows(df).first()
    assert (row["before_text"], row["after_text"]) == ("R | invalid_reason=—", "R | invalid_reason=why")


def test_screening_prefers_exact_over_relaxed(spark):
    base = merged(spark, empty_master(spark), [("Acme (UK)", "S", 1), ("Acme UK", "S", 2), ("Solo (X)", "S", 3)])
    q = spark.createDataFrame([(1, "ACME（UK）"), (2, "(Acme) UK"), (3, "Solo X"), (4, "none")], "query_id int, query string")
    got = {}
    for r in screening.screen_names(q, master.new_master(base)).collect():
        got.setdefault((r["query_id"], r["decision"], r["match_type"]), set()).add(r["candidate_key"])
    assert got == {(1, "HIT", "EXACT"): {"acme(uk)"}, (2, "REVIEW", "PARENTHESIS_RELAXED"): {"acme(uk)", "acmeuk"},
                   (3, "HIT", "PARENTHESIS_RELAXED"): {"solo(x)"}, (4, "NO_HIT", "NONE"): {""}}


def test_search_matches_brute_force(spark):
    import random

    rng = random.Random(3)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    terms = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(25)]
    names = spark.createDataFrame(list(enumerate(words)), "name_id bigint, name string")
    asked = spark.createDataFrame(list(enumerate(terms)), "term_id bigint, term string")
    got = {(r["term_id"], r["name_id"], r["match"]) for r in screening.search_names(asked, names).collect()}
    want = {(t, i, "完全一致" if a == b else "部分一致") for t, a in enumerate(terms) if len(a) >= 2 for i, b in enumerate(words) if a in b or b in a}
    assert got == want


def test_search_equals_brute_force_where_half_of_all_names_hold_a_term(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    names = [(i, ("zeta" + word(rng.randint(0, 9))) if i % 2 else word(rng.randint(1, 12))) for i in range(300)]
    names += [(900, "Ａbc"), (901, "a"), (902, ""), (903, None), (904, "zeta"), (905, "zeta"), (906, "q" * 70)]
    terms = [("t0", "zeta"), ("t1", "zeta"), ("t2", "b"), ("t3", "xx" + "q" * 70 + "zetaab"), ("t4", None), ("t5", "q" * 64)]
    terms += [(f"r{i}", word(rng.randint(2, 14))) for i in range(60)]
    shown = lambda s: (s or "").replace("Ａ", "a").lower()
    want = set()
    for t, term in terms:
        a = shown(term)
        hits = [(0 if a == shown(n) else 1, 0 if a == shown(n) else len(n), i) for i, n in names
                if len(a) >= 2 and n and (a in shown(n) or shown(n) in a)]
        want |= {(t, rank, i) for rank, (_, _, i) in enumerate(sorted(hits), 1)}
    asked, listed = spark.createDataFrame(terms, "term_id string, term string"), spark.createDataFrame(names, "name_id bigint, name string")
    got = screening.search_names(asked, listed).select("term_id", "rank", "name_id").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert sum(t == "t0" for t, _, _ in want) > 150
    assert screening.search_names(asked, listed.limit(0)).count() == 0 == screening.search_names(asked.limit(0), listed).count()


def test_first_snapshot_is_a_baseline(spark):
    schema = "list string, party_id string, name string, match_key string, first_seen_ms bigint, last_changed_ms bigint, alias_current boolean, party_current boolean, formats array<string>, primary boolean, low_quality boolean"
    records = spark.createDataFrame([("SDN", "1", "A", "adv", True, False), ("SDN", "1", "A", "csv", False, True)],
                                    "list string, party_id string, name string, format string, alias_primary boolean, low_quality boolean")
    none = spark.createDataFrame([], schema)
    assert history.party_changes(none, records).count() == 0
    row = history.update_history(none, records, 5).first()
    assert (row["low_quality"], row["primary"], row["formats"], row["is_new"]) == (False, True, ["adv", "csv"], True)


def test_moved_alias_is_not_structural_and_fullwidth_is_cosmetic(spark):
    cols = ["番号", "氏名（英語）", "別名・別称（英語）", "確定に十分でない別名（英語）", "生年月日", "国連参照番号"]
    schema = ", ".join(f"`{c}` string" for c in cols)
    before = spark.createDataFrame([("1", "Ann", "", "Bee", "1960年５月07日", "Q1")], schema)
    after = spark.createDataFrame([("1", "ＡＮＮ", "Bee", "", "1960年5月7日", "Q1")], schema)
    rows = {r["field"]: r for r in snapshots.classify_impact(snapshots.field_changes(snapshots.pair_records(before, after))).collect()}
    assert rows["氏名（英語）"]["impact"] == K.IMPACT_COSMETIC and rows["生年月日"]["impact"] == K.IMPACT_COSMETIC
    assert rows["別名・別称（英語）"]["impact"] == K.IMPACT_IDENTITY and rows["別名・別称（英語）"]["material"]


def test_look_back_crosses_buckets(spark):
    df = spark.range(100).select(F.lit(1).alias("p"), F.col("id").alias("i"), F.when(F.col("id") % 17 == 3, F.col("id")).alias("v"))
    got = look_back(df, ["p"], F.floor(F.col("i") / 5), ["i"], F.col("v"), "last", inclusive=True).orderBy("i").collect()
    assert [r["last"] for r in got] == [None if i < 3 else (i - 3) // 17 * 17 + 3 for i in range(100)]


def test_look_back_splits_full_buckets(spark):
    rng = random.Random(2)
    base = dt.datetime(2026, 1, 1)
    rows = [("hot" if i % 10 else rng.choice(["a", None]), base + dt.timedelta(seconds=rng.randrange(3600) if i % 10 else rng.randrange(90_000)), i,
             rng.choice([None, None, i])) for i in range(6000)]
    df = spark.createDataFrame(rows, "p string, ts timestamp, ord long, v long").repartition(4)
    hour, second = F.date_trunc("hour", "ts"), F.date_trunc("second", "ts")
    sizes = sequences.bucketed(df, ["p"], hour, second, full=50).groupBy("p", "__bucket", "__fine").count().agg(F.max("count")).first()[0]
    assert sizes <= 50
    for inclusive in (True, False):
        got = look_back(df, ["p"], hour, ["ts", "ord"], F.col("v"), "out", inclusive=inclusive, finer=second, full=50).collect()
        plain = look_back(df, ["p"], hour, ["ts", "ord"], F.col("v"), "out", inclusive=inclusive).collect()
        wanted, last = {}, {}
        for p, _, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
            before = last.get(p)
            last[p] = before if v is None else v
            wanted[i] = last[p] if inclusive else before
        assert {r["ord"]: r["out"] for r in got} == wanted == {r["ord"]: r["out"] for r in plain}


VECTORS = [
    ("ETH", "0x5aAeb6053F3E94C9b9A09f33669435E7Ef1BeAed", "CHECKSUM_VALID", "EIP55"),
    ("ETH", "0x5aAeb6053F3E94C9b9A09f33669435E7Ef1Beaed", "INVALID", "EIP55"),
    ("XBT", "BC1QW508D6QEJXTDG4Y5R3ZARVARY0C5XW7KV8F3T4", "CHECKSUM_VALID", "BECH32"),
    ("XBT", "bc1p0xlxvlhemja6c4dqv22uapctqupfhlxm9h8z3k2e72q4k9hcz7vqzk5jj0", "CHECKSUM_VALID", "BECH32M"),
    ("XBT", "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t5", "INVALID", "BECH32"),
    ("XBT", "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa", "CHECKSUM_VALID", "BASE58CHECK"),
    ("XBT", "TR7NHqjeKQxGTCi8q8ZY4pL8otSzgjLj6t", "INVALID", "BASE58CHECK"),
    ("USDT", "TR7NHqjeKQxGTCi8q8ZY4pL8otSzgjLj6t", "CHECKSUM_VALID", "BASE58CHECK"),
    ("BCH", "bitcoincash:qpm2qsznhks23z7629mms6s4cwef74vcwvy22gdx6a", "CHECKSUM_VALID", "CASHADDR"),
    ("XRP", "rHb9CJAWyB4rj91VRWn96DkukG4bwdtyTh", "CHECKSUM_VALID", "XRP_BASE58"),
    ("XMR", "44AFFq5kSiGBoZ4NMDwYtN18obc8AemS33DBLWs3H7otXft3XjrpDtQGv7SqSsaBYBb98uNbr2VBBEt7f2wfn3RVGQBEP3A", "CHECKSUM_VALID", "MONERO_BASE58"),
    ("ETH", "0x12 34", "INVALID", "TEXT"), ("ZZZ", "whatever", "UNSUPPORTED", "UNSUPPORTED"),
]


def test_address_vectors(spark):
    df = crypto.validate_addresses(spark.createDataFrame([v[:2] for v in VECTORS], "symbol string, address string"))
    got = {(r["symbol"], r["address"]): r for r in df.collect()}
    for symbol, address, state, method in VECTORS:
        row = got[(symbol, address)]
        assert (row["validation"], row["validation_method"]) == (state, method), address
    tron = got[("XBT", "TR7NHqjeKQxGTCi8q8ZY4pL8otSzgjLj6t")]
    assert tron["network_candidates"] == ["tron-family"] and tron["network_resolution"] == "FAMILY_ONLY"
    assert keccak256(b"abc").hex().startswith("4e03657aea45a94f")


def test_queue_rejects_partial_approval(spark):
    queue = spark.createDataFrame([("e", "SDN", "s", p, "n", K.PENDING) for p in "ab"],
                                  "event_id string, list string, snapshot_sha256 string, party_id string, party_name string, status string")
    asked = spark.createDataFrame([("SDN", "s", "a"), ("SDN", "s", "z")], "list string, snapshot_sha256 string, party_id string")
    got = {r["party_id"]: r["violation"] for r in ledgers.mark_applied(queue, asked, 1).collect()}
    assert got == {"a": "PARTIAL_EVENT", "b": "PARTIAL_EVENT", "z": "NOT_PENDING"}


def test_jst_text(spark):
    df = spark.createDataFrame([("2026-09-05T20:53:06Z",), ("Wed, 10 Jan 2024 05:00:00 GMT",), ("令和6年",), (None,)], "v string")
    assert [r[0] for r in df.select(monitoring.jst_text(F.col("v"), http_dates=True)).collect()] == ["2026-09-06 05:53:06", "2024-01-10 14:00:00", "令和6年", ""]


# --- files -------------------------------------------------------------------------------

def test_list_files_in_three_charsets(spark, tmp_path):
    head = ",".join(K.LIST_COLUMNS)
    row = lambda i, name: ",".join([str(i % 3), str(i), "", "", "", name, f'"A, {i}"'] + [""] * 25)
    body = lambda i, name: f"{head}\n{row(i, name)}\n"
    (tmp_path / "a.csv").write_bytes(body(1, "山田").encode("utf-8-sig"))
    (tmp_path / "b.csv").write_bytes(body(2, "鈴木").encode("cp932"))
    (tmp_path / "c.csv.gz").write_bytes(gzip.compress(body(3, "佐藤").encode("utf-8")))
    rows = text.read_list(spark, str(tmp_path)).collect()
    assert sorted((r["番号"], r["氏名（日本語）"], r["氏名（英語）"]) for r in rows) == [("1", "山田", "A, 1"), ("2", "鈴木", "A, 2"), ("3", "佐藤", "A, 3")]


@pytest.mark.parametrize("split", [None, 50, 1000])
def test_records_with_line_breaks_across_splits(spark, tmp_path, split):
    rng = random.Random(split)
    cell = lambda i: "".join(rng.choice(["山", "é", "a", ",", '""', "\n", " ", "ソ"]) for _ in range(i % 60))
    wanted = []
    for name, charset in (("a.csv", "utf-8"), ("b.csv", "utf-8-sig"), ("c.csv", "cp932"), ("d.csv.gz", "utf-8"), ("e.csv", "utf-8")):
        records = [] if name == "e.csv" else [f'{i},"{cell(i * 7)}",x{i}' for i in range(80)]
        if charset == "cp932":
            records = [r.replace("é", "ｴ") for r in records]
        body = "".join(r + "\n" for r in records).encode(charset)
        (tmp_path / name).write_bytes(gzip.compress(body) if name.endswith("gz") else body)
        wanted += [(name, r) for r in records]
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:
        spark.conf.set(key, str(split))
    try:
        got = text.read_records(spark, str(tmp_path)).select(F.element_at(F.split("file", "/"), -1).alias("file"), "ord", "value", "violation").collect()
    finally:
        spark.conf.set(key, old)
    assert {r["violation"] for r in got} == {None}
    assert [(r["file"], r["value"]) for r in sorted(got, key=lambda r: (r["file"], r["ord"]))] == wanted


def test_record_files_that_cannot_be_cut(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('1,"a\n2,b\n')
    (tmp_path / "raw.csv").write_bytes(b"1,\x81\n2,ok\n")
    (tmp_path / "empty").mkdir()
    records = text.read_records(spark, str(tmp_path))
    assert sorted((r["file"][-7:], r["violation"], r["n"]) for r in text.file_violations(records).collect()) == [
        ("odd.csv", "UNBALANCED_QUOTES", 2), ("raw.csv", "UNDECODABLE", 1)]
    assert text.read_list(spark, str(tmp_path / "empty")).count() == 0


def test_headerless_file_and_plausibility(spark, tmp_path):
    (tmp_path / "sdn.csv").write_text('1,"X ""Q"", Ltd",-0- ,P\n-0-,-0-\n\x1a\n2,"B",individual,"Q",t,c,v,t,g,f,o,r1,r2\n')
    (tmp_path / "bad.csv").write_text("<html>\n")
    lines = text.read_lines(spark, str(tmp_path))
    assert [(r["violation"]) for r in text.content_violations(lines).collect()] == ["NOT_A_LIST"]
    rows = text.parse_headerless(lines.filter(F.endswith("file", F.lit("sdn.csv"))), text.PRIMARY_COLUMNS).orderBy("ent_num").collect()
    assert [(r["ent_num"], r["name"], r["sdn_type"], r["remarks"]) for r in rows] == [("1", 'X "Q", Ltd', None, None), ("2", "B", "individual", "r1,r2")]


XML = """<Sanctions xmlns="n" Version="3"><ReferenceValueSets><FeatureType ID="344">Digital Currency Address - XBT</FeatureType></ReferenceValueSets>
<DistinctParties><DistinctParty FixedRef="7"><Profile ID="70"><Identity ID="1" False="false"><Alias Primary="true" LowQuality="false"><DocumentedName>
<DocumentedNamePart><NamePartValue NamePartGroupID="1" ScriptID="215">Ann</NamePartValue></DocumentedNamePart>
<DocumentedNamePart><NamePartValue NamePartGroupID="2" ScriptID="215">Lee</NamePartValue></DocumentedNamePart></DocumentedName></Alias></Identity>
<Feature ID="8" FeatureTypeID="344"><FeatureVersion ID="9"><VersionDetail DetailTypeID="1432">1abc</VersionDetail></FeatureVersion></Feature></Profile></DistinctParty></DistinctParties>
<SanctionsEntries><SanctionsEntry ID="1" ProfileID="70"><SanctionsMeasure ID="2"><Comment>CYBER2</Comment></SanctionsMeasure></SanctionsEntry></SanctionsEntries></Sanctions>"""


def test_party_xml_file(spark, tmp_path):
    path = tmp_path / "a.xml"
    path.write_text(XML)
    parties = party_xml.read_elements(spark, str(path), "DistinctParty", party_xml.PARTY_SCHEMA)
    names = party_xml.party_names(parties, "SDN").collect()
    assert [(r["source_id"], r["name"], r["alias_primary"]) for r in names] == [("7", "Ann Lee", True)]
    types = party_xml.read_elements(spark, str(path), "FeatureType", party_xml.FEATURE_TYPE_SCHEMA)
    entries = party_xml.read_elements(spark, str(path), "SanctionsEntry", party_xml.ENTRY_SCHEMA)
    row = party_xml.address_features(parties, types, entries).first()
    assert (row["symbol"], row["address"], row["program"], row["entity_name"], row["violation"]) == ("XBT", "1abc", "CYBER2", "Ann Lee", None)


def test_sinks(spark, tmp_path):
    base = master.new_master(merged(spark, empty_master(spark), [(f"Name {i:02d}", "SDN", i) for i in range(30)]))
    sinks.write_master(base, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 30
    sinks.write_screening(base, str(tmp_path / "s"))
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).count() == 30
    with pytest.raises(sinks.GateError):
        sinks.write_screening(base.withColumn("display_name", F.lit(" ")), str(tmp_path / "x"))


def test_signed_urls_are_redacted(spark):
    df = spark.createDataFrame([("see https://h/p?X-Amz-Date=1&b=2#f and https://h/q?a=1#f.",)], "v string")
    assert df.select(documents.redact_urls(F.col("v"))).first()[0] == "see https://h/p and https://h/q?a=1#f."


def test_long_quoted_cells_and_open_quotes(spark):
    long = "x" * 100_000
    lines = [f'1,"{long}",z', '2,"' + '""' * 50_000 + '",z', '3,"torn', "4,,", '5,"a ""b"" c","d,e"']
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [r[0] for r in df.select(text.csv_cells(F.col("value"))).collect()]
    assert got == [["1", long, "z"], ["2", '"' * 50_000, "z"], ["3", '"torn'], ["4", "", ""], ["5", 'a "b" c', "d,e"]]


def test_places_with_one_hot_bucket_and_nulls(spark):
    rows = [(i % 10 == 0, i) for i in range(500)] + [(None, None)]
    df = spark.createDataFrame(rows, "b boolean, i int").repartition(5)
    got = sequences.numbered(df, [F.floor(F.col("i") / 400)], ["i"], "place").collect()
    assert sorted((r.place, -1 if r.i is None else r.i) for r in got) == [(1, -1)] + [(i + 2, i) for i in range(500)]


def test_look_back_keeps_rows_without_partition(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 20, None), ("p", 3, None)], "p string, i int, v string")
    got = sequences.look_back(df, ["p"], F.floor(F.col("i") / 10), ["i"], F.col("v"), "out", inclusive=True).collect()
    assert {(r.p, r.i): r.out for r in got} == {(None, 1): "a", (None, 20): "a", ("p", 3): None}


def test_first_proof_after_many_tries(spark):
    event = spark.sql("SELECT struct(1 AS log_index, 'ff' AS amount_hex) AS event").first()["event"]
    rows = [("r", f"t{i}", i, 6, "PROOF" if i >= 5 else "UNAVAILABLE" if i % 2 else "NOT_IN_BLOCK", 9, event) for i in range(1, 7)]
    df = spark.createDataFrame(rows, "relation_id string, tx_hash string, try_no int, n_candidates long, outcome string, block_number long, event struct<log_index:int,amount_hex:string>")
    got = crypto.select_proofs(df).first()
    assert (got.state, got.checked_candidates, got.unavailable_candidates, got.rejected_candidates, got.tx_hash) == ("VERIFIED", 5, 2, 2, "t5")


def test_effects_share_one_flag_table(spark):
    from rosterline.operators import history as H

    history = spark.createDataFrame(
        [("K1", "SDN", "1", False, True, True), ("K1", "SDN", "2", False, True, True), ("K2", "SDN", "1", True, True, True), ("K3", "SDN", "1", None, None, True),
         ("K3", "SDN", "3", False, False, False), (" ", "SDN", "1", False, True, True), (None, "SDN", "1", False, True, True), ("K4", "SDN", "2", False, True, True)],
        "match_key string, list string, party_id string, low_quality boolean, party_current boolean, alias_current boolean")
    parties = lambda *ids: spark.createDataFrame([("SDN", i) for i in ids], "list string, party_id string")
    flags = H.removal_flags(history, parties("1", "1"), parties("3"))
    got = {(r["match_key"], r["party_id"]): r["flags"] for r in flags.collect()}
    assert got == {("K1", "1"): 3, ("K1", "2"): 2, ("K2", "1"): 1, ("K3", "1"): 1, ("K3", "3"): 4, ("K4", "2"): 2}
    approvals = spark.createDataFrame([("SDN", "1", "s", "One"), ("SDN", "1", "s", "One"), ("SDN", "9", "s", "Nine"), ("SDN", None, "s", "None")],
                                      "list string, party_id string, snapshot_sha256 string, party_name string")
    effects = spark.createDataFrame([(k, "deactivated", k, (1,), (2,)) for k in ("K1", "K2", "K3")],
                                    "match_key string, action string, display_name string, before struct<a:int>, after struct<a:int>")
    rows = H.effect_audit(approvals, effects, H.removal_parties(flags)).collect()
    assert sorted((r["party_name"], r["match_key"], r["effect_count"]) for r in rows) == sorted(
        [("One", k, 6) for k in ("K1", "K2", "K3")] * 2 + [("Nine", "", 0), ("None", "", 0)])
