"""What a query moves between tasks, on hand-made rows: it must not grow faster than its input."""

import random

import pytest
from pyspark.sql import functions as F

from rosterline.functions import remarks
from rosterline.operators import crypto, master, screening, snapshots
from rosterline.plans import registry
from rosterline.sources import documents, party_xml

registry.load()


def moved(spark, df):
    """(rows, bytes) that the stages of a run write to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    stages = lambda: store.stageList(None, False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    listed = stages()
    last = max((listed.apply(i).stageId() for i in range(listed.size())), default=-1)
    df.write.format("noop").mode("overwrite").save()
    listed = stages()
    new = [s for s in (listed.apply(i) for i in range(listed.size())) if s.stageId() > last]
    return sum(s.shuffleWriteRecords() for s in new), sum(s.shuffleWriteBytes() for s in new)


def test_search_gives_hits_to_equal_terms_without_moving_them(spark):
    names = [(i, "Cu" if i % 2 else f"Copper {i:05d} cu") for i in range(2500)]
    terms = [(i, "cu" if i % 3 else f"a cu {i % 5}") for i in range(700)]
    shown = lambda s: s.replace(" ", "").lower()
    want, ranked = set(), {}
    for t, term in terms:
        a = shown(term)
        if a not in ranked:
            ranked[a] = sorted((a != shown(n), len(n) if a != shown(n) else 0, i) for i, n in names if a in shown(n) or shown(n) in a)
        want |= {(t, rank, i) for rank, (_, _, i) in enumerate(ranked[a], 1)}
    asked, listed = spark.createDataFrame(terms, "term_id bigint, term string"), spark.createDataFrame(names, "name_id bigint, name string")
    found = screening.search_names(asked, listed)
    got = found.select("term_id", "rank", "name_id").collect()
    assert len(got) == len(want) > 1_000_000 and {tuple(r) for r in got} == want
    assert moved(spark, found)[0] < 100_000


def test_search_deals_the_rows_of_one_term_to_all_tasks(spark):
    names = spark.range(20_000).select(F.col("id").alias("name_id"), F.format_string("zz%06d", F.lit(99_999) - F.col("id")).alias("name"))
    terms = spark.range(30).select(F.col("id").alias("term_id"), F.lit("ZZ").alias("term"))
    rows = screening.search_names(terms, names).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in rows) == 600_000 > 2 * max(r["count"] for r in rows)


def test_search_gives_steps_of_terms_and_names_whole(spark):
    """More terms of one key and more names of one length than one step holds, ids that are null, a text found twice in a name."""
    n, m = screening.TERMS + 4, screening.MEMBERS + 2
    names = spark.range(m).select(F.when(F.col("id") > 0, F.col("id")).alias("name_id"), F.format_string("zz%05dzz", F.lit(m) - F.col("id")).alias("name"))
    terms = spark.range(n).select(F.when(F.col("id") > 0, F.col("id")).alias("term_id"), F.lit("zz").alias("term"))
    found = screening.search_names(terms, names).groupBy("rank", "name_id", "name").agg(F.count(F.lit(1)).alias("n"), F.count("term_id").alias("ids"), F.sum("term_id").alias("sum"))
    got = {tuple(r) for r in found.collect()}
    assert got == {(i + 1, i or None, f"zz{m - i:05d}zz", n, n - 1, n * (n - 1) // 2) for i in range(m)}


def test_packed_texts_come_back_and_stay_apart(spark):
    values = ["0xab", "0xAB", "0xabc", "0xab\n", "0x", "", "plain", "«", None, "0x" + "0f" * 32]
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", crypto._packed(F.col("v")).alias("p"))
    rows = df.select("v", "p", crypto._unpacked(F.col("p")).alias("back"), F.length("p").alias("n")).collect()
    assert [r["back"] for r in rows] == values and len({bytes(r["p"]) for r in rows if r["p"] is not None}) == len(values) - 1
    assert rows[-1]["n"] == 33


def test_proofs_move_each_side_once(spark):
    """A relation's candidates share events; receipts may repeat; nothing but packed transfers and candidates moves."""
    topic, pad, a, b = "0x" + crypto.TRANSFER_TOPIC, "0x" + "0" * 24, "a" * 40, "b" * 40
    n = 300
    tx = lambda i: "0x" + f"{i:064x}"
    frame = spark.createDataFrame
    candidates = frame([("r1", tx(i), "0xC1", "0x" + a, i) for i in range(n)] + [("r1", tx(0), "0xc1", "0x" + a, -1), ("r1", tx(1), "0xc2", "0x" + b, 1), ("r2", "odd", "0xc1", "0x" + b, 0)],
                       "relation_id string, tx_hash string, contract string, subject string, seq bigint")
    receipts = frame([(tx(i), "0x1" if i % 3 else "0x0", i, tx(7000 + i)) for i in range(n)] + [(tx(2), "0x1", 2, tx(7002))], "tx_hash string, status string, block_number bigint, block_hash string")
    blocks = frame([(i, tx(7000 + i), 5) for i in range(n)], "number bigint, hash string, timestamp bigint")
    inside = frame([(i, tx(i)) for i in range(n) if i != 4] * 2, "number bigint, tx_hash string")
    data = lambda v: "0x" + f"{v:064x}"
    logs = frame([(tx(i), k, i, tx(7000 + i), False, "0xc1", [topic, pad + a, pad + b], data(9 - k)) for i in range(n) if i != 5 for k in (2, 1)]
                 + [(tx(i), 0, i, tx(7000 + i), False, "0xc1", [topic, pad + a, pad + b], data(0)) for i in range(n)] * 20,
                 "tx_hash string, log_index bigint, block_number bigint, block_hash string, removed boolean, address string, topics array<string>, data string")
    head = frame([(n - 10, 100)], "finalized_height bigint, head_time bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        proved = crypto.prove_transfers(crypto.tried_candidates(candidates), receipts, blocks, inside, logs, head)
        got = proved.select("relation_id", "tx_hash", "try_no", "outcome", "event.log_index", "event.amount_hex", "event.from_address").collect()
        rows = moved(spark, crypto.select_proofs(proved))[0]
        state = {r["relation_id"]: r for r in crypto.select_proofs(proved).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_tx = {}
    for r in got:
        by_tx.setdefault(r["tx_hash"], []).append(r)
    assert len(got) == n + 2 + 1 + 1  # both spellings of a contract, both contracts of one transaction, the repeated receipt, the odd one
    assert [r["outcome"] for r in by_tx["odd"]] == ["UNAVAILABLE"] and {r["outcome"] for r in by_tx[tx(0)]} == {"RECEIPT_NOT_SUCCESSFUL"}
    assert [(r["outcome"], r["log_index"], r["amount_hex"], r["from_address"]) for r in by_tx[tx(1)]] == [("PROOF", 1, data(8)[2:], "0x" + a)] * 2
    assert len(by_tx[tx(2)]) == 2 and by_tx[tx(4)][0]["outcome"] == "NOT_IN_BLOCK" and by_tx[tx(5)][0]["outcome"] == "TRANSFER_NOT_FOUND"
    assert by_tx[tx(n - 2)][0]["outcome"] == "NOT_FINALIZED"
    assert (state["r1"]["state"], state["r1"]["tx_hash"], state["r2"]["state"]) == ("VERIFIED", tx(1), "PARTIAL")
    assert rows < 12 * n, rows


PARTY = ('<DistinctParty FixedRef="{0}"><Profile ID="p"><Identity False="{1}"><Alias Primary="true"><DocumentedName><DocumentedNamePart>'
         '<NamePartValue NamePartGroupID="1" ScriptID="215">{2}</NamePartValue></DocumentedNamePart></DocumentedName></Alias></Identity></Profile></DistinctParty>')


def test_party_gates_read_each_element_once(spark):
    rows = [(" 5 ", "false", "Ann"), ("6", "true", "Bob"), ("7", "false", " 　"), ("8", "false", "Cy"), ("8", "false", "Cy"), ("", "false", "Di")]
    texts = spark.createDataFrame([(PARTY.format(*r),) for r in rows] + [('<DistinctParty FixedRef="9"/>',)], "element string")
    parties = texts.select(F.from_xml("element", party_xml.PARTY_SCHEMA, {"mode": "FAILFAST"}).alias("e")).select("e.*")
    found = party_xml.party_violations(parties)
    assert {tuple(r) for r in found.collect()} == {("6", "NO_NAME"), ("7", "NO_NAME"), ("8", "REFERENCE_REPEATED"), ("9", "NO_NAME"), ("", "REFERENCE_MISSING")}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1


@pytest.mark.parametrize("name", ["s3_party_names", "s3_party_gates", "s4_address_features"])
def test_elements_are_dealt_to_all_tasks_before_they_are_parsed(spark, name):
    plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().split("from_xml(")
    assert len(plan) > 1 and all("Exchange hashpartitioning(element" in after for after in plan[1:])


def test_case_queue_folds_its_cells_in_one_python_stage(spark):
    changes = snapshots.field_changes(snapshots.pair_records(*[spark.createDataFrame([("1", t, "")], "`番号` string, `氏名（英語）` string, `国連参照番号` string") for t in ("Ａ", "b")]))
    cases = snapshots.review_cases(snapshots.classify_impact(changes).select(
        F.lit("shisantouketsu20260905.csv").alias("after_raw"), F.col("after_id").alias("record_id"), F.lit("t").alias("detected_at"),
        "name", "un_reference", "pos", "field", "before", "after", "impact", "before_fold", "after_fold"))
    assert cases._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert [r["reasons"] for r in cases.collect()] == ["主名称変更"]


def test_list_lines_are_cut_once(spark):
    plan = registry.QUERIES["s1_headerless_list"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1


def test_legacy_cells_are_worked_out_per_text(spark):
    """A remark's arrays are worked out once, keys per distinct spelling; nested quotes and brackets come out as before."""
    assert remarks.remark_of(F.col("sources"), F.col("cats"))._jc.toString().count("cats") == 1
    texts = ['"" “Ann  Lee” ""', "(Ann Lee)", "Ann Lee (a.k.a. Al) x) y", "「」"] * 50
    rows = spark.createDataFrame([(t, "OFAC" if i % 2 else "外為法", i, 5, False, i) for i, t in enumerate(texts)],
                                 "raw string, remark string, first_ms bigint, last_ms bigint, was_invalid boolean, ord bigint")
    out = master.cluster_legacy(rows, 9)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Aggregate [name#")  # parents stand first
    assert {r["match_key"]: (r["variants"], r["members"], r["remark"]) for r in out.collect()} == {
        "annlee": (["Ann Lee"], 150, "制裁リスト（OFAC／外為法）"), "al": (["Al"], 50, "制裁リスト（外為法）"), "x": (["x"], 50, "制裁リスト（外為法）"), "y": (["y"], 50, "制裁リスト（外為法）")}


PAGE = ('<a href="/out.html">x</a><dl id=pressrelease><dt>9月 1日</dt></dl><!-- <div id="maincontents"> --><DIV id=\'maincontents\'><div><p>9月2日<a href="a.html"> A <b>1</b>\n</a></p></div><h2>9月3日</h2>'
        '<a href="/release/8_9_index.html">list</a><a href="/b.pdf#p">B</a><a href="/b.pdf">again</a></DIV><a href="/late.pdf">late</a>')


def _page_plan(df):
    plan = df._jdf.queryExecution()
    return plan.optimizedPlan().toString().count("regexp_extract_all("), plan.executedPlan().toString().count("Exchange hashpartitioning(")


def test_release_entries_read_and_move_a_page_once(spark):
    pages = spark.createDataFrame([(1, "https://h.example/r/i.html", PAGE), (2, "https://h.example/r/i.html", PAGE.replace("=pressrelease", "=x")), (3, "https://h.example/", None), (4, "https://h.example/", "<p>")],
                                  "page_id bigint, url string, html string")
    months = pages.selectExpr("page_id", "2026 AS year", "9 AS month_no", "true AS rolling")
    found = documents.release_entries(documents.page_anchors(pages, ["h.example"]), months)
    archive = ("archive", "https://h.example/release/8_9_index.html", "2026-09-01", "list", None)
    assert {(r["page_id"], r["kind"], r["url"], str(r["date"]), r["title"], r["violation"]) for r in found.collect()} == {
        (1, *archive), (2, *archive), (2, "notice", "https://h.example/b.pdf", "2026-09-03", "again", "UNKNOWN_LINK")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reads, moves = _page_plan(documents.release_entries(documents.page_anchors(pages, ["h.example"]), months))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (reads, moves) == (1, 2)  # the links' tokens and the months


def test_page_documents_move_only_the_main_part_once(spark):
    pages = spark.createDataFrame([(i, "https://h.example/r/i.html", "<p>x<b>y</b></p>" * 200 + PAGE) for i in range(50)], "page_id bigint, url string, html string")
    found = documents.page_documents(documents.page_anchors(pages, ["h.example"]))
    assert _page_plan(found) == (1, 1)
    assert {tuple(r) for r in found.collect()} == {(i, "https://h.example/b.pdf", "B", "attachment_pdf") for i in range(50)}
    assert moved(spark, found)[0] <= 50 * 25
    assert [r["reasons"] for r in documents.page_reasons(pages.limit(1)).collect()] == [""]


def test_only_the_tag_that_opens_a_link_moves_the_page_url(spark):
    digits = random.Random(1)
    urls = [f"https://h.example/{digits.getrandbits(160_000):040000x}/i.html" for _ in range(5)]
    pages = spark.createDataFrame([(i, u, PAGE.replace("<h2>", "<p>x</p>" * 100 + "<h2>")) for i, u in enumerate(urls)], "page_id bigint, url string, html string")
    anchors = documents.page_anchors(pages, ["h.example"])
    assert {(r["href"], r["page"] == urls[r["page_id"]], r["title"]) for r in anchors.collect()} == {
        ("a.html", True, "A 1"), ("/release/8_9_index.html", True, "list"), ("/b.pdf#p", True, "B"), ("/b.pdf", True, "again")}
    assert moved(spark, documents.page_documents(anchors))[1] < 5 * 4 * 45_000  # four links of a page; over 200 tags
