"""Listed crypto addresses: validation profile, relation ledger, probe planning and transfer proofs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.codecs import with_checksum_facts
from ..functions.rows import explode_once

# Networks of the identity, version bytes and human-readable prefixes per symbol.
LEGACY_NETWORKS = {"XBT": "bitcoin", "ETH": "ethereum", "ETC": "ethereum-classic", "TRX": "tron",
                   "LTC": "litecoin", "DOGE": "dogecoin", "DASH": "dash"}
VERIFIER_NETWORKS = {"XBT": "bitcoin", "ETH": "ethereum", "ETC": "ethereum-classic", "BSC": "bsc", "ARB": "arbitrum",
                     "BCH": "bitcoin-cash", "XMR": "monero", "SOL": "solana", "XRP": "xrp-ledger", "BNB": "bnb-beacon",
                     "LTC": "litecoin", "BSV": "bitcoin-sv", "BTG": "bitcoin-gold", "XVG": "verge", "ZEC": "zcash",
                     "TRX": "tron", "DOGE": "dogecoin", "DASH": "dash"}
VERSIONS = {"XBT": ["00", "05"], "BCH": ["00", "05"], "LTC": ["30", "32", "05"], "BSV": ["00", "05"], "BTG": ["26", "17"],
            "XVG": ["1e", "21"], "ZEC": ["1cb8", "1cbd"], "TRX": ["41"], "DOGE": ["1e", "16"], "DASH": ["4c", "10"],
            "tron-family": ["41"], "bitcoin-family": ["00", "05", "6f", "c4"]}
EVM_SYMBOLS = ["ETH", "ETC", "BSC", "ARB"]
TOKENS = ["USDT", "USDC"]
REASON_CHECKSUM = "原文のチェックサム・形式不正"
INVALID_REASONS = {
    "base58": REASON_CHECKSUM, "segwit": "SegWitの接頭辞・形式・チェックサム不整合",
    "cashaddr": "CashAddrの接頭辞・長さ・形式・チェックサム不整合", "monero": "Moneroの95/106文字形式・接頭辞・チェックサム不整合（原文保持）",
    "sol": "SolanaのBase58文字・32バイト長に不整合", "xrp": "XRP classicの接頭辞・文字・長さ・チェックサム不整合",
    "beacon": "BNB bnb形式の接頭辞・長さ・チェックサム不整合", "text": "原文の形式不正",
}
DEFAULT_REASON = "ネットワーク未確定・検証未対応"
SYMBOL_SCRIPT = "公式通貨記号XBTと形式が不整合：TRON系の形式・チェックサムに一致（原文保持）"
VALIDATION_VERSION = "3"


def _pick(c: Column, table: dict, default) -> Column:
    expr = None
    for key, value in table.items():
        expr = F.when(c == key, value) if expr is None else expr.when(c == key, value)
    return expr.otherwise(default)


def _starts(c: Column, *heads: str) -> Column:
    test = F.lit(False)
    for head in heads:
        test = test | F.startswith(c, F.lit(head))
    return test


def _routed(df: DataFrame) -> DataFrame:
    """``route`` (codec), ``family`` (multi-chain tokens only) and ``why`` (reason of an unsupported form)."""
    s, a, low = F.col("symbol"), F.col("address"), F.lower("address")
    token = s.isin(TOKENS)
    bech = low.rlike("^(bc1|tb1|bcrt1)")
    bad = (a == "") | a.rlike(r"(?U)\s")
    hrp = F.concat(F.lit("segwit:"), F.regexp_extract(low, "^([^1]*)1", 1))
    route = (
        F.when(bad, "text")
        .when(token, F.when(a.rlike("^0x[0-9a-fA-F]{64}$"), "hex32").when(_starts(a, "0x"), "hex20").when(
            (_starts(a, "T") & (F.length(a) == 34)) | (_starts(a, "1", "3", "m", "n", "2") & F.length(a).between(26, 35)), "base58").when(bech, hrp).otherwise("sol"))
        .when(s == "XBT", F.when(bech, "segwit:bc").otherwise("base58"))
        .when(s.isin(EVM_SYMBOLS), "hex20")
        .when(s == "BCH", F.when(_starts(a, "1", "3"), "base58").otherwise("cashaddr"))
        .when(s == "XMR", "monero").when(s == "SOL", "sol")
        .when(s == "XRP", F.when(_starts(a, "X", "T"), "xaddress").otherwise("xrp"))
        .when(s == "BNB", F.when(_starts(a, "0x"), "unsupported").otherwise("beacon"))
        .when((s == "LTC") & low.rlike("^t?ltcmweb1"), "unsupported")
        .when((s == "ZEC") & low.rlike("^(zs|zc|u1|utest1|tex1|textest1)"), "unsupported")
        .when((s == "LTC") & _starts(low, "ltc1"), "segwit:ltc").when((s == "BTG") & _starts(low, "btg1"), "segwit:btg").when((s == "XVG") & _starts(low, "vg1"), "segwit:vg")
        .when(s.isin("LTC", "BSV", "BTG", "XVG", "ZEC", "TRX", "DOGE", "DASH"), "base58").otherwise("unsupported"))
    df = df.withColumn("route", route)
    r = F.col("route")
    family = F.when(token, F.when(r == "hex20", "evm-family").when((r == "base58") & _starts(a, "T"), "tron-family").when(
        (r == "base58") | _starts(r, "segwit"), "bitcoin-family").when(r == "sol", "solana-family").when(r == "hex32", "hex32-family"))
    why = (
        F.when(r == "xaddress", "XRP X-address検証未対応").when(s == "BNB", "BNB通貨記号だけではBeacon/BSCを確定できない")
        .when(s == "LTC", "Litecoin MWEBアドレス検証未対応").when(s == "ZEC", "Zcash shielded/unified/TEXアドレス検証未対応")
        .when(r == "hex32", "32バイト16進アドレスのチェーン別検証未対応・実ネットワーク未確定").otherwise(DEFAULT_REASON))
    return df.withColumns({"family": family, "why": why})


def validate_addresses(rows: DataFrame) -> DataFrame:
    """Validation profile of distinct (symbol, address) pairs with the number of rows behind each.

    Equal pairs are counted map-side first.  Lower-case hex, unsupported and malformed texts are decided by
    expressions alone and reach the checksum step as NULL.
    """
    df = _routed(rows.groupBy("symbol", "address").agg(F.count(F.lit(1)).alias("n_rows")))
    s, a, r, family = F.col("symbol"), F.col("address"), F.col("route"), F.col("family")
    hex20 = a.rlike("^0x[0-9a-fA-F]{40}$")
    digits = F.substring(a, 3, 40)
    cased = hex20 & (digits != F.lower(digits)) & (digits != F.upper(digits))
    asked = F.when(r == "hex20", F.when(cased, "eip55")).when(~r.isin("text", "hex32", "unsupported", "xaddress"), r)
    df = df.withColumn("asked", asked)
    df = with_checksum_facts(df, "asked", "address")
    size, version, codec = F.coalesce("size", F.lit(-1)), F.coalesce("version", F.lit("")), F.coalesce("codec", F.lit(""))
    allowed = F.lit(False)
    for name, versions in VERSIONS.items():
        allowed = allowed | ((F.coalesce(family, s) == name) & version.isin(versions))
    seg = _starts(r, "segwit")
    own = (
        F.when(r == "text", "INVALID").when(r == "hex20", F.when(~hex20, "INVALID").when(~cased, "FORMAT_ONLY").when(codec == "EIP55", "CHECKSUM_VALID").otherwise("INVALID"))
        .when(r == "base58", F.when(allowed, "CHECKSUM_VALID").otherwise("INVALID"))
        .when(seg, F.when(codec.isin("BECH32", "BECH32M"), "CHECKSUM_VALID").otherwise("INVALID"))
        .when(r == "cashaddr", F.when(codec == "CASHADDR", "CHECKSUM_VALID").when(codec == "OTHER_TYPE", "UNSUPPORTED").otherwise("INVALID"))
        .when(r.isin("monero", "xrp", "beacon"), F.when(codec != "", "CHECKSUM_VALID").otherwise("INVALID"))
        .when(r == "sol", F.when(size == 32, "FORMAT_ONLY").when(family.isNotNull(), "UNSUPPORTED").otherwise("INVALID")).otherwise("UNSUPPORTED"))
    df = df.withColumn("own", own)
    # a token text that fails its own family may still be a 32-byte Base58 text
    fallback = family.isNotNull() & (F.col("own") == "INVALID") & (size == 32)
    df = df.withColumns({"fallback": fallback, "validation": F.when(fallback, "FORMAT_ONLY").otherwise(F.col("own"))})
    v = F.col("validation")
    route = F.when(F.col("fallback"), "sol").when(seg, "segwit").otherwise(r)
    plain = (
        F.when(v == "CHECKSUM_VALID", "")
        .when((v == "FORMAT_ONLY") & (route == "sol"), "形式正常・仕様に文字列チェックサムなし")
        .when(v == "FORMAT_ONLY", "形式正常・チェックサム情報なし（大小文字の区別なし）")
        .when((v == "UNSUPPORTED") & (r == "cashaddr"), "CashAddrのアドレス種別は検証未対応")
        .when((v == "UNSUPPORTED") & (r == "sol"), "トークンのネットワーク・アドレス種別は未確定（検証未対応）")
        .when(v == "UNSUPPORTED", F.col("why"))
        .when((s == "XBT") & (version == "41"), SYMBOL_SCRIPT)
        .when((s == "XBT") & seg, F.when(_starts(codec, "!!"), "Bitcoin mainnetの接頭辞ではない").otherwise("Bech32／Bech32mの形式・チェックサム不正"))
        .when((s == "ZEC") & (r == "base58"), "Zcash透明アドレスの接頭辞・長さ・チェックサム不整合")
        .when(r == "hex20", F.when(hex20, "EIP-55チェックサム不一致（原文保持・要確認）").otherwise("原文の形式不正"))
        .otherwise(_pick(route, INVALID_REASONS, "")))
    named = family.isNotNull() & v.isin("CHECKSUM_VALID", "FORMAT_ONLY")
    reason = F.when(named, F.rtrim(F.concat(F.lit("形式候補は正常・実ネットワーク未確定。"), plain), F.lit("。"))).otherwise(plain)
    method = (
        F.when(r == "text", "TEXT").when(route == "sol", F.when(v == "UNSUPPORTED", "UNSUPPORTED").otherwise("BASE58_32"))
        .when(r == "hex20", F.when(cased, "EIP55").otherwise("HEX20")).when(r == "base58", "BASE58CHECK")
        .when(seg, F.when(codec == "", "BECH32").otherwise(F.translate(codec, "!", ""))).when(r == "cashaddr", "CASHADDR")
        .when(r == "monero", "MONERO_BASE58").when(r == "xrp", "XRP_BASE58").when(r == "beacon", "BNB_BECH32").when(r == "xaddress", "XRP_XADDRESS").otherwise("UNSUPPORTED"))
    tron = (s == "XBT") & (v == "INVALID") & (version == "41")
    candidate = (
        F.when(named, F.when(F.col("fallback"), "solana-family").otherwise(family)).when(r == "hex32", "hex32-family").when(tron, "tron-family")
        .when(family.isNull() & v.isin("CHECKSUM_VALID", "FORMAT_ONLY"), _pick(s, VERIFIER_NETWORKS, "")).otherwise(""))
    resolution = F.when(candidate == "", "UNRESOLVED").when(named | (r == "hex32") | tron, "FAMILY_ONLY").otherwise("SYMBOL_AND_FORMAT")
    category = F.when(reason == "", "").when(v == "INVALID", "INCONSISTENCY").when(v == "UNSUPPORTED", "UNSUPPORTED").otherwise("LIMITATION")
    normal = F.when(s.isin("ETH", "ETC") & hex20, F.lower(a)).otherwise(a)
    return df.select(
        "symbol", "address", "n_rows", _pick(s, LEGACY_NETWORKS, "").alias("network"), normal.alias("normalized_address"), "validation",
        reason.alias("review_reason"), method.alias("validation_method"), category.alias("review_category"),
        F.filter(F.array(candidate), lambda c: c != "").alias("network_candidates"), resolution.alias("network_resolution"),
        version.alias("version"), F.lit(VALIDATION_VERSION).alias("validation_version"))


def attach_validation(rows: DataFrame, profile: DataFrame) -> DataFrame:
    """Validation columns on every row; a hot address is handled by the adaptive skew join."""
    return rows.join(profile.drop("n_rows"), ["symbol", "address"], "left")


def validation_profile(profile: DataFrame) -> DataFrame:
    """Rows and distinct addresses per symbol and state."""
    states = ["CHECKSUM_VALID", "FORMAT_ONLY", "INVALID", "UNSUPPORTED"]
    return profile.groupBy("symbol").agg(
        F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_addresses"),
        *[F.count_if(F.col("validation") == st).alias(st.lower()) for st in states])


# --- relation ledger ---------------------------------------------------------------------

IDENTITY = ["entity_name", "program", "address"]
VALIDATION = ["validation", "review_reason", "review_category", "network_candidates", "network_resolution"]


def relation_id(list_name: str = "SDN") -> Column:
    """Relation key: list, party, network (or symbol) and normalised address."""
    where = F.when(F.coalesce("network", F.lit("")) != "", F.col("network")).otherwise(F.concat(F.lit("symbol:"), "symbol"))
    return F.sha2(F.concat_ws("|", F.lit("OFAC"), F.lit(list_name), "party_id", where, "normalized_address"), 256)


def reconcile_ledger(previous: DataFrame, incoming: DataFrame, now: str, source_hash: str, parser_version: str, *,
                     previous_version: str | None = None, empty: bool | None = None) -> DataFrame:
    """Ledger after one extract: first row per relation, lifecycle state and the event (kind, id) it causes.

    Mentions of a relation beyond the first are evidence: they stay in long form (``ledger_evidence``) and
    are counted here.  Absent relations are kept for review, never removed.
    """
    if empty is None:
        empty = previous.isEmpty()
    upgrade = not empty and previous_version is not None and previous_version != parser_version
    base = ["party_id", "symbol", "network", "normalized_address", *IDENTITY, *VALIDATION, "validation_version"]
    keyed = incoming.withColumn("relation_id", relation_id())
    new = keyed.groupBy("relation_id").agg(
        F.min_by(F.struct(*base), F.struct("ord", "source_record_id")).alias("n"), F.count(F.lit(1)).alias("n_evidence"))
    carried = ["listing_status", "first_seen", "last_seen", "last_event_id", "last_validation_event_id", "n_evidence"]
    old = previous.select("relation_id", F.struct(*base, *carried).alias("o"))
    j = old.join(new, "relation_id", "full_outer")
    known, here = F.col("o").isNotNull(), F.col("n").isNotNull()
    changed = F.lit(False)
    for c in IDENTITY:
        changed = changed | ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    revalidated = (F.coalesce("o.validation_version", F.lit("")) != "") & ~F.col("o.validation_version").eqNullSafe(F.col("n.validation_version"))
    for c in VALIDATION:
        revalidated = revalidated | ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    was_listed = F.col("o.listing_status") == "LISTED"
    first_kind = "BASELINED" if empty else "BACKFILLED" if upgrade else "ADDED"
    kind = (
        F.when(~known, first_kind).when(~here, F.when(was_listed, "REMOVAL_CANDIDATE"))
        .when(~was_listed, "RELISTED").when(changed, "CHANGED").when(revalidated, "REVALIDATED"))
    j = j.withColumns({"kind": kind, "r": F.coalesce("n", F.struct(*[F.col(f"o.{c}").alias(c) for c in base]))})
    text = lambda c: F.coalesce(c, F.lit(""))
    chain = text(F.when(F.col("kind") == "REVALIDATED", F.col("o.last_validation_event_id")).otherwise(F.col("o.last_event_id")))
    listed_id = F.sha2(F.concat_ws(
        "|", "relation_id", chain, "kind", F.lit(source_hash), F.lit(parser_version), *[text(F.col(f"r.{c}")) for c in ("entity_name", "program", "validation")],
        text(F.col("r.validation_version")), text(F.col("r.review_reason")), text(F.col("r.review_category")), F.array_join("r.network_candidates", ";"), text(F.col("r.network_resolution"))), 256)
    removal_id = F.sha2(F.concat_ws("|", "relation_id", text(F.col("o.last_event_id")), F.lit("REMOVAL_CANDIDATE"), F.lit(source_hash)), 256)
    j = j.withColumn("event_id", F.when(F.col("kind") == "REMOVAL_CANDIDATE", removal_id).when(F.col("kind").isNotNull(), listed_id).otherwise(""))
    official = F.col("kind").isNotNull() & (F.col("kind") != "REVALIDATED")
    return j.select(
        "relation_id", *[F.col(f"r.{c}").alias(c) for c in base],
        F.when(here, "LISTED").otherwise("REMOVAL_REVIEW").alias("listing_status"),
        F.coalesce("o.first_seen", F.lit(now)).alias("first_seen"), F.when(here, now).otherwise(F.col("o.last_seen")).alias("last_seen"),
        F.when(official, F.col("event_id")).otherwise(text(F.col("o.last_event_id"))).alias("last_event_id"),
        F.when(F.col("kind") == "REVALIDATED", F.col("event_id")).otherwise(text(F.col("o.last_validation_event_id"))).alias("last_validation_event_id"),
        F.when(here, F.col("n_evidence")).otherwise(F.col("o.n_evidence")).alias("n_evidence"),
        text(F.col("kind")).alias("kind"), "event_id", text(F.col("o.listing_status")).alias("before_status"))


def ledger_evidence(incoming: DataFrame) -> DataFrame:
    return incoming.select(relation_id().alias("relation_id"), "source_record_id", "address").distinct()


def ledger_counts(ledger: DataFrame) -> DataFrame:
    """Item / value rows of the ledger: relations, unique addresses, review categories, relations per symbol."""
    listed = F.col("listing_status") == "LISTED"
    where = F.when(F.col("network") != "", F.col("network")).otherwise(F.concat(F.lit("symbol:"), "symbol"))
    category = F.when(F.col("review_reason") != "", F.when(F.col("validation") == "INVALID", "INCONSISTENCY").when(
        F.col("validation") == "UNSUPPORTED", "UNSUPPORTED").otherwise("LIMITATION"))
    one = ledger.agg(
        F.count_if(listed).alias("listed_relations"),
        F.countDistinct(F.when(listed, F.struct(where, "normalized_address"))).alias("unique_addresses"),
        F.count_if(F.col("listing_status") == "REMOVAL_REVIEW").alias("removal_review"),
        F.count_if(listed & (F.col("review_reason") != "")).alias("format_review"),
        F.count_if(listed & (category == "INCONSISTENCY")).alias("inconsistency_review"),
        F.count_if(listed & (category == "LIMITATION")).alias("validation_limitations"),
        F.count_if(listed & (category == "UNSUPPORTED")).alias("unsupported_review"))
    items = one.select(F.explode(F.create_map(*[v for c in one.columns for v in (F.lit(c), F.col(c))])).alias("item", "value"))
    symbols = ledger.filter(listed).groupBy("symbol").agg(F.count(F.lit(1)).alias("value"))
    return items.unionByName(symbols.select(F.concat(F.lit("symbol: "), "symbol").alias("item"), "value"))


def snapshot_violations(ledger: DataFrame, declared: DataFrame) -> DataFrame:
    """Published ledger against its declared counts (item, value), and per-row consistency; (scope, key, violation) rows."""
    empty = F.size("network_candidates") == 0
    category = F.when(F.col("review_reason") == "", "").when(F.col("validation") == "INVALID", "INCONSISTENCY").when(
        F.col("validation") == "UNSUPPORTED", "UNSUPPORTED").otherwise("LIMITATION")
    rules = F.array_compact(F.array(
        F.when(~F.col("relation_id").rlike("^[0-9a-f]{64}$"), "BAD_ID"),
        F.when((F.coalesce("party_id", F.lit("")) == "") | (F.coalesce("symbol", F.lit("")) == "") | (F.coalesce("address", F.lit("")) == ""), "EMPTY_FIELD"),
        F.when(~F.col("listing_status").isin("LISTED", "REMOVAL_REVIEW"), "UNKNOWN_LISTING"),
        F.when(~F.col("validation").isin("CHECKSUM_VALID", "FORMAT_ONLY", "INVALID", "UNSUPPORTED"), "UNKNOWN_VALIDATION"),
        F.when(F.col("review_category") != category, "CATEGORY_MISMATCH"),
        F.when((F.col("network_resolution") == "UNRESOLVED") != empty, "CANDIDATES_MISMATCH")))
    rows = explode_once(ledger, [F.lit("row").alias("scope"), F.col("relation_id").alias("key")], rules, "violation")
    twice = ledger.groupBy("relation_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        F.lit("row").alias("scope"), F.col("relation_id").alias("key"), F.lit("DUPLICATE_ID").alias("violation"))
    counts = declared.join(ledger_counts(ledger).withColumnRenamed("value", "actual"), "item", "left")
    wrong = counts.filter(F.col("value") != F.coalesce("actual", F.lit(0))).select(
        F.lit("count").alias("scope"), F.col("item").alias("key"), F.lit("COUNT_MISMATCH").alias("violation"))
    return rows.unionByName(twice).unionByName(wrong)


# --- probes ------------------------------------------------------------------------------

def probe_consensus(probes: DataFrame) -> DataFrame:
    """State per relation; providers are compared per chain and per contract by minima and maxima.

    ``probes``: relation_id, chain, provider, contract, status, positive, asset_match, history_error.
    """
    ok = F.col("status") == "SUCCESS"
    token = ok & (F.coalesce("contract", F.lit("")) != "")
    bit = lambda cond, c: F.when(cond, F.col(c).cast("int"))
    per_contract = probes.groupBy("relation_id", "chain", "contract").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_ok"), F.min(bit(ok, "positive")).alias("p_lo"), F.max(bit(ok, "positive")).alias("p_hi"),
        F.coalesce(F.max(bit(token, "asset_match")) - F.min(bit(token, "asset_match")), F.lit(0)).alias("a_gap"),
        F.max(bit(ok, "history_error")).alias("h"))
    per_chain = per_contract.groupBy("relation_id", "chain").agg(
        F.sum("n").alias("n"), F.sum("n_ok").alias("n_ok"), F.coalesce(F.max("p_hi") - F.min("p_lo"), F.lit(0)).alias("p_gap"),
        F.max("p_hi").alias("p_hi"), F.max("a_gap").alias("a_gap"), F.max("h").alias("h"))
    fold = per_chain.groupBy("relation_id").agg(
        F.sum("n").alias("n_probes"), F.sum("n_ok").alias("n_success"), F.max(F.greatest("p_gap", "a_gap")).alias("gap"),
        F.coalesce(F.max("p_hi"), F.lit(0)).alias("seen"), F.coalesce(F.max("h"), F.lit(0)).alias("h"))
    state = (
        F.when(F.col("gap") > 0, "CONFLICT").when(F.col("n_success") == 0, "FAILED")
        .when((F.col("n_success") < F.col("n_probes")) | (F.col("h") > 0), "PARTIAL").when(F.col("seen") > 0, "POSITIVE").otherwise("NO_EVIDENCE"))
    return fold.select("relation_id", state.alias("state"), "n_probes", "n_success")


def scan_totals(consensus: DataFrame) -> DataFrame:
    """Relations, probes and successful probes per state, with the grand total (state ALL)."""
    return consensus.rollup("state").agg(
        F.count(F.lit(1)).alias("n_relations"), F.sum("n_probes").alias("n_probes"), F.sum("n_success").alias("n_success")
    ).withColumn("state", F.coalesce("state", F.lit("ALL")))


# Issuer contracts and public providers; a registry of a dozen rows.
CONTRACTS = [
    ("USDT", "ethereum", "USDT", "0xdac17f958d2ee523a2206206994597c13d831ec7"),
    ("USDT", "avalanche", "USDT", "0x9702230a8ea53601f5cd2dc00fdbc13d4df4a8c7"),
    ("USDC", "ethereum", "USDC", "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48"),
    ("USDC", "arbitrum", "USDC", "0xaf88d065e77c8cc2239327c5edb3a432268e5831"),
    ("USDC", "base", "USDC", "0x833589fcd6edb6e08f4c7c32d4f71b54bda02913"),
    ("ETH", "ethereum", "", ""), ("ETC", "ethereum-classic", "", ""), ("BSC", "bsc", "", ""), ("ARB", "arbitrum", "", ""),
]
TRON_CONTRACT = ("tron", "USDT", "TR7NHqjeKQxGTCi8q8ZY4pL8otSzgjLj6t")
PROVIDERS = [
    ("ethereum", "PublicNode", "https://ethereum-rpc.publicnode.com"), ("ethereum", "dRPC", "https://eth.drpc.org"),
    ("ethereum-classic", "dRPC", "https://etc.drpc.org"), ("ethereum-classic", "ETC-Network.info", "https://geth-at.etc-network.info"),
    ("bsc", "PublicNode", "https://bsc-rpc.publicnode.com"), ("bsc", "dRPC", "https://bsc.drpc.org"),
    ("arbitrum", "PublicNode", "https://arbitrum-one-rpc.publicnode.com"), ("arbitrum", "Network public RPC", "https://arb1.arbitrum.io/rpc"),
    ("avalanche", "PublicNode", "https://avalanche-c-chain-rpc.publicnode.com"), ("avalanche", "Network public RPC", "https://api.avax.network/ext/bc/C/rpc"),
    ("base", "PublicNode", "https://base-rpc.publicnode.com"), ("base", "Network public RPC", "https://mainnet.base.org"),
    ("tron", "PublicNode", "https://tron-solidity-rpc.publicnode.com"), ("tron", "TronGrid", "https://api.trongrid.io"),
    ("bitcoin", "Blockstream", "https://blockstream.info/api"), ("bitcoin", "mempool.space", "https://mempool.space/api"),
    ("solana", "Solana public RPC", "https://api.mainnet-beta.solana.com"), ("solana", "PublicNode", "https://solana-rpc.publicnode.com"),
]


def _targets() -> Column:
    """Probe targets of a relation as an array expression over the fixed registry (no join)."""
    def target(chain: str, asset: str, contract: str) -> Column:
        return F.struct(F.lit(chain).alias("chain"), F.lit(asset).alias("asset"), F.lit(contract).alias("contract"))

    s, evm = F.col("symbol"), F.col("address").rlike("^0x[0-9a-fA-F]{40}$")
    by_symbol: dict[str, list[Column]] = {}
    for symbol, chain, asset, contract in CONTRACTS:
        by_symbol.setdefault(symbol, []).append(target(chain, asset, contract))
    expr = None
    for symbol, found in by_symbol.items():
        test = evm & (s == symbol)
        expr = F.when(test, F.array(*found)) if expr is None else expr.when(test, F.array(*found))
    return (
        expr.when((s == "SOL") & F.array_contains("network_candidates", "solana"), F.array(target("solana", "", "")))
        .when((s == "USDT") & (F.col("version") == "41"), F.array(target(*TRON_CONTRACT)))
        .when((s == "USDT") & F.col("version").isin("00", "05"), F.array(target("bitcoin", "USDT", ""))))


def probe_targets(ledger: DataFrame) -> DataFrame:
    """One row per relation, chain target and provider to ask; listed limitations only."""
    asked = ledger.filter(
        (F.col("listing_status") == "LISTED") & (F.col("review_category") == "LIMITATION") & ~F.col("validation").isin("INVALID", "UNSUPPORTED"))
    rows = explode_once(asked, ["relation_id", "address", "symbol"], _targets(), "t")
    providers = F.array(*[F.struct(F.lit(c).alias("chain"), F.lit(p).alias("provider"), F.lit(e).alias("endpoint")) for c, p, e in PROVIDERS])
    rows = explode_once(rows, ["relation_id", "address", "symbol", "t"], F.filter(providers, lambda p: p["chain"] == F.col("t.chain")), "p")
    return rows.select("relation_id", "address", "symbol", F.col("t.chain").alias("chain"), F.col("t.asset").alias("asset"),
                       F.col("t.contract").alias("contract"), F.col("p.provider").alias("provider"), F.col("p.endpoint").alias("endpoint"))


PROBE = ["relation_id", "chain", "provider", "contract"]


def due_probes(targets: DataFrame, previous: DataFrame, now: Column, *, budget_retry: bool = False) -> DataFrame:
    """reuse / wait / due per target.

    A success younger than 6 h with complete history is reused, a failure younger than 1 h waits; ages
    below zero never count.  A changed endpoint, address or symbol voids the earlier row.
    ``budget_retry``: attempts deferred for budget are due at once.
    """
    p = previous.select(*PROBE, F.struct("endpoint", "address", "symbol", "status", "attempted_at", "checked_at", "incomplete", "error").alias("p"))
    j = targets.join(p, PROBE, "left")
    valid = F.col("p").isNotNull() & (F.col("p.endpoint") == F.col("endpoint")) & (F.col("p.address") == F.col("address")) & (F.col("p.symbol") == F.col("symbol"))
    def age(c: str) -> Column:
        return (F.unix_micros(now) - F.unix_micros(F.col(c).cast("timestamp"))) / F.lit(1_000_000)

    fresh = age("p.checked_at").between(0, 21600) & (age("p.checked_at") < 21600)
    recent = (age("p.attempted_at") >= 0) & (age("p.attempted_at") < 3600)
    partial = F.coalesce("p.incomplete", F.lit(False))
    failed = F.col("p.status").isin("FAILED", "DEFERRED") | partial
    if budget_retry:
        failed = failed & ~((F.col("p.status") == "DEFERRED") & F.startswith(F.coalesce("p.error", F.lit("")), F.lit("request/time budget exhausted")))
    decision = (
        F.when(valid & (F.col("p.status") == "SUCCESS") & ~partial & fresh, "reuse")
        .when(valid & failed & recent, "wait").otherwise("due"))
    return j.select(*PROBE, "endpoint", F.coalesce(decision, F.lit("due")).alias("decision"))


def merge_observations(previous: DataFrame, attempts: DataFrame) -> DataFrame:
    """Probe table after new attempts: the attempt gives status and error, earlier successes and proofs survive."""
    cols = ["status", "attempted_at", "checked_at", "positive", "proof_state", "verified_at", "error"]
    o = previous.select(*PROBE, F.struct(*cols).alias("o"))
    n = attempts.select(*PROBE, F.struct(*cols).alias("n"))
    j = o.join(n, PROBE, "full_outer")
    tried, won = F.col("n").isNotNull(), F.coalesce(F.col("n.status") == "SUCCESS", F.lit(False))
    latest = lambda c: F.when(tried, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    success = lambda c: F.when(won, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    old_proof = F.coalesce("o.verified_at", F.when(F.col("o.proof_state") == "VERIFIED", F.col("o.checked_at")))
    verified = F.when(won & (F.col("n.proof_state") == "VERIFIED"), F.col("n.checked_at")).otherwise(
        F.when(tried, old_proof).otherwise(F.col("o.verified_at")))
    return j.select(*PROBE, latest("status"), latest("attempted_at"), latest("error"), success("checked_at"), success("positive"),
                    success("proof_state"), verified.alias("verified_at"))


# --- transfer proofs ---------------------------------------------------------------------

TRANSFER_TOPIC = "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"


def _log_facts(prefix: str) -> tuple[Column, Column, Column, Column]:
    """What a log shows by itself: whether it is a transfer of a non-zero amount; its parties (40 hex digits each) and amount (64)."""
    topics = F.col("topics")
    padded = rf"^{prefix}0{{24}}[0-9a-fA-F]{{40}}\z"
    party = lambda i: F.lower(F.right(F.get(topics, F.lit(i)), F.lit(40)))
    good = (
        (F.size(topics) == 3) & (F.get(topics, F.lit(0)) == prefix + TRANSFER_TOPIC) & F.get(topics, F.lit(1)).rlike(padded) & F.get(topics, F.lit(2)).rlike(padded)
        & F.col("data").rlike(rf"^{prefix}[0-9a-fA-F]{{64}}\z") & ~F.col("data").rlike(rf"^{prefix}0{{64}}\z"))
    return good, party(1), party(2), F.lower(F.right("data", F.lit(64)))


def transfer_events(logs: DataFrame, prefix: str = "0x") -> DataFrame:
    """Transfer logs of the wanted contract that touch the wanted subject, with a non-zero amount (hex text).

    ``logs``: address, topics, data plus ``contract`` and ``subject`` (prefixed hex).
    """
    good, sender, receiver, amount = _log_facts(prefix)
    subject = F.lower(F.right("subject", F.lit(40)))
    good = good & (F.lower("address") == F.lower("contract")) & (sender.eqNullSafe(subject) | receiver.eqNullSafe(subject))
    event = F.struct(F.concat(F.lit(prefix), sender).alias("from_address"), F.concat(F.lit(prefix), receiver).alias("to_address"), amount.alias("amount_hex"))
    # a generator drops the other logs in one pass; a filter would be pushed down and repeat the expressions behind its inputs
    found = explode_once(logs, ["*"], F.when(good, F.array(event)), "__event")
    return found.select(*logs.columns, "__event.from_address", "__event.to_address", "__event.amount_hex")


def _packed(c: Column) -> Column:
    """A text in few bytes: lower-case hex behind 0x as its bytes, any other as UTF-8.  The first byte tells which, so it is exact."""
    hexed = c.rlike(r"^0x[0-9a-f]*\z") & (F.length(c) % 2 == 0)
    return F.when(hexed, F.concat(F.lit(b"\x01"), F.unhex(F.substr(c, F.lit(3))))).otherwise(F.concat(F.lit(b"\x00"), F.encode(c, "utf-8")))


def _unpacked(c: Column) -> Column:
    rest = F.substr(c, F.lit(2))
    return F.when(F.substr(c, F.lit(1), F.lit(1)) == F.lit(b"\x01"), F.concat(F.lit("0x"), F.lower(F.hex(rest)))).otherwise(F.decode(rest, "utf-8"))


def tried_candidates(candidates: DataFrame) -> DataFrame:
    """The distinct transactions per relation in their order, with the number of them; all are tried.

    Rows move once, by relation and with packed texts; repeats, places and numbers are found where they then lie.
    """
    texts = ["tx_hash", "contract", "subject"]
    packed = candidates.select("relation_id", *[_packed(F.col(c)).alias(c) for c in texts], "seq").repartition("relation_id")
    distinct = packed.groupBy("relation_id", *texts).agg(F.min("seq").alias("seq"))
    one = W.partitionBy("relation_id")
    return distinct.select("relation_id", *[_unpacked(F.col(c)).alias(c) for c in texts], "seq").withColumns({
        "try_no": F.row_number().over(one.orderBy("seq", "tx_hash")), "n_candidates": F.count(F.lit(1)).over(one)})


def prove_transfers(tried: DataFrame, receipts: DataFrame, blocks: DataFrame, block_txs: DataFrame, logs: DataFrame, head: DataFrame) -> DataFrame:
    """Outcome per candidate: PROOF, UNAVAILABLE, or the reason why it is rejected.

    ``head`` is one row (finalized_height, head_time), read as scalar subqueries.  Receipts meet their blocks first; then every side
    moves once, by transaction, with packed hashes and addresses and without logs that are no transfer.  What else has to
    be equal is a range of one value, since a further join key would move the joined rows again.
    """
    good, sender, receiver, amount = _log_facts("0x")
    b = blocks.select(F.col("number").alias("r_number"), _packed(F.col("hash")).alias("b_hash"), F.col("timestamp").alias("b_time"))
    r = receipts.select(
        F.col("block_number").alias("r_number"), _packed(F.col("tx_hash")).alias("tx"), _packed(F.col("block_hash")).alias("r_hash"), F.col("status").alias("r_status"))
    r = r.join(b, "r_number", "left").withColumns({c: head.select(c).scalar() for c in ("finalized_height", "head_time")})
    fault = (
        F.when(F.col("r_status").isNull(), "UNAVAILABLE").when(F.col("r_status") != "0x1", "RECEIPT_NOT_SUCCESSFUL")
        .when(F.col("r_number") > F.col("finalized_height"), "NOT_FINALIZED").when(F.col("b_hash").isNull(), "BLOCK_MISSING")
        .when(F.col("b_hash") != F.col("r_hash"), "BLOCK_MISMATCH").when(F.col("b_time") > F.col("head_time"), "BLOCK_AFTER_HEAD").otherwise(""))
    r = r.select("tx", "r_number", "r_hash", fault.alias("fault"))
    inside = block_txs.select(_packed(F.col("tx_hash")).alias("tx"), F.col("number").alias("i_number")).repartition("tx").distinct()
    log = F.struct(
        _packed(F.col("tx_hash")).alias("tx"), F.col("block_number").alias("l_number"), _packed(F.col("block_hash")).alias("l_hash"),
        _packed(F.lower("address")).alias("l_contract"), F.unhex(sender).alias("sender"), F.unhex(receiver).alias("receiver"),
        "log_index", F.unhex(amount).alias("amount"))
    events = explode_once(logs, [], F.when(good & ~F.col("removed"), F.array(log)), "log").select("log.*")
    c = tried.select(
        "relation_id", _packed(F.col("tx_hash")).alias("tx"), "try_no", "n_candidates", _packed(F.lower("contract")).alias("contract"),
        F.unhex(F.right("subject", F.lit(40))).alias("subject"))
    same = lambda x, y: F.col(x).between(F.col(y), F.col(y))
    by_tx = lambda x, y: F.col(f"{x}.tx") == F.col(f"{y}.tx")
    j = c.join(r, "tx", "left").withColumn("row", F.monotonically_increasing_id()).alias("j")
    j = j.join(inside.alias("i"), by_tx("j", "i") & same("i_number", "r_number"), "left").select("j.*", F.col("i_number").isNotNull().alias("inside")).alias("j")
    touches = (F.col("sender") == F.col("subject")) | (F.col("receiver") == F.col("subject"))
    j = j.join(events.alias("e"), by_tx("j", "e") & same("l_number", "r_number") & same("l_hash", "r_hash") & same("l_contract", "contract")
               & touches & F.col("relation_id").isNotNull(), "left").drop(F.col("e.tx"))
    # one row per candidate and receipt, with the first event of its relation in that transaction
    found = F.when(F.col("l_number").isNotNull(), F.struct("log_index", "amount", "sender", "receiver"))
    one = ["tx", "relation_id", "r_number", "r_hash"]
    j = j.withColumn("nth", F.row_number().over(W.partitionBy(*one, "row").orderBy("log_index")))
    j = j.withColumn("first", F.min(found).over(W.partitionBy(*one))).filter("nth = 1")
    outcome = (
        F.when(F.col("fault").isNull(), "UNAVAILABLE").when(F.col("fault") != "", F.col("fault"))
        .when(~F.col("inside"), "NOT_IN_BLOCK").when(F.col("first").isNull(), "TRANSFER_NOT_FOUND").otherwise("PROOF"))
    shown = lambda v: F.lower(F.hex(F.col(f"first.{v}")))
    event = F.when(F.col("first").isNotNull(), F.struct(
        F.col("first.log_index").alias("log_index"), shown("amount").alias("amount_hex"), F.concat(F.lit("0x"), shown("sender")).alias("from_address"),
        F.concat(F.lit("0x"), shown("receiver")).alias("to_address")))
    return j.select("relation_id", _unpacked(F.col("tx")).alias("tx_hash"), "try_no", "n_candidates", outcome.alias("outcome"),
                    F.col("r_number").alias("block_number"), event.alias("event"))


def select_proofs(outcomes: DataFrame) -> DataFrame:
    """State per relation: candidates are taken in order until the first proof; counts are of those before it.

    Outcomes move once, by relation, and only a proof carries its transaction.
    """
    proved, lost = F.col("outcome") == "PROOF", F.col("outcome") == "UNAVAILABLE"
    slim = outcomes.filter("relation_id IS NOT NULL").select(
        "relation_id", "try_no", "n_candidates", proved.alias("proved"), lost.alias("lost"), F.when(proved, F.struct("tx_hash", F.col("event.amount_hex").alias("amount_hex"))).alias("proof"))
    tried = F.when(F.col("proved"), F.col("try_no"))
    before = F.col("hit").isNull() | (F.col("try_no") < F.col("hit"))
    agg = slim.repartition("relation_id").withColumn("hit", F.min(tried).over(W.partitionBy("relation_id"))).groupBy("relation_id").agg(
        F.max("hit").alias("hit"), F.max("n_candidates").alias("n_candidates"), F.max("try_no").alias("last"), F.min_by("proof", tried).alias("proof"),
        F.count_if(before & F.col("lost")).alias("lost"), F.count_if(before & ~F.col("lost") & ~F.col("proved")).alias("refused"))
    state = F.when(F.col("hit").isNotNull(), "VERIFIED").when(F.col("lost") > 0, "PARTIAL").otherwise("NO_PROOF")
    return agg.select(
        "relation_id", state.alias("state"), "n_candidates", F.coalesce("hit", "last").alias("checked_candidates"),
        F.col("lost").alias("unavailable_candidates"), F.col("refused").alias("rejected_candidates"),
        F.coalesce("proof.tx_hash", F.lit("")).alias("tx_hash"), F.coalesce("proof.amount_hex", F.lit("")).alias("amount_hex"))


def proof_totals(proofs: DataFrame) -> DataFrame:
    """Relations and candidates per state of the token history, with the grand total (state ALL)."""
    return proofs.rollup("state").agg(
        F.count(F.lit(1)).alias("n_relations"), *[F.sum(c).alias(c) for c in (
            "n_candidates", "checked_candidates", "unavailable_candidates", "rejected_candidates")]
    ).withColumn("state", F.coalesce("state", F.lit("ALL")))


STATE_LABELS = {"POSITIVE": "記録・残高を観測", "NO_EVIDENCE": "照会範囲で未観測", "CONFLICT": "取得先で観測結果が異なる",
                "PARTIAL": "一部取得失敗・範囲不足", "FAILED": "取得失敗・未照会"}
PROOF_LABELS = {"VERIFIED": "発行元の送受信を検証済み", "NO_PROOF": "取得範囲で証拠なし", "PARTIAL": "候補あり・取引結果の取得不足"}


def review_matrix(ledger: DataFrame, consensus: DataFrame, proofs: DataFrame) -> DataFrame:
    """Rows to review with chain state and token evidence; ``priority`` orders inconsistency, removal, unsupported, limitation."""
    rows = ledger.filter((F.col("review_reason") != "") | (F.col("listing_status") == "REMOVAL_REVIEW"))
    gone = F.col("listing_status") == "REMOVAL_REVIEW"
    label = F.when(gone, "掲載終了候補").when(F.col("validation") == "INVALID", "不整合").when(F.col("validation") == "UNSUPPORTED", "検証未対応").otherwise("検証制限")
    j = rows.join(consensus.select("relation_id", F.col("state").alias("chain")), "relation_id", "left").join(
        proofs.select("relation_id", F.col("state").alias("proof")), "relation_id", "left")
    return j.select(
        "relation_id", "symbol", "address", label.alias("category"), _pick(label, {"不整合": 0, "掲載終了候補": 1, "検証未対応": 2}, 3).alias("priority"),
        F.when(gone, "原本から消失。対象者指定の解除とは別").otherwise(F.col("review_reason")).alias("reason"),
        F.coalesce(_pick(F.col("chain"), STATE_LABELS, None), F.lit("対象外・未照会")).alias("chain_state"),
        F.coalesce(_pick(F.col("proof"), PROOF_LABELS, None), F.lit("対象外・未照会")).alias("token_evidence"))
