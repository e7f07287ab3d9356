"""Crypto-address queries."""

from pyspark.sql import functions as F

from ..operators import crypto as C
from .fixtures import view
from .registry import query

NOW = "2024-01-20 00:00:00"
EVM = "(address LIKE '0x%' AND length(address) = 42)"


@view("addresses")
def _(d):
    """Addresses as listed, one per order: twelve shapes by customer key, so most repeat."""
    h = d.sha("'a' || CAST(o_custkey AS STRING)")
    b58 = f"translate(substr({h}, 1, 42), '0', 'A')"
    return f"""
SELECT o_orderkey AS id, o_custkey % 12 AS v,
  CASE o_custkey % 12 WHEN 0 THEN 'ETH' WHEN 1 THEN 'XBT' WHEN 2 THEN 'USDT' WHEN 3 THEN 'USDC' WHEN 4 THEN 'SOL' WHEN 5 THEN 'XYZ'
    WHEN 6 THEN 'XRP' WHEN 7 THEN 'LTC' WHEN 8 THEN 'USDT' WHEN 9 THEN 'ETC' WHEN 10 THEN 'USDT' ELSE 'BNB' END AS symbol,
  CASE o_custkey % 12 WHEN 0 THEN '0x' || substr({h}, 1, 40) WHEN 1 THEN '1' || substr({b58}, 1, 33) WHEN 2 THEN '0x' || upper(substr({h}, 1, 40))
    WHEN 3 THEN '0x' || {h} WHEN 4 THEN '9' || {b58} WHEN 5 THEN {h} WHEN 6 THEN 'X' || {b58} WHEN 7 THEN 'ltcmweb1' || {h}
    WHEN 8 THEN 'T' || substr({b58}, 1, 33) WHEN 9 THEN '0x' || substr({h}, 1, 39) WHEN 10 THEN '8' || {b58} ELSE '0x' || substr({h}, 1, 40) END AS address
FROM {d.t('orders')}
"""


PROFILE = f"""
pairs AS (SELECT symbol, address, any_value(v) AS v, count(*) AS n_rows FROM addresses GROUP BY symbol, address),
mixed AS (SELECT *, v = 2 AND upper(address) = address AS odd FROM pairs),
prof AS (SELECT symbol, address, n_rows,
    CASE symbol WHEN 'ETH' THEN 'ethereum' WHEN 'ETC' THEN 'ethereum-classic' WHEN 'XBT' THEN 'bitcoin' WHEN 'LTC' THEN 'litecoin' ELSE '' END AS network, address AS normalized_address,
    CASE WHEN v IN (0, 2, 4, 10) THEN 'FORMAT_ONLY' WHEN v IN (1, 8, 9) THEN 'INVALID' ELSE 'UNSUPPORTED' END AS validation,
    CASE v WHEN 0 THEN '形式正常・チェックサム情報なし（大小文字の区別なし）' WHEN 2 THEN '形式候補は正常・実ネットワーク未確定。形式正常・チェックサム情報なし（大小文字の区別なし）'
      WHEN 1 THEN '原文のチェックサム・形式不正' WHEN 8 THEN '原文のチェックサム・形式不正' WHEN 3 THEN '32バイト16進アドレスのチェーン別検証未対応・実ネットワーク未確定'
      WHEN 4 THEN '形式正常・仕様に文字列チェックサムなし' WHEN 5 THEN 'ネットワーク未確定・検証未対応' WHEN 6 THEN 'XRP X-address検証未対応' WHEN 7 THEN 'Litecoin MWEBアドレス検証未対応'
      WHEN 9 THEN '原文の形式不正' WHEN 10 THEN '形式候補は正常・実ネットワーク未確定。形式正常・仕様に文字列チェックサムなし' ELSE 'BNB通貨記号だけではBeacon/BSCを確定できない' END AS review_reason,
    CASE WHEN v IN (0, 2, 9) THEN 'HEX20' WHEN v IN (1, 8) THEN 'BASE58CHECK' WHEN v IN (4, 10) THEN 'BASE58_32' WHEN v = 6 THEN 'XRP_XADDRESS' ELSE 'UNSUPPORTED' END AS validation_method,
    CASE WHEN v IN (0, 2, 4, 10) THEN 'LIMITATION' WHEN v IN (1, 8, 9) THEN 'INCONSISTENCY' ELSE 'UNSUPPORTED' END AS review_category,
    CASE v WHEN 0 THEN 'ethereum' WHEN 2 THEN 'evm-family' WHEN 3 THEN 'hex32-family' WHEN 4 THEN 'solana' WHEN 10 THEN 'solana-family' ELSE '' END AS network_candidates,
    CASE WHEN v IN (0, 4) THEN 'SYMBOL_AND_FORMAT' WHEN v IN (2, 3, 10) THEN 'FAMILY_ONLY' ELSE 'UNRESOLVED' END AS network_resolution FROM mixed)
"""


def _profile(x):
    return C.validate_addresses(x.view("addresses"))


@query("c1_address_validation", views="addresses", oracle=f"WITH {PROFILE} SELECT * FROM prof")
def _(x):
    return _profile(x).withColumn("network_candidates", F.array_join("network_candidates", ";")).drop("version", "validation_version")


@query("c1_validation_profile", views="addresses", oracle=f"""
WITH {PROFILE} SELECT symbol, CAST(sum(n_rows) AS BIGINT) AS n_rows, count(*) AS n_addresses, count(*) FILTER (validation = 'CHECKSUM_VALID') AS checksum_valid,
  count(*) FILTER (validation = 'FORMAT_ONLY') AS format_only, count(*) FILTER (validation = 'INVALID') AS invalid, count(*) FILTER (validation = 'UNSUPPORTED') AS unsupported FROM prof GROUP BY symbol
""")
def _(x):
    return C.validation_profile(_profile(x))


# Public test vectors, one per checksum: valid, and the same with one character changed (EIP-55 by case).
VECTORS = [
    ("ETH", "0x5aAeb6053F3E94C9b9A09f33669435E7Ef1BeAed", "0x5aAeb6053F3E94C9b9A09f33669435E7Ef1Beaed", "EIP55"),
    ("XBT", "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa", "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNb", "BASE58CHECK"),
    ("XBT", "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4", "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t5", "BECH32"),
    ("XBT", "bc1p0xlxvlhemja6c4dqv22uapctqupfhlxm9h8z3k2e72q4k9hcz7vqzk5jj0", "bc1p0xlxvlhemja6c4dqv22uapctqupfhlxm9h8z3k2e72q4k9hcz7vqzk5jj9", "BECH32M"),
    ("USDT", "TR7NHqjeKQxGTCi8q8ZY4pL8otSzgjLj6t", "TR7NHqjeKQxGTCi8q8ZY4pL8otSzgjLj6u", "BASE58CHECK"),
    ("BCH", "bitcoincash:qpm2qsznhks23z7629mms6s4cwef74vcwvy22gdx6a", "bitcoincash:qpm2qsznhks23z7629mms6s4cwef74vcwvy22gdx6q", "CASHADDR"),
    ("XRP", "rHb9CJAWyB4rj91VRWn96DkukG4bwdtyTh", "rHb9CJAWyB4rj91VRWn96DkukG4bwdtyTr", "XRP_BASE58"),
    ("XMR", "44AFFq5kSiGBoZ4NMDwYtN18obc8AemS33DBLWs3H7otXft3XjrpDtQGv7SqSsaBYBb98uNbr2VBBEt7f2wfn3RVGQBEP3A",
     "44AFFq5kSiGBoZ4NMDwYtN18obc8AemS33DBLWs3H7otXft3XjrpDtQGv7SqSsaBYBb98uNbr2VBBEt7f2wfn3RVGQBEP3B", "MONERO_BASE58"),
]
VECTOR_ROWS = ", ".join(f"({i * 2 + j}, '{symbol}', '{pair[j]}', '{state}', '{method}')" for i, (symbol, *pair, method) in enumerate(VECTORS)
                        for j, state in enumerate(("CHECKSUM_VALID", "INVALID")))
VECTOR_ROWS = VECTOR_ROWS.replace("'INVALID', 'BECH32M'", "'INVALID', 'BECH32'")  # neither checksum fits, so the older name stands


@view("vector_addresses")
def _(d):
    """Listed addresses, one per order, out of the public test vectors."""
    return f"""SELECT o_orderkey AS id, symbol, address, state, method FROM {d.t('orders')} JOIN (VALUES {VECTOR_ROWS}) AS t(k, symbol, address, state, method) ON k = o_custkey % {2 * len(VECTORS)}"""


@query("c1_checksum_vectors", views="vector_addresses", oracle="""
SELECT symbol, address, count(*) AS n_rows, any_value(state) AS validation, any_value(method) AS validation_method FROM vector_addresses GROUP BY symbol, address
""")
def _(x):
    return C.validate_addresses(x.view("vector_addresses").select("id", "symbol", "address")).select("symbol", "address", "n_rows", "validation", "validation_method")


# --- ledger ------------------------------------------------------------------------------

def _mention(d, generation: int) -> str:
    k = "c_custkey"
    sym = f"CASE {k} % 5 WHEN 0 THEN 'ETH' WHEN 1 THEN 'XBT' WHEN 2 THEN 'USDT' WHEN 3 THEN 'USDC' ELSE 'SOL' END"
    new = generation == 1
    entity = f"'Entity ' || CAST({k} AS STRING)" + (f" || CASE WHEN {k} % 11 = 2 THEN ' renamed' ELSE '' END" if new else "")
    validation = f"CASE WHEN {k} % 4 = 1 THEN 'INVALID' WHEN {k} % 4 = 2 THEN 'UNSUPPORTED' ELSE 'FORMAT_ONLY' END"
    if new:
        validation = f"CASE WHEN {k} % 13 = 3 THEN 'CHECKSUM_VALID' ELSE {validation} END"
    reason = f"CASE WHEN {k} % 4 = 1 THEN 'bad' WHEN {k} % 4 = 2 THEN 'unknown' ELSE 'limited' END"
    cat = f"CASE WHEN {k} % 4 = 1 THEN 'INCONSISTENCY' WHEN {k} % 4 = 2 THEN 'UNSUPPORTED' ELSE 'LIMITATION' END"
    if new:
        reason, cat = f"CASE WHEN {k} % 13 = 3 THEN '' ELSE {reason} END", f"CASE WHEN {k} % 13 = 3 THEN '' ELSE {cat} END"
    none = "CAST(array() AS array<string>)" if d.spark else "CAST([] AS VARCHAR[])"
    return f"""
SELECT CAST({d.div(k, '2')} AS STRING) AS party_id, {sym} AS symbol, CASE {k} % 5 WHEN 0 THEN 'ethereum' WHEN 1 THEN 'bitcoin' ELSE '' END AS network,
  '0x' || substr({d.sha('c_name')}, 1, 40) AS normalized_address, {entity} AS entity_name, 'PROG' AS program,
  '0x' || substr({d.sha('c_name')}, 1, 40) AS address, {validation} AS validation, {reason} AS review_reason, {cat} AS review_category,
  CASE WHEN {k} % 4 IN (1, 2) THEN {none} ELSE {d.arr(f"CASE WHEN {k} % 5 = 4 THEN 'solana' ELSE 'evm-family' END")} END AS network_candidates,
  CASE WHEN {k} % 4 IN (1, 2) THEN 'UNRESOLVED' ELSE 'FAMILY_ONLY' END AS network_resolution, '3' AS validation_version, '' AS version,
  'r' || CAST({k} AS STRING) AS source_record_id, {k} * 2 AS ord, {k} AS k FROM {d.t('customer')}"""


@view("crypto_incoming")
def _(d):
    """Extract of one snapshot: some relations absent, renamed or revalidated; some mentioned twice."""
    one = _mention(d, 1)
    return f"{one} WHERE c_custkey % 17 <> 5 UNION ALL {one.replace('c_custkey * 2 AS ord', 'c_custkey * 2 + 1 AS ord')} WHERE c_custkey % 10 = 0 AND c_custkey % 17 <> 5"


RELATION = "concat_ws('|', 'OFAC', 'SDN', party_id, CASE WHEN network <> '' THEN network ELSE 'symbol:' || symbol END, normalized_address)"


@view("crypto_ledger")
def _(d):
    """Ledger before the snapshot: most relations listed, some already under removal review."""
    return f"""
SELECT {d.sha(RELATION)} AS relation_id, m.*, CASE WHEN k % 19 = 6 THEN 'REMOVAL_REVIEW' ELSE 'LISTED' END AS listing_status, '2023-01-01' AS first_seen, '2023-12-31' AS last_seen,
  'e' || CAST(k AS STRING) AS last_event_id, '' AS last_validation_event_id, CAST(1 AS BIGINT) AS n_evidence FROM ({_mention(d, 0)}) m WHERE k % 7 <> 4
"""


EVENT_TEXT = ("concat_ws('|', relation_id, chain, kind, 'HASH', '1', entity_name, program, validation, coalesce(validation_version, ''), review_reason, review_category, "
              "array_to_string(network_candidates, ';'), network_resolution)")
RECONCILED = f"""
n AS (SELECT sha256({RELATION}) AS relation_id, count(*) AS n_evidence, arg_min(i, ord) AS n FROM crypto_incoming i GROUP BY 1),
j AS (SELECT coalesce(o.relation_id, n.relation_id) AS relation_id, o, n.n AS n, n.n_evidence AS ne,
    CASE WHEN o.relation_id IS NULL THEN 'ADDED' WHEN n.n IS NULL THEN CASE WHEN o.listing_status = 'LISTED' THEN 'REMOVAL_CANDIDATE' ELSE '' END
      WHEN o.listing_status <> 'LISTED' THEN 'RELISTED' WHEN (o.entity_name, o.program, o.address) <> (n.n.entity_name, n.n.program, n.n.address) THEN 'CHANGED'
      WHEN (o.validation, o.review_reason, o.review_category, o.network_candidates, o.network_resolution) IS DISTINCT FROM (n.n.validation, n.n.review_reason, n.n.review_category, n.n.network_candidates, n.n.network_resolution) THEN 'REVALIDATED'
      ELSE '' END AS kind FROM crypto_ledger o FULL JOIN n ON n.relation_id = o.relation_id),
f AS (SELECT relation_id, kind, n IS NOT NULL AS here, ne, o.first_seen AS ofs, o.last_seen AS ols, o.last_event_id AS oe, o.listing_status AS os, o.n_evidence AS one,
    CASE WHEN kind = 'REVALIDATED' THEN '' ELSE coalesce(o.last_event_id, '') END AS chain, coalesce(n.party_id, o.party_id) AS party_id, coalesce(n.symbol, o.symbol) AS symbol,
    coalesce(n.network, o.network) AS network, coalesce(n.normalized_address, o.normalized_address) AS normalized_address, coalesce(n.entity_name, o.entity_name) AS entity_name,
    coalesce(n.program, o.program) AS program, coalesce(n.address, o.address) AS address, coalesce(n.validation, o.validation) AS validation, coalesce(n.review_reason, o.review_reason) AS review_reason,
    coalesce(n.review_category, o.review_category) AS review_category, coalesce(n.network_candidates, o.network_candidates) AS network_candidates,
    coalesce(n.network_resolution, o.network_resolution) AS network_resolution, coalesce(n.validation_version, o.validation_version) AS validation_version FROM j),
e AS (SELECT *, CASE kind WHEN '' THEN '' WHEN 'REMOVAL_CANDIDATE' THEN sha256(concat_ws('|', relation_id, oe, 'REMOVAL_CANDIDATE', 'HASH')) ELSE sha256({EVENT_TEXT}) END AS event_id FROM f),
led AS (SELECT relation_id, party_id, symbol, network, normalized_address, entity_name, program, address, validation, review_reason, review_category, network_candidates, network_resolution,
    CASE WHEN here THEN 'LISTED' ELSE 'REMOVAL_REVIEW' END AS listing_status, coalesce(ofs, '2024-01-01') AS first_seen, CASE WHEN here THEN '2024-01-01' ELSE ols END AS last_seen,
    CASE WHEN kind NOT IN ('', 'REVALIDATED') THEN event_id ELSE coalesce(oe, '') END AS last_event_id, CASE WHEN kind = 'REVALIDATED' THEN event_id ELSE '' END AS last_validation_event_id,
    CASE WHEN here THEN ne ELSE one END AS n_evidence, kind, event_id, coalesce(os, '') AS before_status FROM e)
"""
LEDGER_VIEWS = "crypto_incoming crypto_ledger"


def _ledger(x):
    return C.reconcile_ledger(x.view("crypto_ledger"), x.view("crypto_incoming"), "2024-01-01", "HASH", "1", previous_version="1", empty=False)


@query("m9_ledger_reconcile", views=LEDGER_VIEWS, oracle=f"""
WITH {RECONCILED} SELECT * REPLACE (array_to_string(network_candidates, ';') AS network_candidates) FROM led
""")
def _(x):
    return _ledger(x).withColumn("network_candidates", F.array_join("network_candidates", ";")).drop("validation_version")


COUNTS = """
counts AS (SELECT 'listed_relations' AS item, count(*) FILTER (listing_status = 'LISTED') AS value FROM led
UNION ALL SELECT 'unique_addresses', count(DISTINCT (CASE WHEN network <> '' THEN network ELSE 'symbol:' || symbol END, normalized_address)) FILTER (listing_status = 'LISTED') FROM led
UNION ALL SELECT 'removal_review', count(*) FILTER (listing_status = 'REMOVAL_REVIEW') FROM led
UNION ALL SELECT 'format_review', count(*) FILTER (listing_status = 'LISTED' AND review_reason <> '') FROM led
UNION ALL SELECT 'inconsistency_review', count(*) FILTER (listing_status = 'LISTED' AND review_reason <> '' AND validation = 'INVALID') FROM led
UNION ALL SELECT 'validation_limitations', count(*) FILTER (listing_status = 'LISTED' AND review_reason <> '' AND validation NOT IN ('INVALID', 'UNSUPPORTED')) FROM led
UNION ALL SELECT 'unsupported_review', count(*) FILTER (listing_status = 'LISTED' AND review_reason <> '' AND validation = 'UNSUPPORTED') FROM led
UNION ALL SELECT 'symbol: ' || symbol, count(*) FROM led WHERE listing_status = 'LISTED' GROUP BY symbol)
"""


@query("a3_ledger_counts", views=LEDGER_VIEWS, oracle=f"WITH {RECONCILED}, {COUNTS} SELECT * FROM counts")
def _(x):
    return C.ledger_counts(_ledger(x))


@view("declared_counts", "crypto_ledger")
def _(d):
    """Counts a publication declares; two of them are wrong."""
    return """SELECT 'listed_relations' AS item, count(*) + 1 AS value FROM crypto_ledger WHERE listing_status = 'LISTED'
UNION ALL SELECT 'removal_review', count(*) FROM crypto_ledger WHERE listing_status = 'REMOVAL_REVIEW'
UNION ALL SELECT 'format_review', count(*) - 2 FROM crypto_ledger WHERE listing_status = 'LISTED' AND review_reason <> ''"""


@view("published_ledger", "crypto_ledger")
def _(d):
    """Published ledger rows with planted faults: bad ids, empty fields, wrong category, candidates and repeated rows."""
    cols = "party_id, symbol, network, normalized_address, address, validation, review_reason, network_candidates, listing_status, k"
    return f"""
SELECT CASE WHEN k % 43 = 1 THEN 'short' || CAST(k AS STRING) ELSE relation_id END AS relation_id, CASE WHEN k % 47 = 2 THEN '' ELSE party_id END AS party_id,
  symbol, network, normalized_address, address, validation, review_reason, CASE WHEN k % 53 = 3 THEN 'LIMITATION' ELSE review_category END AS review_category, network_candidates,
  CASE WHEN k % 59 = 4 THEN 'UNRESOLVED' ELSE network_resolution END AS network_resolution, listing_status, k FROM crypto_ledger
UNION ALL SELECT relation_id, party_id, symbol, network, normalized_address, address, validation, review_reason, review_category, network_candidates, network_resolution, 'REMOVAL_REVIEW', k
FROM crypto_ledger WHERE k % 61 = 5 AND listing_status = 'REMOVAL_REVIEW'"""


@query("q15_ledger_consistency", views="published_ledger declared_counts", oracle="""
WITH led AS (SELECT * FROM published_ledger),
c AS (SELECT 'listed_relations' AS item, count(*) FILTER (listing_status = 'LISTED') AS v FROM led UNION ALL SELECT 'removal_review', count(*) FILTER (listing_status <> 'LISTED') FROM led
  UNION ALL SELECT 'format_review', count(*) FILTER (listing_status = 'LISTED' AND review_reason <> '') FROM led)
SELECT 'row' AS scope, relation_id AS key, unnest(list_filter([CASE WHEN length(relation_id) <> 64 THEN 'BAD_ID' END, CASE WHEN party_id = '' THEN 'EMPTY_FIELD' END,
  CASE WHEN review_category <> CASE validation WHEN 'INVALID' THEN 'INCONSISTENCY' WHEN 'UNSUPPORTED' THEN 'UNSUPPORTED' ELSE 'LIMITATION' END THEN 'CATEGORY_MISMATCH' END,
  CASE WHEN (network_resolution = 'UNRESOLVED') <> (len(network_candidates) = 0) THEN 'CANDIDATES_MISMATCH' END], lambda v: v IS NOT NULL)) AS violation FROM led
UNION ALL SELECT 'row', relation_id, 'DUPLICATE_ID' FROM led GROUP BY relation_id HAVING count(*) > 1
UNION ALL SELECT 'count', d.item, 'COUNT_MISMATCH' FROM declared_counts d JOIN c ON c.item = d.item WHERE c.v <> d.value
""")
def _(x):
    return C.snapshot_violations(x.view("published_ledger"), x.view("declared_counts"))


# --- probes ------------------------------------------------------------------------------

@view("probes")
def _(d):
    """Probe results: one per event; the relation is the user and hour, so groups hold several providers."""
    return f"""
SELECT CAST(user_id AS STRING) || '-' || CAST({d.div('event_id', '1500')} AS STRING) AS relation_id, CASE user_id % 3 WHEN 0 THEN 'ethereum' ELSE 'tron' END AS chain,
  event_type AS provider, CASE WHEN event_id % 2 = 0 THEN 'C1' ELSE '' END AS contract, CASE WHEN event_type = 'error' AND user_id % 2 = 0 THEN 'FAILED' WHEN user_id % 31 = 3 THEN 'DEFERRED' ELSE 'SUCCESS' END AS status,
  CASE WHEN user_id % 5 = 0 THEN value > 10 ELSE user_id % 4 = 0 END AS positive, CASE WHEN user_id % 7 = 1 THEN value > 20 ELSE true END AS asset_match, user_id % 11 = 2 AND event_id % 9 = 0 AS history_error
FROM {d.t('events')}
"""


CONSENSUS = """
ok AS (SELECT * FROM probes WHERE status = 'SUCCESS'),
gap AS (SELECT DISTINCT relation_id FROM ok GROUP BY relation_id, chain HAVING count(DISTINCT positive) > 1
  UNION SELECT DISTINCT relation_id FROM ok WHERE contract <> '' GROUP BY relation_id, chain, contract HAVING count(DISTINCT asset_match) > 1),
cons AS (SELECT relation_id, CASE WHEN relation_id IN (SELECT relation_id FROM gap) THEN 'CONFLICT' WHEN count(*) FILTER (status = 'SUCCESS') = 0 THEN 'FAILED'
    WHEN count(*) FILTER (status <> 'SUCCESS') > 0 OR bool_or(history_error AND status = 'SUCCESS') THEN 'PARTIAL' WHEN bool_or(positive AND status = 'SUCCESS') THEN 'POSITIVE' ELSE 'NO_EVIDENCE' END AS state,
    count(*) AS n_probes, count(*) FILTER (status = 'SUCCESS') AS n_success FROM probes GROUP BY relation_id)
"""


@query("a4_probe_consensus", views="probes", oracle=f"WITH {CONSENSUS} SELECT * FROM cons")
def _(x):
    return C.probe_consensus(x.view("probes"))


@query("a5_scan_totals", views="probes", oracle=f"""
WITH {CONSENSUS} SELECT coalesce(state, 'ALL') AS state, count(*) AS n_relations, CAST(sum(n_probes) AS BIGINT) AS n_probes, CAST(sum(n_success) AS BIGINT) AS n_success FROM cons GROUP BY ROLLUP (state)
""")
def _(x):
    return C.scan_totals(C.probe_consensus(x.view("probes")))


# Written out, so that the oracle does not follow the engine's own registry.
PROVIDERS = """
    ('ethereum', 'PublicNode', 'https://ethereum-rpc.publicnode.com'),
    ('ethereum', 'dRPC', 'https://eth.drpc.org'),
    ('ethereum-classic', 'dRPC', 'https://etc.drpc.org'),
    ('ethereum-classic', 'ETC-Network.info', 'https://geth-at.etc-network.info'),
    ('bsc', 'PublicNode', 'https://bsc-rpc.publicnode.com'),
    ('bsc', 'dRPC', 'https://bsc.drpc.org'),
    ('arbitrum', 'PublicNode', 'https://arbitrum-one-rpc.publicnode.com'),
    ('arbitrum', 'Network public RPC', 'https://arb1.arbitrum.io/rpc'),
    ('avalanche', 'PublicNode', 'https://avalanche-c-chain-rpc.publicnode.com'),
    ('avalanche', 'Network public RPC', 'https://api.avax.network/ext/bc/C/rpc'),
    ('base', 'PublicNode', 'https://base-rpc.publicnode.com'),
    ('base', 'Network public RPC', 'https://mainnet.base.org'),
    ('tron', 'PublicNode', 'https://tron-solidity-rpc.publicnode.com'),
    ('tron', 'TronGrid', 'https://api.trongrid.io'),
    ('bitcoin', 'Blockstream', 'https://blockstream.info/api'),
    ('bitcoin', 'mempool.space', 'https://mempool.space/api'),
    ('solana', 'Solana public RPC', 'https://api.mainnet-beta.solana.com'),
    ('solana', 'PublicNode', 'https://solana-rpc.publicnode.com')
"""
CONTRACTS = """
    ('USDT', 'ethereum', 'USDT', '0xdac17f958d2ee523a2206206994597c13d831ec7'),
    ('USDT', 'avalanche', 'USDT', '0x9702230a8ea53601f5cd2dc00fdbc13d4df4a8c7'),
    ('USDC', 'ethereum', 'USDC', '0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48'),
    ('USDC', 'arbitrum', 'USDC', '0xaf88d065e77c8cc2239327c5edb3a432268e5831'),
    ('USDC', 'base', 'USDC', '0x833589fcd6edb6e08f4c7c32d4f71b54bda02913'),
    ('ETH', 'ethereum', '', ''),
    ('ETC', 'ethereum-classic', '', ''),
    ('BSC', 'bsc', '', ''),
    ('ARB', 'arbitrum', '', '')
"""
TARGETS = f"""
prov(chain, provider, endpoint) AS (VALUES {PROVIDERS}), cont(symbol, chain, asset, contract) AS (VALUES {CONTRACTS}, ('SOL', 'solana', '', '')),
targ AS (SELECT l.relation_id, l.address, l.symbol, c.chain, c.asset, c.contract, p.provider, p.endpoint FROM crypto_ledger l JOIN cont c ON c.symbol = l.symbol JOIN prov p ON p.chain = c.chain
  WHERE listing_status = 'LISTED' AND review_category = 'LIMITATION' AND validation NOT IN ('INVALID', 'UNSUPPORTED'))
"""


@query("c2_probe_targets", views="crypto_ledger", oracle=f"WITH {TARGETS} SELECT * FROM targ")
def _(x):
    return C.probe_targets(x.view("crypto_ledger"))


@view("previous_probes", "crypto_ledger")
def _(d):
    """Earlier probe rows of the first two providers' chains with various ages, endpoints and outcomes."""
    return f"""
SELECT relation_id, chain, provider, contract, CASE WHEN k % 9 = 1 THEN 'https://old.example' ELSE endpoint END AS endpoint,
  CASE WHEN k % 10 = 2 THEN 'other' ELSE address END AS address, symbol, CASE k % 4 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'DEFERRED' ELSE 'SUCCESS' END AS status,
  TIMESTAMP '{NOW}' - CASE k % 6 WHEN 0 THEN INTERVAL '10' MINUTE WHEN 1 THEN INTERVAL '60' MINUTE WHEN 2 THEN INTERVAL '59' MINUTE ELSE INTERVAL '400' MINUTE END AS attempted_at,
  TIMESTAMP '{NOW}' - CASE k % 5 WHEN 0 THEN INTERVAL '359' MINUTE WHEN 1 THEN INTERVAL '360' MINUTE WHEN 2 THEN INTERVAL '-5' MINUTE ELSE INTERVAL '5' MINUTE END AS checked_at,
  k % 8 = 3 AS incomplete, CASE WHEN k % 3 = 0 THEN 'request/time budget exhausted' ELSE 'x' END AS error,
  k % 2 = 0 AS positive, CASE k % 3 WHEN 0 THEN 'VERIFIED' ELSE 'NO_PROOF' END AS proof_state, CASE WHEN k % 12 = 1 THEN '2023-11-11' END AS verified_at, k
FROM (SELECT relation_id, address, symbol, k, 'ethereum' AS chain, 'dRPC' AS provider, 'https://eth.drpc.org' AS endpoint,
    CASE symbol WHEN 'USDT' THEN '0xdac17f958d2ee523a2206206994597c13d831ec7' WHEN 'USDC' THEN '0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48' ELSE '' END AS contract FROM crypto_ledger
  UNION ALL SELECT relation_id, address, symbol, k, 'solana', 'PublicNode', 'https://solana-rpc.publicnode.com', '' FROM crypto_ledger) b
"""


@query("c3_due_probes", views="crypto_ledger previous_probes", oracle=f"""
WITH {TARGETS},
j AS (SELECT t.relation_id, t.chain, t.provider, t.contract, t.endpoint, p.relation_id IS NOT NULL AND p.endpoint = t.endpoint AND p.address = t.address AND p.symbol = t.symbol AS valid, status, incomplete, error,
    epoch(TIMESTAMP '{NOW}' - attempted_at) AS ta, epoch(TIMESTAMP '{NOW}' - checked_at) AS tc
  FROM targ t LEFT JOIN previous_probes p ON p.relation_id = t.relation_id AND p.chain = t.chain AND p.provider = t.provider AND p.contract = t.contract)
SELECT relation_id, chain, provider, contract, endpoint, CASE WHEN valid AND status = 'SUCCESS' AND NOT incomplete AND tc >= 0 AND tc < 21600 THEN 'reuse'
  WHEN valid AND (status = 'FAILED' OR incomplete OR (status = 'DEFERRED')) AND NOT (status = 'DEFERRED' AND error LIKE 'request/time budget%') AND ta >= 0 AND ta < 3600 THEN 'wait' ELSE 'due' END AS decision FROM j
""")
def _(x):
    return C.due_probes(C.probe_targets(x.view("crypto_ledger")), x.view("previous_probes"), F.lit(NOW).cast("timestamp"), budget_retry=True)


@query("c4_observation_merge", views="crypto_ledger previous_probes", oracle=f"""
WITH p AS (SELECT relation_id, chain, provider, contract, status, CAST(attempted_at AS VARCHAR) AS attempted_at, CAST(checked_at AS VARCHAR) AS checked_at, positive, proof_state, verified_at, error, k FROM previous_probes),
a AS (SELECT relation_id, chain, provider, contract, CASE WHEN k % 3 = 1 THEN 'FAILED' ELSE 'SUCCESS' END AS status, '2024-01-20' AS attempted_at, CASE WHEN k % 3 = 1 THEN NULL ELSE '2024-01-20' END AS checked_at, k % 5 = 0 AS positive,
    CASE WHEN k % 7 = 0 THEN 'VERIFIED' ELSE 'PARTIAL' END AS proof_state, 'new' AS error FROM p WHERE k % 2 = 0 UNION ALL
  SELECT relation_id, 'bitcoin', 'Blockstream', '', 'SUCCESS', '2024-01-20', '2024-01-20', true, 'VERIFIED', 'new' FROM crypto_ledger WHERE k % 9 = 0)
SELECT coalesce(a.relation_id, p.relation_id) AS relation_id, coalesce(a.chain, p.chain) AS chain, coalesce(a.provider, p.provider) AS provider, coalesce(a.contract, p.contract) AS contract,
  coalesce(a.status, p.status) AS status, coalesce(a.attempted_at, p.attempted_at) AS attempted_at, coalesce(a.error, p.error) AS error,
  CASE WHEN a.status = 'SUCCESS' THEN a.checked_at ELSE p.checked_at END AS checked_at, CASE WHEN a.status = 'SUCCESS' THEN a.positive ELSE p.positive END AS positive,
  CASE WHEN a.status = 'SUCCESS' THEN a.proof_state ELSE p.proof_state END AS proof_state,
  CASE WHEN a.status = 'SUCCESS' AND a.proof_state = 'VERIFIED' THEN a.checked_at WHEN a.status IS NOT NULL THEN coalesce(p.verified_at, CASE WHEN p.proof_state = 'VERIFIED' THEN p.checked_at END) ELSE p.verified_at END AS verified_at
FROM p FULL JOIN a ON a.relation_id = p.relation_id AND a.chain = p.chain AND a.provider = p.provider AND a.contract = p.contract
""")
def _(x):
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    previous = x.view("previous_probes").select(*C.PROBE, "status", text("attempted_at"), text("checked_at"), "positive", "proof_state", "verified_at", "error", "k")
    again = previous.filter("k % 2 = 0").select(
        *C.PROBE, F.expr("CASE WHEN k % 3 = 1 THEN 'FAILED' ELSE 'SUCCESS' END").alias("status"), F.lit("2024-01-20").alias("attempted_at"),
        F.expr("CASE WHEN k % 3 = 1 THEN NULL ELSE '2024-01-20' END").alias("checked_at"), F.expr("k % 5 = 0").alias("positive"),
        F.expr("CASE WHEN k % 7 = 0 THEN 'VERIFIED' ELSE 'PARTIAL' END").alias("proof_state"), F.lit(None).cast("string").alias("verified_at"), F.lit("new").alias("error"))
    fresh = x.view("crypto_ledger").filter("k % 9 = 0").select(
        "relation_id", F.lit("bitcoin").alias("chain"), F.lit("Blockstream").alias("provider"), F.lit("").alias("contract"), F.lit("SUCCESS").alias("status"),
        F.lit("2024-01-20").alias("attempted_at"), F.lit("2024-01-20").alias("checked_at"), F.lit(True).alias("positive"), F.lit("VERIFIED").alias("proof_state"),
        F.lit(None).cast("string").alias("verified_at"), F.lit("new").alias("error"))
    return C.merge_observations(previous.drop("k"), again.unionByName(fresh))


# --- transfers ---------------------------------------------------------------------------

CONTRACT = "0xdac17f958d2ee523a2206206994597c13d831ec7"


def _subject(d, key: str) -> str:
    return f"substr({d.sha(chr(39) + 'a' + chr(39) + ' || CAST(' + key + ' AS STRING)')}, 1, 40)"


@view("transfer_logs")
def _(d):
    """Event logs: one per line item; foreign contracts, odd topics, zero amounts and removed logs planted."""
    other = _subject(d, "l_suppkey")
    mine = _subject(d, "o_custkey")
    pad = "'0x' || repeat('0', 24) || "
    topics = d.arr(f"'0x{C.TRANSFER_TOPIC}'", pad + f"CASE WHEN l_linenumber % 2 = 0 THEN {mine} ELSE {other} END", pad + f"CASE WHEN l_linenumber % 4 = 1 THEN {mine} ELSE {other} END")
    short = d.arr(f"'0x{C.TRANSFER_TOPIC}'", pad + mine)
    return f"""
SELECT '0x' || {d.sha("CAST(o_orderkey AS STRING)")} AS tx_hash, l_linenumber AS log_index, {d.div('o_orderkey', '10')} AS block_number,
  '0x' || {d.sha("'b' || CAST(" + d.div('o_orderkey', '10') + " AS STRING)")} AS block_hash, l_partkey % 23 = 3 AS removed,
  CASE WHEN l_partkey % 5 = 0 THEN '0x' || repeat('1', 40) ELSE upper(substr('{CONTRACT}', 1, 2)) || substr('{CONTRACT}', 3) END AS raw_address,
  CASE WHEN l_partkey % 5 = 0 THEN '0x' || repeat('1', 40) ELSE '{CONTRACT}' END AS address,
  CASE WHEN l_partkey % 17 = 2 THEN {short} ELSE {topics} END AS topics,
  '0x' || CASE WHEN l_partkey % 13 = 1 THEN repeat('0', 64) WHEN l_partkey % 19 = 4 THEN 'zz' ELSE lpad(CAST(CAST(l_quantity AS BIGINT) AS STRING), 64, '0') END AS data,
  o_custkey, l_linenumber, l_partkey, l_suppkey
FROM {d.t('lineitem')} JOIN {d.t('orders')} ON l_orderkey = o_orderkey
"""


@query("c5_transfer_scan", views="transfer_logs", oracle=f"""
WITH l AS (SELECT *, substr(sha256('a' || o_custkey), 1, 40) AS me, lower(substr(topics[2], -40)) AS f, lower(substr(topics[3], -40)) AS t FROM transfer_logs
  WHERE address = '{CONTRACT}' AND len(topics) = 3 AND length(data) = 66 AND data <> '0x' || repeat('0', 64))
SELECT tx_hash, log_index, '0x' || f AS from_address, '0x' || t AS to_address, substr(data, 3) AS amount_hex FROM l WHERE f = me OR t = me
""")
def _(x):
    logs = x.view("transfer_logs").withColumns({
        "contract": F.lit(CONTRACT), "subject": F.concat(F.lit("0x"), F.left(F.sha2(F.concat(F.lit("a"), F.col("o_custkey").cast("string")), 256), F.lit(40)))})
    return C.transfer_events(logs).select("tx_hash", "log_index", "from_address", "to_address", "amount_hex")


@view("proof_candidates")
def _(d):
    """Candidate transactions per relation (customer): its orders, some listed twice."""
    one = f"""SELECT CAST(o_custkey AS STRING) AS relation_id, '0x' || {d.sha("CAST(o_orderkey AS STRING)")} AS tx_hash, o_orderkey AS seq, '{CONTRACT}' AS contract,
  '0x' || {_subject(d, 'o_custkey')} AS subject, o_orderkey AS k FROM {d.t('orders')}"""
    return f"{one} UNION ALL {one.replace('o_orderkey AS seq', 'o_orderkey + 7 AS seq')} WHERE o_orderkey % 6 = 1"


@view("receipts")
def _(d):
    return f"""SELECT '0x' || {d.sha("CAST(o_orderkey AS STRING)")} AS tx_hash, CASE WHEN o_orderkey % 7 = 3 THEN '0x0' ELSE '0x1' END AS status, {d.div('o_orderkey', '10')} AS block_number,
  CASE WHEN o_orderkey % 17 = 4 THEN '0xbad' ELSE '0x' || {d.sha("'b' || CAST(" + d.div('o_orderkey', '10') + " AS STRING)")} END AS block_hash FROM {d.t('orders')} WHERE o_orderkey % 9 <> 2"""


@view("blocks")
def _(d):
    return f"""SELECT DISTINCT {d.div('o_orderkey', '10')} AS number, '0x' || {d.sha("'b' || CAST(" + d.div('o_orderkey', '10') + " AS STRING)")} AS hash,
  1000 + {d.div('o_orderkey', '10')} + CASE WHEN {d.div('o_orderkey', '10')} % 29 = 1 THEN 1000000000 ELSE 0 END AS timestamp FROM {d.t('orders')} WHERE {d.div('o_orderkey', '10')} % 31 <> 5"""


@view("block_txs")
def _(d):
    return f"""SELECT {d.div('o_orderkey', '10')} AS number, '0x' || {d.sha("CAST(o_orderkey AS STRING)")} AS tx_hash FROM {d.t('orders')} WHERE o_orderkey % 13 <> 6"""


@view("chain_head")
def _(d):
    return f"SELECT {d.div('max(o_orderkey) * 9', '100')} AS finalized_height, 500000000 AS head_time FROM {d.t('orders')}"


PROOFS = f"""
ds AS (SELECT relation_id, tx_hash, contract, subject, min(seq) AS seq, any_value(k) AS k FROM proof_candidates GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY relation_id ORDER BY seq, tx_hash) AS try_no, count(*) OVER (PARTITION BY relation_id) AS n_candidates FROM ds),
ev AS (SELECT c.relation_id, c.tx_hash, l.block_number, l.block_hash, min(log_index) AS log_index, arg_min(substr(data, 3), (log_index, substr(data, 3))) AS amount_hex FROM rk c JOIN transfer_logs l ON l.tx_hash = c.tx_hash
  WHERE NOT removed AND address = '{CONTRACT}' AND len(topics) = 3 AND length(data) = 66 AND data <> '0x' || repeat('0', 64)
    AND (substr(topics[2], -40) = substr(subject, 3) OR substr(topics[3], -40) = substr(subject, 3)) GROUP BY ALL),
oc AS (SELECT c.relation_id, c.tx_hash, try_no, n_candidates, r.block_number, ev.amount_hex, CASE WHEN r.tx_hash IS NULL THEN 'UNAVAILABLE' WHEN r.status <> '0x1' THEN 'RECEIPT_NOT_SUCCESSFUL'
    WHEN r.block_number > finalized_height THEN 'NOT_FINALIZED' WHEN b.hash IS NULL THEN 'BLOCK_MISSING' WHEN b.hash <> r.block_hash THEN 'BLOCK_MISMATCH' WHEN b.timestamp > head_time THEN 'BLOCK_AFTER_HEAD'
    WHEN t.tx_hash IS NULL THEN 'NOT_IN_BLOCK' WHEN ev.log_index IS NULL THEN 'TRANSFER_NOT_FOUND' ELSE 'PROOF' END AS outcome
  FROM rk c CROSS JOIN chain_head LEFT JOIN receipts r ON r.tx_hash = c.tx_hash LEFT JOIN blocks b ON b.number = r.block_number LEFT JOIN block_txs t ON t.number = r.block_number AND t.tx_hash = c.tx_hash
  LEFT JOIN ev ON ev.relation_id = c.relation_id AND ev.tx_hash = c.tx_hash AND ev.block_number = r.block_number AND ev.block_hash = r.block_hash)
"""
PROOF_VIEWS = "transfer_logs proof_candidates receipts blocks block_txs chain_head"


def _outcomes(x):
    return C.prove_transfers(C.tried_candidates(x.view("proof_candidates")), *[x.view(v) for v in ("receipts", "blocks", "block_txs", "transfer_logs", "chain_head")])


@query("c6_transfer_proofs", views=PROOF_VIEWS, oracle=f"WITH {PROOFS} SELECT relation_id, tx_hash, try_no, n_candidates, outcome, coalesce(block_number, -1) AS block_number, amount_hex FROM oc")
def _(x):
    return _outcomes(x).withColumn("amount_hex", F.col("event.amount_hex")).drop("event").fillna(-1, "block_number")


SELECTED = """
hit AS (SELECT relation_id, min(try_no) FILTER (outcome = 'PROOF') AS h FROM oc GROUP BY 1),
sel AS (SELECT o.relation_id, CASE WHEN h IS NOT NULL THEN 'VERIFIED' WHEN count(*) FILTER (outcome = 'UNAVAILABLE') > 0 THEN 'PARTIAL' ELSE 'NO_PROOF' END AS state, max(n_candidates) AS n_candidates,
    coalesce(h, max(try_no)) AS checked_candidates, count(*) FILTER (outcome = 'UNAVAILABLE' AND (h IS NULL OR try_no < h)) AS unavailable_candidates,
    count(*) FILTER (outcome NOT IN ('UNAVAILABLE', 'PROOF') AND (h IS NULL OR try_no < h)) AS rejected_candidates, coalesce(max(tx_hash) FILTER (try_no = h), '') AS tx_hash, coalesce(max(amount_hex) FILTER (try_no = h), '') AS amount_hex
  FROM oc o JOIN hit USING (relation_id) GROUP BY o.relation_id, h)
"""


@query("c7_proof_selection", views=PROOF_VIEWS, oracle=f"WITH {PROOFS}, {SELECTED} SELECT * FROM sel")
def _(x):
    return C.select_proofs(_outcomes(x))


@query("a5_proof_totals", views=PROOF_VIEWS, oracle=f"""
WITH {PROOFS}, {SELECTED} SELECT coalesce(state, 'ALL') AS state, count(*) AS n_relations, CAST(sum(n_candidates) AS BIGINT) AS n_candidates, CAST(sum(checked_candidates) AS BIGINT) AS checked_candidates,
  CAST(sum(unavailable_candidates) AS BIGINT) AS unavailable_candidates, CAST(sum(rejected_candidates) AS BIGINT) AS rejected_candidates FROM sel GROUP BY ROLLUP (state)
""")
def _(x):
    return C.proof_totals(C.select_proofs(_outcomes(x)))


@query("c8_review_matrix", views="crypto_ledger probes " + PROOF_VIEWS, oracle=f"""
WITH {PROOFS}, {SELECTED}, {CONSENSUS},
ch AS (SELECT l.relation_id, c.state FROM crypto_ledger l JOIN cons c ON c.relation_id = CAST(l.k AS STRING) || '-0'),
pr AS (SELECT l.relation_id, s.state FROM sel s JOIN crypto_ledger l ON CAST(l.k AS STRING) = s.relation_id)
SELECT l.relation_id, symbol, address, CASE WHEN listing_status <> 'LISTED' THEN '掲載終了候補' WHEN validation = 'INVALID' THEN '不整合' WHEN validation = 'UNSUPPORTED' THEN '検証未対応' ELSE '検証制限' END AS category,
  CASE WHEN listing_status <> 'LISTED' THEN 1 WHEN validation = 'INVALID' THEN 0 WHEN validation = 'UNSUPPORTED' THEN 2 ELSE 3 END AS priority,
  CASE WHEN listing_status <> 'LISTED' THEN '原本から消失。対象者指定の解除とは別' ELSE review_reason END AS reason,
  CASE ch.state WHEN 'POSITIVE' THEN '記録・残高を観測' WHEN 'NO_EVIDENCE' THEN '照会範囲で未観測' WHEN 'CONFLICT' THEN '取得先で観測結果が異なる' WHEN 'PARTIAL' THEN '一部取得失敗・範囲不足' WHEN 'FAILED' THEN '取得失敗・未照会' ELSE '対象外・未照会' END AS chain_state,
  CASE pr.state WHEN 'VERIFIED' THEN '発行元の送受信を検証済み' WHEN 'NO_PROOF' THEN '取得範囲で証拠なし' WHEN 'PARTIAL' THEN '候補あり・取引結果の取得不足' ELSE '対象外・未照会' END AS token_evidence
FROM crypto_ledger l LEFT JOIN ch ON ch.relation_id = l.relation_id LEFT JOIN pr ON pr.relation_id = l.relation_id WHERE review_reason <> '' OR listing_status <> 'LISTED'
""")
def _(x):
    ledger = x.view("crypto_ledger")
    # the probes of a user's first hour stand for those of the relation with that number
    probed = C.probe_consensus(x.view("probes")).withColumnRenamed("relation_id", "probed")
    chain = ledger.select("relation_id", F.concat(F.col("k").cast("string"), F.lit("-0")).alias("probed")).join(probed, "probed").select("relation_id", "state")
    owner = ledger.select("relation_id", F.col("k").cast("string").alias("owner"))
    proofs = C.select_proofs(_outcomes(x)).withColumnRenamed("relation_id", "owner").join(owner, "owner").select("relation_id", "state")
    return C.review_matrix(ledger, chain, proofs)
