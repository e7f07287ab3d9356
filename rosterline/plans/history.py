"""Alias-history queries and their consequences for the master."""

from pyspark.sql import functions as F

from ..operators import history as H
from .fixtures import DELISTED, view
from .master import remark_sql
from .registry import query

TS = 1700000000000
N9 = "lpad(CAST(c_custkey AS STRING), 9, '0')"
LIST = "CASE WHEN c_custkey % 3 = 0 THEN 'CONS' ELSE 'SDN' END"
PID = "CAST(c_custkey AS STRING)"


@view("alias_records")
def _(d):
    """One snapshot of party names: primaries, weak and strong alternates, the same name in two formats, new parties."""
    return f"""
SELECT {LIST} AS list, {PID} AS party_id, 'Customer ' || {N9} AS name, 'advanced_xml_v3' AS format, true AS alias_primary, false AS low_quality
FROM {d.t('customer')} WHERE c_custkey % 10 <> 7
UNION ALL
SELECT {LIST}, {PID}, '"Alt ' || {N9} || '"', 'advanced_xml_v3', false, c_custkey % 5 = 0 FROM {d.t('customer')} WHERE c_custkey % 10 <> 7 AND c_custkey % 4 <> 1
UNION ALL
SELECT {LIST}, {PID}, 'Alt ' || {N9}, 'classic_csv', false, false FROM {d.t('customer')} WHERE c_custkey % 15 = 0
UNION ALL
SELECT 'SDN', CAST(100000000 + s_suppkey AS STRING), 'Supplier ' || lpad(CAST(s_suppkey AS STRING), 9, '0'), '', true, false FROM {d.t('supplier')}
UNION ALL
SELECT 'SDN', '', 'No party', '', true, false FROM {d.t('supplier')} WHERE s_suppkey % 10 = 0
"""


def _hist(d, name: str, alias_current: str, formats: str, primary: str, low: str, where: str) -> str:
    return f"""
SELECT {LIST} AS list, {PID} AS party_id, {name} || {N9} AS name, lower(replace({name}, ' ', '')) || {N9} AS match_key,
  1000 + c_custkey AS first_seen_ms, 2000 + c_custkey AS last_changed_ms, {alias_current} AS alias_current,
  c_custkey % 13 <> 0 AS party_current, {formats} AS formats, {primary} AS {d.q('primary')}, {low} AS low_quality
FROM {d.t('customer')} WHERE c_custkey % 11 <> 0 AND {where}"""


@view("alias_history")
def _(d):
    """History before the snapshot: current, inactive and soon vanishing aliases."""
    xml, none = d.arr("'advanced_xml_v3'"), "CAST(array() AS array<string>)" if d.spark else "CAST([] AS VARCHAR[])"
    return " UNION ALL ".join([
        _hist(d, "'Customer '", "c_custkey % 13 <> 0", xml, "c_custkey % 6 <> 1", "false", "true"),
        _hist(d, "'Alt '", "c_custkey % 13 <> 0", xml, "false", "c_custkey % 10 = 0", "true"),
        _hist(d, "'Old '", "false", none, "false", "c_custkey % 2 = 0", "c_custkey % 4 = 2"),
        _hist(d, "'Gone '", "c_custkey % 13 <> 0", xml, "false", "true", "c_custkey % 14 = 0"),
    ])


UPDATED = """
shown AS (SELECT list, party_id, trim(name, '"') AS name, format, alias_primary, low_quality FROM alias_records WHERE party_id <> ''),
inc AS (SELECT list, party_id, name, list_sort(list_distinct(list(format) FILTER (format <> ''))) AS formats,
    bool_or(alias_primary) AS prim, bool_or(low_quality) AND NOT bool_or(NOT low_quality) AS low FROM shown GROUP BY ALL),
parties AS (SELECT DISTINCT list, party_id FROM inc),
upd AS (SELECT coalesce(h.list, i.list) AS list, coalesce(h.party_id, i.party_id) AS party_id, coalesce(h.name, i.name) AS name,
    h.match_key, h.first_seen_ms, h.last_changed_ms, h.alias_current AS hac, h.party_current AS hpc, h.formats AS hf, h."primary" AS hp, h.low_quality AS hl,
    i.name IS NOT NULL AS seen, h.name IS NULL AS is_new, coalesce(i.prim, h."primary") AS prim, coalesce(i.low, h.low_quality) AS low,
    CASE WHEN h.name IS NULL THEN coalesce(i.formats, []) WHEN i.name IS NULL THEN h.formats ELSE list_sort(list_distinct(list_concat(h.formats, coalesce(i.formats, [])))) END AS nf
  FROM alias_history h FULL JOIN inc i ON h.list = i.list AND h.party_id = i.party_id AND h.name = i.name),
fin AS (SELECT u.*, p.party_id IS NOT NULL AS pc FROM upd u LEFT JOIN parties p ON p.list = u.list AND p.party_id = u.party_id),
hist2 AS (SELECT list, party_id, name, coalesce(match_key, lower(replace(name, ' ', ''))) AS match_key, coalesce(first_seen_ms, 1700000000000) AS first_seen_ms,
    CASE WHEN is_new OR hac <> seen OR hpc <> pc OR hf IS DISTINCT FROM nf OR hp <> prim OR hl <> low THEN 1700000000000 ELSE last_changed_ms END AS last_changed_ms,
    seen AS alias_current, pc AS party_current, nf AS formats, prim AS "primary", low AS low_quality, is_new FROM fin)
"""
VIEWS = "alias_history alias_records"


@query("m2_alias_history", views=VIEWS, oracle=f"""
WITH {UPDATED} SELECT * REPLACE (array_to_string(formats, ';') AS formats) FROM hist2
""")
def _(x):
    return H.update_history(x.view("alias_history"), x.view("alias_records"), TS).withColumn("formats", F.array_join("formats", ";"))


@query("m2_party_changes", views=VIEWS, oracle=f"""
WITH {UPDATED}, was AS (SELECT DISTINCT list, party_id FROM alias_history WHERE party_current)
SELECT list, party_id, 'added' AS change FROM (SELECT * FROM parties EXCEPT SELECT * FROM was)
UNION ALL SELECT list, party_id, 'removed' FROM (SELECT * FROM was EXCEPT SELECT * FROM parties)
""")
def _(x):
    return H.party_changes(x.view("alias_history"), x.view("alias_records"))


@query("m2_history_totals", views=VIEWS, oracle=f"""
WITH {UPDATED} SELECT list, count(*) AS n_rows, count(DISTINCT party_id) FILTER (party_current) AS n_current_parties, count(*) FILTER (alias_current) AS n_current_aliases,
  count(*) FILTER (NOT alias_current AND party_current) AS n_former_aliases FROM hist2 GROUP BY list
""")
def _(x):
    return H.history_totals(H.update_history(x.view("alias_history"), x.view("alias_records"), TS))


@query("w5_best_party_names", views=VIEWS, oracle=f"""
WITH {UPDATED} SELECT list, party_id, arg_min(name, (NOT "primary", low_quality, lower(name), name)) AS party_name FROM hist2 GROUP BY ALL
""")
def _(x):
    return H.best_party_names(H.update_history(x.view("alias_history"), x.view("alias_records"), TS))


COVERAGE = """
a AS (SELECT DISTINCT party_id FROM alias_records WHERE format = 'advanced_xml_v3'),
b AS (SELECT DISTINCT CAST(c_custkey AS STRING) AS party_id FROM customer WHERE c_custkey % 6 <> 1),
d AS (SELECT 'left_only' AS side, party_id FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'right_only', party_id FROM (SELECT * FROM b EXCEPT SELECT * FROM a))
"""


def _coverage(x):
    feed = x.view("alias_records").filter("format = 'advanced_xml_v3'")
    other = x.table("customer").filter("c_custkey % 6 <> 1").select(F.col("c_custkey").cast("string").alias("party_id"))
    return H.key_coverage(feed, other, "party_id")


@query("q3_key_coverage", views="alias_records", oracle=f"WITH {COVERAGE} SELECT * FROM d")
def _(x):
    return _coverage(x)


@query("q3_key_totals", views="alias_records", oracle=f"WITH {COVERAGE} SELECT side, count(*) AS n_keys FROM d GROUP BY side")
def _(x):
    return H.key_totals(_coverage(x))


@view("coded_records")
def _(d):
    """List records with the category their code maps to; codes 3 and 5 are shifted, code 6 is unknown."""
    return f"""
SELECT 'customer' || {N9} AS match_key, CAST(c_custkey % 7 AS STRING) AS code,
  CASE WHEN c_custkey % 7 = 6 THEN '' WHEN c_custkey % 7 IN (3, 5) THEN 'ロシア連邦' WHEN c_custkey % 6 = 1 THEN 'テロリスト等' ELSE 'ハイチ共和国' END AS category
FROM {d.t('customer')}
"""


@query("q7_category_drift", views="coded_records master", oracle="""
WITH s AS (SELECT r.code, r.category, list_contains(m.categories, '財務省:' || r.category) AND r.category <> '' AS agree
  FROM coded_records r JOIN master m ON m.match_key = r.match_key WHERE len(list_filter(m.categories, lambda c: starts_with(c, '財務省:'))) > 0)
SELECT code, max(category) AS category, count(*) FILTER (agree) AS n_agree, count(*) AS n_samples FROM s GROUP BY code
HAVING count(*) >= 8 AND count(*) FILTER (agree) / count(*) < 0.5
""")
def _(x):
    return H.category_drift(x.view("coded_records"), x.view("master"))


WEAK = """
cur AS (SELECT * FROM hist2 WHERE party_current AND alias_current),
weak AS (SELECT match_key, count(DISTINCT (list, party_id)) AS n FROM cur GROUP BY 1 HAVING NOT bool_or(NOT low_quality))
"""


@view("weak_master", "alias_history")
def _(d):
    """Master rows for the alternate names of the history: delisted, annotated, numeric-reason and active ones."""
    none = "CAST(array() AS array<string>)" if d.spark else "CAST([] AS VARCHAR[])"
    return f"""
SELECT match_key, name AS display_name, CASE WHEN first_seen_ms % 7 = 0 THEN '有効' ELSE '無効' END AS status, '制裁リスト' AS risk_type, '高' AS risk_level,
  first_seen_ms, last_changed_ms AS last_updated_ms, CASE WHEN first_seen_ms % 9 = 0 THEN {d.arr("'OFAC'")} ELSE {none} END AS sources, {none} AS categories,
  '制裁リスト' AS remark, CASE WHEN first_seen_ms % 7 = 0 THEN '' WHEN first_seen_ms % 5 = 1 THEN '数字のみ' WHEN first_seen_ms % 5 = 2 THEN 'OFAC現役Weak Aliasのため通常スクリーニング対象外' ELSE '{DELISTED}' END AS invalid_reason,
  CASE WHEN first_seen_ms % 5 = 2 THEN 'OFAC_WEAK_ALIAS_CURRENT' ELSE '' END AS review_flag, {d.arr('name')} AS variants
FROM alias_history WHERE name LIKE 'Alt %' OR name LIKE 'Gone %'
"""


@query("m3_weak_alias_sync", views=VIEWS + " weak_master", oracle=f"""
WITH {UPDATED}, {WEAK},
j AS (SELECT m.*, w.n, w.n IS NOT NULL AND status = '無効' AND (invalid_reason LIKE '全ての%' OR invalid_reason LIKE 'OFAC現役Weak%') AS annotate,
    w.n IS NULL AND (invalid_reason LIKE 'OFAC現役Weak%' OR review_flag LIKE 'OFAC_WEAK%') AS stale
  FROM weak_master m LEFT JOIN weak w ON w.match_key = m.match_key),
n AS (SELECT *, CASE WHEN annotate THEN CASE WHEN n > 1 THEN 'OFAC現役Weak Alias（複数Party）のため通常スクリーニング対象外' ELSE 'OFAC現役Weak Aliasのため通常スクリーニング対象外' END
      WHEN stale AND status = '有効' THEN '' WHEN stale AND len(sources) = 0 THEN '{DELISTED}' ELSE invalid_reason END AS nr,
    CASE WHEN annotate THEN CASE WHEN n > 1 THEN 'OFAC_WEAK_ALIAS_MULTI_PARTY' ELSE 'OFAC_WEAK_ALIAS_CURRENT' END
      WHEN stale AND (status = '有効' OR len(sources) = 0) AND review_flag LIKE 'OFAC_WEAK%' THEN '' ELSE review_flag END AS nfl FROM j)
SELECT match_key, status, nr AS invalid_reason, nfl AS review_flag, (nr <> invalid_reason OR nfl <> review_flag) AS changed,
  CASE WHEN nr <> invalid_reason OR nfl <> review_flag THEN 1700000000000 ELSE last_updated_ms END AS last_updated_ms FROM n
""")
def _(x):
    history = H.update_history(x.view("alias_history"), x.view("alias_records"), TS)
    return H.sync_weak_aliases(x.view("weak_master"), history, TS).select(
        "match_key", "status", "invalid_reason", "review_flag", "changed", "last_updated_ms")


@view("removed_parties")
def _(d):
    return f"SELECT {LIST} AS list, {PID} AS party_id FROM {d.t('customer')} WHERE c_custkey % 10 = 7 AND c_custkey % 11 <> 0 AND c_custkey % 13 <> 0"


@view("protected_parties")
def _(d):
    return f"SELECT {LIST} AS list, {PID} AS party_id FROM {d.t('customer')} WHERE c_custkey % 30 = 17"


@view("approvals")
def _(d):
    """Approval rows for the removed parties of one snapshot per list; a few parties are not approved."""
    return f"""
SELECT {LIST} AS list, {d.sha(LIST)} AS snapshot_sha256, {PID} AS party_id, 'Customer ' || {N9} AS party_name
FROM {d.t('customer')} WHERE c_custkey % 10 = 7 AND c_custkey % 4 <> 3
"""


EFFECTS = f"""
rp AS (SELECT DISTINCT h.match_key, h.list, h.party_id FROM hist2 h JOIN removed_parties USING (list, party_id)),
keys AS (SELECT match_key, count(*) AS n_parties FROM rp GROUP BY 1),
cs AS (SELECT DISTINCT match_key FROM hist2 WHERE party_current AND alias_current AND NOT low_quality),
ps AS (SELECT DISTINCT match_key FROM hist2 JOIN protected_parties USING (list, party_id) WHERE NOT low_quality),
eff AS (SELECT k.match_key, n_parties, m.* EXCLUDE (match_key), CASE WHEN m.match_key IS NULL THEN 'master_row_absent' WHEN k.match_key IN (SELECT match_key FROM cs) THEN 'kept_current_ofac_party'
      WHEN k.match_key IN (SELECT match_key FROM ps) THEN 'kept_pending_review_party' WHEN NOT list_contains(m.sources, 'OFAC') THEN 'ofac_source_absent'
      WHEN len(m.sources) = 1 THEN 'deactivated' ELSE 'removed_ofac_source' END AS action
  FROM keys k LEFT JOIN master m ON m.match_key = k.match_key),
eff2 AS (SELECT *, action IN ('deactivated', 'removed_ofac_source') AS applied,
    CASE WHEN action IN ('deactivated', 'removed_ofac_source') THEN list_filter(sources, lambda s: s <> 'OFAC') ELSE sources END AS ns,
    CASE WHEN action IN ('deactivated', 'removed_ofac_source') THEN list_filter(categories, lambda c: NOT starts_with(c, 'OFAC:')) ELSE categories END AS nc FROM eff)
"""
EFFECT_VIEWS = VIEWS + " removed_parties protected_parties master"


def _effects(x):
    history = H.update_history(x.view("alias_history"), x.view("alias_records"), TS)
    flags = H.removal_flags(history, x.view("removed_parties"), x.view("protected_parties"))
    return H.removal_effects(x.view("master"), flags, TS), H.removal_parties(flags)


@query("m4_approved_removal", views=EFFECT_VIEWS, oracle=f"""
WITH {UPDATED}, {EFFECTS}
SELECT match_key, coalesce(display_name, '') AS display_name, n_parties, action, coalesce(remark, '') AS before_remark,
  coalesce(CASE WHEN applied THEN {remark_sql('ns', 'nc')} ELSE remark END, '') AS after_remark,
  coalesce(CASE WHEN action = 'deactivated' THEN '無効' ELSE status END, '') AS after_status,
  coalesce(CASE WHEN action = 'deactivated' THEN '{DELISTED}' ELSE invalid_reason END, '') AS after_reason FROM eff2
""")
def _(x):
    e, _ = _effects(x)
    return e.select("match_key", "display_name", "n_parties", "action", *[
        F.coalesce(c, F.lit("")).alias(a) for c, a in (("before.remark", "before_remark"), ("after.remark", "after_remark"),
                                                       ("after.status", "after_status"), ("after.invalid_reason", "after_reason"))])


@query("m5_effect_audit", views=EFFECT_VIEWS + " approvals", oracle=f"""
WITH {UPDATED}, {EFFECTS},
n AS (SELECT a.list, a.party_id, a.snapshot_sha256, count(*) AS c FROM approvals a JOIN rp USING (list, party_id) GROUP BY ALL)
SELECT a.list, a.party_id, a.snapshot_sha256, a.party_name, coalesce(n.c, 0) AS effect_count, coalesce(rp.match_key, '') AS match_key, coalesce(e.action, '') AS action,
  CASE WHEN e.match_key IS NULL THEN '' ELSE '"match_key":"' || e.match_key || '"}}' END AS effect_tail
FROM approvals a LEFT JOIN rp ON rp.list = a.list AND rp.party_id = a.party_id LEFT JOIN eff2 e ON e.match_key = rp.match_key
LEFT JOIN n ON n.list = a.list AND n.party_id = a.party_id
""")
def _(x):
    effects, parties = _effects(x)
    audit = H.effect_audit(x.view("approvals"), effects, parties)
    return audit.withColumn("effect_tail", F.regexp_extract("effect_json", r'("match_key":"[^"]*"\})$', 1)).drop("effect_json")
