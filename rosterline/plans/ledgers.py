"""Review-ledger queries."""

from pyspark.sql import functions as F

from ..operators import ledgers as L
from .fixtures import Dialect, view
from .history import LIST, N9, PID
from .registry import query

TS = 1700000000000
DUCK = Dialect("duckdb")


@view("queue_base")
def _(d):
    """Queue rows before event ids: events of up to fifty neighbouring customers per list."""
    g = d.div("c_custkey", "50")
    return f"""
SELECT {LIST} AS list, {g} AS g, {PID} AS party_id, 'Customer ' || {N9} AS party_name,
  CASE {g} % 4 WHEN 1 THEN 'APPLIED' WHEN 2 THEN 'CANCELLED_REAPPEARED' ELSE 'PENDING_REVIEW' END AS status,
  {d.sha(LIST + f" || CAST({g} AS STRING)")} AS snapshot_sha256, 1600000000000 + {g} * 1000 AS detected_at_ms, c_custkey
FROM {d.t('customer')}
"""


@view("removal_queue", "queue_base")
def _(d):
    """Removal queue whose event ids are the digests of their party sets."""
    return f"""
SELECT e.event_id, q.list, q.snapshot_sha256, party_id, party_name, status, detected_at_ms, detected_at_ms + 5 AS last_seen_at_ms,
  CASE WHEN status = 'PENDING_REVIEW' THEN NULL ELSE detected_at_ms + 9 END AS resolved_at_ms,
  CASE status WHEN 'APPLIED' THEN 'HUMAN_APPROVED' WHEN 'CANCELLED_REAPPEARED' THEN 'REAPPEARED' ELSE '' END AS resolution, q.g, c_custkey
FROM queue_base q JOIN (SELECT list, g, {d.sha(f"concat_ws('|', list, min(snapshot_sha256), {d.set_digest('party_id')})")} AS event_id
  FROM queue_base GROUP BY list, g) e ON e.list = q.list AND e.g = q.g
"""


@view("current_parties")
def _(d):
    return f"SELECT {LIST} AS list, {PID} AS party_id FROM {d.t('customer')} WHERE c_custkey % 10 = 3 AND {d.div('c_custkey', '50')} % 3 = 0 OR c_custkey % 10 = 0"


@view("newly_removed")
def _(d):
    return f"SELECT {LIST} AS list, {PID} AS party_id FROM {d.t('customer')} WHERE c_custkey % 10 IN (7, 9)"


@view("snapshot_hashes")
def _(d):
    return f"SELECT DISTINCT {LIST} AS list, {d.sha(LIST + chr(32) + '||' + chr(32) + chr(39) + 'new' + chr(39))} AS snapshot_sha256 FROM {d.t('customer')}"


@view("party_names")
def _(d):
    return f"SELECT {LIST} AS list, {PID} AS party_id, 'Customer ' || {N9} AS party_name FROM {d.t('customer')}"


@query("m6_queue_reconcile", views="removal_queue current_parties newly_removed snapshot_hashes party_names", oracle=f"""
WITH back AS (SELECT DISTINCT event_id FROM removal_queue JOIN current_parties USING (list, party_id) WHERE status = 'PENDING_REVIEW'),
q AS (SELECT r.*, r.status = 'PENDING_REVIEW' AND r.event_id IN (SELECT event_id FROM back) AS cancelled,
    (r.list, r.party_id) IN (SELECT (list, party_id) FROM current_parties) AS here FROM removal_queue r),
kept AS (SELECT event_id, list, snapshot_sha256, party_id, party_name, CASE WHEN cancelled THEN 'CANCELLED_REAPPEARED' ELSE status END AS status, detected_at_ms,
    CASE WHEN status = 'PENDING_REVIEW' AND NOT cancelled THEN {TS} ELSE last_seen_at_ms END AS last_seen_at_ms,
    CASE WHEN cancelled THEN {TS} ELSE resolved_at_ms END AS resolved_at_ms, CASE WHEN cancelled THEN 'REAPPEARED' ELSE resolution END AS resolution FROM q),
wanted AS (SELECT list, party_id FROM newly_removed UNION SELECT list, party_id FROM q WHERE cancelled AND NOT here),
fresh AS (SELECT * FROM wanted EXCEPT SELECT list, party_id FROM kept WHERE status = 'PENDING_REVIEW'),
ev AS (SELECT f.list, s.snapshot_sha256, sha256(concat_ws('|', f.list, s.snapshot_sha256, {DUCK.set_digest('party_id')})) AS event_id
  FROM fresh f JOIN snapshot_hashes s ON s.list = f.list GROUP BY f.list, s.snapshot_sha256)
SELECT * REPLACE (coalesce(resolved_at_ms, -1) AS resolved_at_ms) FROM kept
UNION ALL SELECT event_id, f.list, ev.snapshot_sha256, f.party_id, n.party_name, 'PENDING_REVIEW', {TS}, {TS}, -1, ''
FROM fresh f JOIN ev ON ev.list = f.list JOIN party_names n ON n.list = f.list AND n.party_id = f.party_id
""")
def _(x):
    queue = x.view("removal_queue").drop("g", "c_custkey")
    return L.reconcile_queue(queue, x.view("newly_removed"), x.view("current_parties"), x.view("snapshot_hashes"), x.view("party_names"), TS).fillna(-1, "resolved_at_ms")


@query("m7_pending_groups", views="removal_queue", oracle="""
SELECT event_id, list, snapshot_sha256, count(DISTINCT party_id) AS n_parties FROM removal_queue WHERE status = 'PENDING_REVIEW' GROUP BY ALL
""")
def _(x):
    return L.pending_groups(x.view("removal_queue"))


@view("apply_requests", "removal_queue")
def _(d):
    """Approved parties: whole events, partial events and parties that are not pending."""
    return """
SELECT list, snapshot_sha256, party_id FROM removal_queue WHERE status = 'PENDING_REVIEW' AND (g % 3 = 0 OR g % 3 = 1 AND c_custkey % 10 = 3)
UNION ALL SELECT list, snapshot_sha256, party_id FROM removal_queue WHERE status = 'APPLIED' AND c_custkey % 20 = 1
"""


@query("m7_mark_applied", views="removal_queue apply_requests", oracle=f"""
WITH p AS (SELECT q.*, (q.list, q.snapshot_sha256, q.party_id) IN (SELECT (list, snapshot_sha256, party_id) FROM apply_requests) AS asked
  FROM removal_queue q WHERE status = 'PENDING_REVIEW'),
c AS (SELECT *, count(*) OVER (PARTITION BY event_id) AS n_all, count(*) FILTER (asked) OVER (PARTITION BY event_id) AS n_asked FROM p)
SELECT list, snapshot_sha256, party_id, event_id, CASE WHEN n_all = n_asked THEN 'APPLIED' ELSE status END AS status,
  CASE WHEN n_all = n_asked THEN {TS} ELSE -1 END AS resolved_at_ms, CASE WHEN n_all = n_asked THEN 'HUMAN_APPROVED' ELSE '' END AS resolution,
  CASE WHEN n_asked > 0 AND n_asked < n_all THEN 'PARTIAL_EVENT' END AS violation FROM c
UNION ALL
SELECT list, snapshot_sha256, party_id, '', '', -1, '', 'NOT_PENDING' FROM (
  SELECT list, snapshot_sha256, party_id FROM apply_requests EXCEPT SELECT list, snapshot_sha256, party_id FROM p)
""")
def _(x):
    return L.mark_applied(x.view("removal_queue"), x.view("apply_requests"), TS).fillna(-1, "resolved_at_ms")


@view("queue_approvals", "removal_queue")
def _(d):
    """Approvals per open event: none, exact, partial, with extras, and with names the history does not know."""
    return """
SELECT list, snapshot_sha256, party_id, CASE WHEN g % 7 = 3 AND c_custkey % 10 = 1 THEN 'Somebody else' ELSE party_name END AS party_name
FROM removal_queue WHERE g % 5 <> 0 AND NOT (g % 5 = 1 AND c_custkey % 10 = 7)
UNION ALL SELECT list, snapshot_sha256, party_id || '9', party_name FROM removal_queue WHERE g % 11 = 4 AND c_custkey % 10 = 1
"""


@query("j7_approval_authorisation", views="removal_queue queue_approvals party_names", oracle="""
WITH d AS (SELECT DISTINCT list, snapshot_sha256, party_id FROM removal_queue WHERE status = 'PENDING_REVIEW'),
a AS (SELECT list, snapshot_sha256, party_id, bool_and((list, party_id, party_name) IN (SELECT (list, party_id, party_name) FROM party_names)) AS ok FROM queue_approvals GROUP BY ALL),
j AS (SELECT coalesce(d.list, a.list) AS list, coalesce(d.snapshot_sha256, a.snapshot_sha256) AS snapshot_sha256, d.party_id AS dp, a.party_id AS ap, ok
  FROM d FULL JOIN a ON d.list = a.list AND d.snapshot_sha256 = a.snapshot_sha256 AND d.party_id = a.party_id),
s AS (SELECT list, snapshot_sha256, count(dp) AS n_detected, count(ap) AS n_approved, count(*) FILTER (ap IS NULL) AS n_missing, count(*) FILTER (dp IS NULL) AS n_extra,
    count(*) FILTER (ap IS NOT NULL AND NOT ok) AS n_unknown_names FROM j GROUP BY ALL)
SELECT *, CASE WHEN n_approved = 0 THEN 'PENDING' WHEN n_missing > 0 OR n_extra > 0 THEN 'SET_MISMATCH' WHEN n_unknown_names > 0 THEN 'NAME_MISMATCH' ELSE 'AUTHORIZED' END AS state
FROM s WHERE n_detected > 0
""")
def _(x):
    history = x.view("party_names").withColumnRenamed("party_name", "name")
    return L.authorise(x.view("queue_approvals"), x.view("removal_queue").filter("status = 'PENDING_REVIEW'"), history)


@query("q11_url_policy", oracle="""
WITH u AS (SELECT page_id, url, lower(regexp_extract(url, '^([a-z]+)://', 1)) AS scheme, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM pages)
SELECT page_id, url, scheme = 'https' AND (host = 'example.com' OR host LIKE '%.example.com') AS official FROM u
""")
def _(x):
    return L.url_policy(x.table("pages").select("page_id", "url"), "url", ["example.com"], [])


@view("faulty_approvals")
def _(d):
    """Approval ledger with one planted fault per row class."""
    k = "c_custkey"
    return f"""
SELECT {LIST} AS list, CASE WHEN {k} % 17 = 3 THEN 'XYZ' ELSE {d.sha(LIST)} END AS snapshot_sha256, {PID} AS party_id,
  CASE WHEN {k} % 19 = 4 THEN ' ' ELSE 'Customer ' || {N9} END AS party_name, CASE WHEN {k} % 23 = 5 THEN 'REJECTED' ELSE 'APPROVED' END AS decision,
  CASE WHEN {k} % 29 = 6 THEN '' ELSE 'operator' END AS approved_by,
  CASE {k} % 31 WHEN 7 THEN '2026-09-05T10:00:00' WHEN 8 THEN '5 Sept 2026' WHEN 9 THEN '2026-13-05T10:00:00Z' WHEN 10 THEN '2026-09-05T10:00:00+09:00' ELSE '2026-09-05T10:00:00Z' END AS approved_at,
  CASE {k} % 37 WHEN 1 THEN 'http://treasury.gov/x' WHEN 2 THEN 'https://treasury.gov.example.net/x' WHEN 3 THEN 'https://nottreasury.gov/'
    WHEN 4 THEN 'https://sanctionslistservice.ofac.treas.gov/a' ELSE 'https://ofac.treasury.gov/faq' END AS official_url
FROM {d.t('customer')}
UNION ALL
SELECT {LIST}, {d.sha(LIST)}, {PID}, 'Customer ' || {N9}, 'APPROVED', 'operator', '2026-09-05T10:00:00Z', 'https://treasury.gov/' FROM {d.t('customer')} WHERE {k} % 41 = 11 AND {k} % 17 <> 3
"""


@query("q12_ledger_validation", views="faulty_approvals", oracle="""
WITH n AS (SELECT *, count(*) OVER (PARTITION BY list, snapshot_sha256, party_id) AS c FROM faulty_approvals)
SELECT list, snapshot_sha256, party_id, unnest(list_filter([
  CASE WHEN trim(party_name) = '' THEN 'MISSING:party_name' END, CASE WHEN approved_by = '' THEN 'MISSING:approved_by' END,
  CASE WHEN snapshot_sha256 = 'XYZ' THEN 'BAD_HASH' END, CASE WHEN decision <> 'APPROVED' THEN 'BAD_DECISION' END,
  CASE WHEN approved_at = '2026-09-05T10:00:00' THEN 'NO_TIMEZONE' WHEN approved_at IN ('5 Sept 2026', '2026-13-05T10:00:00Z') THEN 'BAD_TIMESTAMP' END,
  CASE WHEN official_url LIKE 'http://%' OR official_url LIKE '%nottreasury%' OR official_url LIKE '%example.net%' THEN 'UNOFFICIAL_URL' END,
  CASE WHEN c > 1 THEN 'DUPLICATE' END], lambda v: v IS NOT NULL)) AS violation FROM n
""")
def _(x):
    return L.approval_violations(x.view("faulty_approvals"))


@view("faulty_queue", "removal_queue")
def _(d):
    """Removal queue with planted faults: wrong ids, mixed metadata, partial transitions, repeats, twice-open parties."""
    return """
SELECT CASE WHEN g % 9 = 1 THEN 'x' || substr(event_id, 2) ELSE event_id END AS event_id, list,
  CASE WHEN g % 9 = 2 AND c_custkey % 10 = 1 THEN 'other' ELSE snapshot_sha256 END AS snapshot_sha256, party_id, party_name,
  CASE WHEN g % 9 = 3 AND c_custkey % 10 = 7 THEN 'PENDING_REVIEW' ELSE status END AS status, detected_at_ms,
  CASE WHEN g % 9 = 3 AND c_custkey % 10 = 7 THEN '' ELSE resolution END AS resolution FROM removal_queue
UNION ALL SELECT event_id, list, snapshot_sha256, party_id, party_name, status, detected_at_ms, resolution FROM removal_queue WHERE g % 9 = 4 AND c_custkey % 20 = 1
UNION ALL SELECT 'twice' || party_id, list, snapshot_sha256, party_id, party_name, 'PENDING_REVIEW', detected_at_ms, '' FROM removal_queue WHERE g % 9 = 5 AND c_custkey % 30 = 11 AND status = 'PENDING_REVIEW'
"""


@query("q13_queue_consistency", views="faulty_queue", oracle=f"""
WITH dup AS (SELECT DISTINCT event_id, 'DUPLICATE_ROW' AS violation FROM (SELECT event_id, party_id FROM faulty_queue GROUP BY ALL HAVING count(*) > 1)),
op AS (SELECT * FROM faulty_queue WHERE status = 'PENDING_REVIEW'),
tw AS (SELECT DISTINCT event_id, 'PARTY_OPEN_TWICE' AS violation FROM op WHERE (list, party_id) IN (SELECT (list, party_id) FROM op GROUP BY list, party_id HAVING count(*) > 1)),
ev AS (SELECT event_id, count(DISTINCT (list, snapshot_sha256, detected_at_ms)) > 1 AS mixed, count(DISTINCT (status, resolution)) > 1 AS partial,
    min(list) AS list, min(snapshot_sha256) AS sha FROM faulty_queue GROUP BY 1),
dg AS (SELECT event_id, {DUCK.set_digest('party_id')} AS members FROM (SELECT DISTINCT event_id, party_id FROM faulty_queue) GROUP BY 1)
SELECT * FROM dup UNION ALL SELECT * FROM tw
UNION ALL SELECT event_id, 'MIXED_METADATA' FROM ev WHERE mixed
UNION ALL SELECT event_id, 'PARTIAL_TRANSITION' FROM ev WHERE partial
UNION ALL SELECT event_id, 'ID_MISMATCH' FROM ev JOIN dg USING (event_id) WHERE NOT mixed AND event_id <> sha256(concat_ws('|', list, sha, members))
""")
def _(x):
    return L.queue_violations(x.view("faulty_queue"))


@view("document_events")
def _(d):
    """Evidence log: one observation per document, and review entries that need no queue row."""
    return f"""
SELECT {d.sha("'e' || CAST(doc_id AS STRING)")} AS event_id, CASE WHEN doc_id % 13 = 0 THEN 'DOCUMENT_REVIEW' ELSE 'DETECTED' END AS event_type,
  {d.sha('text')} AS source_hash, source AS url, lang AS title, 'REVIEW_REQUIRED_DOCUMENT' AS review_status FROM {d.t('documents')}
"""


@view("document_queue", "document_events")
def _(d):
    """Review queue of the log with orphans, missing rows and altered evidence."""
    return f"""
SELECT {d.sha("'e' || CAST(doc_id AS STRING)")} AS event_id, CASE WHEN doc_id % 17 = 2 THEN 'changed' ELSE {d.sha('text')} END AS source_hash,
  CASE WHEN doc_id % 19 = 3 THEN 'elsewhere' ELSE source END AS url, lang AS title, CASE doc_id % 3 WHEN 0 THEN 'REVIEWED_DOCUMENT' ELSE 'REVIEW_REQUIRED_DOCUMENT' END AS review_status
FROM {d.t('documents')} WHERE doc_id % 13 <> 0 AND doc_id % 23 <> 4
UNION ALL SELECT 'orphan' || CAST(doc_id AS STRING), 'h', 'u', 't', 'REVIEWED_DOCUMENT' FROM {d.t('documents')} WHERE doc_id % 29 = 5
"""


@query("q14_evidence_integrity", views="document_events document_queue", oracle="""
WITH e AS (SELECT * FROM document_events WHERE event_type <> 'DOCUMENT_REVIEW')
SELECT coalesce(e.event_id, q.event_id) AS event_id, CASE WHEN e.event_id IS NULL THEN 'ORPHAN_QUEUE_ROW' WHEN q.event_id IS NULL THEN 'MISSING_QUEUE_ROW'
  WHEN e.source_hash <> q.source_hash THEN 'CONFLICTING_HASH' ELSE 'EVIDENCE_CHANGED' END AS violation
FROM e FULL JOIN document_queue q ON q.event_id = e.event_id
WHERE e.event_id IS NULL OR q.event_id IS NULL OR (e.source_hash, e.url, e.title) IS DISTINCT FROM (q.source_hash, q.url, q.title)
""")
def _(x):
    return L.evidence_integrity(x.view("document_events"), x.view("document_queue"), ["source_hash", "url", "title"])


# --- published change log ----------------------------------------------------------------

REVIEWS = """
reviews AS (SELECT DISTINCT strftime(epoch_ms(detected_at_ms) + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS detected_at, 'OFAC' AS source, '掲載終了候補（要確認）' AS kind,
  party_name AS name, '制裁リスト（OFAC：' || list || '）; FixedRef=' || party_id || '; event_id=' || event_id || '; SHA256=' || snapshot_sha256 AS before_text,
  '削除承認待ち（名簿は有効のまま・削除未反映）' AS after_text FROM removal_queue WHERE status = 'PENDING_REVIEW')
"""


@query("w4_open_reviews", views="removal_queue", oracle=f"WITH {REVIEWS} SELECT * FROM reviews")
def _(x):
    return L.open_reviews(x.view("removal_queue"))


@view("change_log")
def _(d):
    """Published changes, newest first by ``ord``; repeated keys, resolved and foreign kinds planted."""
    return f"""
SELECT {d.iso('o_orderdate')} AS detected_at, 'OFAC' AS source, CASE o_orderkey % 6 WHEN 0 THEN '追加' WHEN 1 THEN '変更' WHEN 2 THEN '掲載終了'
    WHEN 3 THEN '掲載終了候補（要確認）' WHEN 4 THEN '初回同期（Advanced XML）' ELSE '情報改訂' END AS kind,
  'Customer ' || CAST(o_custkey % 200 AS STRING) AS name, '' AS before_text, 'x' || CAST(o_orderkey % 3 AS STRING) AS after_text,
  CASE o_orderkey % 5 WHEN 0 THEN '完了' WHEN 1 THEN '' WHEN 2 THEN ' 対応中 ' ELSE '未確認' END AS status, 'n' || CAST(o_orderkey AS STRING) AS note, o_orderkey AS ord
FROM {d.t('orders')}
"""


@query("w3_pinned_retention", views="removal_queue change_log", oracle=f"""
WITH {REVIEWS},
h AS (SELECT c.*, row_number() OVER (ORDER BY ord) AS rn FROM change_log c
  WHERE (detected_at, source, kind, name, before_text, after_text) NOT IN (SELECT (detected_at, source, kind, name, before_text, after_text) FROM reviews)),
n AS (SELECT count(*) AS n FROM reviews)
SELECT detected_at, source, kind, name, before_text, after_text, true AS pinned, true AS kept FROM reviews
UNION ALL SELECT detected_at, source, kind, name, before_text, after_text, false, rn <= greatest(5000, n) - n FROM h, n
""")
def _(x):
    return L.retain_changes(x.view("change_log"), x.view("removal_queue"))


KEY = "concat_ws('|', detected_at, source, kind, name, before_text, after_text)"


@query("w6_unresolved_queue", views="change_log", oracle=f"""
WITH s AS (SELECT {KEY} AS key, arg_max(status, ord) AS st FROM change_log WHERE ord % 7 <> 3 GROUP BY 1),
h AS (SELECT c.* EXCLUDE (status), {KEY} AS key, CASE WHEN trim(coalesce(s.st, status)) = '' THEN '未確認' ELSE trim(coalesce(s.st, status)) END AS status
  FROM change_log c LEFT JOIN s ON s.key = {KEY}),
f AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ord) AS rn FROM h
  WHERE kind IN ('追加', '変更', '掲載終了', '掲載終了候補（要確認）') AND status NOT IN ('対応済', '対応済み', '完了', '処理済'))
SELECT key, detected_at, source, kind, name, before_text, after_text, status, ord FROM f WHERE rn = 1
""")
def _(x):
    log = x.view("change_log")
    statuses = log.filter("ord % 7 <> 3").select(L.change_key().alias("key"), "status", "ord")
    return L.unresolved_queue(log, statuses)


@query("m11_mirror_upsert", views="change_log", oracle=f"""
WITH o AS (SELECT * FROM (SELECT *, {KEY} AS key, row_number() OVER (PARTITION BY {KEY} ORDER BY ord) AS rn FROM change_log WHERE ord % 3 <> 0) WHERE rn = 1),
n AS (SELECT * FROM (SELECT *, {KEY} AS key, row_number() OVER (PARTITION BY {KEY} ORDER BY ord) AS rn FROM change_log WHERE ord % 2 = 0) WHERE rn = 1),
j AS (SELECT coalesce(n.key, o.key) AS key, coalesce(n.detected_at, o.detected_at) AS detected_at, coalesce(n.source, o.source) AS source, coalesce(n.kind, o.kind) AS kind,
    coalesce(n.name, o.name) AS name, coalesce(n.before_text, o.before_text) AS before_text, coalesce(n.after_text, o.after_text) AS after_text,
    CASE WHEN coalesce(o.status, '') = '' THEN '未確認' ELSE o.status END AS status, coalesce(o.note, '') AS note, coalesce(n.ord, o.ord) AS ord, o.key IS NULL AS is_new
  FROM o FULL JOIN n ON n.key = o.key)
SELECT * FROM j
""")
def _(x):
    log = x.view("change_log")
    return L.mirror_changes(log.filter("ord % 3 <> 0"), log.filter("ord % 2 = 0"))


@view("review_mirror")
def _(d):
    """Mirrored and incoming re-review cases of the orders: some blank and repeated case ids, reviewer columns on mirrored rows."""
    case = "CASE WHEN o_orderkey % 41 = 3 THEN ' ' WHEN o_orderkey % 37 = 5 THEN 'case-' || CAST(o_custkey AS STRING) ELSE 'case-o' || CAST(o_orderkey AS STRING) END"
    return f"""
SELECT 'existing' AS side, {case} AS case_id, 'old ' || o_orderstatus AS state, o_orderpriority AS priority, CASE WHEN o_orderkey % 5 = 1 THEN 'done' ELSE '' END AS decision,
  'reviewer ' || CAST(o_custkey % 9 AS STRING) AS reviewer, o_orderkey AS ord FROM {d.t('orders')} WHERE o_orderkey % 4 <> 1
UNION ALL SELECT 'incoming', {case}, 'new ' || o_orderstatus, o_orderpriority, '', '', o_orderkey FROM {d.t('orders')} WHERE o_orderkey % 4 <> 2
"""


MIRROR = """
c AS (SELECT * REPLACE (trim(case_id) AS case_id) FROM review_mirror),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY side, case_id ORDER BY ord) AS rn FROM c) WHERE rn = 1 AND case_id <> ''),
o AS (SELECT * FROM f WHERE side = 'existing'), n AS (SELECT * FROM f WHERE side = 'incoming')
"""


def _mirror(x):
    rows = x.view("review_mirror")
    return L.mirror_reviews(rows.filter("side = 'existing'"), rows.filter("side = 'incoming'"), ["state", "priority"], ["decision", "reviewer"])


@query("m11_review_mirror", views="review_mirror", oracle=f"""
WITH {MIRROR}
SELECT coalesce(o.case_id, n.case_id) AS case_id, coalesce(n.state, o.state) AS state, coalesce(n.priority, o.priority) AS priority, coalesce(o.decision, '') AS decision,
  coalesce(o.reviewer, '') AS reviewer, coalesce(n.ord, o.ord) AS ord, o.case_id IS NULL AS is_new FROM o FULL JOIN n ON n.case_id = o.case_id
""")
def _(x):
    return _mirror(x)[0]


@query("m11_review_violations", views="review_mirror", oracle=f"""
WITH {MIRROR}
SELECT side, case_id, count(*) AS n_rows, CASE WHEN case_id = '' THEN 'BLANK_CASE_ID' ELSE 'DUPLICATE_CASE_ID' END AS violation FROM c GROUP BY side, case_id HAVING count(*) > 1 OR case_id = ''
""")
def _(x):
    return _mirror(x)[1]


# --- evidence and documents --------------------------------------------------------------

@view("evidence_table")
def _(d):
    """Earlier evidence rows, up to two per company; some without a first date."""
    return f"""
SELECT 'Customer ' || {N9} AS canonical_record, 'customer' || {N9} AS match_key, 'h0:' || {PID} AS source_record_id,
  CASE WHEN c_custkey % 9 = 0 THEN '' ELSE '2020-01-' || lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') END AS first_seen, '2021-01-01' AS last_seen, '{{}}' AS evidence, c_custkey AS ord
FROM {d.t('customer')} WHERE c_custkey % 3 <> 1
UNION ALL
SELECT 'CUSTOMER ' || {N9}, 'customer' || {N9}, 'h1:' || {PID}, '2019-06-01', '2022-01-01', '{{}}', 1000000000 + c_custkey FROM {d.t('customer')} WHERE c_custkey % 6 = 3
"""


@query("m8_evidence_upsert", views="evidence_table records_new", oracle="""
WITH f AS (SELECT match_key, arg_min(first_seen, ord) AS c FROM evidence_table WHERE first_seen <> '' GROUP BY 1)
SELECT canonical_record, match_key, source_record_id, first_seen, last_seen, false AS current, evidence FROM evidence_table
UNION ALL
SELECT company, k, 'h9:' || record_no, coalesce(f.c, '2026-01-01'), '2026-01-01', true,
  '{"record_no":' || record_no || ',"country":"' || country || '","aliases":["' || aliases[1] || '","' || aliases[2] || '"],"wmd":"' || wmd || '","conventional_weapons":"' || conventional_weapons || '"}'
FROM (SELECT *, lower(replace(company, ' ', '')) AS k FROM records_new) r LEFT JOIN f ON f.match_key = k
""")
def _(x):
    return L.update_evidence(x.view("evidence_table"), x.view("records_new"), "h9", "2026-01-01")


@view("document_links")
def _(d):
    """Attachments that a notice requires, one per document."""
    return f"""
SELECT 'attachment:' || CAST(doc_id AS STRING) AS {d.q('key')}, CAST({d.div('doc_id', '5')} AS STRING) AS notice_url, 'https://host.example/' || CAST(doc_id AS STRING) || '.pdf' AS url,
  '2026-01-' || lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0') AS observed_at, source || '-' || CAST({d.div('doc_id', '20')} AS STRING) AS family FROM {d.t('documents')}
"""


@view("document_resources")
def _(d):
    """Fetched resources: renamed keys, changed urls, unavailable and outdated ones."""
    return f"""
SELECT CASE WHEN doc_id % 7 = 1 THEN 'import:' || CAST(doc_id AS STRING) ELSE 'attachment:' || CAST(doc_id AS STRING) END AS {d.q('key')},
  CAST({d.div('doc_id', '5')} AS STRING) AS notice_url, 'https://host.example/' || CAST(doc_id AS STRING) || CASE WHEN doc_id % 11 = 2 THEN '-v2.pdf' ELSE '.pdf' END AS url,
  doc_id % 13 <> 3 AS available, CASE WHEN doc_id % 17 = 4 THEN '2025-12-31' ELSE '2026-02-01' END AS last_success_at,
  source || '-' || CAST({d.div('doc_id', '20')} AS STRING) AS family FROM {d.t('documents')} WHERE doc_id % 19 <> 5
"""


MISSING = """
hit AS (SELECT l.*, r.key AS rk, r.url AS ru, r.available AS av, r.last_success_at AS ls FROM document_links l JOIN document_resources r ON r.key = l.key
  UNION ALL SELECT l.*, r.key, r.url, r.available, r.last_success_at FROM document_links l LEFT JOIN document_resources r ON r.url = l.url AND r.notice_url = l.notice_url
  WHERE l.key NOT IN (SELECT key FROM document_resources)),
miss AS (SELECT *, CASE WHEN rk IS NULL THEN 'NO_RESOURCE' WHEN NOT av THEN 'UNAVAILABLE' WHEN ru <> url THEN 'URL_CHANGED' WHEN ls < observed_at THEN 'STALE' END AS reason FROM hit)
"""


@query("j11_document_completeness", views="document_links document_resources", oracle=f"""
WITH {MISSING} SELECT DISTINCT notice_url, coalesce(rk, key) AS pending_key, reason FROM miss WHERE reason IS NOT NULL
""")
def _(x):
    return L.missing_documents(x.view("document_links").drop("family"), x.view("document_resources").drop("family"))


@view("site_resources")
def _(d):
    """Resources of many sites: notices, attachments and the two current lists; some unavailable, some without a link."""
    key = "CASE WHEN doc_id % 7 = 1 THEN 'import:' || CAST(doc_id AS STRING) ELSE 'attachment:' || CAST(doc_id AS STRING) END"
    site = "source"
    return f"""
SELECT {site} AS site, CASE WHEN doc_id % 3 = 0 THEN 'notice:' || CAST(doc_id AS STRING) ELSE {key} END AS {d.q('key')}, CASE WHEN doc_id % 3 = 0 THEN 'notice' ELSE 'attachment_pdf' END AS role,
  'https://host.example/' || CAST(doc_id AS STRING) || CASE WHEN doc_id % 11 = 2 THEN '-v2.pdf' ELSE '.pdf' END AS url, CAST({d.div('doc_id', '5')} AS STRING) AS notice_url,
  doc_id % 13 <> 3 AS available, CASE WHEN doc_id % 17 = 4 THEN '2025-12-31' ELSE '2026-02-01' END AS last_success_at FROM {d.t('documents')} WHERE doc_id % 19 <> 5
UNION ALL SELECT {site}, CASE WHEN doc_id % 10 = 1 THEN 'current_un' ELSE 'current_1373' END, 'current_pdf', 'https://host.example/c', '', doc_id % 100 < 50, '2026-02-01' FROM {d.t('documents')} WHERE doc_id % 10 IN (1, 2)
"""


@view("site_links")
def _(d):
    """Attachments that press notices name."""
    return f"""SELECT source AS site, 'attachment:' || CAST(doc_id AS STRING) AS {d.q('key')}, CAST({d.div('doc_id', '5')} AS STRING) AS notice_url,
  'https://host.example/' || CAST(doc_id AS STRING) || '.pdf' AS url, '2026-01-01' AS observed_at FROM {d.t('documents')} WHERE doc_id % 3 = 1"""


@view("site_notices")
def _(d):
    return f"SELECT source AS site, 'pending:' || CAST(doc_id AS STRING) AS {d.q('key')} FROM {d.t('documents')} WHERE doc_id % 23 = 6"


PENDING = """
res AS (SELECT * FROM site_resources WHERE role = 'attachment_pdf'),
hit AS (SELECT l.*, r.key AS rk, r.url AS ru, r.available AS av, r.last_success_at AS ls FROM site_links l JOIN res r ON r.site = l.site AND r.key = l.key
  UNION ALL SELECT l.*, r.key, r.url, r.available, r.last_success_at FROM site_links l LEFT JOIN res r ON r.site = l.site AND r.url = l.url AND r.notice_url = l.notice_url
  WHERE NOT EXISTS (SELECT 1 FROM res k WHERE k.site = l.site AND k.key = l.key)),
linked AS (SELECT site, coalesce(rk, key) AS pending_key, CASE WHEN rk IS NULL THEN 'NO_RESOURCE' WHEN NOT av THEN 'UNAVAILABLE' WHEN ru <> url THEN 'URL_CHANGED' WHEN ls < observed_at THEN 'STALE' END AS reason FROM hit),
own AS (SELECT site, key AS pending_key FROM site_resources WHERE role <> 'current_pdf' AND NOT available),
lists AS (SELECT s.site, k.key FROM (SELECT DISTINCT site FROM site_resources) s, (VALUES ('current_un'), ('current_1373')) AS k(key)),
pending AS (
  SELECT site, 'catalog' AS family, key AS pending_key, 'NO_CURRENT_LIST' AS reason FROM lists l
    WHERE NOT EXISTS (SELECT 1 FROM site_resources r WHERE r.site = l.site AND r.key = l.key AND r.role = 'current_pdf' AND r.available)
  UNION ALL SELECT site, 'press', pending_key, min(reason) FROM linked WHERE reason IS NOT NULL GROUP BY ALL
  UNION ALL SELECT DISTINCT site, 'press', pending_key, 'UNAVAILABLE' FROM own o WHERE NOT EXISTS (SELECT 1 FROM linked l WHERE l.reason IS NOT NULL AND l.site = o.site AND l.pending_key = o.pending_key)
  UNION ALL SELECT site, 'press', key, 'PENDING_NOTICE' FROM site_notices)
"""


@query("j11_pending_documents", views="site_resources site_links site_notices", oracle=f"WITH {PENDING} SELECT * FROM pending")
def _(x):
    resources = x.view("site_resources")
    return L.pending_documents(resources.select("site").distinct(), resources, x.view("site_links"), x.view("site_notices"))


@view("document_families")
def _(d):
    return f"""
SELECT family, min(doc_id) % 5 = 1 AS coverage_gap, min(doc_id) % 7 = 2 AS declared_pending, CASE WHEN min(doc_id) % 3 = 0 THEN '' ELSE '2026-01-01' END AS last_manual_check_at
FROM (SELECT source || '-' || CAST({d.div('doc_id', '20')} AS STRING) AS family, doc_id FROM {d.t('documents')}) f GROUP BY family
"""


def _family(d) -> str:
    return f"source || '-' || CAST({d.div('doc_id', '20')} AS STRING)"


@view("family_queue")
def _(d):
    return f"""SELECT {_family(d)} AS family, CASE WHEN doc_id % 4 = 0 THEN 'REVIEW_REQUIRED_DOCUMENT' ELSE 'REVIEWED_DOCUMENT' END AS review_status FROM {d.t('documents')} WHERE doc_id % 8 < 5"""


@view("family_missing")
def _(d):
    return f"SELECT {_family(d)} AS family FROM {d.t('documents')} WHERE doc_id % 31 = 6"


@view("family_errors")
def _(d):
    return f"SELECT {_family(d)} AS family FROM {d.t('documents')} WHERE doc_id % 43 = 7"


@query("a9_family_status", views="document_families document_resources family_queue family_missing family_errors", oracle="""
WITH c AS (SELECT f.*, (SELECT count(*) FROM document_resources r WHERE r.family = f.family) AS nr,
    (SELECT count(*) FROM family_queue q WHERE q.family = f.family AND review_status = 'REVIEW_REQUIRED_DOCUMENT') AS review_count,
    (SELECT count(*) FROM family_missing m WHERE m.family = f.family) AS pending_count, (SELECT count(*) FROM family_errors e WHERE e.family = f.family) AS ne FROM document_families f)
SELECT family, CASE WHEN coverage_gap THEN 'COVERAGE_GAP' WHEN ne > 0 THEN 'manual_error'
    WHEN declared_pending OR pending_count > 0 THEN CASE WHEN nr > 0 OR declared_pending OR last_manual_check_at <> '' THEN 'manual_pending' ELSE 'manual_required' END
    WHEN review_count > 0 THEN 'manual_review' WHEN last_manual_check_at <> '' THEN 'manual_checked' ELSE 'manual_required' END AS status, pending_count, review_count FROM c
""")
def _(x):
    return L.family_status(x.view("document_families"), x.view("document_resources"), x.view("family_queue"), x.view("family_missing"), x.view("family_errors"))
