"""Monitoring queries."""

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import monitoring as M
from .fixtures import view
from .registry import query

ASOF = "2024-01-31 12:00:00"


@view("heartbeats")
def _(d):
    """Heartbeat history: a check per event, with repeated rows and an unmanaged source."""
    src = "CASE event_id % 7 WHEN 0 THEN 'ofac_sdn' WHEN 1 THEN 'ofac_cons' WHEN 2 THEN 'mof' WHEN 3 THEN 'meti' WHEN 4 THEN 'mofa_catalog' WHEN 5 THEN 'mofa_press' ELSE 'other' END"
    st = "CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'unchanged' WHEN 'purchase' THEN 'changed' ELSE 'fetched' END"
    one = f"""SELECT {src} AS source, {d.iso('ts')} AS checked_at, ts, {st} AS status, {d.sha('props')} AS content_hash,
  CASE WHEN event_id % 3 = 0 THEN '' ELSE 'Wed, 10 Jan 2024 0' || CAST(event_id % 10 AS STRING) || ':00:00 GMT' END AS source_updated,
  CASE WHEN event_id % 4 = 0 THEN '' ELSE CAST(event_id AS STRING) END AS record_count, event_id * 2 AS ord FROM {d.t('events')}"""
    return f"{one} UNION ALL {one.replace('event_id * 2 AS ord', 'event_id * 2 + 1 AS ord')} WHERE event_id % 50 = 0"


@view("current_beats", "heartbeats")
def _(d):
    """Rows of the running check: the newest history time of some sources with another status."""
    return """SELECT source, max(checked_at) AS checked_at, 'review_required' AS status, 'cafe' AS content_hash, '' AS source_updated, '' AS record_count, max(ord) AS ord
FROM heartbeats WHERE source IN ('ofac_sdn', 'mof') GROUP BY source"""


LATEST = """
u AS (SELECT *, 0 AS cur, -ord AS o FROM heartbeats UNION ALL SELECT source, checked_at, NULL, status, content_hash, source_updated, record_count, ord, 1, ord FROM current_beats),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY checked_at DESC, cur DESC, o DESC) AS rn FROM u
  WHERE source IN ('mof', 'meti', 'ofac_sdn', 'ofac_cons', 'mofa_catalog', 'mofa_press')) WHERE rn = 1)
"""


def _latest(x):
    return M.latest_heartbeats(x.view("heartbeats"), x.view("current_beats"))


@query("w1_latest_heartbeats", views="heartbeats current_beats", oracle=f"""
WITH {LATEST} SELECT source, checked_at, status, content_hash, source_updated, record_count FROM latest
""")
def _(x):
    return _latest(x)


@view("source_state", "heartbeats")
def _(d):
    """Control table per source."""
    return """SELECT source, '' AS source_updated, '令和6年' AS asof, CAST(count(*) AS STRING) AS record_count, min(content_hash) AS sha256 FROM heartbeats GROUP BY source"""


@view("manual_state", "heartbeats")
def _(d):
    return """SELECT source, 'DETECTED' AS lifecycle_state, max(checked_at) AS sla_breached_at, min(checked_at) AS last_check_at, '2024-01-05' AS effective_date,
  CAST(count(*) AS STRING) AS record_count, max(content_hash) AS source_hash FROM heartbeats WHERE source = 'meti' GROUP BY source"""


@view("family_state", "heartbeats")
def _(d):
    return """SELECT source, 'manual_review' AS status, max(checked_at) AS checked_at, '' AS changed_at, max(content_hash) AS sha256 FROM heartbeats WHERE source = 'mofa_catalog' GROUP BY source"""


def jst(x: str) -> str:
    return f"strftime(strptime({x}, '%Y-%m-%dT%H:%M:%SZ') + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S')"


# Written out, so that the oracle does not follow the engine's own tables.
STATUS = """
    WHEN 'fetched' THEN '取得あり' WHEN 'changed' THEN '更新あり' WHEN 'no_effective_change' THEN '元データ更新・実質変更なし' WHEN 'unchanged' THEN '変更なし'
    WHEN 'review_required' THEN '掲載終了候補・要レビュー' WHEN 'updated' THEN '更新あり（要手動確認）' WHEN 'blocked' THEN '自動取得不可' WHEN 'error' THEN 'エラー'
    WHEN 'manual_ok' THEN '手動監視（正常）' WHEN 'manual_pending' THEN '要確認：正本取得待ち' WHEN 'manual_review' THEN '要レビュー'
    WHEN 'manual_approved' THEN '要確認：反映待ち' WHEN 'manual_critical' THEN '重大：更新候補未検証' WHEN 'manual_blocked' THEN '重大：正本解析BLOCKED'
    WHEN 'manual_rejected' THEN '要確認：取込却下'
"""
LABELS = """
    (0, 'mof', '財務省'),
    (1, 'meti', '経済産業省'),
    (2, 'ofac_sdn', 'OFAC SDN'),
    (3, 'ofac_cons', 'OFAC Consolidated'),
    (4, 'mofa_catalog', '外務省（現行リスト）'),
    (5, 'mofa_press', '外務省（報道発表）')
"""
STATUS_VIEWS = "heartbeats current_beats source_state manual_state family_state"
TABLE = f"""
labels(position, key, label) AS (VALUES {LABELS}),
stat AS (SELECT b.position, b.label AS source,
    CASE WHEN key = 'mofa_catalog' THEN '資料更新・要レビュー（手動取得）' WHEN key = 'mofa_press' THEN '自動取得不可・手動確認待ち' WHEN key = 'meti' THEN '重大：更新候補未検証' ELSE CASE l.status {STATUS} END END AS state,
    CASE WHEN key = 'mofa_catalog' THEN {jst('f.checked_at')} WHEN key = 'mofa_press' THEN '' WHEN key = 'meti' THEN {jst('m.last_check_at')} ELSE {jst('l.checked_at')} END AS last_check,
    CASE WHEN key LIKE 'mofa%' THEN '' WHEN key = 'meti' THEN m.effective_date
      WHEN l.source_updated <> '' THEN strftime(strptime(l.source_updated, '%a, %d %b %Y %H:%M:%S GMT') + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') ELSE s.asof END AS source_updated,
    CASE WHEN key LIKE 'mofa%' THEN '' WHEN key = 'meti' THEN m.record_count WHEN l.record_count <> '' THEN l.record_count ELSE s.record_count END AS record_count,
    CASE WHEN key = 'mofa_catalog' THEN substr(f.sha256, 1, 12) WHEN key = 'mofa_press' THEN '' WHEN key = 'meti' THEN substr(m.source_hash, 1, 12) ELSE substr(l.content_hash, 1, 12) END AS hash
  FROM labels b LEFT JOIN latest l ON l.source = key LEFT JOIN source_state s ON s.source = key LEFT JOIN manual_state m ON m.source = key LEFT JOIN family_state f ON f.source = key)
"""


def _status(x):
    return M.status_table(_latest(x), x.view("source_state"), x.view("manual_state"), x.view("family_state"))


@query("w2_status_table", views=STATUS_VIEWS, oracle=f"WITH {LATEST}, {TABLE} SELECT * FROM stat")
def _(x):
    return _status(x)


# --- freshness of many instances ---------------------------------------------------------

@view("instance_status")
def _(d):
    """Status rows of monitored instances: one per user and source with the last check in JST, some missing or unreadable."""
    return f"""
SELECT user_id AS instance, CASE event_id % 6 WHEN 0 THEN '財務省' WHEN 1 THEN '経済産業省' WHEN 2 THEN 'OFAC SDN' WHEN 3 THEN 'OFAC Consolidated'
    WHEN 4 THEN '外務省（現行リスト）' ELSE '外務省（報道発表）' END AS source,
  CASE WHEN max(event_id) % 17 = 3 THEN 'エラー' WHEN max(event_id) % 19 = 4 THEN '自動取得不可' ELSE '変更なし' END AS state,
  CASE WHEN max(event_id) % 11 = 1 THEN '' WHEN max(event_id) % 13 = 2 THEN 'soon'
    ELSE '2024-01-31 ' || lpad(CAST(9 + max(event_id) % 13 AS STRING), 2, '0') || ':' || lpad(CAST(max(event_id) % 60 AS STRING), 2, '0') || ':00' END AS last_check
FROM {d.t('events')} WHERE event_id % 97 <> 5 GROUP BY user_id, event_id % 6
"""


FRESH = f"""
aged AS (SELECT *, CASE WHEN last_check LIKE '2024%' THEN epoch(TIMESTAMP '{ASOF}' + INTERVAL 9 HOUR - CAST(last_check AS TIMESTAMP)) / 60 END AS age,
    CASE WHEN source LIKE 'OFAC%' THEN 90 ELSE 420 END AS warn, CASE WHEN source LIKE 'OFAC%' THEN 150 ELSE 600 END AS crit, source LIKE 'OFAC%' OR source = '財務省' AS timed
  FROM (SELECT instance, source, state, CASE WHEN last_check LIKE '2024%' THEN last_check ELSE CASE WHEN last_check = '' THEN '' ELSE 'soon' END END AS last_check FROM instance_status)),
fresh AS (SELECT instance, source, state, last_check,
    CASE WHEN state = 'エラー' THEN 3 WHEN source LIKE '外務省%' THEN 1 WHEN state = '自動取得不可' THEN 1 WHEN last_check = '' THEN 3 WHEN NOT timed THEN 0 WHEN age IS NULL THEN 3
      WHEN age > crit THEN 3 WHEN age > warn THEN 2 ELSE 0 END AS severity,
    CASE WHEN state = 'エラー' THEN '取得エラー' WHEN source LIKE '外務省%' THEN '手動監視' WHEN state = '自動取得不可' THEN '自動取得不可' WHEN last_check = '' THEN '監視未確認'
      WHEN NOT timed THEN '' WHEN age IS NULL THEN '日時解析エラー' WHEN age > warn THEN '監視遅延' ELSE '' END AS anomaly_type,
    age FROM aged)
"""


def _fresh(x):
    return M.freshness(x.view("instance_status"), F.lit(ASOF).cast("timestamp"))


@query("r2_freshness", views="instance_status", oracle=f"""
WITH {FRESH} SELECT instance, source, state, last_check, severity, anomaly_type,
  CASE WHEN anomaly_type = '監視遅延' THEN '最終チェックから約' || CAST(CAST(floor(age) AS BIGINT) AS STRING) || '分' ELSE '' END AS note FROM fresh
""")
def _(x):
    return _fresh(x)


@query("a10_health_rollup", views="instance_status", oracle=f"""
WITH {FRESH}, labels(position, key, label) AS (VALUES {LABELS}),
e AS (SELECT DISTINCT instance, label AS source FROM instance_status, labels),
j AS (SELECT e.instance, e.source, coalesce(severity, CASE WHEN e.source LIKE '外務省%' THEN 1 ELSE 3 END) AS sev FROM e LEFT JOIN fresh f ON f.instance = e.instance AND f.source = e.source)
SELECT instance, CASE WHEN max(sev) = 3 THEN '異常' WHEN max(sev) > 0 THEN '要確認' ELSE '正常' END AS overall, count(*) AS n_sources,
  count(*) FILTER (sev = 0) AS n_normal, count(*) FILTER (sev <> 0) AS n_abnormal FROM j GROUP BY instance
""")
def _(x):
    labels = F.explode(F.array(*[F.lit(v) for v in K.SOURCE_LABELS.values()])).alias("source")
    expected = x.view("instance_status").select("instance").distinct().select("instance", labels)
    return M.health_rollup(_fresh(x), expected, ["instance"])


@view("open_incidents")
def _(d):
    """Incident table: open and closed rows per user, source and type."""
    return f"""
SELECT DISTINCT CAST(user_id AS STRING) || '|' || CASE event_id % 3 WHEN 0 THEN 'OFAC SDN|監視遅延' WHEN 1 THEN '財務省|取得エラー' ELSE '経済産業省|監視未確認' END AS incident_key,
  '2024-01-0' || CAST(1 + user_id % 9 AS STRING) AS opened_at, CASE WHEN user_id % 4 = 1 THEN '2024-01-20' ELSE '' END AS resolved_at, '警告' AS severity FROM {d.t('events')}
"""


@query("r3_incidents", views="instance_status open_incidents", oracle=f"""
WITH {FRESH},
a AS (SELECT CAST(instance AS STRING) || '|' || source || '|' || anomaly_type AS incident_key, max(severity) AS level FROM fresh WHERE anomaly_type <> '' GROUP BY 1),
o AS (SELECT * FROM open_incidents WHERE resolved_at = '')
SELECT coalesce(o.incident_key, a.incident_key) AS incident_key, coalesce(opened_at, '2024-01-31') AS opened_at, CASE WHEN level IS NULL THEN '2024-01-31' ELSE '' END AS resolved_at,
  coalesce(severity, CASE level WHEN 3 THEN '重大' WHEN 2 THEN '警告' ELSE '注意' END) AS severity, CASE WHEN opened_at IS NULL THEN 'opened' WHEN level IS NULL THEN 'resolved' ELSE 'open' END AS change
FROM o FULL JOIN a ON a.incident_key = o.incident_key
UNION ALL SELECT incident_key, opened_at, resolved_at, severity, 'closed' FROM open_incidents WHERE resolved_at <> ''
""")
def _(x):
    active = _fresh(x).filter("anomaly_type <> ''").select(
        F.concat_ws("|", F.col("instance").cast("string"), "source", "anomaly_type").alias("incident_key"), "severity")
    return M.reconcile_incidents(x.view("open_incidents"), active, "2024-01-31")


@query("r1_heartbeat_ingest", views="heartbeats", oracle="SELECT DISTINCT checked_at, source, status, content_hash FROM heartbeats")
def _(x):
    return M.distinct_heartbeats(x.view("heartbeats")).select("checked_at", "source", "status", "content_hash")


@query("s14_heartbeat_sink", views="heartbeats", oracle="""
SELECT checked_at, source, arg_max(status, ord) AS status, arg_max(content_hash, ord) AS content_hash, arg_max(record_count, ord) AS record_count,
  count(*) AS n_entries, substr(checked_at, 1, 7) AS month FROM heartbeats GROUP BY checked_at, source
""")
def _(x):
    return M.heartbeat_rows(x.view("heartbeats"))


@view("snapshots_at")
def _(d):
    """Snapshots to be explained by their upstream checks, one per event."""
    return f"""SELECT event_id AS snapshot_id, CASE event_id % 3 WHEN 0 THEN 'ofac_sdn' WHEN 1 THEN 'mof' ELSE 'nowhere' END AS source, ts AS {d.q('at')} FROM {d.t('events')}"""


@query("j10_upstream_lookup", views="heartbeats snapshots_at", oracle="""
SELECT snapshot_id, s.source, strftime(h.ts, '%Y-%m-%dT%H:%M:%SZ') AS checked_at, coalesce(h.status, 'UNKNOWN') AS status, coalesce(h.content_hash, '') AS content_hash
FROM snapshots_at s ASOF LEFT JOIN (SELECT source, ts, arg_max(status, ord) AS status, arg_max(content_hash, ord) AS content_hash FROM heartbeats GROUP BY ALL) h ON s.source = h.source AND s.at >= h.ts
""")
def _(x):
    return M.attach_upstream(x.view("snapshots_at"), x.view("heartbeats"))


@view("observations")
def _(d):
    """Document observations: the document is the user, failures are error events, hashes and urls change slowly."""
    return f"""
SELECT user_id AS document, ts, event_id AS ord, event_type <> 'error' AS available, 'u' || CAST({d.div('event_id', '700')} AS STRING) AS url,
  'h' || CAST({d.div('event_id', '500')} AS STRING) AS content_hash, CASE WHEN event_type = 'error' THEN 'r' || CAST(event_id % 2 AS STRING) ELSE '' END AS reason, user_id % 2 = 0 AS baseline FROM {d.t('events')}
"""


@query("d8_observation_events", views="observations", oracle="""
WITH l AS (SELECT *, lag((available, url, content_hash, reason)) OVER w AS p, lag(available) OVER w AS pa, lag(url) OVER w AS pu, lag(content_hash) OVER w AS ph, lag(reason) OVER w AS pr
  FROM observations WINDOW w AS (PARTITION BY document ORDER BY ts, ord)),
k AS (SELECT *, CASE WHEN NOT available THEN CASE WHEN pa IS NULL OR pa OR pr <> reason THEN 'UNAVAILABLE' END
  WHEN pa IS NULL THEN CASE WHEN baseline THEN 'BASELINED' ELSE 'DETECTED' END WHEN NOT pa THEN 'REAPPEARED' WHEN ph <> content_hash THEN 'CONTENT_CHANGED'
  WHEN pu <> url THEN 'LINK_CHANGED_SAME_CONTENT' END AS event_type FROM l)
SELECT document, ord, url, content_hash, reason, event_type FROM k WHERE event_type IS NOT NULL
""")
def _(x):
    return M.observation_events(x.view("observations")).select("document", "ord", "url", "content_hash", "reason", "event_type")


STATES = ["CHECKED_NO_CHANGE", "DETECTED", "MANUAL_FETCH_REQUIRED", "FILE_RECEIVED", "VALIDATED", "DIFFED", "REVIEW_REQUIRED", "APPROVED", "APPLIED", "BLOCKED", "REJECTED"]


@view("lifecycle_log")
def _(d):
    """Lifecycle log per user: mostly the regular order, with jumps and an unknown state."""
    cases = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STATES))
    return f"""SELECT user_id AS detection_id, ts, event_id AS ord, CASE ({d.div('event_id', '150')} + CASE WHEN event_id % 10 = 3 THEN 5 ELSE 0 END) % 12 {cases} ELSE 'LOST' END AS state FROM {d.t('events')}"""


# Written out, so that the oracle does not follow the engine's own table.
TRANSITIONS = """
    ('', 'CHECKED_NO_CHANGE'), ('', 'DETECTED'), ('CHECKED_NO_CHANGE', 'CHECKED_NO_CHANGE'), ('CHECKED_NO_CHANGE', 'DETECTED'),
    ('DETECTED', 'MANUAL_FETCH_REQUIRED'), ('MANUAL_FETCH_REQUIRED', 'FILE_RECEIVED'), ('MANUAL_FETCH_REQUIRED', 'BLOCKED'),
    ('FILE_RECEIVED', 'VALIDATED'), ('FILE_RECEIVED', 'BLOCKED'), ('VALIDATED', 'DIFFED'), ('VALIDATED', 'BLOCKED'), ('DIFFED', 'REVIEW_REQUIRED'),
    ('DIFFED', 'BLOCKED'), ('REVIEW_REQUIRED', 'APPROVED'), ('REVIEW_REQUIRED', 'REJECTED'), ('REVIEW_REQUIRED', 'BLOCKED'), ('APPROVED', 'APPLIED'),
    ('APPROVED', 'APPLIED_WITH_HOLDS'), ('APPROVED', 'BLOCKED'), ('REJECTED', 'CHECKED_NO_CHANGE'), ('REJECTED', 'DETECTED'),
    ('APPLIED', 'CHECKED_NO_CHANGE'), ('APPLIED', 'DETECTED'), ('APPLIED_WITH_HOLDS', 'CHECKED_NO_CHANGE'), ('APPLIED_WITH_HOLDS', 'DETECTED'),
    ('BLOCKED', 'FILE_RECEIVED'), ('BLOCKED', 'REJECTED')
"""


@query("r4_lifecycle_audit", views="lifecycle_log", oracle=f"""
WITH t(a, b) AS (VALUES {TRANSITIONS}), l AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY detection_id ORDER BY ts, ord), '') AS previous FROM lifecycle_log)
SELECT detection_id, ord, previous, state, CASE WHEN state = 'LOST' THEN 'UNKNOWN_STATE' WHEN previous IN ('REJECTED', 'APPLIED', 'APPLIED_WITH_HOLDS') THEN 'AFTER_TERMINAL' ELSE 'FORBIDDEN_TRANSITION' END AS violation
FROM l WHERE (previous, state) NOT IN (SELECT (a, b) FROM t)
""")
def _(x):
    return M.lifecycle_violations(x.view("lifecycle_log"))


@view("sla_log")
def _(d):
    """SLA event log per order: detection, then by key a diff, breach and recovery at various distances."""
    t = "o_orderdate"
    k = "o_orderkey"
    return f"""
SELECT {k} AS detection_id, {t} AS ts, 0 AS ord, CASE WHEN {k} % 23 = 1 THEN 'CHECKED_NO_CHANGE' ELSE 'DETECTED' END AS state FROM {d.t('orders')}
UNION ALL SELECT {k}, {t} + INTERVAL '10' MINUTE, 1, 'VALIDATED' FROM {d.t('orders')} WHERE {k} % 3 <> 0
UNION ALL SELECT {k}, {t} + CASE WHEN {k} % 5 = 0 THEN INTERVAL '30' MINUTE ELSE INTERVAL '90' MINUTE END, 2, 'DIFFED' FROM {d.t('orders')} WHERE {k} % 2 = 0
UNION ALL SELECT {k}, {t} + CASE WHEN {k} % 7 = 0 THEN INTERVAL '50' MINUTE ELSE INTERVAL '61' MINUTE END, 3, 'SLA_BREACHED' FROM {d.t('orders')} WHERE {k} % 4 < 2
UNION ALL SELECT {k}, {t} + CASE WHEN {k} % 11 = 0 THEN INTERVAL '80' MINUTE ELSE INTERVAL '95' MINUTE END, 4, 'SLA_RECOVERED' FROM {d.t('orders')} WHERE {k} % 8 = 0
UNION ALL SELECT {k}, {t} + INTERVAL '100' MINUTE, 5, CASE {k} % 3 WHEN 0 THEN 'BLOCKED' WHEN 1 THEN 'APPLIED' ELSE 'APPROVED' END FROM {d.t('orders')} WHERE {k} % 13 < 4
"""


@query("r5_sla_condition", views="sla_log", oracle="""
WITH s AS (SELECT detection_id, arg_max(state, (ts, ord)) FILTER (state NOT LIKE 'SLA%') AS life, min(ts) FILTER (state = 'DETECTED') AS hit, min(ts) FILTER (state = 'DIFFED') AS diff,
    min(ts) FILTER (state = 'SLA_BREACHED') AS br, min(ts) FILTER (state = 'SLA_RECOVERED') AS bk FROM sla_log GROUP BY 1),
d AS (SELECT *, hit + INTERVAL 60 MINUTE AS due, TIMESTAMP '1998-06-01 00:30:00' AS now, life IN ('CHECKED_NO_CHANGE', 'REJECTED', 'APPLIED', 'APPLIED_WITH_HOLDS') AS closed,
    life IN ('DETECTED', 'MANUAL_FETCH_REQUIRED', 'FILE_RECEIVED', 'VALIDATED') AS op, life IN ('DIFFED', 'REVIEW_REQUIRED', 'APPROVED') AS df FROM s),
e AS (SELECT *, closed AND hit IS NULL AND diff IS NULL AND br IS NULL AND bk IS NULL AS quiet,
    CASE WHEN life = 'BLOCKED' OR (closed AND hit IS NULL AND diff IS NULL AND br IS NULL AND bk IS NULL) THEN NULL
      WHEN df AND diff IS NULL THEN 'DIFF_TIME_MISSING' WHEN hit IS NULL THEN 'DETECTION_TIME_MISSING' WHEN op AND diff IS NOT NULL THEN 'DIFF_IN_OPEN_STATE' WHEN diff < hit THEN 'DIFF_BEFORE_DETECTION'
      WHEN br < due THEN 'BREACH_BEFORE_DUE' WHEN br IS NOT NULL AND diff < due THEN 'BREACH_THOUGH_IN_TIME' WHEN br > diff THEN 'BREACH_AFTER_DIFF'
      WHEN bk IS NOT NULL AND (br IS NULL OR diff IS NULL) THEN 'RECOVERY_WITHOUT_BREACH' WHEN bk < br OR bk < diff THEN 'RECOVERY_TOO_EARLY' WHEN diff > now OR br > now OR bk > now THEN 'TIME_IN_FUTURE' END AS error FROM d)
SELECT detection_id, life AS lifecycle_state, coalesce(error, '') AS error, CASE WHEN error IS NOT NULL THEN '' WHEN life = 'BLOCKED' THEN 'blocked' WHEN quiet THEN 'healthy'
  WHEN diff IS NOT NULL THEN CASE WHEN bk IS NOT NULL THEN 'healthy' WHEN br IS NOT NULL OR diff >= due THEN 'recovered' ELSE 'healthy' END
  WHEN closed THEN 'healthy' WHEN br IS NOT NULL THEN 'breached' WHEN now < due THEN 'pending' ELSE 'breached' END AS condition FROM e
""")
def _(x):
    states = M.sla_states(x.view("sla_log"))
    done = M.evaluate_sla(states, F.lit("1998-06-01 00:30:00").cast("timestamp_ntz"))
    return done.select("detection_id", "lifecycle_state", F.coalesce("error", F.lit("")).alias("error"), F.coalesce("condition", F.lit("")).alias("condition"))
