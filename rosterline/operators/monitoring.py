"""Monitoring: heartbeats, status table, freshness, incidents, document observations, lifecycle and SLA."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.digests import short_hash
from .sequences import look_back

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
HTTP_SHAPE = r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun), \d{2} (Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) \d{4} \d{2}:\d{2}:\d{2} GMT$"
JST_FORMAT = "yyyy-MM-dd HH:mm:ss"
MANUAL_STATUS = {
    "manual_ok": ["CHECKED_NO_CHANGE", "APPLIED", "APPLIED_WITH_HOLDS"],
    "manual_review": ["DIFFED", "REVIEW_REQUIRED"],
    "manual_approved": ["APPROVED"],
    "manual_blocked": ["BLOCKED"],
    "manual_rejected": ["REJECTED"],
}
FAMILY_LABELS = {
    "unchanged": "変更なし", "document_updated": "資料更新・要レビュー", "checking": "確認中",
    "COVERAGE_GAP": "未確認期間あり", "schema_changed": "構造異常", "error": "エラー",
    "manual_required": "自動取得不可・手動確認待ち", "manual_pending": "手動取得待ち",
    "manual_review": "資料更新・要レビュー（手動取得）", "manual_checked": "手動確認済み", "manual_error": "手動取込エラー",
}
ERROR_LABELS = ["エラー", "構造異常", "未確認期間あり", "手動取込エラー"]
# source prefix or name -> (warn, critical) minutes
AGE_LIMITS = {"OFAC": (90, 150), "財務省": (420, 600)}


def _lookup(c: Column, table: dict[str, str], default: Column) -> Column:
    expr = None
    for key, value in table.items():
        expr = F.when(c == key, value) if expr is None else expr.when(c == key, value)
    return expr.otherwise(default)


def _utc(iso: Column) -> Column:
    return F.try_to_timestamp(F.when(iso.rlike(ISO_SHAPE), F.regexp_replace(iso, "[TZ]", " ")), F.lit("yyyy-MM-dd HH:mm:ss "))


def jst_text(c: Column, http_dates: bool = False) -> Column:
    """UTC ISO (or HTTP date) text as JST display text; text that is neither stays as it is."""
    parsed = _utc(c)
    if http_dates:
        http = F.try_to_timestamp(F.when(c.rlike(HTTP_SHAPE), F.substring(c, 6, 20)), F.lit("dd MMM yyyy HH:mm:ss"))
        parsed = F.coalesce(parsed, http)
    shown = F.date_format(F.from_utc_timestamp(parsed, "Asia/Tokyo"), JST_FORMAT)
    return F.coalesce(shown, c, F.lit(""))


def latest_heartbeats(history: DataFrame, current: DataFrame) -> DataFrame:
    """Latest heartbeat of each managed source; at equal time the current run wins.  A map-side maximum, no window."""
    cols = ["source", "checked_at", "status", "content_hash", "source_updated", "record_count", "ord"]
    rows = history.select(*cols, F.lit(0).alias("is_current")).unionByName(current.select(*cols, F.lit(1).alias("is_current")))
    place = F.struct("checked_at", "is_current", F.when(F.col("is_current") == 1, F.col("ord")).otherwise(-F.col("ord")))
    kept = [c for c in cols if c not in ("source", "ord")]
    rows = rows.filter(F.col("source").isin(list(K.SOURCE_LABELS)))
    return rows.groupBy("source").agg(F.max_by(F.struct(*kept), place).alias("r")).select("source", *[F.col(f"r.{c}").alias(c) for c in kept])


def manual_status(lifecycle: Column, breached_at: Column) -> Column:
    breached = F.coalesce(breached_at, F.lit("")) != ""
    expr = F.when(lifecycle.isin(K.OPEN_STATES), F.when(breached, "manual_critical").otherwise("manual_pending"))
    for status, states in MANUAL_STATUS.items():
        expr = expr.when(lifecycle.isin(states), status)
    return expr.otherwise("")


def status_table(latest: DataFrame, state: DataFrame, manual: DataFrame, families: DataFrame) -> DataFrame:
    """Status row per managed source in fixed order, with the fall-back chains of time, count and hash.

    ``state``: source, source_updated, asof, record_count, sha256.  ``manual``: source, lifecycle_state,
    sla_breached_at, last_check_at, effective_date, record_count, source_hash.  ``families``: source, status, checked_at, changed_at, sha256.
    """
    labels = latest.sparkSession.createDataFrame(
        [(i, k, v) for i, (k, v) in enumerate(K.SOURCE_LABELS.items())], "position int, source string, label string")
    text = lambda c: F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col(c).cast("string"))
    l = latest.select("source", *[text(c).alias(f"l_{c}") for c in latest.columns if c != "source"])
    s = state.select("source", *[text(c).alias(f"s_{c}") for c in state.columns if c != "source"])
    m = manual.select("source", *[text(c).alias(f"m_{c}") for c in manual.columns if c != "source"])
    f = families.select("source", *[text(c).alias(f"f_{c}") for c in families.columns if c != "source"])
    j = labels
    for side in (l, s, m, f):  # at most one row per managed source on every side
        j = j.join(side, "source", "left")
    family, by_hand = F.startswith(F.col("source"), F.lit("mofa_")), F.col("m_lifecycle_state").isNotNull()
    raw = F.when(by_hand, manual_status(F.col("m_lifecycle_state"), F.col("m_sla_breached_at"))).otherwise(F.coalesce("l_status", F.lit("")))
    shown = F.when(raw == "", K.UNCHECKED).otherwise(_lookup(raw, K.STATUS_LABELS, raw))
    updated = F.coalesce(F.when(by_hand, F.col("m_effective_date")), "l_source_updated", "s_source_updated", "s_asof", F.lit(""))
    count = F.coalesce(F.when(by_hand, F.col("m_record_count")), F.when(~by_hand, F.col("l_record_count")), "s_record_count", F.lit(""))
    digest = F.coalesce(F.when(by_hand, F.col("m_source_hash")), F.when(~by_hand, F.col("l_content_hash")), "s_sha256", F.lit(""))
    return j.select(
        "position", F.col("label").alias("source"),
        F.when(family, _lookup(F.coalesce("f_status", F.lit("")), FAMILY_LABELS, F.lit("自動取得不可・手動確認待ち"))).otherwise(shown).alias("state"),
        F.when(family, jst_text(F.col("f_checked_at"))).when(by_hand, jst_text(F.coalesce("m_last_check_at", F.lit("")))).otherwise(jst_text(F.coalesce("l_checked_at", F.lit("")))).alias("last_check"),
        F.when(family, jst_text(F.col("f_changed_at"))).otherwise(jst_text(updated, http_dates=True)).alias("source_updated"),
        F.when(family, "").otherwise(count).alias("record_count"),
        F.when(family, short_hash(F.coalesce("f_sha256", F.lit("")))).otherwise(short_hash(digest)).alias("hash"))


def freshness(status: DataFrame, asof: Column) -> DataFrame:
    """Severity of every status row (source, state, last_check in JST) at ``asof`` (UTC timestamp); limits are strict."""
    checked = F.from_utc_timestamp(asof, "Asia/Tokyo")
    then = F.try_to_timestamp("last_check", F.lit(JST_FORMAT))
    age = (F.unix_micros(checked) - F.unix_micros(then)) / F.lit(60_000_000)
    source, state, last = F.col("source"), F.col("state"), F.coalesce("last_check", F.lit(""))
    ofac, mof = F.startswith(source, F.lit("OFAC")), source == "財務省"
    warn = F.when(ofac, AGE_LIMITS["OFAC"][0]).otherwise(AGE_LIMITS["財務省"][0])
    critical = F.when(ofac, AGE_LIMITS["OFAC"][1]).otherwise(AGE_LIMITS["財務省"][1])
    df = status.withColumns({"__age": age, "__warn": warn, "__critical": critical})
    timed = ofac | mof
    severity = (
        F.when(state.isin(ERROR_LABELS), 3).when(F.startswith(source, F.lit("外務省")), 1).when(state == "自動取得不可", 1)
        .when(last == "", 3).when(~timed, 0).when(F.col("__age").isNull(), 3)
        .when(F.col("__age") > F.col("__critical"), 3).when(F.col("__age") > F.col("__warn"), 2).otherwise(0))
    anomaly = (
        F.when(state.isin(ERROR_LABELS), "取得エラー").when(F.startswith(source, F.lit("外務省")), "手動監視")
        .when(state == "自動取得不可", "自動取得不可").when(last == "", "監視未確認").when(~timed, "")
        .when(F.col("__age").isNull(), "日時解析エラー").when(F.col("__age") > F.col("__warn"), "監視遅延").otherwise(""))
    note = F.when(anomaly == "監視遅延", F.concat(F.lit("最終チェックから約"), F.floor("__age").cast("string"), F.lit("分"))).otherwise("")
    return df.withColumns({"severity": severity, "anomaly_type": anomaly, "note": note}).drop("__age", "__warn", "__critical")


def health_rollup(fresh: DataFrame, expected: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Overall state over a fixed source list; a source without a status row counts as never checked (severity 3)."""
    keys = keys or []
    j = expected.join(fresh.select(*keys, "source", "severity"), [*keys, "source"], "left")
    severity = F.coalesce("severity", F.when(F.startswith("source", F.lit("外務省")), 1).otherwise(3))
    agg = j.groupBy(*keys).agg(
        F.max(severity).alias("worst"), F.count(F.lit(1)).alias("n_sources"), F.count_if(severity == 0).alias("n_normal"))
    overall = F.when(F.col("worst") == 3, "異常").when(F.col("worst") > 0, "要確認").otherwise("正常")
    return agg.select(*keys, overall.alias("overall"), "n_sources", "n_normal", (F.col("n_sources") - F.col("n_normal")).alias("n_abnormal"))


def reconcile_incidents(incidents: DataFrame, active: DataFrame, now: str) -> DataFrame:
    """Incident table after one check: open rows no longer active are resolved, new anomalies open one row each.

    ``incidents``: incident_key, opened_at, resolved_at, severity.  ``active``: incident_key, severity (0-3).
    """
    is_open = F.coalesce("resolved_at", F.lit("")) == ""
    label = F.when(F.col("level") == 3, "重大").when(F.col("level") == 2, "警告").otherwise("注意")
    a = active.groupBy("incident_key").agg(F.max("severity").alias("level"))
    opened = incidents.filter(is_open).join(a, "incident_key", "full_outer")
    new = F.col("opened_at").isNull()
    rows = opened.select(
        "incident_key", F.coalesce("opened_at", F.lit(now)).alias("opened_at"),
        F.when(F.col("level").isNull(), now).otherwise("").alias("resolved_at"),
        F.when(new, label).otherwise(F.col("severity")).alias("severity"),
        F.when(new, "opened").when(F.col("level").isNull(), "resolved").otherwise("open").alias("change"))
    return rows.unionByName(incidents.filter(~is_open).select("incident_key", "opened_at", "resolved_at", "severity", F.lit("closed").alias("change")))


def distinct_heartbeats(rows: DataFrame) -> DataFrame:
    """Heartbeats once per (checked_at, source, status, content_hash); the batch twin of the stream ingest."""
    return rows.dropDuplicates(["checked_at", "source", "status", "content_hash"])


def heartbeat_rows(entries: DataFrame) -> DataFrame:
    """Heartbeat sink rows: one per (run, source), the last entry of the run, with the month partition."""
    cols = ["status", "content_hash", "record_count"]
    rows = entries.groupBy("checked_at", "source").agg(
        F.max_by(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in cols]), "ord").alias("r"), F.count(F.lit(1)).alias("n_entries"))
    return rows.select("checked_at", "source", *[F.col(f"r.{c}").alias(c) for c in cols], "n_entries", F.left("checked_at", F.lit(7)).alias("month"))


def append_heartbeats(entries: DataFrame, path: str) -> None:
    heartbeat_rows(entries).drop("n_entries").write.mode("append").partitionBy("month").parquet(path)


def attach_upstream(snapshots: DataFrame, heartbeats: DataFrame) -> DataFrame:
    """As-of join: the last heartbeat of the source at or before each snapshot (snapshot_id, source, at).

    Both tables go through one bucketed look-back by hour, by second in hours that are too full, so a source with most of the rows is spread.
    """
    seen = F.struct(F.col("ts").alias("checked_at"), "status", "content_hash")
    beats = heartbeats.select("source", "ts", F.lit(0).alias("kind"), "ord", F.lit(None).cast("bigint").alias("snapshot_id"), seen.alias("beat"))
    shots = snapshots.select("source", F.col("at").alias("ts"), F.lit(1).alias("kind"), F.col("snapshot_id").alias("ord"), "snapshot_id",
                             F.lit(None).cast(beats.schema["beat"].dataType).alias("beat"))
    rows = look_back(beats.unionByName(shots), ["source"], F.date_trunc("hour", "ts"), ["ts", "kind", "ord"], F.col("beat"), "upstream", inclusive=True,
                     finer=F.date_trunc("second", "ts"))
    return rows.filter("kind = 1").select("snapshot_id", "source", F.date_format("upstream.checked_at", ISO).alias("checked_at"),
                                          F.coalesce("upstream.status", F.lit("UNKNOWN")).alias("status"), F.coalesce("upstream.content_hash", F.lit("")).alias("content_hash"))


def observation_events(observations: DataFrame) -> DataFrame:
    """Event kind of every document observation against the previous one; a repeated identical failure is silent.

    ``observations``: document, ts, ord, available, url, content_hash, reason, baseline.
    """
    now = F.struct("available", "url", "content_hash", "reason")
    rows = look_back(observations, ["document"], F.date_trunc("day", "ts"), ["ts", "ord"], now, "prev", inclusive=False, finer=F.date_trunc("second", "ts"))
    first, ok = F.col("prev").isNull(), F.col("available")
    kind = (
        F.when(~ok, F.when(first | F.col("prev.available") | (F.col("prev.reason") != F.col("reason")), "UNAVAILABLE"))
        .when(first, F.when(F.col("baseline"), "BASELINED").otherwise("DETECTED"))
        .when(~F.col("prev.available"), "REAPPEARED")
        .when(F.col("prev.content_hash") != F.col("content_hash"), "CONTENT_CHANGED")
        .when(F.col("prev.url") != F.col("url"), "LINK_CHANGED_SAME_CONTENT"))
    return rows.withColumn("event_type", kind).filter("event_type IS NOT NULL").drop("prev")


def lifecycle_violations(events: DataFrame) -> DataFrame:
    """Log rows whose state may not follow the previous state of the detection (detection_id, ts, ord, state)."""
    rows = look_back(events, ["detection_id"], F.date_trunc("day", "ts"), ["ts", "ord"], F.col("state"), "previous", inclusive=False, finer=F.date_trunc("second", "ts"))
    previous = F.coalesce("previous", F.lit(""))
    allowed = F.lit(False)
    for state, following in K.TRANSITIONS.items():
        allowed = allowed | ((previous == state) & F.col("state").isin(following))
    known = F.col("state").isin(list(K.TRANSITIONS))
    violation = F.when(~known, "UNKNOWN_STATE").when(~allowed & previous.isin(K.TERMINAL_STATES), "AFTER_TERMINAL").when(~allowed, "FORBIDDEN_TRANSITION")
    return rows.select("detection_id", "ord", previous.alias("previous"), "state", violation.alias("violation")).filter("violation IS NOT NULL")


def sla_states(log: DataFrame) -> DataFrame:
    """One row per detection from its event log: first time of each milestone and the latest state."""
    first = lambda *states: F.min(F.when(F.col("state").isin(*states), F.col("ts")))
    marks = ["SLA_BREACHED", "SLA_RECOVERED"]
    return log.groupBy("detection_id").agg(
        F.max_by("state", F.when(~F.col("state").isin(marks), F.struct("ts", "ord"))).alias("lifecycle_state"),
        first("DETECTED").alias("detected_at"), (first("DETECTED") + F.expr("INTERVAL 60 MINUTES")).alias("sla_due_at"),
        first("DIFFED").alias("diffed_at"), first("SLA_BREACHED").alias("sla_breached_at"), first("SLA_RECOVERED").alias("sla_recovered_at"))


def evaluate_sla(states: DataFrame, now: Column) -> DataFrame:
    """SLA condition, or the first broken rule as ``error``, of every detection at ``now``."""
    life, hit, due = F.col("lifecycle_state"), F.col("detected_at"), F.col("sla_due_at")
    diff, breach, back = F.col("diffed_at"), F.col("sla_breached_at"), F.col("sla_recovered_at")
    history = hit.isNotNull() | due.isNotNull() | diff.isNotNull() | breach.isNotNull() | back.isNotNull()
    closed, diffed, open_ = life.isin(K.CLOSED_STATES), life.isin(K.DIFFED_STATES), life.isin(K.OPEN_STATES)
    quiet = closed & ~history
    error = (
        F.when(life.isNull() | ~life.isin(list(K.TRANSITIONS)) | (life == ""), "UNKNOWN_STATE").when((life == "BLOCKED") | quiet, None)
        .when(diffed & diff.isNull(), "DIFF_TIME_MISSING").when(hit.isNull(), "DETECTION_TIME_MISSING").when(due.isNull(), "DUE_TIME_MISSING")
        .when(due != hit + F.expr("INTERVAL 60 MINUTES"), "DUE_NOT_60_MINUTES").when(open_ & diff.isNotNull(), "DIFF_IN_OPEN_STATE")
        .when(diff < hit, "DIFF_BEFORE_DETECTION").when(breach < due, "BREACH_BEFORE_DUE")
        .when(breach.isNotNull() & (diff < due), "BREACH_THOUGH_IN_TIME").when(breach > diff, "BREACH_AFTER_DIFF")
        .when(back.isNotNull() & (breach.isNull() | diff.isNull()), "RECOVERY_WITHOUT_BREACH").when((back < breach) | (back < diff), "RECOVERY_TOO_EARLY")
        .when((diff > now) | (breach > now) | (back > now), "TIME_IN_FUTURE"))
    condition = (
        F.when(life == "BLOCKED", "blocked").when(quiet, "healthy")
        .when(diff.isNotNull(), F.when(back.isNotNull(), "healthy").when(breach.isNotNull() | (diff >= due), "recovered").otherwise("healthy"))
        .when(closed, "healthy").when(breach.isNotNull(), "breached").when(now < due, "pending").otherwise("breached"))
    df = states.withColumn("error", error)
    return df.withColumn("condition", F.when(F.col("error").isNull(), condition))
