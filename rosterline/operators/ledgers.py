"""Review ledgers: removal queue, approvals, case mirrors, evidence and document completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import names as N
from ..functions.digests import set_digest
from ..functions.rows import explode_once
from .sequences import numbered

PARTY = ["list", "party_id"]
HEX64 = "^[0-9a-f]{64}$"
# The official publisher.
OFFICIAL_DOMAINS = ["treasury.gov"]
OFFICIAL_HOSTS = ["sanctionslistservice.ofac.treas.gov"]
QUEUE_COLUMNS = ["event_id", "list", "snapshot_sha256", "party_id", "party_name", "status",
                 "detected_at_ms", "last_seen_at_ms", "resolved_at_ms", "resolution"]


def event_digest(list_name: Column, snapshot: Column, members: Column) -> Column:
    """Event id: SHA-256 of list, snapshot and the order-independent digest of the exact party set."""
    return F.sha2(F.concat_ws("|", list_name, snapshot, members), 256)


def reconcile_queue(queue: DataFrame, removed: DataFrame, current: DataFrame, snapshots: DataFrame,
                    names: DataFrame, ts: int) -> DataFrame:
    """Removal queue after one complete snapshot.

    One reappeared party cancels its whole open event; its absent siblings are queued again together with
    newly absent parties, one new event per list.  Sets are joined or digested, never gathered.
    """
    stamp = F.lit(ts).cast("bigint")
    now = current.select(*PARTY, F.lit(True).alias("here")).distinct()
    q = queue.join(now, PARTY, "left")
    pending = F.col("status") == K.PENDING
    back = q.filter(pending & F.col("here")).select("event_id", F.lit(True).alias("back")).distinct()
    q = q.join(back, "event_id", "left").join(
        snapshots.select("list", F.col("snapshot_sha256").alias("fresh_sha")), "list", "left")
    cancelled = pending & F.coalesce("back", F.lit(False))
    touched = pending & ~cancelled & F.col("fresh_sha").isNotNull()
    q = q.withColumns({
        "requeue": cancelled & F.col("here").isNull(),
        "new_status": F.when(cancelled, K.CANCELLED).otherwise(F.col("status")),
        "new_seen": F.when(touched, stamp).otherwise(F.col("last_seen_at_ms")),
        "new_resolved": F.when(cancelled, stamp).otherwise(F.col("resolved_at_ms")),
        "new_resolution": F.when(cancelled, "REAPPEARED").otherwise(F.col("resolution")),
    })
    kept = q.select("event_id", "list", "snapshot_sha256", "party_id", "party_name", F.col("new_status").alias("status"), "detected_at_ms",
                    F.col("new_seen").alias("last_seen_at_ms"), F.col("new_resolved").alias("resolved_at_ms"), F.col("new_resolution").alias("resolution"))
    still_open = q.filter(F.col("new_status") == K.PENDING).select(*PARTY)
    wanted = removed.select(*PARTY).unionByName(q.filter("requeue").select(*PARTY)).distinct().join(still_open, PARTY, "left_anti")
    events = wanted.groupBy("list").agg(set_digest(F.col("party_id")).alias("members")).join(
        snapshots.select("list", "snapshot_sha256"), "list").select(
        "list", "snapshot_sha256", event_digest(F.col("list"), F.col("snapshot_sha256"), F.col("members")).alias("event_id"))
    fresh = wanted.join(events, "list").join(names.select(*PARTY, "party_name"), PARTY, "left").select(
        "event_id", "list", "snapshot_sha256", "party_id", "party_name", F.lit(K.PENDING).alias("status"),
        stamp.alias("detected_at_ms"), stamp.alias("last_seen_at_ms"), F.lit(None).cast("bigint").alias("resolved_at_ms"), F.lit("").alias("resolution"))
    return kept.unionByName(fresh)


def pending_groups(queue: DataFrame) -> DataFrame:
    """Open events with the number of their parties; the parties themselves stay queue rows."""
    return queue.filter(F.col("status") == K.PENDING).groupBy("event_id", "list", "snapshot_sha256").agg(
        F.countDistinct("party_id").alias("n_parties"))


def mark_applied(queue: DataFrame, requests: DataFrame, ts: int) -> DataFrame:
    """Apply approved parties.  A request must name pending rows and cover its event completely.

    ``violation`` is NOT_PENDING for a request without a pending row and PARTIAL_EVENT for the rows of an
    event that would be applied in part; such rows keep their state.
    """
    key = ["list", "snapshot_sha256", "party_id"]
    asked = requests.select(*key, F.lit(True).alias("asked")).distinct()
    pending = queue.filter(F.col("status") == K.PENDING).join(asked, key, "full_outer")
    known = F.col("event_id").isNotNull()
    counts = pending.filter(known).groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(F.coalesce("asked", F.lit(False))).alias("n_asked"))
    j = pending.join(counts, "event_id", "left")
    partial = (F.col("n_asked") > 0) & (F.col("n_asked") < F.col("n_all"))
    violation = F.when(~known, "NOT_PENDING").when(partial, "PARTIAL_EVENT")
    applied = known & (F.col("n_asked") == F.col("n_all"))
    return j.select(
        *key, F.coalesce("event_id", F.lit("")).alias("event_id"),
        F.when(applied, K.APPLIED).when(known, F.col("status")).otherwise("").alias("status"),
        F.when(applied, F.lit(ts).cast("bigint")).alias("resolved_at_ms"), F.when(applied, "HUMAN_APPROVED").otherwise("").alias("resolution"),
        violation.alias("violation"))


def authorise(approvals: DataFrame, detected: DataFrame, history: DataFrame) -> DataFrame:
    """Approval state per (list, snapshot): PENDING without approvals, AUTHORIZED on exact set and known names, else MISMATCH."""
    key = ["list", "snapshot_sha256"]
    known = history.select(*PARTY, N.canonical_display_name(F.col("name")).alias("party_name"), F.lit(True).alias("known")).distinct()
    a = approvals.withColumn("party_name", N.canonical_display_name(F.col("party_name"))).join(known, [*PARTY, "party_name"], "left")
    a = a.groupBy(*key, "party_id").agg(F.bool_and(F.coalesce("known", F.lit(False))).alias("name_known"))
    d = detected.select(*key, "party_id", F.lit(True).alias("detected")).distinct()
    j = d.join(a, [*key, "party_id"], "full_outer")
    wanted, given = F.col("detected").isNotNull(), F.col("name_known").isNotNull()
    sets = j.groupBy(*key).agg(
        F.count_if(wanted).alias("n_detected"), F.count_if(given).alias("n_approved"), F.count_if(wanted & ~given).alias("n_missing"),
        F.count_if(given & ~wanted).alias("n_extra"), F.count_if(given & ~F.col("name_known")).alias("n_unknown_names"))
    state = (
        F.when(F.col("n_approved") == 0, "PENDING")
        .when((F.col("n_missing") > 0) | (F.col("n_extra") > 0), "SET_MISMATCH")
        .when(F.col("n_unknown_names") > 0, "NAME_MISMATCH").otherwise("AUTHORIZED"))
    return sets.filter("n_detected > 0").withColumn("state", state)


# --- gates -------------------------------------------------------------------------------

def url_policy(df: DataFrame, url: str, domains: list[str] = OFFICIAL_DOMAINS, hosts: list[str] = OFFICIAL_HOSTS) -> DataFrame:
    """Adds ``official``: https and a host equal to, or below, an allowed domain; look-alikes fail."""
    host = F.lower(F.coalesce(F.try_parse_url(F.col(url), F.lit("HOST")), F.lit("")))
    below = F.lit(False)
    for d in domains:
        below = below | (host == d) | F.endswith(host, F.lit("." + d))
    scheme = F.coalesce(F.try_parse_url(F.col(url), F.lit("PROTOCOL")), F.lit(""))
    return df.withColumn("official", (scheme == "https") & (below | host.isin(hosts)))


def approval_violations(approvals: DataFrame, domains: list[str] = OFFICIAL_DOMAINS, hosts: list[str] = OFFICIAL_HOSTS) -> DataFrame:
    """One row per broken rule of an approval ledger (list, snapshot_sha256, party_id, party_name, decision, approved_by, approved_at, official_url)."""
    required = ["list", "party_id", "party_name", "approved_by", "approved_at", "official_url"]
    df = url_policy(approvals, "official_url", domains, hosts)
    key = ["list", "snapshot_sha256", "party_id"]
    repeats = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_same"))
    df = df.join(repeats, key)
    stamp = F.col("approved_at")
    shape = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?$"
    readable = stamp.rlike(shape) & F.try_to_timestamp(F.regexp_replace(F.left(stamp, F.lit(16)), " ", "T"), F.lit("yyyy-MM-dd'T'HH:mm")).isNotNull()
    missing = [c for c in required]
    rules = [F.when(F.coalesce(N.strip(F.col(c)), F.lit("")) == "", F.lit(f"MISSING:{c}")) for c in missing] + [
        F.when(~F.coalesce("snapshot_sha256", F.lit("")).rlike(HEX64), "BAD_HASH"),
        F.when(F.coalesce("decision", F.lit("")) != "APPROVED", "BAD_DECISION"),
        F.when(stamp != "", F.when(~readable, "BAD_TIMESTAMP").when(~stamp.rlike(r"(Z|[+-]\d{2}:\d{2})$"), "NO_TIMEZONE")),
        F.when((F.col("official_url") != "") & ~F.col("official"), "UNOFFICIAL_URL"),
        F.when(F.col("n_same") > 1, "DUPLICATE"),
    ]
    return explode_once(df, key, F.array_compact(F.array(*rules)), "violation")


def queue_violations(queue: DataFrame) -> DataFrame:
    """Consistency of the removal queue: (event_id, violation) rows; all checks are counting aggregates."""
    pairs = queue.groupBy("event_id", "party_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "event_id", F.lit("DUPLICATE_ROW").alias("violation")).distinct()
    opened = queue.filter(F.col("status") == K.PENDING)
    twice = opened.groupBy(*PARTY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    doubled = opened.join(twice, PARTY, "left_semi").select("event_id", F.lit("PARTY_OPEN_TWICE").alias("violation")).distinct()
    members = queue.groupBy("event_id", "party_id").agg(
        F.min("list").alias("list"), F.max("list").alias("list_hi"), F.min("snapshot_sha256").alias("sha"), F.max("snapshot_sha256").alias("sha_hi"),
        F.min("detected_at_ms").alias("at"), F.max("detected_at_ms").alias("at_hi"),
        F.min("status").alias("st"), F.max("status").alias("st_hi"), F.min("resolution").alias("re"), F.max("resolution").alias("re_hi"))
    events = members.groupBy("event_id").agg(
        F.min("list").alias("list"), F.max("list_hi").alias("list_hi"), F.min("sha").alias("sha"), F.max("sha_hi").alias("sha_hi"),
        F.min("at").alias("at"), F.max("at_hi").alias("at_hi"), F.min("st").alias("st"), F.max("st_hi").alias("st_hi"),
        F.min("re").alias("re"), F.max("re_hi").alias("re_hi"), set_digest(F.col("party_id")).alias("members"))
    mixed = (F.col("list") != F.col("list_hi")) | (F.col("sha") != F.col("sha_hi")) | (F.col("at") != F.col("at_hi"))
    rules = F.array_compact(F.array(
        F.when(mixed, "MIXED_METADATA"), F.when((F.col("st") != F.col("st_hi")) | (F.col("re") != F.col("re_hi")), "PARTIAL_TRANSITION"),
        F.when(~mixed & (F.col("event_id") != event_digest(F.col("list"), F.col("sha"), F.col("members"))), "ID_MISMATCH")))
    return pairs.unionByName(doubled).unionByName(explode_once(events, ["event_id"], rules, "violation"))


def evidence_integrity(events: DataFrame, queue: DataFrame, immutable: list[str]) -> DataFrame:
    """Event log against its review queue: orphan queue rows, missing rows, altered evidence."""
    e = events.filter("event_type <> 'DOCUMENT_REVIEW'").select("event_id", F.struct(*immutable).alias("e"))
    q = queue.select("event_id", F.struct(*immutable).alias("q"))
    j = e.join(q, "event_id", "full_outer")
    violation = F.when(F.col("e").isNull(), "ORPHAN_QUEUE_ROW").when(F.col("q").isNull(), "MISSING_QUEUE_ROW").when(
        ~F.col("e.source_hash").eqNullSafe(F.col("q.source_hash")), "CONFLICTING_HASH").when(~F.col("e").eqNullSafe(F.col("q")), "EVIDENCE_CHANGED")
    return j.select("event_id", violation.alias("violation")).filter("violation IS NOT NULL")


# --- projections and mirrors -------------------------------------------------------------

CHANGE_COLUMNS = ["detected_at", "source", "kind", "name", "before_text", "after_text"]


def open_reviews(queue: DataFrame) -> DataFrame:
    """Display rows of the open removals; the key columns come from first detection, so they stay stable."""
    seen = F.date_format(F.from_utc_timestamp(F.timestamp_millis("detected_at_ms"), "Asia/Tokyo"), "yyyy-MM-dd HH:mm:ss")
    before = F.concat(F.lit("制裁リスト（OFAC："), F.col("list"), F.lit("）; FixedRef="), F.col("party_id"), F.lit("; event_id="),
                      F.col("event_id"), F.lit("; SHA256="), F.col("snapshot_sha256"))
    return queue.filter(F.col("status") == K.PENDING).select(
        seen.alias("detected_at"), F.lit("OFAC").alias("source"), F.lit("掲載終了候補（要確認）").alias("kind"),
        N.canonical_display_name(F.col("party_name")).alias("name"), before.alias("before_text"),
        F.lit("削除承認待ち（名簿は有効のまま・削除未反映）").alias("after_text"))


def retain_changes(history: DataFrame, queue: DataFrame, cap: int = K.CHANGE_CAP) -> DataFrame:
    """Change log with a verdict for every row: open reviews are pinned and kept, history rows are kept from the newest on while
    the log has no more than max(cap, reviews) rows.  No row is dropped; writers filter on ``kept``.

    ``history`` carries ``ord`` (0 = newest); places are numbered by buckets of it.
    """
    pinned = open_reviews(queue).distinct()
    n_pinned = pinned.agg(F.count(F.lit(1))).scalar()
    rest = history.join(pinned, CHANGE_COLUMNS, "left_anti")
    rest = numbered(rest, [F.floor(F.col("ord") / 4096)], ["ord"], "rank").withColumn("n_pinned", n_pinned)
    kept = F.col("rank") <= F.greatest(F.lit(cap), F.col("n_pinned")) - F.col("n_pinned")
    return pinned.withColumns({"pinned": F.lit(True), "kept": F.lit(True)}).unionByName(
        rest.select(*CHANGE_COLUMNS, F.lit(False).alias("pinned"), kept.alias("kept")))


QUEUE_KINDS = ["追加", "変更", "掲載終了", "掲載終了候補（要確認）"]
RESOLVED_WORDS = ["対応済", "対応済み", "完了", "処理済"]


def change_key() -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in CHANGE_COLUMNS])


def unresolved_queue(history: DataFrame, statuses: DataFrame) -> DataFrame:
    """Eligible, unresolved changes, the first history row of each key; sheet statuses override history statuses."""
    clean = lambda c: F.when(N.strip(F.coalesce(c, F.lit(""))) == "", K.UNCHECKED).otherwise(N.strip(c))
    known = statuses.groupBy("key").agg(F.max_by("status", "ord").alias("sheet_status"))
    rows = history.withColumn("key", change_key()).join(known, "key", "left")
    rows = rows.withColumn("status", F.when(F.col("sheet_status").isNotNull(), clean(F.col("sheet_status"))).otherwise(clean(F.col("status"))))
    rows = rows.filter(F.col("kind").isin(QUEUE_KINDS) & ~F.col("status").isin(RESOLVED_WORDS))
    first = rows.groupBy("key").agg(F.min_by(F.struct(*CHANGE_COLUMNS, "status", "ord"), "ord").alias("r"))
    return first.select("key", *[F.col(f"r.{c}").alias(c) for c in [*CHANGE_COLUMNS, "status", "ord"]])


def mirror_changes(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Mirror of the change log: incoming rows replace base columns, reviewer columns survive.  Every row is returned; the sheet
    shows them by detected_at (newest first), ord and key."""
    old = existing.withColumn("key", change_key()).groupBy("key").agg(F.min_by(F.struct(*CHANGE_COLUMNS, "status", "note", "ord"), "ord").alias("o"))
    new = incoming.withColumn("key", change_key()).groupBy("key").agg(F.min_by(F.struct(*CHANGE_COLUMNS, "ord"), "ord").alias("n"))
    j = old.join(new, "key", "full_outer")
    base = [F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in CHANGE_COLUMNS]
    status = F.when(F.coalesce("o.status", F.lit("")) == "", K.UNCHECKED).otherwise(F.col("o.status"))
    return j.select("key", *base, status.alias("status"), F.coalesce("o.note", F.lit("")).alias("note"),
                    F.coalesce("n.ord", "o.ord").alias("ord"), F.col("o").isNull().alias("is_new"))


def mirror_reviews(existing: DataFrame, incoming: DataFrame, base: list[str], reviewer: list[str]) -> tuple[DataFrame, DataFrame]:
    """Mirror of the re-review queue, keyed by case_id: (rows, violations).

    Incoming rows replace the ``base`` columns, the ``reviewer`` columns survive.  A blank case id is a violation on its side
    and no row; of several rows with one case id the first (``ord``) stands and the others are violations.
    """
    def side(df: DataFrame, columns: list[str], name: str) -> tuple[DataFrame, DataFrame]:
        case = N.strip(F.coalesce("case_id", F.lit("")))
        groups = df.withColumn("case_id", case).groupBy("case_id").agg(
            F.min_by(F.struct(*columns, "ord"), "ord").alias(name), F.count(F.lit(1)).alias("n_rows"))
        violation = F.when(F.col("case_id") == "", "BLANK_CASE_ID").when(F.col("n_rows") > 1, "DUPLICATE_CASE_ID")
        bad = groups.select(F.lit(name).alias("side"), "case_id", "n_rows", violation.alias("violation")).filter("violation IS NOT NULL")
        return groups.filter("case_id <> ''").select("case_id", name), bad

    old, bad_old = side(existing, [*base, *reviewer], "existing")
    new, bad_new = side(incoming, base, "incoming")
    j = old.join(new, "case_id", "full_outer")
    rows = j.select("case_id", *[F.coalesce(f"incoming.{c}", f"existing.{c}").alias(c) for c in base],
                    *[F.coalesce(f"existing.{c}", F.lit("")).alias(c) for c in reviewer],
                    F.coalesce("incoming.ord", "existing.ord").alias("ord"), F.col("existing").isNull().alias("is_new"))
    return rows, bad_old.unionByName(bad_new)


def update_evidence(evidence: DataFrame, records: DataFrame, source_hash: str, seen_at: str) -> DataFrame:
    """Evidence table after a new list: earlier rows are no longer current, ``first_seen`` is carried by key."""
    first = evidence.filter("coalesce(match_key, '') <> '' AND coalesce(first_seen, '') <> ''").groupBy("match_key").agg(
        F.min_by("first_seen", "ord").alias("carried"))
    named = N.with_identity_key(records, "company")
    body = F.to_json(F.struct("record_no", "country", "aliases", "wmd", "conventional_weapons"))
    fresh = named.join(first, "match_key", "left").select(
        F.col("company").alias("canonical_record"), "match_key", F.concat_ws(":", F.lit(source_hash), F.col("record_no").cast("string")).alias("source_record_id"),
        F.coalesce("carried", F.lit(seen_at)).alias("first_seen"), F.lit(seen_at).alias("last_seen"), F.lit(True).alias("current"), body.alias("evidence"))
    old = evidence.select("canonical_record", "match_key", "source_record_id", "first_seen", "last_seen", F.lit(False).alias("current"), "evidence")
    return old.unionByName(fresh)


# --- document families -------------------------------------------------------------------

def missing_documents(links: DataFrame, resources: DataFrame) -> DataFrame:
    """Required attachments without an available, URL-equal resource that is at least as new as the link.

    The resource is found by key, else by (url, notice_url).
    """
    r = resources.select(F.col("key").alias("r_key"), F.col("url").alias("r_url"), "available", "last_success_at")
    by_key = links.join(r.withColumnRenamed("r_key", "key"), "key", "left").withColumn("r_key", F.when(F.col("r_url").isNotNull(), F.col("key")))
    direct = by_key.filter("r_key IS NOT NULL")
    other = resources.groupBy(F.col("url"), F.col("notice_url")).agg(
        F.min_by(F.struct(F.col("key").alias("k"), "available", "last_success_at"), "key").alias("m"))
    indirect = by_key.filter("r_key IS NULL").drop("r_key", "r_url", "available", "last_success_at").join(other, ["url", "notice_url"], "left").select(
        "key", "notice_url", "url", "observed_at", F.col("m.k").alias("r_key"),
        F.when(F.col("m").isNotNull(), F.col("url")).alias("r_url"), F.col("m.available").alias("available"), F.col("m.last_success_at").alias("last_success_at"))
    found = direct.select(*indirect.columns).unionByName(indirect)
    reason = (
        F.when(F.col("r_key").isNull(), "NO_RESOURCE").when(~F.coalesce("available", F.lit(False)), "UNAVAILABLE")
        .when(F.col("r_url") != F.col("url"), "URL_CHANGED").when(F.coalesce("last_success_at", F.lit("")) < F.col("observed_at"), "STALE"))
    return found.select("notice_url", F.coalesce("r_key", "key").alias("pending_key"), reason.alias("reason")).filter("reason IS NOT NULL").distinct()


CURRENT_LISTS = ["current_un", "current_1373"]


def pending_documents(sites: DataFrame, resources: DataFrame, links: DataFrame, notices: DataFrame) -> DataFrame:
    """What the document families of every site still wait for: site, family (catalog or press), pending_key, reason.

    The catalog waits for each of its two current lists without an available resource.  The press family waits for its
    unavailable notices and attachments, whether a link names them or not, for linked attachments without a fitting resource
    (``missing_documents``), and for pending notices.  ``resources``: site, key, role, url, notice_url, available,
    last_success_at; ``links``: site, key, notice_url, url, observed_at; ``notices``: site, key.  A key of the press family pends once, with the
    reason of the link before its own."""
    there = F.coalesce("available", F.lit(False))
    wanted = sites.select("site", F.explode(F.array(*map(F.lit, CURRENT_LISTS))).alias("key"))
    current = resources.filter(F.col("role") == "current_pdf").groupBy("site", "key").agg(F.bool_or(there).alias("available"))
    lists = wanted.join(current, ["site", "key"], "left").filter(~there).select(
        "site", F.lit("catalog").alias("family"), F.col("key").alias("pending_key"), F.lit("NO_CURRENT_LIST").alias("reason"))
    press = resources.filter(F.col("role").isin("notice", "attachment_pdf"))
    own = press.filter(~there).select("site", F.col("key").alias("pending_key"), F.lit("UNAVAILABLE").alias("reason"), F.lit(1).alias("rank"))
    named = lambda df: df.withColumns({c: F.concat_ws("\u241f", "site", c) for c in ("key", "notice_url")}).drop("site")
    linked = missing_documents(named(links), named(press.filter("role = 'attachment_pdf'")))
    part = lambda i: F.element_at(F.split("pending_key", "\u241f"), i)
    linked = linked.select(part(1).alias("site"), part(2).alias("pending_key"), "reason", F.lit(0).alias("rank"))
    waiting = own.unionByName(linked).groupBy("site", "pending_key").agg(F.min(F.struct("rank", "reason")).alias("r"))
    waiting = waiting.select("site", F.lit("press").alias("family"), "pending_key", F.col("r.reason").alias("reason"))
    late = notices.select("site", F.lit("press").alias("family"), F.col("key").alias("pending_key"), F.lit("PENDING_NOTICE").alias("reason"))
    return lists.unionByName(waiting).unionByName(late)


def family_status(families: DataFrame, resources: DataFrame, queue: DataFrame, missing: DataFrame, errors: DataFrame) -> DataFrame:
    """Status per document family; the first rule that applies wins.

    ``families``: family, coverage_gap, declared_pending, last_manual_check_at.  The others carry ``family``.
    """
    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("family").agg(F.count(F.lit(1)).alias(name))

    unresolved = queue.filter(~F.col("review_status").isin("REVIEWED_DOCUMENT", "CANCELLED_DOCUMENT"))
    j = families
    for df, name in ((resources, "n_resources"), (unresolved, "review_count"), (missing, "pending_count"), (errors, "n_errors")):
        j = j.join(count(df, name), "family", "left")
    j = j.fillna(0, ["n_resources", "review_count", "pending_count", "n_errors"])
    checked = F.coalesce("last_manual_check_at", F.lit("")) != ""
    pending = F.col("declared_pending") | (F.col("pending_count") > 0)
    started = (F.col("n_resources") > 0) | F.col("declared_pending") | checked
    status = (
        F.when(F.col("coverage_gap"), "COVERAGE_GAP").when(F.col("n_errors") > 0, "manual_error")
        .when(pending & started, "manual_pending").when(pending, "manual_required")
        .when(F.col("review_count") > 0, "manual_review").when(checked, "manual_checked").otherwise("manual_required"))
    return j.select("family", status.alias("status"), "pending_count", "review_count")
