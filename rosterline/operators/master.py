"""Master table: source-scoped merge, repair, annotations, statistics and published projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import constants as K
from ..functions import names as N
from ..functions import remarks as R
from ..functions.digests import row_text, set_digest
from ..functions.rows import explode_once

NO_TEXTS = "array<string>"
AUDITED = ["status", "sources", "categories", "remark"]
AUDIT_FIELDS = ["status", "sources", "categories", "remark", "invalid_reason", "review_flag"]


def empty_array() -> Column:
    return F.array().cast(NO_TEXTS)


def _tagged(source: str, cats: Column) -> Column:
    return F.transform(cats, lambda c: F.concat(F.lit(source + ":"), c))


def _without(source: str, cats: Column) -> Column:
    return F.filter(cats, lambda c: ~F.startswith(c, F.lit(source + ":")))


def fold_records(records: DataFrame, order: str = "ord") -> DataFrame:
    """Fetched records to one row per identity key: first spelling by source order, set of categories.

    Damaged names and names without a key are skipped.  The category set is bounded by the number
    of categories of one source, and both aggregates combine map-side.
    """
    named = records.withColumn("name", N.canonical_display_name(F.col("name")))
    named = N.with_identity_key(named.filter(~N.is_unknown_artifact(F.col("name"))), "name")
    return named.filter("match_key <> ''").groupBy("match_key").agg(
        F.min_by("name", order).alias("name"),
        F.array_sort(F.collect_set(F.when(F.coalesce("category", F.lit("")) != "", F.col("category")))).alias("cats"),
    )


def merge(master: DataFrame, records: DataFrame, source: str, ts: int, *,
          delist: bool = True, report_missing: bool = True) -> DataFrame:
    """Fold one source into the master.

    Returns every master row after the merge plus ``kind`` (added / changed / removed / NULL),
    ``delisted`` and the four audited fields before; ``new_master`` and ``diff_of`` project it.  Both
    sides have one row per key, so the only wide step is one full outer join on the key.
    """
    before = F.struct(*[F.col(f"m.{c}").alias(c) for c in AUDITED])
    joined = master.alias("m").join(fold_records(records).alias("i"), "match_key", "full_outer").select(
        "match_key", *[F.col(f"m.{c}").alias(c) for c in K.MASTER_COLUMNS if c != "match_key"],
        F.col("i.name").alias("in_name"), F.col("i.cats").alias("in_cats"), before.alias("before"))
    known, fetched = F.col("display_name").isNotNull(), F.col("in_name").isNotNull()
    tracked = F.coalesce(F.array_contains("sources", source), F.lit(False))
    kept, lost = known & fetched, known & ~fetched & tracked
    dropped = lost if delist else F.lit(False)

    cats = _tagged(source, F.coalesce("in_cats", empty_array()))
    sources = (
        F.when(~known, F.array(F.lit(source)))
        .when(kept, F.array_sort(F.array_union("sources", F.array(F.lit(source)))))
        .when(dropped, F.array_remove("sources", source))
        .otherwise(F.col("sources"))
    )
    categories = (
        F.when(~known, cats)
        .when(kept, F.array_sort(F.array_union(_without(source, F.col("categories")), cats)))
        .when(dropped, _without(source, F.col("categories")))
        .otherwise(F.col("categories"))
    )
    invalid, review = N.invalid_reason(F.col("in_name")), N.review_reason(F.col("in_name"))
    revived = kept & F.col("invalid_reason").isin(K.REACTIVATABLE)
    step = joined.withColumns({
        "new_sources": sources, "new_categories": categories,
        "in_invalid": F.when(~known, invalid), "in_review": F.when(~known, review),
    })
    orphaned = dropped & (F.size("new_sources") == 0)
    step = step.withColumns({
        "new_status": F.when(~known, F.when(F.col("in_invalid").isNull(), K.ACTIVE).otherwise(K.INACTIVE))
        .when(revived, K.ACTIVE).when(orphaned, K.INACTIVE).otherwise(F.col("status")),
        "new_invalid": F.when(~known, F.coalesce("in_invalid", F.lit("")))
        .when(revived, "").when(orphaned, K.DELISTED).otherwise(F.col("invalid_reason")),
        "new_flag": F.when(~known, F.when(F.col("in_invalid").isNull(), F.coalesce("in_review", F.lit(""))).otherwise(""))
        .when(revived & F.col("review_flag").isin(K.WEAK_FLAGS), "").otherwise(F.col("review_flag")),
        "new_remark": F.when(~known | kept | dropped, R.remark_of(F.col("new_sources"), F.col("new_categories")))
        .otherwise(F.col("remark")),
    })
    same = (
        F.col("status").eqNullSafe(F.col("new_status")) & (F.array_sort("sources") == F.col("new_sources"))
        & (F.array_sort("categories") == F.col("new_categories")) & F.col("remark").eqNullSafe(F.col("new_remark"))
    )
    kind = F.when(~known, "added").when(kept & ~same, "changed").when(
        lost & F.lit(delist or report_missing), "removed")
    step = step.withColumn("kind", kind)
    moved = F.col("kind").isin("added", "changed") | dropped
    return step.select(
        "match_key", F.coalesce("display_name", "in_name").alias("display_name"),
        F.col("new_status").alias("status"),
        F.coalesce("risk_type", F.lit(K.RISK_TYPE)).alias("risk_type"),
        F.coalesce("risk_level", F.lit(K.RISK_LEVEL)).alias("risk_level"),
        F.coalesce("first_seen_ms", F.lit(ts).cast("bigint")).alias("first_seen_ms"),
        F.when(moved, F.lit(ts).cast("bigint")).otherwise(F.col("last_updated_ms")).alias("last_updated_ms"),
        F.col("new_sources").alias("sources"), F.col("new_categories").alias("categories"),
        F.col("new_remark").alias("remark"), F.col("new_invalid").alias("invalid_reason"),
        F.col("new_flag").alias("review_flag"),
        F.coalesce("variants", F.array("in_name")).alias("variants"),
        "kind", F.when(F.col("kind") == "removed", F.lit(delist)).alias("delisted"), "before",
    )


def new_master(merged: DataFrame) -> DataFrame:
    return merged.select(*K.MASTER_COLUMNS)


def diff_of(merged: DataFrame, source: str) -> DataFrame:
    """Diff rows of a merge; a held removal reports its unchanged state on both sides."""
    return merged.filter("kind IS NOT NULL").select(
        F.lit(source).alias("source"), "kind", "match_key", F.col("display_name").alias("name"), "delisted", "before",
        F.struct(*[F.col(c) for c in AUDITED]).alias("after"), "invalid_reason", "review_flag")


def classify_backfill(diff: DataFrame, previous_strong: DataFrame, *, rollout_pending: bool = True,
                      index_baseline: bool = False) -> DataFrame:
    """Additions that the earlier history already held as strong names are an initial sync, not news."""
    if not rollout_pending:
        return diff.withColumn("origin", F.lit(None).cast("string"))
    if index_baseline:
        return diff.withColumn("origin", F.when(F.col("kind") == "added", "backfill"))
    seen = previous_strong.select("match_key", F.lit(True).alias("was_strong"))
    return diff.join(seen, "match_key", "left").withColumn(
        "origin", F.when((F.col("kind") == "added") & F.col("was_strong"), "backfill")).drop("was_strong")


def diff_counts(diff: DataFrame) -> DataFrame:
    """Added / backfilled / removed / changed per source."""
    backfill = F.coalesce(F.col("origin") == "backfill", F.lit(False))
    return diff.groupBy("source").agg(
        F.count_if((F.col("kind") == "added") & ~backfill).alias("added"),
        F.count_if((F.col("kind") == "added") & backfill).alias("backfilled"),
        F.count_if(F.col("kind") == "removed").alias("removed"),
        F.count_if(F.col("kind") == "changed").alias("changed"))


def diff_rows(diff: DataFrame) -> DataFrame:
    """Diff as published: source, kind label, name, text before and after (extra fields when they changed).

    ``before`` / ``after`` may carry ``invalid_reason`` and ``review_flag``; only then are they compared.
    """
    extras = [c for c in ("invalid_reason", "review_flag")
              if c in diff.schema["before"].dataType.fieldNames() and c in diff.schema["after"].dataType.fieldNames()]

    def text(side: str) -> Column:
        other = "after" if side == "before" else "before"
        shown = [
            F.when(F.coalesce(F.col(f"{side}.{c}"), F.lit("")) != F.coalesce(F.col(f"{other}.{c}"), F.lit("")),
                   F.concat(F.lit(c + "="), F.when(F.coalesce(F.col(f"{side}.{c}"), F.lit("")) == "", "—").otherwise(F.col(f"{side}.{c}"))))
            for c in extras
        ]
        extra = F.concat_ws(" / ", *shown) if shown else F.lit("")
        parts = F.filter(F.array(F.coalesce(F.col(f"{side}.remark"), F.lit("")), extra), lambda v: v != "")
        return F.when(F.col("kind") == "changed", F.array_join(parts, " | ")).otherwise(F.coalesce(F.col(f"{side}.remark"), F.lit("")))

    held = ~F.coalesce(F.col("delisted"), F.lit(True))
    label = (
        F.when((F.col("kind") == "added") & F.coalesce(F.col("origin") == "backfill", F.lit(False)), "初回同期（Advanced XML）")
        .when(F.col("kind") == "added", "追加")
        .when(held, "掲載終了候補（要確認）").when(F.col("kind") == "removed", "掲載終了").otherwise("変更")
    )
    return diff.select("source", label.alias("kind_label"), "name",
                       F.when(F.col("kind") == "added", "").otherwise(text("before")).alias("before_text"),
                       text("after").alias("after_text"))


# --- repair and cluster ------------------------------------------------------------------

# Fixed values of the repair: characters trimmed at the edges, trailing bracket, leading number.
EDGE = "(（)）-–—:：;；.,、。'\"「」『』 　"
BRACKET_TAIL = r"[（(]([^（()）]+)[)）]\s*$"
LEADING_NUMBER = r"^\s*[0-9０-９]+[\s.．、]+"


def repair_candidates(raw: Column) -> Column:
    """Names that a damaged legacy cell may stand for, in trial order."""
    pieces = F.flatten(F.transform(N.split_top_level(N.clean_name(raw)), N.split_aliases))

    def spellings(p):
        bare = N.strip_descriptor(p)
        forms = F.flatten(F.transform(F.array(p, bare), lambda s: F.array(
            s, F.btrim(s, F.lit(EDGE)), F.regexp_replace(F.btrim(s, F.lit(EDGE)), LEADING_NUMBER, ""))))
        return F.flatten(F.transform(F.array_distinct(forms), lambda s: F.array(
            s, F.when(s.rlike(BRACKET_TAIL), N.clean_name(F.regexp_replace(s, BRACKET_TAIL, ""))).otherwise(""),
            N.clean_name(F.regexp_extract(s, BRACKET_TAIL, 1)))))

    return F.filter(F.array_distinct(F.flatten(F.transform(pieces, spellings))), lambda s: s != "")


def repair_legacy(master: DataFrame, official: DataFrame, source: str = K.SRC_MOF) -> DataFrame:
    """Revive or merge inactive rows that lost every source because their name was damaged.

    ``official``: match_key, name, categories.  The first candidate on the official list wins; a
    target that is already a master row absorbs the damaged one (earliest first_seen, all variants),
    several damaged rows with one absent target become one row.  Every output row says what
    happened: ``outcome`` is revived / merged_into / unresolved / untouched.
    """
    target = (F.col("invalid_reason") == K.DELISTED) & (F.size("sources") == 0)
    damaged = master.filter(target)
    tried = explode_once(damaged, [F.col("match_key").alias("old_key")], repair_candidates(F.col("display_name")), "cand", "pos")
    tried = N.with_identity_key(tried, "cand", "cand_key").filter("cand_key <> '' AND cand_key <> old_key")
    listed = official.select(F.col("match_key").alias("cand_key"), F.col("name").alias("official_name"), F.col("categories").alias("official_cats"))
    hits = tried.join(listed, "cand_key").groupBy("old_key").agg(
        F.min_by(F.struct("cand_key", "official_name", "official_cats"), "pos").alias("hit"))
    flagged = master.join(hits.select(F.col("old_key").alias("match_key"), F.col("hit")), "match_key", "left")
    moved = F.col("hit").isNotNull()
    # rows that land on one key: the standing master row (if any) and the damaged rows re-keyed to it
    landed = flagged.withColumn("standing", ~moved).withColumn(
        "landing", F.when(moved, F.col("hit.cand_key")).otherwise(F.col("match_key")))
    arrivals = landed.filter(moved).select(
        "landing", "first_seen_ms", "match_key", F.struct("match_key", *[c for c in K.MASTER_COLUMNS if c != "match_key"]).alias("row"),
        "hit", F.explode(F.array_union("variants", F.array("display_name"))).alias("variant"))
    grouped = arrivals.groupBy("landing").agg(
        F.min("first_seen_ms").alias("arrival_first"), F.countDistinct("match_key").alias("n_arrivals"),
        F.min_by("row", "match_key").alias("head"), F.min_by("hit", "match_key").alias("hit"),
        F.collect_set("variant").alias("arrival_variants"))
    stay = landed.filter(~moved).select(*K.MASTER_COLUMNS, target.alias("was_target"))
    out = stay.join(grouped.withColumnRenamed("landing", "match_key"), "match_key", "full_outer")
    standing, arrived = F.col("display_name").isNotNull(), F.col("hit").isNotNull()
    revived = ~standing & arrived
    cats = F.array_sort(_tagged(source, F.coalesce(F.col("hit.official_cats"), empty_array())))
    fresh = {
        "display_name": F.col("hit.official_name"), "status": F.lit(K.ACTIVE), "invalid_reason": F.lit(""),
        "sources": F.array(F.lit(source)), "categories": cats, "remark": R.remark_of(F.array(F.lit(source)), cats),
        "variants": F.array_sort(F.array_union("arrival_variants", F.array("hit.official_name"))),
        "first_seen_ms": F.col("arrival_first"),
    }
    absorbed = {
        "first_seen_ms": F.least("first_seen_ms", "arrival_first"),
        "variants": F.array_sort(F.array_union("variants", "arrival_variants")),
    }

    def pick(c: str) -> Column:
        base = F.when(revived, fresh.get(c, F.col(f"head.{c}")))
        if c in absorbed:
            base = base.when(arrived, absorbed[c])
        return base.otherwise(F.col(c)).alias(c)

    outcome = F.when(revived, "revived").when(arrived, "merged_into").when(F.col("was_target"), "unresolved").otherwise("untouched")
    return out.select("match_key", *[pick(c) for c in K.MASTER_COLUMNS if c != "match_key"],
                      outcome.alias("outcome"), F.coalesce("n_arrivals", F.lit(0)).alias("n_absorbed"))


def _spelled(rows: DataFrame) -> DataFrame:
    """Legacy sheet rows to one row per (key, spelling, remark); keyless spellings and unknown artifacts fall away."""
    cells = N.with_aliases(rows.select("ord", "raw", "remark", "first_ms", "last_ms", "was_invalid"), "raw", "parts")
    pieces = explode_once(cells, ["ord", "raw", "remark", "first_ms", "last_ms", "was_invalid", (F.size("parts") > 1).alias("split")], F.col("parts"), "piece", "pos")
    pieces = N.with_display_name(pieces, "piece").drop("piece")
    # one row per (spelling, remark): keys, verdicts and remarks are worked out per distinct text, not per row
    spelled = pieces.withColumn("place", F.struct("first_ms", "ord", "pos")).groupBy("name", "remark").agg(
        F.min_by(F.struct("raw", "last_ms"), "place").alias("head"), F.min("place").alias("place"), F.count(F.lit(1)).alias("n"),
        F.bool_or("was_invalid").alias("was_invalid"), F.min(F.when(F.col("was_invalid"), F.col("place"))).alias("invalid_place"),
        F.bool_or("split").alias("split"))
    return N.with_identity_key(spelled.filter(~N.is_unknown_artifact(F.col("name"))), "name").filter("match_key <> ''")


def legacy_spellings(rows: DataFrame) -> DataFrame:
    """(match_key, name, place) per distinct spelling of a key, with the place it first stands at: the spelling cells in long form, so a
    key of any number of spellings stays spread over rows.  ``sources.sinks.fold_cells`` writes them as cells."""
    return _spelled(rows).groupBy("match_key", "name").agg(F.min("place").alias("place"))


def legacy_marks(rows: DataFrame) -> DataFrame:
    """Distinct (match_key, source, category) of the remarks of a key: its source and category cells in long form."""
    remarks = _spelled(rows).select("match_key", "remark").distinct()
    texts = rows.select("remark").distinct().withColumn("pairs", R.parse_remark_multi(F.col("remark")))
    return remarks.join(texts, "remark").select("match_key", F.inline("pairs")).select("match_key", "source", "category").distinct()


def cluster_legacy(rows: DataFrame, ts: int) -> DataFrame:
    """Legacy sheet rows (raw, remark, first_ms, last_ms, was_invalid, ord) to master rows, one per key.

    Per-key reductions are ordered minima and bounded sets, all combined map-side; the spelling set is
    reduced to distinct (key, spelling) pairs before it is gathered.
    """
    texts = rows.select("remark").distinct().withColumn("pairs", R.parse_remark_multi(F.col("remark")))
    spelled = _spelled(rows).join(texts, "remark")
    spelled = spelled.withColumns({"bad": N.invalid_reason(F.col("name")), "odd": N.review_reason(F.col("name"))})
    reason = F.coalesce("bad", F.when(F.col("was_invalid"), "既存データで無効指定"))
    reason_place = F.when(F.col("bad").isNotNull(), F.col("place")).otherwise(F.col("invalid_place"))
    review = F.when(F.col("bad").isNull(), F.col("odd"))
    head = spelled.groupBy("match_key").agg(
        F.min_by(F.struct("name", "head.raw", "head.last_ms"), "place").alias("head"), F.min("place.first_ms").alias("first_seen_ms"),
        F.sum("n").alias("members"), F.bool_or(reason.isNotNull()).alias("invalid"), F.bool_or("split").alias("any_split"),
        F.min_by(reason, F.when(reason.isNotNull(), reason_place)).alias("reason"), F.min_by(review, F.when(review.isNotNull(), F.col("place"))).alias("review"),
        F.array_sort(F.collect_set("name")).alias("variants"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    sources = F.array_sort(F.array_distinct(F.transform("pairs", lambda p: p["source"])))
    cats = F.array_sort(F.array_distinct(F.transform(
        F.filter("pairs", lambda p: p["category"] != ""), lambda p: F.concat(p["source"], F.lit(":"), p["category"]))))
    head = head.withColumns({"sources": sources, "categories": cats})
    touched = (F.col("members") > 1) | F.col("invalid") | F.col("any_split") | (F.col("head.name") != F.col("head.raw"))
    return head.select(
        "match_key", F.col("head.name").alias("display_name"),
        F.when(F.col("invalid"), K.INACTIVE).otherwise(K.ACTIVE).alias("status"),
        F.lit(K.RISK_TYPE).alias("risk_type"), F.lit(K.RISK_LEVEL).alias("risk_level"), "first_seen_ms",
        F.when(touched, F.lit(ts).cast("bigint")).otherwise(F.coalesce("head.last_ms", "first_seen_ms")).alias("last_updated_ms"),
        "sources", "categories", R.remark_of(F.col("sources"), F.col("categories")).alias("remark"),
        F.coalesce("reason", F.lit("")).alias("invalid_reason"), F.coalesce("review", F.lit("")).alias("review_flag"),
        "variants", "members")


# --- statistics --------------------------------------------------------------------------

def build_statistics(master: DataFrame) -> DataFrame:
    """Item / value rows: totals, status split, time range, rows per source (a row counts in each)."""
    total = master.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == K.ACTIVE).alias("active"),
        F.count_if(F.col("status") == K.INACTIVE).alias("inactive"),
        F.min("first_seen_ms").alias("first_seen_ms"), F.max("last_updated_ms").alias("last_updated_ms"))
    items = total.select(F.explode(F.create_map(*[
        v for c in total.columns for v in (F.lit(c), F.col(c))])).alias("item", "value"))
    per_source = master.select(F.explode("sources").alias("s")).filter(F.col("s") != K.SRC_UNKNOWN).groupBy("s").agg(
        F.count(F.lit(1)).alias("value")).select(F.concat(F.lit("source: "), "s").alias("item"), "value")
    return items.unionByName(per_source)


def remarks_from_pairs(pairs: DataFrame) -> DataFrame:
    """Remark per row from long (row_id, source, category) pairs; the pair set of a row is bounded by the categories."""
    grouped = pairs.distinct().groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("source", "category"))).alias("pairs"))
    return grouped.select("row_id", R.render_remark(F.col("pairs")).alias("remark"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Violations of 'present and unique': empty keys and keys held by several rows."""
    empty = None
    for k in keys:
        e = F.coalesce(F.col(k).cast("string"), F.lit("")) == ""
        empty = e if empty is None else empty | e
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "violation", F.when(empty, "EMPTY_KEY").when(F.col("n_rows") > 1, "DUPLICATE_KEY")).filter("violation IS NOT NULL")


def state_digest(df: DataFrame, fields: list[str]) -> DataFrame:
    """Order-independent digest of a keyed table: one row, no collected group."""
    texts = [F.array_join(c, ";") if dict(df.dtypes)[f].startswith("array") else c for f in fields for c in [F.col(f)]]
    rows = df.select(row_text(texts).alias("row"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), set_digest(F.col("row")).alias("state_hash"))


def multiset_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows that are missing or extra as a multiset, with their surplus count."""
    cols = expected.columns
    both = expected.select(*cols, F.lit(1).alias("w")).unionByName(actual.select(*cols, F.lit(-1).alias("w")))
    surplus = both.groupBy(*cols).agg(F.sum("w").alias("w")).filter("w <> 0")
    return surplus.withColumn("side", F.when(F.col("w") > 0, "missing").otherwise("extra")).withColumn("n_rows", F.abs("w")).drop("w")


# --- published projections ---------------------------------------------------------------

def clean_rows(master: DataFrame) -> DataFrame:
    """Rows as they may be written: display name canonical, damaged names dropped."""
    shown = master.withColumn("display_name", N.canonical_display_name(F.col("display_name")))
    return shown.filter(~N.is_unknown_artifact(F.col("display_name")))


def flat_master(master: DataFrame) -> DataFrame:
    """The 13 text columns of the master file; arrays in their joined form."""
    rows = clean_rows(master)
    joined = {c: F.array_join(F.array_sort(c), ";") for c in ("sources", "categories")}
    joined["variants"] = F.to_json("variants")
    return rows.select(*[joined.get(c, F.col(c)).alias(c) for c in K.MASTER_COLUMNS])


def list_projection(master: DataFrame) -> DataFrame:
    return clean_rows(master).select("display_name", "risk_type", "status", "risk_level")


def screening_projection(master: DataFrame) -> DataFrame:
    """Active rows with exact and relaxed key; ``violation`` marks rows that must stop the publication."""
    rows = clean_rows(master.filter(N.strip(F.col("status")) == K.ACTIVE))
    rows = N.with_identity_key(rows, "display_name", "own_key").withColumn("secondary_key", N.relaxed_key(F.col("own_key")))
    violation = F.when(F.col("display_name") == "", "EMPTY_NAME").when(
        N.strip(F.col("match_key")) == "", "EMPTY_KEY").when(F.col("secondary_key") == "", "EMPTY_SECONDARY_KEY")
    return rows.select(
        N.strip(F.col("match_key")).alias("match_key"), "secondary_key", "display_name",
        F.array_join("sources", ";").alias("sources"), F.array_join("categories", ";").alias("categories"),
        "risk_type", "risk_level", "status", "review_flag", violation.alias("violation"))


def import_projection(master: DataFrame, published_diff: DataFrame) -> DataFrame:
    """Current master row of every key that a published diff touches, once; held removals are skipped.

    ``violation`` is set for diff keys that the master does not hold.
    """
    held = (F.col("kind_label") == "掲載終了候補（要確認）") | (
        (F.col("kind_label") == "掲載終了") & (F.col("before_text") == F.col("after_text")))
    touched = published_diff.filter(~held).select(N.canonical_display_name(F.col("name")).alias("name"))
    touched = touched.filter(~N.is_unknown_artifact(F.col("name")))
    touched = N.with_identity_key(touched, "name").filter("match_key <> ''").groupBy("match_key").agg(F.min("name").alias("diff_name"))
    rows = touched.join(clean_rows(master), "match_key", "left")

    def jst(ms: str) -> Column:
        return F.date_format(F.from_utc_timestamp(F.timestamp_millis(F.col(ms)), "Asia/Tokyo"), "yyyy-MM-dd HH:mm:ss")

    return rows.select(
        "match_key", F.coalesce("display_name", "diff_name").alias("name"), "risk_type", "status", "risk_level",
        jst("first_seen_ms").alias("first_seen"), jst("last_updated_ms").alias("last_updated"), "remark",
        F.when(F.col("display_name").isNull(), "MASTER_ROW_MISSING").alias("violation"))


# --- plan and apply ----------------------------------------------------------------------

def plan_candidates(records: DataFrame, source_hash: str) -> DataFrame:
    """One row per primary or alias name of a record (record_no, company, aliases) with its verdicts."""
    names = records.select("record_no", F.col("company").alias("record_primary"), F.posexplode(
        F.concat(F.array("company"), "aliases")).alias("pos", "raw"))
    names = names.withColumn("name", N.canonical_display_name(F.col("raw"))).filter("name <> ''")
    names = N.with_identity_key(names, "name")
    kind = F.when(F.col("pos") == 0, "PRIMARY").otherwise(F.concat(F.lit("ALIAS:"), F.col("pos").cast("string")))
    invalid = F.coalesce(N.invalid_reason(F.col("name")), F.lit(""))
    names = names.withColumns({"kind": kind, "invalid": invalid})
    return names.withColumns({
        "review": F.when(F.col("invalid") == "", F.coalesce(N.review_reason(F.col("name")), F.lit(""))).otherwise(""),
        "token": F.concat_ws(":", F.lit(source_hash), F.col("record_no").cast("string"), F.col("kind")),
    })


def classify_plan(candidates: DataFrame, master: DataFrame, source: str = K.SRC_METI,
                  verified_names: list[str] | None = None) -> DataFrame:
    """Action per identity key.

    Ordered minima and boolean folds decide, so a hot key needs constant state; the tokens and names
    of a key stay in the long candidate table (``plan_tokens``) instead of one cell.
    """
    weak = F.col("review").contains("短く") & F.col("review").contains("誤検知")
    verified = F.col("review").contains("異常に長い") & F.col("name").isin(verified_names or [])
    safe = (F.col("invalid") == "") & ((F.col("review") == "") | verified)
    priority = F.struct(
        (F.col("kind") != "PRIMARY").alias("a"), (F.col("review") != "").alias("b"), F.col("record_no"),
        F.lower("name").alias("fold"), F.col("pos"))
    chosen = F.struct("name", "record_no", "record_primary", "kind", "review")
    keyed = candidates.groupBy("match_key").agg(
        F.count(F.lit(1)).alias("n_names"), F.min("record_no").alias("low"), F.max("record_no").alias("high"),
        F.min_by(chosen, priority).alias("best"), F.min_by(chosen, F.when(safe, priority)).alias("best_safe"),
        F.bool_or(safe).alias("any_safe"), F.bool_and(F.col("invalid") != "").alias("all_invalid"),
        F.bool_or(F.col("review") != "").alias("any_review"),
        F.bool_and((F.col("review") == "") | weak).alias("only_weak"),
        F.min_by("invalid", F.when(F.col("invalid") != "", priority)).alias("first_invalid"),
        F.min_by("review", F.when(F.col("review") != "", priority)).alias("first_review"),
    )
    held = master.select("match_key", F.array_contains("sources", source).alias("tagged"),
                         F.array_join("sources", ";").alias("existing_sources"), F.col("display_name").alias("existing_name"))
    row = keyed.join(held, "match_key", "left")
    collision = F.col("low") != F.col("high")
    action = (
        F.when(collision, "HOLD_MULTI_PARTY_COLLISION")
        .when(F.col("any_safe") & F.col("tagged").isNull(), "READY_ADD")
        .when(F.col("any_safe") & F.col("tagged"), "NOOP_ALREADY_METI")
        .when(F.col("any_safe"), "READY_TAG_EXISTING")
        .when(F.col("all_invalid"), "HOLD_INVALID")
        .when(F.col("any_review") & F.col("only_weak"), "HOLD_WEAK_ALIAS")
        .otherwise("HOLD_REVIEW")
    )
    pick = F.when(~collision & F.col("any_safe"), F.col("best_safe")).otherwise(F.col("best"))
    row = row.withColumns({"action": action, "chosen": pick})
    reason = (
        F.when(F.col("action") == "HOLD_MULTI_PARTY_COLLISION",
               "同一match_keyが複数のMETI No.に紐づく。party-aware管理まで単独master反映しない")
        .when(F.col("any_safe"), F.col("chosen.review"))
        .when(F.col("action") == "HOLD_WEAK_ALIAS", F.col("first_review"))
        .otherwise(F.coalesce("first_invalid", "first_review", F.lit("")))
    )
    return row.select(
        "action", "match_key", F.col("chosen.name").alias("name"), F.col("chosen.record_no").alias("record_no"),
        F.col("chosen.record_primary").alias("record_primary"), F.col("chosen.kind").alias("kind"), "n_names",
        reason.alias("review_reason"),
        F.when(~collision & F.col("any_safe") & (F.col("chosen.review") != ""), "SOURCE_VERIFIED_LONG_ALIAS").otherwise("").alias("resolution"),
        F.coalesce("existing_sources", F.lit("")).alias("existing_sources"), F.coalesce("existing_name", F.lit("")).alias("existing_name"))


def plan_tokens(candidates: DataFrame, plan: DataFrame) -> DataFrame:
    """Long form of the plan's source tokens: which name of which record every plan row rests on."""
    return candidates.select("match_key", "token", "record_no", "kind", "name").join(plan.select("match_key", "action"), "match_key")


def legacy_holds(master: DataFrame, current: DataFrame, source: str = K.SRC_METI) -> DataFrame:
    """Rows tagged with the source whose key the current list no longer carries."""
    tagged = master.filter(F.array_contains("sources", source))
    return tagged.join(current.select("match_key").distinct(), "match_key", "left_anti").select(
        F.lit("HOLD_LEGACY_NOT_IN_CURRENT").alias("action"), "match_key", "display_name",
        F.array_join("sources", ";").alias("sources"), "status", "remark")


def audit_tokens(expected: DataFrame, reached: DataFrame) -> DataFrame:
    """Source tokens that a plan misses, repeats or invents.  ``expected``: token; ``reached``: token, match_key."""
    want = expected.groupBy("token").agg(F.count(F.lit(1)).alias("n_expected"))
    have = reached.groupBy("token").agg(F.count(F.lit(1)).alias("n_reached"))
    both = want.join(have, "token", "full_outer").fillna(0, ["n_expected", "n_reached"])
    violation = (
        F.when(F.col("n_expected") == 0, "UNEXPECTED_TOKEN").when(F.col("n_reached") == 0, "MISSING_TOKEN")
        .when(F.col("n_expected") > 1, "REPEATED_SOURCE_TOKEN").when(F.col("n_reached") > 1, "DUPLICATED_TOKEN"))
    return both.withColumn("violation", violation).filter("violation IS NOT NULL")


ACTIONABLE = ["READY_ADD", "READY_TAG_EXISTING", "NOOP_ALREADY_METI"]


def primary_outcomes(records: DataFrame, reached: DataFrame) -> DataFrame:
    """The plan's outcome for the primary name of every record: record_no, n_outcomes, action, match_key, name, held, violation.

    ``records``: record_no; ``reached``: the plan's tokens (record_no, kind, action, match_key, name).  Exactly one row of the plan may
    rest on a record's primary name; a hold is an outcome too."""
    outcome = F.struct("action", "match_key", "name")
    found = reached.filter("kind = 'PRIMARY'").groupBy("record_no").agg(F.count(F.lit(1)).alias("n"), F.min(outcome).alias("o"))
    rows = records.select("record_no").distinct().join(found, "record_no", "left")
    n = F.coalesce("n", F.lit(0))
    one = lambda c: F.when(n == 1, F.col(f"o.{c}"))
    return rows.select(
        "record_no", n.alias("n_outcomes"), one("action").alias("action"), one("match_key").alias("match_key"), one("name").alias("name"),
        F.startswith(one("action"), F.lit("HOLD")).alias("held"), F.when(n == 0, "NO_PRIMARY").when(n > 1, "SEVERAL_PRIMARY").alias("violation"))


def audit_action_counts(plan: DataFrame, ledger: DataFrame) -> DataFrame:
    """Actions whose number of plan rows is not the one that the apply ledger (action, n) recorded."""
    planned = plan.groupBy("action").agg(F.count(F.lit(1)).alias("n_plan"))
    recorded = ledger.groupBy("action").agg(F.sum("n").alias("n_ledger"))
    return planned.join(recorded, "action", "full_outer").fillna(0, ["n_plan", "n_ledger"]).filter("n_plan <> n_ledger")


def unchanged_since_apply(master: DataFrame, applied: DataFrame, fields: list[str]) -> DataFrame:
    """Whether the master still is what the ledger of an apply (run, n_rows, state_hash) recorded; one row for each run."""
    now = state_digest(master, fields).select(F.col("n_rows").alias("current_count"), F.col("state_hash").alias("current_hash"))
    # the digest is one row; a key that both sides share makes it an equi-join
    return applied.withColumn("one", F.lit(1)).join(now.withColumn("one", F.lit(1)), "one").select(
        "run", F.col("n_rows").alias("apply_count"), "current_count", (F.col("state_hash") == F.col("current_hash")).alias("unchanged"))


def primary_details(outcomes: DataFrame, master: DataFrame, source: str = K.SRC_METI) -> DataFrame:
    """Where the primary name of every record stands in the master: in_master, tagged; ``outcomes`` as of ``primary_outcomes``."""
    held = master.select("match_key", F.array_contains("sources", source).alias("tagged"), F.lit(True).alias("there"))
    return outcomes.join(held, "match_key", "left").select(
        "record_no", "action", "name", "match_key", F.coalesce("there", F.lit(False)).alias("in_master"), F.coalesce("tagged", F.lit(False)).alias("tagged"))


def audit_applied(plan: DataFrame, master: DataFrame, source: str = K.SRC_METI) -> DataFrame:
    """Plan rows against the applied master: actionable keys must exist and carry the tag."""
    ready = plan.filter(F.col("action").isin(ACTIONABLE))
    row = ready.select("action", "match_key").join(master.select("match_key", "sources", "status"), "match_key", "left")
    violation = (
        F.when(F.col("sources").isNull(), "MASTER_ROW_MISSING")
        .when(~F.array_contains("sources", source), "SOURCE_TAG_MISSING"))
    return row.select("match_key", "action", violation.alias("violation")).filter("violation IS NOT NULL")


def simulate_apply(plan: DataFrame, master: DataFrame, source: str, ts: int) -> DataFrame:
    """Merge the READY rows and compare the effect with the plan; one row per key that deviates or was touched.

    Every inserted key must be READY_ADD, every changed key READY_TAG_EXISTING, and every READY row must
    have its effect; held and untouched rows must stay as they are.
    """
    ready = plan.filter(F.col("action").isin("READY_ADD", "READY_TAG_EXISTING")).select(
        "name", F.lit("").alias("category"), F.col("record_no").cast("bigint").alias("ord"))
    merged = merge(master, ready, source, ts, delist=False, report_missing=False)
    effect = F.when(F.col("kind") == "added", "INSERTED").when(F.col("kind") == "changed", "CHANGED").otherwise("UNCHANGED")
    seen = merged.select("match_key", effect.alias("effect"), "status", F.array_join("sources", ";").alias("sources"))
    both = plan.select("match_key", "action").join(seen, "match_key", "full_outer")
    want = F.when(F.col("action") == "READY_ADD", "INSERTED").when(F.col("action") == "READY_TAG_EXISTING", "CHANGED").otherwise("UNCHANGED")
    got = F.coalesce("effect", F.lit("UNCHANGED"))
    return both.filter(F.col("action").isNotNull() | (got != "UNCHANGED")).select(
        "match_key", F.coalesce("action", F.lit("")).alias("action"), got.alias("effect"),
        F.coalesce("status", F.lit("")).alias("status"), F.coalesce("sources", F.lit("")).alias("sources"),
        (want == got).alias("as_planned"))
