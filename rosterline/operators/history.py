"""Alias and party history of an identifier-based list, and what its changes mean for the master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import constants as K
from ..functions import names as N
from ..functions import remarks as R
from .master import AUDIT_FIELDS, empty_array

PARTY = ["list", "party_id"]
ALIAS = ["list", "party_id", "name"]


def fold_aliases(records: DataFrame) -> DataFrame:
    """Snapshot rows to one row per (list, party, name); rows without list, party or name are skipped."""
    named = records.withColumn("name", N.canonical_display_name(F.col("name"))).filter(
        "coalesce(trim(list), '') <> '' AND coalesce(trim(party_id), '') <> '' AND name <> ''")
    weak = F.coalesce("low_quality", F.lit(False))
    return named.groupBy(*ALIAS).agg(
        F.array_sort(F.collect_set(F.when(F.coalesce("format", F.lit("")) != "", F.col("format")))).alias("formats"),
        F.bool_or(F.coalesce("alias_primary", F.lit(False))).alias("primary"),
        (F.bool_or(weak) & ~F.bool_or(~weak)).alias("low_quality"))


def update_history(history: DataFrame, records: DataFrame, ts: int) -> DataFrame:
    """History after one snapshot.  ``last_changed_ms`` moves only on a real change; ``is_new`` marks inserts."""
    incoming = fold_aliases(records)
    present = incoming.select(*PARTY, F.lit(True).alias("present")).distinct()
    h, i = history.alias("h"), incoming.alias("i")
    j = h.join(i, ALIAS, "full_outer").select(
        *ALIAS, *[F.col(f"h.{c}").alias(f"h_{c}") for c in history.columns if c not in ALIAS],
        *[F.col(f"i.{c}").alias(f"i_{c}") for c in ("formats", "primary", "low_quality")])
    j = j.join(present, PARTY, "left")
    new, seen = F.col("h_first_seen_ms").isNull(), F.col("i_formats").isNotNull()
    party_now = F.coalesce("present", F.lit(False))
    formats = F.when(new, F.col("i_formats")).when(seen, F.array_sort(F.array_union("h_formats", "i_formats"))).otherwise(F.col("h_formats"))
    primary = F.when(seen, F.col("i_primary")).otherwise(F.col("h_primary"))
    weak = F.when(seen, F.col("i_low_quality")).otherwise(F.col("h_low_quality"))
    j = j.withColumns({"formats": formats, "primary": primary, "low_quality": weak})
    changed = new | (F.col("h_party_current") != party_now) | (F.col("h_alias_current") != seen) | (
        F.array_sort("h_formats") != F.col("formats")) | (F.col("h_primary") != F.col("primary")) | (F.col("h_low_quality") != F.col("low_quality"))
    stamp = F.lit(ts).cast("bigint")
    out = N.with_identity_key(j.withColumn("changed", changed), "name", "new_key")
    return out.select(
        *ALIAS, F.coalesce("h_match_key", "new_key").alias("match_key"), F.coalesce("h_first_seen_ms", stamp).alias("first_seen_ms"),
        F.when(F.col("changed"), stamp).otherwise(F.col("h_last_changed_ms")).alias("last_changed_ms"),
        seen.alias("alias_current"), party_now.alias("party_current"), "formats", "primary", "low_quality", new.alias("is_new"))


def party_changes(history: DataFrame, records: DataFrame, baseline: bool | None = None) -> DataFrame:
    """Parties that appeared or vanished.  The first snapshot of an empty history reports none."""
    known = F.lit(not baseline) if baseline is not None else history.select(F.lit(1)).limit(1).agg(F.count(F.lit(1)) > 0).scalar()
    before = history.filter("party_current").select(*PARTY, F.lit(True).alias("was")).distinct()
    now = fold_aliases(records).select(*PARTY, F.lit(True).alias("is")).distinct()
    both = before.join(now, PARTY, "full_outer").filter("was IS NULL OR is IS NULL")
    return both.filter(known).select(*PARTY, F.when(F.col("was").isNull(), "added").otherwise("removed").alias("change"))


def history_totals(history: DataFrame) -> DataFrame:
    """Per list: rows, current parties and aliases, and former aliases of parties that are still listed."""
    gone = ~F.col("alias_current")
    return history.groupBy("list").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(F.when(F.col("party_current"), F.col("party_id"))).alias("n_current_parties"),
        F.count_if("alias_current").alias("n_current_aliases"), F.count_if(gone & F.col("party_current")).alias("n_former_aliases"))


def best_party_names(history: DataFrame) -> DataFrame:
    """Display name per party: primary, then strong, then folded name, then name."""
    named = history.withColumn("name", N.canonical_display_name(F.col("name"))).filter("name <> ''")
    named = named.withColumn("__wide", N.casefold(F.when(~N.is_ascii(F.col("name")), F.col("name"))))
    order = F.struct(~F.col("primary"), F.col("low_quality"), F.coalesce("__wide", F.lower("name")), F.col("name"))
    return named.groupBy(*PARTY).agg(F.min_by("name", order).alias("party_name"))


def key_coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every key that only one of two independent feeds carries, with its side; totals are ``key_totals``."""
    a = left.select(key).distinct().withColumn("in_left", F.lit(True))
    b = right.select(key).distinct().withColumn("in_right", F.lit(True))
    return a.join(b, key, "full_outer").filter("in_left IS NULL OR in_right IS NULL").select(
        F.when(F.col("in_right").isNull(), "left_only").otherwise("right_only").alias("side"), key)


def key_totals(coverage: DataFrame) -> DataFrame:
    """One-sided keys per side."""
    return coverage.groupBy("side").agg(F.count(F.lit(1)).alias("n_keys"))


def category_drift(records: DataFrame, master: DataFrame, source: str = K.SRC_MOF,
                   min_samples: int = 8, threshold: float = 0.5) -> DataFrame:
    """Category codes whose mapped category mostly disagrees with the master (records: match_key, code, category)."""
    own = F.transform(F.filter("categories", lambda c: F.startswith(c, F.lit(source + ":"))),
                      lambda c: F.substring(c, F.lit(len(source) + 2), F.length(c)))
    held = master.select("match_key", own.alias("own")).filter(F.size("own") > 0)
    seen = records.join(held, "match_key")
    agree = (F.col("category") != "") & F.array_contains("own", F.col("category"))
    per_code = seen.groupBy("code").agg(
        F.max("category").alias("category"), F.count_if(agree).alias("n_agree"), F.count(F.lit(1)).alias("n_samples"))
    return per_code.filter((F.col("n_samples") >= min_samples) & (F.col("n_agree") / F.col("n_samples") < threshold))


# --- consequences for the master ---------------------------------------------------------

def _audit(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c).alias(c) for c in AUDIT_FIELDS])


def sync_weak_aliases(master: DataFrame, history: DataFrame, ts: int) -> DataFrame:
    """Annotate inactive rows whose key is now only a weak alias, and clear stale annotations.

    Active rows and rows with an independent invalid reason keep their state.  Adds ``changed`` and ``before``.
    """
    current = history.filter("party_current AND alias_current").filter(N.strip(F.col("match_key")) != "")
    per_key = current.groupBy("match_key").agg(
        F.bool_or(~F.col("low_quality")).alias("strong"),
        F.countDistinct(F.when(F.col("low_quality"), F.struct(*PARTY))).alias("n_weak"))
    weak_only = per_key.filter("NOT strong").select("match_key", "n_weak")
    j = master.join(weak_only, "match_key", "left")
    weak = F.col("n_weak").isNotNull()
    reason, flag = F.col("invalid_reason"), F.col("review_flag")
    annotate = weak & (F.col("status") == K.INACTIVE) & reason.isin(K.REACTIVATABLE)
    stale = ~weak & (reason.isin(K.WEAK_REASONS) | flag.isin(K.WEAK_FLAGS))
    clear = stale & (F.col("status") == K.ACTIVE)
    orphan = stale & ~(F.col("status") == K.ACTIVE) & (F.size("sources") == 0)
    many = F.col("n_weak") > 1
    new_reason = F.when(annotate, F.when(many, K.WEAK_MULTI_REASON).otherwise(K.WEAK_REASON)).when(clear, "").when(orphan, K.DELISTED).otherwise(reason)
    new_flag = F.when(annotate, F.when(many, K.WEAK_MULTI_FLAG).otherwise(K.WEAK_FLAG)).when(
        (clear | orphan) & flag.isin(K.WEAK_FLAGS), "").otherwise(flag)
    j = j.withColumns({"before": _audit(), "new_reason": new_reason, "new_flag": new_flag,
                       "new_status": F.when(orphan, K.INACTIVE).otherwise(F.col("status"))})
    changed = (F.col("new_reason") != reason) | (F.col("new_flag") != flag) | (F.col("new_status") != F.col("status"))
    return j.withColumn("changed", changed).select(
        *[{"status": F.col("new_status"), "invalid_reason": F.col("new_reason"), "review_flag": F.col("new_flag"),
           "last_updated_ms": F.when(F.col("changed"), F.lit(ts).cast("bigint")).otherwise(F.col("last_updated_ms"))}.get(c, F.col(c)).alias(c)
          for c in K.MASTER_COLUMNS], "changed", "before")


REMOVED, CURRENT_STRONG, PROTECTED_STRONG = 1, 2, 4


def removal_flags(history: DataFrame, removed: DataFrame, protected: DataFrame) -> DataFrame:
    """One row per (match_key, list, party_id) with ``flags``: the party is removed, backs the key by a strong alias that is current,
    is protected and backs it by a strong alias.

    All three are one ``bit_or``, so every table derived from this one needs the same columns of the history and the plans share its shuffle.
    """
    flag = lambda df, name: df.select(*PARTY).distinct().withColumn(name, F.lit(True))
    flagged = history.filter(N.strip(F.col("match_key")) != "").join(flag(removed, "removed"), PARTY, "left").join(flag(protected, "shielded"), PARTY, "left")
    strong = ~F.col("low_quality")
    bit = lambda test, value: F.when(test, value).otherwise(0)
    bits = bit(F.col("removed"), REMOVED) + bit(strong & F.col("party_current") & F.col("alias_current"), CURRENT_STRONG) + bit(
        strong & F.col("shielded"), PROTECTED_STRONG)
    return flagged.groupBy("match_key", *PARTY).agg(F.bit_or(bits).alias("flags"))


def _has(flag: int) -> Column:
    return F.col("flags").bitwiseAND(F.lit(flag)) != 0


def removal_parties(flags: DataFrame) -> DataFrame:
    """(match_key, list, party_id) of every name a removed party backed."""
    return flags.filter(_has(REMOVED)).select("match_key", *PARTY)


def removal_effects(master: DataFrame, flags: DataFrame, ts: int, source: str = K.SRC_OFAC) -> DataFrame:
    """What an approved party removal does to each name it backed, with the audited fields before and after.

    ``flags``: ``removal_flags``.  The parties of a key stay in long form (``removal_parties``); this table carries their number.
    """
    keys = flags.groupBy("match_key").agg(
        F.count_if(_has(REMOVED)).alias("n_parties"), F.bool_or(_has(CURRENT_STRONG)).alias("current_strong"),
        F.bool_or(_has(PROTECTED_STRONG)).alias("protected_strong")).filter("n_parties > 0")
    j = keys.join(master, "match_key", "left")
    remaining = F.array_remove("sources", source)
    action = (
        F.when(F.col("display_name").isNull(), "master_row_absent")
        .when(F.col("current_strong"), "kept_current_ofac_party")
        .when(F.col("protected_strong"), "kept_pending_review_party")
        .when(~F.array_contains("sources", source), "ofac_source_absent")
        .when(F.size(remaining) == 0, "deactivated").otherwise("removed_ofac_source"))
    j = j.withColumns({"action": action, "before": _audit()})
    applied = F.col("action").isin("deactivated", "removed_ofac_source")
    cats = F.filter("categories", lambda c: ~F.startswith(c, F.lit(source + ":")))
    new_sources = F.when(applied, remaining).otherwise(F.col("sources"))
    new_cats = F.when(applied, cats).otherwise(F.col("categories"))
    gone = F.col("action") == "deactivated"
    after = F.struct(
        F.when(gone, K.INACTIVE).otherwise(F.col("status")).alias("status"), new_sources.alias("sources"), new_cats.alias("categories"),
        F.when(applied, R.remark_of(remaining, cats)).otherwise(F.col("remark")).alias("remark"),
        F.when(gone, K.DELISTED).otherwise(F.col("invalid_reason")).alias("invalid_reason"), F.col("review_flag").alias("review_flag"))
    return j.select("match_key", F.coalesce("display_name", F.lit("")).alias("display_name"), "n_parties", "action", "before",
                    after.alias("after"), F.when(applied, F.lit(ts).cast("bigint")).alias("updated_ms"))


def effect_audit(approvals: DataFrame, effects: DataFrame, parties: DataFrame) -> DataFrame:
    """One row per approval and effect that names its party, with the canonical effect JSON and the approval's effect count.

    ``parties`` is the long party table of the effects.  A party of any size stays spread over rows.
    """
    before, after = ["before", "after"]
    text = F.to_json(F.struct("action", F.col(after), F.col(before), "display_name", "match_key"), {"ignoreNullFields": "false"})
    rows = effects.select("match_key", "action", text.alias("effect_json"))
    named = approvals.join(parties, PARTY, "left").join(rows, "match_key", "left")
    per_party = parties.groupBy(*PARTY).agg(F.count(F.lit(1)).alias("n_keys"))
    per_approval = approvals.groupBy(*PARTY, "snapshot_sha256").agg(F.count(F.lit(1)).alias("n_rows"))
    counts = per_approval.join(per_party, PARTY).select(*PARTY, "snapshot_sha256", (F.col("n_rows") * F.col("n_keys")).alias("effect_count"))
    return named.join(counts, [*PARTY, "snapshot_sha256"], "left").select(
        *PARTY, "snapshot_sha256", "party_name", F.coalesce("effect_count", F.lit(0)).alias("effect_count"),
        F.coalesce("match_key", F.lit("")).alias("match_key"), F.coalesce("action", F.lit("")).alias("action"),
        F.coalesce("effect_json", F.lit("")).alias("effect_json"))
