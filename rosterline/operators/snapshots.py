"""Snapshot comparison: record pairing, field diffs, impact classes, review cases, generation catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import constants as K
from ..functions import names as N
from ..functions.rows import explode_once
from .sequences import numbered

ID = "番号"
REFERENCE = "国連参照番号"
CELL_GAP = "\u0001"


def clean_cell(c: Column) -> Column:
    """CSV cell without line-break noise: NUL dropped, every line stripped."""
    s = F.translate(F.coalesce(c, F.lit("")), "\u0000", "")
    s = F.regexp_replace(s, r"\r\n?", "\n")
    return N.strip(F.regexp_replace(s, r"[ \t\u3000]*\n[ \t\u3000]*", "\n"))


def _field_in(names: list[str]) -> Column:
    return F.expr("field IN (" + ", ".join(f"'{n}'" for n in names) + ")")


def list_fields(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c in K.LIST_COLUMNS]


def _named(c: Column) -> Column:
    return F.when(c.isin(K.NULLISH), "").otherwise(c)


def _digests(id_: Column, *names: str) -> list[Column]:
    """128 bits of an id, as two numbers that can be added without carry (XOR); NULL for a NULL id, which equals nothing."""
    parts = (F.xxhash64(id_), F.xxhash64(F.reverse(id_), F.lit(1)))
    return [F.when(id_.isNotNull(), p).alias(n) for p, n in zip(parts, names)]


_SUMS = ["n_b", "n_a", "b1", "b2", "a1", "a2"]


def renumbered(before: DataFrame, after: DataFrame) -> DataFrame:
    """(via, b1, b2, a1, a2): the digests of the ids of records that changed their id but kept a unique reference number, or else
    unique primary names, among the records whose id is on one side only.

    One narrow pass, without joining counts back to rows: every candidate key is reduced to the number of its rows and the XOR of
    their id digests per side, so a key that one row holds on each side *is* its pair.  For the second pass, the rows that the first
    one took are subtracted from the sums of their names.  All steps are partial sums, so a key of very many rows is no burden.
    """
    fields = list_fields(before)

    def keys(df: DataFrame, side: str) -> DataFrame:
        ja, en = [_named(F.col(f"`{c}`")) if c in fields else F.lit("") for c in K.PRIMARY_NAME]
        names = F.when((ja != "") | (en != ""), F.concat_ws("\u241f", ja, en)).otherwise("")
        reference = F.coalesce(_named(F.col(f"`{REFERENCE}`")), F.lit(""))
        return df.select(F.col(f"`{ID}`").alias("id"), F.lit(side == "b").alias("is_b"), reference.alias("reference"), F.coalesce(names, F.lit("")).alias("names"))

    rows = keys(before, "b").unionByName(keys(after, "a")).filter("id IS NOT NULL")
    one = rows.groupBy("id").agg(
        F.count_if("is_b").alias("n_b"), F.count_if(~F.col("is_b")).alias("n_a"), F.max("reference").alias("reference"), F.max("names").alias("names"))
    left = one.filter("n_b = 0 OR n_a = 0")
    left = left.select("reference", "names", "n_b", "n_a", *_digests(F.col("id"), "d1", "d2"))
    left = left.select("reference", "names", "n_b", "n_a", *[
        F.when(F.col(f"n_{side}") > 0, F.col(f"d{i}")).otherwise(F.lit(0).cast("long")).alias(f"{side}{i}") for side in "ba" for i in (1, 2)])

    def key(kind: str, c: str) -> Column:
        return F.when(F.col(c) != "", F.struct(F.lit(kind).alias("kind"), F.col(c).alias("text")))

    keyed = left.select(F.explode(F.array_compact(F.array(key("REFERENCE", "reference"), key("NAME", "names")))).alias("key"), "names", *_SUMS)
    total = [F.sum(c).alias(c) if c.startswith("n_") else F.bit_xor(c).alias(c) for c in _SUMS]
    of = lambda side: F.max(F.when(F.col(f"n_{side}") > 0, F.col("names"))).alias(f"names_{side}")
    counted = keyed.groupBy("key").agg(*total, of("b"), of("a"))
    pair = (F.col("n_b") == 1) & (F.col("n_a") == 1)
    zero = F.lit(0).cast("long")
    entry = lambda kind, text, **given: F.struct(
        F.struct(F.lit(kind).alias("kind"), text.alias("text")).alias("key"), *[given.get(c, zero).cast("long").alias(c) for c in _SUMS])
    every = {c: F.col(c) for c in _SUMS}
    taken = {s: {f"n_{s}": F.lit(-1), f"{s}1": F.col(f"{s}1"), f"{s}2": F.col(f"{s}2")} for s in "ba"}
    after_reference = F.when(pair, F.array(
        entry("REFERENCE", F.col("key.text"), **every), entry("NAME", F.col("names_b"), **taken["b"]), entry("NAME", F.col("names_a"), **taken["a"])))
    entries = F.when(F.col("key.kind") == "NAME", F.array(entry("NAME", F.col("key.text"), **every))).otherwise(after_reference)
    rest = counted.select(F.explode(entries).alias("e")).select("e.*").groupBy("key").agg(*total)
    return rest.filter(pair & (F.col("key.text") != "")).select(F.col("key.kind").alias("via"), "b1", "b2", "a1", "a2")


def pair_records(before: DataFrame, after: DataFrame) -> DataFrame:
    """Pairs of two snapshots: by id, then by unique reference number, then by unique primary names.

    Output: ``via`` (ID / REFERENCE / NAME / REMOVED / ADDED) and the wide rows ``b`` and ``a``.  The
    passes work on ids and keys of the leftovers only; the result renames renumbered ids, so the
    wide rows meet in a single full outer join.
    """
    fields = list_fields(before)
    own = F.col(f"`{ID}`")
    b = before.select(*_digests(own, "k1", "k2"), F.struct(*[F.col(f"`{c}`") for c in fields]).alias("b"))
    a = after.select(*_digests(own, "a1", "a2"), F.struct(*[F.col(f"`{c}`") for c in fields]).alias("a"))
    a = a.join(renumbered(before, after), ["a1", "a2"], "left").select(
        F.coalesce("b1", "a1").alias("k1"), F.coalesce("b2", "a2").alias("k2"), "a", F.col("via").alias("renamed_via"))
    via = F.when(F.col("a").isNull(), "REMOVED").when(F.col("b").isNull(), "ADDED").otherwise(F.coalesce("renamed_via", F.lit("ID")))
    return b.join(a, ["k1", "k2"], "full_outer").select("b", "a", via.alias("via"))


def _fields_of(pairs: DataFrame) -> list[str]:
    return pairs.schema["b"].dataType.fieldNames()


def _display_name(row: str, fields: list[str]) -> Column:
    options = []
    for c in K.NAME_COLUMNS[:6]:
        if c in fields:
            v = F.col(f"{row}.`{c}`")
            shown = v if c in K.PRIMARY_NAME else N.strip(F.element_at(F.split(v, "[；;]"), 1))
            options.append(F.when(~v.isin(K.NULLISH), shown))
    rid = F.col(f"{row}.`{ID}`")
    return F.coalesce(*options, F.when(rid != "", F.concat(F.lit("番号 "), rid)), F.lit("（名称不明）"))


def _cells(row: str, fields: list[str]) -> Column:
    # one SQL text instead of dozens of column objects: the plan is the same, building it is not
    return F.expr("array(" + ", ".join(f"named_struct('f', '{c}', 'v', {row}.`{c}`)" for c in fields) + ")")


def field_changes(pairs: DataFrame, unpaired: bool = False) -> DataFrame:
    """Long field diff of paired records; with ``unpaired`` also one row, without field, for each record of one side (``via`` tells which).

    The rows are already side by side, so the 32 columns are compared in place and only changed cells
    are exploded; nothing is unpivoted or joined again.  ``others`` holds the other cells of the row
    in which moved information would still be found; it is set only where that question arises.
    """
    fields = _fields_of(pairs)
    both = "b IS NOT NULL AND a IS NOT NULL"
    matched = pairs if unpaired else pairs.filter(both)
    cells = F.expr("array(" + ", ".join(
        f"named_struct('pos', {i}, 'field', '{c}', 'before', b.`{c}`, 'after', a.`{c}`)" for i, c in enumerate(fields)) + ")")
    reference = F.when(F.col(f"a.`{REFERENCE}`") != "", F.col(f"a.`{REFERENCE}`")).otherwise(F.col(f"b.`{REFERENCE}`"))
    after_name = _display_name("a", fields)
    changed = F.filter(cells, lambda c: ~c["before"].eqNullSafe(c["after"]))
    if unpaired:
        none = F.expr("array(named_struct('pos', 0, 'field', CAST(NULL AS STRING), 'before', '', 'after', ''))")
        changed = F.when(F.expr(both), changed).otherwise(none)
    wide = matched.select(
        F.col(f"b.`{ID}`").alias("before_id"), F.col(f"a.`{ID}`").alias("after_id"), reference.alias("un_reference"),
        F.when(after_name != "（名称不明）", after_name).otherwise(_display_name("b", fields)).alias("name"),
        changed.alias("changed"), "b", "a", "via")
    long = explode_once(wide, ["before_id", "after_id", "un_reference", "name", "b", "a", "via"], F.col("changed"), "c")
    appeared, vanished = F.col("c.before") == "", F.col("c.after") == ""

    def others(row: str) -> Column:
        rest = F.filter(_cells(row, fields), lambda x: x["f"] != F.col("c.field"))
        return F.array_join(F.transform(rest, lambda x: x["v"]), CELL_GAP)

    echo = F.col("c.field").isin(K.ECHO_FIELDS)
    passport = (F.col("c.field") == "旅券番号") & ~appeared & ~vanished
    return long.select(
        "before_id", "after_id", "un_reference", "name", F.col("c.pos").alias("pos"), F.col("c.field").alias("field"),
        F.col("c.before").alias("before"), F.col("c.after").alias("after"),
        F.when(echo & appeared, others("b")).when((echo & vanished) | passport, others("a")).otherwise("").alias("others"),
        *([F.col("via")] if unpaired else []))


def _folded(df: DataFrame, columns: dict[str, str], udf) -> DataFrame:
    """NFKC forms of columns (out: column) in one Python stage; ASCII text is unchanged by NFKC and never reaches Python."""
    wide = {f"__{out}": udf(F.when(~N.is_ascii(F.col(column)), F.col(column))) for out, column in columns.items()}
    plain = lambda c: F.col(c) if udf is N.nfkc else F.lower(c)
    df = df.withColumns(wide)
    return df.withColumns({out: F.coalesce(f"__{out}", plain(column)) for out, column in columns.items()}).drop(*wide)


def with_forms(changes: DataFrame) -> DataFrame:
    """Every form of the cells that later steps compare, in one Python stage (each further one would hold a worker for each task):
    NFKC (__plain_*) and NFKC with full case folding (*_fold).  Folding a cell's NFKC form gives its *_fold."""
    forms = {f"__plain_{c}": (c, N.nfkc) for c in ("before", "after")} | {f"{c}_fold": (c, N.nfkc_casefold) for c in ("before", "after", "others")}
    df = changes.withColumns({f"__wide_{out}": udf(F.when(~N.is_ascii(F.col(c)), F.col(c))) for out, (c, udf) in forms.items()})
    plain = lambda c, udf: F.col(c) if udf is N.nfkc else F.lower(c)
    return df.withColumns({out: F.coalesce(f"__wide_{out}", plain(c, udf)) for out, (c, udf) in forms.items()}).drop(*[f"__wide_{out}" for out in forms])


def _evidence(c: Column, keep: str = "") -> Column:
    s = F.regexp_replace(c, r"(?U)[\u200b-\u200d\ufeff\s]+", "")
    return F.regexp_replace(s, rf"[^0-9a-z_\u0080-\uffff{keep}]+", "")


# Fixed value: identifiers are ASCII letters and digits mixed, at least four characters.
ID_TOKEN = r"(?<![a-z0-9])(?=[a-z0-9.-]*[a-z])(?=[a-z0-9.-]*[0-9])[a-z][a-z0-9.-]{3,}(?![a-z0-9])"


def _id_tokens(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(ID_TOKEN), F.lit(0))))


def moved_information(changes: DataFrame) -> DataFrame:
    """Flag changes whose value only moved to or from another column of the record."""
    return _moved(_folded(changes, {f"{column}_fold": column for column in ("before", "after", "others")}, N.nfkc_casefold)).drop("before_fold", "after_fold")


def _moved(df: DataFrame) -> DataFrame:
    appeared, vanished = F.col("before") == "", F.col("after") == ""
    token = _evidence(F.when(appeared, F.col("after_fold")).otherwise(F.col("before_fold")))
    elsewhere = (F.length(token) >= 2) & F.contains(_evidence(F.col("others_fold"), keep=CELL_GAP), token)

    ids = _id_tokens(F.col("before_fold"))
    before_token, after_token = _evidence(F.col("before_fold")), _evidence(F.col("after_fold"))
    dropped = F.filter(F.array(*[F.lit(m) for m in K.DOCUMENT_MARKERS]),
                       lambda m: F.contains(F.col("before_fold"), m) & ~F.contains(F.col("after_fold"), m))
    kept_cell = F.exists(F.split("others_fold", CELL_GAP), lambda cell: (
        F.size(F.array_except(ids, _id_tokens(cell))) == 0) & F.exists(dropped, lambda m: F.contains(cell, m)))
    detail = (
        (F.col("field") == "旅券番号") & (F.size(ids) > 0) & (ids == _id_tokens(F.col("after_fold")))
        & (after_token != "") & (F.length(after_token) < F.length(before_token)) & (F.size(dropped) > 0) & kept_cell)
    moved = F.when(~_field_in(K.ECHO_FIELDS), False).when(appeared | vanished, elsewhere).otherwise(detail)
    return df.withColumn("moved", moved).drop("others_fold", "others")


def _with_semantic(df: DataFrame, sides: tuple[str, ...] = ("before", "after")) -> DataFrame:
    """Comparable value of each side's cell in ``<side>_sem``: NFKC, blanks, separators, then the rules of its field class (``with_forms``)."""
    df = df.withColumns({f"__low_{side}": F.when(_field_in(K.CASELESS_FIELDS), F.col(f"{side}_fold")) for side in sides})

    def comparable(v: Column) -> Column:
        place = F.regexp_replace(F.regexp_replace(v, "[,，]+", " "), r"[ \t]+", " ")
        by_class = (
            F.when(_field_in(K.DATE_FIELDS), F.regexp_replace(v, r"(?<![0-9])0+(?=[0-9])", ""))
            .when(_field_in(K.LOCATION_FIELDS), place)
            .when(_field_in(K.SUPPLEMENT_FIELDS), F.regexp_replace(v, r"(?U)\s+", "")).otherwise(v))
        return by_class

    spaced = lambda side: F.regexp_replace(F.coalesce(f"__low_{side}", f"__plain_{side}"), r"[ \t\u00a0]+", " ")
    df = df.withColumns({f"{side}_sem": F.regexp_replace(spaced(side), r"(?U)\s*([;,:])\s*", "$1") for side in sides})
    df = df.withColumns({f"{side}_sem": comparable(F.col(f"{side}_sem")) for side in sides})
    df = df.withColumns({f"{side}_sem": N.strip(F.regexp_replace(F.col(f"{side}_sem"), r"(?U)[^\S\n]*\n[^\S\n]*", "\n")) for side in sides})
    return df.drop(*[f"__{kind}_{side}" for kind in ("plain", "low") for side in sides])


def classify_impact(changes: DataFrame) -> DataFrame:
    """Impact class, material flag and kind label of every field change; the first rule that fits wins.  The folded cells stay, for ``review_cases``."""
    df = _moved(with_forms(changes))
    df = _with_semantic(df)
    field = F.col("field")
    impact = (
        F.when(_field_in(K.AGGREGATE_FIELDS), K.IMPACT_AGGREGATE)
        .when(F.col("moved"), K.IMPACT_MOVED)
        .when(F.col("before_sem") == F.col("after_sem"), K.IMPACT_COSMETIC)
        .when(_field_in(K.ADMIN_FIELDS), K.IMPACT_ADMIN)
        .when(_field_in(K.SUPPLEMENT_FIELDS), K.IMPACT_SUPPLEMENT)
        .otherwise(K.IMPACT_IDENTITY)
    )
    prefix = F.when(_field_in(K.ADMIN_FIELDS), "管理情報改訂").when(
        _field_in(K.SUPPLEMENT_FIELDS), "補足情報改訂").otherwise("情報改訂")
    df = df.withColumn("impact", impact).drop("before_sem", "after_sem")
    return df.withColumns({
        "material": ~F.col("impact").isin(K.IMPACT_COSMETIC, K.IMPACT_AGGREGATE, K.IMPACT_MOVED),
        "kind": F.concat(prefix, F.lit("（"), field, F.lit("）")),
    })


def diff_summary(classified: DataFrame) -> DataFrame:
    """One row of counts for a transition: records added, removed, amended; field changes per impact.

    ``classified``: the field changes of all pairs, records of one side included (``unpaired``).  Changes are folded per record first, so
    the distinct record counts need no distinct aggregate, and the pairs are read once.
    """
    record = F.when(F.col("after_id") != "", F.col("after_id")).otherwise(F.col("before_id"))
    changed = F.col("field").isNotNull()
    tests = {
        "field_changes": F.col("material"), "raw_field_changes": F.lit(True), "cosmetic_changes": F.col("impact") == K.IMPACT_COSMETIC,
        "aggregate_changes": F.col("impact") == K.IMPACT_AGGREGATE, "structure_changes": F.col("impact") == K.IMPACT_MOVED,
    }
    alone = {"added": "ADDED", "removed": "REMOVED"}
    folded = classified.groupBy(record.alias("record"), changed.alias("changed")).agg(
        *[F.count_if(changed & test).alias(c) for c, test in tests.items()], *[F.count_if(~changed & (F.col("via") == v)).alias(c) for c, v in alone.items()])
    return folded.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in alone], F.count_if(F.col("changed") & (F.col("field_changes") > 0)).alias("amended"),
        F.count_if("changed").alias("raw_amended"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in tests])


# --- review cases ------------------------------------------------------------------------

def _alias_set(c: Column) -> Column:
    parts = F.transform(F.split(c, "[;；]"), N.strip)
    return F.when(N.strip(c).isin("", "-", "—", "―"), F.array().cast("array<string>")).otherwise(F.filter(parts, lambda p: p != ""))


def review_cases(changes: DataFrame) -> DataFrame:
    """Re-review case per (snapshot, record) whose names, ids, birth, place, nationality or address changed.

    ``changes``: after_raw, record_id, detected_at, name, un_reference, pos, field, before, after, impact; before_fold and after_fold where known.
    A group holds at most the columns of the list, so gathering it is bounded.
    """
    alias_only = lambda column: F.when(F.col("field").isin(K.STRONG_ALIAS + K.WEAK_ALIAS), F.col(column)).otherwise("")
    if {"before_fold", "after_fold"} <= set(changes.columns):
        df = changes.withColumns({f"{column}_fold": alias_only(f"{column}_fold") for column in ("before", "after")})
    else:
        df = changes.withColumns({f"__alias_{column}": alias_only(column) for column in ("before", "after")})
        df = _folded(df, {f"{column}_fold": f"__alias_{column}" for column in ("before", "after")}, N.nfkc_casefold)
    row = F.struct("pos", "field", "before", "after", "impact", "before_fold", "after_fold")
    grouped = df.groupBy("after_raw", "record_id").agg(
        F.min_by(F.struct("detected_at", "name", "un_reference"), "pos").alias("head"),
        F.array_sort(F.collect_list(row)).alias("rows"))
    screening = F.filter("rows", lambda r: r["impact"] == K.IMPACT_IDENTITY)
    grouped = grouped.withColumn("triggers", F.filter(screening, lambda r: r["field"].isin(K.HIGH_TRIGGERS + K.MEDIUM_TRIGGERS)))
    grouped = grouped.filter(F.size("triggers") > 0)
    names = F.transform("triggers", lambda r: r["field"])

    def touches(fields: list[str]) -> Column:
        return F.arrays_overlap(names, F.array(*[F.lit(f) for f in fields]))

    def change(field: str, side: str) -> Column:
        picked = F.filter("rows", lambda r: r["field"] == field)
        return _alias_set(F.get(F.transform(picked, lambda r: r[side]), F.lit(0)))

    def promoted(strong: str, weak: str) -> Column:
        gained = F.array_except(change(strong, "after_fold"), change(strong, "before_fold"))
        lost = F.array_except(change(weak, "before_fold"), change(weak, "after_fold"))
        return F.coalesce(F.size(F.array_intersect(gained, lost)) > 0, F.lit(False))

    promotion = promoted(K.STRONG_ALIAS[0], K.WEAK_ALIAS[0]) | promoted(K.STRONG_ALIAS[1], K.WEAK_ALIAS[1])
    labels = F.array(
        F.when(promotion, "Weak Alias→Strong Alias昇格").when(touches(K.STRONG_ALIAS), "強い別名変更"),
        F.when(touches(K.PRIMARY_NAME), "主名称変更"), F.when(touches(K.FORMER_NAME), "旧称変更"),
        F.when(touches(["旅券番号"]), "旅券番号変更"), F.when(touches(["身分証番号"]), "身分証番号変更"),
        F.when(touches(["生年月日"]), "生年月日変更"), F.when(touches(K.BIRTH_PLACE), "出生地変更"),
        F.when(touches(K.NATIONALITY), "国籍変更"), F.when(touches(K.ADDRESS), "住所変更"))
    reasons = F.array_join(labels, " / ")
    context = F.when(touches(K.STRONG_ALIAS), F.concat("triggers", F.filter(screening, lambda r: r["field"].isin(K.WEAK_ALIAS)))).otherwise(F.col("triggers"))
    dash = lambda c: F.when(c == "", "—").otherwise(c)
    detail = F.array_join(F.transform(context, lambda r: F.concat(
        r["field"], F.lit(": "), dash(r["before"]), F.lit(" → "), dash(r["after"]))), "\n")
    date = F.regexp_extract("after_raw", r"shisantouketsu(\d{8})", 1)
    digest = F.left(F.sha2(F.concat_ws("|", "after_raw", "record_id"), 256), F.lit(8))
    return grouped.select(
        F.concat_ws("-", F.lit("MOF"), F.when(date == "", "UNKNOWN").otherwise(date), "record_id", digest).alias("case_id"),
        F.col("head.detected_at").alias("detected_at"),
        F.when(F.col("head.name") == "", F.concat(F.lit("番号 "), "record_id")).otherwise(F.col("head.name")).alias("name"),
        "record_id", F.col("head.un_reference").alias("un_reference"),
        F.when(touches(K.HIGH_TRIGGERS), "高").otherwise("中").alias("priority"),
        F.when(reasons == "", "スクリーニング識別情報変更").otherwise(reasons).alias("reasons"),
        F.array_join(F.transform(context, lambda r: r["field"]), " / ").alias("fields"), detail.alias("detail"),
        F.col("after_raw").alias("source_document"))


def append_cases(queue: DataFrame, cases: DataFrame) -> DataFrame:
    """Whole case queue with unseen cases in front.

    ``queue`` carries ``position``; new cases keep their (source_document, record_id) order.  Positions are numbered by
    buckets of old positions and of record id heads.
    """
    fresh = cases.join(queue.select("case_id"), "case_id", "left_anti")
    cols = ["case_id", "record_id", "source_document"]
    top = fresh.select(*cols, F.lit(0).alias("block"), F.lit(0).cast("bigint").alias("old_position")).unionByName(
        queue.select(*cols, F.lit(1).alias("block"), F.col("position").cast("bigint").alias("old_position")))
    order = ["block", "old_position", "source_document", "record_id"]
    heads = [F.col("block"), F.floor(F.col("old_position") / 4096), F.when(F.col("block") == 0, F.col("source_document")),
             F.when(F.col("block") == 0, F.substring("record_id", 1, 4))]
    return numbered(top, heads, order, "position").select(*cols, "position")


# --- keyed record diff -------------------------------------------------------------------

def diff_keyed_records(old: DataFrame, new: DataFrame) -> DataFrame:
    """Added / removed / changed records (record_no, country, company, aliases, wmd, conventional_weapons) by identity key.

    Comparison ignores blanks and case; the highest record number stands for a repeated key.
    """
    attrs = ["record_no", "country", "company", "aliases", "wmd", "conventional_weapons"]

    def side(df: DataFrame, name: str) -> DataFrame:
        keyed = N.with_identity_key(df.select(*attrs), "company")
        text = F.concat_ws(CELL_GAP, "country", "wmd", "conventional_weapons", F.concat_ws("\u0002", "aliases"))
        keyed = _folded(keyed.withColumn("__text", text), {"__fold": "__text"}, N.casefold)
        squeeze = F.regexp_replace("__fold", r"(?U)\s+", " ")
        parts = F.transform(F.split(squeeze, CELL_GAP), N.strip)
        aliases = F.transform(F.split(F.get(parts, F.lit(3)), "\u0002"), N.strip)
        aliases = F.array_sort(F.filter(aliases, lambda a: a != ""))
        keyed = keyed.withColumn("same", F.struct(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), aliases))
        return keyed.groupBy("match_key").agg(F.max_by(F.struct(*attrs, "same"), "record_no").alias(name))

    both = side(old, "o").join(side(new, "n"), "match_key", "full_outer")
    action = F.when(F.col("o").isNull(), "追加").when(F.col("n").isNull(), "削除").when(
        ~F.col("o.same").eqNullSafe(F.col("n.same")), "変更")
    shown = [F.col(f"{s}.{c}").alias(f"{p}_{c}") for s, p in (("o", "old"), ("n", "new")) for c in ("record_no", "company", "country")]
    joined = [F.array_join(F.col(f"{s}.aliases"), " | ").alias(f"{p}_aliases") for s, p in (("o", "old"), ("n", "new"))]
    return both.withColumn("action", action).filter("action IS NOT NULL").select("action", "match_key", *shown, *joined)


# --- generations -------------------------------------------------------------------------

STAMP = r"^(\d{8}T\d{6}Z)__"


def generations(files: DataFrame) -> DataFrame:
    """Stored files (source, file_name, bytes, n_rows) grouped by time stamp; other and hidden files are ignored."""
    stamped = files.withColumn("stamp", F.regexp_extract("file_name", STAMP, 1)).filter("stamp <> ''")
    return stamped.groupBy("source", "stamp").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows"), F.min("file_name").alias("file_name"))


def plan_transitions(gens: DataFrame, processed: DataFrame) -> DataFrame:
    """Adjacent generation pairs still to compare, per source.

    ``processed``: source, stamp.  Without one only the newest pair is planned.  ``violation`` marks a
    source whose processed generation is gone or whose stamp holds several files.  Windows run over
    one row per stored generation of a source.
    """
    w = W.partitionBy("source").orderBy("stamp")
    steps = gens.withColumns({
        "next_stamp": F.lead("stamp").over(w),
        "newest": F.max("stamp").over(W.partitionBy("source")),
    })
    steps = steps.join(processed.withColumnRenamed("stamp", "done"), "source", "left")
    known = F.max((F.col("stamp") == F.col("done")).cast("int")).over(W.partitionBy("source")) == 1
    steps = steps.withColumn("known", F.coalesce(known, F.lit(False)))
    todo = F.col("next_stamp").isNotNull() & F.when(
        F.col("done").isNull(), F.col("next_stamp") == F.col("newest")).otherwise(F.col("known") & (F.col("stamp") >= F.col("done")))
    lost = F.col("done").isNotNull() & ~F.col("known")
    violation = F.when(F.col("n_files") > 1, "SEVERAL_FILES_PER_STAMP").when(lost & (F.col("stamp") == F.col("newest")), "PROCESSED_GENERATION_LOST")
    return steps.withColumn("violation", violation).filter(todo | F.col("violation").isNotNull()).select(
        "source", F.col("stamp").alias("before_stamp"), F.when(todo, F.col("next_stamp")).alias("after_stamp"), "violation")


def retention(gens: DataFrame, keep: int = 30, max_bytes: int = 16 * 1024 * 1024) -> DataFrame:
    """Keep / drop verdict per generation, newest first: whole generations only, and never the newest."""
    w = W.partitionBy("source").orderBy(F.col("stamp").desc())
    ranked = gens.withColumns({
        "age": F.row_number().over(w) - 1,
        "running": F.sum("bytes").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)),
    })
    over = (F.col("age") >= keep) | ((F.col("running") > max_bytes) & (F.col("age") > 0))
    first_over = F.min(F.when(over, F.col("age"))).over(W.partitionBy("source"))
    return ranked.withColumn("cut", first_over).select(
        "source", "stamp", "n_files", "bytes", F.col("age").cast("bigint").alias("age"),
        F.when(F.col("cut").isNotNull() & (F.col("age") >= F.col("cut")), "drop").otherwise("keep").alias("verdict"))


def volume_drops(gens: DataFrame, floor: float = 0.8) -> DataFrame:
    """Generations with fewer rows than ``floor`` of their predecessor."""
    previous = F.lag("n_rows").over(W.partitionBy("source").orderBy("stamp"))
    return gens.withColumn("previous_rows", previous).filter(
        (F.col("previous_rows") > 0) & (F.col("n_rows") < F.col("previous_rows") * floor)).select("source", "stamp", "previous_rows", "n_rows")
