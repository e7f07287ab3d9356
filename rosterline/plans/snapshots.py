"""Snapshot queries: pairing, diffs, impact, review cases, generations."""

from pyspark.sql import functions as F

from ..operators import snapshots as S
from .fixtures import view
from .registry import query

COLUMNS = ["区分", "番号", "告示番号", "氏名（日本語）", "氏名（英語）", "別名・別称（英語）", "確定に十分でない別名（英語）",
           "生年月日", "出生地（英語）", "国籍（英語）", "旅券番号", "住所・所在地（都市その他の情報）（英語）", "国連参照番号",
           "その他の情報", "外務省告示情報"]
RAW = "shisantouketsu20260905.csv"


def _snapshot(d, values: list[str], source: str) -> str:
    return "SELECT " + ", ".join(f"{v} AS {d.q(c)}" for v, c in zip(values, COLUMNS)) + f" FROM {source}"


def _n(width: int = 9) -> str:
    return f"lpad(CAST(c_custkey AS STRING), {width}, '0')"


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


K = "c_custkey"
REF = f"CASE WHEN {K} % 116 = 0 THEN 'QDi.DUP' WHEN {K} % 31 = 0 THEN '-' ELSE 'QDi.' || {_s(K)} END"


@view("snap_before")
def _(d):
    """Earlier list snapshot: one record per customer."""
    return _snapshot(d, [
        _s(f"{K} % 7"), _s(K), f"'N' || {_s(K + ' % 50')}", "''",
        f"CASE WHEN {K} % 174 = 0 THEN 'SHARED NAME' ELSE 'Customer ' || {_n()} END",
        f"'Alias A' || {_s(K)}", f"'Weak B' || {_s(K)} || '; Weak C' || {_s(K)}",
        f"'1960年0' || {_s(f'1 + {K} % 9')} || '月07日'", f"'City ' || {_s(K + ' % 50')} || ', Region'",
        f"CASE WHEN {K} % 13 = 5 THEN '' ELSE 'Nation ' || {_s('c_nationkey')} END",
        f"'AB' || {_n(7)} || CASE WHEN {K} % 13 = 0 THEN ' (expires 2029)' ELSE '' END",
        f"'Street ' || {_s(K)}", REF,
        f"CASE WHEN {K} % 13 = 5 THEN 'Nationality: Nation ' || {_s('c_nationkey')} || ' noted' ELSE 'Note ' || {_s(K)} END",
        f"'Notice ' || {_s(K)}"], d.t("customer"))


@view("snap_after")
def _(d):
    """Later snapshot: records dropped, renumbered, reworded, promoted, moved between columns, and added."""
    after = _snapshot(d, [
        _s(f"{K} % 7"), f"CASE WHEN {K} % 29 = 0 THEN {_s(K + ' + 100000000')} ELSE {_s(K)} END",
        f"'N' || {_s(K + ' % 50')} || CASE WHEN {K} % 37 = 1 THEN 'b' ELSE '' END", "''",
        f"CASE WHEN {K} % 174 = 0 THEN 'SHARED NAME' WHEN {K} % 11 = 0 THEN 'CUSTOMER  ' || {_n()} ELSE 'Customer ' || {_n()} END",
        f"'Alias A' || {_s(K)} || CASE WHEN {K} % 19 = 0 THEN '; Weak B' || {_s(K)} ELSE '' END",
        f"CASE WHEN {K} % 19 = 0 THEN 'Weak C' || {_s(K)} ELSE 'Weak B' || {_s(K)} || '; Weak C' || {_s(K)} END",
        f"CASE WHEN {K} % 23 = 0 THEN '1960年' || {_s(f'1 + {K} % 9')} || '月7日' ELSE '1960年0' || {_s(f'1 + {K} % 9')} || '月07日' END",
        f"'City ' || {_s(K + ' % 50')} || CASE WHEN {K} % 9 = 2 THEN ' Region' ELSE ', Region' END",
        f"'Nation ' || CASE WHEN {K} % 7 = 3 AND {K} % 13 <> 5 THEN {_s('c_nationkey + 100')} ELSE {_s('c_nationkey')} END",
        f"'AB' || {_n(7)}", f"'Street ' || {_s(K)}", REF,
        f"CASE WHEN {K} % 13 = 5 THEN 'Nationality: Nation ' || {_s('c_nationkey')} || ' noted' ELSE 'Note ' || {_s(K)} END"
        f" || CASE WHEN {K} % 26 = 0 THEN ' passport AB' || {_n(7)} || ' expires 2029' WHEN {K} % 41 = 2 THEN ' revised' ELSE '' END",
        f"'Notice ' || {_s(K)} || CASE WHEN {K} % 7 = 3 THEN ' v2' ELSE '' END"], d.t("customer")) + f" WHERE {K} % 17 <> 0"
    new = _snapshot(d, [
        "'1'", _s("s_suppkey + 200000000"), "'N'", "''", f"'Supplier ' || {_s('s_suppkey')}", "''", "''", "''", "''",
        f"'Nation ' || {_s('s_nationkey')}", "''", "''", "''", "''", "''"], d.t("supplier"))
    return after + " UNION ALL " + new


def _q(c: str) -> str:
    return f'"{c}"'


PAIRS = f"""
b AS (SELECT * FROM snap_before), a AS (SELECT * FROM snap_after),
p1 AS (SELECT b."番号" AS bid, b."番号" AS aid, 'ID' AS via FROM b JOIN a ON a."番号" = b."番号"),
lb AS (SELECT * FROM b WHERE "番号" NOT IN (SELECT bid FROM p1)), la AS (SELECT * FROM a WHERE "番号" NOT IN (SELECT aid FROM p1)),
rb AS (SELECT "国連参照番号" AS k, min("番号") AS id FROM lb WHERE "国連参照番号" NOT IN ('', '-') GROUP BY 1 HAVING count(*) = 1),
ra AS (SELECT "国連参照番号" AS k, min("番号") AS id FROM la WHERE "国連参照番号" NOT IN ('', '-') GROUP BY 1 HAVING count(*) = 1),
p2 AS (SELECT rb.id AS bid, ra.id AS aid, 'REFERENCE' AS via FROM rb JOIN ra USING (k)),
lb2 AS (SELECT * FROM lb WHERE "番号" NOT IN (SELECT bid FROM p2)), la2 AS (SELECT * FROM la WHERE "番号" NOT IN (SELECT aid FROM p2)),
nb AS (SELECT "氏名（英語）" AS k, min("番号") AS id FROM lb2 WHERE "氏名（英語）" <> '' GROUP BY 1 HAVING count(*) = 1),
na AS (SELECT "氏名（英語）" AS k, min("番号") AS id FROM la2 WHERE "氏名（英語）" <> '' GROUP BY 1 HAVING count(*) = 1),
p3 AS (SELECT nb.id AS bid, na.id AS aid, 'NAME' AS via FROM nb JOIN na USING (k)),
matched AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3),
paired AS (SELECT * FROM matched
  UNION ALL SELECT "番号", '', 'REMOVED' FROM b WHERE "番号" NOT IN (SELECT bid FROM matched)
  UNION ALL SELECT '', "番号", 'ADDED' FROM a WHERE "番号" NOT IN (SELECT aid FROM matched)),
side AS (SELECT bid, aid, b AS rb, a AS ra, a."国連参照番号" AS un_reference, a."氏名（英語）" AS name
  FROM matched JOIN b ON b."番号" = bid JOIN a ON a."番号" = aid),
cells AS (SELECT bid AS before_id, aid AS after_id, un_reference, name, unnest([{', '.join(
    f"{{'field': '{c}', 'before': rb.{_q(c)}, 'after': ra.{_q(c)}}}" for c in COLUMNS)}], recursive := true) FROM side),
changes AS (SELECT *, CAST(before_id AS BIGINT) AS n FROM cells WHERE before <> after),
classed AS (SELECT *, CASE
    WHEN field = '外務省告示情報' THEN '集約原文（重複）'
    WHEN field = '国籍（英語）' AND before = '' THEN '列再構成（既知情報）'
    WHEN field = '旅券番号' AND n % 26 = 0 THEN '列再構成（既知情報）'
    WHEN field IN ('生年月日', '出生地（英語）', '氏名（英語）') THEN '表記差'
    WHEN field IN ('番号', '告示番号') THEN '管理'
    WHEN field = 'その他の情報' THEN '補足情報・要レビュー' ELSE '識別・スクリーニング' END AS impact FROM changes),
kinds AS (SELECT *, impact NOT IN ('表記差', '集約原文（重複）', '列再構成（既知情報）') AS material,
    CASE WHEN field IN ('番号', '告示番号') THEN '管理情報改訂' WHEN field = 'その他の情報' THEN '補足情報改訂' ELSE '情報改訂' END || '（' || field || '）' AS kind
  FROM classed)
"""
SNAPS = "snap_before snap_after"


def _pairs(x):
    return S.pair_records(x.view("snap_before"), x.view("snap_after"))


@query("j4_record_pairing", views=SNAPS, oracle=f"WITH {PAIRS} SELECT bid AS before_id, aid AS after_id, via FROM paired")
def _(x):
    return _pairs(x).select(F.coalesce("b.番号", F.lit("")).alias("before_id"), F.coalesce("a.番号", F.lit("")).alias("after_id"), "via")


@query("d1_field_diff", views=SNAPS, oracle=f"WITH {PAIRS} SELECT before_id, after_id, un_reference, name, field, before, after FROM changes")
def _(x):
    return S.field_changes(_pairs(x)).drop("pos", "others")


@query("j5_moved_information", views=SNAPS, oracle=f"""
WITH {PAIRS} SELECT before_id, after_id, field, before, after, coalesce(impact = '列再構成（既知情報）', false) AS moved FROM classed
""")
def _(x):
    return S.moved_information(S.field_changes(_pairs(x))).select("before_id", "after_id", "field", "before", "after", "moved")


@query("d2_impact_classes", views=SNAPS, oracle=f"""
WITH {PAIRS} SELECT before_id, after_id, field, before, after, impact, material, kind FROM kinds
""")
def _(x):
    return S.classify_impact(S.field_changes(_pairs(x))).select(
        "before_id", "after_id", "field", "before", "after", "impact", "material", "kind")


@query("d3_diff_summary", views=SNAPS, oracle=f"""
WITH {PAIRS}
SELECT (SELECT count(*) FROM paired WHERE via = 'ADDED') AS added, (SELECT count(*) FROM paired WHERE via = 'REMOVED') AS removed,
  count(DISTINCT after_id) FILTER (material) AS amended, count(DISTINCT after_id) AS raw_amended, count(*) FILTER (material) AS field_changes,
  count(*) AS raw_field_changes, count(*) FILTER (impact = '表記差') AS cosmetic_changes,
  count(*) FILTER (impact = '集約原文（重複）') AS aggregate_changes, count(*) FILTER (impact = '列再構成（既知情報）') AS structure_changes
FROM kinds
""")
def _(x):
    return S.diff_summary(S.classify_impact(S.field_changes(_pairs(x), unpaired=True)))


def _cases(x):
    changes = S.classify_impact(S.field_changes(_pairs(x)))
    record = F.when(F.col("after_id") != "", F.col("after_id")).otherwise(F.col("before_id"))
    return S.review_cases(changes.select(
        F.lit(RAW).alias("after_raw"), record.alias("record_id"), F.lit("2026-09-05 10:00:00").alias("detected_at"),
        "name", "un_reference", "pos", "field", "before", "after", "impact", "before_fold", "after_fold"))


CASES = f"""
rows_of AS (SELECT after_id AS record_id, n, max(name) AS name, max(un_reference) AS un_reference,
    bool_or(field = '別名・別称（英語）') AS alias, bool_or(field = '旅券番号' AND material) AS passport,
    bool_or(field = '国籍（英語）' AND material) AS nation,
    max(before) FILTER (field = '国籍（英語）') AS nb, max(after) FILTER (field = '国籍（英語）') AS na,
    max(before) FILTER (field = '旅券番号') AS pb, max(after) FILTER (field = '旅券番号') AS pa,
    max(before) FILTER (field = '別名・別称（英語）') AS ab, max(after) FILTER (field = '別名・別称（英語）') AS aa,
    max(before) FILTER (field = '確定に十分でない別名（英語）') AS wb, max(after) FILTER (field = '確定に十分でない別名（英語）') AS wa
  FROM kinds GROUP BY 1, 2),
cases AS (SELECT 'MOF-20260905-' || record_id || '-' || substr(sha256('{RAW}|' || record_id), 1, 8) AS case_id,
    '2026-09-05 10:00:00' AS detected_at, name, record_id, un_reference, CASE WHEN alias OR passport THEN '高' ELSE '中' END AS priority,
    concat_ws(' / ', CASE WHEN alias THEN 'Weak Alias→Strong Alias昇格' END, CASE WHEN passport THEN '旅券番号変更' END, CASE WHEN nation THEN '国籍変更' END) AS reasons,
    concat_ws(' / ', CASE WHEN alias THEN '別名・別称（英語）' END, CASE WHEN nation THEN '国籍（英語）' END, CASE WHEN passport THEN '旅券番号' END,
      CASE WHEN alias THEN '確定に十分でない別名（英語）' END) AS fields,
    concat_ws(chr(10), CASE WHEN alias THEN '別名・別称（英語）: ' || ab || ' → ' || aa END, CASE WHEN nation THEN '国籍（英語）: ' || nb || ' → ' || na END,
      CASE WHEN passport THEN '旅券番号: ' || pb || ' → ' || pa END, CASE WHEN alias THEN '確定に十分でない別名（英語）: ' || wb || ' → ' || wa END) AS detail,
    '{RAW}' AS source_document
  FROM rows_of WHERE alias OR passport OR nation)
"""


@query("d6_review_cases", views=SNAPS, oracle=f"WITH {PAIRS}, {CASES} SELECT * FROM cases")
def _(x):
    return _cases(x)


@view("case_queue")
def _(d):
    """Existing case queue: a case of the same document for some customers, an older one for each of the others."""
    return f"""
SELECT CASE WHEN c_custkey % 38 = 0 THEN 'MOF-20260905-' || CAST(c_custkey AS STRING) || '-' || substr({d.sha(f"'{RAW}|' || CAST(c_custkey AS STRING)")}, 1, 8)
    ELSE 'MOF-20250101-' || CAST(c_custkey AS STRING) || '-00000000' END AS case_id,
  CAST(c_custkey AS STRING) AS record_id, 'older.csv' AS source_document, c_custkey AS position
FROM {d.t('customer')}
"""


@query("d7_case_queue", views=SNAPS + " case_queue", oracle=f"""
WITH {PAIRS}, {CASES},
u AS (SELECT case_id, record_id, source_document, 0 AS block, 0 AS old_position FROM cases WHERE case_id NOT IN (SELECT case_id FROM case_queue)
  UNION ALL SELECT case_id, record_id, source_document, 1, position FROM case_queue),
r AS (SELECT case_id, record_id, source_document, row_number() OVER (ORDER BY block, old_position, source_document, record_id) AS position FROM u)
SELECT * FROM r
""")
def _(x):
    return S.append_cases(x.view("case_queue"), _cases(x))


def _records(d, after: bool) -> str:
    n = "lpad(CAST(c_custkey AS STRING), 9, '0')"
    other = f"CASE WHEN c_custkey % 8 = 1 THEN 'ALIAS  ' || {n} WHEN c_custkey % 8 = 2 THEN 'Alias new ' || {n} ELSE 'Alias ' || {n} END" if after else f"'Alias ' || {n}"
    pair = d.arr(f"'Second ' || {n}", other) if after else d.arr(other, f"'Second ' || {n}")
    name = f"CASE WHEN c_custkey % 5 = 0 THEN 'CUSTOMER ' || {n} ELSE 'Customer ' || {n} END" if after else f"'Customer ' || {n}"
    country = "CASE WHEN c_custkey % 21 = 4 THEN 'Nation X' ELSE 'Nation ' || CAST(c_nationkey AS STRING) END" if after else "'Nation ' || CAST(c_nationkey AS STRING)"
    return f"""
SELECT c_custkey + {1 if after else 0} AS record_no, {country} AS country, {name} AS company, {pair} AS aliases,
  CASE WHEN c_custkey % 3 = 0 THEN '○' ELSE '' END AS wmd, {"CASE WHEN c_custkey % 50 = 6 THEN '○' ELSE '' END" if after else "''"} AS conventional_weapons
FROM {d.t('customer')} WHERE c_custkey % 10 <> {7 if after else 9}"""


@view("records_old")
def _(d):
    """Earlier manual list: country, company, aliases and two attributes per record."""
    return _records(d, False)


@view("records_new")
def _(d):
    """Later manual list: reworded, reordered, changed, dropped and new records."""
    return _records(d, True)


@query("d4_keyed_record_diff", views="records_old records_new", oracle="""
WITH o AS (SELECT *, lower(replace(company, ' ', '')) AS k FROM records_old), n AS (SELECT *, lower(replace(company, ' ', '')) AS k FROM records_new),
j AS (SELECT coalesce(o.k, n.k) AS match_key, o, n,
    CASE WHEN o.k IS NULL THEN '追加' WHEN n.k IS NULL THEN '削除'
      WHEN (lower(o.country), o.wmd, o.conventional_weapons, list_sort(list_transform(o.aliases, lambda a: lower(regexp_replace(a, ' +', ' ', 'g')))))
        IS DISTINCT FROM (lower(n.country), n.wmd, n.conventional_weapons, list_sort(list_transform(n.aliases, lambda a: lower(regexp_replace(a, ' +', ' ', 'g'))))) THEN '変更' END AS action
  FROM o FULL JOIN n ON o.k = n.k)
SELECT action, match_key, coalesce(o.record_no, -1) AS old_record_no, o.company AS old_company, o.country AS old_country, coalesce(n.record_no, -1) AS new_record_no,
  n.company AS new_company, n.country AS new_country, array_to_string(o.aliases, ' | ') AS old_aliases, array_to_string(n.aliases, ' | ') AS new_aliases
FROM j WHERE action IS NOT NULL
""")
def _(x):
    return S.diff_keyed_records(x.view("records_old"), x.view("records_new")).fillna(-1, ["old_record_no", "new_record_no"])


@view("stored_files")
def _(d):
    """File listing of a snapshot store: one file per hour and event type, with twins, hidden and foreign files."""
    stamp = f"replace(replace({d.iso('hour')}, '-', ''), ':', '')"
    return f"""
SELECT source, {stamp} || '__list.csv' AS file_name, bytes, n_rows FROM hourly
UNION ALL SELECT source, {stamp} || '__alt.csv', 1000, 0 FROM hourly WHERE source = 'error' AND n_rows % 5 = 4
UNION ALL SELECT source, '.' || {stamp} || '__list.csv', 1000, 0 FROM hourly WHERE n_rows % 7 = 3
UNION ALL SELECT source, 'readme ' || {stamp}, 1000, 0 FROM hourly WHERE n_rows % 7 = 4
"""


@view("hourly")
def _(d):
    return f"""
SELECT event_type AS source, date_trunc('hour', ts) AS hour, count(*) * 100000 AS bytes, count(*) AS n_rows
FROM {d.t('events')} GROUP BY event_type, date_trunc('hour', ts)
"""


@view("processed_stamps", "hourly")
def _(d):
    """Last processed generation of some sources; one points to a generation that is gone."""
    stamp = f"replace(replace({d.iso('max(hour)')}, '-', ''), ':', '')"
    return f"""
SELECT source, {stamp} AS stamp FROM hourly WHERE n_rows % 3 = 0 AND source IN ('click', 'view') GROUP BY source
UNION ALL SELECT DISTINCT source, '19990101T000000Z' FROM hourly WHERE source = 'error'
"""


from .fixtures import VIEWS  # noqa: E402  (stored_files needs its dependency declared before use)

VIEWS["stored_files"] = (["hourly"], VIEWS["stored_files"][1])

GENS = """
gens AS (SELECT source, substr(file_name, 1, 16) AS stamp, count(*) AS n_files, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(n_rows) AS BIGINT) AS n_rows
  FROM stored_files WHERE regexp_matches(file_name, '^[0-9]{8}T[0-9]{6}Z__') GROUP BY 1, 2)
"""


@query("s7_transition_plan", views="stored_files processed_stamps", oracle=f"""
WITH {GENS},
w AS (SELECT g.*, p.stamp AS done, lead(g.stamp) OVER s AS nxt, max(g.stamp) OVER (PARTITION BY g.source) AS newest,
    coalesce(bool_or(g.stamp = p.stamp) OVER (PARTITION BY g.source), false) AS known
  FROM gens g LEFT JOIN processed_stamps p ON p.source = g.source WINDOW s AS (PARTITION BY g.source ORDER BY g.stamp)),
t AS (SELECT *, nxt IS NOT NULL AND CASE WHEN done IS NULL THEN nxt = newest ELSE known AND stamp >= done END AS todo,
    CASE WHEN n_files > 1 THEN 'SEVERAL_FILES_PER_STAMP' WHEN done IS NOT NULL AND NOT known AND stamp = newest THEN 'PROCESSED_GENERATION_LOST' END AS violation FROM w)
SELECT source, stamp AS before_stamp, CASE WHEN todo THEN nxt END AS after_stamp, violation FROM t WHERE todo OR violation IS NOT NULL
""")
def _(x):
    return S.plan_transitions(S.generations(x.view("stored_files")), x.view("processed_stamps"))


@query("s8_retention", views="stored_files", oracle=f"""
WITH {GENS},
r AS (SELECT *, row_number() OVER w - 1 AS age, sum(bytes) OVER w AS running FROM gens WINDOW w AS (PARTITION BY source ORDER BY stamp DESC)),
c AS (SELECT *, min(CASE WHEN age >= 100 OR (running > 20000000 AND age > 0) THEN age END) OVER (PARTITION BY source) AS cut FROM r)
SELECT source, stamp, n_files, bytes, age, CASE WHEN age >= cut THEN 'drop' ELSE 'keep' END AS verdict FROM c
""")
def _(x):
    return S.retention(S.generations(x.view("stored_files")), keep=100, max_bytes=20000000)


@query("q8_volume_drops", views="stored_files", oracle=f"""
WITH {GENS}, l AS (SELECT source, stamp, lag(n_rows) OVER (PARTITION BY source ORDER BY stamp) AS previous_rows, n_rows FROM gens)
SELECT * FROM l WHERE previous_rows > 0 AND n_rows < previous_rows * 0.8
""")
def _(x):
    return S.volume_drops(S.generations(x.view("stored_files")))
