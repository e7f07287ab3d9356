"""Master queries: merge, repair, clusters, plans, statistics, projections, table gates."""

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.digests import WORDS
from ..operators import master as M
from ..sources import sinks
from .fixtures import DELISTED, view
from .registry import query

TS = 1700000000000


def remark_sql(sources: str, categories: str) -> str:
    """Remark text of a (sources, categories) pair of lists in DuckDB SQL."""
    order = "['財務省', '経産省', '外務省', 'OFAC', 'UK FCDO', 'legacy']"
    cats = (f"array_to_string(list_transform(list_filter({categories}, lambda c: starts_with(c, s || ':')), "
            "lambda c: substr(c, length(s) + 2)), '、')")
    bare = cats.replace("'、'", "'／'")
    block = f"CASE WHEN s = 'legacy' THEN {bare} WHEN {cats} = '' THEN s ELSE s || '：' || {cats} END"
    parts = (f"list_filter(list_transform(list_filter({order}, lambda s: list_contains({sources}, s)), "
             f"lambda s: {block}), lambda b: b <> '')")
    return f"CASE WHEN len({parts}) = 0 THEN '制裁リスト' ELSE '制裁リスト（' || array_to_string({parts}, '／') || '）' END"


FOLDED = """
shown AS (SELECT trim(trim(regexp_replace(name, ' +', ' ', 'g')), '"') AS name, category, source_id, ord FROM incoming
  WHERE name NOT LIKE '%不明'),
folded AS (SELECT lower(replace(name, ' ', '')) AS match_key, arg_min(name, ord) AS in_name,
    list_sort(list_distinct(list('OFAC:' || category))) AS in_cats FROM shown GROUP BY 1)
"""


def merged_sql(delist: bool) -> str:
    lost = "display_name IS NOT NULL AND in_name IS NULL AND list_contains(m.sources, 'OFAC')"
    dropped = lost if delist else "false"
    return f"""
{FOLDED},
joined AS (SELECT coalesce(m.match_key, i.match_key) AS match_key, m.* EXCLUDE (match_key), in_name, in_cats,
    CASE WHEN display_name IS NULL THEN ['OFAC']
      WHEN in_name IS NOT NULL THEN list_sort(list_distinct(list_append(m.sources, 'OFAC')))
      WHEN {dropped} THEN list_filter(m.sources, lambda s: s <> 'OFAC') ELSE m.sources END AS ns,
    CASE WHEN display_name IS NULL THEN in_cats
      WHEN in_name IS NOT NULL THEN list_sort(list_concat(list_filter(m.categories, lambda c: NOT starts_with(c, 'OFAC:')), in_cats))
      WHEN {dropped} THEN list_filter(m.categories, lambda c: NOT starts_with(c, 'OFAC:')) ELSE m.categories END AS nc,
    ({lost}) AS lost, ({dropped}) AS dropped,
    display_name IS NOT NULL AND in_name IS NOT NULL AND (invalid_reason LIKE '全ての出所%' OR invalid_reason LIKE 'OFAC現役Weak%') AS revived,
    CASE WHEN display_name IS NULL AND regexp_full_match(in_name, '[0-9]+') THEN '数字のみで人名・団体名として成立しない（' || in_name || '）' ELSE '' END AS bad,
    CASE WHEN display_name IS NULL AND length(in_name) <= 3 THEN CAST(length(in_name) AS STRING) || '文字と短く、照合時に誤検知が多発する見込み（' || in_name || '）' ELSE '' END AS odd
  FROM master m FULL JOIN folded i ON m.match_key = i.match_key),
stated AS (SELECT *, CASE WHEN display_name IS NULL THEN CASE WHEN bad = '' THEN '有効' ELSE '無効' END
      WHEN revived THEN '有効' WHEN dropped AND len(ns) = 0 THEN '無効' ELSE status END AS nstatus,
    CASE WHEN display_name IS NULL OR in_name IS NOT NULL OR dropped THEN {remark_sql('ns', 'nc')} ELSE remark END AS nremark
  FROM joined),
merged AS (SELECT *, CASE WHEN display_name IS NULL THEN 'added'
    WHEN in_name IS NOT NULL AND (status, sources, categories, remark) IS DISTINCT FROM (nstatus, ns, nc, nremark) THEN 'changed'
    WHEN lost THEN 'removed' END AS kind FROM stated)
"""


@query("m1_source_merge", views="master incoming", oracle=f"""
WITH {merged_sql(True)}
SELECT match_key, coalesce(display_name, in_name) AS display_name, nstatus AS status,
  coalesce(first_seen_ms, {TS}) AS first_seen_ms,
  CASE WHEN kind IS NULL THEN last_updated_ms ELSE {TS} END AS last_updated_ms,
  array_to_string(ns, ';') AS sources, array_to_string(nc, ';') AS categories, nremark AS remark,
  CASE WHEN display_name IS NULL THEN bad WHEN revived THEN '' WHEN dropped AND len(ns) = 0 THEN '{DELISTED}' ELSE invalid_reason END AS invalid_reason,
  CASE WHEN display_name IS NULL THEN CASE WHEN bad = '' THEN odd ELSE '' END WHEN revived THEN '' ELSE review_flag END AS review_flag,
  coalesce(kind, '') AS kind, coalesce(remark, '') AS before_remark
FROM merged
""")
def _(x):
    merged = M.merge(x.view("master"), x.view("incoming"), "OFAC", TS)
    return merged.select(
        "match_key", "display_name", "status", "first_seen_ms", "last_updated_ms", F.array_join("sources", ";").alias("sources"),
        F.array_join("categories", ";").alias("categories"), "remark", "invalid_reason", "review_flag",
        F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("before.remark", F.lit("")).alias("before_remark"))


def _diff(x):
    return M.diff_of(M.merge(x.view("master"), x.view("incoming"), "OFAC", TS, delist=False), "OFAC")


def _strong(x):
    """Names the earlier history held as strong: every third new supplier name."""
    return x.table("supplier").filter("s_suppkey % 3 = 0").select(
        F.concat(F.lit("supplier"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("match_key"))


BACKFILL = """
strong AS (SELECT 'supplier' || lpad(CAST(s_suppkey AS STRING), 9, '0') AS match_key FROM supplier WHERE s_suppkey % 3 = 0),
classified AS (SELECT d.*, kind = 'added' AND d.match_key IN (SELECT match_key FROM strong) AS backfill FROM merged d WHERE kind IS NOT NULL)
"""


@query("m10_backfill_classification", views="master incoming", oracle=f"""
WITH {merged_sql(False)}, {BACKFILL}
SELECT match_key, kind, CASE WHEN backfill THEN 'backfill' ELSE '' END AS origin FROM classified
""")
def _(x):
    return M.classify_backfill(_diff(x), _strong(x)).select("match_key", "kind", F.coalesce("origin", F.lit("")).alias("origin"))


@query("a1_diff_counts", views="master incoming", oracle=f"""
WITH {merged_sql(False)}, {BACKFILL}
SELECT 'OFAC' AS source, count(*) FILTER (kind = 'added' AND NOT backfill) AS added, count(*) FILTER (backfill) AS backfilled,
  count(*) FILTER (kind = 'removed') AS removed, count(*) FILTER (kind = 'changed') AS changed FROM classified
""")
def _(x):
    return M.diff_counts(M.classify_backfill(_diff(x), _strong(x)))


PUBLISHED = """
published AS (SELECT 'OFAC' AS source, CASE WHEN backfill THEN '初回同期（Advanced XML）' WHEN kind = 'added' THEN '追加'
    WHEN kind = 'removed' THEN '掲載終了候補（要確認）' ELSE '変更' END AS kind_label,
  coalesce(display_name, in_name) AS name, CASE WHEN kind = 'added' THEN '' ELSE remark END AS before_text, nremark AS after_text
  FROM classified)
"""


@query("d5_diff_rows", views="master incoming", oracle=f"""
WITH {merged_sql(False)}, {BACKFILL}, {PUBLISHED}
SELECT * FROM published
""")
def _(x):
    return M.diff_rows(M.classify_backfill(_diff(x), _strong(x)))


@query("s13_import_projection", views="master incoming", oracle=f"""
WITH {merged_sql(False)}, {BACKFILL}, {PUBLISHED},
touched AS (SELECT lower(replace(name, ' ', '')) AS match_key, min(name) AS diff_name FROM published
  WHERE kind_label <> '掲載終了候補（要確認）' GROUP BY 1)
SELECT t.match_key, coalesce(m.display_name, diff_name) AS name, risk_type, status, risk_level,
  strftime(epoch_ms(first_seen_ms) + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS first_seen,
  strftime(epoch_ms(last_updated_ms) + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS last_updated, remark,
  CASE WHEN m.display_name IS NULL THEN 'MASTER_ROW_MISSING' END AS violation
FROM touched t LEFT JOIN master m ON m.match_key = t.match_key
""")
def _(x):
    published = M.diff_rows(M.classify_backfill(_diff(x), _strong(x)))
    return M.import_projection(x.view("master"), published)


@query("a2_build_statistics", views="master", oracle="""
SELECT 'total' AS item, count(*) AS value FROM master
UNION ALL SELECT 'active', count(*) FROM master WHERE status = '有効'
UNION ALL SELECT 'inactive', count(*) FROM master WHERE status = '無効'
UNION ALL SELECT 'first_seen_ms', min(first_seen_ms) FROM master
UNION ALL SELECT 'last_updated_ms', max(last_updated_ms) FROM master
UNION ALL SELECT 'source: ' || s, count(*) FROM (SELECT unnest(sources) AS s FROM master) WHERE s <> 'legacy' GROUP BY s
""")
def _(x):
    return M.build_statistics(x.view("master"))


@view("remark_pairs")
def _(d):
    """Long (row, source, category) pairs: up to three per order, some repeated."""
    return f"""
SELECT l_orderkey AS row_id, CASE l_suppkey % 4 WHEN 0 THEN 'OFAC' WHEN 1 THEN '財務省' WHEN 2 THEN 'legacy' ELSE '経産省' END AS source,
  CASE WHEN l_suppkey % 4 = 3 THEN '' ELSE 'C' || CAST(l_linenumber % 3 AS STRING) END AS category FROM {d.t('lineitem')}
"""


@query("a8_remark_text", views="remark_pairs", oracle=f"""
WITH g AS (SELECT row_id, list_distinct(list(source)) AS sources,
    list_sort(list_distinct(list(source || ':' || category) FILTER (category <> ''))) AS cats FROM remark_pairs GROUP BY row_id),
s AS (SELECT row_id, sources, coalesce(cats, []) AS categories FROM g)
SELECT row_id, {remark_sql('sources', 'categories')} AS remark FROM s
""")
def _(x):
    return M.remarks_from_pairs(x.view("remark_pairs"))


@query("s11_master_sink", views="master", oracle="""
SELECT match_key, display_name, status, risk_type, risk_level, first_seen_ms, last_updated_ms, array_to_string(sources, ';') AS sources,
  array_to_string(categories, ';') AS categories, remark, invalid_reason, review_flag, '["' || variants[1] || '"]' AS variants FROM master
""")
def _(x):
    return M.flat_master(x.view("master"))


@query("s12_screening_projection", views="master", oracle="""
SELECT match_key, replace(replace(match_key, '(', ''), ')', '') AS secondary_key, display_name, array_to_string(sources, ';') AS sources,
  array_to_string(categories, ';') AS categories, risk_type, risk_level, status, review_flag, CAST(NULL AS VARCHAR) AS violation
FROM master WHERE status = '有効'
""")
def _(x):
    return M.screening_projection(x.view("master"))


@view("published_screening")
def _(d):
    """A published screening file with planted faults: rows missing, doubled and altered."""
    return f"""
SELECT 'customer' || lpad(CAST(c_custkey AS STRING), 9, '0') AS match_key,
  'Customer ' || lpad(CAST(c_custkey AS STRING), 9, '0') AS display_name,
  CASE WHEN c_custkey % 101 = 7 THEN '低' ELSE '高' END AS risk_level FROM {d.t('customer')} WHERE c_custkey % 37 <> 3
UNION ALL
SELECT 'customer' || lpad(CAST(c_custkey AS STRING), 9, '0'), 'Customer ' || lpad(CAST(c_custkey AS STRING), 9, '0'), '高'
FROM {d.t('customer')} WHERE c_custkey % 53 = 1
"""


@query("q9_multiset_equality", views="master published_screening", oracle="""
WITH e AS (SELECT match_key, display_name, risk_level FROM master),
u AS (SELECT *, 1 AS w FROM e UNION ALL SELECT *, -1 FROM published_screening)
SELECT match_key, display_name, risk_level, CASE WHEN sum(w) > 0 THEN 'missing' ELSE 'extra' END AS side, CAST(abs(sum(w)) AS BIGINT) AS n_rows
FROM u GROUP BY ALL HAVING sum(w) <> 0
""")
def _(x):
    cols = ["match_key", "display_name", "risk_level"]
    return M.multiset_differences(x.view("master").select(*cols), x.view("published_screening"))


def digest_sql(member: str) -> str:
    """The set digest in DuckDB: eight 32-bit word sums of SHA-256, hashed with the count."""
    words = " || '|' || ".join(
        f"CAST(sum(CAST(('0x' || substr(sha256({member}), {1 + 8 * i}, 8)) AS BIGINT)) AS STRING)" for i in range(WORDS))
    return f"sha256(CAST(count({member}) AS STRING) || '|' || {words})"


MASTER_ROW = ("concat_ws(chr(31), match_key, display_name, status, risk_type, risk_level, CAST(first_seen_ms AS STRING), "
              "CAST(last_updated_ms AS STRING), array_to_string(sources, ';'), array_to_string(categories, ';'), remark, "
              "invalid_reason, review_flag, array_to_string(variants, ';'))")


@query("q10_state_digest", views="master", oracle=f"""
WITH r AS (SELECT {MASTER_ROW} AS member FROM master)
SELECT count(*) AS n_rows, {digest_sql('member')} AS state_hash FROM r
""")
def _(x):
    return M.state_digest(x.view("master"), K.MASTER_COLUMNS)


@query("q4_key_uniqueness", views="raw_names", oracle="""
WITH k AS (SELECT CASE WHEN v = 6 THEN '' ELSE upper(trim(raw)) END AS k FROM raw_names)
SELECT k AS name_key, count(*) AS n_rows, CASE WHEN k = '' THEN 'EMPTY_KEY' ELSE 'DUPLICATE_KEY' END AS violation
FROM k GROUP BY k HAVING k = '' OR count(*) > 1
""")
def _(x):
    keyed = x.view("raw_names").select(F.when(F.col("v") == 6, "").otherwise(F.upper(F.trim("raw"))).alias("name_key"))
    return M.duplicate_keys(keyed, "name_key")


# --- repair ------------------------------------------------------------------------------

@view("damaged_master")
def _(d):
    """Master with damaged, source-less rows: numbered, bracketed and descriptor-laden names; some share a target."""
    none = "CAST(array() AS array<string>)" if d.spark else "CAST([] AS VARCHAR[])"
    n = "lpad(CAST(c_custkey AS STRING), 9, '0')"
    key = f"""CASE WHEN c_custkey % 5 = 0 THEN 'customer' || {n} WHEN c_custkey % 5 = 1 THEN '3.customer' || lpad(CAST(c_custkey - 1 AS STRING), 9, '0')
    WHEN c_custkey % 5 = 2 THEN 'official' || {n} || '(国籍：x)' WHEN c_custkey % 5 = 3 THEN 'official' || lpad(CAST(c_custkey - 1 AS STRING), 9, '0') || ')' ELSE 'lost' || {n} END"""
    name = f"""CASE WHEN c_custkey % 5 = 0 THEN 'Customer ' || {n} WHEN c_custkey % 5 = 1 THEN '3. Customer ' || lpad(CAST(c_custkey - 1 AS STRING), 9, '0')
    WHEN c_custkey % 5 = 2 THEN 'Official ' || {n} || ' (国籍：x)' WHEN c_custkey % 5 = 3 THEN 'Official ' || lpad(CAST(c_custkey - 1 AS STRING), 9, '0') || ')' ELSE 'Lost ' || {n} END"""
    return f"""
SELECT {key} AS match_key, {name} AS display_name, CASE WHEN c_custkey % 5 = 0 THEN '有効' ELSE '無効' END AS status,
  '制裁リスト' AS risk_type, '高' AS risk_level, 1500000000000 - c_custkey AS first_seen_ms, 1600000000000 + c_custkey AS last_updated_ms,
  CASE WHEN c_custkey % 5 = 0 THEN {d.arr("'財務省'")} ELSE {none} END AS sources, {none} AS categories,
  '制裁リスト' AS remark, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '{DELISTED}' END AS invalid_reason, '' AS review_flag,
  {d.arr(name)} AS variants
FROM {d.t('customer')}
"""


@view("official_names")
def _(d):
    """Current official list: every customer name of a multiple of five and the 'Official' names."""
    return f"""
SELECT 'customer' || lpad(CAST(c_custkey AS STRING), 9, '0') AS match_key, 'Customer ' || lpad(CAST(c_custkey AS STRING), 9, '0') AS name,
  {d.arr("'ハイチ共和国'")} AS categories FROM {d.t('customer')} WHERE c_custkey % 5 = 0
UNION ALL
SELECT 'official' || lpad(CAST(c_custkey AS STRING), 9, '0'), 'Official ' || lpad(CAST(c_custkey AS STRING), 9, '0'),
  {d.arr("'テロリスト等'")} FROM {d.t('customer')} WHERE c_custkey % 5 = 2
"""


@query("j6_legacy_repair", views="damaged_master official_names", oracle=f"""
WITH n AS (SELECT *, 1500000000000 - first_seen_ms AS id FROM damaged_master),
t AS (SELECT *, CASE id % 5 WHEN 1 THEN 'customer' || lpad(CAST(id - 1 AS STRING), 9, '0') WHEN 2 THEN 'official' || lpad(CAST(id AS STRING), 9, '0')
    WHEN 3 THEN 'official' || lpad(CAST(id - 1 AS STRING), 9, '0') END AS landing FROM n),
arr AS (SELECT landing, min(first_seen_ms) AS first_ms, count(*) AS n, list(display_name) AS names FROM t WHERE landing IS NOT NULL GROUP BY 1)
SELECT t.match_key, display_name, status, least(first_seen_ms, coalesce(first_ms, first_seen_ms)) AS first_seen_ms,
  array_to_string(sources, ';') AS sources, array_to_string(list_sort(list_distinct(list_concat(variants, coalesce(names, [])))), '|') AS variants,
  CASE WHEN arr.n IS NOT NULL THEN 'merged_into' WHEN id % 5 = 4 THEN 'unresolved' ELSE 'untouched' END AS outcome, coalesce(arr.n, 0) AS n_absorbed
FROM t LEFT JOIN arr ON arr.landing = t.match_key WHERE t.landing IS NULL
UNION ALL
SELECT landing, o.name, '有効', first_ms, '財務省', array_to_string(list_sort(list_distinct(list_append(names, o.name))), '|'), 'revived', n
FROM arr JOIN official_names o ON o.match_key = arr.landing WHERE landing LIKE 'official%'
""")
def _(x):
    return M.repair_legacy(x.view("damaged_master"), x.view("official_names")).select(
        "match_key", "display_name", "status", "first_seen_ms", F.array_join("sources", ";").alias("sources"),
        F.array_join("variants", "|").alias("variants"), "outcome", "n_absorbed")


@view("legacy_rows")
def _(d):
    """Legacy sheet: several spellings of each customer per order, alias cells, brackets and invalid marks."""
    n = "lpad(CAST(o_custkey AS STRING), 9, '0')"
    return f"""
SELECT o_orderkey AS ord, CASE o_orderkey % 6 WHEN 0 THEN 'CUSTOMER ' || {n} WHEN 1 THEN 'Customer   ' || {n}
    WHEN 2 THEN '"Customer ' || {n} || '"' WHEN 3 THEN 'Customer ' || {n} || ' (a.k.a. Alias ' || {n} || ')'
    WHEN 4 THEN '(Customer ' || {n} || ')' ELSE 'Customer ' || {n} END AS raw,
  CASE o_orderkey % 4 WHEN 0 THEN 'OFAC' WHEN 1 THEN '制裁リスト（財務省：テロリスト等／OFAC：SDN）' WHEN 2 THEN '外為法' ELSE '2. ハイチ' END AS remark,
  {d.ms('o_orderdate')} AS first_ms, {d.ms('o_orderdate')} + 5 AS last_ms, o_orderkey % 50 = 0 AS was_invalid
FROM {d.t('orders')}
"""


@query("m12_legacy_clusters", views="legacy_rows", oracle=f"""
WITH p AS (
  SELECT *, 0 AS pos, trim(trim(regexp_replace(CASE WHEN ord % 6 = 3 THEN split_part(raw, ' (', 1) WHEN ord % 6 = 4 THEN trim(raw, '()') ELSE raw END, ' +', ' ', 'g')), '"') AS name FROM legacy_rows
  UNION ALL SELECT *, 1, 'Alias ' || substr(raw, 10, 9) FROM legacy_rows WHERE ord % 6 = 3),
k AS (SELECT *, lower(replace(name, ' ', '')) AS match_key, ord % 6 = 3 AS split FROM p),
prs AS (SELECT match_key, CASE ord % 4 WHEN 0 THEN 'OFAC' WHEN 1 THEN '財務省' WHEN 2 THEN 'legacy' ELSE '財務省' END AS s,
    CASE ord % 4 WHEN 0 THEN '' WHEN 1 THEN 'テロリスト等' WHEN 2 THEN '外為法' ELSE 'ハイチ共和国' END AS c FROM k
  UNION ALL SELECT match_key, 'OFAC', 'SDN' FROM k WHERE ord % 4 = 1),
pg AS (SELECT match_key, list_sort(list_distinct(list(s))) AS sources, coalesce(list_sort(list_distinct(list(s || ':' || c) FILTER (c <> ''))), []) AS categories
  FROM prs GROUP BY 1),
g AS (SELECT match_key, arg_min(name, (first_ms, ord, pos)) AS display_name, arg_min(raw, (first_ms, ord, pos)) AS head_raw,
    arg_min(last_ms, (first_ms, ord, pos)) AS head_last, min(first_ms) AS first_seen_ms, count(*) AS members, bool_or(was_invalid) AS invalid,
    bool_or(split) AS any_split, list_sort(list_distinct(list(name))) AS variants FROM k GROUP BY 1)
SELECT match_key, display_name, CASE WHEN invalid THEN '無効' ELSE '有効' END AS status, first_seen_ms,
  CASE WHEN members > 1 OR invalid OR any_split OR display_name <> head_raw THEN {TS} ELSE head_last END AS last_updated_ms,
  array_to_string(sources, ';') AS sources, array_to_string(categories, ';') AS categories, {remark_sql('sources', 'categories')} AS remark,
  CASE WHEN invalid THEN '既存データで無効指定' ELSE '' END AS invalid_reason, array_to_string(variants, '|') AS variants, members
FROM g JOIN pg USING (match_key)
""")
def _(x):
    return M.cluster_legacy(x.view("legacy_rows"), TS).select(
        "match_key", "display_name", "status", "first_seen_ms", "last_updated_ms", F.array_join("sources", ";").alias("sources"),
        F.array_join("categories", ";").alias("categories"), "remark", "invalid_reason", F.array_join("variants", "|").alias("variants"), "members")


LEGACY = """
WITH p AS (
  SELECT *, 0 AS pos, trim(trim(regexp_replace(CASE WHEN ord % 6 = 3 THEN split_part(raw, ' (', 1) WHEN ord % 6 = 4 THEN trim(raw, '()') ELSE raw END, ' +', ' ', 'g')), '"') AS name FROM legacy_rows
  UNION ALL SELECT *, 1, 'Alias ' || substr(raw, 10, 9) FROM legacy_rows WHERE ord % 6 = 3),
k AS (SELECT *, lower(replace(name, ' ', '')) AS match_key, ord % 6 = 3 AS split FROM p),
prs AS (SELECT match_key, CASE ord % 4 WHEN 0 THEN 'OFAC' WHEN 1 THEN '財務省' WHEN 2 THEN 'legacy' ELSE '財務省' END AS s,
    CASE ord % 4 WHEN 0 THEN '' WHEN 1 THEN 'テロリスト等' WHEN 2 THEN '外為法' ELSE 'ハイチ共和国' END AS c FROM k
  UNION ALL SELECT match_key, 'OFAC', 'SDN' FROM k WHERE ord % 4 = 1)
"""


@query("m12_legacy_spellings", views="legacy_rows", oracle=LEGACY + "SELECT match_key, name, min(first_ms) AS first_ms FROM k GROUP BY match_key, name")
def _(x):
    """Spelling cells in long form: a key of any number of spellings stays spread over rows."""
    return M.legacy_spellings(x.view("legacy_rows")).select("match_key", "name", F.col("place.first_ms").alias("first_ms"))


@query("m12_legacy_marks", views="legacy_rows", oracle=LEGACY + "SELECT DISTINCT match_key, s AS source, c AS category FROM prs")
def _(x):
    """Source and category cells in long form."""
    return M.legacy_marks(x.view("legacy_rows"))


@query("m12_folded_spellings", views="legacy_rows", oracle=LEGACY + "SELECT match_key, string_agg(DISTINCT name, '|' ORDER BY name) AS name FROM k GROUP BY match_key")
def _(x):
    """The spelling cell of every key as the sink's streaming writer makes it."""
    return sinks.fold_cells(M.legacy_spellings(x.view("legacy_rows")), ["match_key"], ["name"], ["name"], "|")


# --- plan --------------------------------------------------------------------------------

@view("plan_records")
def _(d):
    """Records of a manual list: one per customer with two aliases; short, numeric and shared aliases planted."""
    n = "lpad(CAST(c_custkey AS STRING), 9, '0')"
    return f"""
SELECT c_custkey AS record_no, CASE WHEN c_custkey % 11 = 0 THEN 'Newco ' || {n} ELSE 'Customer ' || {n} END AS company,
  {d.arr(f"CASE c_custkey % 9 WHEN 0 THEN 'Shared ' || CAST({d.div('c_custkey', '18')} AS STRING) WHEN 1 THEN 'X' || CAST(c_custkey % 10 AS STRING) || CAST({d.div('c_custkey', '10')} % 10 AS STRING) WHEN 2 THEN lpad(CAST(c_custkey AS STRING), 8, '4') ELSE 'CUSTOMER ' || {n} END", f"'Trade ' || {n}")} AS aliases
FROM {d.t('customer')}
"""


CANDIDATES = """
names AS (SELECT record_no, company, 0 AS pos, 'PRIMARY' AS kind, company AS name FROM plan_records
  UNION ALL SELECT record_no, company, 1, 'ALIAS:1', aliases[1] FROM plan_records
  UNION ALL SELECT record_no, company, 2, 'ALIAS:2', aliases[2] FROM plan_records),
cand AS (SELECT *, lower(replace(name, ' ', '')) AS match_key,
    CASE WHEN regexp_full_match(name, '[0-9]+') THEN '数字のみで人名・団体名として成立しない（' || name || '）' ELSE '' END AS invalid,
    CASE WHEN length(name) <= 3 THEN CAST(length(name) AS STRING) || '文字と短く、照合時に誤検知が多発する見込み（' || name || '）' ELSE '' END AS review
  FROM names),
ranked AS (SELECT *, row_number() OVER (PARTITION BY match_key ORDER BY kind <> 'PRIMARY', review <> '', record_no, lower(name), pos) AS rn,
    count(*) OVER (PARTITION BY match_key) AS n_names, min(record_no) OVER (PARTITION BY match_key) AS lo,
    max(record_no) OVER (PARTITION BY match_key) AS hi FROM cand),
plan AS (SELECT CASE WHEN lo <> hi THEN 'HOLD_MULTI_PARTY_COLLISION' WHEN invalid <> '' THEN 'HOLD_INVALID' WHEN review <> '' THEN 'HOLD_WEAK_ALIAS'
      WHEN m.match_key IS NULL THEN 'READY_ADD' WHEN list_contains(m.sources, '経産省') THEN 'NOOP_ALREADY_METI' ELSE 'READY_TAG_EXISTING' END AS action,
    r.match_key, name, record_no, company AS record_primary, kind, n_names, invalid, review,
    coalesce(array_to_string(m.sources, ';'), '') AS existing_sources, coalesce(m.display_name, '') AS existing_name
  FROM ranked r LEFT JOIN master m ON m.match_key = r.match_key WHERE rn = 1)
"""


def _plan(x):
    candidates = M.plan_candidates(x.view("plan_records"), "h0")
    return candidates, M.classify_plan(candidates, x.view("master"))


@query("a6_plan_classification", views="plan_records master", oracle=f"""
WITH {CANDIDATES}
SELECT action, match_key, name, record_no, record_primary, kind, n_names,
  CASE WHEN action = 'HOLD_MULTI_PARTY_COLLISION' THEN '同一match_keyが複数のMETI No.に紐づく。party-aware管理まで単独master反映しない'
    WHEN action = 'HOLD_INVALID' THEN invalid WHEN action = 'HOLD_WEAK_ALIAS' THEN review ELSE '' END AS review_reason,
  '' AS resolution, existing_sources, existing_name FROM plan
""")
def _(x):
    return _plan(x)[1]


@query("a7_legacy_holds", views="plan_records master", oracle=f"""
WITH {CANDIDATES}
SELECT 'HOLD_LEGACY_NOT_IN_CURRENT' AS action, match_key, display_name, array_to_string(sources, ';') AS sources, status, remark
FROM master WHERE list_contains(sources, '経産省') AND match_key NOT IN (SELECT match_key FROM cand)
""")
def _(x):
    candidates, _ = _plan(x)
    return M.legacy_holds(x.view("master"), candidates)


@query("j8_token_reach_audit", views="plan_records master", oracle=f"""
WITH {CANDIDATES},
tok AS (SELECT 'h0:' || record_no || ':' || kind AS token, record_no, kind, match_key FROM cand),
expected AS (SELECT token, 1 AS e, 0 AS r FROM tok UNION ALL SELECT 'h0:' || record_no || ':PRIMARY', 1, 0 FROM tok WHERE kind = 'PRIMARY' AND record_no % 97 = 5
  UNION ALL SELECT 'h0:' || (record_no + 100000000) || ':PRIMARY', 1, 0 FROM tok WHERE kind = 'PRIMARY' AND record_no % 89 = 3),
reached AS (SELECT token, 0 AS e, 1 AS r FROM tok WHERE NOT (kind = 'ALIAS:2' AND record_no % 61 = 1)
  UNION ALL SELECT token, 0, 1 FROM tok WHERE kind = 'ALIAS:1' AND record_no % 71 = 2
  UNION ALL SELECT token || ':X', 0, 1 FROM tok WHERE kind = 'PRIMARY' AND record_no % 83 = 4)
SELECT token, CAST(sum(e) AS BIGINT) AS n_expected, CAST(sum(r) AS BIGINT) AS n_reached,
  CASE WHEN sum(e) = 0 THEN 'UNEXPECTED_TOKEN' WHEN sum(r) = 0 THEN 'MISSING_TOKEN' WHEN sum(e) > 1 THEN 'REPEATED_SOURCE_TOKEN' ELSE 'DUPLICATED_TOKEN' END AS violation
FROM (SELECT * FROM expected UNION ALL SELECT * FROM reached) GROUP BY token HAVING sum(e) <> 1 OR sum(r) <> 1
""")
def _(x):
    candidates, plan = _plan(x)
    primary = candidates.filter("kind = 'PRIMARY'")
    expected = candidates.select("token").unionByName(primary.filter("record_no % 97 = 5").select("token")).unionByName(
        primary.filter("record_no % 89 = 3").select(F.concat(F.lit("h0:"), (F.col("record_no") + 100000000).cast("string"), F.lit(":PRIMARY")).alias("token")))
    reached = M.plan_tokens(candidates, plan)
    faulty = reached.filter("NOT (kind = 'ALIAS:2' AND record_no % 61 = 1)").select("token").unionByName(
        reached.filter("kind = 'ALIAS:1' AND record_no % 71 = 2").select("token")).unionByName(
        reached.filter("kind = 'PRIMARY' AND record_no % 83 = 4").select(F.concat("token", F.lit(":X")).alias("token")))
    return M.audit_tokens(expected, faulty)


OUTCOMES = f"""
WITH {CANDIDATES},
prim AS (SELECT c.record_no, p.action, p.match_key, c.name FROM cand c JOIN plan p ON p.match_key = c.match_key WHERE c.kind = 'PRIMARY'),
reached AS (SELECT * FROM prim WHERE record_no % 83 <> 4 UNION ALL SELECT * FROM prim WHERE record_no % 71 = 2 AND record_no % 83 <> 4),
counted AS (SELECT record_no, count(*) AS n, min(action) AS action, min(match_key) AS match_key, min(name) AS name FROM reached GROUP BY record_no),
outcomes AS (SELECT r.record_no, coalesce(n, 0) AS n_outcomes, CASE WHEN n = 1 THEN action END AS action, CASE WHEN n = 1 THEN match_key END AS match_key,
    CASE WHEN n = 1 THEN name END AS name FROM (SELECT DISTINCT record_no FROM plan_records) r LEFT JOIN counted c ON c.record_no = r.record_no)
"""


def _outcomes(x):
    """Primary outcomes of a plan in which some primary tokens are lost and some stand twice."""
    reached = M.plan_tokens(*_plan(x))
    faulty = reached.filter("record_no % 83 <> 4").unionByName(reached.filter("kind = 'PRIMARY' AND record_no % 71 = 2 AND record_no % 83 <> 4"))
    return M.primary_outcomes(x.view("plan_records"), faulty)


@query("j8_primary_outcomes", views="plan_records master", oracle=OUTCOMES + """
SELECT *, starts_with(action, 'HOLD') AS held, CASE WHEN n_outcomes = 0 THEN 'NO_PRIMARY' WHEN n_outcomes > 1 THEN 'SEVERAL_PRIMARY' END AS violation FROM outcomes
""")
def _(x):
    return _outcomes(x)


@query("j8_action_counts", views="plan_records master", oracle=f"""
WITH {CANDIDATES},
p AS (SELECT action, count(*) AS n FROM plan GROUP BY action),
ledger AS (SELECT action, n + CASE WHEN action = 'READY_ADD' THEN 2 ELSE 0 END AS n FROM p WHERE action <> 'HOLD_WEAK_ALIAS' UNION ALL SELECT 'HOLD_REVIEW', 3)
SELECT coalesce(p.action, l.action) AS action, coalesce(p.n, 0) AS n_plan, CAST(coalesce(l.n, 0) AS BIGINT) AS n_ledger
FROM p FULL JOIN ledger l ON l.action = p.action WHERE coalesce(p.n, 0) <> coalesce(l.n, 0)
""")
def _(x):
    """A ledger that recorded two additions too many, no weak aliases, and reviews that the plan does not have."""
    plan = _plan(x)[1]
    counts = plan.groupBy("action").agg(F.count(F.lit(1)).alias("n")).filter("action <> 'HOLD_WEAK_ALIAS'")
    ledger = counts.select("action", (F.col("n") + F.when(F.col("action") == "READY_ADD", 2).otherwise(0)).alias("n"))
    return M.audit_action_counts(plan, ledger.unionByName(x.spark.sql("SELECT 'HOLD_REVIEW' AS action, 3L AS n")))


@query("j9_unchanged_since_apply", views="master", oracle=f"""
WITH r AS (SELECT match_key, {MASTER_ROW} AS member FROM master),
now AS (SELECT count(*) AS n, {digest_sql('member')} AS h FROM r), then_ AS (SELECT count(*) AS n, {digest_sql('member')} AS h FROM r WHERE match_key NOT LIKE '%7')
SELECT 'same' AS run, now.n AS apply_count, now.n AS current_count, true AS unchanged FROM now
UNION ALL SELECT 'edited', then_.n, now.n, then_.h = now.h FROM now, then_
""")
def _(x):
    """Two applies: after one nothing changed, after the other rows were added."""
    master = x.view("master")
    run = lambda name, rows: M.state_digest(rows, K.MASTER_COLUMNS).withColumn("run", F.lit(name))
    return M.unchanged_since_apply(master, run("same", master).unionByName(run("edited", master.filter("match_key NOT LIKE '%7'"))), K.MASTER_COLUMNS)


@query("j9_master_keys", views="master", oracle="""
WITH k AS (SELECT match_key FROM master UNION ALL SELECT match_key FROM master WHERE match_key LIKE '%5' UNION ALL SELECT '' FROM master WHERE match_key LIKE '%99')
SELECT match_key, count(*) AS n_rows, CASE WHEN match_key = '' THEN 'EMPTY_KEY' ELSE 'DUPLICATE_KEY' END AS violation FROM k GROUP BY match_key HAVING match_key = '' OR count(*) > 1
""")
def _(x):
    """The key gate of the applied master, over a master with repeated and empty keys."""
    master = x.view("master").select("match_key")
    return M.duplicate_keys(master.unionByName(master.filter("match_key LIKE '%5'")).unionByName(
        master.filter("match_key LIKE '%99'").select(F.lit("").alias("match_key"))), "match_key")


@query("j9_primary_details", views="plan_records master", oracle=OUTCOMES + """
SELECT record_no, action, name, o.match_key, m.match_key IS NOT NULL AS in_master, coalesce(list_contains(m.sources, '経産省'), false) AS tagged
FROM outcomes o LEFT JOIN master m ON m.match_key = o.match_key
""")
def _(x):
    return M.primary_details(_outcomes(x), x.view("master"))


@query("j9_applied_plan_audit", views="plan_records master", oracle=f"""
WITH {CANDIDATES}
SELECT p.match_key, action, CASE WHEN m.match_key IS NULL THEN 'MASTER_ROW_MISSING' ELSE 'SOURCE_TAG_MISSING' END AS violation
FROM plan p LEFT JOIN master m ON m.match_key = p.match_key
WHERE action IN ('READY_ADD', 'READY_TAG_EXISTING', 'NOOP_ALREADY_METI')
  AND (m.match_key IS NULL OR NOT list_contains(m.sources, '経産省'))
""")
def _(x):
    return M.audit_applied(_plan(x)[1], x.view("master"))


@query("m13_apply_simulation", views="plan_records master", oracle=f"""
WITH {CANDIDATES}
SELECT p.match_key, action, CASE action WHEN 'READY_ADD' THEN 'INSERTED' WHEN 'READY_TAG_EXISTING' THEN 'CHANGED' ELSE 'UNCHANGED' END AS effect,
  CASE WHEN action = 'READY_ADD' THEN '有効' WHEN action = 'READY_TAG_EXISTING' AND m.invalid_reason NOT LIKE '数字%' THEN '有効' ELSE coalesce(m.status, '') END AS status,
  CASE WHEN action = 'READY_ADD' THEN '経産省' WHEN action = 'READY_TAG_EXISTING' THEN array_to_string(list_sort(list_append(m.sources, '経産省')), ';')
    ELSE coalesce(array_to_string(m.sources, ';'), '') END AS sources, true AS as_planned
FROM plan p LEFT JOIN master m ON m.match_key = p.match_key
""")
def _(x):
    return M.simulate_apply(_plan(x)[1], x.view("master"), K.SRC_METI, TS)
