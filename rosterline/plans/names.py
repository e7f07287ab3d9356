"""Name jobs (N1-N5)."""

from pyspark.sql import functions as F

from ..operators import naming
from .fixtures import view
from .registry import query

# ASCII identity key in SQL, step by step, for oracles over ``raw_names``
NAMED = """
cleaned AS (SELECT *, trim(regexp_replace(raw, '[ \\t\\r\\n]+', ' ', 'g')) AS s FROM raw_names),
shown AS (SELECT *, CASE WHEN length(s) >= 2 AND s LIKE '"%"' THEN trim(substr(s, 2, length(s) - 2)) ELSE s END AS display
  FROM cleaned),
swapped AS (SELECT *, CASE WHEN regexp_full_match(display, '[^,]{2,60}, +[^,]{2,60}')
    AND NOT regexp_matches(trim(split_part(display, ',', 2)),
      '^(?i)(LTD|INC|LLC|L\\.L\\.C\\.|CORP|CO|PLC|GMBH|S\\.A\\.|S\\.R\\.L\\.|SA|SARL|AG|NV|BV|AB|AS|OY|PTE|PTY|LLP|LP|JSC|OAO|OOO|PAO|ZAO|A\\.S\\.|D\\.O\\.O\\.)')
  THEN trim(split_part(display, ',', 2)) || ' ' || trim(split_part(display, ',', 1)) ELSE display END AS sw FROM shown),
named AS (SELECT *, lower(trim(replace(sw, ' ', ''), '''"`')) AS match_key FROM swapped)
"""


@query("n1_name_standardisation", views="raw_names", oracle=f"""
WITH {NAMED}
SELECT match_key, replace(replace(match_key, '(', ''), ')', '') AS relaxed_key, count(*) AS n_rows,
       count(DISTINCT raw) AS n_spellings, arg_min(display, ord) AS first_display
FROM named WHERE match_key <> '' GROUP BY match_key
""")
def _(x):
    return naming.standardise_names(x.view("raw_names"))


@query("n2_name_triage", views="raw_names", oracle="""
WITH r AS (SELECT raw, v, length(trim(raw)) AS n,
    CASE WHEN v = 6 AND length(raw) = 5 THEN 'Excelの日付シリアル値が名前として混入した疑い'
         WHEN v = 6 THEN '数字のみで人名・団体名として成立しない' END AS bad,
    CASE WHEN v = 7 AND length(raw) <= 3 THEN CAST(length(raw) AS STRING) || '文字と短く、照合時に誤検知が多発する見込み'
         WHEN v = 4 THEN '別名マーカーを分解しきれなかった。手動で名前を切り出す必要がある' END AS odd
  FROM raw_names),
spelled AS (SELECT raw, count(*) AS n, any_value(bad) AS bad, any_value(odd) AS odd FROM r GROUP BY raw)
SELECT CASE WHEN bad IS NOT NULL THEN 'INVALID' WHEN odd IS NOT NULL THEN 'REVIEW' ELSE 'OK' END AS verdict,
       coalesce(bad, odd, '') AS reason, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_spellings
FROM spelled GROUP BY ALL
""")
def _(x):
    return naming.triage_names(x.view("raw_names"))


@query("n3_alias_explosion", views="raw_names", oracle="""
WITH p AS (
  SELECT ord, CAST(0 AS INT) AS pos, v, CASE
      WHEN v IN (0, 10) THEN trim(head) || ' ' || trim(tail)
      WHEN v IN (1, 4) THEN head || ' ' || tail
      ELSE raw END AS alias FROM raw_names
  UNION ALL SELECT ord, 1, v, head || ' ALPHA ' || tail FROM raw_names WHERE v = 4
  UNION ALL SELECT ord, 2, v, seg || ' ' || tail FROM raw_names WHERE v = 4),
k AS (SELECT ord, pos, alias, lower(trim(replace(
   CASE WHEN v = 2 AND NOT regexp_matches(split_part(alias, ', ', 2), '^(?i)(CO|AS|SA|AG|AB|LP|INC|PTE|PTY|OY|NV|BV)')
        THEN split_part(alias, ', ', 2) || ' ' || split_part(alias, ', ', 1) ELSE alias END, ' ', ''), '''"`')) AS match_key FROM p)
SELECT ord, match_key, arg_min(alias, pos) AS alias, min(pos) AS pos, count(*) OVER (PARTITION BY ord) AS fan_out
FROM k GROUP BY ord, match_key
""")
def _(x):
    return naming.explode_aliases(x.view("raw_names"))


@view("remarks")
def _(d):
    """Remark cells as old and new list files write them; twelve shapes by order key."""
    return f"""
SELECT o_orderkey AS id, CASE o_orderkey % 12
    WHEN 0 THEN '制裁リスト（財務省：テロリスト等／OFAC：SDN）'
    WHEN 1 THEN 'OFAC SDN ' || CAST(o_orderkey % 100 AS STRING)
    WHEN 2 THEN '3. タリバーン関係者'
    WHEN 3 THEN '財務省　' || CAST(o_orderkey % 50 AS STRING) || '.ハイチ'
    WHEN 4 THEN '外為法 ' || CAST(2000 + o_orderkey % 24 AS STRING)
    WHEN 5 THEN '制裁リスト（12.ロシア連邦（個人））'
    WHEN 6 THEN 'METI外国ユーザーリスト'
    WHEN 7 THEN ''
    WHEN 8 THEN 'UK FCDO'
    WHEN 9 THEN 'タリバーン関係者等、3.テロリスト等 (1)'
    WHEN 10 THEN '制裁リスト（legacy：外為法／経産省）'
    ELSE '30.ロシア連邦(特定銀行）' END AS remark
FROM {d.t('orders')}
"""


@query("n4_category_bridge", views="remarks", oracle="""
WITH texts AS (SELECT remark, id % 12 AS v, count(*) AS n FROM remarks GROUP BY ALL),
pairs AS (
  SELECT n, CASE WHEN v IN (0, 2, 3, 5, 9, 11) THEN '財務省' WHEN v = 1 THEN 'OFAC' WHEN v = 6 THEN '経産省'
      WHEN v = 8 THEN 'UK FCDO' ELSE 'legacy' END AS source,
    CASE v WHEN 0 THEN 'テロリスト等' WHEN 2 THEN 'タリバーン関係者等' WHEN 3 THEN 'ハイチ共和国' WHEN 4 THEN remark
      WHEN 5 THEN 'ロシア連邦(個人)' WHEN 9 THEN 'タリバーン関係者等、3.テロリスト等(1)' WHEN 10 THEN '外為法'
      WHEN 11 THEN 'ロシア連邦(特定銀行)' ELSE '' END AS category FROM texts
  UNION ALL SELECT n, 'OFAC', 'SDN' FROM texts WHERE v = 0
  UNION ALL SELECT n, '経産省', '' FROM texts WHERE v = 10)
SELECT source, category, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_remarks FROM pairs GROUP BY ALL
""")
def _(x):
    return naming.bridge_remarks(x.view("remarks"))


@view("notices")
def _(d):
    """Notice texts: a whole document followed by a labelled original-script value; shapes by document id."""
    return f"""
SELECT doc_id AS id, doc_id % 8 AS v, CASE doc_id % 8
    WHEN 0 THEN text || ' (original script: Иван ' || CAST(doc_id AS STRING) || ')'
    WHEN 1 THEN text || ' original scipt： 山田 ' || CAST(doc_id AS STRING) || ' 生年月日：1960'
    WHEN 2 THEN text || ' (original script: Latin Only)'
    WHEN 3 THEN text || ' original script: Иван без конца'
    WHEN 4 THEN text || ' (Original Script: أحمد ' || CAST(doc_id AS STRING) || '; ) (original script: أحمد  ' || CAST(doc_id AS STRING) || ')'
    WHEN 5 THEN text || ' originalscript: （original script: 李 ' || CAST(doc_id AS STRING) || '）'
    ELSE text END AS notice
FROM {d.t('documents')}
"""


@query("n5_original_scripts", views="notices", oracle="""
SELECT id, CAST(0 AS INT) AS pos,
  CASE v WHEN 0 THEN 'Иван ' WHEN 1 THEN '山田 ' WHEN 4 THEN 'أحمد ' ELSE '李 ' END || CAST(id AS STRING) AS name,
  CASE v WHEN 0 THEN 'иван' WHEN 1 THEN '山田' WHEN 4 THEN 'أحمد' ELSE '李' END || CAST(id AS STRING) AS match_key
FROM notices WHERE v IN (0, 1, 4, 5)
""")
def _(x):
    return naming.extract_original_scripts(x.view("notices"), "id", "notice").select("id", "pos", "name", "match_key")
