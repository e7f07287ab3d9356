"""Input views derived from the driver tables, written once for Spark and DuckDB.

A view is SQL text; ``Dialect`` hides the few functions that the engines name differently.  The
views are narrow projections and unions, so the work of a query on them grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Dialect:
    def __init__(self, engine: str, sf_dir: str = ""):
        self.spark = engine == "spark"
        self.sf_dir = sf_dir

    def t(self, name: str) -> str:
        return f"parquet.`{self.sf_dir}/{name}.parquet`" if self.spark else name

    def sha(self, x: str) -> str:
        return f"sha2({x}, 256)" if self.spark else f"sha256({x})"

    def ms(self, ts: str) -> str:
        return f"unix_millis(CAST({ts} AS TIMESTAMP))" if self.spark else f"epoch_ms({ts})"

    def iso(self, ts: str) -> str:
        if self.spark:
            return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
        return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"

    def arr(self, *xs: str) -> str:
        return f"array({', '.join(xs)})" if self.spark else f"[{', '.join(xs)}]"

    def div(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.spark else f"({a} // {b})"

    def explode(self, arr: str, alias: str) -> str:
        return f"explode({arr}) AS {alias}" if self.spark else f"unnest({arr}) AS {alias}"

    def range(self, lo: str, hi: str) -> str:
        """Inclusive integer range."""
        return f"sequence({lo}, {hi})" if self.spark else f"generate_series({lo}, {hi})"

    def set_digest(self, member: str) -> str:
        """Aggregate: the order-independent set digest of ``member``."""
        word = "CAST(conv({0}, 16, 10) AS BIGINT)" if self.spark else "CAST(('0x' || {0}) AS BIGINT)"
        sums = [f"CAST(sum({word.format(f'substr({self.sha(member)}, {1 + 8 * i}, 8)')}) AS STRING)" for i in range(8)]
        return self.sha(f"concat_ws('|', CAST(count({member}) AS STRING), {', '.join(sums)})")

    def q(self, name: str) -> str:
        return f"`{name}`" if self.spark else f'"{name}"'

    def lines(self, text: str) -> str:
        return f"split({text}, '\\n')" if self.spark else f"string_split({text}, chr(10))"


VIEWS: dict[str, tuple[list[str], object]] = {}


def view(name: str, *deps: str):
    def register(fn):
        VIEWS[name] = (list(deps), fn)
        return fn

    return register


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(name: str) -> None:
        for dep in VIEWS[name][0]:
            visit(dep)
        if name not in out:
            out.append(name)

    for name in names:
        visit(name)
    return out


def with_clause(names: list[str], d: Dialect) -> str:
    parts = [f"{n} AS ({VIEWS[n][1](d)})" for n in _closure(names)]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(with_clause([name], Dialect("spark", sf_dir)) + f"SELECT * FROM {name}")


def oracle(names: list[str], sql: str) -> str:
    """Prefix the oracle body with the CTEs it uses; the body may start its own WITH list."""
    head = with_clause(names, Dialect("duckdb"))
    body = sql.strip()
    if head and body.upper().startswith("WITH "):
        return head.rstrip() + ",\n" + body[5:]
    return head + body


# --- F1: raw names -----------------------------------------------------------------------

@view("parties")
def _(d):
    """One row per named party of the three name tables."""
    return f"""
SELECT c_custkey AS id, c_custkey * 3 AS ord, 'Customer' AS head, lpad(CAST(c_custkey AS STRING), 9, '0') AS tail,
       c_mktsegment AS seg, c_nationkey AS nation FROM {d.t('customer')}
UNION ALL
SELECT s_suppkey, s_suppkey * 3 + 1, 'Supplier', lpad(CAST(s_suppkey AS STRING), 9, '0'), 'AGENCY', s_nationkey
FROM {d.t('supplier')}
UNION ALL
SELECT p_partkey, p_partkey * 3 + 2, p_name, p_brand, p_type, p_size FROM {d.t('part')}
"""


@view("raw_names", "parties")
def _(d):
    """Names as a list cell may hold them; twelve spellings by id."""
    return f"""
SELECT id, ord, head, tail, seg, id % 12 AS v,
  CASE id % 3 WHEN 0 THEN 'OFAC' WHEN 1 THEN '財務省' ELSE '経産省' END AS source,
  CAST(id % 7 AS STRING) AS code,
  CASE id % 12
    WHEN 0 THEN head || '   ' || tail
    WHEN 1 THEN '"' || head || ' ' || tail || '"'
    WHEN 2 THEN seg || ', ' || head || ' ' || tail
    WHEN 3 THEN upper(head) || ' ' || tail || ' CO, LTD.'
    WHEN 4 THEN head || ' ' || tail || ' (a.k.a. ' || head || ' ALPHA ' || tail || '; a.k.a. ' || seg || ' ' || tail || ')'
    WHEN 5 THEN head || ' (' || tail || ')'
    WHEN 6 THEN CASE WHEN id % 24 = 6 THEN lpad(CAST(id % 100000 AS STRING), 5, '0') ELSE lpad(CAST(id AS STRING), 8, '7') END
    WHEN 7 THEN substr(seg, 1, 3)
    WHEN 8 THEN upper(head) || ' ' || tail
    WHEN 9 THEN head || ' ' || tail
    WHEN 10 THEN head || ' ' || chr(9) || chr(13) || chr(10) || ' ' || tail || ' '
    ELSE '''' || head || ' ' || tail END AS raw
FROM parties
"""


# --- F3: master, incoming records, screening queries --------------------------------------

DELISTED = "全ての出所から掲載が無くなったため無効化（制裁解除または統廃合）"
WEAK_REASON = "OFAC現役Weak Aliasのため通常スクリーニング対象外"
DIGITS = "数字のみで人名・団体名として成立しない（x）"


@view("master")
def _(d):
    """Master table: one row per customer name, and a bracketed twin of every twentieth."""
    none = "CAST(array() AS array<string>)" if d.spark else "CAST([] AS VARCHAR[])"
    return f"""
SELECT 'customer' || lpad(CAST(c_custkey AS STRING), 9, '0') AS match_key,
  'Customer ' || lpad(CAST(c_custkey AS STRING), 9, '0') AS display_name,
  CASE WHEN c_custkey % 6 = 5 OR c_custkey % 10 = 9 THEN '無効' ELSE '有効' END AS status,
  '制裁リスト' AS risk_type, '高' AS risk_level,
  1500000000000 + c_custkey * 60000 AS first_seen_ms, 1600000000000 + c_custkey * 61000 AS last_updated_ms,
  CASE c_custkey % 6 WHEN 0 THEN {d.arr("'OFAC'")} WHEN 1 THEN {d.arr("'OFAC'", "'財務省'")}
    WHEN 2 THEN {d.arr("'財務省'")} WHEN 3 THEN {d.arr("'経産省'")} WHEN 4 THEN {d.arr("'legacy'")} ELSE {none} END AS sources,
  CASE c_custkey % 6 WHEN 0 THEN {d.arr("'OFAC:SDN'")} WHEN 1 THEN {d.arr("'OFAC:CONS'", "'財務省:テロリスト等'")}
    WHEN 2 THEN {d.arr("'財務省:ハイチ共和国'")} WHEN 4 THEN {d.arr("'legacy:外為法'")} ELSE {none} END AS categories,
  CASE c_custkey % 6 WHEN 0 THEN '制裁リスト（OFAC：SDN）' WHEN 1 THEN '制裁リスト（財務省：テロリスト等／OFAC：CONS）'
    WHEN 2 THEN '制裁リスト（財務省：ハイチ共和国）' WHEN 3 THEN '制裁リスト（経産省）' WHEN 4 THEN '制裁リスト（外為法）'
    ELSE '制裁リスト' END AS remark,
  CASE WHEN c_custkey % 12 = 5 THEN '{DELISTED}' WHEN c_custkey % 12 = 11 THEN '{WEAK_REASON}'
    WHEN c_custkey % 10 = 9 THEN '{DIGITS}' ELSE '' END AS invalid_reason,
  CASE WHEN c_custkey % 12 = 11 THEN 'OFAC_WEAK_ALIAS_CURRENT' ELSE '' END AS review_flag,
  {d.arr("'Customer ' || lpad(CAST(c_custkey AS STRING), 9, '0')")} AS variants
FROM {d.t('customer')}
UNION ALL
SELECT 'customer(' || lpad(CAST(c_custkey AS STRING), 9, '0') || ')',
  'Customer (' || lpad(CAST(c_custkey AS STRING), 9, '0') || ')', '有効', '制裁リスト', '高',
  1500000000000 + c_custkey, 1600000000000 + c_custkey, {d.arr("'経産省'")}, {none}, '制裁リスト（経産省）', '', '',
  {d.arr("'Customer (' || lpad(CAST(c_custkey AS STRING), 9, '0') || ')'")}
FROM {d.t('customer')} WHERE c_custkey % 20 = 0
"""


@view("incoming")
def _(d):
    """One fetch of the OFAC source: known names, upper-case repeats, new, short, numeric and damaged names."""
    return f"""
SELECT 'Customer ' || lpad(CAST(c_custkey AS STRING), 9, '0') AS name,
  CASE WHEN c_custkey % 3 = 0 THEN 'SDN' ELSE 'CONS' END AS category, c_custkey AS source_id, c_custkey * 10 AS ord
FROM {d.t('customer')} WHERE c_custkey % 4 < 2 OR c_custkey % 12 = 11
UNION ALL
SELECT upper('Customer ' || lpad(CAST(c_custkey AS STRING), 9, '0')), 'EXTRA', c_custkey, c_custkey * 10 + 1
FROM {d.t('customer')} WHERE c_custkey % 8 = 0
UNION ALL
SELECT CASE s_suppkey % 5 WHEN 0 THEN lpad(CAST(s_suppkey AS STRING), 9, '1') WHEN 1 THEN 'S' || CAST(s_suppkey % 10 AS STRING)
    WHEN 2 THEN 'Supplier ' || CAST(s_suppkey AS STRING) || '不明'
    WHEN 3 THEN '"Supplier ' || lpad(CAST(s_suppkey AS STRING), 9, '0') || '"'
    ELSE 'Supplier  ' || lpad(CAST(s_suppkey AS STRING), 9, '0') END,
  'SDN', s_suppkey, s_suppkey * 10 + 2 FROM {d.t('supplier')}
"""


@view("screen_queries")
def _(d):
    """Names to screen, one per order: exact, bracketed, upper case, ambiguous and unknown."""
    return f"""
SELECT o_orderkey AS query_id, CASE o_orderkey % 5
    WHEN 0 THEN 'Customer ' || lpad(CAST(o_custkey AS STRING), 9, '0')
    WHEN 1 THEN 'Customer (' || lpad(CAST(o_custkey AS STRING), 9, '0') || ')'
    WHEN 2 THEN upper('Customer ' || lpad(CAST(o_custkey AS STRING), 9, '0'))
    WHEN 3 THEN '(Customer) ' || lpad(CAST(o_custkey AS STRING), 9, '0')
    ELSE 'Unknown ' || CAST(o_custkey AS STRING) END AS query
FROM {d.t('orders')}
"""
