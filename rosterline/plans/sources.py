"""Source queries: list files, party XML, document lines, pages, audits and their gates."""

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.rows import explode_once, spread
from ..sources import documents as D
from ..sources import sinks
from ..sources import party_xml as X
from ..sources import text as T
from .fixtures import view
from .registry import query

N9 = "lpad(CAST(c_custkey AS STRING), 9, '0')"
KEY = "c_custkey"


# --- headerless list files ---------------------------------------------------------------

@view("primary_lines")
def _(d):
    """Lines of a headerless primary file: quoted names, null marks, surplus cells, short and empty lines, a stray header."""
    return f"""
SELECT 'f' || CAST({KEY} % 4 AS STRING) AS file, {KEY} AS ord, CASE WHEN {KEY} = 3 THEN 'ent_num,SDN_Name,x' WHEN {KEY} % 41 = 7 THEN chr(26) WHEN {KEY} % 43 = 8 THEN '-0- ,-0-,-0-'
  ELSE CAST({KEY} AS STRING) || CASE WHEN {KEY} % 10 = 4 THEN ',"CUSTOMER ""' || {N9} || '"", Ltd"' WHEN {KEY} % 10 = 5 THEN ',Customer ' || {N9} || ' (a.k.a. Alias ' || {N9} || ')'
      WHEN {KEY} % 10 = 6 THEN ',-0-' ELSE ',"Customer ' || {N9} || '" ' END
    || ',individual,' || CASE WHEN {KEY} % 3 = 0 THEN '-0- ' ELSE '"PROG ' || CAST({KEY} % 5 AS STRING) || '"' END || ',-0-,-0-,-0-,-0-,-0-,-0-,-0-,'
    || CASE WHEN {KEY} % 6 = 1 THEN 'remark one, two,"three"' ELSE '-0- ' END END AS value
FROM {d.t('customer')}
"""


@view("alias_lines")
def _(d):
    return f"""SELECT 'a' AS file, {KEY} AS ord, CAST({KEY} + CASE WHEN {KEY} % 20 = 1 THEN 500000000 ELSE 0 END AS STRING) || ',' || CAST({KEY} AS STRING) || ',aka,' ||
  CASE WHEN {KEY} % 8 = 3 THEN '-0-' ELSE '"Other ' || {N9} || '"' END || ',-0- ' AS value FROM {d.t('customer')}"""


PRIMARY = f"""
keyed AS (SELECT *, ord AS k, lpad(CAST(ord AS STRING), 9, '0') AS n FROM primary_lines WHERE ord <> 3 AND ord % 41 <> 7 AND ord % 43 <> 8),
prim AS (SELECT ord, CAST(k AS STRING) AS ent_num, CASE WHEN k % 10 = 4 THEN 'CUSTOMER "' || n || '", Ltd' WHEN k % 10 = 5 THEN 'Customer ' || n || ' (a.k.a. Alias ' || n || ')' WHEN k % 10 = 6 THEN NULL ELSE 'Customer ' || n END AS name,
  'individual' AS sdn_type, CASE WHEN k % 3 = 0 THEN NULL ELSE 'PROG ' || (k % 5) END AS program, CASE WHEN k % 6 = 1 THEN 'remark one,two,three' END AS remarks FROM keyed)
"""


def _primary(x):
    return T.parse_headerless(spread(x.view("primary_lines"), "value"), T.PRIMARY_COLUMNS)


@query("s1_headerless_list", views="primary_lines", oracle=f"WITH {PRIMARY} SELECT ord, ent_num, name, sdn_type, program, remarks FROM prim")
def _(x):
    return _primary(x).select("ord", "ent_num", "name", "sdn_type", "program", "remarks")


@query("s2_list_records", views="primary_lines alias_lines", oracle=f"""
WITH {PRIMARY},
al AS (SELECT CAST(ord + CASE WHEN ord % 20 = 1 THEN 500000000 ELSE 0 END AS STRING) AS ent_num, 'Other ' || lpad(CAST(ord AS STRING), 9, '0') AS name FROM alias_lines WHERE ord % 8 <> 3),
r AS (SELECT ent_num, split_part(name, ' (a.k.a.', 1) AS name, program FROM prim WHERE name IS NOT NULL
  UNION ALL SELECT ent_num, 'Alias ' || lpad(ent_num, 9, '0'), program FROM prim WHERE name LIKE '%a.k.a.%'
  UNION ALL SELECT al.ent_num, al.name, p.program FROM al LEFT JOIN prim p ON p.ent_num = al.ent_num)
SELECT 'OFAC' AS source, 'SDN' AS category, name, ent_num AS source_id, coalesce(program, '') AS program FROM r
""")
def _(x):
    return T.list_records(_primary(x), T.parse_headerless(spread(x.view("alias_lines"), "value"), T.ALIAS_COLUMNS), "SDN")


@view("file_lines")
def _(d):
    """Lines of many fetched files, one file per nation and segment: lists, HTML pages, JSON bodies, empty files, headless files."""
    f = "CAST(c_nationkey AS STRING) || c_mktsegment"
    return f"""
SELECT {f} AS file, {KEY} AS ord, CASE c_nationkey % 6 WHEN 1 THEN CASE WHEN {KEY} % 3 = 0 THEN '  ' ELSE '  <!DOCTYPE HTML><p>' END WHEN 2 THEN '{{"error": 1}}' WHEN 3 THEN '  ' WHEN 4 THEN 'name,x'
  ELSE CAST({KEY} AS STRING) || ',"x, y"' END AS value FROM {d.t('customer')}
"""


@query("q2_content_plausibility", views="file_lines", oracle="""
WITH g AS (SELECT file, bool_or(trim(value) <> '') AS filled, arg_min(lower(trim(value)), ord) FILTER (trim(value) <> '') AS head, count(*) FILTER (regexp_matches(value, '^[0-9]+,')) AS n FROM file_lines GROUP BY file)
SELECT file, CASE WHEN NOT filled THEN 'EMPTY_BODY' WHEN head LIKE '<!doctype html%' OR head LIKE '<html%' OR head LIKE '{%' OR head LIKE '[%' THEN 'NOT_A_LIST' ELSE 'NO_PARTY_ROW' END AS violation
FROM g WHERE NOT filled OR head LIKE '<%' OR head LIKE '{%' OR n = 0
""")
def _(x):
    return T.content_violations(x.view("file_lines"))


HEAD = ["区分", "番号", "告示日付", "氏名（日本語）", "氏名（英語）", "外務省告示情報"]


@view("list_headers")
def _(d):
    """Header lines of many snapshot files, one per supplier: exact, missing, extra and swapped columns."""
    full = ",".join(HEAD)
    return f"""
SELECT 's' || CAST(s_suppkey AS STRING) AS file, CASE s_suppkey % 9 WHEN 1 THEN '{",".join(HEAD[:-1])}' WHEN 2 THEN '{full},新列' WHEN 3 THEN '{",".join([HEAD[1], HEAD[0]] + HEAD[2:])}'
  WHEN 4 THEN '{full.replace("告示日付", "告示日")}' ELSE '{full}' END AS header FROM {d.t('supplier')}
"""


@query("q1_header_contract", views="list_headers", oracle="""
WITH k AS (SELECT file, CAST(substr(file, 2) AS BIGINT) % 9 AS v FROM list_headers)
SELECT file, 'MISSING' AS violation, '外務省告示情報' AS "column" FROM k WHERE v = 1
UNION ALL SELECT file, 'EXTRA', '新列' FROM k WHERE v = 2
UNION ALL SELECT file, 'REORDERED', '' FROM k WHERE v = 3
UNION ALL SELECT file, 'MISSING', '告示日付' FROM k WHERE v = 4
UNION ALL SELECT file, 'EXTRA', '告示日' FROM k WHERE v = 4
""")
def _(x):
    return T.header_violations(x.view("list_headers"), HEAD)


@view("list_lines")
def _(d):
    """CSV lines of the 32-column list: a header per file, then records; empty and repeated ids planted."""
    head = ",".join(K.LIST_COLUMNS)
    cells = ["'1'", f"CASE WHEN {KEY} % 101 = 5 THEN '' WHEN {KEY} % 103 = 6 THEN CAST({KEY} - 4 AS STRING) ELSE CAST({KEY} AS STRING) END", "'2020'", "'N'", "'個人'", "'顧客'",
             f"'\"Customer, ' || {N9} || '\"'"] + ["''"] * 24 + [f"'notice ' || {N9}"]
    return f"""
SELECT DISTINCT 'g' || CAST({KEY} % 4 AS STRING) AS file, CAST(-1 AS BIGINT) AS ord, '{head}' AS value FROM {d.t('customer')}
UNION ALL SELECT 'g' || CAST({KEY} % 4 AS STRING), {KEY}, {" || ',' || ".join(cells)} FROM {d.t('customer')}
"""


@query("s5_contract_list", views="list_lines", oracle="""
SELECT file, ord, CASE WHEN ord % 101 = 5 THEN '' WHEN ord % 103 = 6 THEN CAST(ord - 4 AS STRING) ELSE CAST(ord AS STRING) END AS record_id, '顧客' AS name_ja,
  'Customer, ' || lpad(CAST(ord AS STRING), 9, '0') AS name_en, 'notice ' || lpad(CAST(ord AS STRING), 9, '0') AS notice FROM list_lines WHERE ord >= 0
""")
def _(x):
    return T.parse_list(x.view("list_lines")).select(
        "file", "ord", F.col("番号").alias("record_id"), F.col("氏名（日本語）").alias("name_ja"), F.col("氏名（英語）").alias("name_en"), F.col("外務省告示情報").alias("notice"))


@query("s5_record_ids", views="list_lines", oracle="""
WITH r AS (SELECT file, CASE WHEN ord % 101 = 5 THEN '' WHEN ord % 103 = 6 THEN CAST(ord - 4 AS STRING) ELSE CAST(ord AS STRING) END AS record_id FROM list_lines WHERE ord >= 0)
SELECT file, record_id, count(*) AS n_rows, CASE WHEN record_id = '' THEN 'EMPTY_ID' ELSE 'DUPLICATE_ID' END AS violation FROM r GROUP BY file, record_id HAVING record_id = '' OR count(*) > 1
""")
def _(x):
    return T.list_violations(T.parse_list(x.view("list_lines")))


# --- list files as they come: charsets, compression, line breaks inside cells ---------------

FILE_KINDS = [("utf-8", "none"), ("utf-8-sig", "none"), ("cp932", "none"), ("utf-8", "gzip")]


@view("list_cells")
def _(d):
    """Records of the 32-column list as one CSV text each, with quotes and line breaks in the notice; kind: which files they go to."""
    cells = ["'1'", f"CAST({KEY} AS STRING)", "'2020'", "'N'", "'個人'", "'顧客 ソ'", f"'\"Customer, ' || {N9} || '\"'"] + ["''"] * 24 + [
        f"'\"notice ' || {N9} || chr(10) || '\"\"two\"\", ' || chr(10) || 'ﾃｽﾄ\"'"]
    return f"SELECT {KEY} AS ord, {KEY} % 6 AS kind, {' || chr(44) || '.join(cells)} AS value FROM {d.t('customer')}"


def _write_list_files(rows, folder: str, header: str, charset: str, compression: str) -> None:
    """One list file for each range of records: the header, then the records, in a charset."""

    def lines(batches):
        body = "" if charset != "utf-8-sig" else "\ufeff"
        for batch in batches:
            texts = ([body + header] if body is not None else []) + batch.column("value").to_pylist()
            body = None
            yield pa.RecordBatch.from_arrays([pa.array([t.encode("utf-8" if charset == "utf-8-sig" else charset) for t in texts], pa.binary())], ["value"])

    dealt = rows.repartitionByRange("ord").sortWithinPartitions("ord").select("value")
    dealt.mapInArrow(lines, "value binary").select(F.col("value").cast("string")).write.option("compression", compression).text(folder)


def _list_files(x) -> str:
    folder, header = sinks.shared_folder(x.spark), ",".join(K.LIST_COLUMNS)
    for kind, (charset, compression) in enumerate(FILE_KINDS):
        _write_list_files(x.view("list_cells").filter(F.col("kind") == kind), f"{folder}/k{kind}", header, charset, compression)
    return folder


@query("s5_list_files", views="list_cells", oracle="""
SELECT 'k' || kind AS folder, CAST(ord AS STRING) AS record_id, '顧客 ソ' AS name_ja, 'Customer, ' || lpad(CAST(ord AS STRING), 9, '0') AS name_en,
  'notice ' || lpad(CAST(ord AS STRING), 9, '0') || chr(10) || '"two", ' || chr(10) || 'ﾃｽﾄ' AS notice FROM list_cells WHERE kind < 4
""")
def _(x):
    """The list written as files (UTF-8, BOM, legacy charset, gzip) and read by the splittable reader; the file gates must be empty."""
    folder = _list_files(x)
    paths = [f"{folder}/k{kind}" for kind in range(len(FILE_KINDS))]
    return T.read_list(x.spark, paths).select(
        F.element_at(F.split("file", "/"), -2).alias("folder"), F.col("番号").alias("record_id"), F.col("氏名（日本語）").alias("name_ja"),
        F.col("氏名（英語）").alias("name_en"), F.col("外務省告示情報").alias("notice"))


@query("s5_file_gates", views="list_cells", oracle="""
SELECT DISTINCT 'headless' AS folder, 'MISSING' AS violation, '外務省告示情報' AS "column" FROM list_cells WHERE kind = 4
UNION ALL SELECT DISTINCT 'torn', 'UNBALANCED_QUOTES', '' FROM list_cells WHERE kind = 5
""")
def _(x):
    """Gates over files: one set of files misses a column, another ends inside a quoted cell."""
    folder = sinks.shared_folder(x.spark)
    rows = x.view("list_cells")
    _write_list_files(rows.filter("kind = 4"), f"{folder}/headless", ",".join(K.LIST_COLUMNS[:-1]), "utf-8", "none")
    _write_list_files(rows.filter("kind = 5"), f"{folder}/torn", ",".join(K.LIST_COLUMNS) + '\n"', "cp932", "none")
    records = T.read_records(x.spark, [f"{folder}/headless", f"{folder}/torn"])
    torn = T.file_violations(records).select("file", "violation", F.lit("").alias("column"))
    heads = T.header_violations(T.first_lines(records.filter("violation IS NULL")), K.LIST_COLUMNS)
    return torn.unionByName(heads).select(F.element_at(F.split("file", "/"), -2).alias("folder"), "violation", "column").distinct()


CATEGORIES = {str(i): f"区分{i}" for i in range(5)}


@view("list_rows")
def _(d):
    """List records with several names per cell, brackets holding birth notes, null marks and repeated spellings."""
    return f"""
SELECT CAST({KEY} % 7 AS STRING) AS {d.q('区分')}, CAST({KEY} AS STRING) AS {d.q('番号')}, '-' AS {d.q('氏名（日本語）')}, 'Customer ' || {N9} AS {d.q('氏名（英語）')},
  CASE {KEY} % 4 WHEN 0 THEN 'Ali ' || {N9} || '; Ben ' || {N9} WHEN 1 THEN 'Cleo ' || {N9} || ' (passport A; B); CUSTOMER ' || {N9} WHEN 2 THEN 'Dora (x; y) ' || {N9} ELSE 'なし' END AS {d.q('別名・別称（英語）')}
FROM {d.t('customer')}
"""


@query("s6_list_names", views="list_rows", oracle="""
WITH r AS (SELECT "番号" AS record_id, "区分" AS code, CAST("番号" AS BIGINT) AS k, lpad("番号", 9, '0') AS n FROM list_rows),
p AS (SELECT record_id, code, 'Customer ' || n AS name FROM r UNION ALL SELECT record_id, code, 'Ali ' || n FROM r WHERE k % 4 = 0 UNION ALL SELECT record_id, code, 'Ben ' || n FROM r WHERE k % 4 = 0
  UNION ALL SELECT record_id, code, 'Cleo ' || n FROM r WHERE k % 4 = 1 UNION ALL SELECT record_id, code, 'Dora (x; y) ' || n FROM r WHERE k % 4 = 2)
SELECT record_id, lower(replace(name, ' ', '')) AS match_key, name, code, CASE WHEN CAST(code AS INT) < 5 THEN '区分' || code ELSE '' END AS category, CAST(code AS INT) >= 5 AS unknown_code FROM p
""")
def _(x):
    return T.list_names(x.view("list_rows"), CATEGORIES)


# --- party XML ---------------------------------------------------------------------------

@view("party_elements")
def _(d):
    """DistinctParty elements as text: several scripts per name, false identities, repeated and missing names, address features."""
    doc = lambda *vs: "'<DocumentedName><DocumentedNamePart>' || " + " || ".join(vs) + " || '</DocumentedNamePart></DocumentedName>'"
    val = lambda g, s, t: f"'<NamePartValue NamePartGroupID=\"{g}\" ScriptID=\"{s}\">' || {t} || '</NamePartValue>'"
    n = N9
    return f"""
SELECT {KEY} AS k, '<DistinctParty FixedRef="' || CAST({KEY} AS STRING) || '"><Profile ID="p' || CAST({KEY} AS STRING) || '">'
  || '<Identity False="true"><Alias Primary="true">' || {doc(val(1, 215, "'False'"))} || '</Alias></Identity>'
  || CASE WHEN {KEY} % 31 = 4 THEN '<Identity/>' ELSE '<Identity False="false"><Alias Primary="true" LowQuality="false">' || {doc(val(1, 215, "'Customer'"), val(2, 220, "'Клиент'"), val(3, 215, f"'  ' || {n}"), val(4, 220, n))} || '</Alias>'
  || '<Alias Primary="false" LowQuality="true">' || {doc(val(1, 215, f"CASE WHEN {KEY} % 5 = 0 THEN 'Customer ' || {n} ELSE 'Weak ' || {n} END"))} || '</Alias></Identity>' END
  || CASE WHEN {KEY} % 3 = 0 THEN '<Feature ID="f' || CAST({KEY} AS STRING) || '" FeatureTypeID="' || CAST(340 + {KEY} % 4 AS STRING) || '"><FeatureVersion ID="v' || CAST({KEY} AS STRING) || '"><VersionDetail>addr' || {n} || '</VersionDetail>'
    || CASE WHEN {KEY} % 9 = 0 THEN '<VersionDetail>second' || {n} || '</VersionDetail>' ELSE '' END || '</FeatureVersion></Feature>' ELSE '' END
  || '</Profile></DistinctParty>' AS element FROM {d.t('customer')}
"""


@view("entry_elements")
def _(d):
    return f"""SELECT '<SanctionsEntry ProfileID="p' || CAST(o_custkey AS STRING) || '"><SanctionsMeasure><Comment> PROG' || CAST(o_orderkey % 3 AS STRING) || ' </Comment></SanctionsMeasure></SanctionsEntry>' AS element, o_custkey, o_orderkey FROM {d.t('orders')}"""


@view("feature_type_elements")
def _(d):
    """Feature types, one per nation from 340 on; the fourth label is outside the expected form."""
    return f"""SELECT '<FeatureType ID="' || CAST(340 + n_nationkey AS STRING) || '">' || CASE n_nationkey WHEN 0 THEN 'Digital Currency Address - XBT' WHEN 1 THEN 'Digital Currency Address - ETH'
  WHEN 2 THEN 'Vessel Flag' WHEN 3 THEN 'Digital Currency Address: new' ELSE 'Other' END || '</FeatureType>' AS element FROM {d.t('nation')}"""


def _elements(x, name: str, schema: str, distinct: bool = False):
    """Parsed elements; parsing costs most, so the texts are dealt to all tasks first, and a generator keeps later filters from parsing them
    again below that.  ``distinct``: each text once."""
    texts = x.view(name).select("element")
    texts = texts.distinct() if distinct else spread(texts, "element")
    parsed = F.struct(F.from_xml("element", schema, {"mode": "FAILFAST"}).alias("e"))
    return explode_once(texts, [], F.array(parsed), "p").select("p.e.*")


def _parties(x):
    return _elements(x, "party_elements", X.PARTY_SCHEMA)


PARTIES = """
p AS (SELECT k, CAST(k AS STRING) AS id, lpad(CAST(k AS STRING), 9, '0') AS n FROM party_elements),
names AS (SELECT id, 'Customer ' || n AS name, '215' AS script_id, true AS alias_primary, false AS low_quality FROM p WHERE k % 31 <> 4
  UNION ALL SELECT id, 'Клиент ' || n, '220', true, false FROM p WHERE k % 31 <> 4 UNION ALL SELECT id, 'Weak ' || n, '215', false, true FROM p WHERE k % 5 <> 0 AND k % 31 <> 4)
"""


@query("s3_party_names", views="party_elements", oracle=f"""
WITH {PARTIES} SELECT 'OFAC' AS source, 'SDN' AS category, name, id AS source_id, script_id, alias_primary, low_quality, 'advanced_xml_v3' AS format FROM names
""")
def _(x):
    return X.party_names(_parties(x), "SDN")


@query("s3_party_gates", views="party_elements", oracle=f"WITH {PARTIES} SELECT id AS party_id, 'NO_NAME' AS violation FROM p WHERE k % 31 = 4")
def _(x):
    return X.party_violations(_parties(x))


@view("party_files")
def _(d):
    """Party files, one per supplier: root elements in several spellings, some changed."""
    good = "https://sanctionslistservice.ofac.treas.gov/api/PublicationPreview/exports/ADVANCED_XML"
    return f"""
SELECT s_suppkey AS k, 'f' || CAST(s_suppkey AS STRING) AS file, CASE s_suppkey % 8 WHEN 0 THEN '<?xml version="1.0"?>' || chr(10) || '<!-- a > b -->' || '<Sanctions xmlns="{good}" Version="3">'
  WHEN 1 THEN '<s:Sanctions xmlns:s="{good}" Version="3"><x/>' WHEN 2 THEN '<Sanctions Version="3">' WHEN 3 THEN '<Sanctions xmlns="urn:other" Version="3">' WHEN 4 THEN '<Sanctions Version="4" xmlns="{good}">'
  WHEN 5 THEN '<List xmlns="{good}" Version="3">' WHEN 6 THEN 'no xml' ELSE '<Sanctions xmlns:i="urn:i" xmlns="{good}" Version="3" i:a="b">' END AS head FROM {d.t('supplier')}
"""


@query("s3_file_gates", views="party_files", oracle="""
SELECT file, CASE k % 8 WHEN 2 THEN 'NAMESPACE_MISSING' WHEN 3 THEN 'NAMESPACE_CHANGED' WHEN 4 THEN 'VERSION_CHANGED' WHEN 5 THEN 'ROOT_CHANGED' ELSE 'ROOT_MISSING' END AS violation FROM party_files WHERE k % 8 IN (2, 3, 4, 5, 6)
UNION ALL SELECT file, 'NO_PARTIES' FROM party_files WHERE NOT EXISTS (SELECT 1 FROM customer WHERE 'f' || c_nationkey * 7 = file)
UNION ALL SELECT file, 'NAME_PART_TYPES_MISSING' FROM party_files WHERE EXISTS (SELECT 1 FROM customer WHERE 'f' || c_nationkey * 7 = file) AND NOT EXISTS (SELECT 1 FROM nation WHERE 'f' || n_nationkey * 14 = file AND n_nationkey <> 4)
""")
def _(x):
    types = x.table("nation").selectExpr("concat('f', n_nationkey * 14) AS file", "cast(n_nationkey AS string) AS _ID", "CASE WHEN n_nationkey = 4 THEN ' ' ELSE n_name END AS _VALUE")
    parties = x.table("customer").selectExpr("concat('f', c_nationkey * 7) AS file", "c_custkey")
    return X.file_violations(x.view("party_files").select("file", "head"), types, parties)


@query("s4_address_features", views="party_elements entry_elements", oracle=f"""
WITH {PARTIES},
prog AS (SELECT o_custkey AS k, array_to_string(list_sort(list_distinct(list('PROG' || (o_orderkey % 3)))), ' / ') AS program FROM entry_elements GROUP BY 1),
v AS (SELECT p.*, 0 AS pos, 'addr' || n AS address FROM p WHERE k % 3 = 0 UNION ALL SELECT p.*, 1, 'second' || n FROM p WHERE k % 9 = 0)
SELECT id AS party_id, 'p' || id AS profile_id, 'f' || id AS feature_id, 'v' || id AS version_id, id || '/f' || id || '/v' || id || '/' || pos AS source_record_id,
  'DistinctParty[@FixedRef="' || id || '"]/Profile[@ID="p' || id || '"]/Feature[@ID="f' || id || '"]/FeatureVersion[@ID="v' || id || '"]/VersionDetail[' || (pos + 1) || ']' AS evidence_locator,
  CASE WHEN v.k % 31 = 4 THEN '' ELSE 'Customer ' || n END AS entity_name, CASE v.k % 4 WHEN 0 THEN 'XBT' WHEN 1 THEN 'ETH' ELSE '' END AS symbol, address, coalesce(program, '') AS program,
  CASE WHEN v.k % 4 = 3 THEN 'LABEL_CHANGED' END AS violation
FROM v LEFT JOIN prog ON prog.k = v.k WHERE v.k % 4 <> 2
""")
def _(x):
    features = X.address_features(_parties(x), _elements(x, "feature_type_elements", X.FEATURE_TYPE_SCHEMA), _elements(x, "entry_elements", X.ENTRY_SCHEMA, distinct=True))
    return features.withColumn("entity_name", F.regexp_replace("entity_name", " +", " "))


# --- document lines ----------------------------------------------------------------------

@view("doc_lines")
def _(d):
    """Every line of every document with its number."""
    if d.spark:
        return f"SELECT doc_id AS doc, CAST(pos AS BIGINT) AS i, col AS line FROM {d.t('documents')} LATERAL VIEW posexplode(split(text, '\\n')) AS pos, col"
    return "SELECT doc_id AS doc, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS i, unnest(string_split(text, chr(10))) AS line FROM documents"


@view("table_rows", "doc_lines")
def _(d):
    """Lines as table rows: headers, numbered rows, continuations and rows with another mark."""
    return f"""SELECT doc, i, i % 12 = 5 AS is_header, CASE WHEN i % 12 = 5 THEN 'No.' WHEN i % 3 = 0 THEN CAST({d.div('i', '3')} + 1 AS STRING) WHEN i % 11 = 7 THEN 'x' ELSE '' END AS no,
  CASE WHEN i % 4 = 1 THEN '' ELSE trim(line) END AS company, CAST(length(line) AS STRING) AS country FROM doc_lines"""


@query("s9_row_stitching", views="table_rows", oracle="""
WITH r AS (SELECT *, CASE WHEN is_header THEN 'H' WHEN regexp_full_match(no, '[0-9]+') THEN 'N' END AS m FROM table_rows),
w AS (SELECT *, max(CASE WHEN m IS NOT NULL THEN i END) OVER s AS start, max(CASE WHEN m = 'H' THEN i END) OVER s AS tab FROM r WINDOW s AS (PARTITION BY doc ORDER BY i)),
o AS (SELECT * FROM w WHERE tab IS NOT NULL AND NOT is_header AND start % 12 <> 5 AND (m = 'N' OR no = ''))
SELECT doc, start, max(CASE WHEN m = 'N' THEN CAST(no AS BIGINT) END) AS no, count(*) AS n_rows, coalesce(string_agg(company, chr(10) ORDER BY i) FILTER (company <> ''), '') AS company,
  string_agg(country, chr(10) ORDER BY i) AS country FROM o GROUP BY doc, start
""")
def _(x):
    return D.stitch_rows(x.view("table_rows"), ["company", "country"])


STITCHED = """
WITH r AS (SELECT *, CASE WHEN is_header THEN 'H' WHEN regexp_full_match(no, '[0-9]+') THEN 'N' END AS m FROM table_rows),
w AS (SELECT *, max(CASE WHEN m IS NOT NULL THEN i END) OVER s AS start, max(CASE WHEN m = 'H' THEN i END) OVER s AS tab FROM r WINDOW s AS (PARTITION BY doc ORDER BY i)),
o AS (SELECT * FROM w WHERE tab IS NOT NULL AND NOT is_header AND start % 12 <> 5 AND (m = 'N' OR no = ''))
"""


@query("s9_record_lines", views="table_rows", oracle=STITCHED + """
SELECT doc, start, i, CASE WHEN m = 'N' THEN CAST(no AS BIGINT) END AS no, company, country FROM o
""")
def _(x):
    """Records in long form: a record of any length stays spread over rows."""
    return D.record_lines(x.view("table_rows"), ["company", "country"])


@query("s9_folded_records", views="table_rows", oracle=STITCHED + """
SELECT doc, start, coalesce(string_agg(company, chr(10) ORDER BY i) FILTER (company <> ''), '') AS company,
  coalesce(string_agg(country, chr(10) ORDER BY i) FILTER (country <> ''), '') AS country FROM o GROUP BY doc, start
""")
def _(x):
    """The cells of every record as the sink's streaming writer makes them."""
    return sinks.fold_cells(D.record_lines(x.view("table_rows"), ["company", "country"]), ["doc", "start"], ["i"], ["company", "country"], "\n")


@view("numbered_lines", "doc_lines")
def _(d):
    """Lines with planted block headers (some repeated, skipped or deleted), section heads, closing marks, reference numbers and
    published counts (every fourth document is a UN list); some counts are wrong, some break over two lines."""
    most = "max(i) OVER (PARTITION BY doc)"
    persons = f"CAST({d.div(most + ' + 17', '18')} + CASE WHEN doc % 8 = 4 THEN 1 ELSE 0 END AS STRING)"
    entities = f"CAST({d.div(most + ' + 11', '18')} AS STRING)"
    return f"""SELECT doc, i, {d.div('i', '20')} AS page, CASE WHEN i % 30 = 17 THEN 'II 告示第' || CAST(i AS STRING) WHEN i % 30 = 11 THEN '(了)'
    WHEN i = 3 AND doc % 12 = 8 THEN '計 ' || {persons} || ' 個人及' WHEN i = 4 AND doc % 12 = 8 THEN 'び ' || {entities} || ' 団体' WHEN i = 3 AND doc % 4 = 0 THEN '計 ' || {persons} || ' 個人及び' || {entities} || '団体'
    WHEN i % 54 = 37 THEN '国連参照番号: QDi.' || CAST(i AS STRING) WHEN i % 54 = 43 THEN '国連参照番号 : QDe.' || CAST(i AS STRING)
    WHEN i % 66 = 60 THEN CAST({d.div('i', '6')} + 1 AS STRING) || CASE WHEN i % 132 = 60 THEN '. 削除 ' ELSE '. ※ 2020年1月1日解除 ' END || line
    WHEN i % 6 = 0 AND i % 42 = 36 THEN '1. repeated ' || line WHEN i % 6 = 0 THEN CAST({d.div('i', '6')} + 1 AS STRING) || '. Name ' || line
    WHEN i % 18 = 1 THEN '生年月日: 1960' WHEN i % 18 = 7 THEN '所在地: x' ELSE 'text ' || line END AS line FROM doc_lines"""


BLOCKS = """
l AS (SELECT *, trim(line) AS t, CASE WHEN (i % 30 = 17 AND doc % 4 <> 0) OR i % 30 = 11 THEN 'C' WHEN i % 6 = 0 THEN 'O' END AS m FROM numbered_lines),
w AS (SELECT *, max(CASE WHEN m IS NOT NULL THEN i END) OVER s AS start, CASE WHEN doc % 4 = 0 THEN 'UN' ELSE coalesce(max(CASE WHEN i % 30 = 17 THEN 'II' END) OVER s, 'I') END AS section FROM l WINDOW s AS (PARTITION BY doc ORDER BY i)),
b AS (SELECT doc, start, max(CASE WHEN i = start THEN CAST(split_part(t, '.', 1) AS BIGINT) END) AS number, max(section) AS section, count(*) FILTER (t <> '') AS n_lines, min(page) AS first_page, max(page) AS last_page,
    CAST(sum(length(t)) AS BIGINT) AS n_chars, bool_or(t LIKE '生年月日%' OR i % 54 = 37) AS pe, bool_or(t LIKE '所在地%' OR i % 54 = 43) AS en,
    coalesce(max(CASE i % 54 WHEN 37 THEN 'QDi.' || i WHEN 43 THEN 'QDe.' || i END), '') AS external_id FROM w WHERE start IS NOT NULL AND (start % 30 <> 17 OR doc % 4 = 0) AND start % 30 <> 11 GROUP BY doc, start),
blocks AS (SELECT doc, start, number, section, n_lines, first_page, last_page, n_chars, external_id, start % 66 <> 60 AS current, CASE WHEN pe AND NOT en THEN 'person' WHEN en AND NOT pe THEN 'entity' ELSE 'unknown' END AS party_type FROM b)
"""


def _blocks(x):
    return D.numbered_blocks(x.view("numbered_lines"), F.col("doc") % 4 == 0)


@query("w7_numbered_blocks", views="numbered_lines", oracle=f"WITH {BLOCKS} SELECT * FROM blocks")
def _(x):
    return _blocks(x)


@query("w7_block_lines", views="numbered_lines", oracle=f"""
WITH {BLOCKS} SELECT w.doc, w.start, b.number, b.section, w.i, w.page, w.t AS text FROM w JOIN blocks b ON b.doc = w.doc AND b.start = w.start
""")
def _(x):
    return D.block_lines(x.view("numbered_lines"), F.col("doc") % 4 == 0).drop("head")


SEQUENCE = """
sq AS (SELECT doc, section, start, number, coalesce(lag(number) OVER (PARTITION BY doc, section ORDER BY start), 0) + 1 AS expected FROM blocks),
viol AS (SELECT doc, section, number, expected, 'NUMBER_SEQUENCE' AS violation FROM sq WHERE number <> expected
  UNION ALL SELECT doc, section, number, NULL, 'DUPLICATE_NUMBER' FROM blocks GROUP BY doc, section, number HAVING count(*) > 1)
"""


@query("q5_dense_sequence", views="numbered_lines", oracle=f"WITH {BLOCKS}, {SEQUENCE} SELECT * REPLACE (coalesce(expected, -1) AS expected) FROM viol")
def _(x):
    return D.sequence_violations(_blocks(x), ["doc", "section"], "start", "number").fillna(-1, "expected")


@query("q16_document_gate", views="numbered_lines", oracle=f"""
WITH {BLOCKS}, {SEQUENCE},
c AS (SELECT doc, count(*) AS nb, count(*) FILTER (current AND party_type = 'person') AS np, count(*) FILTER (current AND party_type = 'entity') AS ne FROM blocks GROUP BY doc),
ep AS (SELECT doc, page FROM l GROUP BY doc, page HAVING sum(length(t)) + coalesce(max(i) FILTER (t <> '') - min(i) FILTER (t <> ''), 0) < 20),
v AS (SELECT doc, count(*) AS ni FROM (SELECT doc FROM viol UNION ALL SELECT doc FROM ep) GROUP BY doc),
j2 AS (SELECT doc, i, regexp_extract(regexp_replace(coalesce(lag(line) OVER (PARTITION BY doc ORDER BY i), '') || line, '\\s+', '', 'g'), '([0-9]+)個人(?:及び|および)([0-9]+)団体', ['p', 'e']) AS g FROM numbered_lines),
p AS (SELECT doc, CAST(arg_min(g.p, i) AS BIGINT) AS persons, CAST(arg_min(g.e, i) AS BIGINT) AS entities FROM j2 WHERE g.p <> '' AND doc % 4 = 0 GROUP BY doc),
j AS (SELECT d.doc_id AS doc, coalesce(nb, 0) AS n_blocks, coalesce(ni, 0) AS n_issues, p.persons IS NOT NULL AND (p.persons <> coalesce(np, 0) OR p.entities <> coalesce(ne, 0)) AS count_mismatch
  FROM documents d LEFT JOIN c ON c.doc = d.doc_id LEFT JOIN v ON v.doc = d.doc_id LEFT JOIN p ON p.doc = d.doc_id)
SELECT doc, CASE WHEN n_issues > 0 OR n_blocks = 0 OR count_mismatch THEN 'BLOCKED' ELSE 'REVIEW_REQUIRED' END AS status, n_blocks, n_issues, count_mismatch FROM j
""")
def _(x):
    lines = x.view("numbered_lines")
    published = D.published_counts(lines.filter("doc % 4 = 0"))
    documents = x.table("documents").select(F.col("doc_id").alias("doc"))
    return D.document_gate(documents, D.block_summary(_blocks(x)), D.empty_pages(lines), published)


@view("declared_snapshots")
def _(d):
    """Declared counts per snapshot (part brand): records in state, report and expectation, diff rows per action; some wrong."""
    total = "count(*)"
    return f"""
SELECT p_brand AS snapshot, 'state' AS name, {total} + CASE WHEN p_brand LIKE '%3' THEN 1 ELSE 0 END AS value FROM {d.t('part')} GROUP BY p_brand
UNION ALL SELECT p_brand, 'report', {total} FROM {d.t('part')} GROUP BY p_brand
UNION ALL SELECT p_brand, 'expected', {total} - CASE WHEN p_brand LIKE '%7' THEN 2 ELSE 0 END FROM {d.t('part')} GROUP BY p_brand
UNION ALL SELECT p_brand, 'diff:' || p_type, count(*) + CASE WHEN p_brand LIKE '%1' THEN 1 ELSE 0 END FROM {d.t('part')} WHERE p_size > 5 GROUP BY p_brand, p_type
"""


@query("q6_count_agreement", views="declared_snapshots", oracle="""
WITH a AS (SELECT p_brand AS snapshot, n AS name, count(*) AS actual FROM part, (VALUES ('state'), ('report'), ('expected')) t(n) GROUP BY ALL UNION ALL SELECT p_brand, 'diff:' || p_type, count(*) FROM part GROUP BY ALL)
SELECT coalesce(d.snapshot, a.snapshot) AS snapshot, coalesce(d.name, a.name) AS name, coalesce(value, 0) AS declared, coalesce(actual, 0) AS actual
FROM declared_snapshots d FULL JOIN a ON a.snapshot = d.snapshot AND a.name = d.name WHERE coalesce(value, 0) <> coalesce(actual, 0)
""")
def _(x):
    parts = x.table("part").select(F.col("p_brand").alias("snapshot"), "p_type")
    per_type = parts.groupBy("snapshot", "p_type").agg(F.count(F.lit(1)).alias("value"))
    records = per_type.groupBy("snapshot").agg(F.sum("value").alias("value")).select(
        "snapshot", F.explode(F.array(F.lit("state"), F.lit("report"), F.lit("expected"))).alias("name"), "value")
    actions = per_type.select("snapshot", F.concat(F.lit("diff:"), "p_type").alias("name"), "value")
    return D.count_agreement(records.unionByName(actions), x.view("declared_snapshots"), ["snapshot"])


# --- pages and audit ---------------------------------------------------------------------

@view("catalog_pages")
def _(d):
    """Page sources with planted catalogue links: documents, notices, relative, foreign and plain-http targets, keywords."""
    return f"""
SELECT page_id, url, html || '<ul><li><a class="x" href="https://www.mofa.go.jp/files/' || CAST(page_id AS STRING) || '.pdf">資産凍結 <b>' || CAST(page_id AS STRING) || '</b></a></li>'
  || CASE WHEN page_id % 3 = 0 THEN '<li><a href="press' || CAST(page_id AS STRING) || '.html#top">報道</a></li>' ELSE '' END
  || CASE WHEN page_id % 4 = 1 THEN '<li><a href="http://www.mofa.go.jp/x.pdf?y=1">制裁の解除</a></li>' ELSE '' END
  || CASE WHEN page_id % 5 = 2 THEN '<li><a href="//mofa.go.jp/a.html">x</a></li>' ELSE '' END || '</ul>' AS html FROM {d.t('pages')}
"""


@query("s10_page_links", views="catalog_pages", oracle=r"""
WITH m AS (SELECT page_id, url, html, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>(?s:.*?)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a [^>]*href="[^"]*"[^>]*>((?s:.*?))</a>', 1)) AS body FROM catalog_pages),
r AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS base, regexp_extract(url, '^(https?://[^/?#]+(/[^?#]*/|/)?)', 1) AS folder, split_part(url, ':', 1) AS scheme, split_part(href, '#', 1) AS h,
    trim(regexp_replace(body, '<[^>]*>', '', 'g')) AS text, array_to_string(list_filter(['資産凍結', '制裁', '措置対象者', '追加', '削除', '解除', '外為法', 'タリバーン', 'テロリスト', 'ウクライナ'], lambda w: contains(html, w)), ';') AS reasons FROM m),
u AS (SELECT page_id, CASE WHEN h LIKE 'http%://%' THEN h WHEN h LIKE '//%' THEN scheme || ':' || h WHEN h LIKE '/%' THEN base || h ELSE (CASE WHEN folder = base THEN base || '/' ELSE folder END) || h END AS url, text, reasons FROM r)
SELECT page_id, url, text, CASE WHEN regexp_matches(url, '\.pdf(\?|$)') THEN 'attachment_pdf' WHEN regexp_matches(url, '\.html(\?|$)') THEN 'notice' ELSE 'other' END AS role,
  CASE WHEN url LIKE 'https://www.mofa.go.jp/%' OR url LIKE 'https://mofa.go.jp/%' THEN 'official' ELSE 'external' END AS policy, reasons FROM u
""")
def _(x):
    return D.page_links(x.view("catalog_pages"), ["www.mofa.go.jp", "mofa.go.jp"])


HOSTS = ["www.mofa.go.jp", "mofa.go.jp"]
P = "CAST(page_id AS STRING)"


@view("catalog_html")
def _(d):
    """Catalogue pages after the page's own source: the two current lists, some missing, doubled or elsewhere, and links that do not count."""
    return f"""
SELECT page_id, 'https://www.mofa.go.jp/mofaj/gaiko/terro/kyoryoku_05.html' AS url, CASE WHEN page_id % 11 = 10 THEN '' ELSE html || CASE WHEN page_id % 5 = 3 THEN '<div>' ELSE '<div class="m" id="maincontents">' END
  || '<div class="b"></div><ul><li>資産凍結措置対象リスト <a class="x" href="/files/un' || {P} || '.pdf">国連 <b>1267</b></a></li>'
  || CASE WHEN page_id % 5 = 2 THEN '' ELSE '<li>資産凍結措置対象リスト<p><a href=files/r' || {P} || '.PDF?x=1#f>1373 号</a></p></li>' END
  || CASE WHEN page_id % 5 = 1 THEN '<li>資産凍結措置対象リスト <a href="/files/second.pdf">1267</a></li>' ELSE '' END
  || CASE WHEN page_id % 7 = 1 THEN '<li><p>資産凍結措置対象リスト</p><A HREF="https://host.example/x.pdf">1373 他</A></li>' ELSE '' END
  || '<li><a href="/other.pdf">1267 no phrase</a></li></ul><!-- <li>資産凍結措置対象リスト<a href="/c.pdf">1373</a></li> --></div><p>資産凍結措置対象リスト <a href="/late.pdf">1267</a></p>' END AS html FROM {d.t('pages')}
"""


LISTS = """
k AS (SELECT page_id, page_id % 5 = 3 AS headless, page_id % 11 = 10 AS empty FROM catalog_html),
lists AS (SELECT page_id, 'current_un' AS role, 'https://www.mofa.go.jp/files/un' || page_id || '.pdf' AS url, '国連 1267' AS title, true AS official FROM k WHERE NOT headless AND NOT empty
  UNION ALL SELECT page_id, 'current_1373', 'https://www.mofa.go.jp/mofaj/gaiko/terro/files/r' || page_id || '.PDF?x=1', '1373 号', true FROM k WHERE NOT headless AND NOT empty AND page_id % 5 <> 2
  UNION ALL SELECT page_id, 'current_un', 'https://www.mofa.go.jp/files/second.pdf', '1267', true FROM k WHERE NOT empty AND page_id % 5 = 1
  UNION ALL SELECT page_id, 'current_1373', 'https://host.example/x.pdf', '1373 他', false FROM k WHERE NOT headless AND NOT empty AND page_id % 7 = 1)
"""


@query("s10_current_lists", views="catalog_html", oracle=f"WITH {LISTS} SELECT * FROM lists")
def _(x):
    return D.current_lists(D.page_anchors(x.view("catalog_html"), HOSTS))


@query("s10_catalog_gates", views="catalog_html", oracle=f"""
WITH {LISTS}, w AS (SELECT k.*, r.role, (SELECT count(*) FROM lists l WHERE l.page_id = k.page_id AND l.role = r.role) AS n, (SELECT bool_and(official) FROM lists l WHERE l.page_id = k.page_id AND l.role = r.role) AS ok
  FROM k, (VALUES ('current_un'), ('current_1373')) AS r(role))
SELECT DISTINCT page_id, CASE WHEN empty THEN 'EMPTY_HTML' WHEN headless THEN 'MAIN_MISSING' WHEN n = 0 THEN 'CURRENT_LIST_MISSING' WHEN n > 1 THEN 'DUPLICATE_CURRENT_LIST' ELSE 'FORBIDDEN_URL' END AS violation,
  CASE WHEN NOT empty AND NOT headless THEN role END AS role FROM w WHERE empty OR headless OR n <> 1 OR NOT ok
""")
def _(x):
    pages = x.view("catalog_html")
    return D.catalog_violations(pages, D.current_lists(D.page_anchors(pages, HOSTS)))


@view("listing_html")
def _(d):
    """Release listings of September 2026: month links, dated entries, entries of the month before, links of another kind."""
    return f"""
SELECT page_id, 'https://www.mofa.go.jp/mofaj/press/release/index.html' AS url, html || '<div id="maincontents"><h1>報道発表</h1><h2>8月 31日</h2><p><a href="/mofaj/press/release/8_8_index.html">8月</a>'
  || '<a href="/press/release/2026/7.html">7月</a><a href="/release/8_13_index.html">13月</a></p><div id="pressrelease"><dl><dt>9月 <b>x</b></dt><dt>９月<i> </i>9月 1日（火）</dt><dd><a href="press' || {P} || '_1.html?a=1">件名&nbsp;' || {P} || '</a></dd>'
  || '<dd><a href="/mofaj/press/release/8_9_index.html">一覧</a></dd>' || CASE WHEN page_id % 3 = 0 THEN '<dt>8月30日</dt><dd><div><a href="press' || {P} || '_0.html">前月</a></div></dd>' ELSE '' END
  || CASE WHEN page_id % 4 = 1 THEN '<dt>9月2日</dt><dd><a href="/files/a.pdf">資料</a></dd>' ELSE '' END || CASE WHEN page_id % 6 = 1 THEN '<dt>9月31日</dt><dd><a href="bad.html">日付</a></dd>' ELSE '' END
  || '</dl></div><h2>9月9日</h2><p><a href="outside.html">外</a></p></div>' AS html, 2026 AS year, 9 AS month_no, page_id % 2 = 0 AS rolling FROM {d.t('pages')}
"""


@query("s10_release_entries", views="listing_html", oracle="""
WITH p AS (SELECT page_id, 'https://www.mofa.go.jp/mofaj/press/release/' AS folder, rolling FROM listing_html)
SELECT page_id, 'archive' AS kind, folder || '8_8_index.html' AS url, DATE '2026-08-01' AS date, '8月' AS title, NULL AS violation FROM p
UNION ALL SELECT page_id, 'archive', 'https://www.mofa.go.jp/press/release/2026/7.html', DATE '2026-07-01', '7月', NULL FROM p
UNION ALL SELECT page_id, 'archive', 'https://www.mofa.go.jp/release/8_13_index.html', NULL, '13月', 'BAD_ARCHIVE_MONTH' FROM p
UNION ALL SELECT page_id, 'archive', folder || '8_9_index.html', DATE '2026-09-01', '一覧', NULL FROM p
UNION ALL SELECT page_id, 'notice', folder || 'press' || page_id || '_1.html?a=1', DATE '2026-09-01', '件名 ' || page_id, NULL FROM p
UNION ALL SELECT page_id, 'notice', folder || 'press' || page_id || '_0.html', DATE '2026-08-30', '前月', 'CONTRADICTS_MONTH' FROM p WHERE page_id % 3 = 0 AND NOT rolling
UNION ALL SELECT page_id, 'notice', 'https://www.mofa.go.jp/files/a.pdf', DATE '2026-09-02', '資料', 'UNKNOWN_LINK' FROM p WHERE page_id % 4 = 1
UNION ALL SELECT page_id, 'notice', folder || 'bad.html', NULL, '日付', 'BAD_DATE' FROM p WHERE page_id % 6 = 1
""")
def _(x):
    pages = x.view("listing_html")
    return D.release_entries(D.page_anchors(pages, HOSTS), pages.select("page_id", "year", "month_no", "rolling"))


@view("release_html")
def _(d):
    """Release bodies: repeated and foreign PDFs, keywords in texts, and keywords in attributes, scripts and outside the main part."""
    return f"""
SELECT page_id, 'https://www.mofa.go.jp/mofaj/press/release/press' || {P} || '.html' AS url, html || '<h1>t</h1><div id=maincontents><p title="制裁">本文 追加 <a href="/files/' || {P} || '.pdf">添付 <i>' || {P} || '</i></a>'
  || '<a href="/files/' || {P} || '.pdf#p2">再掲</a><a href="https://host.example/e.pdf">外部</a><a name="x">無</a><a href="next.html">次</a></p>' || CASE WHEN page_id % 2 = 0 THEN '<p>解除</p>' ELSE '' END
  || '<script>var x = "削除";</script></div><p>外為法 <a href="/files/late.pdf">後</a></p>' AS html FROM {d.t('pages')}
"""


@query("s10_page_documents", views="release_html", oracle="""
SELECT page_id, 'https://www.mofa.go.jp/files/' || page_id || '.pdf' AS url, '添付 ' || page_id AS title, 'attachment_pdf' AS role FROM release_html
UNION ALL SELECT page_id, 'https://host.example/e.pdf', '外部', 'external_pdf' FROM release_html
""")
def _(x):
    return D.page_documents(D.page_anchors(x.view("release_html"), HOSTS))


@query("s10_page_reasons", views="release_html", oracle="SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '追加;解除' ELSE '追加' END AS reasons FROM release_html")
def _(x):
    return D.page_reasons(x.view("release_html"))


@view("audit_entries")
def _(d):
    """Fetch attempts, one per event: signed and plain URLs, multi-line and very long errors."""
    k = "event_id"
    return f"""
SELECT {k} AS entry_id, {d.iso('ts')} AS checked_at, event_type AS source, 'list_file' AS document_role, CASE WHEN event_type = 'error' THEN 'error' ELSE 'fetched' END AS status,
  'https://host.example/f' || CAST({k} AS STRING) || CASE {k} % 4 WHEN 0 THEN '?X-Amz-Signature=abc&b=2#frag' WHEN 1 THEN '?page=2#frag' WHEN 2 THEN '?a=1&x-amz-date=3' ELSE '' END AS url,
  CASE WHEN event_type <> 'error' THEN NULL WHEN {k} % 3 = 0 THEN 'failed' || chr(10) || 'at https://h.example/p?x-amz-id=9 and' || chr(13) || chr(10) || 'https://h.example/q?z=1' || chr(10) WHEN {k} % 3 = 1 THEN repeat('long ', 900) ELSE 'plain' END AS error_message,
  CASE WHEN event_type = 'error' THEN 503 WHEN {k} % 6 = 1 THEN 304 ELSE 200 END AS http_status, CASE WHEN {k} % 6 <> 2 THEN 'W/"' || CAST({k} AS STRING) || '"' END AS etag,
  CASE WHEN {k} % 5 = 3 THEN NULL ELSE {d.iso('ts')} END AS last_modified, CASE WHEN event_type <> 'error' THEN {d.sha(f"CAST({k} AS STRING)")} END AS content_hash, CAST(NULL AS STRING) AS source_updated,
  'https://cdn.example/f' || CAST({k} AS STRING) || CASE WHEN {k} % 3 = 0 THEN '?x-amz-expires=1#page=2' ELSE '' END AS final_url, CASE WHEN event_type <> 'error' THEN 'f' || CAST({k} AS STRING) || '.csv' END AS fetched_file,
  CASE WHEN event_type <> 'error' THEN 'raw/' || CAST({k} AS STRING) END AS raw_path, CASE WHEN event_type = 'purchase' THEN {k} * 3 END AS record_count, CASE WHEN event_type = 'error' THEN 'HttpError' END AS error_type,
  event_type = 'error' AS fetch_failed, CAST(NULL AS BOOLEAN) AS schema_changed, CASE WHEN event_type = 'purchase' THEN {k} % 9 END AS diff_added, CASE WHEN event_type = 'purchase' THEN 0 END AS diff_removed, CASE WHEN event_type = 'purchase' THEN 1 END AS diff_changed
FROM {d.t('events')}
"""


@query("s15_fetch_audit", views="audit_entries", oracle="""
SELECT entry_id, checked_at, source, document_role, status, CAST(http_status AS STRING) AS http_status, coalesce(etag, '') AS etag, coalesce(last_modified, '') AS last_modified, coalesce(content_hash, '') AS content_hash,
  '' AS source_updated, CASE WHEN entry_id % 3 = 0 THEN split_part(final_url, '?', 1) ELSE final_url END AS final_url, coalesce(fetched_file, '') AS fetched_file, coalesce(raw_path, '') AS raw_path,
  coalesce(CAST(record_count AS STRING), '') AS record_count, coalesce(error_type, '') AS error_type, CASE WHEN entry_id % 4 IN (0, 2) THEN split_part(url, '?', 1) ELSE url END AS url,
  CASE WHEN error_message IS NULL THEN '' WHEN entry_id % 3 = 0 THEN 'failed at https://h.example/p and https://h.example/q?z=1' WHEN entry_id % 3 = 1 THEN error_message ELSE 'plain' END AS error_message,
  CASE WHEN fetch_failed THEN '1' ELSE '0' END AS fetch_failed, '0' AS schema_changed, coalesce(CAST(diff_added AS STRING), '') AS diff_added, coalesce(CAST(diff_removed AS STRING), '') AS diff_removed,
  coalesce(CAST(diff_changed AS STRING), '') AS diff_changed, substr(checked_at, 1, 7) AS month FROM audit_entries
""")
def _(x):
    return D.audit_rows(x.view("audit_entries"))
