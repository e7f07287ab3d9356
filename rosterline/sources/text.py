"""Line-based list files: scans, CSV cells, plausibility and header gates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import names as N
from ..functions.rows import explode_once

# Columns and null marks of the headerless list files.
PRIMARY_COLUMNS = ["ent_num", "name", "sdn_type", "program", "title", "call_sign", "vess_type", "tonnage", "grt", "vess_flag", "vess_owner", "remarks"]
ALIAS_COLUMNS = ["ent_num", "alt_num", "alt_type", "alt_name", "alt_remarks"]
NULL_MARKS = ["-0-", ""]
# possessive: a long or much quoted cell costs no stack
LEGACY_CHARSET = "cp932"
CSV_CELL = r'(?:^|,)("[^"]*+(?:""[^"]*+)*+"|[^,]*+)'


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, value) of text files; plain or gzip.  ``ord`` follows the lines of a file across its splits."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    return lines.select("file", F.struct("start", F.monotonically_increasing_id().alias("line")).alias("ord"), "value")


def _decoder(charset: str):
    """Bytes as text of a charset that Spark has no expression for; NULL for what it cannot hold."""

    def one(value: bytes | None) -> str | None:
        try:
            return None if value is None else bytes(value).decode(charset)
        except UnicodeDecodeError:
            return None

    def run(values: pd.Series) -> pd.Series:
        return values.map(one, na_action="ignore").astype(object)

    run.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string").asNondeterministic()


def read_records(spark: SparkSession, path: str | list[str], legacy: str = LEGACY_CHARSET) -> DataFrame:
    """(file, ord, value, violation) of the CSV records of text files, plain or gzip; a quoted cell may hold line breaks (given as \\n).

    A file is cut into splits as for any text.  Whether a split begins inside a quoted cell follows from the number of
    quotes before it, a running sum over one row for each split; records are put together inside their split, and a record
    that is torn at its border by the place where it began.  Only records of several lines are grouped.  A file is UTF-8 (with
    or without BOM) if all of it is, else of the ``legacy`` charset.  Files that hold an odd number of quotes cannot be cut into
    records: their lines come one by one, as UNBALANCED_QUOTES, and lines of neither charset as UNDECODABLE without value."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    split, order = ["file", "start"], Window.partitionBy("file", "start").orderBy("line")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"), quotes.alias("quotes"), "value")
    lines = lines.withColumns({
        "before": F.coalesce(F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "first": F.row_number().over(order) == 1})
    even = F.col("before") % 2 == 0
    splits = lines.groupBy(*split).agg(
        F.sum("quotes").alias("total"), F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.max(F.when(even, F.col("line"))).alias("last_even"), F.max(F.when(~even, F.col("line"))).alias("last_odd"))
    files, earlier = Window.partitionBy("file"), Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumns({
        "inside": F.coalesce(F.sum("total").over(earlier), F.lit(0)) % 2, "balanced": F.sum("total").over(files) % 2 == 0, "utf8": F.min("utf8").over(files)})
    opened = F.when(F.col("inside") == 0, F.col("last_even")).otherwise(F.col("last_odd"))
    begun = F.when(opened.isNotNull(), F.struct("start", opened.alias("line")))
    splits = splits.select(*split, "inside", "balanced", "utf8", F.last(begun, ignorenulls=True).over(earlier).alias("torn"))
    met = lines.join(splits, split).withColumn("within", (F.col("inside") + F.col("before")) % 2 == 1)
    place = F.struct("start", "line")
    here = F.last(F.when(~F.col("within"), place), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = met.withColumn("ord", F.when(F.col("balanced"), F.coalesce(here, "torn")).otherwise(place))
    bom = F.col("first") & (F.col("start") == 0) & F.startswith("value", F.lit("\ufeff"))
    decoded = F.when(F.col("utf8"), F.when(bom, F.substr("value", F.lit(2))).otherwise(F.col("value"))).otherwise(
        _decoder(legacy)(F.when(~F.col("utf8"), F.col("value").cast("binary"))))
    text = met.select("file", "ord", "start", "line", (~F.col("balanced") | (~F.col("within") & (F.col("quotes") % 2 == 0))).alias("whole"),
                      "balanced", decoded.alias("value"))
    several = text.filter("NOT whole").groupBy("file", "ord", "balanced").agg(
        F.sort_array(F.collect_list(F.struct("start", "line", "value"))).alias("parts"))
    joined = several.select("file", "ord", "balanced", F.when(~F.exists("parts", lambda p: p["value"].isNull()),
                            F.array_join(F.transform("parts", lambda p: p["value"]), "\n")).alias("value"))
    violation = F.when(~F.col("balanced"), "UNBALANCED_QUOTES").when(F.col("value").isNull(), "UNDECODABLE")
    return text.filter("whole").select("file", "ord", "balanced", "value").unionByName(joined).select("file", "ord", "value", violation.alias("violation"))


def file_violations(records: DataFrame) -> DataFrame:
    """Files that ``read_records`` could not cut or decode, with the number of lines or records."""
    return records.filter("violation IS NOT NULL").groupBy("file", "violation").agg(F.count(F.lit(1)).alias("n"))


def csv_cells(line: Column) -> Column:
    """Cells of one CSV line; quotes removed, doubled quotes undone, blanks stripped."""
    quoted = lambda c: F.startswith(c, F.lit('"')) & F.endswith(c, F.lit('"')) & (F.length(c) >= 2)
    bare = lambda c: F.when(quoted(c), F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), '""', '"')).otherwise(c)
    return F.transform(F.regexp_extract_all(line, F.lit(CSV_CELL), F.lit(1)), lambda c: N.strip(bare(c)))


def parse_headerless(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a headerless list file.

    Null marks become NULL, lines with fewer than two cells or only nulls and a stray header line are
    dropped, and surplus cells belong to the last column.
    """
    n = len(columns)
    # a generator cuts a line once; filters on plain columns would be pushed down and cut it again
    cells = explode_once(lines, [c for c in ("file", "ord") if c in lines.columns], F.array(csv_cells(F.col("value"))), "cells")
    blank = lambda c: c.isin(NULL_MARKS)
    kept = cells.filter((F.size("cells") >= 2) & ~F.forall("cells", blank)).filter(
        ~F.lower(F.get("cells", F.lit(0))).isin("ent_num", "entnum", "id"))
    last = F.array_join(F.slice("cells", n, F.greatest(F.size("cells") - (n - 1), F.lit(0))), ",")

    def column(i: int) -> Column:
        v = F.when(F.size("cells") >= n, last) if i == n - 1 else F.get("cells", F.lit(i))
        return F.when(~blank(v), v).alias(columns[i])

    return kept.select(*[c for c in ("file", "ord") if c in lines.columns], *[column(i) for i in range(n)])


def list_records(primary: DataFrame, alias: DataFrame, label: str) -> DataFrame:
    """One row per name of the primary and alias rows; alias rows inherit the program of their entity."""
    programs = primary.filter("ent_num IS NOT NULL").groupBy("ent_num").agg(F.max_by("program", "ord").alias("program"))
    own = primary.filter("name IS NOT NULL").select("ent_num", F.col("name").alias("raw"), "program", F.lit(0).alias("kind"), "ord")
    other = alias.filter("alt_name IS NOT NULL").select("ent_num", F.col("alt_name").alias("raw"), F.lit(1).alias("kind"), "ord").join(
        programs, "ent_num", "left").select("ent_num", "raw", "program", "kind", "ord")
    rows = N.with_aliases(own.unionByName(other), "raw")
    names = explode_once(rows, ["ent_num", "program"], F.col("aliases"), "name")
    return names.select(
        F.lit("OFAC").alias("source"), F.lit(label).alias("category"), "name", F.col("ent_num").alias("source_id"),
        F.coalesce("program", F.lit("")).alias("program"))


def content_violations(lines: DataFrame) -> DataFrame:
    """Files that cannot be a list: empty body, HTML or JSON, or no row with a numeric id."""
    head = F.lower(F.ltrim("value"))
    foreign = F.startswith(head, F.lit("<!doctype html")) | F.startswith(head, F.lit("<html")) | F.startswith(head, F.lit("{")) | F.startswith(head, F.lit("["))
    cells = csv_cells(F.col("value"))
    party = (F.size(cells) >= 2) & F.get(cells, F.lit(0)).rlike("^[0-9]+$")
    filled = F.coalesce(F.trim("value"), F.lit("")) != ""
    per_file = lines.groupBy("file").agg(
        F.bool_or(filled).alias("filled"), F.min_by(foreign, F.when(filled, F.col("ord"))).alias("foreign"), F.count_if(party).alias("n_parties"))
    violation = F.when(~F.col("filled"), "EMPTY_BODY").when(F.col("foreign"), "NOT_A_LIST").when(F.col("n_parties") == 0, "NO_PARTY_ROW")
    return per_file.select("file", violation.alias("violation")).filter("violation IS NOT NULL")


def header_violations(headers: DataFrame, contract: list[str]) -> DataFrame:
    """Missing, extra and displaced columns of every header line (file, header), compared in place."""
    want = F.array(*[F.lit(c) for c in contract])
    df = headers.select("file", csv_cells(F.col("header")).alias("have"))
    found = lambda code, cols: F.transform(cols, lambda c: F.struct(F.lit(code).alias("violation"), c.alias("column")))
    missing, extra = F.array_except(want, "have"), F.array_except("have", want)
    shifted = (F.size(missing) == 0) & (F.size(extra) == 0) & (F.col("have") != want)
    wrong = F.concat(found("MISSING", missing), found("EXTRA", extra), F.when(
        shifted, F.array(F.struct(F.lit("REORDERED").alias("violation"), F.lit("").alias("column")))).otherwise(F.array().cast("array<struct<violation:string,column:string>>")))
    return explode_once(df, ["file"], wrong, "w").select("file", "w.violation", "w.column")


def first_lines(lines: DataFrame) -> DataFrame:
    return lines.groupBy("file").agg(F.min_by("value", "ord").alias("header"))


# --- 32-column list ----------------------------------------------------------------------

def parse_list(lines: DataFrame, columns: list[str] = K.LIST_COLUMNS) -> DataFrame:
    """Rows of the list from CSV lines or records; header lines are recognised by their first cells."""
    cells = lines.select("file", "ord", csv_cells(F.col("value")).alias("cells"))
    header = (F.get("cells", F.lit(0)) == columns[0]) & (F.get("cells", F.lit(1)) == columns[1])
    body = cells.filter(F.coalesce(F.trim(F.array_join("cells", "")), F.lit("")) != "").filter(~header)
    return body.select("file", "ord", *[F.translate(F.coalesce(F.get("cells", F.lit(i)), F.lit("")), "\u0000", "").alias(c) for i, c in enumerate(columns)])


def read_list(spark: SparkSession, path: str | list[str], legacy: str = LEGACY_CHARSET) -> DataFrame:
    """Rows of list files (``read_records``); an empty folder gives no rows.

    Gate the files with ``file_violations`` and ``header_violations(first_lines(...))`` before the rows are used."""
    return parse_list(read_records(spark, path, legacy).filter("violation IS NULL"))


def list_violations(rows: DataFrame, key: str = "番号") -> DataFrame:
    """Empty and repeated record ids per file."""
    return rows.groupBy("file", F.col(f"`{key}`").alias("record_id")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "violation", F.when(F.col("record_id") == "", "EMPTY_ID").when(F.col("n_rows") > 1, "DUPLICATE_ID")).filter("violation IS NOT NULL")


def list_names(rows: DataFrame, categories: dict[str, str], extra: DataFrame | None = None) -> DataFrame:
    """One row per screening name of a list record (区分, 番号, name columns), first spelling per identity key.

    Codes outside ``categories`` keep an empty category and set ``unknown_code``.  ``extra`` adds names found
    elsewhere for the record (record_id, name), such as original scripts.
    """
    columns = [c for c in K.NAME_COLUMNS if c in rows.columns]

    def parts(c: str) -> Column:
        names = F.transform(N.split_top_level(N.clean_name(F.col(f"`{c}`"))), N.strip_descriptor)
        keep = F.filter(names, lambda n: ~n.isin(K.NULLISH) & (n != ""))
        return F.when(N.clean_name(F.col(f"`{c}`")).isin(K.NULLISH), F.array().cast("array<string>")).otherwise(keep)

    code = N.clean_name(F.col("区分"))
    head = [F.col("番号").alias("record_id"), code.alias("code")]
    found = explode_once(rows, head, F.concat(*[parts(c) for c in columns]), "name", "pos")
    if extra is not None:
        ids = rows.select(*head)
        found = found.unionByName(extra.select("record_id", "name").join(ids, "record_id").select(
            "record_id", "code", F.lit(1_000_000).alias("pos"), "name"))
    keyed = N.with_identity_key(found, "name").filter("match_key <> ''")
    unique = keyed.groupBy("record_id", "match_key").agg(F.min_by(F.struct("code", "name"), F.struct("pos", "name")).alias("r"))
    known = F.create_map(*[F.lit(v) for kv in categories.items() for v in kv])
    category = F.coalesce(F.try_element_at(known, F.col("r.code")), F.lit(""))
    return unique.select("record_id", "match_key", F.col("r.name").alias("name"), F.col("r.code").alias("code"), category.alias("category"),
                         (~F.map_contains_key(known, F.col("r.code")) & (F.col("r.code") != "")).alias("unknown_code"))
