"""Name standardisation as column expressions.

Everything runs in the JVM except NFKC + full case folding of non-ASCII text, which Spark has no
expression for; that step is one Arrow UDF that receives NULL for every ASCII row.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rows import bound

# The characters and words that decide when two spellings are one name.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
INVISIBLE = "\u200b\ufeff"
PUNCT_FROM = "\u2018\u2019\u201c\u201d\u2010\u2011\u2012\u2013\u2014\u2015\u30fc\uff0d\u00b4`"
PUNCT_TO = "''\"\"--------''"
EDGE_QUOTES = "“”‘’「」『』«»＂'\"`"
OPENERS = "「『“‘«\"'＂`"
CLOSERS = "」』”’»\"'＂`"
COMPANY_PREFIXES = [
    "LTD", "INC", "LLC", "L.L.C.", "CORP", "CO", "PLC", "GMBH", "S.A.", "S.R.L.", "SA", "SARL",
    "AG", "NV", "BV", "AB", "AS", "OY", "PTE", "PTY", "S. DE R.L.", "DE C.V.", "LLP", "LP",
    "JSC", "OAO", "OOO", "PAO", "ZAO", "A.S.", "D.O.O.",
]
CJK = r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]"
UNKNOWN_TAIL = r"(?U)(?:[A-Za-z0-9]|[)\]}>）］】])\s*不明$"
LATIN_MARKER = r"(?i)(?<![A-Za-z])(?:a\.\s?k\.\s?a|f\.\s?k\.\s?a|n\.\s?k\.\s?a)\.?(?![A-Za-z])"
JAPANESE_MARKER = r"別名|別称|旧称"
VESSEL_TAIL = (
    r"(?i)\s*[（(][A-Z0-9]{4,8}[)）]\s*"
    r"(?:Crude Oil|Products|Chemical|Bulk|LPG|LNG|Oil|Cargo|Container|Refrigerated|General|Vehicle)?\s*"
    r"(?:Tanker|Carrier|Vessel|Ship|Cargo)\b.*?\bflag\s*$"
)
ALIAS_NUMBER = r"^\s*[（(]\s*別名\s*[0-9０-９]*\s*[)）]?\s*"
JAPANESE_SPLIT = r"[（(]?\s*(?:別称|別名|旧称)\s*[、,]?\s*"
LATIN_SPLIT = (
    r"(?i)[（(]?\s*(?<![A-Za-z])(?:a\.\s?k\.\s?a|f\.\s?k\.\s?a|n\.\s?k\.\s?a)\.?\s*[.:：]?\s*(?![A-Za-z])"
)
DESCRIPTOR = (
    r"(?i)生年月日|出生地|国籍|旅券|passport|original\s*script|\bDOB\b|\bPOB\b|Nationality|"
    r"\d{4}\s*年\s*\d+\s*月\s*\d+\s*日\s*生"
)
DESCRIPTOR_TAIL = r"[（(][^（()）]*[)）]?\s*$"

TIDY = r"\A[!-~]++(?: [!-~]++)*+\z"  # words of ASCII with one blank between: nothing to clean

BREAK = "\u0000"  # piece separator inside one cell


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def clean_name(c: Column) -> Column:
    """Display clean-up only: invisible characters, line breaks, blank runs, outer blanks."""
    s = F.translate(F.coalesce(c, F.lit("")), "\u3000" + INVISIBLE, " ")
    return F.when(c.rlike(TIDY), c).otherwise(strip(F.regexp_replace(s, r"[ \r\n\t]+", " ")))


def _unquote_once(s: Column) -> Column:
    first, last = F.left(s, F.lit(1)), F.right(s, F.lit(1))
    inner = bound(F.substring(s, F.lit(2), F.length(s) - 2), clean_name)
    paired = (F.length(s) >= 2) & first.isin(list(OPENERS)) & (F.translate(first, OPENERS, CLOSERS) == last)
    return F.when(paired, bound(inner, lambda t: F.when(t != "", t).otherwise(s))).otherwise(s)


def canonical_display_name(c: Column) -> Column:
    """Clean name without outer quote pairs, however deeply they are nested."""
    return _unquoted(clean_name(c))


def _unquoted(s: Column) -> Column:
    """A clean name without its outer quote pairs; every pair takes one opener, so there are no more rounds than openers."""
    maybe = F.left(s, F.lit(1)).isin(list(OPENERS)) & F.right(s, F.lit(1)).isin(list(CLOSERS))
    return F.when(maybe, F.aggregate(F.sequence(F.lit(1), _count(s, OPENERS)), s, lambda acc, _: _unquote_once(acc))).otherwise(s)


def with_display_name(df: DataFrame, raw: str, out: str = "name") -> DataFrame:
    """``canonical_display_name`` as staged columns: the cleaning is computed once."""
    clean = f"__{out}_c"
    return df.withColumn(clean, clean_name(F.col(raw))).withColumn(out, _unquoted(F.col(clean))).drop(clean)


def _quote_regex(words: list[str]) -> str:
    return "|".join("".join("\\" + ch if ch in ".()" else ch for ch in w) for w in words)


def swap_surname_first(c: Column) -> Column:
    """``Surname, Given`` to ``Given Surname`` unless a company form follows the comma."""
    shape = r"(?U)^([^,]{2,60}),\s+([^,]{2,60})$"
    s = strip(c)
    head = strip(F.regexp_extract(s, shape, 1))
    tail = strip(F.regexp_extract(s, shape, 2))
    company = tail.rlike(r"(?i)^(?:" + _quote_regex(COMPANY_PREFIXES) + ")")
    swapped = F.when(s.rlike(shape) & ~company, F.concat(tail, F.lit(" "), head)).otherwise(c)
    return F.when(F.contains(c, F.lit(",")), swapped).otherwise(c)


def _fold_udf(fold) -> object:
    """Arrow UDF over the non-NULL (non-ASCII) texts.

    Declared non-deterministic so that the optimizer neither copies it into pushed-down filters nor
    merges the projections around it: every text is folded once.
    """

    def run(s: pd.Series) -> pd.Series:
        return s.map(fold, na_action="ignore")

    return F.pandas_udf(run, T.StringType()).asNondeterministic()


nfkc_casefold = _fold_udf(lambda v: unicodedata.normalize("NFKC", v).casefold())
nfkc = _fold_udf(lambda v: unicodedata.normalize("NFKC", v))
casefold = _fold_udf(str.casefold)


def _finish_key(folded: Column) -> Column:
    s = F.translate(folded, PUNCT_FROM + BLANKS + INVISIBLE, PUNCT_TO)  # blanks have no counterpart and go
    return F.btrim(s, F.lit(EDGE_QUOTES))


def ascii_identity_key(c: Column) -> Column:
    """Identity key of a name known to be ASCII (then NFKC is the identity and folding is lower)."""
    return _finish_key(F.lower(swap_surname_first(clean_name(c))))


def with_identity_key(df: DataFrame, name: str, out: str = "match_key") -> DataFrame:
    """Add the identity key.  Narrow: no shuffle; only non-ASCII names carry text into Python."""
    clean, swapped, wide = (f"__{out}_{x}" for x in "csw")
    df = df.withColumn(clean, clean_name(F.col(name))).withColumn(swapped, swap_surname_first(F.col(clean))).drop(clean)
    df = df.withColumn(wide, nfkc_casefold(F.when(~is_ascii(F.col(swapped)), F.col(swapped))))
    key = _finish_key(F.coalesce(F.col(wide), F.lower(F.col(swapped))))
    return df.withColumn(out, key).drop(swapped, wide)


def relaxed_key(key: Column) -> Column:
    """Screening-only key: the identity key without round brackets."""
    return F.translate(key, "()", "")


# --- triage ------------------------------------------------------------------------------

def is_unknown_artifact(c: Column) -> Column:
    """Damaged name that ends in a stray 不明; ``c`` is a canonical display name."""
    return F.contains(c, F.lit("不明")) & c.rlike(UNKNOWN_TAIL)


def invalid_reason(s: Column) -> Column:
    """Why a canonical display name can never be a listed name; NULL when it can."""
    return (
        F.when(s == "", "空文字または空白のみ")
        .when(is_unknown_artifact(s), "original script等のメタ情報「不明」が名称末尾に混入した旧データ")
        .when(s.rlike("^[0-9]{5}$"), F.concat(F.lit("Excelの日付シリアル値が名前として混入した疑い（"), s, F.lit("）")))
        .when(s.rlike("^[0-9]+$"), F.concat(F.lit("数字のみで人名・団体名として成立しない（"), s, F.lit("）")))
        .when(s.rlike(r"^[^\p{L}\p{N}]+$"), "記号のみで構成されている")
    )


def has_alias_marker(s: Column) -> Column:
    return s.rlike(JAPANESE_MARKER) | s.rlike(LATIN_MARKER)


def review_reason(s: Column) -> Column:
    """Why a valid canonical display name still needs a person to look; NULL when it does not."""
    n = F.char_length(s)
    cjk = s.rlike(CJK)
    return (
        F.when(cjk & (n <= 1), F.concat(F.lit("1文字のため照合時に誤検知が多発する見込み（"), s, F.lit("）")))
        .when(~cjk & (n <= 3), F.concat(n.cast("string"), F.lit("文字と短く、照合時に誤検知が多発する見込み（"), s, F.lit("）")))
        .when(has_alias_marker(s), "別名マーカーを分解しきれなかった。手動で名前を切り出す必要がある")
        .when(n > 120, F.concat(n.cast("string"), F.lit("文字と異常に長い。複数名が1セルに連結された疑い")))
    )


# --- alias cells -------------------------------------------------------------------------

def _count(s: Column, chars: str) -> Column:
    return F.length(s) - F.length(F.translate(s, chars, ""))


def orphan_closers_to_break(s: Column) -> Column:
    """Closing brackets that lost their opener become piece separators."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("depth"))

    def step(acc, piece):  # text up to a bracket and the bracket
        ch = F.right(piece, F.lit(1))
        opens, closes = ch.isin("(", "（"), ch.isin(")", "）")
        orphan = closes & (acc["depth"] == 0)
        return F.struct(
            F.concat(acc["text"], F.when(orphan, F.concat(F.left(piece, F.length(piece) - 1), F.lit(BREAK))).otherwise(piece)).alias("text"),
            (acc["depth"] + F.when(opens, 1).when(closes & ~orphan, -1).otherwise(0)).alias("depth"),
        )

    folded = F.aggregate(F.regexp_extract_all(s, F.lit(r"[^()（）]*+[()（）]|[^()（）]++"), F.lit(0)), start, step, lambda acc: acc["text"])
    return F.when(s.rlike("[)）]"), folded).otherwise(s)


def unwrap_brackets(s: Column) -> Column:
    inner = F.regexp_extract(s, r"^[（(]\s*(.+?)\s*[)）]$", 1)
    return F.when((inner != "") & ~inner.rlike("[（(]"), inner).otherwise(s)


def _split_marked(body: Column) -> Column:
    t = F.regexp_replace(body, ALIAS_NUMBER, "")
    t = F.regexp_replace(t, JAPANESE_SPLIT, BREAK)
    return F.regexp_replace(t, LATIN_SPLIT, BREAK)


def _tidy_pieces(cut: Column, whole: Column) -> Column:
    """Pieces of a cell whose markers are already breaks: unclosed brackets split again, edges trimmed, repeats dropped."""
    opens, closes = "(（", ")）"
    parts = F.flatten(F.transform(F.split(cut, f"[{BREAK}、，;；]"), lambda p: F.when(
        _count(p, opens) > _count(p, closes), F.split(p, "[（(]")).otherwise(F.array(p))))
    parts = F.transform(parts, lambda p: F.btrim(clean_name(p), F.lit("\u3000 ,;；、（(")))
    parts = F.transform(parts, lambda p: F.when(
        _count(p, opens) < _count(p, closes), clean_name(F.regexp_replace(p, "[)）]+$", ""))).otherwise(p))
    return bound(F.array_distinct(F.filter(parts, lambda p: p != "")), lambda kept: F.when(F.size(kept) == 0, F.array(whole)).otherwise(kept))


def split_aliases(c: Column) -> Column:
    """All names held in one cell, in order, without repeats.

    Cells without an alias marker are never split: their commas separate family and given names.
    """
    s = clean_name(c)
    body = strip(F.regexp_replace(s, VESSEL_TAIL, ""))
    whole = unwrap_brackets(body)
    many = _tidy_pieces(orphan_closers_to_break(_split_marked(body)), s)
    return F.when(s == "", F.array().cast("array<string>")).when(has_alias_marker(body), many).otherwise(
        F.array(F.when(whole == "", s).otherwise(whole)))


def with_aliases(df: DataFrame, raw: str, out: str = "aliases") -> DataFrame:
    """``split_aliases`` as staged columns: each step is computed once and the costly ones only for marked cells."""
    clean, body, marked, cut = (f"__{out}_{x}" for x in ("clean", "body", "marked", "cut"))
    df = df.withColumn(clean, clean_name(F.col(raw)))
    tail = F.when(F.lower(clean).contains("flag"), strip(F.regexp_replace(F.col(clean), VESSEL_TAIL, ""))).otherwise(F.col(clean))
    df = df.withColumn(body, tail)
    df = df.withColumn(marked, has_alias_marker(F.col(body)))
    df = df.withColumn(cut, F.when(F.col(marked), _split_marked(F.col(body))))
    df = df.withColumn(cut, F.when(F.col(marked), orphan_closers_to_break(F.col(cut))))
    whole = unwrap_brackets(F.col(body))
    return df.withColumn(out, F.when(F.col(clean) == "", F.array().cast("array<string>")).when(
        F.col(marked), _tidy_pieces(F.col(cut), F.col(clean))).otherwise(
        F.array(F.when(whole == "", F.col(clean)).otherwise(whole)))).drop(clean, body, marked, cut)


def split_top_level(s: Column) -> Column:
    """Split at ``;`` outside brackets only (inside they separate birth dates)."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("depth"))

    def step(acc, ch):
        depth = acc["depth"] + F.when(ch.isin("(", "（"), 1).when(ch.isin(")", "）") & (acc["depth"] > 0), -1).otherwise(0)
        return F.struct(
            F.concat(acc["text"], F.when(ch.isin(";", "；") & (depth == 0), F.lit(BREAK)).otherwise(ch)).alias("text"),
            depth.alias("depth"),
        )

    nested = F.aggregate(F.split(s, ""), start, step, lambda acc: acc["text"])
    flat = F.regexp_replace(s, "[;；]", BREAK)
    marked = F.when(s.rlike("[;；]"), F.when(s.rlike("[（()）]"), nested).otherwise(flat)).otherwise(s)
    return F.filter(F.transform(F.split(marked, BREAK), strip), lambda p: p != "")


def strip_descriptor(c: Column) -> Column:
    """Drop trailing brackets that hold birth, nationality or passport notes."""
    s = clean_name(c)

    def once(t):
        tail = F.regexp_extract(t, DESCRIPTOR_TAIL, 0)
        return F.when((tail != "") & tail.rlike(DESCRIPTOR), clean_name(F.regexp_replace(t, DESCRIPTOR_TAIL, ""))).otherwise(t)

    rounds = F.sequence(F.lit(1), _count(s, "(（") + 1)
    return F.when(s.rlike(DESCRIPTOR), F.aggregate(rounds, s, lambda acc, _: once(acc))).otherwise(s)
