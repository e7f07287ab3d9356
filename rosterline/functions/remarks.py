"""Remark text to (source, category) pairs and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .names import strip
from .rows import bound

PAIR = "array<struct<source:string,category:string>>"

# Spellings of one category.
CATEGORY_SYNONYMS = {
    "タリバーン関係者": "タリバーン関係者等",
    "タリバーン関係者等リストの改正": "タリバーン関係者等",
    "ハイチ": "ハイチ共和国",
    "ハイチにおける平和等を脅かす行為等に関与した者等": "ハイチ共和国",
}


def _replace_all(c: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for source, target in mapping.items():
        expr = F.when(c == source, target) if expr is None else expr.when(c == source, target)
    return expr.otherwise(c)


def strip_category_numbers(c: Column) -> Column:
    parts = F.transform(F.split(c, "[、,]"), lambda p: strip(
        F.regexp_replace(p, r"^\s*(?:[0-9０-９]+\s*[.．]\s*)+", "")))
    return F.array_join(F.filter(parts, lambda p: p != ""), "、")


def canonical_category(c: Column) -> Column:
    s = F.translate(strip(c), "（）;", "()；")
    s = strip(F.regexp_replace(s, r"(?U)[\s\u3000\u200b\ufeff]+", " "))
    s = F.regexp_replace(s, r"\s*\(\s*", "(")
    s = F.regexp_replace(s, r"\s*\)\s*", ")")
    s = F.regexp_replace(s, r"\s*[？；]\s*", "；")
    lead = F.length(F.translate(s, "(", "")) - F.length(F.translate(s, ")", ""))  # closers - openers
    s = F.when(lead < 0, F.concat(s, F.repeat(F.lit(")"), -lead))).when(
        lead > 0, F.concat(F.repeat(F.lit("("), lead), s)).otherwise(s)
    parts = F.filter(F.transform(F.split(s, "、"), strip), lambda p: p != "")
    parts = F.transform(parts, lambda p: _replace_all(p, CATEGORY_SYNONYMS))
    return F.array_join(F.array_distinct(parts), "、")


def _pair(source, category) -> Column:
    source = F.lit(source) if isinstance(source, str) else source
    category = F.lit(category) if isinstance(category, str) else category
    return F.struct(source.alias("source"), category.alias("category"))


def parse_remark(c: Column) -> Column:
    """One legacy remark to one (source, category); rule order decides."""
    v = strip(c)
    u = F.upper(v)
    listed = r"^制裁リスト\s*[（(]\s*(.*?)\s*[)）]?\s*$"
    numbered = canonical_category(strip_category_numbers(v))
    return (
        F.when(v == "", _pair(K.SRC_UNKNOWN, ""))
        .when(u.contains("OFAC") | u.contains("OFCA"), _pair(K.SRC_OFAC, ""))
        .when(u.contains("FCDO"), _pair(K.SRC_UK, ""))
        .when(u.contains("METI") | v.contains("経産"), _pair(K.SRC_METI, ""))
        .when(v.contains("外務省告示"), _pair(K.SRC_MOFA, canonical_category(v)))
        .when(v.contains("誤登録"), _pair(K.SRC_UNKNOWN, "誤登録"))
        .when(v.rlike("財務省|財務諸表"), _pair(K.SRC_MOF, canonical_category(strip_category_numbers(
            strip(F.regexp_replace(v, "財務諸表|財務省", ""))))))
        .when(v.rlike(listed), _pair(K.SRC_MOF, canonical_category(strip_category_numbers(
            F.regexp_extract(v, listed, 1)))))
        .when(v.rlike(r"^\s*[0-9０-９]+\s*[.．]"), _pair(K.SRC_MOF, numbered))
        .when(v.contains("外為法"), _pair(K.SRC_UNKNOWN, v))
        .otherwise(_pair(K.SRC_MOF, canonical_category(v)))
    )


def parse_remark_multi(c: Column) -> Column:
    """Remark to pairs: the canonical ``制裁リスト（出所：区分／…）`` form first, else the legacy rules."""
    v = strip(c)
    canonical = r"^\s*制裁リスト\s*[（(]\s*(.+?)\s*[)）]\s*$"
    parts = F.filter(F.transform(F.split(F.regexp_extract(v, canonical, 1), "／"), strip), lambda p: p != "")
    label = lambda p: strip(F.element_at(F.split(p, "：", 2), 1))
    known = F.forall(parts, lambda p: ~p.contains("：") | label(p).isin(list(K.SOURCE_ORDER)))

    def expand(p):
        cats = F.filter(F.split(F.element_at(F.split(p, "：", 2), -1), "、"), lambda q: strip(q) != "")
        tagged = F.when(F.size(cats) == 0, F.array(_pair(label(p), ""))).otherwise(
            F.transform(cats, lambda q: _pair(label(p), canonical_category(q))))
        return F.when(p.contains("："), tagged).otherwise(F.array(parse_remark(p)))

    ok = v.rlike(canonical) & (F.size(parts) > 0) & known
    return F.when(ok, F.flatten(F.transform(parts, expand))).otherwise(F.array(parse_remark(v)))


def source_rank(c: Column) -> Column:
    expr = None
    for name, rank in K.SOURCE_ORDER.items():
        expr = F.when(c == name, rank) if expr is None else expr.when(c == name, rank)
    return expr.otherwise(K.OTHER_SOURCE_ORDER)


def render_remark(pairs: Column) -> Column:
    """Pairs to remark text: sources in fixed order, categories in first-seen order."""
    return bound(pairs, _rendered)


def _rendered(pairs: Column) -> Column:
    ranked = F.array_sort(F.array_distinct(F.transform(
        pairs, lambda p: F.struct(source_rank(p["source"]).alias("rank"), p["source"].alias("source")))))

    def block(s):
        own = F.filter(pairs, lambda p: (p["source"] == s["source"]) & (p["category"] != ""))
        return bound(F.array_distinct(F.transform(own, lambda p: p["category"])), lambda cats: F.when(s["source"] == K.SRC_UNKNOWN, cats).when(
            F.size(cats) == 0, F.array(s["source"])).otherwise(
            F.array(F.concat(s["source"], F.lit("："), F.array_join(cats, "、")))))

    return bound(F.flatten(F.transform(ranked, block)), lambda parts: F.when(F.size(parts) == 0, F.lit("制裁リスト")).otherwise(
        F.concat(F.lit("制裁リスト（"), F.array_join(parts, "／"), F.lit("）"))))


def pairs_of(sources: Column, categories: Column) -> Column:
    """(source, category) pairs of a master row; a source without its own category keeps an empty one."""
    def own(s, cats):
        return bound(F.filter(cats, lambda c: F.startswith(c, F.concat(s, F.lit(":")))), lambda mine: F.when(
            F.size(mine) == 0, F.array(_pair(s, ""))).otherwise(F.transform(mine, lambda c: _pair(s, F.substring(c, F.length(s) + 2, F.length(c))))))

    return bound(categories, lambda cats: F.flatten(F.transform(sources, lambda s: own(s, cats))))


def remark_of(sources: Column, categories: Column) -> Column:
    return render_remark(pairs_of(sources, categories))
