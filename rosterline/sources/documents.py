"""Document material: table rows, numbered lines, page links and the fetch audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import names as N
from ..functions.rows import explode_once
from ..operators.sequences import look_back, look_backs

LINES_PER_BUCKET = 10_000
# What opens and closes a numbered block, and the issues that block a document.
HEADER = r"^\s*(?:\(重複\)\s*)?(\d+)\s*\.\s*(.*)$"
SECTION = r"^(I{1,3}|IV|V|VI{0,3}|IX|X)\s+.*(?:告示|公告)"
RESET = r"^【(?:以下)?(?:[0-9]|平成|令和|昭和)"
PARTICLES = r"^(?:に|の|と|及び|および|で|を|から|、|\))"
UN_REFERENCE = r"国連参照番号\s*:\s*([A-Za-z]{2}[ie]\.[0-9]+)"
DELETED = r"^(?:\(\(重複\).*?\)\s*)?(?:※\s*)?(?:[0-9].*?解除|削除|解除)"
PUBLISHED = "([0-9]+)個人(?:及び|および)([0-9]+)団体"
FATAL = ["NO_RECORDS", "DUPLICATE_NUMBER", "NUMBER_SEQUENCE", "PRIMARY_MISSING", "COUNT_MISMATCH", "IMAGE_OR_EMPTY_PAGE"]


def record_lines(rows: DataFrame, cells: list[str]) -> DataFrame:
    """Table rows (doc, i, no, is_header, cells...) with the record each belongs to (doc, start, i, no, cells...): a numbered row starts
    one, rows without a number (``no`` is NULL) continue it.

    A repeated header ends the open record; rows before the first header and rows with another mark in the number cell belong to none.
    Records stay in long form; ``stitch_rows`` or ``sinks.fold_cells`` make one row of each.
    """
    bucket = F.floor(F.col("i") / LINES_PER_BUCKET)
    numbered = F.col("no").rlike(r"^\d+$")
    mark = F.when(F.col("is_header"), F.struct(F.lit(True).alias("header"), F.col("i").alias("start"))).when(
        numbered, F.struct(F.lit(False).alias("header"), F.col("i").alias("start")))
    rows = look_backs(rows, ["doc"], bucket, ["i"], {"island": (mark, True), "table": (F.when(F.col("is_header"), F.col("i")), True)})
    own = rows.filter("table IS NOT NULL AND NOT is_header AND NOT island.header").filter(numbered | (F.col("no") == ""))
    return own.select("doc", F.col("island.start").alias("start"), "i", F.when(numbered, F.col("no").try_cast("bigint")).alias("no"), *cells)


def stitch_rows(rows: DataFrame, cells: list[str]) -> DataFrame:
    """One row per record of ``record_lines``: its number, its number of rows and its cells, lines joined in order."""
    text = lambda c: F.array_join(F.transform(F.filter(F.array_sort(F.collect_list(F.struct("i", c))), lambda x: x[c] != ""), lambda x: x[c]), "\n")
    return record_lines(rows, cells).groupBy("doc", "start").agg(
        F.max("no").alias("no"), F.count(F.lit(1)).alias("n_rows"), *[text(c).alias(c) for c in cells])


def block_lines(lines: DataFrame, un_list: Column | None = None) -> DataFrame:
    """Lines of numbered blocks (doc, start, number, head, section, i, page, text): a header opens a block, section heads and marks
    close it.  Documents of the ``un_list`` have the one section UN and no section heads; the others begin in section I."""
    un = F.lit(False) if un_list is None else un_list
    text = N.strip(F.col("line"))
    number, head = F.regexp_extract(text, HEADER, 1), F.regexp_extract(text, HEADER, 2)
    section = F.when(un, F.lit("")).otherwise(F.regexp_extract(text, SECTION, 1))
    ends = text.rlike(RESET) | text.isin("(了)", "(注)")
    opens = (section == "") & ~ends & (number != "") & ~head.rlike(PARTICLES)
    bucket = F.floor(F.col("i") / LINES_PER_BUCKET)
    mark = F.when((section != "") | ends, F.struct(F.lit(None).cast("bigint").alias("start"), F.lit("").alias("number"), F.lit("").alias("head"))).when(
        opens, F.struct(F.col("i").cast("bigint").alias("start"), number.alias("number"), head.alias("head")))
    rows = look_backs(lines, ["doc"], bucket, ["i"], {"block": (mark, True), "section": (F.when(section != "", section), True)})
    return rows.filter("block.start IS NOT NULL").select(
        "doc", F.col("block.start").alias("start"), F.col("block.number").try_cast("bigint").alias("number"), F.col("block.head").alias("head"),
        F.when(un, "UN").otherwise(F.coalesce("section", F.lit("I"))).alias("section"), "i", "page", text.alias("text"))


def numbered_blocks(lines: DataFrame, un_list: Column | None = None) -> DataFrame:
    """One row per numbered block of document lines (doc, i, page, line).

    The party type follows from a birth date, a place, a United Nations reference number or a notice link; ``current`` is false
    where the head says that the entry was deleted.  The text stays in ``block_lines``, one row per line.
    """
    rows = block_lines(lines, un_list)
    text = F.col("text")
    blocks = rows.groupBy("doc", "start").agg(
        F.max("number").alias("number"), F.max("section").alias("section"), F.max("head").alias("head"), F.count_if(text != "").alias("n_lines"),
        F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.sum(F.char_length("text")).alias("n_chars"),
        F.min_by(F.nullif(F.regexp_extract("text", UN_REFERENCE, 1), F.lit("")), F.when(text.rlike(UN_REFERENCE), F.col("i"))).alias("external_id"),
        F.bool_or(text.rlike(r"^生年月日\s*:") | text.rlike("View-UN-Notices-Individuals")).alias("person"),
        F.bool_or(text.rlike(r"^所在地\s*(?::|$)") | text.rlike("View-UN-Notices-Entities")).alias("entity"))
    listed = F.coalesce("external_id", F.lit(""))
    person, entity = F.col("person") | listed.rlike(r"[A-Z]{2}i\.[0-9]+"), F.col("entity") | listed.rlike(r"[A-Z]{2}e\.[0-9]+")
    kind = F.when(person & ~entity, "person").when(entity & ~person, "entity").otherwise("unknown")
    return blocks.select("doc", "start", "number", "section", "n_lines", "first_page", "last_page", "n_chars", listed.alias("external_id"),
                         (~F.col("head").rlike(DELETED)).alias("current"), kind.alias("party_type"))


def empty_pages(lines: DataFrame) -> DataFrame:
    """IMAGE_OR_EMPTY_PAGE per page (doc, page) of fewer than 20 characters between its first and last text."""
    text = N.strip(F.col("line"))
    at = F.when(text != "", F.col("i"))
    breaks = F.coalesce(F.max(at) - F.min(at), F.lit(0))
    return lines.groupBy("doc", "page").agg((F.sum(F.char_length(text)) + breaks).alias("n")).filter("n < 20").select(
        "doc", "page", F.lit("IMAGE_OR_EMPTY_PAGE").alias("code"))


def published_counts(lines: DataFrame) -> DataFrame:
    """Persons and entities that a document declares in its text (first place), also where the words break over two lines."""
    bucket = F.floor(F.col("i") / LINES_PER_BUCKET)
    rows = look_back(lines.select("doc", "i", "line"), ["doc"], bucket, ["i"], F.col("line"), "before", inclusive=False)
    joined = F.regexp_replace(F.concat(F.coalesce("before", F.lit("")), "line"), r"(?U)\s+", "")
    found = rows.select("doc", "i", *[F.regexp_extract(joined, PUBLISHED, g).try_cast("bigint").alias(c) for g, c in ((1, "persons"), (2, "entities"))])
    return found.filter("persons IS NOT NULL").groupBy("doc").agg(
        F.min_by("persons", "i").alias("persons"), F.min_by("entities", "i").alias("entities"))


def _followed(numbers: DataFrame, part: list[str], order: str, number: str) -> DataFrame:
    """Add ``expected``: one more than the number before, or 1."""
    rows = look_back(numbers, part, F.floor(F.col(order) / LINES_PER_BUCKET), [order], F.col(number), "before", inclusive=False)
    return rows.withColumn("expected", F.coalesce("before", F.lit(0)) + 1).drop("before")


def sequence_violations(numbers: DataFrame, part: list[str], order: str, number: str) -> DataFrame:
    """Numbers of a section that repeat or do not follow their predecessor by one; rows without a number are in no sequence gap.

    Every number asks both questions in one aggregate: a gap is a group of its own row, a repetition the group of its number."""
    rows = _followed(numbers, part, order, number)
    gap = F.when(F.col(number) != F.col("expected"), F.struct(F.lit("NUMBER_SEQUENCE").alias("violation"), F.col("expected"), F.col(order).alias("at")))
    twice = F.struct(F.lit("DUPLICATE_NUMBER").alias("violation"), F.lit(None).cast(rows.schema["expected"].dataType).alias("expected"),
                     F.lit(None).cast(rows.schema[order].dataType).alias("at"))
    asked = rows.select(*part, F.col(number).alias("number"), F.explode(F.array(gap, twice)).alias("v")).filter("v IS NOT NULL")
    counted = asked.groupBy(*part, "number", "v").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("v.violation") == "NUMBER_SEQUENCE") | (F.col("n") > 1)).select(*part, "number", "v.expected", "v.violation")


def block_summary(blocks: DataFrame) -> DataFrame:
    """Blocks, current persons and entities, and violations of the numbering per document, from one pass over ``numbered_blocks``."""
    current = lambda kind: F.col("current") & (F.col("party_type") == kind)
    rows = _followed(blocks, ["doc", "section"], "start", "number")
    per_number = rows.groupBy("doc", "section", "number").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("number") != F.col("expected")).alias("gaps"),
        F.count_if(current("person")).alias("persons"), F.count_if(current("entity")).alias("entities"))
    return per_number.groupBy("doc").agg(
        F.sum("n").alias("n_blocks"), F.sum("persons").alias("n_persons"), F.sum("entities").alias("n_entities"),
        (F.sum("gaps") + F.count_if(F.col("n") > 1)).alias("n_violations"))


def count_agreement(actual: DataFrame, declared: DataFrame, keys: list[str]) -> DataFrame:
    """Declared numbers against counted ones.  ``actual`` / ``declared``: keys + name + value; every disagreement is a row."""
    a = actual.withColumnRenamed("value", "actual")
    d = declared.withColumnRenamed("value", "declared")
    j = d.join(a, [*keys, "name"], "full_outer")
    return j.filter(~F.coalesce("declared", F.lit(0)).eqNullSafe(F.coalesce("actual", F.lit(0)))).select(
        *keys, "name", F.coalesce("declared", F.lit(0)).alias("declared"), F.coalesce("actual", F.lit(0)).alias("actual"))


def document_gate(documents: DataFrame, summary: DataFrame, issues: DataFrame, published: DataFrame) -> DataFrame:
    """BLOCKED or REVIEW_REQUIRED per document, from violations of the numbering (``block_summary``), other fatal issues, missing blocks and
    published counts of current persons and entities.  ``issues`` (doc, code) may hold any code, such as PRIMARY_MISSING from a
    name extraction."""
    others = issues.groupBy("doc").agg(F.count(F.lit(1)).alias("n_others"), F.count_if(F.col("code").isin(FATAL)).alias("n_fatal"))
    j = documents.select("doc").join(summary, "doc", "left").join(others, "doc", "left").join(published, "doc", "left").fillna(
        0, ["n_blocks", "n_persons", "n_entities", "n_violations", "n_others", "n_fatal"])
    mismatch = F.col("persons").isNotNull() & ((F.col("persons") != F.col("n_persons")) | (F.col("entities") != F.col("n_entities")))
    blocked = (F.col("n_violations") + F.col("n_fatal") > 0) | (F.col("n_blocks") == 0) | mismatch
    return j.select("doc", F.when(blocked, "BLOCKED").otherwise("REVIEW_REQUIRED").alias("status"), "n_blocks",
                    (F.col("n_violations") + F.col("n_others")).alias("n_issues"), mismatch.alias("count_mismatch"))


# --- pages -------------------------------------------------------------------------------

# The keywords of a release.
KEYWORDS = ["資産凍結", "制裁", "措置対象者", "追加", "削除", "解除", "外為法", "タリバーン", "テロリスト", "ウクライナ"]
LINK = r'(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>'


def page_links(pages: DataFrame, allowed_hosts: list[str]) -> DataFrame:
    """Links of page sources (page_id, url, html): resolved, classified, with policy verdict and the keyword reasons of the page.

    The whole source is scanned once per column; a page's links are exploded, never gathered.
    """
    base = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1)
    folder = F.regexp_extract("url", r"^(https?://[^/?#]+(?:/[^?#]*/|/)?)", 1)
    scheme = F.regexp_extract("url", r"^(https?):", 1)
    words = F.filter(F.array(*[F.lit(w) for w in KEYWORDS]), lambda w: F.contains(F.col("html"), w))
    pairs = F.arrays_zip(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(LINK), F.lit(2)).alias("text"))
    rows = explode_once(
        pages, ["page_id", base.alias("base"), folder.alias("folder"), scheme.alias("scheme"), words.alias("reasons")], pairs, "a")
    href = F.regexp_replace("a.href", "#.*$", "")
    url = (
        F.when(href.rlike("(?i)^https?://"), href).when(F.startswith(href, F.lit("//")), F.concat(F.col("scheme"), F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(F.col("base"), href))
        .otherwise(F.concat(F.when(F.col("folder") == F.col("base"), F.concat(F.col("base"), F.lit("/"))).otherwise(F.col("folder")), href)))
    rows = rows.withColumn("link", url).withColumn("host", F.regexp_extract(F.col("link"), r"^https://([^/?#]+)(?:[/?#]|$)", 1))
    policy = F.col("host").isin(allowed_hosts) & ~F.col("link").rlike(r"\s")
    role = F.when(F.col("link").rlike(r"(?i)\.pdf(\?|$)"), "attachment_pdf").when(F.col("link").rlike(r"\.html(\?|$)"), "notice").otherwise("other")
    return rows.select("page_id", F.col("link").alias("url"), N.clean_name(F.regexp_replace("a.text", "<[^>]*>", "")).alias("text"), role.alias("role"),
                       F.when(policy, "official").otherwise("external").alias("policy"), F.array_join("reasons", ";").alias("reasons"))


# What a page catalogue is read by.
MAIN, LISTING, LIST_PHRASE, RELEASE_HEADING = "maincontents", "pressrelease", "資産凍結措置対象リスト", "報道発表"
LIST_ROLES = {"current_1373": "1373", "current_un": "1267"}
ERA = 2018
TOKEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[^>]*>|[^<]+"
NAME, NO_TAG = r"^</?([A-Za-z][A-Za-z0-9]*)", r"(?i)^<(?:!|script\b|style\b)"
LINKS_AND_HEADS = r"(?i)^[^<]*[^< \r\n\t]|^</?(?:a|li|p|dd|dt|h2|h3)(?![A-Za-z0-9])"  # texts that are not blank, and these tags
LINK_TAG, BLOCK_TAG, HEAD_TAG = 1, 2, 3  # what a tag opens, or closes (negative); 0 is a text
TAG_KINDS = {LINK_TAG: ["a"], BLOCK_TAG: ["li", "p", "dd"], HEAD_TAG: ["dt", "h2", "h3"]}


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, quoted or not; NULL if the tag does not have it."""
    pattern = rf"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))"
    found = F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    return F.when(tag.rlike(rf"(?is)\s{name}\s*="), found)


def _region(rows: DataFrame, element: str, out: str) -> DataFrame:
    """Add ``out``: first and last place (from, to) in ``tokens`` of the first element with that id, from its tag to the one that closes it, or
    to the end; NULL without one.

    A fold over the tokens of one page that keeps two numbers: what is outside is left before a token becomes a row."""
    tag = F.col("__tag")
    name = lambda t: F.when(F.startswith(t, F.lit("<")), F.lower(F.regexp_extract(t, NAME, 1))).otherwise("")
    found = lambda t: F.contains(t, F.lit(element)) & F.startswith(t, F.lit("<")) & ~F.startswith(t, F.lit("</")) & ~t.rlike(NO_TAG) & (_attribute(t, "id") == element)
    rows = rows.withColumn("__at", F.array_min(F.transform("tokens", lambda t, i: F.when(found(t), i))))
    rows = rows.withColumn("__tag", name(F.get("tokens", F.col("__at"))))
    start = F.struct(F.lit(0).alias("open"), F.col("__at").alias("i"), F.lit(None).cast("int").alias("to"))

    def step(acc, t):
        counts = (name(t) == tag) & ~t.rlike(NO_TAG)
        n = acc["open"] + F.when(counts, F.when(F.startswith(t, F.lit("</")), -1).otherwise(1)).otherwise(0)
        return F.when(acc["to"].isNotNull(), acc).otherwise(F.struct(n.alias("open"), (acc["i"] + 1).alias("i"), F.when(counts & (n == 0), acc["i"]).alias("to")))

    to = F.aggregate(F.slice("tokens", F.col("__at") + 1, F.size("tokens")), start, step, lambda acc: F.coalesce(acc["to"], acc["i"] - 1))
    return rows.withColumn(out, F.when(F.col("__at").isNotNull(), F.struct(F.col("__at").alias("from"), to.alias("to")))).drop("__at", "__tag")


def main_tokens(pages: DataFrame, kinds: str) -> DataFrame:
    """Tags and texts of the main part of page sources (page_id, url, html) whose beginning matches ``kinds``, in order: page_id, url, i,
    token, listed (inside the release listing, or no listing in the page)."""
    rows = pages.select("page_id", "url", F.regexp_extract_all("html", F.lit(TOKEN), F.lit(0)).alias("tokens"))
    rows = _region(_region(rows, MAIN, "main"), LISTING, "listing")
    part = F.when(F.col("main").isNotNull(), F.slice("tokens", F.col("main.from") + 1, F.col("main.to") - F.col("main.from") + 1))
    rows = explode_once(rows, ["page_id", "url", F.col("main.from").alias("from"), "listing"], part, "token", "pos").withColumn("i", F.col("pos") + F.col("from"))
    listed = F.col("listing").isNull() | F.col("i").between(F.col("listing.from"), F.col("listing.to"))
    return rows.filter(F.col("token").rlike(kinds)).select("page_id", "url", "i", "token", listed.alias("listed"))


def _shown(text: Column) -> Column:
    """A text as it is shown."""
    for mark, value in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(mark), F.lit(value))
    return text


def _mark(name: Column, closing: Column) -> Column:
    """The kind of a tag, negative if it closes; 0 for a text."""
    mark = F.lit(0)
    for kind, names in TAG_KINDS.items():
        mark = F.when(name.isin(names), F.when(closing, -kind).otherwise(kind)).otherwise(mark)
    return mark.cast("byte")


def _depth(kind: int) -> Column:
    """How many tags of a kind are open at a row."""
    step = F.when(F.col("mark") == kind, 1).when(F.col("mark") == -kind, -1).otherwise(0)
    return F.sum(step).over(W.partitionBy("page_id").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow))


def _resolved(url: Column, href: Column) -> Column:
    """``href`` against the page's ``url``, without fragment."""
    base, folder = F.regexp_extract(url, r"^(https?://[^/?#]+)", 1), F.regexp_extract(url, r"^(https?://[^/?#]+(?:/[^?#]*/|/)?)", 1)
    h = F.regexp_replace(href, "#.*$", "")
    return (F.when(h.rlike("(?i)^https?://"), h).when(F.startswith(h, F.lit("//")), F.concat(F.regexp_extract(url, r"^(https?):", 1), F.lit(":"), h))
            .when(F.startswith(h, F.lit("/")), F.concat(base, h))
            .otherwise(F.concat(F.when(folder == base, F.concat(base, F.lit("/"))).otherwise(folder), h)))


def page_anchors(pages: DataFrame, allowed_hosts: list[str]) -> DataFrame:
    """Links of the main part of page sources (page_id, url, html): page_id, page, i, href, url (resolved), title, official (an allowed host over
    https), listed (inside the release listing, or no listing there), in_entry (inside a list entry or paragraph that names the current
    lists), month and day of the last dated heading."""
    token, opens, href = F.col("token"), F.col("mark") == LINK_TAG, _attribute(F.col("token"), "href")
    # what a moved row holds: a mark and, of a tag that opens a link, its target, or of a text, the text
    rows = main_tokens(pages, LINKS_AND_HEADS).withColumn("name", F.lower(F.regexp_extract(token, NAME, 1)))
    rows = rows.withColumn("mark", _mark(F.col("name"), F.startswith(token, F.lit("</")))).select(
        "page_id", "i", "listed", "mark", F.when(opens, F.struct("url", href.alias("href"))).alias("link"),
        F.when(F.col("mark") == 0, _shown(token)).alias("text"))
    # all windows over one order: a page's rows move and are sorted once
    upto = W.partitionBy("page_id").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumns({"__block": _depth(BLOCK_TAG), "__head": _depth(HEAD_TAG), "__a": _depth(LINK_TAG), "anchor": F.sum(F.when(opens, 1).otherwise(0)).over(upto)})
    rows = rows.withColumn("__block_no", F.sum(F.when((F.col("mark") == BLOCK_TAG) & (F.col("__block") == 1), 1).otherwise(0)).over(upto))
    day = F.when((F.col("__head") > 0) & F.col("listed"), F.regexp_extract("text", r"(\d{1,2})月\s*(\d{1,2})日", 0))
    rows = rows.withColumn("dated", F.last(F.when(day != "", day), ignorenulls=True).over(upto))
    named = F.coalesce(F.contains("text", F.lit(LIST_PHRASE)), F.lit(False)) & (F.col("__block") > 0)
    rows = rows.withColumn("in_entry", F.max(named).over(W.partitionBy("page_id", "__block_no")) & (F.col("__block") > 0))
    inside = (F.col("__a") > 0) | opens
    own = lambda c: F.max(F.when(opens, F.col(c)))  # noqa: E731  # of the one tag that opens the link; what a query does not ask for is not worked out
    links = rows.filter(inside).groupBy("page_id", "anchor").agg(
        F.min("i").alias("i"), *[own(c).alias(c.split(".")[-1]) for c in ("link.url", "link.href", "listed", "in_entry", "dated")],
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("i", "text")))), lambda t: t["text"]), " ").alias("title"))
    number = lambda i: F.regexp_extract("dated", r"(\d{1,2})月\s*(\d{1,2})日", i).try_cast("int")
    found = links.filter("href IS NOT NULL").withColumn("link", _resolved(F.col("url"), F.col("href")))
    host = F.regexp_extract("link", r"^https://([^/?#]+)(?:[/?#]|$)", 1)
    return found.select(
        "page_id", F.col("url").alias("page"), "i", "href", F.col("link").alias("url"), N.clean_name(F.col("title")).alias("title"),
        (host.isin(allowed_hosts) & ~F.col("link").rlike(r"\s")).alias("official"), "listed", "in_entry",
        number(1).alias("month"), number(2).alias("day"))


def _is_pdf(c: Column) -> Column:
    return c.rlike(r"(?i)\.pdf(\?|$)")


def current_lists(anchors: DataFrame) -> DataFrame:
    """The current lists of catalogue pages: page_id, role, url, title; one row for each different url of a role."""
    role = F.lit(None).cast("string")
    for name, mark in reversed(list(LIST_ROLES.items())):  # 1373 before 1267
        role = F.when(F.contains("title", F.lit(mark)), name).otherwise(role)
    found = anchors.filter(F.col("in_entry") & _is_pdf(F.col("href"))).withColumn("role", role).filter("role IS NOT NULL")
    return found.groupBy("page_id", "role", "url").agg(F.max_by("title", "i").alias("title"), F.bool_and("official").alias("official"))


def catalog_violations(pages: DataFrame, lists: DataFrame) -> DataFrame:
    """Gates of catalogue pages (page_id, html): page_id, violation, role.  A missing main part hides the roles."""
    main = F.coalesce(F.col("html").rlike(rf"(?is)<[a-z][^>]*\sid\s*=\s*[\"']?{MAIN}\b"), F.lit(False))
    per_role = lists.groupBy("page_id", "role").agg(F.count(F.lit(1)).alias("n"), F.bool_and("official").alias("official"))
    wanted = pages.select("page_id", (F.coalesce("html", F.lit("")) == "").alias("empty"), main.alias("main"))
    wide = wanted.select("page_id", "empty", "main", F.explode(F.array(*map(F.lit, LIST_ROLES))).alias("role")).join(per_role, ["page_id", "role"], "left")
    page = F.when(F.col("empty"), "EMPTY_HTML").when(~F.col("main"), "MAIN_MISSING")
    violation = F.coalesce(page, F.when(F.col("n").isNull(), "CURRENT_LIST_MISSING").when(F.col("n") > 1, "DUPLICATE_CURRENT_LIST").when(~F.col("official"), "FORBIDDEN_URL"))
    return wide.select("page_id", violation.alias("violation"), F.when(page.isNull(), F.col("role")).alias("role")).filter("violation IS NOT NULL").distinct()


def release_entries(anchors: DataFrame, months: DataFrame) -> DataFrame:
    """Entries of release listings for a month (``months``: page_id, year, month_no): page_id, kind, url, date, title, violation.

    Links of months (archives) carry the first of the month; dated links of the listing are notices.  A rolling index may hold entries of
    other months, which are left out; on an archive page (``rolling`` false) they are a violation."""
    era, modern = r"/release/(\d+)_(\d+)_index\.html", r"/release/(\d{4})/(\d+)\.html"
    part = lambda pattern, i: F.regexp_extract("href", pattern, i).try_cast("int")
    year = F.coalesce(part(era, 1) + ERA, part(modern, 1))
    month = F.coalesce(part(era, 2), part(modern, 2))
    date = lambda *parts: F.try_make_timestamp(*parts, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    entry = lambda kind, day, violation: F.struct(F.lit(kind).alias("kind"), F.struct(day.alias("date"), "title", violation.alias("violation")).alias("n"))
    first, day = date(year, month, F.lit(1)), date("year", "month", "day")
    archive = F.when(year.isNotNull(), entry("archive", first, F.when(first.isNull(), "BAD_ARCHIVE_MONTH").when(~F.col("official"), "FORBIDDEN_URL")))
    dated = F.col("asked") & F.col("listed") & F.col("month").isNotNull() & ~F.col("href").rlike(r"_index\.html|/\d{4}/\d+\.html|#archives")
    other = F.col("month") != F.col("month_no")
    violation = (F.when(day.isNull(), "BAD_DATE").when(~F.col("href").rlike(r"\.html(\?|$)"), "UNKNOWN_LINK").when(~F.col("official"), "FORBIDDEN_URL")
                 .when(other, "CONTRADICTS_MONTH"))
    notice = F.when(dated & (F.coalesce(~(F.col("rolling") & other), F.lit(True)) | day.isNull()), entry("notice", day, violation))
    # a link may be both; one pass over the links gives either
    links = anchors.join(months.withColumn("asked", F.lit(True)), "page_id", "left")
    found = explode_once(links, ["page_id", "url", "i"], F.array_compact(F.array(archive, notice)), "e")
    # a notice that several entries name counts once, with the last one's date
    found = found.groupBy("page_id", F.col("e.kind").alias("kind"), "url").agg(F.max_by("e.n", "i").alias("last"), F.max("e.n").alias("most"))
    n = F.when(F.col("kind") == "notice", F.col("last")).otherwise(F.col("most"))
    return found.select("page_id", "kind", "url", n["date"].alias("date"), n["title"].alias("title"), n["violation"].alias("violation"))


def page_documents(anchors: DataFrame) -> DataFrame:
    """PDFs of release bodies, each url of a page once: page_id, url, title, role (attachment_pdf, or external_pdf elsewhere)."""
    pdfs = anchors.filter(_is_pdf(F.col("url"))).groupBy("page_id", "url", "official").agg(F.min_by("title", "i").alias("title"))
    return pdfs.select("page_id", "url", "title", F.when(F.col("official"), "attachment_pdf").otherwise("external_pdf").alias("role"))


def page_reasons(pages: DataFrame) -> DataFrame:
    """page_id, reasons: the keywords in the texts of the main part; tags, scripts and comments do not count."""
    texts = main_tokens(pages, "^[^<]").select("page_id", _shown(F.col("token")).alias("text"))
    has = [F.max(F.contains("text", F.lit(w))).alias(f"w{i}") for i, w in enumerate(KEYWORDS)]
    found = texts.groupBy("page_id").agg(*has)
    return found.select("page_id", F.array_join(F.array(*[F.when(F.col(f"w{i}"), w) for i, w in enumerate(KEYWORDS)]), ";").alias("reasons"))


# --- fetch audit -------------------------------------------------------------------------

SIGNED = r"""(https?://[^\s<>"'?#]+)\?[^\s<>"'#]*(?i:x-amz-)[^\s<>"'#]*(#[^\s<>"']*)?"""


def redact_urls(text: Column) -> Column:
    """Drop query and fragment of URLs whose query carries a temporary signature; other URLs stay whole."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SIGNED, "$1")


LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def audit_rows(entries: DataFrame) -> DataFrame:
    """Fetch-audit rows as stored: signed URLs redacted, whole error text on one line, month partition."""
    # a break at the end of the text ends its last line and is no gap
    flat = F.regexp_replace(F.translate(F.coalesce("error_message", F.lit("")), "\u0000", ""), rf"(?:{LINE_BREAK})\z", "")
    flat = F.regexp_replace(flat, LINE_BREAK, " ")
    flag = lambda c: F.when(F.coalesce(c, F.lit(False)), "1").otherwise("0").alias(c)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return entries.select(
        "entry_id", "checked_at", "source", "document_role", "status", *[blank(c) for c in ("http_status", "etag", "last_modified", "content_hash", "source_updated")],
        redact_urls(F.col("url")).alias("url"), redact_urls(F.col("final_url")).alias("final_url"), blank("fetched_file"), blank("raw_path"), blank("record_count"),
        blank("diff_added"), blank("diff_removed"), blank("diff_changed"), flag("fetch_failed"), flag("schema_changed"), blank("error_type"),
        redact_urls(flat).alias("error_message"), F.left("checked_at", F.lit(7)).alias("month"))


def append_audit(entries: DataFrame, path: str) -> None:
    audit_rows(entries).write.mode("append").partitionBy("month").parquet(path)
