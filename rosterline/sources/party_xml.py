"""Hierarchical party XML: names per script and address features.

Files are read with the XML source, one element per row (``rowTag``), under explicit schemas; the
same functions take elements parsed from text with ``from_xml``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.rows import explode_once

NAME_VALUE = "STRUCT<_NamePartGroupID: STRING, _ScriptID: STRING, _VALUE: STRING>"
DOCUMENTED = f"STRUCT<DocumentedNamePart: ARRAY<STRUCT<NamePartValue: ARRAY<{NAME_VALUE}>>>, NamePartValue: ARRAY<{NAME_VALUE}>>"
ALIAS = f"STRUCT<_Primary: STRING, _LowQuality: STRING, DocumentedName: ARRAY<{DOCUMENTED}>>"
FEATURE = "STRUCT<_ID: STRING, _FeatureTypeID: STRING, FeatureVersion: ARRAY<STRUCT<_ID: STRING, VersionDetail: ARRAY<STRING>>>>"
PROFILE = f"STRUCT<_ID: STRING, Identity: ARRAY<STRUCT<_False: STRING, Alias: ARRAY<{ALIAS}>>>, Feature: ARRAY<{FEATURE}>>"
PARTY_SCHEMA = f"_FixedRef STRING, Profile ARRAY<{PROFILE}>"
FEATURE_TYPE_SCHEMA = "_ID STRING, _VALUE STRING"
ENTRY_SCHEMA = "_ProfileID STRING, SanctionsMeasure ARRAY<STRUCT<Comment: ARRAY<STRING>>>"
# Root of the party file.
ROOT, NAMESPACE, VERSION = "Sanctions", "https://sanctionslistservice.ofac.treas.gov/api/PublicationPreview/exports/ADVANCED_XML", "3"
ADDRESS_LABEL = "^Digital Currency Address - ([A-Z0-9]+)$"
LATIN_SCRIPT = "215"


def read_elements(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("rowTag", tag).option("mode", "FAILFAST").xml(path)


def _flag(c):
    return F.lower(F.trim(F.coalesce(c, F.lit("false")))) == "true"


def _parts(documented):
    nested = F.flatten(F.transform(F.coalesce(documented["DocumentedNamePart"], F.array()), lambda p: F.coalesce(p["NamePartValue"], F.array())))
    return F.concat(nested, F.coalesce(documented["NamePartValue"], F.array()))


def _documented(parties: DataFrame) -> DataFrame:
    """One row per documented name in document order; identities marked false are skipped."""
    p = parties.select(F.col("_FixedRef").alias("party_id"), F.posexplode_outer("Profile").alias("i", "profile"))
    p = p.select("party_id", "i", F.posexplode_outer("profile.Identity").alias("j", "identity")).filter(~_flag(F.col("identity._False")) | F.col("identity").isNull())
    p = p.select("party_id", "i", "j", F.posexplode("identity.Alias").alias("k", "alias"))
    return p.select("party_id", "i", "j", "k", _flag(F.col("alias._Primary")).alias("primary"), _flag(F.col("alias._LowQuality")).alias("low_quality"),
                    F.posexplode("alias.DocumentedName").alias("m", "doc"))


def party_names(parties: DataFrame, label: str) -> DataFrame:
    """One row per (party, name): the parts of a documented name joined per script, first occurrence kept.

    Scripts are never mixed within one name and no comma or order is invented.
    """
    named = _documented(parties).withColumn("parts", F.filter(F.transform(_parts(F.col("doc")), lambda v: F.struct(
        F.coalesce(v["_ScriptID"], F.lit("")).alias("script"), N.clean_name(v["_VALUE"]).alias("text"))), lambda v: v["text"] != ""))
    scripts = F.array_distinct(F.transform("parts", lambda v: v["script"]))
    rows = explode_once(named, ["*"], scripts, "script_id", "n")
    text = F.array_join(F.transform(F.filter("parts", lambda v: v["script"] == F.col("script_id")), lambda v: v["text"]), " ")
    rows = rows.withColumn("name", N.clean_name(text)).filter("name <> ''")
    first = rows.groupBy("party_id", "name").agg(
        F.min_by(F.struct("script_id", "primary", "low_quality"), F.struct("i", "j", "k", "m", "n")).alias("r"))
    return first.select(
        F.lit("OFAC").alias("source"), F.lit(label).alias("category"), "name", F.col("party_id").alias("source_id"), F.col("r.script_id").alias("script_id"),
        F.col("r.primary").alias("alias_primary"), F.col("r.low_quality").alias("low_quality"), F.lit("advanced_xml_v3").alias("format"))


def _has_name() -> Column:
    """Whether ``party_names`` finds a name in the party: a part with text, outside identities marked false."""
    some = lambda array, test: F.coalesce(F.exists(array, test), F.lit(False))
    text = lambda doc: some(_parts(doc), lambda v: N.clean_name(v["_VALUE"]) != "")
    alias = lambda i: some(i["Alias"], lambda a: some(a["DocumentedName"], text))
    return some(F.col("Profile"), lambda p: some(p["Identity"], lambda i: ~_flag(i["_False"]) & alias(i)))


def party_violations(parties: DataFrame) -> DataFrame:
    """Parties without or with a repeated reference, and parties for which no name could be restored; each element is read once."""
    ref = F.coalesce(F.trim("_FixedRef"), F.lit(""))
    per_ref = parties.groupBy(ref.alias("party_id")).agg(F.count(F.lit(1)).alias("n"), F.bool_or(_has_name()).alias("named"))
    violation = F.when(F.col("party_id") == "", "REFERENCE_MISSING").when(F.col("n") > 1, "REFERENCE_REPEATED").when(~F.col("named"), "NO_NAME")
    return per_ref.select("party_id", violation.alias("violation")).filter("violation IS NOT NULL")


def file_violations(files: DataFrame, name_part_types: DataFrame, parties: DataFrame) -> DataFrame:
    """file, violation: what stops a whole party file.

    ``files``: file, head (its first characters, through the root element).  ``name_part_types``: file, _ID, _VALUE of the
    dictionary.  ``parties``: file and one row per party.  Declarations and comments before the root are skipped.
    """
    root = F.regexp_extract("head", r"(?s)^\ufeff?(?:\s|<\?.*?\?>|<!--.*?-->|<![^>]*>)*<([^\s/>]+)([^>]*)>", 1)
    attributes = F.regexp_extract("head", r"(?s)^\ufeff?(?:\s|<\?.*?\?>|<!--.*?-->|<![^>]*>)*<([^\s/>]+)([^>]*)>", 2)
    prefix, local = F.regexp_extract(root, "^(?:([^:]*):)?(.*)$", 1), F.regexp_extract(root, "^(?:([^:]*):)?(.*)$", 2)
    spaces = F.str_to_map(F.array_join(F.transform(F.regexp_extract_all(attributes, F.lit(r"""xmlns(?::[^=\s]+)?\s*=\s*["'][^"']*["']"""), F.lit(0)), lambda a: F.regexp_replace(
        a, r"""^xmlns:?([^=\s]*)\s*=\s*["']([^"']*)["']$""", "$1\u0001$2")), "\u0002"), F.lit("\u0002"), F.lit("\u0001"))
    namespace = F.coalesce(F.try_element_at(spaces, prefix), F.lit(""))
    version = F.regexp_extract(attributes, r"""(?:^|\s)Version\s*=\s*["']([^"']*)["']""", 1)
    typed = name_part_types.filter("trim(coalesce(_ID, '')) <> '' AND trim(coalesce(_VALUE, '')) <> ''").select("file", F.lit(True).alias("typed")).distinct()
    filled = parties.select("file", F.lit(True).alias("filled")).distinct()
    rules = [
        F.when(root == "", "ROOT_MISSING").when(local != ROOT, "ROOT_CHANGED").when(namespace == "", "NAMESPACE_MISSING")
        .when(namespace != NAMESPACE, "NAMESPACE_CHANGED").when(version != VERSION, "VERSION_CHANGED"),
        F.when(F.col("filled").isNull(), "NO_PARTIES").when(F.col("typed").isNull(), "NAME_PART_TYPES_MISSING")]
    j = files.join(typed, "file", "left").join(filled, "file", "left")
    return explode_once(j, ["file"], F.filter(F.array(*rules), lambda v: v.isNotNull()), "violation")


def address_features(parties: DataFrame, feature_types: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per listed address value with its position, symbol, primary name and program labels.

    ``violation`` marks address features whose type or value breaks the expected structure.
    """
    labels = feature_types.select(F.col("_ID").alias("type_id"), N.strip(F.col("_VALUE")).alias("label"))
    labels = labels.filter(F.startswith("label", F.lit("Digital Currency Address")))
    profiles = parties.select(F.col("_FixedRef").alias("party_id"), F.explode("Profile").alias("p"))
    features = profiles.select("party_id", F.col("p._ID").alias("profile_id"), F.explode("p.Feature").alias("f"))
    features = features.select("party_id", "profile_id", F.col("f._ID").alias("feature_id"), F.col("f._FeatureTypeID").alias("type_id"), "f.FeatureVersion").join(labels, "type_id")
    versions = features.select("party_id", "profile_id", "feature_id", "label", F.explode_outer("FeatureVersion").alias("v"))
    values = versions.select("party_id", "profile_id", "feature_id", "label", F.col("v._ID").alias("version_id"), F.posexplode_outer("v.VersionDetail").alias("pos", "address"))
    symbol = F.regexp_extract("label", ADDRESS_LABEL, 1)

    primary = _documented(parties).filter("primary").withColumn("text", F.array_join(F.transform(F.filter(
        _parts(F.col("doc")), lambda v: v["_ScriptID"] == LATIN_SCRIPT), lambda v: F.coalesce(v["_VALUE"], F.lit(""))), " ")).filter("text <> ''")
    primary = primary.groupBy("party_id").agg(F.min_by("text", F.struct("i", "j", "k", "m")).alias("entity_name"))
    comments = entries.select(F.col("_ProfileID").alias("profile_id"), F.explode("SanctionsMeasure").alias("m")).select(
        "profile_id", F.explode("m.Comment").alias("c")).select("profile_id", N.strip(F.col("c")).alias("c")).filter("c <> ''").distinct()
    programs = comments.groupBy("profile_id").agg(F.array_join(F.array_sort(F.collect_list("c")), " / ").alias("program"))
    violation = F.when(symbol == "", "LABEL_CHANGED").when(F.coalesce("feature_id", F.lit("")) == "", "FEATURE_ID_MISSING").when(
        F.coalesce("version_id", F.lit("")) == "", "VERSION_ID_MISSING").when(F.coalesce("address", F.lit("")) == "", "VALUE_MISSING")
    j = values.join(primary, "party_id", "left").join(programs, "profile_id", "left")
    return j.select(
        "party_id", "profile_id", "feature_id", "version_id", F.concat_ws("/", "party_id", "feature_id", "version_id", F.col("pos").cast("string")).alias("source_record_id"),
        F.format_string('DistinctParty[@FixedRef="%s"]/Profile[@ID="%s"]/Feature[@ID="%s"]/FeatureVersion[@ID="%s"]/VersionDetail[%d]',
                        "party_id", "profile_id", "feature_id", "version_id", F.col("pos") + 1).alias("evidence_locator"),
        F.coalesce("entity_name", F.lit("")).alias("entity_name"), symbol.alias("symbol"), "address", F.coalesce("program", F.lit("")).alias("program"), violation.alias("violation"))
