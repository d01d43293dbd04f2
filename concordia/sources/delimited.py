"""Delimited sources: vocabularies, laboratory codes, protocols, data elements, codelists, project files."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.numbers import tolerant_bounds, tolerant_long
from ..schema import to_elements
from .records import PLACE, read_records


def sniff_delimiter(spark: SparkSession, path: str, need_one: bool = True) -> str:
    """Tab if the header has at least as many tabs as commas (and one at least), else a comma. Reads one line."""
    head = spark.read.text(path).limit(1).collect()
    line = head[0][0] if head else ""
    tabs, commas = line.count("\t"), line.count(",")
    return "\t" if tabs >= commas and (tabs >= 1 or not need_one) else ","


def read_delimited(spark: SparkSession, path, sep: str | None = None) -> DataFrame:
    """All columns as strings, with each record's place; quotes are doubled inside quotes, and line ends may stand there.

    Files are cut like any other, whatever their quotes hold. Several paths may differ in columns' order.
    """
    paths = [path] if isinstance(path, str) else list(path)
    sep = sep or sniff_delimiter(spark, paths[0])
    frames = [read_records(spark, p, sep, number=k) for k, p in enumerate(paths)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def resolve(df: DataFrame, *names: str) -> Column:
    """The first of the names that the table has, in any case and with spaces or underscores; else null."""
    fold = lambda s: s.strip().lstrip("﻿").lower().replace("_", " ")
    have = {fold(c): c for c in reversed(df.columns)}
    for n in names:
        if fold(n) in have:
            return F.col(f"`{have[fold(n)]}`")
    return F.lit(None).cast("string")


def _date(value: dt.date | None) -> str:
    return (value or dt.date.today()).isoformat()


def _metadata(keep_blank: bool = False, **entries: Column) -> Column:
    """A JSON object of the entries that have a value; null if none has."""
    made = {k: v if keep_blank else _unblank(v) for k, v in entries.items()}
    text = F.to_json(F.struct(*[v.alias(k) for k, v in made.items()]))
    return F.when(text != "{}", text)


def _unblank(v: Column) -> Column:
    return F.when(v.cast("string") != "", v)


def _first(df: DataFrame, *names: str) -> Column:
    return X.trim_ws(F.coalesce(resolve(df, *names), F.lit("")))


# Fixed tables: what an item's type follows from, in each source.
DOMAIN_TYPES = {"Measurement": "numeric", "Observation": "string", "Condition": "enum", "Drug": "enum", "Procedure": "enum", "Device": "string", "Unit": "string", "Specimen": "enum"}
SCALE_TYPES = {"QN": "numeric", "ORD": "enum", "NOM": "enum", "OC": "enum", "NAR": "string", "DOC": "string", "SET": "string"}
PROTOCOL_TYPES = {
    "numeric": "numeric", "integer": "numeric", "decimal": "numeric", "categorical": "enum", "categoric": "enum", "encoded": "enum", "string": "string", "text": "string", "date": "date", "datetime": "date",
}
CDE_TYPES = {
    "numeric values": "numeric", "numeric": "numeric", "number": "numeric", "integer": "numeric", "alphanumeric": "string", "text": "string", "string": "string", "date": "date",
    "date or date & time": "date", "date & time": "date", "time": "string",
}


def vocabulary_versions(vocabularies: DataFrame) -> DataFrame:
    """(vocabulary_id, version); blank versions are unknown, and of several rows the last in the file stays."""
    v = vocabularies.select("vocabulary_id", F.coalesce(X.blank_to_null("vocabulary_version"), F.lit("unknown")).alias("version"), _place(vocabularies))
    return v.groupBy("vocabulary_id").agg(F.max_by("version", PLACE).alias("version"))


def _place(df: DataFrame) -> Column:
    """Where a row stands: its record's place, or where it is no record, its row's."""
    return F.col(PLACE) if PLACE in df.columns else F.monotonically_increasing_id().alias(PLACE)


def synonym_lists(synonyms: DataFrame) -> DataFrame:
    """(concept_id, synonyms): a concept's names that aren't blank, in the file's order, repeats included."""
    s = synonyms.select(tolerant_long("concept_id").alias("concept_id"), X.blank_to_null("concept_synonym_name").alias("name"), _place(synonyms)).filter("concept_id is not null and name is not null")
    return s.groupBy("concept_id").agg(F.transform(F.sort_array(F.collect_list(F.struct(PLACE, "name"))), lambda x: x["name"]).alias("synonyms"))


def concepts(spark: SparkSession, concept: DataFrame, vocabularies: DataFrame | None = None, synonyms: DataFrame | None = None, axes: DataFrame | None = None, *, retrieved: dt.date | None = None, standard_only: bool = True, skip: tuple[str, ...] = ()) -> DataFrame:
    """Elements of a vocabulary release's concepts."""
    c = concept.withColumn("__id", tolerant_long("concept_id")).withColumns({f"__{n}": _first(concept, n) for n in ("vocabulary_id", "concept_name", "concept_code", "domain_id", "concept_class_id", "standard_concept")})
    c = c.filter("__id is not null and __vocabulary_id <> '' and __concept_name <> ''")
    if standard_only:
        c = c.filter("__standard_concept = 'S'")
    if skip:
        c = c.filter(~F.col("__vocabulary_id").isin(*skip))
    none = F.lit(None).cast("string")
    c = _with_versions(c, vocabularies)
    if synonyms is not None:
        s = synonym_lists(synonyms)
        c = c.join(s.select(F.col("concept_id").alias("__sid"), F.col("synonyms").alias("__synonyms")), F.col("__id") == F.col("__sid"), "left")
        names = X.normalize_pipes(F.array_join("__synonyms", "|"))
    else:
        names = none
    entries = {"omop_concept_id": F.col("__id"), "omop_domain_id": F.col("__domain_id"), "omop_concept_class_id": F.col("__concept_class_id"), "omop_standard_concept": F.col("__standard_concept"), "omop_vocabulary_id": F.col("__vocabulary_id")}
    if axes is not None:
        wide = axes.select(F.col("omop_concept_id").alias("__aid"), *[F.col(a).alias(f"__{a}") for a in axes.columns if a.startswith("axis_")])
        c = c.join(wide, (F.col("__id") == F.col("__aid")) & (F.col("__vocabulary_id") == "LOINC"), "left")
        entries |= {a.removeprefix("__"): F.col(a) for a in wide.columns if a.startswith("__axis_")}
    out = c.select(
        X.left("__concept_name", 255).alias("item"), F.col("__concept_name").alias("description"), X.mapped("__domain_id", DOMAIN_TYPES).alias("item_type"), F.lit("OMOP").alias("source_authority"),
        F.when(F.col("__concept_code") != "", F.col("__concept_code")).otherwise(F.col("__id").cast("string")).alias("source_code"),
        F.concat(F.lit("Athena-"), "__vocabulary_id", F.lit("-"), F.coalesce("__version", F.lit("unknown"))).alias("source_version"),
        F.concat(F.lit("https://athena.ohdsi.org/search-terms/terms/"), F.col("__id").cast("string")).alias("source_url"), F.lit(_date(retrieved)).alias("source_retrieved_date"),
        names.alias("alternate_names"), F.col("__id").alias("canonical_concept_id"), _metadata(**entries).alias("metadata_"),
    )
    return to_elements(out)


def _with_versions(c: DataFrame, vocabularies: DataFrame | None) -> DataFrame:
    if vocabularies is None:
        return c.withColumn("__version", F.lit("unknown"))
    v = vocabulary_versions(vocabularies)
    return c.join(v.select(F.col("vocabulary_id").alias("__vid"), F.col("version").alias("__version")), F.col("__vocabulary_id") == F.col("__vid"), "left")


def lab_codes(df: DataFrame, *, version: str, retrieved: dt.date | None = None) -> DataFrame:
    """Elements of a laboratory code table; only active rows."""
    g = lambda n: _first(df, n)
    status, short, component, long, number = F.upper(g("STATUS")), g("SHORTNAME"), g("COMPONENT"), g("LONG_COMMON_NAME"), g("LOINC_NUM")
    item = X.first_filled(short, component, number)
    scale, unit = F.upper(g("SCALE_TYP")), X.blank_to_null(g("EXAMPLE_UCUM_UNITS"))
    meta = _metadata(loinc_class=g("CLASS"), loinc_status=status, axis_component=component, axis_property=g("PROPERTY"), axis_time=g("TIME_ASPCT"), axis_system=g("SYSTEM"), axis_scale=scale, axis_method=g("METHOD_TYP"), example_units=g("EXAMPLE_UNITS"))
    out = df.filter(status.isin("ACTIVE", "") & (number != "")).select(
        X.left(item, 255).alias("item"), X.first_filled(long, short, component, F.concat(F.lit("LOINC "), number)).alias("description"), X.mapped(scale, SCALE_TYPES).alias("item_type"),
        F.lit("LOINC").alias("source_authority"), number.alias("source_code"), F.lit(f"LOINC-{version}").alias("source_version"), F.concat(F.lit("https://loinc.org/"), number, F.lit("/")).alias("source_url"),
        F.lit(_date(retrieved)).alias("source_retrieved_date"), X.normalize_pipes(resolve(df, "RELATEDNAMES2"), F.when(short != item, short)).alias("alternate_names"), unit.alias("unit_of_measure"),
        F.when(unit.isNotNull(), "UCUM").alias("unit_vocabulary"), meta.alias("metadata_"),
    )
    return to_elements(out)


def protocols(df: DataFrame, *, version: str | None = None, retrieved: dt.date | None = None) -> DataFrame:
    """Elements of protocol dictionaries, whose column names vary."""
    name = _first(df, "Variable_Name", "Variable", "VARNAME")
    kind = X.mapped(F.lower(_first(df, "Variable_Type", "type", "DataType")), PROTOCOL_TYPES)
    unit = X.blank_to_null(_first(df, "Variable_Unit", "Unit", "Units"))
    bounds = tolerant_bounds(_first(df, "Variable_Min", "Min", "Minimum"), _first(df, "Variable_Max", "Max", "Maximum"))
    protocol = X.blank_to_null(_first(df, "Protocol_ID", "ProtocolID", "Protocol"))
    numeric = kind.eqNullSafe(F.lit("numeric"))
    none = F.lit(None).cast("double")
    out = df.filter(name != "").select(
        X.left(name, 255).alias("item"), X.left(X.first_filled(_first(df, "Variable_Description", "Description", "definition", "VARDESC"), name), 8000).alias("description"), kind.alias("item_type"),
        X.blank_to_null(_first(df, "Variable_Values", "Values", "Codes")).alias("values"), F.lit("PhenX").alias("source_authority"), name.alias("source_code"),
        F.lit(version or f"PhenX-{_date(retrieved)}").alias("source_version"), F.concat(F.lit("https://www.phenxtoolkit.org/protocols/view/"), protocol).alias("source_url"),
        F.lit(_date(retrieved)).alias("source_retrieved_date"), unit.alias("unit_of_measure"), F.when(unit.isNotNull(), "free-text").alias("unit_vocabulary"),
        F.when(numeric, bounds["low"]).otherwise(none).alias("plausible_min"), F.when(numeric, bounds["high"]).otherwise(none).alias("plausible_max"),
        F.when(protocol.isNotNull(), F.array(F.concat(F.lit("PhenX-"), protocol))).otherwise(F.array().cast("array<string>")).alias("member_of_collections"),
        _metadata(phenx_protocol_id=protocol, phenx_protocol_name=_first(df, "Protocol_Name", "ProtocolName"), phenx_domain=_first(df, "Domain_Name", "Domain")).alias("metadata_"),
    )
    return to_elements(out)


def data_elements(df: DataFrame, *, version: str | None = None, retrieved: dt.date | None = None) -> DataFrame:
    """Elements of a data element catalogue, with its references to other vocabularies."""
    g = lambda *n: _first(df, *n)
    code, name, variable = g("CDE ID"), g("CDE Name"), g("Variable Name", "VariableName")
    kind = X.mapped(F.lower(g("Data Type")), CDE_TYPES)
    permitted, described = X.blank_to_null(g("Permissible Values")), X.blank_to_null(g("PV Descriptions"))
    values = X.trim_ws(F.replace(F.when(described.isNotNull(), F.concat(permitted, F.lit(" | "), described)).otherwise(permitted), F.lit(";"), F.lit("|")))
    unit_raw = g("Measurement Type")
    unit = F.when((unit_raw != "") & (F.length(unit_raw) <= 64), unit_raw)
    bounds, numeric, none = tolerant_bounds(g("Min Value"), g("Max Value")), kind.eqNullSafe(F.lit("numeric")), F.lit(None).cast("double")
    xrefs = F.concat(X.xref_tokens("LOINC", g("External Id Loinc")), X.xref_tokens("SNOMED", g("External Id Snomed")), X.xref_tokens("caDSR", g("External Id caDSR")), X.xref_tokens("CDISC", g("External Id CDISC")))
    domain, sub = g("Domain Name", "Domain"), g("Subdomain Name", "Sub-Domain", "Subdomain")
    parent = F.when(domain != "", F.concat(F.lit("NINDS-"), domain)).otherwise(F.lit("NINDS"))
    collections = F.array_compact(F.array(F.when(domain != "", F.concat(F.lit("NINDS-"), domain)), F.when((sub != "") & (sub != domain), F.concat(parent, F.lit("-"), sub))))
    item, description = X.first_filled(variable, name), X.first_filled(g("Definition"), g("Short Description"), name)
    meta = _metadata(
        ninds_cde_id=code, ninds_classification=g("Classification (e.g., Core)", "Classification"), ninds_version=g("Version Number"), ninds_population=g("Population"),
        ninds_crf_module=g("CRF Module / Guideline", "CRF Module/Guideline", "CRF Module"), ninds_subdomain=sub, ninds_domain=domain, ninds_question_text=g("Question Text"),
    )
    # References are a list, so they are put beside the object's texts.
    listed = F.when(F.size(xrefs) > 0, F.concat(F.regexp_replace(meta, r"\}$", ""), F.lit(',"ninds_xrefs":'), F.to_json(xrefs), F.lit("}"))).otherwise(meta)
    out = df.filter((code != "") & (F.length(code) <= 40) & item.isNotNull() & description.isNotNull()).select(
        X.left(item, 255).alias("item"), X.left(description, 8000).alias("description"), kind.alias("item_type"), values.alias("values"), F.lit("NINDS-CDE").alias("source_authority"), code.alias("source_code"),
        F.lit(version or f"NINDS-CDE-{_date(retrieved)}").alias("source_version"), F.lit("https://www.commondataelements.ninds.nih.gov/").alias("source_url"), F.lit(_date(retrieved)).alias("source_retrieved_date"),
        unit.alias("unit_of_measure"), F.when(unit.isNotNull(), "free-text").alias("unit_vocabulary"), F.when(numeric, bounds["low"]).otherwise(none).alias("plausible_min"),
        F.when(numeric, bounds["high"]).otherwise(none).alias("plausible_max"), collections.alias("member_of_collections"), listed.alias("metadata_"),
    )
    return to_elements(out)


def codelists(df: DataFrame, *, file_name: str = "", version: str | None = None, retrieved: dt.date | None = None) -> DataFrame:
    """Elements of controlled codelists; the release date stands in the file's name."""
    found = re.search(r"(?:^|[ _])(.{4}-.{2}-.{2})(?=[ _.]|$)", file_name)
    version = version or f"CDISC-SDTM-{found[1] if found else _date(retrieved)}"
    g = lambda *n: X.trim_ws(F.coalesce(*[F.nullif(resolve(df, x), F.lit("")) for x in n], F.lit("")))
    code, value, preferred = g("Code"), g("CDISC Submission Value", "CDISC Submission"), g("NCI Preferred Term", "Preferred Term")
    item = X.first_filled(value, preferred, code)
    out = df.filter(code != "").select(
        X.left(item, 255).alias("item"), X.first_filled(g("CDISC Definition", "Definition"), preferred, value, item).alias("description"), F.lit("enum").alias("item_type"), F.lit("CDISC").alias("source_authority"),
        code.alias("source_code"), F.lit(version).alias("source_version"), F.lit("https://evs.nci.nih.gov/ftp1/CDISC/SDTM/").alias("source_url"), F.lit(_date(retrieved)).alias("source_retrieved_date"),
        X.normalize_pipes(g("CDISC Synonym(s)", "Synonyms")).alias("alternate_names"), _metadata(cdisc_codelist=g("Codelist Name"), cdisc_codelist_code=g("Codelist Code")).alias("metadata_"),
    )
    return to_elements(out)


def project_files(spark: SparkSession, folder: str, *, retrieved: dt.date | None = None, authority: str = "project-derived") -> DataFrame:
    """Elements of a folder of project files, a collection for each file; ids are hashes of place and item."""
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": True}
    df = spark.read.options(**options).csv(f"{folder}/*.csv").withColumn("__file", F.col("_metadata.file_name"))
    g = lambda *n: _first(df, *n)
    item, collection = g("Item"), X.collection_of_file(F.replace(F.col("__file"), F.lit("%20"), F.lit(" ")))
    rest = {n: g(n) for n in ("Required", "Comments", "AlternateDescription", "Related_CDEs", "nacc_variable", "nacc_mapping", "original_item", "original_values", "value_mapping")}
    out = df.filter(item != "").select(
        F.sha2(F.concat_ws(chr(31), "__file", item), 256).alias("id"), X.left(item, 255).alias("item"), X.default_description(g("Description"), item, collection).alias("description"), collection.alias("collection"),
        X.blank_to_null(F.lower(g("ItemType"))).alias("item_type"), X.blank_to_null(g("Values")).alias("values"), X.normalize_names(g("AlternateItemNames")).alias("alternate_names"),
        X.blank_to_null(g("Priority")).alias("priority"), F.lit(authority).alias("source_authority"), item.alias("source_code"), F.lit(f"project-{_date(retrieved)}").alias("source_version"),
        F.lit(_date(retrieved)).alias("source_retrieved_date"), F.array(collection).alias("member_of_collections"), F.lit("under-review").alias("curation_status"), _metadata(**rest).alias("metadata_"),
    )
    return to_elements(out)
