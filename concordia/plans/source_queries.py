"""Sources over files that are made from the tables: each query writes its source's format to the shared folder and reads it."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..bundle import _put, file_manifest, verify, write_bundle
from ..functions import hashing
from ..operators import sixaxis
from ..schema import to_elements
from ..session import shared_folder
from ..sources import delimited, obo, registry, semistructured
from .build import write_edges
from .registry import query, read

DAY = dt.date(2024, 5, 6)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/concordia/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, name: str, sep: str = ",", file: str = "") -> str:
    path = f"{_folder(df.sparkSession, name)}/{file or name}"
    df.write.options(header=True, sep=sep, quote='"', escape='"').csv(path)
    return path


def _pick(values: tuple, n: Column) -> Column:
    """values[n % len(values)]."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (n % len(values) + 1).cast("int"))


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _if(condition: Column, value) -> Column:
    return F.when(condition, value if isinstance(value, Column) else F.lit(value)).otherwise("")


# ---- delimited sources


@query("""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents WHERE doc_id IS NOT NULL)
SELECT doc_id, md5(replace(t, chr(13), '')) AS text_md5, length(t) - length(replace(t, chr(10), '')) AS line_ends, row_number() OVER (ORDER BY doc_id) AS nth FROM d
""")
def cut_records(spark, sf_dir):
    """Whole texts, line ends and quotes included, written as quoted fields in order of ids and read by cuts; nth is the record's place among all."""
    d = read(spark, sf_dir, "documents").filter("doc_id is not null")
    table = d.select("doc_id", F.replace(F.coalesce("text", F.lit("")), F.lit("\r"), F.lit("")).alias("text")).orderBy("doc_id")
    r = delimited.read_delimited(spark, _written(table, "texts"), ",")
    # Places are in order of ids exactly if the n-th id by place is the n-th by value: ranks by place within a file, files by their first id.
    text = F.coalesce("text", F.lit(""))
    ends = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    ranked = r.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("text_md5"), ends.cast("long").alias("line_ends"), F.col("__place.file").alias("file"), F.col("__place.line").alias("line"))
    sizes = ranked.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    before = sizes.select("file", F.coalesce(F.sum("n").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("file").orderBy("line"))
    return ranked.join(before, "file").select("doc_id", "text_md5", "line_ends", (nth + F.col("before")).alias("nth"))


@query("""
WITH t AS (SELECT *, p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN 'S ' || p_brand END AS short FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 3 <> 1)
SELECT k || '-1' AS source_code, coalesce(short, p_name) AS item, CASE WHEN k % 3 = 0 THEN p_name || ', in "' || p_type || '"' ELSE coalesce(short, p_name) END AS description,
  CASE k % 4 WHEN 0 THEN 'numeric' WHEN 1 THEN 'enum' WHEN 2 THEN 'string' END AS item_type, 'n' || p_size || '|' || p_brand AS alternate_names, CASE WHEN k % 5 = 0 THEN 'mg/dL' END AS unit_of_measure,
  CASE WHEN k % 5 = 0 THEN 'UCUM' END AS unit_vocabulary, 'C' || (k % 7) AS class, upper(CASE k % 4 WHEN 0 THEN 'Qn' WHEN 1 THEN 'Ord' WHEN 2 THEN 'Nar' ELSE 'zz' END) AS scale, 'LOINC-9' AS source_version FROM t
""")
def lab_codes(spark, sf_dir):
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part")
    size = _text("n", F.col("p_size"))
    table = p.select(
        _if(k % 11 != 0, _text(k, "-1")).alias("LOINC_NUM"), F.col("p_name").alias("COMPONENT"), _if(k % 2 == 0, _text("S ", F.col("p_brand"))).alias("SHORTNAME"),
        _if(k % 3 == 0, _text(F.col("p_name"), ', in "', F.col("p_type"), '"')).alias("LONG_COMMON_NAME"), _pick(("Qn", "Ord", "Nar", "zz"), k).alias("SCALE_TYP"), _if(k % 5 == 0, "mg/dL").alias("EXAMPLE_UCUM_UNITS"),
        _pick(("active", "DEPRECATED", ""), k).alias("STATUS"), _text(size, "; ", F.col("p_brand"), ", ", size).alias("RELATEDNAMES2"), _text("C", k % 7).alias("CLASS"),
    )
    e = delimited.lab_codes(delimited.read_delimited(spark, _written(table, "lab")), version="9", retrieved=DAY)
    meta = [F.get_json_object("metadata_", f"$.{n}").alias(a) for n, a in (("loinc_class", "class"), ("axis_scale", "scale"))]
    return e.select("source_code", "item", "description", "item_type", "alternate_names", "unit_of_measure", "unit_vocabulary", *meta, "source_version")


@query("""
WITH t AS (SELECT p_partkey AS k, *, CASE WHEN p_partkey % 4 = 0 THEN 10 ELSE 99 END AS high FROM part WHERE p_partkey % 13 <> 0),
u AS (SELECT *, k % 5 IN (0, 2) AND k % 7 <> 0 AND p_size <= high AS good FROM t)
SELECT 'v' || k AS source_code, CASE WHEN k % 2 = 0 THEN p_name ELSE 'v' || k END AS description, CASE k % 5 WHEN 0 THEN 'numeric' WHEN 1 THEN 'enum' WHEN 2 THEN 'numeric' WHEN 3 THEN 'date' END AS item_type,
  CASE WHEN good THEN p_size::DOUBLE END AS low, CASE WHEN good THEN high::DOUBLE END AS high, CASE WHEN k % 3 = 0 THEN 'cm' END AS unit_of_measure, CASE WHEN k % 2 = 0 THEN 'PhenX-P' || p_size ELSE '' END AS collections,
  CASE WHEN k % 2 = 0 THEN 'P' || p_size END AS protocol FROM u
""")
def protocols(spark, sf_dir):
    k = F.col("p_partkey")
    table = read(spark, sf_dir, "part").select(
        _if(k % 13 != 0, _text("v", k)).alias("variable name"), _if(k % 2 == 0, F.col("p_name")).alias("Variable_Description"), _pick(("Integer", "Categorical", "decimal", "Date", "odd"), k).alias("Variable_Type"),
        _if(k % 3 == 0, "cm").alias("Variable_Unit"), F.when(k % 7 == 0, "oops").otherwise(F.col("p_size").cast("string")).alias("Variable_Min"), F.when(k % 4 == 0, "10").otherwise("99").alias("Variable_Max"),
        _if(k % 2 == 0, _text("P", F.col("p_size"))).alias("Protocol_ID"), F.lit("").alias("Variable_Values"),
    )
    e = delimited.protocols(delimited.read_delimited(spark, _written(table, "protocols")), retrieved=DAY)
    return e.select("source_code", "description", "item_type", F.col("plausible_min").alias("low"), F.col("plausible_max").alias("high"), "unit_of_measure", F.array_join("member_of_collections", ",").alias("collections"), F.get_json_object("metadata_", "$.phenx_protocol_id").alias("protocol"))


@query("""
WITH t AS (SELECT p_partkey AS k, *, CASE WHEN p_partkey % 4 <> 3 THEN 'NINDS-D' || (p_partkey % 4) END AS domain FROM part WHERE p_partkey % 17 <> 0)
SELECT 'C' || k AS source_code, CASE WHEN k % 5 = 0 THEN 'V' || k ELSE p_name END AS item, CASE WHEN k % 2 = 0 THEN 'What ' || p_name ELSE p_name END AS description,
  CASE k % 4 WHEN 0 THEN 'numeric' WHEN 2 THEN 'date' ELSE 'string' END AS item_type, CASE WHEN k % 6 = 0 THEN '1|2 | one|two' WHEN k % 3 = 0 THEN '1|2' END AS "values",
  concat_ws(',', domain, coalesce(domain, 'NINDS') || '-S' || (k % 3)) AS collections, '["LOINC:1-' || p_size || '","LOINC:2-2"' || CASE WHEN k % 2 = 0 THEN ',"SCTID:' || k || '"' ELSE '' END || ']' AS xrefs FROM t
""")
def data_elements(spark, sf_dir):
    k = F.col("p_partkey")
    table = read(spark, sf_dir, "part").select(
        F.when(k % 17 == 0, "x" * 41).otherwise(_text("C", k)).alias("CDE ID"), F.col("p_name").alias("CDE Name"), _if(k % 2 == 0, _text("What ", F.col("p_name"))).alias("Definition"),
        _pick(("Numeric Values", "Text", "Date", "Alphanumeric"), k).alias("Data Type"), _if(k % 3 == 0, "1;2").alias("Permissible Values"), _if(k % 6 == 0, "one;two").alias("PV Descriptions"),
        _if(k % 5 == 0, _text("V", k)).alias("Variable Name"), _text("S", k % 3).alias("Sub-Domain"), _if(k % 4 != 3, _text("D", k % 4)).alias("Domain Name"), _text("1-", F.col("p_size"), "; 2-2").alias("External Id Loinc"),
        F.when(k % 2 == 0, _text("SCTID:", k)).otherwise("N/A").alias("External Id Snomed"),
    )
    e = delimited.data_elements(delimited.read_delimited(spark, _written(table, "cde"), ","), retrieved=DAY)
    return e.select("source_code", "item", "description", "item_type", "values", F.array_join("member_of_collections", ",").alias("collections"), F.get_json_object("metadata_", "$.ninds_xrefs").alias("xrefs"))


@query("""
WITH t AS (SELECT 'C' || p_partkey AS code, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS v, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS pref, CASE WHEN p_partkey % 5 = 0 THEN 'Def ' || p_partkey END AS def, * FROM part WHERE p_partkey % 10 <> 0)
SELECT code AS source_code, coalesce(v, pref, code) AS item, coalesce(def, pref, v, code) AS description, p_type || '|' || p_name AS alternate_names, 'CDISC-SDTM-2026-03-27' AS source_version, 'enum' AS item_type FROM t
""")
def codelists(spark, sf_dir):
    k = F.col("p_partkey")
    table = read(spark, sf_dir, "part").select(
        _if(k % 10 != 0, _text("C", k)).alias("Code"), F.lit("").alias("Codelist Code"), F.lit("").alias("Codelist Name"), _if(k % 2 == 0, F.col("p_brand")).alias("CDISC Submission Value"),
        _text(F.col("p_type"), "; ", F.col("p_name")).alias("CDISC Synonym(s)"), _if(k % 5 == 0, _text("Def ", k)).alias("CDISC Definition"), _if(k % 3 == 0, F.col("p_name")).alias("NCI Preferred Term"),
    )
    name = "SDTM Terminology 2026-03-27.txt"
    e = delimited.codelists(delimited.read_delimited(spark, _written(table, "codelists", "\t", name)), file_name=name, retrieved=DAY)
    return e.select("source_code", "item", "description", "alternate_names", "source_version", "item_type")


@query("""
SELECT CASE WHEN p_partkey % 7 = 0 THEN p_partkey::VARCHAR ELSE 'C' || p_partkey END AS source_code, p_name AS item, CASE p_partkey % 4 WHEN 0 THEN 'numeric' WHEN 1 THEN 'enum' END AS item_type,
  'Athena-' || p_brand || '-' || CASE WHEN p_brand LIKE '%1' THEN 'unknown' ELSE 'v' || length(p_brand) END AS source_version, p_type || '|' || p_brand || ' x' AS alternate_names, p_partkey AS canonical_concept_id,
  p_brand AS vocabulary FROM part WHERE p_partkey % 3 = 0
""")
def concepts(spark, sf_dir):
    """Of a vocabulary's version rows the last in the file counts; names keep the file's order."""
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part")
    table = p.select(
        k.alias("concept_id"), F.col("p_name").alias("concept_name"), _pick(("Measurement", "Drug", "Odd", ""), k).alias("domain_id"), F.col("p_brand").alias("vocabulary_id"), F.lit("c").alias("concept_class_id"),
        _if(k % 3 == 0, "S").alias("standard_concept"), _if(k % 7 != 0, _text("C", k)).alias("concept_code"),
    )
    brands = p.select(F.col("p_brand").alias("vocabulary_id")).distinct()
    versions = brands.select("vocabulary_id", F.posexplode(F.array(F.lit("z-old"), _if(~F.endswith("vocabulary_id", F.lit("1")), _text("v", F.length("vocabulary_id"))))).alias("at", "vocabulary_version"))
    names = p.select(k.alias("concept_id"), F.posexplode(F.array("p_type", _text(F.col("p_brand"), " x"))).alias("at", "concept_synonym_name"))
    one = lambda df, *by: df.repartition(1).sortWithinPartitions(*by).drop("at")  # noqa: E731  the order of a file's rows matters
    tables = [_written(t, n, "\t") for t, n in ((table, "CONCEPT"), (one(versions, "vocabulary_id", "at"), "VOCABULARY"), (one(names, "concept_id", "at"), "CONCEPT_SYNONYM"))]
    e = delimited.concepts(spark, *[delimited.read_delimited(spark, t, "\t") for t in tables], retrieved=DAY)
    return e.select("source_code", "item", "item_type", "source_version", "alternate_names", "canonical_concept_id", F.get_json_object("metadata_", "$.omop_vocabulary_id").alias("vocabulary"))


@query("""
SELECT s_name AS item, 'GP2' AS collection, CASE WHEN s_suppkey % 2 = 0 THEN 'd' || s_suppkey ELSE s_name || ' (GP2)' END AS description, 'numeric' AS item_type, 'a|b' AS alternate_names FROM supplier WHERE s_suppkey % 5 <> 0
UNION ALL SELECT n_name, 'Lab', 'What ' || n_name, NULL, NULL FROM nation
""")
def project_files(spark, sf_dir):
    s, n = read(spark, sf_dir, "supplier", "nation")
    folder, key = _folder(spark, "project"), F.col("s_suppkey")
    lines = lambda df, *c: df.agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(",", *c))), "\n")).first()[0]  # noqa: E731  a project's file is written by hand, so it is small
    _put(spark, f"{folder}/GP2_things_cdes.csv", "Item,Description,ItemType,AlternateItemNames\n" + lines(s, _if(key % 5 != 0, F.col("s_name")), _if(key % 2 == 0, _text("d", key)), F.lit("Numeric"), F.lit("a | b|a")) + "\n")
    _put(spark, f"{folder}/Lab_CDEs.csv", "Item,Description\n" + lines(n, "n_name", _text("What ", F.col("n_name"))) + "\n")
    return delimited.project_files(spark, folder, retrieved=DAY).select("item", "collection", "description", "item_type", "alternate_names")


# ---- semi-structured sources


@query("""
SELECT CASE p_partkey % 3 WHEN 0 THEN 'HPO' WHEN 1 THEN 'Mondo' ELSE 'DUO' END AS source_authority, CASE p_partkey % 3 WHEN 0 THEN 'HP:' WHEN 1 THEN 'MONDO:' ELSE 'DUO:' END || p_partkey AS source_code, p_name AS item,
  CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE 'Is ' || p_type || '.' END AS description, p_brand AS alternate_names, CASE WHEN p_partkey % 3 = 2 THEN 'Core-Governance' END AS collection,
  CASE p_partkey % 3 WHEN 0 THEN '{"hpo_xrefs":["MIM:' || p_size || '"]}' WHEN 1 THEN '{"mondo_xrefs":["MIM:' || p_size || '"]}' END AS metadata_ FROM part WHERE p_partkey % 10 <> 0
""")
def ontology_elements(spark, sf_dir):
    """Terms of three ontologies from one file of stanzas."""
    k = F.col("p_partkey")
    prefix = _pick(("HP:", "MONDO:", "DUO:"), k)
    stanza = F.concat_ws(
        "\n", F.lit("[Term]"), _text("id: ", prefix, k), _text("name: ", F.col("p_name"), " ! a note"), F.when(k % 4 != 0, _text('def: "Is ', F.col("p_type"), '." [A:1]')), _text('synonym: "', F.col("p_brand"), '" EXACT []'),
        _text('synonym: "', F.col("p_brand"), '" RELATED []'), _text("xref: mim:", F.col("p_size"), ', "x"'), F.lit("xref: nothing"), F.when(k % 10 == 0, F.lit("is_obsolete: true")),
    )
    path = _folder(spark, "terms")
    read(spark, sf_dir, "part").select(stanza).write.option("lineSep", "\n\n").text(path)
    terms = semistructured.ontology_terms(spark, path)
    every = [semistructured.ontology_elements(terms, kind, version="v", retrieved=DAY) for kind in ("hpo", "mondo", "duo")]
    return reduce(DataFrame.unionByName, every).select("source_authority", "source_code", "item", "description", "alternate_names", "collection", "metadata_")


@query("""
SELECT 'HP:' || p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_name END AS name, CASE WHEN p_partkey % 4 <> 0 THEN 'X:' || p_size || '|Y:' || p_partkey ELSE 'X:' || p_size END AS xrefs
FROM part WHERE p_partkey % 7 <> 0
""")
def ontology_stanzas(spark, sf_dir):
    """Terms of files as they are distributed: CRLF, blanks at lines' ends, stanzas with no line between, other kinds, remarks behind a blank line."""
    k = F.col("p_partkey")
    stanza = F.concat_ws(
        "\r\n", F.when(k % 7 == 0, F.lit("[Typedef]")).otherwise("[Term]  "), _text("id: HP:", k, "\t"), _text("  name: ", F.col("p_name"), " ! remark"), F.when(k % 3 == 0, _text("name: ", F.col("p_brand"))),
        _text("xref: X:", F.col("p_size")), F.when(k % 4 == 0, F.lit(" \t")), _text("xref: Y:", k, " ! a ! b"), F.when(k % 5 == 0, F.lit("")), F.lit("name:no value here"),
    )
    path = _folder(spark, "stanzas")
    read(spark, sf_dir, "part").select(F.concat(stanza, F.lit("\r"))).write.text(path)
    terms = obo.read_stanzas(spark, path, splitBytes=1 << 16, pushFilters=True).filter("kind = 'Term' AND startswith(id, 'HP:')")
    return terms.select("id", "name", F.array_join("xref", "|").alias("xrefs"))


@query("""
SELECT CASE WHEN p_partkey % 2 = 0 THEN replace(p_name, ' ', '') ELSE p_name END AS item, p_name AS description, CASE p_partkey % 4 WHEN 0 THEN 'string' WHEN 3 THEN 'binary' ELSE 'numeric' END AS item_type,
  CASE WHEN p_partkey % 3 = 1 THEN 'multiple' ELSE 'single' END AS cardinality, printf('(%04X,%04X)', p_partkey & 65535, p_size::BIGINT) AS source_code FROM part WHERE p_partkey % 5 <> 0
""")
def tag_elements(spark, sf_dir):
    k = F.col("p_partkey")
    tags = read(spark, sf_dir, "part").select(
        (k * 65536 + F.col("p_size")).alias("tag"), _pick(("PN", "US or SS", "UL", "OB"), k).alias("vr"), _pick(("1", "1-n", "2"), k).alias("vm"), F.col("p_name").alias("name"), _if(k % 5 == 0, "Retired").alias("retired"),
        _if(k % 2 == 0, F.replace("p_name", F.lit(" "), F.lit(""))).alias("keyword"),
    )
    return semistructured.tag_elements(tags, version="v", retrieved=DAY).select("item", "description", "item_type", "cardinality", "source_code")


def _nations(spark, sf_dir) -> list:
    return read(spark, sf_dir, "nation").orderBy(F.col("n_nationkey").desc()).collect()  # 25 rows, a file of them for each region


@query("""
SELECT n_name AS item, 'Nation ' || n_nationkey AS description, CASE WHEN n_nationkey % 2 = 0 THEN 'numeric' ELSE 'string' END AS item_type, 'BIDS:region_' || n_regionkey || ':' || n_name AS source_code FROM nation WHERE n_regionkey <> 4
""")
def yaml_elements(spark, sf_dir):
    """A tree of YAML files, one of which can't be read."""
    folder, by = _folder(spark, "yaml"), {}
    for n in _nations(spark, sf_dir):
        by.setdefault(n["n_regionkey"], []).append(f"{n['n_name']}:\n  type: {'integer' if n['n_nationkey'] % 2 == 0 else 'string'}\n  description: |\n    Nation {n['n_nationkey']}\nodd{n['n_nationkey']}: 3\n")
    for region, parts in by.items():
        _put(spark, f"{folder}/region_{region}/objects.yaml", "".join(parts) + ("broken: [1\n" if region == 4 else ""))
    e = semistructured.yaml_elements(semistructured.yaml_definitions(spark, folder), version="v", retrieved=DAY)
    return e.select("item", "description", "item_type", "source_code")


@query("SELECT 'region_' || n_regionkey AS theme, string_agg(n_name, '|' ORDER BY n_nationkey DESC) AS items FROM nation GROUP BY n_regionkey")
def anchor_themes(spark, sf_dir):
    """Anchors by theme, in the order of their files."""
    folder, by = _folder(spark, "anchors"), {}
    for n in _nations(spark, sf_dir):
        by.setdefault(n["n_regionkey"], []).append({"item": n["n_name"], "priority": "Required", "unknown": 1})
    for region, entries in by.items():
        _put(spark, f"{folder}/region_{region}.json", json.dumps(entries))
    return semistructured.by_theme(semistructured.anchors(spark, folder)).select("theme", F.array_join("items", "|").alias("items"))


@query("SELECT n_name AS item, 'a|b' AS alternate_names, 'c' || n_regionkey AS collections, 'single' AS cardinality FROM nation")
def json_elements(spark, sf_dir):
    base = {"description": "d", "source_authority": "OMOP", "source_version": "1", "source_retrieved_date": "2024-01-01", "alternate_names": "a| b |a"}
    path = f"{_folder(spark, 'json')}/e.json"
    _put(spark, path, json.dumps([base | {"item": n["n_name"], "member_of_collections": [f" c{n['n_regionkey']}", f"c{n['n_regionkey']}"]} for n in _nations(spark, sf_dir)]))
    return semistructured.json_elements(spark, path).select("item", "alternate_names", F.array_join("member_of_collections", ",").alias("collections"), "cardinality")


def _made(df: DataFrame, item: str, authority: str) -> DataFrame:
    fixed = {"description": "d", "source_authority": authority, "source_version": "1", "source_retrieved_date": "2024-01-01"}
    return to_elements(df.select(F.col(item).cast("string").alias("item"), *[F.lit(v).alias(n) for n, v in fixed.items()]))


@query("SELECT s_name AS item, 'HPO' AS source_authority FROM supplier UNION ALL SELECT p_name, 'LOINC' FROM part")
def staged_union(spark, sf_dir):
    """Staged sources: a table hides lines of its name, and malformed lines are skipped."""
    s, p, n = read(spark, sf_dir, "supplier", "part", "nation")
    folder = _folder(spark, "staged")
    _made(s, "s_name", "HPO").write.parquet(f"{folder}/hpo.parquet")
    _made(n, "n_name", "HPO").write.json(f"{folder}/hpo.jsonl")
    _made(p, "p_name", "LOINC").write.json(f"{folder}/lab.jsonl")
    spark.createDataFrame([("not json",)], "value string").write.mode("append").text(f"{folder}/lab.jsonl")
    return semistructured.staged_rows(spark, folder).select("item", "source_authority")


# ---- axes and hashes of elements

_LAB = """
lab AS (SELECT p_partkey AS id, p_name AS name, CASE p_size % 4 WHEN 0 THEN 'Component' WHEN 1 THEN 'LOINC System' ELSE 'Lab Test' END AS class, CASE p_size % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'C' END AS mark FROM part WHERE p_size % 10 <> 9),
step AS (SELECT l_partkey AS id, l_partkey + l_linenumber AS target, CASE l_linenumber % 4 WHEN 0 THEN 'component' WHEN 1 THEN 'system' WHEN 2 THEN 'time' END AS kind, l_orderkey * 10 + l_linenumber AS nth
  FROM lineitem WHERE l_returnflag <> 'R' AND l_linenumber % 4 <> 3)"""


def _lab(spark, sf_dir):
    k = F.col("p_partkey")
    p, l = read(spark, sf_dir, "part", "lineitem")
    size, line = F.col("p_size"), F.col("l_linenumber")
    concept = p.select(
        k.alias("concept_id"), F.col("p_name").alias("concept_name"), _text("L", k).alias("concept_code"), F.when(size % 10 == 9, "SNOMED").otherwise("LOINC").alias("vocabulary_id"),
        F.when(size % 4 == 0, "Component").when(size % 4 == 1, "LOINC System").otherwise("Lab Test").alias("concept_class_id"), F.when(size % 3 == 0, "S").when(size % 3 == 1, "C").alias("standard_concept"),
    )
    relation = l.select(
        F.col("l_partkey").alias("concept_id_1"), (F.col("l_partkey") + line).alias("concept_id_2"), _pick(("Has component", "Has system", "Has time aspect", "Is a"), line).alias("relationship_id"),
        F.when(F.col("l_returnflag") == "R", "D").when(F.col("l_returnflag") == "A", "").alias("invalid_reason"), (F.col("l_orderkey") * 10 + line).alias("at"),
    )
    return concept, relation


@query(f"""
WITH {_LAB}, part_name AS (SELECT id AS target, name FROM lab WHERE class <> 'Lab Test')
SELECT lab.id AS omop_concept_id, 'L' || lab.id AS loinc_code, lab.name AS loinc_long_name, max(n.name) FILTER (kind = 'component') AS axis_component, max(n.name) FILTER (kind = 'time') AS axis_time,
  max(n.name) FILTER (kind = 'system') AS axis_system FROM lab LEFT JOIN step ON step.id = lab.id LEFT JOIN part_name n USING (target) WHERE mark IS NULL OR mark = 'S' GROUP BY lab.id, lab.name
""")
def six_axes(spark, sf_dir):
    return sixaxis.six_axes(*_lab(spark, sf_dir)).select("omop_concept_id", "loinc_code", "loinc_long_name", "axis_component", "axis_time", "axis_system")


@query(f"""
WITH {_LAB}, known AS (SELECT step.*, goal.name FROM step JOIN lab USING (id) JOIN lab goal ON goal.id = target)
SELECT id AS omop_concept_id, arg_max(name, nth) FILTER (kind = 'component') AS axis_component, arg_max(name, nth) FILTER (kind = 'time') AS axis_time, arg_max(name, nth) FILTER (kind = 'system') AS axis_system FROM known GROUP BY id
""")
def six_axes_last(spark, sf_dir):
    return sixaxis.six_axes_last(*_lab(spark, sf_dir), "at").select("omop_concept_id", "axis_component", "axis_time", "axis_system")


@query("""
SELECT p_partkey AS k, sha256('{"alternate_names":' || CASE WHEN p_partkey % 2 = 0 THEN '["' || p_type || '","a"]' ELSE 'null' END || ',"cardinality":"single","collections":["c1","c2"],"description":"' || p_name || '","item_type":"numeric","metadata_":'
  || CASE WHEN p_partkey % 3 = 0 THEN '{"a":"' || p_brand || '","k":[2,1]}' ELSE 'null' END || ',"missing_value_convention":null,"numeric_precision":' || CASE WHEN p_partkey % 5 = 0 THEN '2' ELSE 'null' END || ',"plausible_max":null,"plausible_min":' || p_size
  || '.0,"source_authority":"OMOP","source_code":"' || p_partkey || '","source_version":"1","unit_of_measure":null,"unit_vocabulary":null,"value_set_ref":null,"values":"x|y"}') AS content_hash FROM part
""")
def element_hash(spark, sf_dir):
    """The content hash over all hashed fields of an element."""
    k = F.col("p_partkey")
    e = to_elements(read(spark, sf_dir, "part").select(
        k.cast("string").alias("source_code"), F.col("p_name").alias("description"), F.col("p_name").alias("item"), F.lit("numeric").alias("item_type"), F.lit("x|y").alias("values"), F.lit("OMOP").alias("source_authority"), F.lit("1").alias("source_version"),
        F.lit("2024-01-01").alias("source_retrieved_date"), F.when(k % 2 == 0, _text(F.col("p_type"), "|a")).alias("alternate_names"), F.array(F.lit("c2"), F.lit("c1")).alias("member_of_collections"),
        F.when(k % 3 == 0, _text('{"k": [2, 1], "a": "', F.col("p_brand"), '"}')).alias("metadata_"), F.col("p_size").cast("double").alias("plausible_min"), F.when(k % 5 == 0, F.lit(2)).alias("numeric_precision"),
    ))
    return e.select(F.col("source_code").cast("long").alias("k"), hashing.content_hash(e).alias("content_hash"))


# ---- what is written


@query("SELECT 'd' || n_regionkey || '/' || n_name || '.txt' AS path, length(n_name) AS bytes, sha256(n_name) AS sha256 FROM nation")
def file_digests(spark, sf_dir):
    """Size and SHA-256 of every file below a folder."""
    folder = _folder(spark, "files")
    for n in _nations(spark, sf_dir):
        _put(spark, f"{folder}/d{n['n_regionkey']}/{n['n_name']}.txt", n["n_name"])
    files = [(f["path"], f["bytes"], f["sha256"]) for f in file_manifest(spark, folder)]  # as many as nations
    return spark.createDataFrame(files, "path string, bytes long, sha256 string")


@query("""
SELECT s_name AS item, 'OMOP:' || lpad(s_suppkey::VARCHAR, 7, '0') AS accession, 'nation ' || s_nationkey || ' | OMOP' AS search_text, s_suppkey % 2 = 0 AS embedded,
  (SELECT count(*) FROM supplier) AS n_elements, (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 0) AS n_with_embedding, 0 AS n_wrong FROM supplier
""")
def bundle_written(spark, sf_dir):
    """Elements, embeddings and manifest of a bundle, read back and verified."""
    key = F.col("s_suppkey")
    vector = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda k: (((key + k) % 7) + 1).cast("float"))
    e = to_elements(read(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("item"), _text("nation ", F.col("s_nationkey")).alias("description"), _text("OMOP:", F.lpad(key.cast("string"), 7, "0")).alias("accession"), F.when(key % 2 == 0, vector).alias("embedding"),
        F.lit("OMOP").alias("source_authority"), F.lit("1").alias("source_version"), F.lit("2024-01-01").alias("source_retrieved_date"),
    ))
    out = _folder(spark, "bundle")
    manifest = write_bundle(e, out, "1", created=DAY)
    wrong = len(verify(spark, out))
    stored = spark.read.parquet(f"{out}/embeddings").select("accession", F.lit(True).alias("embedded"))
    rows = spark.read.parquet(f"{out}/elements").join(stored, "accession", "left")
    counts = [F.lit(manifest[n]).cast("long").alias(n) for n in ("n_elements", "n_with_embedding")]
    return rows.select("item", "accession", "search_text", F.coalesce("embedded", F.lit(False)).alias("embedded"), *counts, F.lit(wrong).alias("n_wrong"))


@query("SELECT 'lab_codes' AS source, (SELECT count(*) FROM part WHERE p_partkey % 2 = 0) AS n UNION ALL SELECT 'edges', (SELECT count(*) FROM part WHERE p_partkey % 3 = 0) UNION ALL SELECT 'no edges', 0")
def staged_counts(spark, sf_dir):
    """Rows of a source that the registry stages, and of edges as they are written; without any there is no table."""
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part")
    table = p.select(_text(k, "-1").alias("LOINC_NUM"), F.col("p_name").alias("COMPONENT"), F.when(k % 2 == 0, "ACTIVE").otherwise("TRIAL").alias("STATUS"))
    out = _folder(spark, "stage")
    n = registry.stage(spark, "lab_codes", out, path=_written(table, "lab"), version="9", retrieved=DAY)
    edges = p.filter(k % 3 == 0).select(k.alias("src_code"), F.col("p_size").alias("target_code"))
    written = [("lab_codes", n), ("edges", write_edges(edges, f"{out}/edges")), ("no edges", write_edges(edges.limit(0), f"{out}/none"))]
    return spark.createDataFrame(written, "source string, n long")
