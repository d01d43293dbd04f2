"""String, priority and ontology expressions over tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.numbers import date_after, tag_text, tolerant_long, top_coded_age
from ..functions.priority import is_required, parse_priority
from ..functions.sql_functions import migrate, register
from ..operators import reports, submissions, validation
from ..session import shared_folder
from ..sources import semistructured
from .registry import query, read


def _sql_map(values: dict) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in values.items()) + "}"


_EXACT = X.VOCABULARY_ALIASES | {v: v for v in X.CANONICAL_VOCABULARIES}
_FOLDED = {a.upper(): v for a, v in reversed(X.VOCABULARY_ALIASES.items())} | {v.upper(): v for v in X.CANONICAL_VOCABULARIES}


def _vocabulary_sql(c: str) -> str:
    return f"coalesce({_sql_map(_EXACT)}[{c}], {_sql_map(_FOLDED)}[upper({c})])"


_RAW = "CASE doc_id % 7 WHEN 0 THEN 'hpo' WHEN 1 THEN ' SNOMED CT ' WHEN 2 THEN 'PMID' WHEN 3 THEN 'pubmed' WHEN 4 THEN 'nothing' WHEN 5 THEN 'ICD-10' ELSE '' END"


def _raw():
    k = F.col("doc_id") % 7
    return F.when(k == 0, "hpo").when(k == 1, " SNOMED CT ").when(k == 2, "PMID").when(k == 3, "pubmed").when(k == 4, "nothing").when(k == 5, "ICD-10").otherwise("")


@query(f"SELECT doc_id, {_vocabulary_sql(f'trim({_RAW})')} AS vocabulary FROM documents")
def vocab_normalize(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", X.normalize_vocabulary(_raw()).alias("vocabulary"))


@query(f"""
WITH t AS (SELECT doc_id, {_RAW} || CASE WHEN doc_id % 3 = 0 THEN ' : ' WHEN doc_id % 3 = 1 THEN ':' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'C-' || doc_id || ' ' END AS token FROM documents),
p AS (SELECT doc_id, regexp_extract(token, '^\\s*([A-Za-z][A-Za-z0-9_\\- ]*?)\\s*:\\s*(.+?)\\s*$', 1) AS v, regexp_extract(token, '^\\s*([A-Za-z][A-Za-z0-9_\\- ]*?)\\s*:\\s*(.+?)\\s*$', 2) AS code FROM t)
SELECT doc_id, {_vocabulary_sql("v")} AS vocabulary, trim(code) AS code FROM p WHERE trim(code) <> '' AND {_vocabulary_sql("v")} IS NOT NULL
""")
def xref_parse(spark, sf_dir):
    k = F.col("doc_id")
    token = F.concat(_raw(), F.when(k % 3 == 0, " : ").when(k % 3 == 1, ":").otherwise(""), F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("C-"), k.cast("string"), F.lit(" "))))
    parsed = read(spark, sf_dir, "documents").select("doc_id", X.parse_xref(token).alias("x"))
    return parsed.filter("x is not null").select("doc_id", "x.vocabulary", "x.code")


@query("""
WITH t AS (SELECT p_partkey, list_filter(list_transform(string_split(replace(replace(p_type || '; ' || p_brand || ',' || p_type || '|| ' || p_size, ';', '|'), ',', '|'), '|'), lambda x: trim(x)), lambda x: x <> '') AS l FROM part)
SELECT p_partkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') AS names FROM t
""")
def pipe_normalize(spark, sf_dir):
    raw = F.concat("p_type", F.lit("; "), "p_brand", F.lit(","), "p_type", F.lit("|| "), F.col("p_size").cast("string"))
    return read(spark, sf_dir, "part").select("p_partkey", X.normalize_pipes(raw).alias("names"))


@query("""
WITH t AS (SELECT p_partkey, list_filter(list_transform(string_split(p_type || ' | ' || p_type || '|' || p_brand, '|'), lambda x: trim(x)), lambda x: x <> '') AS l FROM part)
SELECT p_partkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') AS names FROM t
""")
def names_normalize(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", X.normalize_names(F.concat("p_type", F.lit(" | "), "p_type", F.lit("|"), "p_brand")).alias("names"))


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct([trim(p_type), p_brand, p_name])), '|') AS names FROM part")
def collections_normalize(spark, sf_dir):
    listed = F.array(F.concat("p_type", F.lit("\t ")), F.col("p_brand"), F.lit("  "), F.lit(None).cast("string"), F.col("p_name"), F.col("p_brand"))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(X.normalize_collections(listed), "|").alias("names"))


@query("""
SELECT doc_id, left(coalesce(CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN NULL ELSE lang END, nullif(regexp_replace(text, '^[\\s ]+|[\\s ]+$', '', 'g'), ''), 'none'), 255) AS item FROM documents
""")
def fallback_projection(spark, sf_dir):
    k = F.col("doc_id") % 3
    return read(spark, sf_dir, "documents").select("doc_id", X.left(X.first_filled(F.when(k == 1, " \t").when(k == 2, F.col("lang")), "text", F.lit("none")), 255).alias("item"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN upper(split_part(lower(p_type), ' ', 1)) || ':a:' || p_size ELSE lower(p_type) END AS id FROM part")
def id_normalize(spark, sf_dir):
    kind, size = F.lower("p_type"), F.col("p_size").cast("string")
    raw = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" "), F.split_part(kind, F.lit(" "), F.lit(1)), F.lit(":a:"), size)).otherwise(kind)
    return read(spark, sf_dir, "part").select("p_partkey", X.normalize_id(raw).alias("id"))


@query("SELECT l_orderkey, l_linenumber, printf('(%04X,%04X)', (l_orderkey * 65537 + l_partkey) >> 16 & 65535, (l_orderkey * 65537 + l_partkey) & 65535) AS tag FROM lineitem")
def tag_format(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", tag_text(F.col("l_orderkey") * 65537 + F.col("l_partkey")).alias("tag"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 100 >= 90 THEN '90+' ELSE (c_custkey % 100)::VARCHAR END AS age FROM customer")
def age_top_code(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", top_coded_age(F.col("c_custkey") % 100).alias("age"))


@query("SELECT o_orderkey, o_orderdate::DATE + round(((o_orderkey % 40) / 10.0)::DOUBLE * 365.25)::INTEGER AS visit FROM orders")
def visit_date(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", date_after(F.to_date("o_orderdate"), F.col("o_orderkey") % 40 / F.lit(10.0)).alias("visit"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS n FROM events")
def tolerant_integer(spark, sf_dir):
    text = F.when(F.col("event_id") % 3 == 0, F.concat("event_id", F.lit(".5"))).otherwise(F.concat(F.lit(" "), "event_id"))
    return read(spark, sf_dir, "events").select("event_id", tolerant_long(text).alias("n"))


@query("SELECT p_partkey, array_to_string(list_transform(list_filter(string_split(regexp_replace(p_name, '[^A-Za-z0-9]+', ' ', 'g'), ' '), lambda x: x <> ''), lambda x: upper(left(x, 1)) || substr(x, 2)), '') AS name FROM part")
def camel_case(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", X.camel_case("p_name").alias("name"))


_RULES = ("Required", "OPTIONAL", " required-or-derivable ", "Required-when-IsBiosample-true", "Required-when-genetic-ancestry-present", "Required-when-Visit-a-present", "Recommended-for-cross-cohort", "Recommended-when-x", "Recommended", "Required-for-longitudinal", "Required-when-data-asset-indexable", "required-when-x", "", "Required-for-genomic-summary-stats")
_RULE_SQL = "CASE p_partkey % 15 " + " ".join(f"WHEN {k} THEN '{r}'" for k, r in enumerate(_RULES)) + " END"
_KIND_SQL = """
CASE WHEN r = '' THEN 'unknown' WHEN lower(r) IN ('required', 'optional', 'required-or-derivable') THEN lower(r) WHEN regexp_matches(r, '^Required-when-(.+)-present$') THEN 'required-when-field-present'
 WHEN regexp_matches(r, '^Required-when-([A-Z][A-Za-z0-9]*)-(.+)$') THEN 'required-when-field-value' WHEN regexp_matches(r, '^Recommended-(for|when)-(.+)$') THEN 'recommended'
 WHEN regexp_matches(r, '^Required-(for|when)-(.+)$') THEN 'required-for-context' ELSE 'unknown' END"""


def _rules():
    k, out = F.col("p_partkey") % 15, None
    for n, r in enumerate(_RULES):
        out = F.when(k == n, r) if out is None else out.when(k == n, r)
    return out


@query(f"""
WITH t AS (SELECT p_partkey, coalesce(trim({_RULE_SQL}), '') AS r FROM part), u AS (SELECT *, {_KIND_SQL} AS kind FROM t)
SELECT p_partkey, kind, CASE kind WHEN 'required-when-field-present' THEN regexp_extract(r, '^Required-when-(.+)-present$', 1) WHEN 'required-when-field-value' THEN regexp_extract(r, '^Required-when-([A-Z][A-Za-z0-9]*)-(.+)$', 1) END AS field_name,
  CASE kind WHEN 'required-when-field-value' THEN regexp_extract(r, '^Required-when-([A-Z][A-Za-z0-9]*)-(.+)$', 2) END AS field_value,
  CASE kind WHEN 'recommended' THEN regexp_extract(r, '^Recommended-(for|when)-(.+)$', 2) WHEN 'required-for-context' THEN regexp_extract(r, '^Required-(for|when)-(.+)$', 2) END AS context FROM u
""")
def priority_parse(spark, sf_dir):
    r = read(spark, sf_dir, "part").select("p_partkey", parse_priority(_rules()).alias("r"))
    return r.select("p_partkey", "r.kind", "r.field_name", "r.field_value", "r.context")


def _context(spark, sf_dir):
    return validation.submission(spark, ["1", "4", "7", "AncestryGeneticPC1"], {"IsBiosample": "TRUE"}, is_longitudinal=True, has_indexable_data_assets=True)


@query(f"""
WITH t AS (SELECT p_partkey, p_partkey % 15 AS k FROM part)
SELECT p_partkey, coalesce(k IN (0, 3, 4, 9, 10), false) AS required FROM t
""")
def requirement_resolve(spark, sf_dir):
    r = read(spark, sf_dir, "part").select("p_partkey", parse_priority(_rules()).alias("r")).join(F.broadcast(_context(spark, sf_dir)))
    return r.select("p_partkey", is_required("r", "populated", "values", "flags").alias("required"))


def _anchors(spark, sf_dir):
    companions = F.to_json(F.struct(F.array(F.lit("4"), F.col("p_size").cast("string")).alias("companion_fields")))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("item"), _rules().alias("priority"), companions.alias("metadata_"))


@query("SELECT p_partkey::VARCHAR AS item, 'ANCHOR_MISSING' AS code FROM part WHERE p_partkey % 15 IN (0, 3, 4, 9, 10) AND p_partkey NOT IN (1, 4, 7)")
def anchor_missing(spark, sf_dir):
    return validation.missing_anchors(_anchors(spark, sf_dir), _context(spark, sf_dir)).select("item", "code")


@query("SELECT p_partkey::VARCHAR AS item, p_size::VARCHAR AS field FROM part WHERE p_partkey IN (1, 4, 7) AND p_size NOT IN (1, 4, 7)")
def companion_missing(spark, sf_dir):
    return validation.missing_companions(_anchors(spark, sf_dir), _context(spark, sf_dir)).select("item", "field")


_ITEM_SQL = "CASE l_partkey % 50 WHEN 7 THEN 'VisitBaselineDate' WHEN 9 THEN 'VisitDate' ELSE 'F' || (l_partkey % 50) END"
_TIMES_SQL = """
SELECT o_orderkey AS submission_id, CASE WHEN bool_or(coalesce(item = 'VisitBaselineDate', false)) THEN 'NO_TIME_REPRESENTATION' ELSE 'NO_TIME_BASELINE' END AS code, NULL::VARCHAR AS item,
  CASE WHEN NOT bool_or(coalesce(item = 'VisitBaselineDate', false)) THEN 'VisitBaselineDate' END AS field FROM orders LEFT JOIN f ON s = o_orderkey WHERE o_orderkey % 3 = 0 GROUP BY o_orderkey
  HAVING NOT bool_or(coalesce(item = 'VisitBaselineDate', false)) OR NOT bool_or(coalesce(item = 'VisitDate', false))"""
_FIELDS_SQL = f"f AS (SELECT DISTINCT l_orderkey AS s, {_ITEM_SQL} AS item, l_linestatus AS v FROM lineitem)"


def _submissions(spark, sf_dir):
    """Orders as submissions, every third longitudinal; their lines as fields; nations as anchors with rules and companions."""
    o, li, n = read(spark, sf_dir, "orders", "lineitem", "nation")
    table = o.select(F.col("o_orderkey").alias("submission_id"), F.create_map(F.lit("is_longitudinal"), F.col("o_orderkey") % 3 == 0).alias("flags"))
    k = F.col("l_partkey") % 50
    item = F.when(k == 7, "VisitBaselineDate").when(k == 9, "VisitDate").otherwise(F.concat(F.lit("F"), k.cast("string")))
    fields = li.select(F.col("l_orderkey").alias("submission_id"), item.alias("item"), F.col("l_linestatus").alias("value"))
    m, own = F.col("n_nationkey") % 5, F.col("n_nationkey").cast("string")
    rule = (
        F.when(m == 0, "Required").when(m == 1, F.concat(F.lit("Required-when-F"), own, F.lit("-present"))).when(m == 2, F.concat(F.lit("Required-when-F"), own, F.lit("-o")))
        .when(m == 3, "Required-for-longitudinal").otherwise("Optional")
    )
    companions = F.to_json(F.struct(F.array(F.concat(F.lit("F"), (F.col("n_nationkey") + 1).cast("string"))).alias("companion_fields")))
    anchors = n.select(F.concat(F.lit("F"), (2 * F.col("n_nationkey")).cast("string")).alias("item"), rule.alias("priority"), companions.alias("metadata_"))
    return anchors, table, fields


@query(f"WITH {_FIELDS_SQL} {_TIMES_SQL}")
def time_derivability(spark, sf_dir):
    """Longitudinal submissions whose times can't be derived."""
    _, table, fields = _submissions(spark, sf_dir)
    return submissions.time_findings(table, fields).select("submission_id", "code", "item", "field")


@query(f"""
WITH {_FIELDS_SQL},
a AS (SELECT 'F' || (n_nationkey * 2) AS item, n_nationkey % 5 AS k, n_nationkey AS n FROM nation),
need AS (SELECT o_orderkey AS s, item FROM orders JOIN a ON k = 0 OR (k = 3 AND o_orderkey % 3 = 0)
  UNION SELECT s, a.item FROM f JOIN a ON (k = 1 OR (k = 2 AND v = 'O')) AND f.item = 'F' || n)
SELECT s AS submission_id, 'ANCHOR_MISSING' AS code, item, NULL::VARCHAR AS field FROM need WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.s = need.s AND f.item = need.item)
UNION ALL SELECT DISTINCT s, 'MISSING_COMPANION_FIELD', f.item, 'F' || (n + 1) FROM f JOIN a ON f.item = a.item WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.s = f.s AND g.item = 'F' || (n + 1))
UNION ALL SELECT * FROM ({_TIMES_SQL})
""")
def submissions_checked(spark, sf_dir):
    """All findings of all orders as submissions."""
    return submissions.findings(*_submissions(spark, sf_dir)).select("submission_id", "code", "item", "field")


@query("""
SELECT doc_id, md5('d' || doc_id || ' | ' || source || CASE WHEN doc_id % 2 = 0 THEN ' ' || doc_id ELSE '' END || CASE WHEN doc_id % 3 = 0 THEN ' | ' || lang ELSE '' END || ' | c1 ' || lang || ' | lang ' || lang || ' z ' || source) AS text_md5 FROM documents
""")
def search_text_library(spark, sf_dir):
    d, k = read(spark, sf_dir, "documents"), F.col("doc_id")
    d = d.select(k, F.concat(F.lit("d"), k.cast("string")).alias("description"), "source", F.when(k % 2 == 0, k.cast("string")).alias("code"), F.when(k % 3 == 0, F.col("lang")).alias("collection"), F.array(F.lit("c1"), F.col("lang")).alias("collections"), F.to_json(F.struct(F.col("source").alias("z"), F.col("lang").alias("lang"), k.alias("number"))).alias("meta"))
    return d.select("doc_id", F.md5(X.search_text_library("description", "source", "code", "collection", "collections", "meta")).alias("text_md5"))


@query("SELECT doc_id, lang || ' ' || source || CASE WHEN doc_id % 2 = 0 THEN ' ' || doc_id ELSE '' END AS text FROM documents")
def search_text_script(spark, sf_dir):
    code = F.when(F.col("doc_id") % 2 == 0, F.col("doc_id").cast("string")).otherwise("")
    return read(spark, sf_dir, "documents").select("doc_id", X.search_text_script("lang", "source", code).alias("text"))


@query("SELECT doc_id, lang || ' | ' || source || ' ' || CASE WHEN doc_id % 2 = 0 THEN doc_id::VARCHAR ELSE '' END || ' | ' || lang || ' | a b | {}' AS text FROM documents")
def search_text_sql(spark, sf_dir):
    code = F.when(F.col("doc_id") % 2 == 0, F.col("doc_id").cast("string"))
    return read(spark, sf_dir, "documents").select("doc_id", X.search_text_sql("lang", "source", code, "lang", F.array(F.lit("a"), F.lit("b")), F.lit("{}")).alias("text"))


@query("SELECT doc_id, lang || ' | ' || source || ' ' || ' | ' || lang || ' | a b | {}' AS text, CASE WHEN trim(lang) = 'en' THEN NULL ELSE lang END AS lang FROM documents")
def sql_functions(spark, sf_dir):
    """The same expressions by SQL functions."""
    register(spark)
    read(spark, sf_dir, "documents").createOrReplaceTempView("concordia_documents")
    return spark.sql("""SELECT doc_id, compose_search_text(lang, source, NULL, lang, array('a', 'b'), '{}') AS text, filled(CASE WHEN trim_ws(concat(' ', lang)) = 'en' THEN '  ' ELSE lang END) AS lang FROM concordia_documents""")


@query("""
SELECT p_partkey AS accession, p_name AS item, p_size AS old_column, 'single' AS cardinality, true AS is_active, 'auto-matched' AS curation_status, NULL::VARCHAR AS unit_of_measure FROM part
UNION ALL SELECT p_partkey + 10000000, p_type, NULL, 'multiple', false, 'deprecated', 'kg' FROM part WHERE p_partkey % 3 = 0
""")
def table_migrated(spark, sf_dir):
    """A table that was there before is given the element's columns; old rows have the defaults, later ones their own values."""
    p, k = read(spark, sf_dir, "part"), F.col("p_partkey")
    name = f"concordia_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/concordia/{name}"
    p.select(k.cast("string").alias("accession"), F.col("p_name").alias("item"), F.col("p_size").alias("old_column")).write.option("path", path).saveAsTable(name)
    migrate(spark, name)
    later = p.filter(k % 3 == 0).select((k + 10000000).cast("string"), "p_type", F.lit("multiple"), F.lit(False), F.lit("deprecated"), F.lit("kg"))
    later.createOrReplaceTempView(f"{name}_later")
    spark.sql(f"INSERT INTO {name} (accession, item, cardinality, is_active, curation_status, unit_of_measure) SELECT * FROM {name}_later")
    return spark.table(name).select(F.col("accession").cast("long").alias("accession"), "item", "old_column", "cardinality", "is_active", "curation_status", "unit_of_measure")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang ELSE source || ' (' || lang || ')' END AS text FROM documents")
def default_description(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", X.default_description(F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(" "), "source", "lang").alias("text"))


def _scan_sql(name: str, pattern: str) -> str:
    joined = lambda x, n: f"array_to_string(list_slice({x}, 1, {n}), '')"
    ends = lambda x: f"(length({x}) - length(replace({x}, chr(10), '')))"
    before = f"{ends(joined('pieces', 'k'))} + {ends(joined('hits', 'k - 1'))}"
    return f"""
SELECT doc_id, '{name}' AS pattern, ({before} + 1)::INTEGER AS line, substr(hits[k], 1, 50) AS snippet FROM (
  SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS hits, string_split_regex(text, '{pattern}') AS pieces FROM documents WHERE regexp_matches(text, '{pattern}')))"""


@query(" UNION ALL ".join(_scan_sql(name, p) for name, p in reports.FORBIDDEN.items()))
def security_scan(spark, sf_dir):
    """Every place in the documents that one of the patterns matches, with its line and the beginning of the match."""
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), "text")
    return reports.screen_content(d, "path", "text").select(F.col("path").cast("long").alias("doc_id"), "pattern", "line", "snippet")


@query("SELECT doc_id AS path, CASE WHEN n_chars > 5000 THEN 'too large' END AS reason FROM documents WHERE n_chars > 5000 UNION ALL SELECT doc_id, 'forbidden folder' FROM documents WHERE lang = 'fr'")
def file_screen(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.concat("lang", F.lit("/"), "doc_id").alias("path"), (F.col("n_chars") * F.lit(reports.LARGE_BYTES) / 5000).cast("long").alias("length"))
    return reports.screen_files(d, ("fr/",)).select(F.split_part("path", F.lit("/"), F.lit(2)).cast("long").alias("path"), "reason")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE lang END AS text FROM documents")
def search_text_plain(spark, sf_dir):
    described = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang"))
    return read(spark, sf_dir, "documents").select("doc_id", X.search_text_plain(described, "source").alias("text"))
