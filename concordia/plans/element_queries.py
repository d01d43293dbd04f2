"""Deduplication, unions, pivots, hashes and checks of elements."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing
from ..functions.numbers import filled_count, tolerant_bounds
from ..operators import dedup, metadata, reports, sixaxis, validation
from ..schema import to_elements
from .registry import query, read


@query("""
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY
    (CASE WHEN nullif(event_type, 'view') IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN value >= 50 THEN 1 ELSE 0 END) DESC, ts DESC NULLS LAST, event_id) AS rn
  FROM events)
SELECT user_id, event_type, any_value(event_id) FILTER (WHERE rn = 1) AS event_id, any_value(round(value, 6)) FILTER (WHERE rn = 1) AS value,
  any_value(props) FILTER (WHERE rn = 1) AS props, count(DISTINCT props) AS n_props, count(*) AS source_row_count
FROM ranked GROUP BY user_id, event_type
""")
def within_source_dedup(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("value", F.round("value", 6))
    filled = filled_count(F.nullif(F.col("event_type"), F.lit("view")), F.when(F.col("value") >= 50, 1))
    rank = [-filled, F.coalesce(-F.unix_micros(F.col("ts").cast("timestamp")), F.lit((1 << 63) - 1)), F.col("event_id")]
    sums = {"n_props": F.count_distinct("props"), "source_row_count": F.count(F.lit(1))}
    return dedup.best_row(e, ["user_id", "event_type"], rank, ["event_id", "value", "props"], sums)


@query("SELECT user_id, event_type, props, count(*) AS n FROM events WHERE props IS NOT NULL GROUP BY user_id, event_type, props")
def metadata_variants(spark, sf_dir):
    return dedup.metadata_variants(read(spark, sf_dir, "events"), ("user_id", "event_type"), "props")


@query("""
WITH l AS (SELECT p_brand, 'type' AS path, '"' || p_type || '"' AS v FROM part UNION ALL SELECT p_brand, 'size.n', p_size::VARCHAR FROM part UNION ALL SELECT p_brand, 'e' || (p_partkey % 3), '"' || p_name || '"' FROM part),
b AS (SELECT *, row_number() OVER (PARTITION BY p_brand, path ORDER BY n DESC, v) AS nth FROM (SELECT p_brand, path, v, count(*) AS n FROM l GROUP BY ALL))
SELECT p_brand, '{' || string_agg(CASE WHEN path = 'size.n' THEN '"size":{"n":' || v || '}' ELSE '"' || path || '":' || v END, ',' ORDER BY path) || '}' AS metadata FROM b WHERE nth = 1 GROUP BY p_brand
""")
def metadata_merged(spark, sf_dir):
    """One object of metadata for each brand: each path's most frequent value, over all its parts."""
    k = F.col("p_partkey") % 3
    entry = lambda n: F.when(k == n, F.col("p_name")).alias(f"e{n}")  # noqa: E731  null entries aren't written
    meta = F.to_json(F.struct("p_type", F.struct(F.col("p_size").alias("n")).alias("size"), *[entry(n) for n in range(3)]))
    parts = read(spark, sf_dir, "part").select("p_brand", F.replace(meta, F.lit('"p_type"'), F.lit('"type"')).alias("metadata"))
    return metadata.merged(parts, ["p_brand"], "metadata")


@query("SELECT event_type, string_agg(DISTINCT props, '|' ORDER BY props) AS names FROM events GROUP BY event_type")
def string_union(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy("event_type").agg(dedup.string_union("props").alias("names"))


@query("""
SELECT o_custkey, array_to_string(list_sort(list_distinct(flatten(list([o_orderstatus, o_orderpriority])))), ',') AS names
FROM orders GROUP BY o_custkey
""")
def array_union(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", F.array("o_orderstatus", "o_orderpriority").alias("names"))
    return dedup.sets_by_key(o, ["o_custkey"], {"names": F.col("names")}).withColumn("names", F.array_join("names", ","))


@query("""
SELECT o_orderpriority, list, entry, count(*) AS n FROM (
  SELECT o_orderpriority, 'clerk' AS list, o_orderstatus || o_custkey AS entry FROM orders UNION ALL SELECT o_orderpriority, 'key', o_custkey::VARCHAR FROM orders
  UNION ALL SELECT o_orderpriority, 'key', (o_custkey + 1)::VARCHAR FROM orders) GROUP BY ALL
""")
def list_entries(spark, sf_dir):
    """Entries of lists under five keys, a row each."""
    k = F.col("o_custkey")
    lists = {"clerk": F.array(F.concat("o_orderstatus", k.cast("string"))), "key": F.array(k.cast("string"), (k + 1).cast("string"), F.lit(None).cast("string"))}
    return dedup.entries(read(spark, sf_dir, "orders"), ["o_orderpriority"], lists)


@query("""
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment, NULL::VARCHAR AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, 'supplier' FROM supplier
""")
def union_by_name(spark, sf_dir):
    c, s = read(spark, sf_dir, "customer", "supplier")
    a = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"))
    b = s.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    return dedup.union_by_name([a, b])


@query("""
SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars, NULL::BIGINT AS item_id FROM documents
UNION ALL SELECT NULL, md5(text), NULL, NULL, NULL, item_id FROM benchmark
""")
def merge_with_count_check(spark, sf_dir):
    d, b = read(spark, sf_dir, "documents", "benchmark")
    hashed = lambda df: df.withColumn("text_md5", F.md5("text")).drop("text")
    merged = dedup.merge_collections(hashed(d).select("doc_id", "text_md5", "lang", "source", "n_chars"), hashed(b))
    return dedup.checked_count(merged, d.count() + b.count())


@query("""
SELECT e.event_id, e.user_id, e.event_type FROM events e WHERE e.event_id % 5 <> 0
UNION ALL
SELECT min(event_id), user_id, event_type FROM events x WHERE event_id % 5 = 0 AND NOT EXISTS
  (SELECT 1 FROM events o WHERE o.event_id % 5 <> 0 AND o.user_id = x.user_id AND o.event_type = x.event_type) GROUP BY user_id, event_type
""")
def incremental_append(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type").withColumn("content_hash", F.sha2(F.concat_ws(":", F.col("user_id").cast("string"), "event_type"), 256))
    fresh = e.filter("event_id % 5 = 0").groupBy("content_hash", "user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    return dedup.incremental(e.filter("event_id % 5 <> 0"), fresh).drop("content_hash")


_AXES = {"axis_a": ("AF",), "axis_n": ("NO", "NF"), "axis_r": ("RF",)}
_PIVOT = """
SELECT o.o_orderkey AS orderkey, max(CASE WHEN l_returnflag || l_linestatus IN ('AF') THEN p_name END) AS axis_a,
  max(CASE WHEN l_returnflag || l_linestatus IN ('NO', 'NF') THEN p_name END) AS axis_n, max(CASE WHEN l_returnflag || l_linestatus IN ('RF') THEN p_name END) AS axis_r
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey LEFT JOIN part p ON p.p_partkey = l.l_partkey GROUP BY o.o_orderkey
"""


def _pivot(spark, sf_dir):
    o, l, p = read(spark, sf_dir, "orders", "lineitem", "part")
    edges = l.select(F.col("l_orderkey").alias("orderkey"), F.concat("l_returnflag", "l_linestatus").alias("relationship"), F.col("l_partkey").alias("target"))
    return sixaxis.pivot_max(o.select(F.col("o_orderkey").alias("orderkey")), edges, p.select(F.col("p_partkey").alias("target"), F.col("p_name").alias("name")), "orderkey", _AXES)


@query(_PIVOT)
def six_axis_pivot(spark, sf_dir):
    return _pivot(spark, sf_dir)


@query(f"SELECT count(*) AS total, count(axis_a) AS n_axis_a, count(axis_n) AS n_axis_n, count(axis_r) AS n_axis_r FROM ({_PIVOT})")
def axis_population(spark, sf_dir):
    return sixaxis.population(_pivot(spark, sf_dir), list(_AXES))


@query("""
SELECT p_partkey, sha256('{"brand":"' || p_brand || '","description":"' || p_name || '","item_type":' || CASE WHEN p_size % 2 = 0 THEN '"' || p_type || '"' ELSE 'null' END || ',"size":' || p_size || '}') AS content_hash FROM part
""")
def content_hash(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    fields = {"brand": F.col("p_brand"), "description": F.col("p_name"), "item_type": F.when(F.col("p_size") % 2 == 0, F.col("p_type")), "size": F.col("p_size")}
    return p.select("p_partkey", hashing.native_hash(fields, ("size",)).alias("content_hash"))


@query("""
WITH h AS (SELECT coalesce(CASE WHEN p_size % 7 <> 0 THEN sha256(p_name) END, '') AS h FROM part), c AS (SELECT h, count(*) AS n FROM h GROUP BY h),
d AS (SELECT substr(h, 1, 4) AS part, sha256(string_agg(CASE WHEN h = '' THEN ' ' || n ELSE h || ' ' || n END, chr(10) ORDER BY h)) AS digest FROM c GROUP BY 1)
SELECT sha256(string_agg(digest, chr(10) ORDER BY part)) AS rollup_hash FROM d
""")
def rollup_tree(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(F.when(F.col("p_size") % 7 != 0, F.sha2("p_name", 256)).alias("content_hash"))
    return hashing.rollup_tree(p)


@query("SELECT sha256(string_agg(h, chr(10) ORDER BY h)) AS rollup_hash FROM (SELECT coalesce(CASE WHEN p_size % 7 <> 0 THEN sha256(p_name) END, '') AS h FROM part)")
def rollup_hash(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(F.when(F.col("p_size") % 7 != 0, F.sha2("p_name", 256)).alias("content_hash"))
    return hashing.rollup_hash(p)


def _part_elements(spark, sf_dir):
    p, k = read(spark, sf_dir, "part"), F.col("p_partkey")
    none = lambda kind: F.lit(None).cast(kind)
    return to_elements(p.select(
        k.cast("string").alias("item"), F.col("p_name").alias("description"), F.when(k % 3 == 0, "numeric").when(k % 3 == 1, "string").alias("item_type"),
        F.when(k % 2 == 0, F.col("p_size").cast("double")).otherwise(none("double")).alias("plausible_min"), F.when(k % 7 == 0, F.array(F.lit(1.0))).alias("embedding"), F.when(k % 14 == 0, "t").otherwise("").alias("search_text"), F.when(k % 5 == 0, "cm").alias("unit_of_measure"),
        F.when(k % 4 == 0, F.lit(2)).alias("numeric_precision"), F.when(k % 6 == 0, "multiple").otherwise("single").alias("cardinality"),
        F.when(k % 12 == 0, "a; b").when(k % 18 == 0, "a|b; c").otherwise("a, b").alias("values"), F.when(k % 10 == 0, "other").alias("replaced_by_id"), (k % 20 == 0).alias("is_active"),
        F.lit("OMOP").alias("source_authority"), F.lit("1").alias("source_version"), F.lit("2024-01-01").alias("source_retrieved_date"),
    ))


_CHECKS = """
SELECT severity, code, item, field FROM (
  SELECT 'ERROR' AS severity, 'ACTIVE_BUT_REPLACED' AS code, p_partkey::VARCHAR AS item, 'is_active' AS field FROM part WHERE p_partkey % 20 = 0
  UNION ALL SELECT 'ERROR', 'NUMERIC_BOUNDS_WITHOUT_UNIT', p_partkey::VARCHAR, 'unit_of_measure' FROM part WHERE p_partkey % 6 = 0 AND p_partkey % 5 <> 0
  UNION ALL SELECT 'WARNING', 'NUMERIC_PRECISION_ON_NON_NUMERIC', p_partkey::VARCHAR, 'numeric_precision' FROM part WHERE p_partkey % 4 = 0 AND p_partkey % 3 <> 0
  UNION ALL SELECT 'WARNING', 'EMBEDDING_WITHOUT_SEARCH_TEXT', p_partkey::VARCHAR, 'search_text' FROM part WHERE p_partkey % 7 = 0 AND p_partkey % 14 <> 0
  UNION ALL SELECT 'INFO', 'CARDINALITY_DELIMITER_CONVENTION', p_partkey::VARCHAR, 'values' FROM part WHERE p_partkey % 6 = 0 AND NOT (p_partkey % 18 = 0 AND p_partkey % 12 <> 0))
"""


@query(_CHECKS)
def element_checks(spark, sf_dir):
    return validation.element_findings(_part_elements(spark, sf_dir)).drop("message")


@query(f"SELECT count(*) FILTER (severity = 'ERROR') AS errors, count(*) FILTER (severity = 'WARNING') AS warnings, count(*) FILTER (severity = 'INFO') AS infos, count(*) FILTER (severity = 'ERROR') = 0 AS ok FROM ({_CHECKS})")
def severity_summary(spark, sf_dir):
    return validation.summary(validation.element_findings(_part_elements(spark, sf_dir)))


@query("""
SELECT 'TOO_LONG' AS code, 'unit_of_measure' AS field, p_partkey AS n FROM part WHERE length(repeat(p_name, 2)) > 64
UNION ALL SELECT 'ENUM', 'item_type', p_partkey FROM part WHERE p_size % 2 = 0
UNION ALL SELECT 'INVERTED_BOUNDS', 'plausible_min', p_partkey FROM part WHERE p_size > 25
""")
def construction_checks(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    e = to_elements(p.select(
        F.col("p_partkey").cast("string").alias("item"), F.col("p_name").alias("description"), F.repeat("p_name", F.lit(2)).alias("unit_of_measure"), F.when(F.col("p_size") % 2 == 0, "odd").alias("item_type"),
        F.col("p_size").cast("double").alias("plausible_min"), F.lit(25.0).alias("plausible_max"), F.lit("OMOP").alias("source_authority"), F.lit("1").alias("source_version"), F.lit("2024-01-01").alias("source_retrieved_date"),
    ))
    return validation.construction_findings(e).select("code", "field", F.col("item").cast("long").alias("n"))


@query("""
WITH t AS (SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS low, TRY_CAST(CASE WHEN event_id % 4 = 0 THEN 'n/a' ELSE CAST(event_id % 90 AS VARCHAR) END AS DOUBLE) AS high, event_id % 4 = 0 AS bad FROM events)
SELECT event_id, CASE WHEN bad OR low > high THEN NULL ELSE low END AS low, CASE WHEN bad OR low > high THEN NULL ELSE high END AS high FROM t
""")
def tolerant_numeric(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    high = F.when(F.col("event_id") % 4 == 0, "n/a").otherwise((F.col("event_id") % 90).cast("string"))
    b = tolerant_bounds(F.get_json_object("props", "$.k"), high)
    return e.select("event_id", b["low"].alias("low"), b["high"].alias("high"))


@query("""
SELECT c.c_custkey, c.c_name, n.n_name, n.n_regionkey FROM customer c LEFT JOIN nation n ON n.n_nationkey = nullif(c.c_nationkey, 3)
WHERE c.c_acctbal > 0 AND c.c_mktsegment = 'BUILDING'
""")
def crosswalk_view(spark, sf_dir):
    c, n = read(spark, sf_dir, "customer", "nation")
    e = c.select(F.nullif(F.col("c_nationkey"), F.lit(3)).alias("canonical_concept_id"), (F.col("c_acctbal") > 0).alias("is_active"), F.col("c_mktsegment").alias("schema_id"), "c_custkey", "c_name")
    view = reports.active_crosswalk(e, n.withColumnRenamed("n_nationkey", "canonical_concept_id"), "BUILDING")
    return view.select("c_custkey", "c_name", "n_name", "n_regionkey")
