"""Cohort rules and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import suppress_complement, suppress_small
from ..operators import lifecycle, reports, validation
from ..streaming import accessions, incremental
from .registry import query, read


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS visit_number FROM events")
def visit_number(spark, sf_dir):
    v = reports.visit_numbers(read(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"])
    return v.select("event_id", "user_id", F.col("visit_number").cast("long").alias("visit_number"))


@query("SELECT event_id, round(date_diff('day', min(ts::DATE) OVER (PARTITION BY user_id), ts::DATE)::DOUBLE / 365.25, 6) AS years FROM events")
def years_from_baseline(spark, sf_dir):
    return reports.years_from_baseline(read(spark, sf_dir, "events"), ["user_id"], "ts").select("event_id", F.round("years_from_baseline", 6).alias("years"))


@query("""
WITH c AS (SELECT ts::DATE AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT day, event_type, CASE WHEN n > 0 AND n < 5 THEN NULL ELSE n END AS n FROM c
""")
def small_cell_suppress(spark, sf_dir):
    c = read(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return c.select("day", "event_type", suppress_small("n", 5).alias("n"))


@query("""
WITH c AS (SELECT c_mktsegment AS g, c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1, 2),
w AS (SELECT *, sum(CASE WHEN n < 6 THEN 1 ELSE 0 END) OVER (PARTITION BY g) AS small, row_number() OVER (PARTITION BY g ORDER BY CASE WHEN n >= 6 THEN n END ASC NULLS LAST, k) AS r FROM c)
SELECT g, k, CASE WHEN n < 6 OR (small = 1 AND r = 1) THEN NULL ELSE n END AS n FROM w
""")
def complement_suppress(spark, sf_dir):
    c = read(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("g"), F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return suppress_complement(c, ["g"], "n", 6, ["k"]).select("g", "k", F.col("suppressed").alias("n"))


@query("""
SELECT source, count(*) AS n, round(avg(CASE WHEN lang = 'en' THEN 1 ELSE 0 END), 6) AS english, round(avg(CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END), 6) AS long,
  round(avg(CASE WHEN nullif(lang, 'de') = 'fr' THEN 1 ELSE 0 END), 6) AS french FROM documents GROUP BY source
""")
def coverage_report(spark, sf_dir):
    conditions = {"english": F.col("lang") == "en", "long": F.col("n_chars") > 1000, "french": F.nullif(F.col("lang"), F.lit("de")) == "fr"}
    out = reports.coverage(read(spark, sf_dir, "documents"), ["source"], conditions)
    return out.select("source", "n", *[F.round(c, 6).alias(c) for c in conditions])


@query("""
WITH t AS (SELECT n_regionkey AS g, n_nationkey % 6 + 1 AS level, bool_and(n_nationkey % 4 <> 3) AS covered FROM nation GROUP BY 1, 2)
SELECT g, coalesce(min(level) FILTER (NOT covered) - 1, max(level)) AS conformance_level FROM t GROUP BY g
""")
def conformance_level(spark, sf_dir):
    t = read(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("g"), (F.col("n_nationkey") % 6 + 1).alias("level")).agg(F.bool_and(F.col("n_nationkey") % 4 != 3).alias("covered"))
    return reports.conformance_level(t, ["g"])


@query("""
SELECT c_custkey AS individual_id, NOT EXISTS (SELECT 1 FROM customer m WHERE m.c_custkey = c.c_custkey // 2 AND c.c_custkey % 3 = 0) AND NOT EXISTS (SELECT 1 FROM customer f WHERE f.c_custkey = c.c_custkey + 100) AS is_founder FROM customer c
""")
def founders(spark, sf_dir):
    k = F.col("c_custkey")
    i = read(spark, sf_dir, "customer").select(k.alias("individual_id"), F.when(k % 3 == 0, F.floor(k / 2)).alias("mother_id"), (k + 100).alias("father_id"))
    return reports.founders(i)


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey <> min(s_suppkey) OVER (PARTITION BY s_nationkey) THEN min(s_suppkey) OVER (PARTITION BY s_nationkey) END AS replaced_by FROM supplier
""")
def curation_winners(spark, sf_dir):
    return reports.curation_winners(read(spark, sf_dir, "supplier"), ["s_nationkey"], "s_suppkey").select("s_suppkey", "replaced_by")

@query("""
WITH o AS (SELECT p_partkey AS k, p_name AS h, CASE WHEN p_partkey % 17 = 0 THEN p_type END AS c, p_partkey % 5 AS a, p_partkey % 13 <> 0 AS act FROM part WHERE p_partkey % 4 <> 1),
n AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 7 = 0 THEN p_brand ELSE p_name END AS h, CASE WHEN p_partkey % 17 IN (0, 3) THEN p_type END AS c FROM part WHERE p_partkey % 6 <> 2),
m AS (SELECT coalesce(n.k, o.k) AS k, n.k IS NOT NULL AS here, CASE WHEN n.k IS NULL THEN o.h ELSE n.h END AS h, CASE WHEN n.k IS NULL THEN 'v1' ELSE 'v2' END AS v, CASE WHEN n.k IS NULL THEN o.c ELSE n.c END AS c,
  coalesce(o.a, 9) AS a, CASE WHEN o.k IS NULL THEN 'new' WHEN n.k IS NOT NULL AND n.h <> o.h THEN 'changed' WHEN n.k IS NOT NULL AND NOT o.act THEN 'returned' WHEN n.k IS NOT NULL THEN 'same'
  WHEN o.act THEN 'retired' ELSE 'gone' END AS state FROM o FULL JOIN n ON o.k = n.k),
w AS (SELECT *, first_value(k) OVER (PARTITION BY c, here ORDER BY a, k) AS winner FROM m)
SELECT k AS code, h AS content_hash, v AS source_version, a::BIGINT AS accession, CASE WHEN here AND c IS NOT NULL AND winner <> k THEN winner END AS replaced_by,
  CASE WHEN here AND c IS NOT NULL AND winner <> k THEN 'replaced' ELSE state END AS state FROM w
""")
def lifecycle_merge(spark, sf_dir):
    """A release of parts merged into those of the one before: all states, and claims that several make."""
    p, k = read(spark, sf_dir, "part"), F.col("p_partkey")
    claim = lambda *rests: F.when((k % 17).isin(*rests), F.col("p_type")).alias("claim")
    old = p.filter(k % 4 != 1).select(k.alias("code"), F.col("p_name").alias("content_hash"), F.lit("v1").alias("source_version"), claim(0), (k % 5).alias("accession"), (k % 13 != 0).alias("is_active"))
    new = p.filter(k % 6 != 2).select(k.alias("code"), F.when(k % 7 == 0, F.col("p_brand")).otherwise(F.col("p_name")).alias("content_hash"), F.lit("v2").alias("source_version"), claim(0, 3))
    merged = lifecycle.merge(old, new, ["code"], 9)
    return merged.select("code", "content_hash", "source_version", "accession", F.col("replaced_by.code").alias("replaced_by"), "state")


@query("""
SELECT 'PARENT_MISSING' AS code, p_partkey::VARCHAR AS item, 'at ' || (5 - p_partkey % 1000 - 1000000) AS message FROM part WHERE p_partkey % 1000 BETWEEN 5 AND 9
UNION ALL SELECT 'SUBJECT_MISMATCH', p_partkey::VARCHAR, 'at ' || (p_partkey // 1000 * 1000 + 499) FROM part WHERE p_partkey % 1000 BETWEEN 500 AND 899
UNION ALL SELECT 'LINEAGE_CIRCLE', p_partkey::VARCHAR, '' FROM part WHERE p_partkey % 1000 >= 900
""")
def sample_lineage(spark, sf_dir):
    """Chains of hundreds of samples: some end at a missing parent, some change their subject, some go in a circle."""
    k, n = F.col("p_partkey"), F.col("p_partkey") % 1000
    part = read(spark, sf_dir, "part")
    top = part.agg(F.max("p_partkey")).first()[0]
    # Samples 5 to 9 point to parents that aren't there; 10 to 899 to the one before, with another subject from 500 on; 900 on to the next and the last back to 900, where they are all there.
    last = F.least(F.lit(999), F.lit(top) - (k - n))
    parent = F.when(n.between(5, 9), 5 - n - 1000000).when(n.between(11, 899), k - 1).when(n == last, k - n + 900).when(n >= 900, k + 1)
    s = part.select(k.alias("sample_id"), parent.alias("parent_id"), F.when(n.between(500, 899), 2).otherwise(1).alias("subject_id"))
    found = validation.lineage_findings(s)
    return found.select("code", "item", F.when(F.col("code") == "LINEAGE_CIRCLE", "").otherwise(F.col("message")).alias("message"))


@query("SELECT sum(n_chars)::BIGINT AS total_bytes, count(*) AS total_rows FROM documents")
def totals(spark, sf_dir):
    return read(spark, sf_dir, "documents").agg(F.sum("n_chars").alias("total_bytes"), F.count(F.lit(1)).alias("total_rows"))


@query("SELECT user_id, event_type, count(*) AS n, max(event_id) AS last_event FROM events GROUP BY user_id, event_type")
def streaming_dedup(spark, sf_dir):
    """An extension: the same groups, gathered by a stream."""
    return incremental.stream_groups(spark, f"{sf_dir}/events.parquet")


@query("""
WITH last AS (SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id),
mark AS (SELECT epoch_ms(max(ts)) - 3600000 AS ms FROM events)
SELECT user_id::VARCHAR AS accession, CASE WHEN epoch_ms(last.ts) + 7200000 <= ms THEN 'retired' ELSE 'new' END AS state, max(md5(event_type)) AS content_hash
FROM events JOIN last USING (user_id, ts), mark GROUP BY user_id, last.ts, ms
""")
def accession_states(spark, sf_dir):
    """An extension: the last state of each accession, kept by a stateful stream with timers; two hours unseen retire it."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    seen = incremental.follow(spark, f"{sf_dir}/events.parquet", schema).withColumn("content", F.md5("event_type"))
    history = incremental.state_folder(spark) + "-history"
    accessions.run(accessions.changes(seen, "user_id", "ts", "content", expiry_ms=7_200_000), history, incremental.state_folder(spark))
    return accessions.latest(spark, history).select("accession", "state", "content_hash")
