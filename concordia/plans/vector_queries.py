"""Search over embeddings."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.numbers import dot, l2_normalize, mean_pool
from ..operators import dedup, encoding, routing
from ..operators import vectors as V
from ..session import shared_folder
from .registry import query, read

#: The stated set of queries.
_QUERIES = "vec_id % 20 = 0"


def _ranked(where: str = "") -> str:
    return f"""
SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS score
  FROM embeddings q JOIN embeddings c ON true {where} WHERE q.{_QUERIES})"""


@query(f"SELECT query_id, rank::INTEGER AS rank, vec_id, round(score, 6) AS score FROM ({_ranked()}) WHERE rank <= 10")
def cosine_topk(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return V.exact_search(e, e.filter(_QUERIES), 10).withColumn("score", F.round("score", 6))


_CROSS = _ranked("AND q.label IS DISTINCT FROM c.label")


@query(f"SELECT query_id, rank::INTEGER AS rank, vec_id, round(score, 6) AS score FROM ({_CROSS}) WHERE rank <= 5")
def cross_label_knn(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return V.exact_search(e, e.filter(_QUERIES), 5, group="label").withColumn("score", F.round("score", 6))


@query(f"SELECT query_id, vec_id, round(score, 6) AS score, score < 0.4 AS needs_review FROM ({_CROSS}) WHERE rank <= 5 AND score > 0.3")
def cross_label_candidates(spark, sf_dir):
    """Candidates of another label; these vectors have no meaning, so the bounds are lower than the operator's own."""
    e = read(spark, sf_dir, "embeddings")
    found = V.cross_group_candidates(V.exact_search(e, e.filter(_QUERIES), 5, group="label"), 0.3, 0.4)
    return found.select("query_id", "vec_id", F.round("score", 6).alias("score"), "needs_review")


@query(f"""
SELECT query_id, CASE WHEN score >= 0.92 THEN 'auto-bind' WHEN score >= 0.80 THEN 'review' WHEN score >= 0.65 THEN 'review-caution' ELSE 'novel' END AS verdict FROM ({_ranked('AND q.vec_id <> c.vec_id')}) WHERE rank = 1
""")
def cosine_triage(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    best = V.exact_search(e, e.filter(_QUERIES), 2).filter("query_id <> vec_id")
    return V.best_k(best, 1, "vec_id").select("query_id", V.triage("score").alias("verdict"))


@query("""
SELECT vec_id, round(list_sum([x::DOUBLE * x::DOUBLE for x in embedding]) / greatest(list_sum([x::DOUBLE * x::DOUBLE for x in embedding]), 1e-9), 6) AS unit,
  round(CASE WHEN vec_id % 2 = 0 THEN embedding[1]::DOUBLE ELSE (embedding[1]::DOUBLE + embedding[64]::DOUBLE) / 2 END, 6) AS first FROM embeddings
""")
def normalised_vectors(spark, sf_dir):
    """Squared norms after normalising, and the first component of the mean of a vector and its reverse, where both count."""
    e = read(spark, sf_dir, "embeddings").withColumn("u", l2_normalize("embedding"))
    pooled = mean_pool(F.array(F.col("embedding"), F.reverse("embedding")), F.array(F.lit(1), (F.col("vec_id") % 2).cast("int")))
    return e.select("vec_id", F.round(dot("u", "u"), 6).alias("unit"), F.round(pooled[0], 6).alias("first"))


@query("SELECT vec_id, label FROM embeddings")
def vector_append(spark, sf_dir):
    """New vectors below those that are there, all keys once."""
    e = read(spark, sf_dir, "embeddings")
    both = dedup.append_vectors(e.filter("vec_id % 3 <> 0"), e.filter("vec_id % 3 = 0"), "vec_id")
    return both.join(e.select("vec_id", "label"), "vec_id").select("vec_id", "label")


@query("SELECT round(min(n), 5) AS min_norm, round(max(n), 5) AS max_norm, round(avg(n), 5) AS mean_norm, bool_and(abs(n - 1) <= 1e-5) AS all_unit FROM (SELECT sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings)")
def norm_stats(spark, sf_dir):
    s = V.norm_stats(read(spark, sf_dir, "embeddings"))
    return s.select(*[F.round(c, 5).alias(c) for c in ("min_norm", "max_norm", "mean_norm")], "all_unit")


@query(f"SELECT avg((rank <= 1)::INTEGER)::DOUBLE AS recall_1, avg((rank <= 5)::INTEGER)::DOUBLE AS recall_5, avg((rank <= 10)::INTEGER)::DOUBLE AS recall_10 FROM ({_ranked()}) WHERE query_id = vec_id")
def self_recall(spark, sf_dir):
    """How many vectors find themselves among their best."""
    e = read(spark, sf_dir, "embeddings")
    q = e.filter(_QUERIES)
    return V.recall_at(V.exact_search(e, q, 10), q.select(F.col("vec_id").alias("query_id"), "vec_id"))


@query("""
WITH p AS (SELECT a.vec_id AS id, a.embedding::DOUBLE[] AS a, b.embedding::DOUBLE[] AS b FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
h AS (SELECT *, md5(id::VARCHAR) AS h, ('0x' || md5(id::VARCHAR)[1:7])::BIGINT % (SELECT greatest(1, count(*) // 4096) FROM p) AS g FROM p),
o AS (SELECT a, b, coalesce(lead(b) OVER w, first_value(b) OVER w) AS c FROM h WINDOW w AS (PARTITION BY g ORDER BY h))
SELECT round(avg(list_cosine_similarity(a, b)), 6) AS true_pairs, round(avg(list_cosine_similarity(a, c)), 6) AS random_pairs FROM o
""")
def cosine_gap(spark, sf_dir):
    """Mean cosine of neighbouring vectors, as pairs, and of as many random pairs."""
    e = read(spark, sf_dir, "embeddings")
    pairs = e.select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("a")).join(e.select((F.col("vec_id") - 1).alias("row_id"), F.col("embedding").alias("b")), "row_id")
    return V.cosine_gap(pairs).select(F.round("true_pairs", 6).alias("true_pairs"), F.round("random_pairs", 6).alias("random_pairs"))


@query()
def ivf_topk(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return V.CellIndex.build(e, 16).search(e.filter(_QUERIES), 10)


@query(f"SELECT query_id, rank::INTEGER AS rank, vec_id, round(score, 6) AS score FROM ({_ranked()}) WHERE rank <= 10")
def index_appended(spark, sf_dir):
    """A written index to which a third of the rows is added later; asked in all its cells, it finds what the exact search does."""
    e = read(spark, sf_dir, "embeddings")
    path = f"{shared_folder(spark)}/concordia/index-{uuid.uuid4().hex}"
    V.CellIndex.build(e.filter("vec_id % 3 <> 1"), 16, probes=16).write(path)
    index = V.CellIndex.append(spark, path, e.filter("vec_id % 3 = 1"))
    return index.search(e.filter(_QUERIES), 10).withColumn("score", F.round("score", 6))


def _near_sql(least: float) -> str:
    return f"""
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings),
p AS (SELECT a.vec_id, b.label IS DISTINCT FROM a.label AS other FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {least})
SELECT e.vec_id, min(e.vec_id) OVER (PARTITION BY e.v) AS class, coalesce(n, 0) AS n_links, coalesce(m, 0) AS n_cross
FROM e LEFT JOIN (SELECT vec_id, count(*) AS n, count(*) FILTER (other) AS m FROM p GROUP BY vec_id) x ON x.vec_id = e.vec_id"""


@query(_near_sql(0.92))
def cosine_links(spark, sf_dir):
    """All rows' near ones at the bound of binding, as classes of equal vectors with numbers of links."""
    return routing.link_counts(read(spark, sf_dir, "embeddings"), 0.92)


@query(_near_sql(0.45))
def cosine_links_loose(spark, sf_dir):
    """As cosine_links at a bound that many of these vectors reach."""
    return routing.link_counts(read(spark, sf_dir, "embeddings"), 0.45)


@query("SELECT md5(coalesce(text, '')) AS content_hash, 64 AS dimensions FROM conversations GROUP BY ALL")
def encoding_resumed(spark, sf_dir):
    """Contents encoded in batches by a run that leaves off and one that goes on: each is there once."""
    texts = read(spark, sf_dir, "conversations").select(F.md5(F.coalesce("text", F.lit(""))).alias("content_hash"), "text")
    path = f"{shared_folder(spark)}/concordia/encoded-{uuid.uuid4().hex}"
    encoding.resume(texts, "text", V.hashing_encoder(64), path, batches=4, stop_after=2)
    return encoding.resume(texts, "text", V.hashing_encoder(64), path).select("content_hash", F.size("embedding").alias("dimensions"))


@query()
def encoded_search(spark, sf_dir):
    d = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("vec_id"), "text")
    e = V.encode(d, "text", V.hashing_encoder(64))
    return V.exact_search(e, e.filter(_QUERIES), 3)
