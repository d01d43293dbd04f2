"""Embeddings: encoding, exact and cell-based search, checks, triage, recall."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import l2_norm
from . import routing

#: Rows whose exact neighbours set an index's probes, and the share of these neighbours that the probes must reach.
TUNING_ROWS, TUNED_RECALL = 256, 0.95
#: Rows of a bucket of random pairs, about.
GAP_BUCKET = 4096

Encoder = Callable[[list[str]], np.ndarray]


def hashing_encoder(dimensions: int = 64, seed: int = 0) -> Callable[[], Encoder]:
    """A deterministic stand-in for a language model: signed hashes of words, with no claim to meaning."""

    def make() -> Encoder:
        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dimensions), np.float32)
            for k, text in enumerate(texts):
                for word in text.lower().split():
                    h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
                    out[k, h % dimensions] += 1 if h >> 63 else -1
            return out

        return encode

    return make


def encode(df: DataFrame, text: str, factory: Callable[[], Encoder], batch: int = 512, normalize: bool = True) -> DataFrame:
    """df with an embedding of each text. The factory makes the model once for each worker's stream of batches."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for texts in batches:
            parts = []
            for at in range(0, len(texts), batch):
                v = model([t or "" for t in texts.iloc[at : at + batch]])
                if normalize:
                    v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
                parts += list(v.astype(np.float32))
            yield pd.Series(parts)

    return df.withColumn("embedding", embed(F.col(text)))


def encode_missing(stored: DataFrame, incoming: DataFrame, text: str, factory: Callable[[], Encoder], key: str = "content_hash", **options) -> DataFrame:
    """stored (key, embedding) and the embeddings of incoming rows whose key is new, each encoded once.

    Run again after a failure, what has been written by then isn't encoded again.
    """
    fresh = incoming.select(key, text).join(stored.select(key), key, "left_anti").dropDuplicates([key])
    return stored.select(key, "embedding").unionByName(encode(fresh, text, factory, **options).select(key, "embedding"))


def _best_of(scores: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k best finite scores, ties to the smaller key."""
    n = scores.shape[1]
    if n > k:
        least = np.partition(scores, n - k, axis=1)[:, n - k]
        row, column = np.nonzero((scores >= least[:, None]) & np.isfinite(scores))
    else:
        row, column = np.nonzero(np.isfinite(scores))
    order = np.lexsort((keys[column], -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def exact_search(corpus: DataFrame, queries: DataFrame, k: int = 10, *, key: str = "vec_id", vector: str = "embedding", group: str | None = None) -> DataFrame:
    """(query_id, rank, key, score): each query's k best by inner product, ties to the smaller key.

    Blocks of queries meet blocks of rows on the executors, and every meeting hands on its own k best of each
    query, so what is ranked is bounded by blocks, not by pairs. group: a column whose value must differ between
    a query and its neighbours; null is a value.
    """
    tag = [F.col(group).cast("string").alias("tag")] if group else []
    rows = corpus.select(F.col(key).alias("key"), F.col(vector).alias("vector"), *tag)
    asked = queries.select(F.col(key).alias("asker"), F.col(vector).alias("vector"), *tag)
    return best_k(routing.meet_all(rows, asked, routing.best_of(_best_of, k), ("query_id", key)), k, key)


def best_k(scored: DataFrame, k: int, key: str) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), key)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", key, "score")


class CellIndex:
    """Vectors dealt to the cells of a k-means model, as a table partitioned by cell."""

    def __init__(self, cells: DataFrame, centroids: np.ndarray, probes: int):
        self.cells, self.centroids, self.probes = cells, centroids, probes

    @classmethod
    def build(cls, corpus: DataFrame, lists: int, *, probes: int | None = None, key: str = "vec_id", vector: str = "embedding", sample_rows: int = 200_000, seed: int = 42) -> CellIndex:
        """Centroids are fitted on a sample of at most about sample_rows; every row gets its cell.

        Without probes, they are as many as reach TUNED_RECALL of the exact 10 nearest of TUNING_ROWS rows.
        """
        n = corpus.count()
        v = corpus.select(key, vector, array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
        sample = v.sample(min(1.0, sample_rows / max(1, n)), seed) if n > sample_rows else v
        model = KMeans(k=max(2, min(lists, n)), seed=seed, maxIter=15).fit(sample)
        cells, centroids = model.transform(v).select(key, vector, F.col("prediction").alias("cell")), np.array(model.clusterCenters())
        return cls(cells, centroids, probes or tuned_probes(cells, centroids, key, vector))

    def write(self, path: str) -> None:
        _write_cells(self.cells, path)
        spark = self.cells.sparkSession
        rows = [(k, [float(x) for x in c], self.probes) for k, c in enumerate(self.centroids)]
        spark.createDataFrame(rows, "cell int, centroid array<double>, probes int").write.parquet(f"{path}/centroids")

    @classmethod
    def append(cls, spark, path: str, rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding") -> CellIndex:
        """Add rows to the cells of a written index; its centroids stay. Rows whose key is there already stand twice."""
        known = cls.read(spark, path)
        _write_cells(rows.select(key, vector, nearest_cells(known.centroids, 1)(vector)[0].alias("cell")), path)
        return cls.read(spark, path)

    @classmethod
    def read(cls, spark, path: str) -> CellIndex:
        rows = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()  # as many as lists
        return cls(spark.read.parquet(f"{path}/cells"), np.array([r["centroid"] for r in rows]), rows[0]["probes"])

    def search(self, queries: DataFrame, k: int = 10, *, key: str = "vec_id", vector: str = "embedding", probes: int | None = None) -> DataFrame:
        """As exact_search, over each query's nearest cells alone: routes (query, cell) meet the cells' rows; of a written index only those cells are read."""
        n = min(probes or self.probes, len(self.centroids))
        asked = queries.select(F.col(key).alias("asker"), F.col(vector).alias("vector"), F.explode(nearest_cells(self.centroids, n)(vector)).alias("cell"))
        cells = self.cells.select(F.col(key).alias("key"), F.col(vector).alias("vector"), "cell")
        return best_k(routing.best_in_cells(cells, asked, k, _best_of, ("query_id", key)), k, key)


def _write_cells(cells: DataFrame, path: str) -> None:
    """Spark cuts cells that are too large for a file, and gathers a small one's rows in one."""
    cells.hint("rebalance", "cell").write.mode("append").partitionBy("cell").parquet(f"{path}/cells")


def _nearest(q: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The n cells whose centroids are nearest to each vector, in order."""
    d = (centroids**2).sum(axis=1)[None, :] - 2 * q @ centroids.T
    return np.argsort(d, axis=1)[:, :n].astype(np.int32)


def nearest_cells(centroids: np.ndarray, n: int):
    """A function of vectors: the n cells whose centroids are nearest, in order."""

    @F.pandas_udf("array<int>")
    def nearest(v: pd.Series) -> pd.Series:
        return pd.Series(list(_nearest(np.array(v.tolist(), np.float64), centroids, n)))

    return nearest


def tuned_probes(cells: DataFrame, centroids: np.ndarray, key: str, vector: str) -> int:
    """The fewest probes that reach TUNED_RECALL of the exact 10 nearest of TUNING_ROWS rows, chosen by hash."""
    own = cells.select(F.xxhash64(key).alias("vec_id"), vector, "cell")
    asked = own.orderBy("vec_id").limit(TUNING_ROWS)
    true = exact_search(own, asked, 10, vector=vector).join(own.select("vec_id", "cell"), "vec_id")
    order = asked.select(F.col("vec_id").alias("query_id"), nearest_cells(centroids, len(centroids))(vector).alias("order"))
    at = true.join(order, "query_id").groupBy(F.array_position("order", F.col("cell")).alias("at")).count().collect()  # as many as lists
    reached = np.cumsum(np.bincount([r["at"] for r in at], weights=[r["count"] for r in at], minlength=len(centroids) + 1))
    return int(np.argmax(reached >= TUNED_RECALL * reached[-1]))


def triage(score) -> Column:
    """What is done with a best match, by its score. Fixed bounds."""
    score = F.col(score) if isinstance(score, str) else score
    return F.when(score >= 0.92, "auto-bind").when(score >= 0.80, "review").when(score >= 0.65, "review-caution").otherwise("novel")


def cross_group_candidates(neighbours: DataFrame, least: float = 0.92, review_below: float = 0.97) -> DataFrame:
    return neighbours.filter(F.col("score") > least).withColumn("needs_review", F.col("score") < review_below)


def norm_stats(df: DataFrame, vector: str = "embedding", tolerance: float = 1e-5) -> DataFrame:
    norm = l2_norm(F.col(vector))
    return df.agg(F.min(norm).alias("min_norm"), F.max(norm).alias("max_norm"), F.avg(norm).alias("mean_norm"), F.bool_and(F.abs(norm - 1) <= tolerance).alias("all_unit"))


def recall_at(neighbours: DataFrame, truth: DataFrame, key: str = "vec_id", ks: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """truth: (query_id, key); the share of queries whose truth is among their k best."""
    joined = truth.join(neighbours.select("query_id", key, "rank"), ["query_id", key], "left")
    return joined.agg(*[F.avg(F.coalesce((F.col("rank") <= k).cast("double"), F.lit(0.0))).alias(f"recall_{k}") for k in ks])


def cosine_gap(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row: how much nearer true pairs (vectors a, b; row_id) are than as many random ones, by mean cosine.

    The random pairs join each a with the b of the next row of its bucket, by a hash of row_id: no row meets all
    others. Buckets follow the number of rows, so none is large and none has one row alone; one pair has no random one.
    """
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, z: s + z)
    cosine = lambda x, y: dot(x, y) / F.sqrt(dot(x, x) * dot(y, y))
    rows, name = pairs.count(), F.md5(F.col("row_id").cast("string"))
    bucket = F.pmod(F.conv(F.substring(name, 1, 7), 16, 10).cast("long"), F.lit(max(1, rows // GAP_BUCKET)))
    following = Window.partitionBy(bucket).orderBy(name)
    whole = following.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.when(F.lit(rows > 1), F.coalesce(F.lead(b).over(following), F.first(b).over(whole)))
    both = pairs.withColumn("__other", other).select(cosine(a, b).alias("true"), cosine(a, "__other").alias("random"))
    means = both.agg(F.avg("true").alias("true_pairs"), F.avg("random").alias("random_pairs"))
    return means.withColumn("gap", F.col("true_pairs") - F.col("random_pairs"))


def cell_count(n: int) -> int:
    """Lists that suit n vectors: four times the square root, at most 4096."""
    return max(2, min(4096, int(4 * math.sqrt(n))))
