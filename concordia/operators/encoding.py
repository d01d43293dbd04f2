"""Encoding that goes on where it was stopped.

Rows are dealt into batches by a hash of their key, and each batch is one write to a folder of its own. A
folder that Spark has marked as finished is never encoded again, and one without the mark counts for nothing,
whatever it holds: so a run that is killed loses one batch at most. The number of batches is written before
the first of them, and a run that goes on keeps to it. Rows that came to a finished batch's share since then
are found by their keys, and encoded in one more.

Defined results: rows of one key are encoded once, by the smallest text; rows without a key aren't encoded; a
null text is an empty one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .vectors import Encoder, encode

STORED = "embedding array<float>"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.sc().hadoopConfiguration()).exists(target)


def finished(spark: SparkSession, path: str) -> list[str]:
    """Folders of the batches that were written to their end."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batches")
    system = target.getFileSystem(spark._jsc.sc().hadoopConfiguration())
    if not system.exists(target):
        return []
    folders = [str(s.getPath()) for s in system.listStatus(target)]  # one for each batch
    return sorted(f for f in folders if _exists(spark, f"{f}/_SUCCESS"))


def stored(spark: SparkSession, path: str, key: str = "content_hash") -> DataFrame:
    """(key, embedding) of all finished batches."""
    folders = finished(spark, path)
    schema = f"{key} string, {STORED}"
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def resume(df: DataFrame, text: str, factory: Callable[[], Encoder], path: str, *, key: str = "content_hash", batches: int = 64, stop_after: int | None = None, **options) -> DataFrame:
    """Encode what isn't stored at path yet; (key, embedding) of all that is.

    batches: how many, where the folder is new; as many as make a batch's loss bearable. stop_after: leave off after
    so many of them, for runs in limited time.
    """
    spark = df.sparkSession
    if not _exists(spark, f"{path}/plan/_SUCCESS"):
        spark.createDataFrame([(batches,)], "batches int").coalesce(1).write.mode("overwrite").parquet(f"{path}/plan")
    n = spark.read.parquet(f"{path}/plan").first()["batches"]
    own = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias(key), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def write(rows: DataFrame, name: str) -> None:
        once = rows.groupBy(key).agg(F.min("text").alias("text"))
        encode(once, "text", factory, **options).select(key, "embedding").write.mode("overwrite").parquet(f"{path}/batches/{name}")

    done = {f.rsplit("/", 1)[-1] for f in finished(spark, path)}
    open_ = [k for k in range(n) if f"batch-{k}" not in done]
    for k in open_[:stop_after]:
        write(own.filter(F.pmod(F.xxhash64(key), F.lit(n)) == k), f"batch-{k}")
    if done and len(open_[:stop_after]) == len(open_):
        late = own.join(stored(spark, path, key).select(key), key, "left_anti")
        if not late.isEmpty():
            write(late, f"late-{sum(f.startswith('late') for f in done)}")
    return stored(spark, path, key)
