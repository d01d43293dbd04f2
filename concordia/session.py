"""Session settings, and checkpoints in the folder that a cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that the engine's plans rely on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(name: str = "concordia", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in (SETTINGS | settings).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; on a local master without it, a folder of our own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            path = found.get()
        elif spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        else:
            path = "file://" + tempfile.mkdtemp(prefix="concordia-")
            spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared folder: cuts lineage and survives lost executors."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: cuts lineage, and Spark knows its size."""
    path = f"{shared_folder(df.sparkSession)}/concordia/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_merge(df: DataFrame) -> DataFrame:
    """df, to be joined by a merge, whatever its files' size: a table that grows with the input isn't broadcast through the driver."""
    return df.hint("merge")
