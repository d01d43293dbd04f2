"""Streams, an extension: incremental ingest by content hash.

The batch engine has no streams of its own; these let a staging folder be followed as it grows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder


def state_folder(spark: SparkSession) -> str:
    """A place for a stream's own checkpoint, in the shared folder."""
    return f"{shared_folder(spark)}/concordia-stream-{uuid.uuid4().hex}"


def follow(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of a Parquet folder or file, as they come."""
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", name).option("recursiveFileLookup", "true").parquet(folder)


def append_new(stream: DataFrame, target: str, key: str = "content_hash"):
    """Append each batch's rows whose key the target lacks; a batch that runs again adds nothing."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            known = spark.read.parquet(target).select(key)
            batch = batch.join(known, key, "left_anti")
        except Exception as e:  # no target yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        batch.dropDuplicates([key]).write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", state_folder(stream.sparkSession))


def stream_groups(spark: SparkSession, path: str) -> DataFrame:
    """Counts by user and kind of event, run as a stream over all that is there; its last state, as a table."""
    schema = spark.read.parquet(path).schema
    groups = follow(spark, path, schema).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event"))
    state, out = state_folder(spark), state_folder(spark) + "-groups"
    write = lambda batch, _: batch.write.mode("overwrite").parquet(out)
    groups.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(groups.schema).parquet(out)
