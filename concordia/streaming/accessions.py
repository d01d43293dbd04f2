"""Re-ingest as a stream, an extension: one state for each accession, with timers and late rows.

An accession's state is the content that it was last seen with, by event time and, at one time, by content. Each
batch gives one row for each accession whose content is new or changed, that has come back after it was retired,
or that hasn't been seen for a stated time: a timer on event time retires it. Rows that repeat what is known, or
are older than it, change nothing, so a replay gives the same states. Rows older than the watermark are ignored.

Rows are reduced to the last one of each accession in each Arrow batch before they are shuffled, and again as
they reach the state, so an accession of any number of rows takes a state of one row and no list is held.

Defined results: rows without an accession or a time take no part; no content is a content of its own; columns
other than the three named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

CHANGES = "accession string, state string, as_of timestamp, content_hash string"
_ROWS = "accession string, state string, micros long, content_hash string"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _last(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    """The last row of each accession: by time, then by content, none first."""
    ordered = rows.assign(none=rows["content_hash"].notna()).sort_values([*by, "micros", "none", "content_hash"])
    return (ordered.drop_duplicates(by, keep="last") if by else ordered.tail(1)).drop(columns="none")


def _combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield _last(batch, ["accession"])


class _Accessions(StatefulProcessor):
    def __init__(self, expiry_ms: int | None):
        self.expiry_ms = expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "micros long, content_hash string, retired boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        best = None
        for batch in rows:
            batch = batch[batch["micros"] >= mark]
            if len(batch):
                last = _last(batch if best is None else pd.concat([best, batch]), [])
                best = last
        if best is None:
            return
        at, content = int(best["micros"].iloc[0]), best["content_hash"].iloc[0]
        content = None if pd.isna(content) else content
        state = "new"
        if self.known.exists():
            old_at, old_content, retired = self.known.get()
            if (at, content is not None, content or "") <= (old_at, old_content is not None, old_content or ""):
                return  # repeated, or older than what is known
            state = "returned" if retired else "same" if content == old_content else "changed"
        self.known.update((at, content, False))
        if self.expiry_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(at // 1000 + self.expiry_ms)
        if state != "same":
            yield self._change(key, state, at, content)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, content, _ = self.known.get()
        self.known.update((at, content, True))
        yield self._change(key, "retired", at, content)

    @staticmethod
    def _change(key, state, at, content) -> pd.DataFrame:
        return pd.DataFrame({"accession": [key[0]], "state": [state], "micros": [at], "content_hash": pd.Series([content], dtype=object)})

    def close(self) -> None:
        pass


def changes(stream: DataFrame, accession: str, time: str, content: str, *, late: str = "1 hour", expiry_ms: int | None = None) -> DataFrame:
    """Changes of accessions, batch after batch. late: how far rows may be behind. expiry_ms: unseen for so long, an accession is retired."""
    named = stream.select(F.col(accession).cast("string").alias("accession"), F.col(time).cast("timestamp").alias("as_of"), F.col(content).cast("string").alias("content_hash"))
    named = named.filter("accession is not null and as_of is not null").withColumn("micros", F.unix_micros("as_of"))  # the same in any time zone
    last = named.mapInPandas(_combined, named.schema).withWatermark("as_of", late)
    found = last.groupBy("accession").transformWithStateInPandas(_Accessions(expiry_ms), _ROWS, "Update", "EventTime")
    return found.select("accession", "state", F.timestamp_micros("micros").alias("as_of"), "content_hash")


def run(found: DataFrame, history: str, checkpoint: str) -> None:
    """Run changes over all that is there. A batch's rows are a folder of their own, so one that runs again replaces itself."""
    spark = found.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{history}/batch={number}")

    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)  # the only store that keeps timers
    try:
        found.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(_STORE, before)


def latest(spark: SparkSession, history: str) -> DataFrame:
    """Each accession's last change: one aggregate over the history."""
    rows = spark.read.schema(f"{CHANGES}, batch long").parquet(history)
    last = rows.groupBy("accession").agg(F.max_by(F.struct("state", "as_of", "content_hash"), "batch").alias("last"))
    return last.select("accession", "last.*")
