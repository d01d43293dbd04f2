"""Shared pieces: the cluster's shared folder, staged tables, and vectorised text handling.

Text handling works on Arrow buffers: a batch's texts are one byte array with offsets, cut into
chunks of bounded size, so memory in a Python worker doesn't depend on the size of a partition.
A single text is never cut; the largest text is the least that a worker must hold.
"""

from __future__ import annotations

import ctypes
import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: Bytes of text that are worked on at once, and rows that Spark hands to a Python worker at once.
CHUNK_BYTES, BATCH_ROWS = 1 << 19, 1024

#: Narrow rows, or bytes as Spark estimates them, in a file of a written table at least, about; and tasks for each core
#: of the cluster that a write keeps in any case.
FILE_ROWS, FILE_BYTES, CORE_TASKS = 1 << 16, 64 << 20, 2

#: Fixed values of the word contract: the bytes between words.
SPACES = b" \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


#: Paths of tables that this process has staged and not released.
_STAGED: list[str] = []


def product_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for files that release() leaves."""
    bounded_batches(spark)  # plans that are written from here on
    return f"{shared_folder(spark)}/concordia/{name}-{uuid.uuid4().hex}"


def new_path(spark: SparkSession, name: str) -> str:
    _STAGED.append(product_path(spark, name))
    return _STAGED[-1]


def staged(df: DataFrame, name: str, codec: str = "zstd", rows: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts lineage, survives lost executors.

    rows: about how many there are at most; a table of few rows becomes few files, however many partitions made it.
    """
    path = new_path(df.sparkSession, name)
    df = few_files(df) if rows is None else df.coalesce(max(1, -(-rows // FILE_ROWS)))
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Operators of a plan that shuffle; a shuffle's partitions are sized by Spark itself.
_SHUFFLED = ("Join ", "Aggregate [", "Repartition", "Window [", "Sort [", "Distinct", "Deduplicate")


def few_files(df: DataFrame) -> DataFrame:
    """df in no more partitions than its size, or the cluster's cores, ask for: many small inputs don't become many small files.

    Only where df is made without a shuffle.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if any(name in plan.toString() for name in _SHUFFLED):
        return df
    size = min(int(str(plan.stats().sizeInBytes())), 1 << 54)
    return df.coalesce(max(CORE_TASKS * df.sparkSession.sparkContext.defaultParallelism, -(-size // FILE_BYTES)))


def let_go(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of plans that nothing refers to any more.

    It notices them when the driver's JVM collects garbage, which may be long after what they led to was staged.
    A plan goes in two steps: what refers to it is finalised after the first collection.
    """
    gc.collect()
    system = spark.sparkContext._jvm.System
    system.gc()
    time.sleep(0.3)
    system.gc()


def staged_so_far() -> int:
    """A mark for release()."""
    return len(_STAGED)


def discard(spark: SparkSession, path: str) -> None:
    """Remove one staged table."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(target, True)
    if path in _STAGED:
        _STAGED.remove(path)


def release(spark: SparkSession, since: int = 0, keep: str | None = None) -> None:
    """Remove the tables staged since a mark, but for one to keep: call it when what reads them has been written."""
    for path in _STAGED[since:]:
        if path != keep:
            discard(spark, path)


def bounded_batches(spark: SparkSession) -> None:
    """Lower the rows of an Arrow batch for this session: Spark bounds a batch by rows alone, and texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def row_key(df: DataFrame) -> F.Column:
    """A key of a whole row, 128 bits of all its columns: rows that share it are equal in every column."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash_unit(*cols) -> F.Column:
    """A number in [0, 1) from columns: the first 32 bits of their MD5, the same in any SQL engine."""
    text = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


# ---- Python workers


def tidied(scan):
    """scan, which gives its memory back to the machine when a partition ends: workers live on and wait for other tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from scan(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
            if trim is not None:
                trim(0)

    return run


# ---- Arrow text buffers


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES, most: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of texts of about limit bytes and most rows, a text at least."""
    raw, offs = text_buffers(column)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = min(lo + most, max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1))
        yield lo, hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def word_bounds(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the number of words before it (one more entry at the end)."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = ~_IS_SPACE[raw]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[offs] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


# Polynomial hashes modulo 2^64 by prefix sums: every slice of a chunk can be hashed from two entries.
_BASE = np.uint64(0x9E3779B97F4A7C55)
_POWERS: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


mix64 = _mix
_BYTE_VALUES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each; only those of a usual chunk are remembered."""
    size = max(n, CHUNK_BYTES + 4096)
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    made = []
    for b in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        made.append(np.multiply.accumulate(p))
    if size <= CHUNK_BYTES + 4096:
        _POWERS[:] = made
    return made[0], made[1]


def slice_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[start:end] for each slice; equal slices have equal hashes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return _mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return slice_hashes(_BYTE_VALUES[raw], starts, ends)


def crc32_mod3(col) -> F.Column:
    """crc32 of the id written as text, modulo 3: the fold that is held out has remainder 1."""
    return F.crc32(col.cast("string").cast("binary")) % 3
