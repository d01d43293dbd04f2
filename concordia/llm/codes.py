"""Vector code compression: product codes whose entries are found by exponion search, in whole numbers.

A component becomes floor(4096 x), a vector is cut into 8 parts, and each part has a codebook of 16 entries.
To assign a part, the search starts at its entry of the round before, at squared distance d: an entry that
is as near lies, by the triangle inequality, at squared distance at most 4d from that entry. So the
start's neighbour entries are scanned in order of their distance from it, up to that radius; what is
outside can be neither nearer nor a tie. Distances are exact integers, ties go to the lower index.

Codebooks are 16 entries a part, whatever the number of vectors: they go with the tasks, and each round
sends back sums and counts of 16 entries, added up over partitions. A part's entry of the round before is
not stored: a task replays the rounds on the codebooks that it was given, 28 short searches in all for
6 rounds, which costs less than writing every vector's codes six times, and a lost executor costs a task.
The vectors are read once a round.

Defined results: a vector that is null, or holds null, NaN or infinite components, has no row; vectors of
each length have codebooks of their own; where a length is no multiple of 8, part k ends at component
floor((k + 1) length / 8), and an empty part has entry 0 of its codebook; fewer vectors than entries make
fewer entries; equal first entries stay equal, and the higher of them unused; rows that share a vec_id
count each, ordered among themselves by their components; rows without a vec_id come after all others;
components of 2^24 / 4096 or more raise an error, as sums of their squares could leave 64 bits; null
labels are one label; an empty table gives no rows; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, staged, tidied

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Whole numbers of components lie below this, so that squared distances of 2^12 components stay in 64 bits.
LARGEST = 1 << 24


class Codebook:
    """Entries of one part position, with each entry's neighbours in order of distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gaps = ((entries[:, None] - entries[None]) ** 2).sum(axis=2)
        np.fill_diagonal(gaps, -1)  # each entry comes first among its own neighbours
        self.order = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.order, axis=1)

    def nearest(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of x, searched from the entries at start."""
        best, least = start.copy(), ((x - self.entries[start]) ** 2).sum(axis=1)
        radius, open_ = 4 * least, np.arange(len(x))
        for rank in range(1, len(self.entries)):
            open_ = open_[self.gaps[start[open_], rank] <= radius[open_]]
            if not len(open_):
                break
            entry = self.order[start[open_], rank]
            away = ((x[open_] - self.entries[entry]) ** 2).sum(axis=1)
            better = (away < least[open_]) | ((away == least[open_]) & (entry < best[open_]))
            at = open_[better]
            best[at], least[at] = entry[better], away[better]
        return best, least


def whole_numbers(column: pa.Array, width: int) -> np.ndarray:
    """Rows of floor(4096 x) of a list column without nulls."""
    flat = np.asarray(column.flatten().cast(pa.float64()), np.float64)
    scaled = np.floor(flat * SCALE)
    if len(scaled) and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"components of {LARGEST // SCALE} or more are too large for exact codes")
    return scaled.astype(np.int64).reshape(len(column), width)


def bounds(width: int) -> list[int]:
    """Where the parts of a vector begin, and its end."""
    return [k * width // PARTS for k in range(PARTS + 1)]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v, width) of the vectors whose components are all finite."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v"), F.size(v).alias("width")).filter(v.isNotNull() & finite)


def _searched(x: np.ndarray, cuts: list[int], history: list[list[Codebook]]) -> tuple[np.ndarray, np.ndarray]:
    """(entries, squared distances), a column for each part, under the last codebooks of the history."""
    codes, errors = np.zeros((len(x), PARTS), np.int64), np.zeros((len(x), PARTS), np.int64)
    for k in range(PARTS):
        own = np.ascontiguousarray(x[:, cuts[k] : cuts[k + 1]])
        entry = np.zeros(len(x), np.int64)
        for books in history:
            entry, away = books[k].nearest(own, entry)
        codes[:, k], errors[:, k] = entry, away
    return codes, errors


def _sums(data: DataFrame, width: int, history: list[np.ndarray]) -> dict[int, int]:
    """For each entry its parts' count and their componentwise sums, under the last codebooks; slots without parts are missing."""
    cuts, entries = bounds(width), len(history[0])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [[Codebook(h[:, cuts[k] : cuts[k + 1]]) for k in range(PARTS)] for h in history]
        total, count = np.zeros((entries, width), np.int64), np.zeros((entries, PARTS), np.int64)
        for batch in batches:
            x = whole_numbers(batch.column(0), width)
            codes, _ = _searched(x, cuts, books)
            for k in range(PARTS):
                count[:, k] += np.bincount(codes[:, k], minlength=entries)
                np.add.at(total[:, cuts[k] : cuts[k + 1]], codes[:, k], x[:, cuts[k] : cuts[k + 1]])
        flat = np.concatenate([total, count], axis=1).ravel()
        some = np.flatnonzero(flat)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(flat[some])], names=["slot", "value"])

    # One row a slot and partition; a total can be larger than any partition's.
    partial = data.select("v").mapInArrow(tidied(scan), "slot int, value long")
    summed = partial.groupBy("slot").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    return {r["slot"]: int(r["value"]) for r in summed.collect()}  # at most ENTRIES * (width + PARTS) rows


def _first_entries(data: DataFrame, width: int) -> np.ndarray:
    first = data.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    return whole_numbers(pa.array([r["v"] for r in first], pa.list_(pa.float64())), width)


def train(data: DataFrame, width: int, *, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks of each round, the final ones last: rows are entries, parts lie side by side. data: usable vectors of one length."""
    history, cuts = [_first_entries(data, width)], bounds(width)
    for _ in range(rounds):
        found, book = _sums(data, width, history), history[-1].copy()
        slots = width + PARTS
        for entry in range(len(book)):
            for k in range(PARTS):
                n = found.get(entry * slots + width + k, 0)
                if n:
                    book[entry, cuts[k] : cuts[k + 1]] = [found.get(entry * slots + c, 0) // n for c in range(cuts[k], cuts[k + 1])]
        history.append(book)
    return history


def digest(book: np.ndarray) -> str:
    """SHA-256 of all entries' components, by part, entry and position."""
    cuts = bounds(book.shape[1])
    values = [str(v) for k in range(PARTS) for v in book[:, cuts[k] : cuts[k + 1]].ravel().tolist()]
    return hashlib.sha256(",".join(values).encode()).hexdigest()


def coded(data: DataFrame, width: int, history: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) of usable vectors of one length."""
    cuts = bounds(width)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [[Codebook(h[:, cuts[k] : cuts[k + 1]]) for k in range(PARTS)] for h in history]
        for batch in batches:
            codes, errors = _searched(whole_numbers(batch.column(2), width), cuts, books)
            text = codes.astype(np.uint8).tobytes().hex()
            own = pa.array([text[i : i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)], pa.string())
            yield pa.record_batch([batch.column(0), batch.column(1), own, pa.array(errors.sum(axis=1))], names=["vec_id", "label", "code", "error"])

    made = T.StructType([*data.select("vec_id", "label").schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return data.select("vec_id", "label", "v").mapInArrow(tidied(scan), made)


def compress(vectors: DataFrame, *, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, code, error, codebooks_sha256) of each usable row of vectors: vec_id, embedding, label."""
    bounded_batches(vectors.sparkSession)
    data = usable(vectors)
    widths = sorted(r["width"] for r in data.select("width").distinct().collect())  # one row for each length
    out = None
    for width in widths:
        own = data.filter(F.col("width") == width)
        history = train(own, width, rounds=rounds)
        part = coded(own, width, history).withColumn("codebooks_sha256", F.lit(digest(history[-1])))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return data.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit("").alias("codebooks_sha256")).limit(0)
    return out


def with_label_errors(found: DataFrame) -> DataFrame:
    """compress's rows with label_error, the sum of the errors of all rows with the same label."""
    found = staged(found, "codes")
    sums = found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "own")
    return found.join(sums, found["label"].eqNullSafe(sums["own"])).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
