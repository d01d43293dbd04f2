"""Quality: random Fourier features over document statistics, ridge scores, isotonic calibration.

Statistics of a text (lengths, shares of character classes, repeated words and lines, and the worst
stretch of SEGMENT words of each) are computed once, in one pass over the texts, and written as a narrow
table. Random Fourier features, cos(w x + b) with Gaussian w, approximate a Gaussian kernel on them. Each
partition of labelled rows sums its part of the normal equations, for each fold; the sums, of fixed size,
give ridge weights. Every fold is scored by the weights of the other folds, and pooling adjacent violators
on these scores, summed in bins first, gives the calibration.

Held-out rows take no part in any of it. Defined results: a null text is empty, which is a text like any
other; a label that is null is none, of several labels of a doc_id the largest counts; rows without a doc_id
are scored and never trained on; repeated rows are scored alike, and each row of a labelled doc_id is
trained on; equal raw scores have equal results; without labels of both classes every score is their mean,
or 0; an empty table gives no rows. Texts are whole: the longest is the least that a worker holds. Other
columns, whatever their names, take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod3, staged, text_chunks, tidied, word_bounds, word_hashes

THRESHOLD = 0.5
#: Words of a stretch, random features, folds, bins of scores, and labelled rows in a partition.
SEGMENT, RANDOM, FOLDS, BINS, PART_ROWS = 48, 256, 4, 4096, 20_000

_CLASSES = np.zeros((256, 8), np.int32)  # upper, lower, digit, stop, shout, symbol, bar, other ASCII
_CLASSES[65:91, 0] = _CLASSES[97:123, 1] = _CLASSES[48:58, 2] = 1
_CLASSES[[ord(c) for c in ".,;:?'\"()-"], 3] = 1
_CLASSES[ord("!"), 4] = 1
_CLASSES[[ord(c) for c in "#$%&*@^~=+<>\\/"], 5] = 1
_CLASSES[ord("|"), 6] = 1
_CLASSES[[ord(c) for c in "[]{}_`"], 7] = 1


def statistics(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of statistics for each text of a chunk."""
    n = len(offs) - 1
    starts, ends, before = word_bounds(raw, offs)
    n_words, n_bytes = np.diff(before), np.diff(offs)
    hashes = word_hashes(raw, starts, ends)
    doc = np.repeat(np.arange(n), n_words)
    lengths = (ends - starts).astype(float)
    same = np.zeros(len(hashes), np.int32)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    capital = (raw[starts] >= 65) & (raw[starts] <= 90) if len(starts) else np.zeros(0, bool)
    odd_end = ~np.isin(raw[ends - 1], _FINE_ENDS) if len(ends) else np.zeros(0, bool)
    sums = np.zeros((len(raw) + 1, 8), np.int32)
    np.cumsum(_CLASSES[raw], axis=0, out=sums[1:])
    word_sums = np.zeros((len(starts) + 1, 5))
    np.cumsum(np.stack([lengths, lengths**2, same, capital, odd_end], axis=1), axis=0, out=word_sums[1:])

    shares = (sums[offs[1:]] - sums[offs[:-1]]) / np.maximum(1, n_bytes)[:, None]
    by_word = (word_sums[before[1:]] - word_sums[before[:-1]]) / np.maximum(1, n_words)[:, None]
    deviation = np.sqrt(np.maximum(0, by_word[:, 1] - by_word[:, 0] ** 2))
    # Distinct words and the share of the commonest one.
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    distinct = np.bincount(d[at], minlength=n)
    commonest = np.zeros(n)
    np.maximum.at(commonest, d[at], np.diff(np.append(at, len(h))))
    # Lines that repeat within the text.
    lines, repeated = _lines(raw, offs)
    # The worst stretch of each text.
    stretches = -(-n_words // SEGMENT)
    owner = np.repeat(np.arange(n), stretches)
    first = before[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(stretches) - stretches, stretches)) * SEGMENT
    # The last stretch reaches back so that it is whole where the text has the words.
    last = np.minimum(first + SEGMENT, before[owner + 1])
    first = np.maximum(before[owner], np.minimum(first, last - SEGMENT))
    worst = np.zeros((n, 7))
    if len(owner):
        a, b = starts[first], ends[last - 1]
        local = (sums[b] - sums[a]) / np.maximum(1, b - a)[:, None]
        local_words = (word_sums[last] - word_sums[first]) / np.maximum(1, last - first)[:, None]
        some = np.flatnonzero(stretches)
        begin = (np.cumsum(stretches) - stretches)[some]
        worst[some] = np.maximum.reduceat(np.column_stack([local[:, [0, 2, 4, 5, 6]], local_words[:, [2, 4]]]), begin, axis=0)
    return np.column_stack([
        np.log1p(n_words), np.log1p(n_bytes), by_word[:, 0], deviation, shares, by_word[:, 2:], distinct / np.maximum(1, n_words), commonest / np.maximum(1, n_words),
        np.log1p(lines), repeated, worst,
    ]).astype(np.float32)


_FINE_ENDS = np.array([*range(97, 123), *range(65, 91), *range(48, 58), *b".,;:?", *range(128, 256)], np.uint8)


def _lines(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of lines that aren't empty, and the share of them that an earlier line of the text equals."""
    n = len(offs) - 1
    edge = np.flatnonzero(raw == 10)
    begin = np.unique(np.concatenate([offs[:-1], edge + 1]))
    begin = begin[begin < len(raw)]
    # A line ends at the next line end, or where its own text does.
    stop = np.minimum(np.append(edge, len(raw))[np.searchsorted(edge, begin)], offs[np.searchsorted(offs, begin, "right")]) if len(begin) else begin
    full = stop > begin
    begin, stop = begin[full], stop[full]
    doc = np.searchsorted(offs, begin, "right") - 1
    hashes = word_hashes(raw, begin, stop)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
    lines = np.bincount(doc, minlength=n)
    return lines, np.bincount(d[again], minlength=n) / np.maximum(1, lines)


def statistics_table(docs: DataFrame) -> DataFrame:
    """(doc_id, x: array<float>)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offs in text_chunks(batch.column(1)):
                x = statistics(raw, offs)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), flat], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(scan), "doc_id long, x array<float>")


class Features:
    """Random Fourier features of standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, seed: int, random: int = RANDOM):
        rng = np.random.default_rng(seed)
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.w = rng.standard_normal((len(mean), random)) / math.sqrt(0.5 * len(mean))
        self.b = rng.uniform(0, 2 * math.pi, random)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -6, 6)
        return np.column_stack([math.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones(len(x))])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def pool_adjacent(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression: the points of a rising step function, as (x, y) of each block's ends."""
    blocks: list[list[float]] = []  # lowest x, highest x, sum, weight
    for a, b, w in zip(x.tolist(), y.tolist(), weight.tolist(), strict=True):
        blocks.append([a, a, b * w, w])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, high, s, w_ = blocks.pop()
            blocks[-1][1] = high
            blocks[-1][2] += s
            blocks[-1][3] += w_
    return np.array([v for b in blocks for v in b[:2]]), np.array([b[2] / b[3] for b in blocks for _ in range(2)])


def score(docs: DataFrame, labels: DataFrame, *, column: str = "quality", ridge: float = 1e-3, seed: int = 42) -> DataFrame:
    """(doc_id, score) for every whole text; labels only of rows that aren't held out."""
    spark = docs.sparkSession
    table = staged(statistics_table(docs), "statistics")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")
    usable = labels.filter(F.col(column).isNotNull() & (crc32_mod3(F.col("doc_id")) != 1)).groupBy(F.col("doc_id").alias("__id")).agg(F.max(column).cast("double").alias("y"))
    known = table.join(usable, F.col("doc_id") == F.col("__id")).select("doc_id", "x", "y", fold.alias("fold"))
    rows = known.count()
    if not rows:
        return table.select("doc_id", F.lit(0.0).alias("score"))
    known = staged(known.repartition(max(1, math.ceil(rows / PART_ROWS)), F.xxhash64("doc_id")), "labelled")
    first = known.agg(vector_to_array(Summarizer.mean(array_to_vector("x"))).alias("mean"), vector_to_array(Summarizer.variance(array_to_vector("x"))).alias("variance"), F.avg("y").alias("y"), F.min("y").alias("low"), F.max("y").alias("high")).first()
    if first["low"] == first["high"]:
        return table.select("doc_id", F.lit(float(first["y"])).alias("score"))
    features = Features(np.array(first["mean"]), np.sqrt(np.array(first["variance"])), seed)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, RANDOM + 1, RANDOM + 2))
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                z, y, f = features(_matrix(part.column(0))), part.column(1).to_numpy(), part.column(2).to_numpy()
                for k in range(FOLDS):
                    own = z[f == k]
                    total[k, :, :-1] += own.T @ own
                    total[k, :, -1] += own.T @ y[f == k]
        for k in range(FOLDS):
            yield pa.record_batch([pa.array([k] * (RANDOM + 1), pa.int32()), pa.array(range(RANDOM + 1), pa.int32()), pa.array(list(total[k]), pa.list_(pa.float64()))], names=["fold", "i", "v"])

    parts = known.select("x", "y", "fold").mapInArrow(tidied(sums), "fold int, i int, v array<double>")
    equations = np.zeros((FOLDS, RANDOM + 1, RANDOM + 2))
    for r in parts.groupBy("fold", "i").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).collect():  # FOLDS * (RANDOM + 1) rows
        equations[r["fold"], r["i"]] = r["v"]

    def solve(e: np.ndarray) -> np.ndarray:
        loss = np.eye(RANDOM + 1) * ridge * max(1.0, e[-1, -2])
        loss[-1, -1] = 1e-9
        return np.linalg.lstsq(e[:, :-1] + loss, e[:, -1], rcond=None)[0]

    whole = solve(equations.sum(axis=0))
    others = np.stack([solve(equations.sum(axis=0) - equations[k]) for k in range(FOLDS)], axis=1)

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = (features(_matrix(batch.column(0))) @ others)[np.arange(batch.num_rows), batch.column(2).to_numpy()]
            yield pa.record_batch([pa.array(np.round(np.clip(s, -1, 2) * BINS / 3).astype(np.int32)), batch.column(1)], names=["bin", "y"])

    bins = known.select("x", "y", "fold").mapInArrow(tidied(crossed), "bin int, y double").groupBy("bin").agg(F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect()  # BINS rows at most
    x, y = pool_adjacent(np.array([r["bin"] for r in bins]) * 3 / BINS, np.array([r["y"] for r in bins]), np.array([r["n"] for r in bins], float))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.concatenate([np.zeros(0), *[features(_matrix(batch.column(1).slice(lo, 4096))) @ whole for lo in range(0, batch.num_rows, 4096)]])
            # Between steps, and a trace of the raw score within them, so that ties of the calibration keep an order.
            calibrated = np.interp(s, x, y) * 0.999 + 0.001 / (1 + np.exp(-np.clip(s, -20, 20)))
            yield pa.record_batch([batch.column(0), pa.array(calibrated)], names=["doc_id", "score"])

    return table.mapInArrow(tidied(scan), "doc_id long, score double")
