"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Features are the presence of hashed character n-grams of the lower-cased text. Their log-count ratios
between toxic and clean documents scale them; the features that tell most take part in a logistic
regression on the scaled features. Scores are its probabilities.

Training reads at most per_class labelled documents of each class, chosen by their ids' hashes; the
weights are a table of fixed size, so scoring is one pass over the texts with nothing to shuffle.

Defined results: a null text is an empty one, which has the score of no features; repeated rows are
scored alike, and each row of a labelled doc_id is trained on; rows without a doc_id are scored and never
trained on; of several labels of a doc_id the largest counts, a null label is none; equally strong
features are taken in order of their hashes; without labels of both classes every score is about 0; an
empty table gives no rows. Texts are whole: the longest one is the least that a worker holds, with some
40 bytes for each of its own. Other columns of docs stay out of the model, whatever their names, and
kept() passes them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod3, staged, text_chunks, tidied

#: Sizes of the n-grams, bits of their hash, and features that the regression takes at most.
GRAMS, HASH_BITS, FEATURES = (3, 4, 5, 6), 22, 6000
#: Labelled documents of each class that are read at most, and partitions of that sample.
PER_CLASS, SAMPLE_PARTS = 3000, 8
#: Bytes and rows of text whose n-grams are worked on at once: row and n-gram fit 32 bits.
GRAM_BYTES, GRAM_ROWS = 1 << 18, 1 << (32 - HASH_BITS)
#: Standard errors that a feature's log-count ratio must stand from zero.
LEAST_STRENGTH = 3.0
THRESHOLD = 0.7

_MULT = np.uint32(0x9E3779B1)
_LOWER_TABLE: list[np.ndarray] = []


def _lower_table() -> np.ndarray:
    """Code points of lower-case forms that are one code point too."""
    if not _LOWER_TABLE:
        table = np.arange(1 << 16, dtype=np.uint32)
        for c in range(1 << 16):
            if not 0xD800 <= c < 0xE000 and len(low := chr(c).lower()) == 1:
                table[c] = ord(low)
        _LOWER_TABLE.append(table)
    return _LOWER_TABLE[0]


def grams(raw: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n, the hashed n-grams of a chunk of texts and the row that each lies in.

    A text's edges and its white space count as one boundary character each.
    """
    codes = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=heads[1:])
    where = heads[offs]  # the first code point of each text
    if where[-1] != len(codes):  # not valid UTF-8: the replaced characters shift, so decode row by row
        rows = [np.frombuffer(raw[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for a, b in zip(offs[:-1], offs[1:], strict=True)]
        codes, where = np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    low = np.where(codes < (1 << 16), _lower_table()[np.minimum(codes, 0xFFFF)], codes)
    low = np.where((low <= 32) | (low == 0xA0), np.uint32(32), low)
    # One boundary character after each text, and one before the first.
    padded = np.insert(low, where, np.uint32(32))
    ends = where[1:] + np.arange(1, len(where))  # place of the boundary after each text
    mixed = (padded + np.uint32(1)) * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(15)
    length = np.diff(ends, prepend=0)
    row = np.repeat(np.arange(len(ends)), length)
    h = mixed.copy()
    place = np.arange(len(padded) - 1)
    last = ends[row]
    for n in range(2, max(GRAMS) + 1):
        h = h[:-1] * _MULT + mixed[n - 1 :]
        if n in GRAMS:
            inside = place[: len(h)] + (n - 1) <= last[: len(h)]
            key = h * np.uint32(0xC2B2AE35)
            key = (key ^ (key >> np.uint32(16))) * np.uint32(0x27D4EB2F) + np.uint32(n)
            yield (key >> np.uint32(32 - HASH_BITS))[inside], row[: len(h)][inside]


def _features(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sorted distinct (row, n-gram) pairs of a chunk of at most GRAM_ROWS texts, as row << HASH_BITS | n-gram."""
    parts = [r.astype(np.uint32) << np.uint32(HASH_BITS) | g for g, r in grams(raw, offs)]
    keys = np.concatenate(parts)
    keys.sort()
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return keys[new]


def gram_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Chunks that are small enough for n-grams, which take many bytes for each of the text."""
    return text_chunks(column, GRAM_BYTES, GRAM_ROWS)


def training_sample(docs: DataFrame, labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """(text, label) of at most per_class documents of each class, none of them held out; in SAMPLE_PARTS partitions."""
    usable = labels.filter(F.col(column).isNotNull() & (crc32_mod3(F.col("doc_id")) != 1))
    own = usable.groupBy(F.col("doc_id").alias("__id")).agg(F.max(column).alias("label"))
    spread = F.xxhash64("__id")
    chosen = None
    for value in (0, 1):
        part = own.filter(F.col("label") == value).orderBy(spread, "__id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    # The sample is bounded by 2 * per_class rows of ids.
    joined = docs.select("doc_id", "text").join(F.broadcast(staged(chosen, "sample", rows=2 * per_class)), F.col("doc_id") == F.col("__id"))
    return joined.repartition(SAMPLE_PARTS, F.xxhash64("__id")).select("text", F.col("label").cast("int").alias("label"))


class Model:
    """Selected n-grams (by hash, FEATURES at most) with their weights, and the intercept: small enough to go with a task."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        self.keys, self.weights, self.bias = keys, weights, bias

    def table(self) -> np.ndarray:
        place = np.zeros(1 << HASH_BITS, np.uint16)
        place[self.keys] = np.arange(1, len(self.keys) + 1)
        return place

    def present(self, raw: np.ndarray, offs: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Sorted distinct (row, feature) pairs of a chunk, as row << 16 | feature."""
        hits = []
        for g, r in grams(raw, offs):
            f = place[g]
            some = np.flatnonzero(f)
            hits.append(r[some].astype(np.uint32) << np.uint32(16) | (f[some] - np.uint16(1)))
        return np.unique(np.concatenate(hits))

    def score(self, raw: np.ndarray, offs: np.ndarray, place: np.ndarray) -> np.ndarray:
        n, pairs = len(offs) - 1, self.present(raw, offs, place)
        total = np.bincount(pairs >> 16, weights=self.weights[pairs & 0xFFFF], minlength=n)[:n] + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def log_count_ratio(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int, smoothing: float) -> np.ndarray:
    """How much likelier a feature is in toxic documents than in clean ones, as a logarithm."""
    return np.log(((toxic + smoothing) / (n_toxic + 2 * smoothing)) / ((clean + smoothing) / (n_clean + 2 * smoothing)))


def fit(docs: DataFrame, labels: DataFrame, *, column: str = "toxic", per_class: int = PER_CLASS, smoothing: float = 1.0, ridge: float = 1.0) -> Model:
    """Train on a bounded sample of labelled documents; held-out documents are never read.

    Each partition of the sample counts the documents with each n-gram, and the counts are summed over
    partitions. The features that tell most, FEATURES at most, come to the driver. One task then trains on
    the documents' selected features: 2 * per_class rows of at most FEATURES small numbers, however long
    the texts are.
    """
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), -50.0)
    sample = staged(training_sample(docs, labels, column, per_class).coalesce(SAMPLE_PARTS), "texts")
    total = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not total.get(0) or not total.get(1):
        return nothing

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << HASH_BITS), np.int32)
        for batch in batches:
            label = batch.column(1).to_numpy()
            for lo, _, raw, offs in gram_chunks(batch.column(0)):
                pairs = _features(raw, offs)
                row = label[(pairs >> np.uint32(HASH_BITS)).astype(np.int64) + lo]
                for k in (0, 1):
                    counts[k] += np.bincount(pairs[row == k] & np.uint32((1 << HASH_BITS) - 1), minlength=1 << HASH_BITS).astype(np.int32)
        some = np.flatnonzero(counts[0] | counts[1])
        for at in range(0, len(some), 1 << 16):
            part = some[at : at + (1 << 16)]
            yield pa.record_batch([pa.array(part.astype(np.int32)), pa.array(counts[0][part]), pa.array(counts[1][part])], names=["gram", "clean", "toxic"])

    counted = sample.mapInArrow(tidied(count), "gram int, clean int, toxic int").groupBy("gram").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter("clean + toxic >= 3")
    clean, toxic = F.col("clean") + smoothing, F.col("toxic") + smoothing
    strength = F.abs(F.log((toxic / (total[1] + 2 * smoothing)) / (clean / (total[0] + 2 * smoothing)))) / F.sqrt(1 / toxic + 1 / clean)
    best = counted.withColumn("strength", strength).filter(F.col("strength") > LEAST_STRENGTH).orderBy(F.col("strength").desc(), "gram").limit(FEATURES).collect()
    if not best:
        return nothing
    best.sort(key=lambda r: r["gram"])
    keys = np.array([r["gram"] for r in best], np.int64)
    ratio = log_count_ratio(np.array([r["clean"] for r in best], float), np.array([r["toxic"] for r in best], float), total[0], total[1], smoothing)
    chosen = Model(keys, ratio, 0.0)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = chosen.table()
        for batch in batches:
            for lo, hi, raw, offs in gram_chunks(batch.column(0)):
                pairs = chosen.present(raw, offs, place)
                bounds = np.searchsorted(pairs, np.arange(hi - lo + 1, dtype=np.uint64) << np.uint64(16))
                low = (pairs & np.uint32(0xFFFF)).astype("<u2")
                found = [low[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.record_batch([pa.array(found, pa.binary()), batch.column(1).slice(lo, hi - lo)], names=["features", "label"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, y = [], []
        for batch in batches:
            rows += [np.frombuffer(g, "<u2") for g in batch.column(0).to_pylist()]
            y += batch.column(1).to_pylist()
        weights, bias = _regress(rows, np.array(y, float), ratio, ridge)
        yield pa.record_batch([pa.array([(weights * ratio).astype("<f8").tobytes()]), pa.array([float(bias)])], names=["weights", "bias"])

    found = staged(sample.mapInArrow(tidied(extract), "features binary, label int"), "features", rows=2 * per_class)
    row = found.coalesce(1).mapInArrow(tidied(train), "weights binary, bias double").first()
    return Model(keys, np.frombuffer(row["weights"], np.float64), row["bias"])


def _sums(groups: np.ndarray, size: int):
    """A function of values in order of groups (sorted): their sums for each of size groups."""
    starts = np.flatnonzero(np.diff(groups, prepend=-1))
    some = groups[starts]

    def sums(values: np.ndarray) -> np.ndarray:
        out = np.zeros(size)
        if len(starts):
            out[some] = np.add.reduceat(values, starts)
        return out

    return sums


def _regress(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, ridge: float, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse scaled presence features by accelerated gradient steps; classes weigh alike."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate([np.zeros(0, np.intp), *rows]).astype(np.intp)
    by_column = np.argsort(column, kind="stable")
    of_row, of_column, owner_by_column = _sums(owner, len(y)), _sums(column[by_column], len(scale)), owner[by_column]
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    norms = of_row((scale * scale).take(column))
    step = 1 / (0.25 * float((weight * (norms + 1)).sum()) + ridge / len(y))
    w, b, w_at, b_at, t = np.zeros(len(scale)), 0.0, np.zeros(len(scale)), 0.0, 1.0
    for _ in range(rounds):
        margin = of_row((scale * w_at).take(column)) + b_at
        slope = weight * (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - y)
        grad = scale * of_column(slope.take(owner_by_column)) + ridge / len(y) * 1e-2 * w_at
        w_new, b_new, t_new = w_at - step * grad, b_at - step * float(slope.sum()), (1 + (1 + 4 * t * t) ** 0.5) / 2
        w_at, b_at = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return w, b


def score(docs: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, score) for every whole text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = model.table()
        for batch in batches:
            for lo, hi, raw, offs in gram_chunks(batch.column(1)):
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(model.score(raw, offs, place))], names=["doc_id", "score"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidied(scan), "doc_id long, score double")


def judged(scores: DataFrame, threshold: float) -> DataFrame:
    """The contract's columns from (doc_id, score)."""
    return scores.select("doc_id", (F.coalesce(crc32_mod3(F.col("doc_id")), F.lit(0)) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def kept(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that the model rejects, in one pass and with all columns."""
    at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = model.table()
        for batch in batches:
            for lo, hi, raw, offs in gram_chunks(batch.column(at)):
                clean = model.score(raw, offs, place) < threshold
                yield batch.slice(lo, hi - lo).filter(pa.array(clean))

    return docs.mapInArrow(tidied(scan), docs.schema)
