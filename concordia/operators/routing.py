"""Vectors and those that ask for them, brought together cell by cell in groups of bounded size.

Rows live in one cell each; routes say which cells an asker looks into. A cell's rows are dealt into blocks
and its askers into parts, by hash and in numbers that follow the cell's own sizes, so a cell that holds a
third of all rows is as many groups as it needs. A group's scores are one matrix product, taken in steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import l2_normalize
from ..session import written

#: Rows and askers of a group, about, and scores that a worker holds at once.
ROWS, ASKERS, HELD_SCORES = 8192, 4096, 1 << 21
#: Bytes of vectors on either side of a group where all rows meet all askers, and the fewest vectors of a side.
SIDE_BYTES, LEAST_SIDE = 32 << 20, 1024
#: Bytes of vectors of a block whose near pairs are sought, about (twice as many at most), and the blocks of fewer rows.
NEAR_BYTES, NEAR_BLOCKS = 48 << 20, 8

#: (asker, row) places in the group, and scores.
Picked = tuple[np.ndarray, np.ndarray, np.ndarray]


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def meet(rows: DataFrame, routes: DataFrame, pick: Callable[[np.ndarray, np.ndarray, np.ndarray], Picked], names: tuple[str, str]) -> DataFrame:
    """(names, score) of what pick chooses of the scores between a cell's rows (key, vector, cell) and its askers (asker, vector, cell).

    pick gets a matrix of scores, askers by rows, and both sides' keys.
    """
    # As many rows as cells, whose centres are in the driver's memory in any case.
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).join(routes.groupBy("cell").agg(F.count(F.lit(1)).alias("m")), "cell")
    ways = F.broadcast(sizes.select("cell", F.ceil(F.col("n") / ROWS).cast("int").alias("blocks"), F.ceil(F.col("m") / ASKERS).cast("int").alias("parts")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    here = rows.join(ways, "cell").select("cell", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"), every("parts").alias("part"), "key", "vector")
    there = routes.join(ways, "cell").select("cell", every("blocks").alias("block"), F.pmod(F.xxhash64("asker"), F.col("parts")).cast("int").alias("part"), "asker", "vector")
    return _scored(here, there, ["cell", "block", "part"], pick, names)


def meet_all(rows: DataFrame, routes: DataFrame, pick: Callable[[np.ndarray, np.ndarray, np.ndarray], Picked], names: tuple[str, str]) -> DataFrame:
    """As meet(), where every asker looks at every row: rows (key, vector), askers (asker, vector), and in both a tag if equal ones mustn't meet.

    A stated set of queries against all rows, in blocks of SIDE_BYTES on either side: nothing passes the driver, and what
    is shuffled is each row once for a block of askers and each asker once for a block of rows. Vectors are of one length.
    """
    first = rows.select(F.size("vector")).first()
    side = max(LEAST_SIDE, SIDE_BYTES // (8 * max(1, first[0] if first else 1)))
    blocks, parts = (max(1, -(-df.count() // side)) for df in (rows, routes))
    dealt = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    here = rows.select(dealt(blocks, "key", "vector").alias("block"), every(parts).alias("part"), *rows.columns)
    there = routes.select(every(blocks).alias("block"), dealt(parts, "asker", "vector").alias("part"), *routes.columns)
    return _scored(here, there, ["block", "part"], pick, names)


def _scored(here: DataFrame, there: DataFrame, own: list[str], pick: Callable, names: tuple[str, str]) -> DataFrame:
    kinds = dict(there.dtypes)["asker"], dict(here.dtypes)["key"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            keys, asking = left["key"].combine_chunks(), right["asker"].combine_chunks()
            m, q = matrix(left["vector"]), matrix(right["vector"])
            if m.shape[1] != q.shape[1]:
                raise ValueError("vectors of different lengths")
            theirs, mine = _tags(left, right) if "tag" in left.column_names else (None, None)
            as_array = lambda x: x.to_numpy(zero_copy_only=False)
            step = max(1, HELD_SCORES // len(m))
            for at in range(0, len(q), step):
                some, scores = asking.slice(at, step), q[at : at + step] @ m.T
                if theirs is not None:
                    scores[mine[at : at + step, None] == theirs[None, :]] = -np.inf
                a, b, s = pick(scores, as_array(some), as_array(keys))
                found.append((some.take(pa.array(a)), keys.take(pa.array(b)), pa.array(s)))
        columns = list(zip(*found, strict=True)) or [[pa.array([], right["asker"].type)], [pa.array([], left["key"].type)], [pa.array([], pa.float64())]]
        return pa.table({n: pa.chunked_array(list(c)) for n, c in zip([*names, "score"], columns, strict=True)})

    return here.groupBy(*own).cogroup(there.groupBy(*own)).applyInArrow(score, f"{names[0]} {kinds[0]}, {names[1]} {kinds[1]}, score double")


def _tags(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Both sides' tags as numbers; null is a tag."""
    both = pa.chunked_array([*left["tag"].chunks, *right["tag"].chunks]).combine_chunks()
    numbers = both.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return numbers[: left.num_rows], numbers[left.num_rows :]


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, v): unit vectors of double precision; null, empty and zero ones, and those with null or non-finite components, are left out."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.filter(F.col(key).isNotNull() & v.isNotNull() & fine).select(F.col(key).alias("key"), l2_normalize(v).alias("v"))


def _cells(pivots: np.ndarray):
    """A function of vectors: the nearest pivot."""

    @F.pandas_udf("int")
    def cells(v):
        import pandas as pd

        return pd.Series(_reached(np.array(v.tolist(), np.float64).reshape(len(v), pivots.shape[1]), pivots, 0.0)[0].astype(np.int32))

    return cells


def _reached(x: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest pivot, and for every pivot whether a vector within reach may live in its cell.

    What is nearer to a pivot than to x's own lies beyond the plane between the two; x's distance from that plane
    is the least distance between them.
    """
    d = (x**2).sum(axis=1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(axis=1)[None]
    own = d.argmin(axis=1)
    gaps = np.sqrt(((pivots[:, None] - pivots[None]) ** 2).sum(axis=2))
    nearest = d[np.arange(len(x)), own]
    return own, (d - nearest[:, None]) / np.maximum(2 * gaps[own], 1e-12) <= reach + 1e-6


def classes(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, class, v): unit vectors with the smallest key that has the same one."""
    unit = usable(df, key, vector)
    first = unit.groupBy("v").agg(F.min("key").alias("class"))
    return unit.join(first, "v").select("key", "class", "v")


def near_pairs(found: DataFrame, least: float, *, pivots: int = 64) -> DataFrame:
    """(a, b, score): pairs a < b of classes whose unit vectors have a cosine of at least least; no pair is lost.

    found: as classes() gives it; only a class's own vector meets others, however many rows have it. A vector lives
    with the nearest of the pivots and reaches the cells that one within reach may live in. Cells, or parts of large
    ones, make up blocks of bounded size; two blocks meet once, each with those of its vectors that reach the other,
    and there cell by cell. So a vector moves at most once for each block: NEAR_BLOCKS times, however many rows there
    are, until blocks are full (NEAR_BYTES), and a pair of blocks is all that a task holds. Where vectors have no
    clusters no cell can be left out; then all pairs are scored, but not moved.
    """
    own = written(found.filter("key = class").dropDuplicates(["class"]).select(F.col("class").alias("key"), "v"), "near")
    chosen = own.orderBy(F.xxhash64("key"), "key").limit(pivots).collect()  # a bounded number
    if not chosen:
        return own.select(F.col("key").alias("a"), F.col("key").alias("b"), F.lit(0.0).alias("score")).limit(0)
    centres = np.array([r["v"] for r in chosen], np.float64)
    reach = float(np.sqrt(max(0.0, 2 - 2 * least)))
    sizes = np.zeros(len(centres), np.int64)
    for r in own.groupBy(_cells(centres)("v").alias("cell")).count().collect():  # as many rows as pivots
        sizes[r["cell"]] = r["count"]
    most = min(max(LEAST_SIDE, NEAR_BYTES // (8 * centres.shape[1])), max(1, -(-int(sizes.sum()) // NEAR_BLOCKS)))
    parts = np.maximum(1, -(-sizes // most))
    block_of, filled = [], 0  # of each cell's parts
    for n, k in zip(sizes.tolist(), parts.tolist(), strict=True):
        block_of.append([(filled + n * j // k) // most for j in range(k)])
        filled += n
    named = sorted({b for of in block_of for b in of})
    holds = np.array([[b in of for b in named] for of in block_of])  # cells by blocks
    place = [np.searchsorted(named, of) for of in block_of]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                cell, reached = _reached(matrix(pa.chunked_array([batch["v"]])), centres, reach)
                mine = np.array([place[c][h % len(place[c])] for c, h in zip(cell.tolist(), batch["h"].to_pylist(), strict=True)], np.int32)
                meets = reached @ holds
                meets[np.arange(len(mine)), mine] = True
                row, other = np.nonzero(meets)
                bits = pa.array([r.tobytes() for r in np.packbits(reached, axis=1)], pa.binary()).take(pa.array(row))
                sides = [pa.array(x.astype(np.int32)) for x in (np.minimum(mine[row], other), np.maximum(mine[row], other), mine[row], cell[row])]
                yield pa.record_batch([*sides, bits, *[batch[c].take(pa.array(row)) for c in ("key", "v")]], names=["low", "high", "block", "cell", "bits", "key", "v"])

    def score(group: pa.Table) -> pa.Table:
        block, cell, low, high = (group[c].to_numpy() for c in ("block", "cell", "low", "high"))
        keys, v = group["key"].combine_chunks(), matrix(group["v"])
        reached = np.unpackbits(np.frombuffer(b"".join(group["bits"].to_pylist()), np.uint8).reshape(len(v), -1), axis=1)
        as_array, one, found = keys.to_numpy(zero_copy_only=False), low[0] == high[0], []
        for c in np.unique(cell[block == high]).tolist():
            there = np.flatnonzero((block == high) & (cell == c))
            here = np.flatnonzero((block == low) & (reached[:, c] == 1) & ((cell <= c) | (not one)))
            m = v[there]
            for at in range(0, len(here), max(1, HELD_SCORES // len(there))):
                some = here[at : at + max(1, HELD_SCORES // len(there))]
                scores = v[some] @ m.T
                a, b = np.nonzero(scores >= least)
                s, a, b = scores[a, b], some[a], there[b]
                once = (cell[a] != cell[b]) | (not one) | (as_array[a] < as_array[b])
                found.append((a[once], b[once], s[once]))
        a, b, s = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        swap = as_array[a] > as_array[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        return pa.table({"a": keys.take(pa.array(a)), "b": keys.take(pa.array(b)), "score": pa.array(s)})

    kind = dict(own.dtypes)["key"]
    dealt = own.select("key", "v", F.xxhash64("key").alias("h")).mapInArrow(deal, f"low int, high int, block int, cell int, bits binary, key {kind}, v array<double>")
    return dealt.groupBy("low", "high").applyInArrow(score, f"a {kind}, b {kind}, score double")


def link_counts(df: DataFrame, least: float, *, key: str = "vec_id", vector: str = "embedding", group: str = "label", pivots: int = 64) -> DataFrame:
    """A row for each usable row: key, class, n_links (other rows that are near), and n_cross (those of another group; null is a group).

    Counted over classes and groups, so the square of a class is never written.
    """
    found = written(classes(df, key, vector), "classes")
    named = found.join(df.select(F.col(key).alias("key"), F.col(group).alias("group")), "key").select("key", "class", "group")
    sizes = named.groupBy("class", "group").agg(F.count(F.lit(1)).alias("n"))
    pairs = near_pairs(found, least, pivots=pivots).select("a", "b")
    both = pairs.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select("p.a", "p.b")  # scored once
    itself = named.select(F.col("class").alias("a")).distinct().select("a", F.col("a").alias("b"))
    reached = written(both.union(itself).join(sizes.withColumnRenamed("class", "b"), "b").groupBy(F.col("a").alias("class"), "group").agg(F.sum("n").alias("n")), "reached")
    total = reached.groupBy("class").agg(F.sum("n").alias("all"))
    mine = reached.select(F.col("class").alias("c"), F.col("group").alias("g"), F.col("n").alias("same"))
    out = named.join(total, "class").join(mine, (F.col("class") == F.col("c")) & F.col("group").eqNullSafe(F.col("g")))
    return out.select(F.col("key").alias(key), F.col("class"), (F.col("all") - 1).alias("n_links"), (F.col("all") - F.col("same")).alias("n_cross"))


def best_in_cells(cells: DataFrame, routes: DataFrame, k: int, best_of_scores: Callable, names: tuple[str, str]) -> DataFrame:
    """(names, score): at least each asker's k best rows of the cells that it looks into.

    Only the cells that are asked are read, where the table is partitioned by cell.
    """
    asked = [r["cell"] for r in routes.select("cell").distinct().collect()]  # as many as cells
    return meet(cells.filter(F.col("cell").isin(asked)), routes, best_of(best_of_scores, k), names)


def best_of(best: Callable, k: int) -> Callable[[np.ndarray, np.ndarray, np.ndarray], Picked]:
    """A pick of the k best of each row of scores, by best(scores, keys, k)."""

    def pick(scores: np.ndarray, asking: np.ndarray, keys: np.ndarray) -> Picked:
        row, column = best(scores, keys, k)
        return row, column, scores[row, column]

    return pick
