"""Approximate nearest neighbours: stable projections, a kd-tree, and a chi-square stopping test.

Inner products are turned into distances by one more coordinate, sqrt(M^2 - |x|^2) with M the largest
norm (0 for queries). Vectors are projected on a few Gaussian directions, a 2-stable family: the squared
projected distance over the squared distance follows a chi-square law.

One kd-tree over the projections holds all vectors. Its top, cells of about BLOCK_ROWS vectors, is split at
medians of a sample of SAMPLE_ROWS projected vectors at most; every vector is placed in its cell, and the
vectors of a cell are dealt to blocks, each with the rest of the tree, down to leaves of LEAF_ROWS, over its
own. A search meets leaves in order of their distance in the projected space and the points in them,
verifies on the original vectors those that lie near enough, and stops when the test says that a vector
nearer than the k-th best would, with the confidence asked for, have been met before.

A query first descends to its own cell and searches one block there. Its k best scores go with it to the
other blocks, and within a task from each block to the next: blocks whose box lies beyond the test's limit
are left out, and the others return only what is better. So few rows come out of a block, however many
queries ask it.

The index is a table with a row for each block and one for the top of the tree, written once to the shared
folder. Queries go in chunks of CHUNK_ROWS, so that a broadcast doesn't grow with the data.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, neither as
query nor as candidate; vectors of different lengths are never neighbours, and each length has a tree of its
own; ties go to the smaller vec_id; fewer candidates than k are all returned; rows that share a vec_id are
candidates of their own, except for that id's query, and ask once, with the smallest of their vectors; rows
without a vec_id take no part; an empty table gives no rows; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import heapq
import math
import struct
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, tidied

#: Vectors in an index block, at most about; in a leaf of a tree; queries in a chunk; vectors that the top of the
#: tree is fitted on, and those of them that a cell needs.
BLOCK_ROWS, LEAF_ROWS, CHUNK_ROWS, SAMPLE_ROWS, CELL_SAMPLE = 1 << 13, 64, 1 << 14, 1 << 16, 16


def chi_square_cdf(x: np.ndarray, m: int) -> np.ndarray:
    """Distribution function of the chi-square law of an even number m of degrees of freedom."""
    half = np.minimum(np.asarray(x, float) / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, m // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_quantile(p: float, m: int) -> float:
    lo, hi = 0.0, 1.0
    while chi_square_cdf(np.array(hi), m) < p:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_cdf(np.array(mid), m) < p else (lo, mid)
    return hi


class KdTree:
    """Leaves of at most LEAF_ROWS points by median splits of the widest side; boxes around the leaves' points."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        cuts, todo = [], [(0, len(points))]
        while todo:
            a, b = todo.pop()
            if b - a <= LEAF_ROWS:
                cuts.append((a, b))
                continue
            own = points[self.order[a:b]]
            side = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            middle = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(own[:, side], middle)]
            todo += [(a, a + middle), (a + middle, b)]
        self.bounds = np.array(sorted(cuts), np.int64).reshape(-1, 2)
        held = points[self.order]
        self.low = np.minimum.reduceat(held, self.bounds[:, 0], axis=0)
        self.high = np.maximum.reduceat(held, self.bounds[:, 0], axis=0)

    def leaf_distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of a point to each leaf's box."""
        gap = np.maximum(0, np.maximum(self.low - q, q - self.high))
        return np.einsum("ij,ij->i", gap, gap)


class Top:
    """The top of the tree: a complete binary tree of cuts, and cells as its leaves, numbered from 0."""

    def __init__(self, side: np.ndarray, cut: np.ndarray, largest: float):
        self.side, self.cut, self.largest = side, cut, largest

    @classmethod
    def fit(cls, points: np.ndarray, cells: int, largest: float) -> Top:
        """Cuts at medians of the widest side, for at least so many cells as the sample can tell apart."""
        depth = 0
        while 1 << depth < cells and len(points) >> (depth + 1) >= CELL_SAMPLE:
            depth += 1
        side, cut, level = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1), [points]
        for d in range(depth):
            below = []
            for k, own in enumerate(level):
                at = (1 << d) - 1 + k
                if len(own):
                    side[at] = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                    cut[at] = np.median(own[:, side[at]])
                left = own[:, side[at]] < cut[at]
                below += [own[left], own[~left]]
            level = below
        return cls(side, cut, largest)

    def cells(self, points: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(points), np.int64), np.arange(len(points))
        for _ in range((len(self.side) + 1).bit_length() - 1):
            at = 2 * at + 1 + (points[rows, self.side[at]] >= self.cut[at])
        return at - len(self.side)

    def body(self) -> bytes:
        return struct.pack("<Qd", len(self.side), self.largest) + self.side.astype("<i8").tobytes() + self.cut.astype("<f8").tobytes()

    @classmethod
    def read(cls, body: bytes) -> Top:
        n, largest = struct.unpack_from("<Qd", body)
        return cls(np.frombuffer(body, "<i8", n, 16), np.frombuffer(body, "<f8", n, 16 + 8 * n), largest)


def _extra(vectors: np.ndarray, largest: float) -> np.ndarray:
    return np.sqrt(np.maximum(0, largest * largest - np.einsum("ij,ij->i", vectors, vectors)))


def projected(vectors: np.ndarray, largest: float, directions: np.ndarray) -> np.ndarray:
    """Projections of indexed vectors."""
    return vectors @ directions[:-1] + _extra(vectors, largest)[:, None] * directions[-1]


class Block:
    """One block of the index: original vectors in the tree's order, and the tree over their projections."""

    HEAD = struct.Struct("<QQQQd")

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, directions: np.ndarray):
        points = projected(vectors, largest, directions)
        self.largest, self.tree = largest, KdTree(points)
        self.ids, self.vectors, self.points = ids[self.tree.order], np.ascontiguousarray(vectors[self.tree.order]), points[self.tree.order]

    def body(self) -> bytes:
        """The block as bytes; vectors in single precision where that loses nothing."""
        t, single = self.tree, self.vectors.astype("<f4")
        narrow = bool((single == self.vectors).all())
        head = self.HEAD.pack(*self.vectors.shape, t.low.shape[1], len(t.bounds) << 1 | narrow, self.largest)
        parts = (self.ids.astype("<i8"), single if narrow else self.vectors.astype("<f8"), self.points.astype("<f8"), t.bounds.astype("<i8"), t.low.astype("<f8"), t.high.astype("<f8"))
        return head + b"".join(p.tobytes() for p in parts)

    @classmethod
    def read(cls, body: bytes) -> Block:
        n, width, m, leaves, largest = cls.HEAD.unpack_from(body)
        at, out = cls.HEAD.size, []
        for kind, shape in (("<i8", (n,)), ("<f4" if leaves & 1 else "<f8", (n, width)), ("<f8", (n, m)), ("<i8", (leaves >> 1, 2)), ("<f8", (leaves >> 1, m)), ("<f8", (leaves >> 1, m))):
            out.append(np.frombuffer(body, kind, math.prod(shape), at).reshape(shape))
            at += out[-1].nbytes
        block, tree = cls.__new__(cls), KdTree.__new__(KdTree)
        tree.bounds, tree.low, tree.high = out[3:]
        block.ids, block.vectors, block.points, block.tree, block.largest = out[0], out[1].astype(np.float64), out[2], tree, largest
        return block

    def far(self, queries: np.ndarray) -> np.ndarray:
        """Squared norms of queries and vectors together: a squared distance is this less twice the inner product."""
        return np.einsum("ij,ij->i", queries, queries) + self.largest * self.largest

    def near_enough(self, queries: np.ndarray, points: np.ndarray, bounds: np.ndarray, stop: float) -> np.ndarray:
        """Which queries the test sends to this block, by the distance of its box."""
        far, gap = self.far(queries), np.zeros(len(queries))
        for low, high, p in zip(self.tree.low.min(axis=0), self.tree.high.max(axis=0), points.T, strict=True):
            gap += np.maximum(0, np.maximum(low - p, p - high)) ** 2
        return gap <= _limit(far, bounds, stop)

    def search(self, qid: int, query: np.ndarray, point: np.ndarray, k: int, stop: float, bound: float = -math.inf) -> tuple[list[tuple[float, int]], int]:
        """(the k best (score, id) found that reach the bound, best first; number of vectors verified)."""
        tree, far = self.tree, float(query @ query) + self.largest * self.largest
        near = tree.leaf_distances(point)
        by_distance = np.argsort(near, kind="stable")
        best: list[tuple[float, int]] = []  # a heap of the k best, worst first, as (score, -id)
        at, step, verified = 0, 4, 0
        while at < len(by_distance):
            # Nothing nearer than the k-th best lies, with the test's confidence, beyond this projected distance.
            limit = float(_limit(far, bound, stop))
            if near[by_distance[at]] > limit:
                break
            leaves = by_distance[at : at + step]
            at, step = at + step, min(step * 2, 64)
            rows = np.concatenate([np.arange(*tree.bounds[j]) for j in leaves])
            gap = self.points[rows] - point
            rows = rows[np.einsum("ij,ij->i", gap, gap) <= limit]
            verified += len(rows)
            rows = rows[self.vectors[rows] @ query >= bound - 1e-9 * max(1.0, far)]  # far more than the rounding of a product
            scores = (self.vectors[rows] * query).sum(axis=1)  # the same sum for the same vector, wherever it lies
            ids = self.ids[rows]
            if len(rows) > 4 * k:
                keep = np.lexsort((ids, -scores))[: k + int((ids == qid).sum())]
                scores, ids = scores[keep], ids[keep]
            for s, i in zip(scores.tolist(), ids.tolist(), strict=True):
                if i == qid:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
            if len(best) == k:
                bound = max(bound, best[0][0])
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1])), verified


def _limit(far, bound, stop: float):
    """Squared projected distance up to which points matter. The slack is for rounding: copies of a vector lie at the same distance but for that."""
    return np.maximum(0.0, far - 2 * bound) * stop + 1e-9 * far


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v: array<double>) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = vectors.select(F.col("vec_id").cast("long"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & good & F.exists("v", lambda x: x != 0))
    return own


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


INDEX = "block long, cell int, way int, n long, width int, directions int, seed long, body binary"
_NAMES = [f.split()[0] for f in INDEX.split(", ")]
_KINDS = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())


def _index_row(*values) -> pa.RecordBatch:
    return pa.record_batch([pa.array([x], t) for x, t in zip(values, _KINDS, strict=True)], names=_NAMES)


def build_index(vectors: DataFrame, *, directions: int = 16, seed: int = 42) -> DataFrame:
    """The index as a table written to the shared folder, a row for each block and for each top (block -1): every usable vector."""
    spark = vectors.sparkSession
    data = staged(usable(vectors), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    sizes = data.groupBy(F.size("v").alias("width")).agg(F.max(F.sqrt(square)).alias("largest"), F.count(F.lit(1)).alias("n")).orderBy("width").collect()  # one row for each length
    parts = [_one_index(data.filter(F.size("v") == r["width"]), r["width"], r["largest"], r["n"], directions, seed) for r in sizes]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], INDEX)


def _one_index(data: DataFrame, width: int, largest: float, n: int, directions: int, seed: int) -> DataFrame:
    spark, gauss = data.sparkSession, _directions(width, directions, seed)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = projected(_matrix(batch.column(1), width), largest, gauss)
            yield pa.record_batch([batch.column(0), pa.array(list(p), pa.list_(pa.float64()))], names=["vec_id", "p"])

    # The sample is bounded by SAMPLE_ROWS rows of a few numbers.
    sample = data.mapInArrow(tidied(project), "vec_id long, p array<double>").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("p").toArrow()
    points = _matrix(sample.column(0).combine_chunks(), directions)
    top = Top.fit(points, math.ceil(n / BLOCK_ROWS), largest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = top.cells(projected(_matrix(batch.column(1), width), largest, gauss))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32))], names=["vec_id", "v", "cell"])

    placed = data.mapInArrow(tidied(place), "vec_id long, v array<double>, cell int")
    counts = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # SAMPLE_ROWS / CELL_SAMPLE cells at most
    # A cell of many vectors, copies of one for instance, is dealt to several blocks.
    ways = np.ones(len(top.side) + 1, np.int64)
    for cell, rows in counts.items():
        ways[cell] = math.ceil(rows / BLOCK_ROWS)
    first = np.cumsum(ways) - ways

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = TaskContext.get().partitionId()
        for batch in batches:
            cell = top.cells(projected(_matrix(batch.column(1), width), largest, gauss))
            way = (nth + np.arange(len(cell))) % ways[cell]  # in turn, whatever the ids
            nth += len(cell)
            yield pa.record_batch([pa.array(first[cell] + way), pa.array(cell.astype(np.int32)), pa.array(way.astype(np.int32)), batch.column(0), batch.column(1)], names=["key", "cell", "way", "vec_id", "v"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key, size, nth = None, 0, 0

        def made() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            block = Block(t.column(3).to_numpy(), _matrix(t.column(4).chunk(0), width), largest, gauss)
            return _index_row(key << 20 | nth, t.column(1)[0].as_py(), t.column(2)[0].as_py(), size, width, directions, seed, block.body())

        for batch in batches:
            keys = batch.column(0).to_numpy()
            for a, b in pairwise([0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]):
                for lo in range(a, b, BLOCK_ROWS):
                    part = batch.slice(lo, min(BLOCK_ROWS, b - lo))
                    if size and (keys[lo] != key or size + part.num_rows > 2 * BLOCK_ROWS):
                        yield made()
                        held, size, nth = [], 0, nth + 1 if keys[lo] == key else 0
                    held.append(part)
                    key, size = int(keys[lo]), size + part.num_rows
        if size:
            yield made()

    blocks = int(ways.sum())
    dealt = data.mapInArrow(tidied(deal), "key long, cell int, way int, vec_id long, v array<double>").repartition(min(blocks, 1 << 14), "key").sortWithinPartitions("key", "vec_id")
    head = spark.createDataFrame([(-1, -1, 0, 0, width, directions, seed, bytearray(top.body()))], INDEX)
    return staged(dealt.mapInArrow(tidied(make), INDEX).union(head), "ann-index")


def _directions(width: int, directions: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width + 1, directions))


def _groups(sorted_keys: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """(key, places) of each run of equal keys."""
    cuts = np.flatnonzero(np.diff(sorted_keys)) + 1
    places = np.split(np.arange(len(sorted_keys)), cuts) if len(sorted_keys) else []
    return [int(sorted_keys[p[0]]) for p in places], places


class Carried:
    """Each query's k best scores so far, worst first; -inf where it has fewer."""

    def __init__(self, queries: int, k: int):
        self.best = np.full((queries, k), -np.inf)

    def add(self, query: int, scores: list[float]) -> None:
        own = np.sort(np.concatenate([self.best[query], scores]))
        self.best[query] = own[len(own) - self.best.shape[1] :]

    def bounds(self) -> np.ndarray:
        return self.best[:, 0]


def ask(block: Block, some: np.ndarray, ids: np.ndarray, q: np.ndarray, points: np.ndarray, carried: Carried, k: int, stop: float) -> Iterator[tuple[int, list, int]]:
    """(query's place, its (score, id) in the block that reach what is carried, vectors verified) of some queries; carries their scores on."""
    for j in np.flatnonzero(some & block.near_enough(q, points, carried.bounds(), stop)):
        hits, verified = block.search(int(ids[j]), q[j], points[j], k, stop, float(carried.best[j, 0]))
        carried.add(j, [s for s, _ in hits])
        yield int(j), hits, verified


_HITS = "query_id long, vec_id long, score double"


def _hits(ids: np.ndarray, found: Iterator[tuple[int, list, int]]) -> pa.RecordBatch:
    flat = [(int(ids[j]), i, s) for j, hits, _ in found for s, i in hits]
    q, i, s = zip(*flat, strict=True) if flat else ((), (), ())
    return pa.record_batch([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "vec_id", "score"])


def search_index(index: DataFrame, queries: DataFrame, *, k: int = 20, confidence: float = 0.9) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query, by inner product.

    A vector is no neighbour of a query with its own id.
    """
    spark, schema = index.sparkSession, "query_id long, rank int, vec_id long, score double"
    asked = staged(usable(queries).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("place", F.xxhash64("vec_id")), "asked")
    parts = []
    for top in index.filter("block = -1").collect():  # one row for each length of vectors
        parts += _search_one(index, asked.filter(F.size("v") == top["width"]), top, k, confidence)
    if not parts:
        return spark.createDataFrame([], schema)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = reduce(DataFrame.union, parts)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_one(index: DataFrame, asked: DataFrame, meta, k: int, confidence: float) -> list[DataFrame]:
    """What each chunk of queries finds among the vectors of one length."""
    spark, width, top = index.sparkSession, meta["width"], Top.read(bytes(meta["body"]))
    gauss, stop = _directions(width, meta["directions"], meta["seed"]), chi_square_quantile(confidence, meta["directions"])
    blocks = index.filter((F.col("block") >= 0) & (F.col("width") == width)).select("cell", "way", "body")
    parts = []
    for chunk in range(chunks := math.ceil(asked.count() / CHUNK_ROWS)):
        own = asked.filter(F.pmod("place", F.lit(chunks)) == chunk).select("vec_id", "v").toArrow()
        if not own.num_rows:
            continue
        ids, q = own.column(0).to_numpy().astype(np.int64), _matrix(own.column(1).combine_chunks(), width)
        points = q @ gauss[:-1]
        home = top.cells(points)
        sent = spark.sparkContext.broadcast((ids, q, points, home))

        def descend(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, q, points, home = sent.value
            carried = Carried(len(ids), k)
            for batch in batches:
                for cell, body in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                    if (home == cell).any():
                        yield _hits(ids, ask(Block.read(body.as_py()), home == cell, ids, q, points, carried, k, stop))

        first = staged(blocks.filter("way = 0").mapInArrow(tidied(descend), _HITS), "neighbours")
        own_hits = first.select("query_id", "score").toArrow()  # k rows at most for each query of the chunk
        place = np.argsort(ids)
        place = place[np.searchsorted(ids[place], own_hits.column(0).to_numpy())]
        known = Carried(len(ids), k)
        scores = own_hits.column(1).to_numpy()
        by_query = np.argsort(place, kind="stable")
        for j, at in zip(*_groups(place[by_query]), strict=True):
            known.add(j, scores[by_query[at]])
        sent_best = spark.sparkContext.broadcast(known.best)

        def others(batches: Iterator[pa.RecordBatch], sent=sent, sent_best=sent_best) -> Iterator[pa.RecordBatch]:
            ids, q, points, home = sent.value
            carried = Carried(0, k)
            carried.best = sent_best.value.copy()
            for batch in batches:
                for cell, way, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    # A cell's first block has been searched by the queries of the cell already.
                    yield _hits(ids, ask(Block.read(body.as_py()), (home != cell) | (way > 0), ids, q, points, carried, k, stop))

        parts += [first, staged(blocks.mapInArrow(tidied(others), _HITS), "neighbours")]
        sent.unpersist()
        sent_best.unpersist()
    return parts


def search(vectors: DataFrame, queries: DataFrame, *, k: int = 20, directions: int = 16, confidence: float = 0.9, seed: int = 42) -> DataFrame:
    """Index vectors and search them: see build_index and search_index."""
    return search_index(build_index(vectors, directions=directions, seed=seed), queries, k=k, confidence=confidence)
