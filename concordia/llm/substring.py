"""Substring dedup by relative Lempel-Ziv factors of words against an index of all documents.

The reference of a document is all text of documents with smaller ids. It is indexed in blocks, and a
document's words are factored greedily against every block that can hold a factor of theirs: from each word
on that no factor has reached, the factor is the longest run of words that goes on as the reference does.
Factors of at least WINDOW words count. Greedy factors of a block may end inside a longer repeat, where the
reference changes or the next block begins, so boundaries are checked word by word: a word begins a window of
WINDOW words, and each window that stands in the reference belongs to a factor, also across factors' ends.

Blocks are dealt out by anchors. A window's anchor is the smallest hash of its GRAM-word grams, so equal
windows have equal anchors, wherever they stand, and no other block can hold one. Neighbouring windows share
an anchor, so an entry of a block is a run of them: anchor, document, place, and a hash for each word that
begins a window. A block is sorted by document and place and read as a stream: what was read before is the
reference, the first holder of a window in it is the source that a factor copies from, and a worker holds a
bounded number of entries and, of the block that is open, one source for each different window.

Blocks of many entries (anchors found on a sample) are dealt out by document in as many ways as their entries
ask for. All of a window's entries under a way but the first document's are repeated; the first ones of all
ways, one row for each way and window, are compared once more. Either way gives the same windows, so the
sample decides on the cost alone.

Defined results: a null text has no words; fewer words than a window: nothing is removed; rows that share a
doc_id are judged each by its own words and are never each other's reference; rows equal in both have equal
results; a null doc_id is neither reference nor repeated; of several sources the one of the smallest doc_id,
then of the first place, is taken; an empty table gives no rows; texts are whole, the longest is the least
that a worker holds; other columns, whatever their names, take no part. Windows are equal if their 64-bit
hashes and their anchors' are; their words are not compared again.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_unit, let_go, mix64, slice_hashes, staged, text_chunks, tidied, word_bounds, word_hashes

WINDOW, GRAM = 50, 25
#: Windows that a worker holds at once; share of documents in the sample; entries in the sample that make an anchor
#: crowded at least; the share of all entries there that does; ways that crowded entries are dealt in at least, and
#: entries of one way at most, about; crowded anchors at most.
HELD, SAMPLE, LEAST_CROWD, CROWD_SHARE, SALTS, SALT_ROWS, MOST_CROWDED = 1 << 19, 1 / 16, 64, 1 / 2048, 64, 1 << 16, 1 << 18


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of width entries from each place on."""
    reach, out = 1, x
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


class Windows:
    """The windows of a chunk of texts: anchor, hash, row, and place in the row's words."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray, window: int, gram: int):
        starts, ends, before = word_bounds(raw, offs)
        words = word_hashes(raw, starts, ends)
        n = len(words)
        count = np.maximum(0, np.diff(before) - window + 1)
        self.row = np.repeat(np.arange(len(offs) - 1), count)
        self.place = np.arange(len(self.row)) - np.repeat(np.cumsum(count) - count, count)
        if not len(self.row):
            self.anchor = self.hash = np.zeros(0, np.uint64)
            return
        at = before[self.row] + self.place
        first = np.arange(n - gram + 1)
        grams = slice_hashes(words, first, first + gram)
        self.anchor = _sliding_min(grams, window - gram + 1)[at]
        self.hash = slice_hashes(words, at, at + window)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal entries begin, and the end."""
    n = len(columns[0])
    if not n:
        return np.zeros(1, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key")).filter(F.col("doc_id").isNotNull())


def crowded_anchors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Sorted anchors of many entries, MOST_CROWDED at most, and how many ways to deal each one's entries."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, raw, offs in text_chunks(batch.column(1)):
                w = Windows(raw, offs, window, gram)
                keys = w.anchor[_runs(w.row, w.anchor)[:-1]]
                yield pa.record_batch([pa.array(keys.view(np.int64))], names=["anchor"])

    sample = _texts(docs).filter(hash_unit(F.lit("sample"), F.col("doc_id")) < SAMPLE)
    counts = staged(sample.mapInArrow(tidied(scan), "anchor long").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LEAST_CROWD), "anchors")
    total = (counts.agg(F.sum("n")).first()[0] or 0)
    bound = max(LEAST_CROWD, min(total * CROWD_SHARE, max(SALT_ROWS * SAMPLE, total / MOST_CROWDED)))
    found = sorted((np.int64(r["anchor"]).view(np.uint64), r["n"]) for r in counts.filter(F.col("n") > bound).collect())
    ways = [max(SALTS, math.ceil(n / SAMPLE / SALT_ROWS)) for _, n in found]
    return np.array([a for a, _ in found], np.uint64), np.array(ways, np.uint64)


def _among(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    if not len(some):
        return np.zeros(len(values), bool)
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values


ENTRY = "key long, anchor long, doc_id long, text_key long, start int, windows binary"
#: Pieces of a row: the factors of its words; or, with anchor and hash, places of a window whose source isn't known yet.
FOUND = "doc_id long, text_key long, pieces array<struct<start:int,n:int,source:long,source_start:int>>, anchor long, hash long"
_PIECES = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("source", pa.int64()), ("source_start", pa.int32())]))


def factors(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_key, pieces): factors of each text that has any. A factor is n windows from word start on, n + window - 1 words,
    which stand from word source_start on in the document source, whose id is smaller."""
    some, dealt = crowded_anchors(docs, window, gram)  # MOST_CROWDED numbers at most, so they go with the tasks

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, raw, offs in text_chunks(batch.column(1)):
                w = Windows(raw, offs, window, gram)
                bounds = _runs(w.row, w.anchor)
                first = bounds[:-1]
                anchors = w.anchor[first]
                crowd = _among(anchors, some)
                row = pa.array(w.row[first] + lo)
                ids = batch.column(0).take(row)
                key = anchors.copy()
                if crowd.any():
                    salt = mix64(ids.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))[crowd] % dealt[np.searchsorted(some, anchors[crowd])]
                    key[crowd] = mix64(anchors[crowd] + salt)
                held = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((bounds * 8).astype(np.int32).tobytes()), pa.py_buffer(w.hash.tobytes())])
                anchor = pa.array(anchors.view(np.int64), mask=~crowd)
                yield pa.record_batch([pa.array(key.view(np.int64)), anchor, ids, batch.column(2).take(row), pa.array(w.place[first].astype(np.int32)), held], names=[f.split()[0] for f in ENTRY.split(", ")])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size, carry = 0, None
        for batch in batches:
            kept.append(batch)
            size += batch.column(5).nbytes // 8
            if size >= HELD:
                found, carry = _parsed(pa.Table.from_batches(kept).combine_chunks(), carry)
                kept, size = [], 0
                yield found
        if kept:
            yield _parsed(pa.Table.from_batches(kept).combine_chunks(), carry)[0]

    index = _texts(docs).mapInArrow(tidied(entries), ENTRY)
    blocks = index.repartition(F.col("key")).sortWithinPartitions("key", "doc_id", "start").mapInArrow(tidied(parse), FOUND)
    found = staged(blocks, "factors")
    sure = found.filter("hash is null").select("doc_id", "text_key", "pieces")
    if len(some):
        # The first entries of each way: all but those of the smallest document are repeated too. A window of the
        # window function holds a row for each way, however often a document repeats it.
        own = F.struct("doc_id", F.col("pieces")[0]["start"].alias("at"))
        first = found.filter("hash is not null").withColumn("least", F.min(own).over(Window.partitionBy("anchor", "hash"))).filter("least.doc_id < doc_id")
        named = F.transform("pieces", lambda p: F.struct(p["start"].alias("start"), p["n"].alias("n"), F.col("least.doc_id").alias("source"), F.col("least.at").alias("source_start")))
        sure = sure.union(first.select("doc_id", "text_key", named.alias("pieces")))
    return sure.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("pieces")).alias("pieces"))


def _grouped(group: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, pa.Array]:
    """(first of each run of equal groups, the runs as lists of pieces)."""
    bounds = _runs(group)
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32())
    values = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], fields=list(_PIECES.value_type))
    return bounds[:-1], pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values).cast(_PIECES)


def _parsed(rows: pa.Table, carry: tuple | None) -> tuple[pa.RecordBatch, tuple | None]:
    """The factors of entries sorted by key, doc_id and start, and the sources in the last block, which may go on."""
    column = rows.column(5).chunk(0)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    lengths = np.diff(offsets) // 8
    hashes = np.frombuffer(column.buffers()[2], np.uint64)[offsets[0] // 8 : offsets[-1] // 8]
    row_keys, row_ids, row_texts = (rows.column(k).to_numpy() for k in (0, 2, 3))
    run = np.repeat(np.arange(rows.num_rows), lengths)
    keys, ids = row_keys[run], row_ids[run]
    place = (np.arange(len(run)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + rows.column(4).to_numpy()[run]).astype(np.int64)
    old = 0
    if carry is not None and carry[0] == row_keys[0]:
        old = len(carry[1])
        hashes, ids, place = np.concatenate([carry[1], hashes]), np.concatenate([carry[2], ids]), np.concatenate([carry[3], place])
        keys = np.concatenate([np.full(old, carry[0]), keys])
    # What was read first comes first among equal windows: the smallest document, then the first place.
    order = np.argsort(mix64(hashes ^ mix64(keys.view(np.uint64))), kind="stable")
    bounds = _runs(hashes[order], keys[order])
    heads = order[bounds[:-1]]
    source = np.empty(len(hashes), np.int64)
    source[order] = np.repeat(heads, np.diff(bounds))
    open_ = heads[keys[heads] == row_keys[-1]]
    carry = (row_keys[-1], hashes[open_], ids[open_], place[open_])
    again = (ids[source] < ids)[old:]
    from_id, from_place = ids[source][old:], place[source][old:]
    hashes, place = hashes[old:], place[old:]
    # A factor goes on while the next window's source is the next window of the same document.
    some = np.flatnonzero(again)
    pieces = _runs(run[some], some - np.arange(len(some)), from_id[some], from_place[some] - place[some])
    first, n = some[pieces[:-1]], np.diff(pieces)
    owner = np.cumsum(np.concatenate([[0], (row_ids[1:] != row_ids[:-1]) | (row_texts[1:] != row_texts[:-1]) | (row_keys[1:] != row_keys[:-1])]))
    at_sure, sure = _grouped(owner[run[first]], [place[first], n, from_id[first], from_place[first]])
    rows_sure = run[first[at_sure]]
    # Windows of crowded blocks that were first under their way are looked at once more, each with all its places in the document.
    anchors = rows.column(1).combine_chunks()
    crowd = anchors.is_valid().to_numpy(zero_copy_only=False)
    unsure = np.flatnonzero(~again & crowd[run])
    unsure = unsure[np.lexsort((place[unsure], hashes[unsure], owner[run[unsure]]))]
    group = _runs(owner[run[unsure]], hashes[unsure])
    group = np.repeat(np.arange(len(group) - 1), np.diff(group))
    same = _runs(group, place[unsure] - np.arange(len(unsure)))  # equal windows one after the other
    held = unsure[same[:-1]]
    none = np.full(len(held), -1)
    at_unsure, maybe = _grouped(group[same[:-1]], [place[held], np.diff(same), none, none])
    rows_unsure = run[held[at_unsure]]
    at = np.concatenate([rows_sure, rows_unsure])
    is_sure = np.arange(len(at)) < len(rows_sure)
    marks = anchors.fill_null(0).to_numpy()[at]
    windows = np.concatenate([np.zeros(len(rows_sure), np.uint64), hashes[held[at_unsure]]]).view(np.int64)
    arrays = [pa.array(row_ids[at]), pa.array(row_texts[at]), pa.concat_arrays([sure, maybe]), pa.array(marks, mask=is_sure), pa.array(windows, mask=is_sure)]
    return pa.record_batch(arrays, names=["doc_id", "text_key", "pieces", "anchor", "hash"]), carry


def _covered(n_words: int, spans: list, window: int) -> np.ndarray:
    """Which words the windows cover."""
    edge = np.zeros(n_words + 1, np.int64)
    for start, n in spans:
        if start < n_words:
            edge[start] += 1
            edge[min(n_words, start + n + window - 1)] -= 1
    return np.cumsum(edge[:-1]) > 0


def dedup(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept (its other words, joined by spaces), spans of words removed."""
    return _joined(docs, window, gram, lambda words, cover: b" ".join(words if cover is None else [w for w, c in zip(words, cover, strict=True) if not c]).decode("utf-8", "replace"), "kept string", pa.string())


def digests(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """As dedup, with the SHA-256 of the kept text in place of the text."""
    return _joined(docs, window, gram, lambda words, cover: hashlib.sha256(b" ".join(words if cover is None else [w for w, c in zip(words, cover, strict=True) if not c])).hexdigest(), "kept_sha256 string", pa.string())


def _joined(docs: DataFrame, window: int, gram: int, made, column: str, kind: pa.DataType) -> DataFrame:
    spans = factors(docs, window=window, gram=gram).select("doc_id", "text_key", F.transform("pieces", lambda p: F.struct(p["start"].alias("start"), p["n"].alias("n"))).alias("spans"))
    let_go(docs.sparkSession)  # of the index
    text = F.col("text").cast("string")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    both = own.join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans")
    name = column.split()[0]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offs in text_chunks(batch.column(1)):
                data, own = raw.tobytes(), batch.column(2).slice(lo, hi - lo)
                out: tuple[list, list, list, list] = ([], [], [], [])
                has = own.is_valid().to_numpy(zero_copy_only=False)
                for k in range(hi - lo):
                    words, cover, removed = data[offs[k] : offs[k + 1]].split(), None, []
                    if has[k]:
                        cover = _covered(len(words), [(s["start"], s["n"]) for s in own[k].as_py()], window)
                        edge = np.flatnonzero(np.diff(np.concatenate([[0], cover.astype(np.int8), [0]])))
                        removed = [{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)]
                    out[0].append(len(words))
                    out[1].append(0 if cover is None else int(cover.sum()))
                    out[2].append(made(words, cover))
                    out[3].append(removed)
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], kind), pa.array(out[3], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["doc_id", "n_words", "n_removed", name, "removed"])

    return both.mapInArrow(tidied(scan), f"doc_id long, n_words long, n_removed long, {column}, removed array<struct<start:long,end:long>>")
