"""Near duplicates by SimHash and multi-index hashing.

Fingerprints are 64 bits over the words' shingles. Two fingerprints at most 2 bits apart differ by at
most 1 bit in one of their two 32-bit segments. So each segment has a table of its values, every
fingerprint looks up the Hamming ball of radius 1 around its own segment (33 values) in it, and what
it finds is verified on the complete fingerprints.

Only distinct fingerprints are looked up, whatever the number of copies. A segment value that more
than CROWD fingerprints share would yield the square of its group: those fingerprints, and all that
would have found them, are linked through complete balls of radius 1 instead. Two fingerprints are at
most 2 bits apart exactly if their complete balls share a point, so each point links all that have it
to the smallest one; that takes 65 rows a fingerprint and loses no link.

Links are made between fingerprints, not ids, so rows without a doc_id and rows that share one link like
any other: a component's id is the smallest doc_id that any row of it has, null only if none has one.

All tables here have rows for fingerprints or documents, so their joins are merges: a broadcast, which Spark
chooses by the size of compressed files, would bring a whole one through the driver.

Defined results: a text without words, an empty or a null text has fingerprint zero and links like any
other; fewer words than a shingle are one shingle of all of them; a bit that exactly half of the hashes
have is 0; repeated rows are separate rows of one component; an empty table gives no rows; a text is never
cut, so the longest one is the least that a worker holds; other columns, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import by_merge
from .common import let_go, row_key, staged, text_chunks, tidied
from .graph import components

#: Entries of a segment value's bucket beyond which its links go through complete balls.
CROWD = 24
SEED = 42


def fingerprint(text: str | None, width: int = 3, seed: int = SEED) -> int:
    """The fingerprint of one text, as an unsigned number."""
    return int(_fingerprints([(text or "").encode("utf-8", "surrogatepass")], width, seed)[0])


def _fingerprints(texts: list[bytes], width: int, seed: int) -> np.ndarray:
    digest, hashes, counts = xxhash.xxh64_intdigest, [], []
    for text in texts:
        words = text.lower().split()  # bytes: A-Z only, and ASCII space only
        if len(words) > width:
            joined = b" ".join(words)
            lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
            ends = np.cumsum(lengths) - 1
            starts = (ends - lengths + 1)[: len(words) - width + 1].tolist()
            found = [digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)]
            hashes.extend(found)
            counts.append(len(found))
        elif words:
            hashes.append(digest(b" ".join(words), seed))
            counts.append(1)
        else:
            counts.append(0)
    result, n = np.zeros(len(texts), np.uint64), np.array(counts, np.int64)
    if not hashes:
        return result
    some, all_hashes = np.flatnonzero(n), np.array(hashes, np.uint64)
    bounds = np.concatenate([[0], np.cumsum(n[some])])
    for k, row in enumerate(some):
        own = all_hashes[bounds[k] : bounds[k + 1]]
        ones = _bit_counts(own)
        result[row] = np.packbits(ones * 2 > len(own), bitorder="little").view("<u8")[0]
    return result


def _bit_counts(values: np.ndarray) -> np.ndarray:
    """How many of the values have each of the 64 bits, lowest first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(values), 1 << 15):
        part = values[at : at + (1 << 15)]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return total


def fingerprints(docs: DataFrame, *, width: int = 3, seed: int = SEED, key: F.Column | None = None) -> DataFrame:
    """(doc_id, fp, and key if one is given): fp is the fingerprint's 64 bits as a signed long, key a string."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for lo, hi, raw, offs in text_chunks(column):
                data = raw.tobytes()
                own = [data[a:b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
                found = pa.array(_fingerprints(own, width, seed).view(np.int64))
                rest = [batch.column(k).slice(lo, hi - lo) for k in range(2, batch.num_columns)]
                yield pa.record_batch([ids.slice(lo, hi - lo), found, *rest], names=["doc_id", "fp", *batch.schema.names[2:]])

    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if key is None:
        return docs.select(*own).mapInArrow(tidied(scan), "doc_id long, fp long")
    return docs.select(*own, key.alias("key")).mapInArrow(tidied(scan), "doc_id long, fp long, key string")


def _segments(fp) -> list[F.Column]:
    return [F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(0xFFFFFFFF))]


def _key(segment: int, value) -> F.Column:
    """Segment number and value in one long."""
    return value.bitwiseOR(F.lit(segment << 40))


#: The masks of a ball of radius 1 in a segment, and in a whole fingerprint.
_BALL_32 = [0] + [1 << k for k in range(32)]
_BALL_64 = [0] + [1 << k for k in range(63)] + [-(1 << 63)]


def links(nodes: DataFrame, *, bits: int = 2, crowd: int = CROWD) -> DataFrame:
    """(a, b): edges between distinct fingerprints (nodes: fp) that differ in at most 2 bits.

    All such pairs below crowded buckets; in crowded ones, edges that connect the same fingerprints.
    """
    if bits != 2:
        raise ValueError("two segments with balls of radius 1 find exactly the pairs within 2 bits")
    fp = F.col("fp")
    table = nodes.select("fp", F.explode(F.array(*[_key(k, v) for k, v in enumerate(_segments(fp))])).alias("key"))
    ball = F.array(*map(F.lit, _BALL_32))
    high, low = _segments(fp)
    balls = F.concat(F.transform(ball, lambda m: _key(0, high.bitwiseXOR(m))), F.transform(ball, lambda m: _key(1, low.bitwiseXOR(m))))
    probes = nodes.select(F.col("fp").alias("p_fp"), F.explode(balls).alias("key"))
    crowded = staged(table.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("key"), "crowded", rows=2 * nodes.count() // crowd)
    # One lookup finds both: entries of sparse buckets, and marks of crowded ones (with no fingerprint).
    mark = crowded.select("key", F.lit(None).cast("long").alias("fp"))
    targets = table.join(by_merge(crowded), "key", "left_anti").select("key", "fp").union(mark)
    near = (F.col("p_fp") != F.col("fp")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("p_fp"))) <= bits)
    hits = staged(probes.join(by_merge(targets), "key").filter(F.col("fp").isNull() | near).select("p_fp", "fp"), "hits")
    found = hits.filter("fp is not null").select(F.col("p_fp").alias("a"), F.col("fp").alias("b"))
    if crowded.isEmpty():
        return found
    rest = hits.filter("fp is null").select(F.col("p_fp").alias("fp")).distinct()
    points = rest.select("fp", F.explode(F.transform(F.array(*map(F.lit, _BALL_64)), lambda m: fp.bitwiseXOR(m))).alias("point"))
    heads = points.groupBy("point").agg(F.min("fp").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("point", "head")
    star = points.join(by_merge(heads), "point").filter((F.col("head") != F.col("fp")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("head"))) <= bits))
    return found.union(star.select(F.col("fp").alias("a"), F.col("head").alias("b")))


def near_duplicates(docs: DataFrame, *, width: int = 3, crowd: int = CROWD, key: F.Column | None = None) -> DataFrame:
    """(doc_id, fp, component_id, and group and key if a key is given) of each row of docs.

    component_id: the smallest doc_id that links reach; group: a fingerprint that stands for the component.
    """
    prints = staged(fingerprints(docs, width=width, key=key), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes", rows=prints.count())
    groups = components(links(nodes.select("fp"), crowd=crowd)).select(F.col("node").alias("fp"), "component")
    let_go(docs.sparkSession)  # of the probes
    named = staged(nodes.join(by_merge(groups), "fp", "left").select("fp", F.coalesce("component", "fp").alias("group"), "least"), "groups", rows=nodes.count())
    # Most groups are one fingerprint: only those of several meet to find their smallest id.
    several = named.filter("group <> fp").select("group").distinct()
    least = named.join(by_merge(several), "group", "left_semi").groupBy("group").agg(F.min("least").alias("lowest"))
    of_print = named.join(by_merge(least), "group", "left").select("fp", "group", F.coalesce("lowest", "least").alias("component_id"))
    out = prints.join(by_merge(of_print), "fp")
    return out.select("doc_id", "fp", "component_id") if key is None else out.select("doc_id", "fp", "component_id", "group", "key")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id, then of the smallest row key; rows without an id come last."""
    keyed = docs.withColumn("__row", row_key(docs))
    found = near_duplicates(docs, key=row_key(docs), **options)
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"))
    stay = first.select(F.col("first.key").alias("__row"))
    # Rows that share a key are equal in every column; one of them stays.
    return keyed.join(by_merge(stay), "__row", "left_semi").dropDuplicates(["__row"]).select(*docs.columns)


def fingerprint_hex(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
