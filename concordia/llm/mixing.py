"""Mixing sources to target weights by systematic sampling.

A document's expected copies are its source's target words divided by its source's words. Within a
source, documents stand in order of size, the expected copies are summed up to each document, one
random offset for the source is added, and a document is emitted once for each integer boundary that
its own share crosses. In order of size the error of a source's words stays within a document or two.

The order within a source is a slot made of the size, then block of a hash of id and text, then id, then the
text's MD5. The prefix sums are therefore built from three levels of counts (source and slot; block; row), so
that no window holds a whole source: a window of rows holds a BLOCKS-th of the texts of one size, and a
window of blocks BLOCKS rows.

Defined results: a null text has size 0; a null source is a source of its own, last; sources of no words get
target 0 and no copies; repeated rows, rows that share a doc_id and rows without one are separate documents
with a place each; rows equal in id and text are interchangeable; an empty table gives no rows; texts are
counted whole, in the JVM; other columns, whatever their names, take no part and emitted() passes them on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_unit, row_key, staged

#: Blocks that the texts of one size in a source are dealt to by hash.
BLOCKS = 1 << 16
#: Above all sizes: falling slots stand after rising ones.
FALLING = 1 << 60


def word_count(text) -> F.Column:
    """Number of words. All spaces are made alike first, which leaves the simplest pattern to match."""
    flat = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.regexp_count(flat, F.lit(r"[^\x20]++")).cast("long")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Sources by code point, null last, take the weights in turn. The share of a source stops at most
    times its size; what is above goes to the others by weight, until none is above. In order of
    size per weight, the sources that stop are a prefix, and the level of the rest is the first that
    the next source can hold.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = (
        totals.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("cap_before")).cast("double") / (F.col("all_weight") - F.col("weight_before")))
    )
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.min(F.when(fits, F.struct(F.col("cap") / F.col("weight"), F.col("place"), F.col("level")))).over(everything)["level"]
    return ranked.withColumn("water", level).select(
        "source", "source_size", "weight", F.least(F.col("cap").cast("double"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap").cast("double"))).alias("target")
    )


def mix(docs: DataFrame, *, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 42, size=None, key=None) -> DataFrame:
    """One row per document: its columns doc_id, source, and size, source_size, target, copies, taken; and key if one is given."""
    place = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    own = docs.select("doc_id", "source", (size if size is not None else word_count(F.col("text"))).alias("size"), place.alias("digest"), *([] if key is None else [key.alias("key")]))
    # Half of the documents stand in rising order of size, the other half after them in falling order: the
    # error then neither starts nor ends at a large document, and its two halves cancel on average.
    block = F.floor(hash_unit(F.col("doc_id"), F.col("digest")) * BLOCKS).cast("int")
    sized = own.withColumn("block", block).withColumn("slot", F.when(F.col("block") % 2 == 0, F.col("size")).otherwise(F.lit(FALLING) - F.col("size")))
    # Narrow rows, read several times below: the texts are read once.
    sized = staged(sized, "sizes")
    groups = sized.groupBy("source", "slot", "block").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
    by_slot = groups.groupBy("source", "slot").agg(F.sum("n").alias("n"), F.first("size").alias("size"))
    totals = by_slot.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(totals, weights, most)
    # Texts of no words add nothing to a source and take no part in its prefix sums.
    wordy = F.when(F.col("size") > 0, F.col("n")).otherwise(0)
    before_slot = F.coalesce(F.sum(wordy).over(Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slots = _null_safe_join(by_slot.withColumn("before_slot", before_slot).drop("n", "size"), targets, ["source"])
    before_block = F.coalesce(F.sum("n").over(Window.partitionBy("source", "slot").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = groups.withColumn("before_block", before_block).drop("n", "size")
    offsets = _null_safe_join(blocks, slots, ["source", "slot"])
    rows = sized.withColumn("nth", F.row_number().over(Window.partitionBy("source", "slot", "block").orderBy("doc_id", "digest")))
    placed = _null_safe_join(rows, offsets, ["source", "slot", "block"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = F.col("before_slot") + F.col("before_block") + F.col("nth")
    offset = hash_unit(F.lit(seed), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")))
    copies = F.floor(offset + place * F.col("rate")) - F.floor(offset + (place - 1) * F.col("rate"))
    copies = F.when(F.col("size") > 0, F.least(copies, F.lit(most))).otherwise(F.lit(0))
    return placed.withColumn("rate", rate).withColumn("copies", copies.cast("long")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"), *([] if key is None else ["key"])
    )


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal keys, nulls equal, the left's key columns kept."""
    named = right.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in right.columns])
    on = [left[k].eqNullSafe(named[f"__{k}"]) for k in keys]
    return left.join(named, on, "inner").drop(*[f"__{k}" for k in keys])


def emitted(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row as often as the mix takes it, with docs' columns.

    Copies are summed by row key: rows that share a key are equal in every column, so one of them is
    emitted as often as all of them are taken.
    """
    times = mix(docs, key=row_key(docs), **options).groupBy(F.col("key").alias("__row")).agg(F.sum("copies").cast("int").alias("__copies")).filter("__copies > 0")
    kept = docs.withColumn("__row", row_key(docs)).join(times, "__row").dropDuplicates(["__row"])
    return kept.withColumn("__copies", F.explode(F.array_repeat(F.lit(0), F.col("__copies")))).select(*docs.columns)
