"""Line dedup: lines that many documents share stay in one of them.

Lines are exploded, normalised and hashed, a hash's documents are counted, and the lines of hashes in
enough documents are dropped everywhere but in the document of the largest id. DataFrame functions only.

Three narrow passes in place of one wide: the first shuffles a hash and an id for each different line of
a document, summed before the shuffle, so a line of every document is one row of each task; the second
joins lines to the hashes that are over the threshold (a join that Spark may broadcast by size, or split
where a hash is skewed); the third joins each text to the places of its dropped lines. Texts are shuffled
once at most, and only in the third.

A hash is 128 bits (two XXH64 of different seeds); keys with equal hashes count as equal.

Defined results: a null text is an empty one, and an empty text is one empty line; rows are documents of
their own, each counted once, also where they share an id or are equal in every column; of a line whose
largest id several rows have, all those rows keep it; rows without an id count, come before every id, and
keep a line that no row with an id holds; lines that occur several times in a document count once and are
dropped or kept alike; an empty table gives no rows; a text is never cut; other columns, whatever their
names, take no part.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Code points of a key, and documents that hold it, from which on its lines are dropped.
LEAST_CHARS, LEAST_DOCS = 40, 5

#: Fixed value of the contract: what is stripped from a line's ends.
BLANKS = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z in lower case; other letters keep their case."""
    body = F.trim(line, F.lit(BLANKS))
    plain = F.octet_length(body) == F.char_length(body)  # ASCII, where lower() changes A-Z alone
    return F.when(plain, F.lower(body)).otherwise(F.translate(body, string.ascii_uppercase, string.ascii_lowercase))


def _hashes(text: Column, *names: str) -> list[Column]:
    return [F.xxhash64(text).alias(names[0]), F.xxhash64(F.lit(7), text).alias(names[1])]


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *_hashes(text, "row_a", "row_b"))


def crowded_lines(docs: DataFrame, *, chars: int = LEAST_CHARS, least: int = LEAST_DOCS) -> DataFrame:
    """(a, b, n, keeper): hashes of keys that are in enough documents, the number of those, and the largest id."""
    long_ones = F.filter(lines_of(F.col("text")), lambda x: F.char_length(F.trim(x, F.lit(BLANKS))) >= chars)
    own = F.explode(F.array_distinct(F.transform(long_ones, line_key))).alias("line")
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    each = held.select("doc_id", own).select("doc_id", *_hashes(F.col("line"), "a", "b"))
    counts = each.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
    return counts.filter(F.col("n") >= least)


def dropped_places(docs: DataFrame, *, chars: int = LEAST_CHARS, least: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, row_a, row_b, places): numbers, from 0, of the lines that a text loses; only texts that lose any."""
    # Written first: then a line that a third of all documents have is a skewed side of the join alone, which Spark splits.
    crowded = staged(crowded_lines(docs, chars=chars, least=least).select("a", "b", "keeper"), "crowded_lines")
    each = _rows(docs).select("doc_id", "row_a", "row_b", F.posexplode(lines_of(F.col("text"))).alias("place", "line"))
    keyed = each.select("doc_id", "row_a", "row_b", "place", line_key(F.col("line")).alias("line"))
    places = keyed.filter(F.char_length("line") >= chars).select("doc_id", "row_a", "row_b", "place", *_hashes(F.col("line"), "a", "b"))
    lost = places.join(crowded, ["a", "b"]).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    # Equal rows have equal places, so a set is as long as a text at most.
    return lost.groupBy("doc_id", "row_a", "row_b").agg(F.collect_set("place").alias("places"))


def dedup(docs: DataFrame, *, chars: int = LEAST_CHARS, least: int = LEAST_DOCS) -> DataFrame:
    """One row for each row of docs: doc_id, n_lines, n_dropped and kept, the other lines joined by line feeds."""
    lost = dropped_places(docs, chars=chars, least=least).select(*[F.col(c).alias(f"lost_{c}") for c in ("doc_id", "row_a", "row_b")], "places")
    rows = _rows(docs)
    same = rows["doc_id"].eqNullSafe(lost["lost_doc_id"]) & (rows["row_a"] == lost["lost_row_a"]) & (rows["row_b"] == lost["lost_row_b"])
    both = rows.join(lost, same, "left").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "places")

    def without(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("places"))
        return F.struct(F.size(lines).alias("n"), F.size(left).alias("left"), F.array_join(F.transform(left, lambda k: lines[k]), "\n").alias("kept"))

    # The lines are a lambda's variable, so a text is split once and not for each of its lines.
    parted = F.transform(F.array(lines_of(F.col("text"))), without)[0]
    whole = F.struct(F.size(lines_of(F.col("text"))).alias("n"), F.size(lines_of(F.col("text"))).alias("left"), F.col("text").alias("kept"))
    done = both.select("doc_id", F.when(F.col("places").isNull(), whole).otherwise(parted).alias("r"))
    return done.select("doc_id", F.col("r.n").cast("long").alias("n_lines"), (F.col("r.n") - F.col("r.left")).cast("long").alias("n_dropped"), F.col("r.kept").alias("kept"))


def digests(found: DataFrame) -> DataFrame:
    """dedup's rows, with the SHA-256 of the kept text in place of the text."""
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
