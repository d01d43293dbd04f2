"""Which elements have a code: an inverted index of (vocabulary, code), kept in sorted Parquet files.

Files hold ranges of codes, and rows in them are in order, so a lookup reads the row groups alone whose bounds
take the code in, and of those only the ones whose Bloom filter has it. Later elements are appended as files of
their own, sorted alike; compact() writes all of them as one again.

Defined results: null and blank vocabularies or codes aren't indexed; an element that has a code twice is found
once; a code that many elements have lies in several row groups, and may in several files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group: what a lookup reads at least.
GROUP_BYTES = 8 << 20
_KEYS = ("vocabulary", "code")


def entries(elements: DataFrame, key: str, codes: str = "alternate_codes") -> DataFrame:
    """(vocabulary, code, key): one row for each code of an element. codes: array<struct<vocabulary, code>>."""
    own = F.filter(F.col(codes), lambda x: (F.coalesce(x["vocabulary"], F.lit("")) != "") & (F.coalesce(x["code"], F.lit("")) != ""))
    return elements.select(F.col(key).alias("key"), F.inline(F.array_distinct(own))).select(*_KEYS, "key").distinct()


def _put(rows: DataFrame, path: str, mode: str, group_bytes: int) -> None:
    """Ranges follow the key too, so a code that a third of all elements have is cut like any other."""
    ordered = rows.repartitionByRange(*_KEYS, "key").sortWithinPartitions(*_KEYS, "key")
    options = {"parquet.block.size": group_bytes, "parquet.bloom.filter.enabled#code": "true", "parquet.enable.dictionary": "false"}
    ordered.write.mode(mode).options(**options).parquet(path)


def write(elements: DataFrame, path: str, key: str, codes: str = "alternate_codes", *, group_bytes: int = GROUP_BYTES) -> None:
    _put(entries(elements, key, codes), path, "overwrite", group_bytes)


def append(elements: DataFrame, path: str, key: str, codes: str = "alternate_codes", *, group_bytes: int = GROUP_BYTES) -> None:
    """Add the codes of elements that aren't indexed yet; an entry that is there already isn't written again."""
    known = elements.sparkSession.read.parquet(path)
    _put(entries(elements, key, codes).join(known, [*_KEYS, "key"], "left_anti"), path, "append", group_bytes)


def compact(spark: SparkSession, path: str, to: str, *, group_bytes: int = GROUP_BYTES) -> None:
    """All entries of an index as one, written to another path."""
    _put(spark.read.parquet(path), to, "overwrite", group_bytes)


def lookup(spark: SparkSession, path: str, vocabulary: str, code: str | None = None) -> DataFrame:
    """(key, code) of the elements that have a code of the vocabulary, or that code."""
    found = spark.read.parquet(path).filter(F.col("vocabulary") == vocabulary)
    return (found if code is None else found.filter(F.col("code") == code)).select("key", "code")


def lookup_all(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """wanted (vocabulary, code and others) with the key of each element that has the code."""
    return wanted.join(spark.read.parquet(path), list(_KEYS))
