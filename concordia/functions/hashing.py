"""Content hashes over canonical JSON."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .canonical import canonical, json_float, json_string

#: Fixed list: the fields that a content hash covers.
HASHED = (
    "description", "item_type", "values", "value_set_ref", "source_authority", "source_code", "source_version", "alternate_names", "collections", "metadata_", "unit_of_measure", "unit_vocabulary",
    "plausible_min", "plausible_max", "numeric_precision", "cardinality", "missing_value_convention",
)


def _hashed_field(name: str, c: Column) -> Column:
    """The canonical JSON of one hashed field; null stays null."""
    if name == "alternate_names":
        names = F.array_join(F.transform(F.sort_array(F.split(c, r"\|", -1)), json_string), ",")
        return F.when(c != "", F.concat(F.lit("["), names, F.lit("]")))
    if name == "collections":
        held = F.array_join(F.transform(F.sort_array(c), lambda x: F.coalesce(json_string(x), F.lit("null"))), ",")
        return F.concat(F.lit("["), F.coalesce(held, F.lit("")), F.lit("]"))
    if name == "metadata_":
        return F.when(c != "", canonical(c))
    if name == "numeric_precision":
        return c.cast("long").cast("string")
    if name in ("plausible_min", "plausible_max"):
        return json_float(F.when(~F.isnan(c.cast("double")), c.cast("double")))
    return json_string(c.cast("string"))


def content_hash(df: DataFrame) -> Column:
    """SHA-256 of an element's hashed fields; columns that the table lacks count as null, as do not-a-numbers.

    All of it is Column functions, canonical JSON of any text, number and metadata included.
    """

    def field(name: str) -> Column:
        column = "member_of_collections" if name == "collections" else name
        kind = "array<string>" if name == "collections" else "string"
        value = F.col(column) if column in df.columns else F.lit(None).cast(kind)
        return F.concat(F.lit(f'"{name}":'), F.coalesce(_hashed_field(name, value), F.lit("null")))

    return F.sha2(F.concat(F.lit("{"), F.concat_ws(",", *map(field, sorted(HASHED))), F.lit("}")), 256)


def native_hash(fields: dict[str, Column], numbers: tuple[str, ...] = ()) -> Column:
    """SHA-256 of an object of whole numbers and texts."""
    parts = [F.concat(F.lit(f'"{k}":'), F.coalesce(v.cast("string") if k in numbers else json_string(v.cast("string")), F.lit("null"))) for k, v in sorted(fields.items())]
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")), 256)


def rollup_tree(df: DataFrame, hashed: str = "content_hash", digits: int = 4) -> DataFrame:
    """One row: a digest of all row hashes that no single place has to read.

    Equal hashes are counted, a line each, and lines are digested by their hash's first digits, sorted; the
    digest of these digests, 16^digits at most, is the result. Null counts as empty.
    """
    counted = df.groupBy(F.coalesce(F.col(hashed), F.lit("")).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    lines = F.array_join(F.sort_array(F.collect_list(F.concat_ws(" ", "h", "n"))), "\n")
    parts = counted.groupBy(F.left("h", F.lit(digits)).alias("part")).agg(F.sha2(lines, 256).alias("digest"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "digest"))), lambda x: x["digest"]), "\n")
    return parts.agg(F.sha2(whole, 256).alias("rollup_hash"))


def rollup_hash(df: DataFrame, hashed: str = "content_hash") -> DataFrame:
    """One row: SHA-256 of all row hashes, sorted, a line each; null counts as empty. As bundles of other makers have it.

    A single digest needs its lines in one order and one place. Rows are sorted by range in parallel and the
    digest is fed partition after partition, so the driver holds one partition's hashes at most. rollup_tree
    has no such place and is for large tables.
    """
    digest, first = hashlib.sha256(), True
    for row in df.select(F.coalesce(F.col(hashed), F.lit("")).alias("h")).orderBy("h").toLocalIterator():
        digest.update((row["h"] if first else "\n" + row["h"]).encode())
        first = False
    return df.sparkSession.createDataFrame([(digest.hexdigest(),)], "rollup_hash string")
