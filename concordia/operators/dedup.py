"""Deduplication within a source, and unions by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

#: Columns whose values all come from a group's best row.
SCALARS = (
    "item", "description", "item_type", "unit_of_measure", "unit_vocabulary", "plausible_min", "plausible_max", "cardinality", "values", "source_version", "source_url", "source_retrieved_date",
    "canonical_concept_id", "curation_status",
)


def best_row(df: DataFrame, keys: list[str], rank: list[Column], scalars: list[str], aggregates: dict[str, Column]) -> DataFrame:
    """One row for each key: the scalars of its row of smallest rank, nulls included, and aggregates over all rows.

    One shuffle and no window: each task hands on one row for a key, so a key that many rows share (such as
    a source's rows without a code) is no more than one row of each task. The rank must be a total order.
    """
    best = F.min_by(F.struct(*scalars), F.struct(*[r.alias(f"r{k}") for k, r in enumerate(rank)])).alias("__best")
    out = df.groupBy(*keys).agg(best, *[a.alias(n) for n, a in aggregates.items()])
    return out.select(*keys, *[F.col("__best")[c].alias(c) for c in scalars], *aggregates)


def string_union(c) -> Column:
    """A group's distinct pipe lists, whole and sorted, joined: what a string aggregate over distinct values gives."""
    every = F.sort_array(F.collect_set(c))
    return F.when(F.size(every) > 0, F.array_join(every, "|"))


def sets_by_key(df: DataFrame, keys: list[str], lists: dict[str, Column]) -> DataFrame:
    """keys and, for each array column given, all of its entries in the group, each once, sorted, nulls left out.

    Entries are taken apart before they are gathered, so each task hands on a key's different entries once,
    however many rows share the key.
    """

    def named(name: str, entries: Column) -> Column:
        return F.transform(F.coalesce(entries, F.array().cast("array<string>")), lambda x: F.struct(F.lit(name).alias("list"), x.alias("entry")))

    entries = F.concat(*[named(n, c) for n, c in lists.items()])
    flat = df.select(*keys, F.inline_outer(entries))
    return flat.groupBy(*keys).agg(*[F.sort_array(F.collect_set(F.when(F.col("list") == n, F.col("entry")))).alias(n) for n in lists])


def entries(df: DataFrame, keys: list[str], lists: dict[str, Column]) -> DataFrame:
    """A row for each key, list and different entry, with the number of times that it stands there.

    What sets_by_key and string_union gather in a row, as a table: no key's entries meet in one place, so a key that
    a third of all rows share is no harder than another. A whole string is the one entry of a list of its own.
    """

    def named(name: str, held: Column) -> Column:
        held = F.filter(F.coalesce(held, F.array().cast("array<string>")), lambda x: x.isNotNull())
        return F.transform(held, lambda x: F.struct(F.lit(name).alias("list"), x.alias("entry")))

    flat = df.select(*keys, F.inline(F.concat(*[named(n, c) for n, c in lists.items()])))
    return flat.groupBy(*keys, "list", "entry").agg(F.count(F.lit(1)).alias("n"))


def tokens(c) -> Column:
    """The entries of a pipe list, trimmed, blanks left out."""
    return F.filter(F.transform(F.split(c, r"\|"), X.trim_ws), lambda x: x != "")


def metadata_variants(df: DataFrame, keys: tuple[str, ...] = ("source_authority", "source_code"), column: str = "metadata_") -> DataFrame:
    """A row for each key and each of its different metadata, with the number of rows that have it: no key's variants meet in one row."""
    return df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys, nulls equal, the left's key columns kept."""
    named = right.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in right.columns])
    on = [left[k].eqNullSafe(named[f"__{k}"]) for k in keys]
    return left.join(named, on, "left").drop(*[f"__{k}" for k in keys])


def dedup_elements(df: DataFrame, mode: str = "strict", tie: list[str] | None = None) -> DataFrame:
    """One element for each source and code; a null code is a code of its own.

    The best row has most of description, unit and lower bound, then the latest date, then the smallest
    of the tie columns (all others, by default). mode "compat" joins alternate names as whole strings and
    lists a group's metadata in one column; else metadata_variants gives them as a table of their own.
    """
    filled = sum((F.col(c).isNotNull().cast("int") for c in ("description", "unit_of_measure", "plausible_min")), F.lit(0))
    keys = ["source_authority", "source_code"]
    scalars = [c for c in SCALARS if c in df.columns]
    rest = tie or [c for c in scalars if c != "source_retrieved_date"]
    newest = F.coalesce(-F.unix_date(F.col("source_retrieved_date").try_cast("date")), F.lit(1 << 30))
    rank = [-filled, newest, *[F.col(c) for c in rest]]
    aggregates = {"source_row_count": F.count(F.lit(1))}
    if mode == "compat":
        aggregates |= {"alternate_names": string_union("alternate_names"), "metadata_variants": F.sort_array(F.collect_list("metadata_"))}
        lists = {"member_of_collections": F.col("member_of_collections")}
    else:
        lists = {"member_of_collections": F.col("member_of_collections"), "__names": tokens("alternate_names")}
    out = same_keys(best_row(df, keys, rank, scalars, aggregates), sets_by_key(df, keys, lists), keys)
    if mode != "compat":
        out = out.withColumn("alternate_names", F.when(F.size("__names") > 0, F.array_join("__names", "|"))).drop("__names")
    first = ["alternate_names", "member_of_collections", "source_row_count"]
    return out.select(*[c for c in out.columns if c not in first], *first)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows; columns that a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_collections(foundation: DataFrame, project: DataFrame) -> DataFrame:
    """foundation's columns in their order, then the project's own, sorted by name; all rows of both."""
    own = sorted(set(project.columns) - set(foundation.columns))
    return union_by_name([foundation, project]).select(*foundation.columns, *own)


def checked_count(df: DataFrame, expected: int) -> DataFrame:
    """df, once its rows have been counted; an error if they are not as many as expected."""
    found = df.count()
    if found != expected:
        raise ValueError(f"{found} rows where {expected} were expected")
    return df


def incremental(existing: DataFrame, incoming: DataFrame, key: str = "content_hash") -> DataFrame:
    """existing rows and those incoming ones whose key is new, once each."""
    fresh = incoming.join(existing.select(key).distinct(), key, "left_anti").dropDuplicates([key])
    return existing.unionByName(fresh.select(*existing.columns))


def append_vectors(existing: DataFrame, incoming: DataFrame, key: str = "accession", vector: str = "embedding") -> DataFrame:
    """existing keyed vectors and incoming ones below them; an error if a key comes twice or a row is lost."""
    both = existing.select(key, vector).unionByName(incoming.select(key, vector))
    rows, keys = both.agg(F.count(F.lit(1)), F.count_distinct(key)).first()
    if rows != keys:
        raise ValueError(f"{rows} vectors for {keys} keys")
    return checked_count(both, existing.count() + incoming.count())
