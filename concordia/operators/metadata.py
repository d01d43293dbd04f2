"""Metadata of a key's variants merged into one object, path by path.

Variants are taken apart into leaves (path, value) level by level, each leaf's rows are summed before they are
shuffled, and every path keeps one value. What meets in one row is the merged object alone, however many
variants a key has.

The rule: a path keeps the value that most rows have, and of equal ones the smallest text. Where some variants
have a value and others an object, the object stays. Arrays are values. Objects without entries stay where
nothing else stands.

Defined results: null metadata and what is no JSON object counts for nothing; of an entry that stands twice in
an object one counts; keys whose metadata all count for nothing have no row; null keys are a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

_IS_OBJECT = "startswith(schema_of_variant(value), 'OBJECT')"


def leaves(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, path, value, n): the leaves of all metadata, with the number of rows that have each; value is JSON text."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    level = counted.select(*keys, F.array().cast("array<string>").alias("path"), F.expr(f"try_parse_json(`{column}`)").alias("value"), "n").filter(f"value IS NOT NULL AND {_IS_OBJECT}")
    found = None
    while True:
        # A level's objects are opened; its other values, and objects without entries, are leaves.
        opened = level.lateralJoin(df.sparkSession.tvf.variant_explode_outer(F.col("value").outer()).select(F.col("key").alias("name"), F.col("value").alias("inner")))
        inner = F.coalesce("inner", F.expr("parse_json('{}')"))
        step = opened.select(*keys, F.when(F.col("name").isNull(), F.col("path")).otherwise(F.concat("path", F.array("name"))).alias("path"), inner.alias("value"), "n", F.col("name").isNull().alias("bare"))
        kept = written(step.select(*keys, "path", F.to_json("value").alias("text"), F.expr(_IS_OBJECT).alias("object"), "bare", "n"), "paths")
        done = kept.filter("bare OR NOT object").select(*keys, "path", F.col("text").alias("value"), "n")
        found = done if found is None else found.union(done)
        deeper = kept.filter("NOT bare AND object")
        if deeper.isEmpty():
            return found.groupBy(*keys, "path", "value").agg(F.sum("n").alias("n"))
        level = deeper.select(*keys, "path", F.parse_json("text").alias("value"), "n")


def merged_paths(df: DataFrame, keys: list[str], column: str = "metadata_") -> DataFrame:
    """(keys, path, value): the merged object's leaves."""
    all_leaves = written(leaves(df, keys, column), "leaves")
    best = all_leaves.groupBy(*keys, "path").agg(F.min(F.struct((-F.col("n")).alias("less"), "value")).alias("best"))
    within = all_leaves.filter(F.size("path") > 0).select(*[F.col(k).alias(f"__{k}") for k in keys], F.explode(F.transform(F.sequence(F.lit(0), F.size("path") - 1), lambda n: F.slice("path", F.lit(1), n))).alias("__path")).distinct()
    same = F.col("path") == F.col("__path")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return best.join(within, same, "left_anti").select(*keys, "path", F.col("best.value").alias("value"))


def merged(df: DataFrame, keys: list[str], column: str = "metadata_") -> DataFrame:
    """(keys, column): one object for each key, entries in order of their names; JSON text."""
    paths = written(merged_paths(df, keys, column), "merged")
    depth = paths.agg(F.max(F.size("path"))).first()[0]
    quoted = F.to_json(F.array(F.element_at("path", -1)))
    level = None
    for d in range(depth or 0, 0, -1):
        own = paths.filter(F.size("path") == d)
        level = own if level is None else own.union(level)
        # The entries of one object of the result meet in a row.
        entry = F.struct(F.element_at("path", -1).alias("name"), F.concat(F.substr(quoted, F.lit(2), F.length(quoted) - 2), F.lit(":"), F.col("value")).alias("text"))
        level = level.withColumn("__entry", entry).groupBy(*keys, F.slice("path", 1, d - 1).alias("path")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("__entry")), lambda x: x["text"]), ",").alias("all"))
        level = level.select(*keys, "path", F.concat(F.lit("{"), "all", F.lit("}")).alias("value"))
    top = paths.filter(F.size("path") == 0)
    out = top if level is None else top.union(level)
    return out.select(*keys, F.col("value").alias(column))
