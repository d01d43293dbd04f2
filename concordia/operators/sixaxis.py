"""Relationship edges turned into columns, and statistics of how full they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Relationships of each axis, and classes of the concepts that name them.
AXES = {
    "axis_component": ("Has component",), "axis_property": ("Has property",), "axis_time": ("Has time", "Has time aspect"), "axis_system": ("Has system",),
    "axis_scale": ("Has scale", "Has scale type"), "axis_method": ("Has method", "Has method type"),
}
PART_CLASSES = tuple(f"{p}{c}" for p in ("", "LOINC ") for c in ("Component", "Property", "Time", "System", "Scale", "Method"))


def pivot_max(base: DataFrame, edges: DataFrame, names: DataFrame, key: str, columns: dict[str, tuple]) -> DataFrame:
    """base with one column for each group of relationships: the largest name that its edges lead to, or null.

    base: key and others, unique by key; edges: key, relationship, target; names: target, name. Edges are
    summed by key before base is joined, so that a key with many edges moves as one row.
    """
    wanted = [r for rs in columns.values() for r in rs]
    named = edges.filter(F.col("relationship").isin(*wanted)).join(names, "target")
    pivoted = named.groupBy(key).agg(*[F.max(F.when(F.col("relationship").isin(*rs), F.col("name"))).alias(c) for c, rs in columns.items()])
    return base.join(pivoted, key, "left")


def six_axes(concepts: DataFrame, relationships: DataFrame) -> DataFrame:
    """The six axes of every standard or unmarked laboratory concept."""
    lab = concepts.filter("vocabulary_id = 'LOINC'")
    parts = lab.filter(F.col("concept_class_id").isin(*PART_CLASSES)).select(F.col("concept_id").alias("target"), F.col("concept_name").alias("name"))
    base = lab.filter("standard_concept = 'S' or standard_concept is null").select(F.col("concept_id").alias("omop_concept_id"), F.col("concept_code").alias("loinc_code"), F.col("concept_name").alias("loinc_long_name"))
    edges = relationships.filter("invalid_reason is null or invalid_reason = ''").select(F.col("concept_id_1").alias("omop_concept_id"), F.col("relationship_id").alias("relationship"), F.col("concept_id_2").alias("target"))
    return pivot_max(base, edges, parts, "omop_concept_id", AXES)


def six_axes_last(concepts: DataFrame, relationships: DataFrame, ordinal: str) -> DataFrame:
    """The ingest's variant: six relationship names, any target, the last edge by ordinal wins; concepts without axes left out."""
    names = {"Has component": "axis_component", "Has property": "axis_property", "Has time aspect": "axis_time", "Has system": "axis_system", "Has scale type": "axis_scale", "Has method type": "axis_method"}
    lab = concepts.filter("vocabulary_id = 'LOINC'").select("concept_id", "concept_name")
    edges = relationships.filter(F.col("relationship_id").isin(*names) & (F.coalesce("invalid_reason", F.lit("")) == ""))
    named = edges.join(lab.select(F.col("concept_id").alias("concept_id_2"), "concept_name"), "concept_id_2").join(lab.select(F.col("concept_id").alias("concept_id_1")), "concept_id_1", "left_semi")
    last = lambda r: F.max_by("concept_name", F.when(F.col("relationship_id") == r, F.struct(F.col(ordinal).isNotNull(), ordinal)))  # noqa: E731  an edge without an ordinal is before all others
    return named.groupBy(F.col("concept_id_1").alias("omop_concept_id")).agg(*[last(r).alias(c) for r, c in names.items()])


def population(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: rows, and for each column how many of them have a value."""
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count(c).alias(f"n_{c}") for c in columns])
