"""The build: staged sources to one table of elements with alternate codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, edges
from ..sources.semistructured import staged_rows


def write_edges(found: DataFrame, path: str) -> int:
    """Write edges and give their number, counted as they are written; without any there is no table."""
    seen = Observation()
    found.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", "snappy").parquet(path)
    n = seen.get["n"]
    if not n:
        where = found.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(found.sparkSession._jsc.sc().hadoopConfiguration()).delete(where, True)
    return n


def build(spark: SparkSession, staging: str, out: str, *, concepts: DataFrame | None = None, relationships: DataFrame | None = None, project: DataFrame | None = None, mode: str = "strict") -> DataFrame:
    """Write out/edges, out/resolved, out/metadata_variants and out/elements; the elements.

    Sources of the staging folder are united by column name and deduplicated; references in their metadata
    become edges and are resolved; concept relationships, where given, become alternate codes.
    """
    sources = staged_rows(spark, staging)
    elements = dedup.dedup_elements(sources, mode)
    dedup.metadata_variants(sources).write.mode("overwrite").parquet(f"{out}/metadata_variants")
    if write_edges(edges.harvest_edges(sources), f"{out}/edges"):
        found = edges.resolve_edges(spark.read.parquet(f"{out}/edges"), elements, mode)
        found.write.mode("overwrite").parquet(f"{out}/resolved")
    if concepts is not None and relationships is not None:
        codes = edges.alternate_codes(edges.maps_to_edges(relationships, concepts, mode))
    else:
        codes = spark.createDataFrame([], "target_concept_id long, alternate_codes array<struct<vocabulary:string,code:string>>")
    elements = edges.attach_alternate_codes(elements, codes)
    if project is not None:
        elements = dedup.merge_collections(elements, project)
    elements.write.mode("overwrite").parquet(f"{out}/elements")
    return spark.read.parquet(f"{out}/elements")
