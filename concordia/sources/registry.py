"""Sources by name. A source is a function (spark, **options) -> elements."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from . import delimited, semistructured
from .fetch import first_match

SOURCES: dict[str, Callable[..., DataFrame]] = {}


def source(name: str):
    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        SOURCES[name] = f
        return f

    return add


@source("lab_codes")
def _lab(spark: SparkSession, path: str, **o) -> DataFrame:
    return delimited.lab_codes(delimited.read_delimited(spark, path), **o)


@source("protocols")
def _protocols(spark: SparkSession, path, **o) -> DataFrame:
    return delimited.protocols(delimited.read_delimited(spark, path), **o)


@source("data_elements")
def _data_elements(spark: SparkSession, path, **o) -> DataFrame:
    return delimited.data_elements(delimited.read_delimited(spark, path, ","), **o)


@source("codelists")
def _codelists(spark: SparkSession, path: str, **o) -> DataFrame:
    return delimited.codelists(delimited.read_delimited(spark, path), file_name=path.rsplit("/", 1)[-1], **o)


@source("project")
def _project(spark: SparkSession, path: str, **o) -> DataFrame:
    return delimited.project_files(spark, path, **o)


@source("concepts")
def _concepts(spark: SparkSession, path: str, **o) -> DataFrame:
    read = lambda n: delimited.read_delimited(spark, f"{path}/{n}.csv")
    return delimited.concepts(spark, read("CONCEPT"), read("VOCABULARY"), read("CONCEPT_SYNONYM"), **o)


@source("yaml")
def _yaml(spark: SparkSession, path: str, **o) -> DataFrame:
    return semistructured.yaml_elements(semistructured.yaml_definitions(spark, path), **o)


@source("json")
def _json(spark: SparkSession, path: str) -> DataFrame:
    return semistructured.json_elements(spark, path)


for _kind in semistructured.ONTOLOGIES:
    SOURCES[_kind] = lambda spark, path, kind=_kind, **o: semistructured.ontology_elements(semistructured.ontology_terms(spark, path), kind, **o)


#: Fixed table: where each source's files are looked for below a folder of downloads, first match first.
FILES = {
    "concepts": ("**/CONCEPT.csv",), "lab_codes": ("**/Loinc.csv", "**/loinc.csv", "**/LoincTable/*.csv"), "hpo": ("**/hp.obo",), "mondo": ("**/mondo.obo",), "duo": ("**/duo.obo",),
    "codelists": ("**/SDTM*Terminology*.txt", "**/*.tsv"), "data_elements": ("**/*CDE*.csv", "**/*.csv"), "protocols": ("**/*.csv", "**/*.txt"), "yaml": ("**/objects", "**/*.yaml"),
}


def find(name: str, folder: str) -> str:
    """The path that a source reads below a folder: the folder of its tables, or its file; an error if there is none."""
    found = first_match(Path(folder), *FILES[name])
    return str(found.parent if name == "concepts" or (name == "yaml" and found.is_file()) else found)


def stage(spark: SparkSession, name: str, out: str, **options) -> int:
    """Write a source's elements to out/<name>.parquet; how many there are.

    Where Parquet can't be written (a type that it lacks), the elements are written as JSON lines instead.
    """
    path = f"{out}/{name}.parquet"
    found = SOURCES[name](spark, **options)
    try:
        found.write.mode("overwrite").parquet(path)
    except AnalysisException:
        path = f"{out}/{name}.jsonl"
        found.write.mode("overwrite").json(path)
        return spark.read.schema(found.schema).json(path).count()
    return spark.read.parquet(path).count()
