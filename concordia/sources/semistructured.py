"""Ontologies, YAML trees, tag dictionaries, JSON elements and anchors, staged folders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.numbers import tag_text
from ..schema import ELEMENT, to_elements
from .obo import LISTED, SINGLE, file_system, read_stanzas


def ontology_terms(spark: SparkSession, path: str) -> DataFrame:
    """One row for each term: single keys (the last value wins) and listed ones as arrays, comments cut off.

    Read by the data source; from a store that only Spark can open, by expressions over what lies between lines
    that begin with "[".
    """
    try:
        file_system(path)
    except (OSError, pa.ArrowInvalid):
        return parse_stanzas(spark.read.option("lineSep", "\n[").text(path))
    return read_stanzas(spark, path, kinds="Term").select(*SINGLE, *LISTED)


def parse_stanzas(chunks: DataFrame) -> DataFrame:
    """Terms of chunks (value), each the text from behind one "[" at a line's beginning to the next."""
    lines = F.transform(F.split(F.replace(F.col("value"), F.lit("\r"), F.lit("")), "\n"), X.trim_ws)
    terms = chunks.select(lines.alias("lines")).filter(F.col("lines")[0].isin("Term]", "[Term]"))
    blank = F.array_position("lines", "")
    body = F.slice("lines", F.lit(2), F.when(blank > 0, blank - 2).otherwise(F.size("lines") - 1).cast("int"))
    pairs = F.transform(
        F.filter(body, lambda x: F.contains(x, F.lit(": "))),
        lambda x: F.struct(F.split_part(x, F.lit(": "), F.lit(1)).alias("key"), X.trim_ws(F.regexp_replace(F.substr(x, F.instr(x, ": ") + 2), r"\s*!\s*.*$", "")).alias("value")),
    )
    terms = terms.select(pairs.alias("pairs"))
    of = lambda key: F.transform(F.filter("pairs", lambda p: p["key"] == key), lambda p: p["value"])
    return terms.select(*[F.try_element_at(of(k), F.lit(-1)).alias(k) for k in SINGLE], *[of(k).alias(k) for k in LISTED])


# Fixed table: an ontology's id prefix, authority, metadata key of references, and collection.
ONTOLOGIES = {
    "hpo": ("HP:", "HPO", "hpo_xrefs", "https://hpo.jax.org/browse/term/", None), "mondo": ("MONDO:", "Mondo", "mondo_xrefs", "https://monarchinitiative.org/", None),
    "duo": ("DUO:", "DUO", None, "http://purl.obolibrary.org/obo/", "Core-Governance"),
}


def ontology_elements(terms: DataFrame, kind: str, *, version: str, retrieved: dt.date | None = None) -> DataFrame:
    """Elements of an ontology's terms of its own prefix that aren't obsolete and have a name."""
    prefix, authority, key, url, collection = ONTOLOGIES[kind]
    synonyms = F.filter(F.transform("synonym", X.quoted), lambda x: x.isNotNull())
    xrefs = F.filter(F.transform("xref", X.ontology_xref), lambda x: x.isNotNull())
    own = terms.filter(F.startswith("id", F.lit(prefix)) & (F.coalesce("is_obsolete", F.lit("")) != "true") & (F.coalesce("name", F.lit("")) != ""))
    meta = F.when(F.size(xrefs) > 0, F.to_json(F.struct(xrefs.alias(key or "xrefs")))) if key else F.lit(None).cast("string")
    return to_elements(own.select(
        X.left("name", 255).alias("item"), F.coalesce(X.ontology_definition("def"), "name").alias("description"), F.lit("enum").alias("item_type"), F.lit(collection).cast("string").alias("collection"),
        F.lit(authority).alias("source_authority"), F.col("id").alias("source_code"), F.lit(version).alias("source_version"), F.concat(F.lit(url), F.col("id")).alias("source_url"),
        F.lit((retrieved or dt.date.today()).isoformat()).alias("source_retrieved_date"), X.normalize_names(F.array_join(synonyms, "|")).alias("alternate_names"), meta.alias("metadata_"),
    ))


YAML_ROW = "category string, key string, display_name string, description string, type string, format string, value string"


def yaml_definitions(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each top-level mapping of YAML files; a file that can't be read gives none. YAML has no parser in Spark."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    data = yaml.safe_load(bytes(content).decode("utf-8", "replace"))
                except yaml.YAMLError:
                    continue
                for key, d in (data.items() if isinstance(data, dict) else ()):
                    if isinstance(d, dict):
                        rows.append([path.rstrip("/").split("/")[-2], str(key), *[None if d.get(f) is None else str(d[f]) for f in ("display_name", "description", "type", "format", "value")]])
            yield pd.DataFrame(rows, columns=["category", "key", "display_name", "description", "type", "format", "value"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{yaml,yml}").load(folder)
    return files.select("path", "content").mapInPandas(parse, YAML_ROW)


# Fixed table: item types of a definition's types.
YAML_TYPES = {"number": "numeric", "integer": "numeric", "float": "numeric", "boolean": "enum", "string": "string", "array": "string", "object": "string"}


def yaml_elements(definitions: DataFrame, *, version: str, retrieved: dt.date | None = None) -> DataFrame:
    display = X.first_filled("display_name", "key")
    meta = F.to_json(F.struct(F.col("category").alias("bids_category"), F.col("type").alias("bids_type"), F.col("format").alias("bids_format"), F.col("value").alias("bids_value")))
    return to_elements(definitions.select(
        X.left("key", 255).alias("item"), X.first_filled("description", display).alias("description"), X.mapped(F.lower(F.coalesce("type", F.lit(""))), YAML_TYPES).alias("item_type"),
        F.lit("BIDS").alias("source_authority"), F.concat_ws(":", F.lit("BIDS"), "category", "key").alias("source_code"), F.lit(version).alias("source_version"),
        F.lit((retrieved or dt.date.today()).isoformat()).alias("source_retrieved_date"), F.lit("Core-Imaging").alias("collection"), meta.alias("metadata_"),
    ))


# Fixed table: item types of value representations.
VR_TYPES = {
    "AE": "string", "AS": "string", "AT": "string", "CS": "enum", "DA": "date", "DS": "numeric", "DT": "date", "FL": "numeric", "FD": "numeric", "IS": "numeric", "LO": "string", "LT": "string",
    "OB": "binary", "OD": "binary", "OF": "binary", "OL": "binary", "OV": "binary", "OW": "binary", "PN": "string", "SH": "string", "SL": "numeric", "SQ": "string", "SS": "numeric", "ST": "string",
    "SV": "numeric", "TM": "string", "UC": "string", "UI": "string", "UL": "numeric", "UN": "binary", "UR": "string", "US": "numeric", "UT": "string", "UV": "numeric",
}
TAG_ROW = "tag long, vr string, vm string, name string, retired string, keyword string"


def tag_elements(tags: DataFrame, *, version: str, retrieved: dt.date | None = None) -> DataFrame:
    """Elements of an imaging tag dictionary (TAG_ROW), retired tags left out."""
    vr = F.upper(F.split_part("vr", F.lit(" or "), F.lit(1)))
    several = F.coalesce(F.endswith("vm", F.lit("n")) | F.contains("vm", F.lit("-")), F.lit(False))
    return to_elements(tags.filter(F.coalesce("retired", F.lit("")) == "").select(
        X.left(X.first_filled("keyword", "name"), 255).alias("item"), F.col("name").alias("description"), X.mapped(vr, VR_TYPES).alias("item_type"), F.when(several, "multiple").otherwise("single").alias("cardinality"),
        F.lit("DICOM").alias("source_authority"), tag_text("tag").alias("source_code"), F.lit(version).alias("source_version"), F.lit((retrieved or dt.date.today()).isoformat()).alias("source_retrieved_date"),
        F.lit("Core-Imaging").alias("collection"), F.to_json(F.struct(vr.alias("dicom_vr"), F.col("vm").alias("dicom_vm"), F.col("keyword").alias("dicom_keyword"))).alias("metadata_"),
    ))


def tag_dictionary(spark: SparkSession) -> DataFrame:
    """The dictionary of the imaging library, where it is installed."""
    from pydicom._dicom_dict import DicomDictionary

    return spark.createDataFrame([(int(t), *map(str, v)) for t, v in DicomDictionary.items()], TAG_ROW)


ANCHOR = T.StructType([
    *[T.StructField(n, T.StringType()) for n in (
        "item", "description", "collection", "item_type", "values", "alternate_names", "priority", "source_authority", "source_code", "source_version", "source_url", "curation_status", "unit_of_measure",
        "unit_vocabulary", "cardinality", "missing_value_convention", "metadata_",
    )], T.StructField("plausible_min", T.DoubleType()), T.StructField("plausible_max", T.DoubleType()), T.StructField("numeric_precision", T.IntegerType()), T.StructField("member_of_collections", T.ArrayType(T.StringType())),
])


def anchors(spark: SparkSession, folder: str) -> DataFrame:
    """Anchor definitions of a folder of JSON arrays, with their file's stem as theme and place, their order in it; unknown keys are left out.

    An item that two definitions share is an error.
    """
    df = spark.read.schema(ANCHOR).option("multiLine", True).option("mode", "FAILFAST").json(f"{folder}/*.json")
    # A file is one partition, so a theme's rows are numbered in its order.
    df = df.select("*", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("theme"), F.monotonically_increasing_id().alias("place"))
    twice = df.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy("item").limit(5).collect()
    if twice:
        raise ValueError(f"defined more than once: {', '.join(str(r['item']) for r in twice)}")
    return df


def by_theme(anchors: DataFrame) -> DataFrame:
    """(theme, items): a theme's anchors in their file's order."""
    return anchors.groupBy("theme").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "item"))), lambda x: x["item"]).alias("items"))


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """Elements of a JSON array of objects; the first row that doesn't fit ends the read."""
    return to_elements(spark.read.schema(ELEMENT).option("multiLine", True).option("mode", "FAILFAST").json(path))


def staged_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Staged sources by name: a Parquet table hides lines of the same stem; malformed lines are skipped."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(folder)
    names = sorted(s.getPath().getName() for s in where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where))
    tables = [n for n in names if n.endswith(".parquet")]
    lines = [n for n in names if n.endswith(".jsonl") and n.removesuffix(".jsonl") + ".parquet" not in tables]
    frames = [spark.read.parquet(f"{folder}/{n}") for n in tables]
    frames += [spark.read.schema(ELEMENT).option("mode", "DROPMALFORMED").json(f"{folder}/{n}") for n in lines]
    if not frames:
        return spark.createDataFrame([], ELEMENT)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def matrix_rows(spark: SparkSession, vectors, keys, key: str = "vec_id") -> DataFrame:
    """A matrix's rows as a keyed table, by Arrow: no row becomes a Python object."""
    m, k = np.asarray(vectors, np.float32), np.asarray(keys, np.int64)
    if m.ndim != 2 or len(m) != len(k):
        raise ValueError(f"{m.shape} vectors for {len(k)} keys")
    column = pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(m).reshape(-1)), max(1, m.shape[1])).cast(pa.list_(pa.float32()))
    return spark.createDataFrame(pa.table({key: pa.array(k), "embedding": column}))
