"""The engine's expressions as SQL functions, and its tables as views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import code_index
from ..schema import DEFAULTS, ELEMENT

#: Name, parameters, and body of each SQL function.
FUNCTIONS = {
    "compose_search_text": (
        "description STRING, authority STRING, code STRING, collection STRING, collections ARRAY<STRING>, metadata STRING",
        "concat_ws(' | ', description, concat(authority, ' ', coalesce(code, '')), collection, array_join(collections, ' '), metadata)",
    ),
    "trim_ws": ("c STRING", r"regexp_replace(c, '^\\s+|\\s+$', '')"),
    "filled": ("c STRING", r"nullif(regexp_replace(c, '^\\s+|\\s+$', ''), '')"),
    "tag_text": ("tag BIGINT", "format_string('(%04X,%04X)', shiftright(tag, 16) & 65535, tag & 65535)"),
    "has_code": ("codes ARRAY<STRUCT<vocabulary: STRING, code: STRING>>, vocabulary STRING, wanted STRING", "exists(codes, x -> x.vocabulary = vocabulary AND (wanted IS NULL OR x.code = wanted))"),
    "match_verdict": ("score DOUBLE", "CASE WHEN score >= 0.92 THEN 'auto-bind' WHEN score >= 0.80 THEN 'review' WHEN score >= 0.65 THEN 'review-caution' ELSE 'novel' END"),
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions for the session; their names."""
    kinds = {"match_verdict": "STRING", "has_code": "BOOLEAN"}
    for name, (parameters, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kinds.get(name, 'STRING')} RETURN {body}")
    return list(FUNCTIONS)


def create_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Create the target tables, empty, where they aren't yet: elements by the element schema, and the edges between them; their names.

    Parquet tables have no indexes: elements are bucketed by the columns that others would index, so that
    lookups and joins on them read one bucket.
    """
    place = f"{database}." if database else ""
    element = spark.createDataFrame([], ELEMENT)
    columns = ", ".join(f"`{n}` {t}" for n, t in element.dtypes)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {place}element_store ({columns}) USING parquet CLUSTERED BY (source_authority, source_code) INTO 64 BUCKETS")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {place}edge_store (src_authority STRING, src_code STRING, target_vocab STRING, target_code STRING, evidence STRING) USING parquet CLUSTERED BY (target_vocab, target_code) INTO 64 BUCKETS")
    return [f"{place}element_store", f"{place}edge_store"]


def migrate(spark: SparkSession, table: str, *, index: str | None = None, key: str = "accession") -> list[str]:
    """Give an existing table the element's columns that it lacks; their names. Its rows and other columns stay as they are.

    Added columns have the element's defaults, also in the rows that are there, and are null without one; no file is
    written again. A column of the same name in any letter case stays if its type is the element's and is refused
    otherwise, before anything is changed. A second run adds nothing. index: where to write the index of the
    table's codes, by key.
    """
    have = {f.name.lower(): f.dataType for f in spark.table(table).schema}
    other = [f"{f.name} {have[f.name.lower()].simpleString()}" for f in ELEMENT if f.name.lower() in have and not _fits(have[f.name.lower()], f.dataType)]
    if other:
        raise ValueError(f"columns of other types than the element's: {', '.join(other)}")
    added = [f for f in ELEMENT if f.name.lower() not in have]
    if added:
        default = lambda n: f" DEFAULT {str(v).lower() if isinstance(v, bool) else repr(v)}" if (v := DEFAULTS.get(n)) is not None else ""
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}{default(f.name)}' for f in added)})")
    if index is not None:
        code_index.write(spark.table(table), index, key)
    return [f.name for f in added]


def _fits(have: T.DataType, want: T.DataType) -> bool:
    """Whether a column can be the element's: the same type, or a narrower or wider whole or floating number."""
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType)
    return have.simpleString() == want.simpleString() or any(isinstance(have, k) and isinstance(want, k) for k in kinds)


def create_views(elements: DataFrame, crosswalk: DataFrame | None = None) -> list[str]:
    """Views over the element table: all elements, active ones, and active ones with a crosswalk's columns."""
    elements.createOrReplaceTempView("elements")
    active = elements.filter("is_active")
    active.createOrReplaceTempView("active_elements")
    if crosswalk is None:
        return ["elements", "active_elements"]
    active.join(crosswalk, "canonical_concept_id", "left").createOrReplaceTempView("enriched_elements")
    return ["elements", "active_elements", "enriched_elements"]
