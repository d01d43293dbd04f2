"""The element table: its columns, vocabularies of values, and construction checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.text import normalize_collections, normalize_names

# Fixed values of the enumerated columns.
AUTHORITIES = ("LOINC", "HPO", "OMIM", "Mondo", "OMOP", "NACC", "NINDS-CDE", "PhenX", "CDISC", "DUO", "DICOM", "BIDS", "project-derived")
CURATION_STATUSES = ("auto-matched", "HitL-confirmed", "expert-curated", "deprecated", "under-review")
ITEM_TYPES = ("numeric", "string", "date", "enum", "binary")
CARDINALITIES = ("single", "multiple", "unbounded")
UNIT_VOCABULARIES = ("UCUM", "SNOMED-units", "free-text")

_STRINGS, _DOUBLE = T.ArrayType(T.StringType()), T.DoubleType()
CODE = T.StructType([T.StructField("vocabulary", T.StringType()), T.StructField("code", T.StringType())])
ELEMENT = T.StructType([
    T.StructField(name, kind, name not in ("item", "description", "source_authority", "source_version", "source_retrieved_date"))
    for name, kind in {
        "id": T.StringType(), "accession": T.StringType(), "content_hash": T.StringType(), "schema_id": T.StringType(), "item": T.StringType(), "description": T.StringType(),
        "collection": T.StringType(), "item_type": T.StringType(), "values": T.StringType(), "value_set_ref": T.StringType(), "alternate_names": T.StringType(), "priority": T.StringType(),
        "sort_order": T.IntegerType(), "is_active": T.BooleanType(), "metadata_": T.StringType(), "unit_of_measure": T.StringType(), "unit_vocabulary": T.StringType(),
        "plausible_min": _DOUBLE, "plausible_max": _DOUBLE, "numeric_precision": T.IntegerType(), "cardinality": T.StringType(), "missing_value_convention": T.StringType(),
        "source_authority": T.StringType(), "source_code": T.StringType(), "source_version": T.StringType(), "source_url": T.StringType(), "source_retrieved_date": T.StringType(),
        "member_of_collections": _STRINGS, "canonical_concept_id": T.LongType(), "equivalent_ids": _STRINGS, "alternate_codes": T.ArrayType(CODE), "curation_status": T.StringType(),
        "curator": T.StringType(), "curation_date": T.StringType(), "match_confidence": _DOUBLE, "replaced_by_id": T.StringType(), "search_text": T.StringType(),
        "embedding": T.ArrayType(T.FloatType()), "created_at": T.StringType(), "updated_at": T.StringType(),
    }.items()
])
#: Values of columns that a row lacks.
DEFAULTS = {"is_active": True, "cardinality": "single", "curation_status": "auto-matched"}
_LENGTHS = {"item": 255, "collection": 255, "source_code": 255, "curator": 255, "priority": 50, "source_version": 50, "unit_of_measure": 64, "missing_value_convention": 64}
_PATTERNS = {"accession": r"^[A-Za-z]+:\d{7}$", "content_hash": r"^[a-f0-9]{64}$", "value_set_ref": r"^[a-f0-9-]+@\d+$"}
_ENUMS = {"item_type": ITEM_TYPES, "cardinality": CARDINALITIES, "unit_vocabulary": UNIT_VOCABULARIES}


def to_elements(df: DataFrame) -> DataFrame:
    """df's columns as elements: missing columns with their defaults, text trimmed, lists normalised.

    Columns that an element doesn't have are refused.
    """
    names = {f.name for f in ELEMENT}
    unknown = sorted(set(df.columns) - names)
    if unknown:
        raise ValueError(f"not columns of an element: {', '.join(unknown)}")
    out = []
    for f in ELEMENT:
        default = F.lit(DEFAULTS.get(f.name)).cast(f.dataType)
        if isinstance(f.dataType, T.ArrayType) and f.name != "embedding":
            default = F.array().cast(f.dataType)
        c = F.coalesce(F.col(f.name).cast(f.dataType), default) if f.name in df.columns else default
        if f.dataType == T.StringType() and f.name in df.columns and f.name != "metadata_":
            c = F.regexp_replace(c, r"^\s+|\s+$", "")
        if f.name == "alternate_names":
            c = normalize_names(c)
        if f.name == "member_of_collections":
            c = normalize_collections(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def construction_checks(extra_authorities: tuple[str, ...] = (), extra_statuses: tuple[str, ...] = ()) -> list[tuple[str, str, Column]]:
    """(code, field, failed) of every check that an element must pass to be one."""
    c, checks = F.col, []
    for name in ("item", "description", "source_authority", "source_version", "source_retrieved_date"):
        checks.append(("REQUIRED", name, c(name).isNull()))
    checks.append(("EMPTY", "description", F.length("description") == 0))
    checks += [("TOO_LONG", n, F.length(n) > k) for n, k in _LENGTHS.items()]
    checks += [("PATTERN", n, ~c(n).rlike(p)) for n, p in _PATTERNS.items()]
    enums = _ENUMS | {"source_authority": (*AUTHORITIES, *extra_authorities), "curation_status": (*CURATION_STATUSES, *extra_statuses)}
    checks += [("ENUM", n, ~c(n).isin(*v)) for n, v in enums.items()]
    checks.append(("RANGE", "numeric_precision", ~c("numeric_precision").between(0, 20)))
    checks.append(("RANGE", "match_confidence", ~c("match_confidence").between(0.0, 1.0)))
    checks.append(("INVERTED_BOUNDS", "plausible_min", c("plausible_min") > c("plausible_max")))
    return [(code, field, F.coalesce(failed, F.lit(False))) for code, field, failed in checks]
