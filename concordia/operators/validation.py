"""Contract validation: findings as rows (severity, code, message, item, field)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.priority import FLAGS, is_required, parse_priority
from ..schema import construction_checks
from ..session import checkpointed

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"
FINDING = "severity string, code string, message string, item string, field string"


def _finding(failed: Column, severity: str, code: str, message, field: str | None) -> Column:
    text = message if isinstance(message, Column) else F.lit(message)
    return F.when(failed, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), text.alias("message"), F.col("item").alias("item"), F.lit(field).cast("string").alias("field")))


def _inline(df: DataFrame, findings: list[Column]) -> DataFrame:
    return df.select(F.inline(F.filter(F.array(*findings), lambda x: x.isNotNull())))


def element_findings(elements: DataFrame) -> DataFrame:
    """Findings of single elements, in one pass."""
    c = F.col
    blank = lambda n: F.coalesce(c(n), F.lit("")) == ""
    numeric = c("item_type").eqNullSafe(F.lit("numeric"))
    bounds = c("plausible_min").isNotNull() | c("plausible_max").isNotNull()
    loose = (F.contains("values", F.lit(";")) | F.contains("values", F.lit(", "))) & ~F.contains("values", F.lit("|"))
    off = lambda x: F.coalesce(x, F.lit(False))
    return _inline(elements, [
        _finding(c("embedding").isNotNull() & blank("search_text"), WARNING, "EMBEDDING_WITHOUT_SEARCH_TEXT", "an embedding without the text that it was made from", "search_text"),
        _finding(c("replaced_by_id").isNotNull() & off(c("is_active")), ERROR, "ACTIVE_BUT_REPLACED", "replaced, yet active", "is_active"),
        _finding(numeric & bounds & blank("unit_of_measure"), ERROR, "NUMERIC_BOUNDS_WITHOUT_UNIT", "bounds of a number need its unit", "unit_of_measure"),
        _finding(c("numeric_precision").isNotNull() & ~numeric, WARNING, "NUMERIC_PRECISION_ON_NON_NUMERIC", "a precision, but not a number", "numeric_precision"),
        _finding(~c("cardinality").eqNullSafe(F.lit("single")) & off(loose), INFO, "CARDINALITY_DELIMITER_CONVENTION", "several values, not parted by |", "values"),
    ])


def construction_findings(elements: DataFrame, **options) -> DataFrame:
    return _inline(elements, [_finding(failed, ERROR, code, F.concat(F.lit(f"{field}: "), F.coalesce(F.col(field).cast("string"), F.lit("null"))), field) for code, field, failed in construction_checks(**options)])


def submission(spark: SparkSession, populated: list[str], values: dict[str, str] | None = None, **flags: bool) -> DataFrame:
    """One row that describes a submission: its fields, their values, and its flags."""
    unknown = sorted(set(flags) - set(FLAGS))
    if unknown:
        raise ValueError(f"not flags: {', '.join(unknown)}")
    row = (list(populated), dict(values or {}), {f: bool(flags.get(f)) for f in FLAGS})
    return spark.createDataFrame([row], "populated array<string>, values map<string,string>, flags map<string,boolean>")


def submission_of(elements: DataFrame, **flags: bool) -> DataFrame:
    """A submission from its elements: values are their permitted values."""
    one = elements.agg(F.collect_set("item").alias("populated"), F.map_from_entries(F.collect_set(F.struct("item", F.coalesce("values", F.lit(""))))).alias("values"))
    return one.withColumn("flags", F.create_map(*[F.lit(x) for f in FLAGS for x in (f, bool(flags.get(f)))]))


def missing_anchors(anchors: DataFrame, context: DataFrame) -> DataFrame:
    """Anchors that their rules ask for and the submission lacks. The context is one row."""
    ruled = anchors.select("item", parse_priority("priority").alias("rule")).join(F.broadcast(context))
    needed = ruled.filter(is_required("rule", "populated", "values", "flags") & ~F.array_contains("populated", F.col("item")))
    message = F.concat(F.lit("required by the rule "), F.col("rule.kind"), F.lit(": "), F.col("rule.raw"))
    return needed.select(F.lit(ERROR).alias("severity"), F.lit("ANCHOR_MISSING").alias("code"), message.alias("message"), "item", F.lit(None).cast("string").alias("field"))


def missing_companions(anchors: DataFrame, context: DataFrame) -> DataFrame:
    """Companions that populated anchors name in their metadata and the submission lacks."""
    named = anchors.select("item", F.explode(F.from_json(F.get_json_object("metadata_", "$.companion_fields"), "array<string>")).alias("field")).join(F.broadcast(context))
    lacking = named.filter(F.array_contains("populated", F.col("item")) & ~F.array_contains("populated", F.col("field")))
    return lacking.select(F.lit(WARNING).alias("severity"), F.lit("MISSING_COMPANION_FIELD").alias("code"), F.lit("its companion isn't there").alias("message"), "item", "field")


def time_findings(context: DataFrame) -> DataFrame:
    """Whether a longitudinal submission's times can be derived from one another. Fixed field names."""
    has = lambda f: F.array_contains("populated", f)
    some = has("VisitDate") | has("VisitNumber") | has("YearsFromEnrollment")
    on = F.coalesce(F.col("flags")["is_longitudinal"], F.lit(False))
    row = context.withColumn("item", F.lit(None).cast("string"))
    return _inline(row, [
        _finding(on & ~has("VisitBaselineDate"), ERROR, "NO_TIME_BASELINE", "times can't be converted without a baseline", "VisitBaselineDate"),
        _finding(on & has("VisitBaselineDate") & ~some, ERROR, "NO_TIME_REPRESENTATION", "a baseline, but no times", None),
    ])


def lineage_note(context: DataFrame) -> DataFrame:
    """The note that a submission with samples gets while no lineage table is given."""
    on = F.coalesce(F.col("flags")["has_biosamples"], F.lit(False))
    return _inline(context.withColumn("item", F.lit(None).cast("string")), [_finding(on, INFO, "LINEAGE_CHECK_DEFERRED", "sample lineage wasn't checked", None)])


def lineage_findings(samples: DataFrame) -> DataFrame:
    """Samples (sample_id, parent_id, subject_id; ids unique) whose ancestors are missing, go in circles, or are of another subject.

    A sample's finding is the first bad step on its way up: a parent that isn't there, or that is of another
    subject (an unknown subject is no other). Every round a sample takes over what the sample it points to has
    found, or points to where that one points, so reaches double: after as many rounds as the number of
    samples has binary digits, whatever is still open goes in a circle.
    """
    own = samples.filter("sample_id is not null").select("sample_id", "parent_id", "subject_id")
    parents = own.select(F.col("sample_id").alias("parent_id"), F.col("subject_id").alias("owner"), F.lit(True).alias("there"))
    step = own.join(parents, "parent_id", "left")
    bad = F.when(F.col("parent_id").isNotNull() & F.col("there").isNull(), "PARENT_MISSING").when(F.col("owner") != F.col("subject_id"), "SUBJECT_MISMATCH")
    ends = F.col("parent_id").isNull() | bad.isNotNull()
    state = checkpointed(step.select("sample_id", bad.alias("code"), F.when(bad.isNotNull(), F.col("parent_id")).alias("at"), F.when(~ends, F.col("parent_id")).alias("next")))
    for _ in range(state.count().bit_length() + 1):
        open_ = state.filter("next is not null")
        if open_.isEmpty():
            break
        above = state.select(F.col("sample_id").alias("next"), F.col("code").alias("__code"), F.col("at").alias("__at"), F.col("next").alias("__next"))
        moved = open_.select("sample_id", "next").join(above, "next").select("sample_id", F.col("__code").alias("code"), F.col("__at").alias("at"), F.col("__next").alias("next"))
        state = checkpointed(state.filter("next is null").unionByName(moved))
    circle = state.filter("next is not null").select("sample_id", F.lit("LINEAGE_CIRCLE").alias("code"), F.col("next").alias("at"))
    every = state.filter("code is not null").select("sample_id", "code", "at").unionByName(circle)
    return every.select(F.lit(ERROR).alias("severity"), "code", F.concat(F.lit("at "), F.col("at").cast("string")).alias("message"), F.col("sample_id").cast("string").alias("item"), F.lit("parent_id").alias("field"))


def validate(elements: DataFrame, anchors: DataFrame, context: DataFrame) -> DataFrame:
    """All findings of a submission."""
    return reduce(DataFrame.unionByName, [element_findings(elements), missing_anchors(anchors, context), missing_companions(anchors, context), time_findings(context), lineage_note(context)])


def summary(findings: DataFrame) -> DataFrame:
    """One row: findings of each severity, and whether there is no error."""
    count = lambda s: F.count_if(F.col("severity") == s)
    return findings.agg(count(ERROR).alias("errors"), count(WARNING).alias("warnings"), count(INFO).alias("infos"), (count(ERROR) == 0).alias("ok"))
