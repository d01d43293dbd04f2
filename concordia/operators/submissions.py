"""Contract validation of many submissions at once, by equi-joins.

A rule is put down under the signals that can fire it: a flag, a field, a field's value, or none at all. A
submission gives the signals that it has, and rules meet it by equal signals; what they ask for and it lacks is
an anti-join. No submission is an array in a row, and none meets rules that can't fire. Signals are salted, as
some (that of unconditional rules, or a flag that most set) are those of a third of all rows and more.

Tables: anchors (item, priority, metadata_), submissions (submission_id, flags: map of flag to boolean), fields
(submission_id, item, value).

Defined results: submissions of one id are one, with any flag that one of them sets; fields without a name, and
those of unknown submissions, take no part; a field that stands several times has all its values; values compare
without case, null ones with none; anchors of one name are one finding for each of their rules that asks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.priority import CONTEXT, CONTEXT_RULES, FIELD_FLAGS, FIELD_PRESENT, FIELD_VALUE, REQUIRED, parse_priority
from ..session import by_merge
from .validation import ERROR, WARNING

#: Ways that a signal's rows are dealt.
SALTS = 16
#: Rows of the tables for each task that joins or counts them, about: memory of a task doesn't grow with the input.
TASK_ROWS = 1 << 18
ALWAYS = "always"
ANCESTRY = "AncestryGenetic"
BASELINE, TIMES = "VisitBaselineDate", ("VisitDate", "VisitNumber", "YearsFromEnrollment")
FOUND = ("submission_id", "severity", "code", "message", "item", "field")


def _tasks(submissions: DataFrame, fields: DataFrame) -> int:
    return max(SALTS, -(-(submissions.count() + fields.count()) // TASK_ROWS))


def _signal(kind: str, *parts: Column) -> Column:
    return F.concat_ws(chr(31), F.lit(kind), *parts)


def _flag(name: str) -> Column:
    return _signal("flag", F.lit(name))


def rule_signals(rule: Column) -> Column:
    """The signals any of which fires a parsed rule; none for rules that never ask."""
    name, context = F.coalesce(rule["field_name"], F.lit("")), F.lower(F.coalesce(rule["context"], F.lit("")))
    stands_for = F.when(F.contains(name, F.lit("genetic-ancestry")), _signal("begins", F.lit(ANCESTRY)))
    for word, flag in FIELD_FLAGS:
        stands_for = stands_for.when(F.contains(name, F.lit(word)), _flag(flag))
    by_context = F.when(F.lit(False), F.lit(""))
    for words, without, flag in CONTEXT_RULES:
        fits = F.contains(context, F.lit(words[0]))
        for w in without:
            fits = fits & ~F.contains(context, F.lit(w))
        by_context = by_context.when(fits, _flag(flag))
    value = _signal("value", name, F.lower(F.coalesce(rule["field_value"], F.lit(""))))
    kind = rule["kind"]
    fired = (
        F.when(kind == REQUIRED, F.array(F.lit(ALWAYS))).when(kind == FIELD_VALUE, F.array(value))
        .when(kind == FIELD_PRESENT, F.array(_signal("field", name), stands_for)).when(kind == CONTEXT, F.array(by_context))
    )
    return F.filter(F.coalesce(fired, F.array().cast("array<string>")), lambda s: s.isNotNull())


def _flags(submissions: DataFrame, tasks: int) -> DataFrame:
    """(submission_id, flag): the flags that are set."""
    on = submissions.select("submission_id", F.explode("flags").alias("flag", "on")).filter("on").select("submission_id", "flag")
    return on.repartition(tasks, "submission_id").distinct()


def _own(fields: DataFrame, submissions: DataFrame, tasks: int) -> DataFrame:
    named = fields.filter(F.col("item").isNotNull()).select("submission_id", "item", "value").repartition(tasks, "submission_id")
    return named.join(by_merge(submissions.select("submission_id").repartition(tasks, "submission_id")), "submission_id", "left_semi")


def signals(submissions: DataFrame, fields: DataFrame, tasks: int) -> DataFrame:
    """(submission_id, signal) of all submissions; repeats stay."""
    ids = submissions.select("submission_id").filter("submission_id is not null")
    by_field = F.array(
        _signal("field", F.col("item")), F.when(F.col("value").isNotNull(), _signal("value", F.col("item"), F.lower("value"))),
        F.when(F.startswith("item", F.lit(ANCESTRY)), _signal("begins", F.lit(ANCESTRY))),
    )
    given = _own(fields, submissions, tasks).select("submission_id", F.explode(F.array_compact(by_field)).alias("signal"))
    flags = _flags(submissions, tasks).filter("submission_id is not null").select("submission_id", _signal("flag", F.col("flag")).alias("signal"))
    return ids.select("submission_id", F.lit(ALWAYS).alias("signal")).union(flags).union(given)


def missing_anchors(anchors: DataFrame, submissions: DataFrame, fields: DataFrame, tasks: int | None = None) -> DataFrame:
    """Anchors that rules ask of a submission and that it lacks."""
    tasks = tasks or _tasks(submissions, fields)
    rule = parse_priority("priority")
    rules = anchors.filter(F.col("item").isNotNull()).select("item", rule.alias("rule")).select("item", "rule.kind", "rule.raw", F.explode(rule_signals(F.col("rule"))).alias("signal"))
    dealt = rules.distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    asking = signals(submissions, fields, tasks).withColumn("salt", F.pmod(F.xxhash64("submission_id"), F.lit(SALTS)).cast("int"))
    fired = asking.join(dealt, ["signal", "salt"]).select("submission_id", "item", "kind", "raw").repartition(tasks, "submission_id", "item").distinct()
    held = _own(fields, submissions, tasks).select("submission_id", "item").repartition(tasks, "submission_id", "item")
    lacking = fired.join(by_merge(held), ["submission_id", "item"], "left_anti")
    message = F.concat(F.lit("required by the rule "), F.col("kind"), F.lit(": "), F.col("raw"))
    return _found(lacking, ERROR, "ANCHOR_MISSING", message, F.lit(None).cast("string"))


def missing_companions(anchors: DataFrame, submissions: DataFrame, fields: DataFrame, tasks: int | None = None) -> DataFrame:
    """Companions that a submission's own anchors name in their metadata and that it lacks."""
    tasks = tasks or _tasks(submissions, fields)
    listed = F.from_json(F.get_json_object("metadata_", "$.companion_fields"), "array<string>")
    named = anchors.select("item", F.explode(listed).alias("field")).filter("item is not null and field is not null").distinct()
    dealt = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = _own(fields, submissions, tasks).select("submission_id", "item").repartition(tasks, "submission_id", "item").distinct()
    salted = own.withColumn("salt", F.pmod(F.xxhash64("submission_id"), F.lit(SALTS)).cast("int"))
    asked = salted.join(dealt, ["item", "salt"]).select("submission_id", "item", "field").repartition(tasks, "submission_id", "field")
    lacking = asked.join(by_merge(own.withColumnRenamed("item", "field")), ["submission_id", "field"], "left_anti")
    return _found(lacking, WARNING, "MISSING_COMPANION_FIELD", F.lit("its companion isn't there"), F.col("field"))


def time_findings(submissions: DataFrame, fields: DataFrame, tasks: int | None = None) -> DataFrame:
    """Longitudinal submissions without a baseline, or with one and no times."""
    tasks = tasks or _tasks(submissions, fields)
    asked = _flags(submissions, tasks).filter("flag = 'is_longitudinal' AND submission_id IS NOT NULL").select("submission_id")
    has = fields.filter(F.col("item").isin(BASELINE, *TIMES)).repartition(tasks, "submission_id").groupBy("submission_id").agg(F.max(F.col("item") == BASELINE).alias("baseline"), F.max(F.col("item") != BASELINE).alias("times"))
    seen = asked.join(by_merge(has), "submission_id", "left").withColumn("item", F.lit(None).cast("string"))
    none = seen.filter(~F.coalesce("baseline", F.lit(False)))
    bare = seen.filter(F.col("baseline") & ~F.coalesce("times", F.lit(False)))
    first = _found(none, ERROR, "NO_TIME_BASELINE", F.lit("times can't be converted without a baseline"), F.lit(BASELINE))
    return first.union(_found(bare, ERROR, "NO_TIME_REPRESENTATION", F.lit("a baseline, but no times"), F.lit(None).cast("string")))


def _found(df: DataFrame, severity: str, code: str, message: Column, field: Column) -> DataFrame:
    return df.select("submission_id", F.lit(severity).alias("severity"), F.lit(code).alias("code"), message.alias("message"), "item", field.alias("field"))


def findings(anchors: DataFrame, submissions: DataFrame, fields: DataFrame) -> DataFrame:
    """All findings of all submissions: FOUND."""
    tasks = _tasks(submissions, fields)
    found = missing_anchors(anchors, submissions, fields, tasks).union(missing_companions(anchors, submissions, fields, tasks))
    return found.union(time_findings(submissions, fields, tasks))
