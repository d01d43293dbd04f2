"""Priority rules: parsing them, and resolving them against a submission."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, trim_ws

#: Kinds of rules.
REQUIRED, OPTIONAL, DERIVABLE, FIELD_VALUE, FIELD_PRESENT, CONTEXT, RECOMMENDED, UNKNOWN = (
    "required", "optional", "required-or-derivable", "required-when-field-value", "required-when-field-present", "required-for-context", "recommended", "unknown",
)
# Fixed patterns of the rules' grammar, in the order they are tried.
PRESENT_PATTERN, VALUE_PATTERN = r"^Required-when-(.+)-present$", r"^Required-when-([A-Z][A-Za-z0-9]*)-(.+)$"
RECOMMENDED_PATTERN, CONTEXT_PATTERN = r"^Recommended-(?:for|when)-(.+)$", r"^Required-(?:for|when)-(.+)$"


def parse_priority(c) -> Column:
    """struct<kind, raw, field_name, field_value, context> of a priority string."""
    raw, none = trim_ws(F.coalesce(col(c), F.lit(""))), F.lit(None).cast("string")
    lower = F.lower(raw)

    def rule(kind: str, name: Column = none, value: Column = none, context: Column = none) -> Column:
        return F.struct(F.lit(kind).alias("kind"), raw.alias("raw"), name.alias("field_name"), value.alias("field_value"), context.alias("context"))

    part = lambda pattern, k: F.regexp_extract(raw, pattern, k)
    return (
        F.when(raw == "", rule(UNKNOWN)).when(lower == "required", rule(REQUIRED)).when(lower == "optional", rule(OPTIONAL)).when(lower == "required-or-derivable", rule(DERIVABLE))
        .when(raw.rlike(PRESENT_PATTERN), rule(FIELD_PRESENT, part(PRESENT_PATTERN, 1)))
        .when(raw.rlike(VALUE_PATTERN), rule(FIELD_VALUE, part(VALUE_PATTERN, 1), part(VALUE_PATTERN, 2)))
        .when(raw.rlike(RECOMMENDED_PATTERN), rule(RECOMMENDED, context=part(RECOMMENDED_PATTERN, 1)))
        .when(raw.rlike(CONTEXT_PATTERN), rule(CONTEXT, context=part(CONTEXT_PATTERN, 1)))
        .otherwise(rule(UNKNOWN))
    )


#: Flags of a submission.
FLAGS = (
    "is_longitudinal", "is_genetic_cohort", "is_cross_cohort", "has_biosamples", "has_tissue_biosamples", "has_cell_isolate_biosamples", "has_non_human_biosamples", "has_omics_data",
    "has_genomic_data", "has_paired_organ_tissues", "requires_sharing_ready", "has_data_assets", "has_indexable_data_assets", "has_genomic_data_assets", "has_pedigree", "has_mz_twins",
    "has_dz_twins", "has_summary_stats", "has_meta_analysis", "has_case_control", "has_variant_level_summary_stats", "has_pca_loadings", "has_projected_loadings", "has_component_loadings",
)
# Fixed table, in order: words of a context (all of the first, none of the second), and the flag that decides.
CONTEXT_RULES = (
    (("longitudinal",), (), "is_longitudinal"), (("genetic-cohort",), (), "is_genetic_cohort"), (("genetic",), ("data-asset",), "is_genetic_cohort"),
    (("tissue-biosample",), (), "has_tissue_biosamples"), (("cell-isolate",), (), "has_cell_isolate_biosamples"), (("paired-organ",), (), "has_paired_organ_tissues"),
    (("non-human",), (), "has_non_human_biosamples"), (("omics-data",), (), "has_omics_data"), (("genomic",), ("data-asset", "summary-stats"), "has_genomic_data"),
    (("data-asset-indexable",), (), "has_indexable_data_assets"), (("data-asset-genomic",), (), "has_genomic_data_assets"), (("data-asset",), (), "has_data_assets"),
    (("cross-cohort",), (), "is_cross_cohort"), (("sharing-ready",), (), "requires_sharing_ready"), (("re-share",), (), "requires_sharing_ready"), (("redistribute",), (), "requires_sharing_ready"),
    (("pedigree",), (), "has_pedigree"), (("mz-twin",), (), "has_mz_twins"), (("monozygotic",), (), "has_mz_twins"), (("dz-twin",), (), "has_dz_twins"), (("dizygotic",), (), "has_dz_twins"),
    (("meta-analysis",), (), "has_meta_analysis"), (("case-control",), (), "has_case_control"), (("variant-level",), (), "has_variant_level_summary_stats"),
    (("summary-stats",), (), "has_summary_stats"), (("pca-loadings",), (), "has_pca_loadings"), (("projected-loadings",), (), "has_projected_loadings"), (("component-loadings",), (), "has_component_loadings"),
)
# Fixed table: words of a field's name that stand for a flag.
FIELD_FLAGS = (("data-asset", "has_data_assets"), ("pedigree", "has_pedigree"), ("summary-stats", "has_summary_stats"), ("summary_stats", "has_summary_stats"))


def is_required(rule, populated, values, flags) -> Column:
    """Whether a parsed rule asks for its anchor.

    populated: array of the submission's fields; values: map of field to value; flags: map of flag to boolean.
    """
    rule, populated, values, flags = col(rule), col(populated), col(values), col(flags)
    on = lambda name: F.coalesce(F.try_element_at(flags, F.lit(name)), F.lit(False))
    has = lambda text, word: F.contains(text, F.lit(word))
    name = F.coalesce(rule["field_name"], F.lit(""))
    given = F.lower(F.try_element_at(values, name))
    by_value = F.coalesce(given == F.lower(F.coalesce(rule["field_value"], F.lit(""))), F.lit(False))
    by_field = F.when(F.array_contains(populated, name), True).when(has(name, "genetic-ancestry"), F.exists(populated, lambda f: F.startswith(f, F.lit("AncestryGenetic"))))
    for word, flag in FIELD_FLAGS:
        by_field = by_field.when(has(name, word), on(flag))
    context, by_context = F.lower(F.coalesce(rule["context"], F.lit(""))), None
    for words, without, flag in CONTEXT_RULES:
        fits = has(context, words[0])
        for w in without:
            fits = fits & ~has(context, w)
        by_context = F.when(fits, on(flag)) if by_context is None else by_context.when(fits, on(flag))
    kind = rule["kind"]
    return (
        F.when(kind == REQUIRED, True).when(kind == FIELD_VALUE, by_value).when(kind == FIELD_PRESENT, F.coalesce(by_field, F.lit(False)))
        .when(kind == CONTEXT, F.coalesce(by_context, F.lit(False))).otherwise(False)
    )
