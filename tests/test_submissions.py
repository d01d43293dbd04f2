"""Many submissions by joins, against the rules' own expression over each pair of submission and anchor."""

import random

from pyspark.sql import functions as F

from concordia.functions.priority import is_required, parse_priority
from concordia.operators import submissions, validation

RULES = [
    "Required", "required", "Optional", "Required-or-derivable", "Required-when-A-present", "Required-when-genetic-ancestry-present", "Required-when-data-asset-x-present", "Required-when-pedigree-present",
    "Required-when-B-Yes", "Required-when-B-no", "Required-for-longitudinal", "Required-when-genomic-data-asset", "Required-for-genetic", "Recommended-for-x", "Required-for-unheard-of", "", None, "Required-for-tissue-biosample",
]
FLAGS = ["is_longitudinal", "is_genetic_cohort", "has_data_assets", "has_pedigree", "has_tissue_biosamples", "has_genomic_data", "has_genomic_data_assets"]
ITEMS = ["A", "B", "C", "AncestryGeneticPC1", "VisitBaselineDate", "VisitDate", "VisitNumber", "I0", "I3", "I7", "I9"]


def test_equal_to_each_alone(spark):
    rng = random.Random(9)
    anchors = spark.createDataFrame([(f"I{k}", r, '{"companion_fields": ["A", "I%d"]}' % (k + 1) if k % 2 else None) for k, r in enumerate(RULES)] + [(None, "Required", None)], "item string, priority string, metadata_ string")
    subs, fields = [], []
    for s in range(120):
        subs.append((s, {f: rng.random() < 0.5 for f in rng.sample(FLAGS, rng.randrange(len(FLAGS)))}))
        fields += [(s, i, rng.choice(["yes", "NO", None])) for i in rng.sample(ITEMS, rng.randrange(len(ITEMS)))]
    held = spark.createDataFrame(fields + [(0, None, "x"), (999, "A", "x"), (None, "A", "x")], "submission_id long, item string, value string")
    table = spark.createDataFrame(subs, "submission_id long, flags map<string,boolean>")
    got = submissions.findings(anchors, table, held)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    got = sorted((r["submission_id"], r["code"], r["item"], r["field"], r["message"]) for r in got.fillna("").collect())
    alone = [(s, [i for t, i, _ in fields if t == s], {i: v for t, i, v in fields if t == s and v is not None}, flags) for s, flags in subs]
    context = spark.createDataFrame(alone, "submission_id long, populated array<string>, values map<string,string>, flags map<string,boolean>")
    ruled = anchors.filter("item is not null").select("item", parse_priority("priority").alias("rule"))
    asked = context.crossJoin(ruled).filter(is_required("rule", "populated", "values", "flags") & ~F.array_contains("populated", F.col("item")))
    want = [(r["submission_id"], "ANCHOR_MISSING", r["item"], "", f"required by the rule {r['rule']['kind']}: {r['rule']['raw']}") for r in asked.collect()]
    named = {f"I{k}": ["A", f"I{k + 1}"] for k in range(len(RULES)) if k % 2}
    for s, populated, _, flags in alone:
        want += [(s, "MISSING_COMPANION_FIELD", i, f, "its companion isn't there") for i in populated for f in named.get(i, []) if f not in populated]
        if flags.get("is_longitudinal"):
            if "VisitBaselineDate" not in populated:
                want.append((s, "NO_TIME_BASELINE", "", "VisitBaselineDate", "times can't be converted without a baseline"))
            elif not {"VisitDate", "VisitNumber", "YearsFromEnrollment"} & set(populated):
                want.append((s, "NO_TIME_REPRESENTATION", "", "", "a baseline, but no times"))
    assert got == sorted(want) and len({w[1] for w in want}) == 4
    assert {r["code"] for r in validation.time_findings(context).collect()} == {"NO_TIME_BASELINE", "NO_TIME_REPRESENTATION"}
    assert submissions.findings(anchors.limit(0), table.limit(0), held).collect() == []
