"""What grows with the input stays out of the driver and out of single tasks."""

import numpy as np
from pyspark.sql import functions as F

from concordia.llm import simhash
from concordia.operators import edges, graph, routing, submissions


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_broadcast_of_fingerprints(spark, monkeypatch):
    """Tables of fingerprints and documents meet by merges, however small their files are."""
    docs = spark.createDataFrame([(k, " ".join(f"w{k % 40 + j}" for j in range(30)) + " end" * (k % 3)) for k in range(160)], "doc_id long, text string")
    plans, plain = [], simhash.staged

    def watched(df, name, **options):
        plans.append(plan_of(df))
        return plain(df, name, **options)

    monkeypatch.setattr(simhash, "staged", watched)
    plans += [plan_of(simhash.one_of_each(docs, crowd=1)), plan_of(simhash.links(docs.select(F.col("doc_id").alias("fp")), crowd=1))]
    assert len(plans) > 6 and any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_no_broadcast_of_labels(spark):
    plans = []

    def watched(df):
        plans.append(plan_of(df))
        return df.localCheckpoint()

    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + F.when(F.col("id") % 100 == 99, 0).otherwise(1)).alias("b"))
    got = {r["node"]: r["component"] for r in graph.components(edges, watched).collect()}
    assert got == {k: k // 100 * 100 for k in range(300)}
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_near_pairs_moved_by_blocks(spark, monkeypatch):
    """Blocks of a few rows, cells larger than a block: all pairs, each once; vectors meet in one step that isn't run twice."""
    monkeypatch.setattr(routing, "LEAST_SIDE", 8)
    monkeypatch.setattr(routing, "NEAR_BYTES", 8 * 8 * 6, raising=False)
    rng = np.random.default_rng(5)
    v = np.concatenate([np.ones(6) + rng.normal(size=(60, 6)) * 0.2, rng.normal(size=(60, 6))])
    table = spark.createDataFrame([(k, x.tolist(), k % 3) for k, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    m = v / np.linalg.norm(v, axis=1, keepdims=True)
    for least in (0.2, 0.9):
        want = {(a, b) for a, b in zip(*np.nonzero(np.triu(m @ m.T >= least, 1)), strict=True)}
        got = [(r["a"], r["b"]) for r in routing.near_pairs(routing.classes(table), least, pivots=5).collect()]
        assert len(got) == len(want) and set(got) == want
    plans, plain = [], getattr(routing, "written", None)
    monkeypatch.setattr(routing, "written", lambda df, name: plans.append(plan_of(df)) or plain(df, name), raising=False)
    last = plan_of(routing.link_counts(table, 0.9))
    plans = "".join([last, *plans])
    assert plans.count("CoGroups") == 0 and plans.count("FlatMapGroupsInArrow") == 1


def test_pairs_of_classes_are_not_rows(spark, monkeypatch):
    """Ids of several cuts, negative ones and repeats: each pair once, and no shuffle of pairs."""
    monkeypatch.setattr(edges, "LIST_BITS", 4, raising=False)
    rng = np.random.default_rng(2)
    rows = [(int(k), int(i)) for k, i in zip(rng.integers(0, 12, 500), rng.integers(-50, 90, 500) * 3, strict=True)]
    by = {}
    for k, i in rows:
        by.setdefault(k, set()).add(i)
    want = {(min(a, b), max(a, b)) for own in by.values() for a in own if a % 4 == 0 for b in own if a != b}
    asked = spark.createDataFrame([(i,) for i in range(-200, 300, 4)] * 2, "id long")
    found = edges.pairs_of(spark.createDataFrame(rows + [(1, None)], "k long, id long"), ["k"], asked)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(want) and set(got) == want
    assert "Aggregate" not in plan_of(found).split("MapInArrow")[0]


def test_tasks_of_submissions_are_bounded(spark, monkeypatch):
    """Joins and counts of submissions get tasks by rows, and none of their tables is broadcast."""
    monkeypatch.setattr(submissions, "TASK_ROWS", 50, raising=False)
    table = spark.range(1000).select(F.col("id").alias("submission_id"), F.create_map(F.lit("is_longitudinal"), F.col("id") % 2 == 0).alias("flags"))
    fields = spark.range(2000).select((F.col("id") % 1000).alias("submission_id"), F.concat(F.lit("F"), (F.col("id") % 7).cast("string")).alias("item"), F.lit("x").alias("value"))
    anchors = spark.createDataFrame([("F1", "Required", None)], "item string, priority string, metadata_ string")
    plan = plan_of(submissions.findings(anchors, table, fields))
    assert ", 60), REPARTITION_BY_NUM" in plan
    assert "LeftSemi, BuildRight" not in plan and "LeftAnti, BuildRight" not in plan


def test_tasks_of_claims_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(edges, "TASK_ROWS", 50, raising=False)
    members = spark.range(3000).select(F.lit("O").alias("target_vocab"), (F.col("id") % 700).alias("target_code"), (F.col("id") % 90).alias("id"))
    elements = spark.range(90).select("id", (F.col("id") % 5).alias("canonical_concept_id"))
    curated = spark.range(90).select(F.col("id").alias("id_a"), (F.col("id") + 7).alias("id_b"))
    plan = plan_of(edges.equivalence_claims(members, elements, curated))
    assert ", 60), REPARTITION_BY_NUM" in plan and "Broadcast" not in plan
