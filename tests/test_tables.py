"""Migration of tables, entries and classes as rows, searches in several blocks, digests of bundles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordia import bundle
from concordia.functions import sql_functions
from concordia.operators import code_index, dedup, edges, reports, routing, sixaxis, vectors


def test_migrate(spark, tmp_path):
    """Old rows get defaults, a second run adds nothing, a column of another type is refused and nothing changed."""
    codes = F.array(F.struct(F.lit("V").alias("vocabulary"), F.col("id").cast("string").alias("code")))
    old = spark.range(5).select(F.concat(F.lit("a"), "id").alias("Accession"), codes.alias("alternate_codes"), F.col("id").alias("own"), F.col("id").alias("sort_order"))
    old.write.option("path", str(tmp_path / "t")).saveAsTable("migrated")
    try:
        added = sql_functions.migrate(spark, "migrated", index=str(tmp_path / "index"))
        assert "cardinality" in added and "accession" not in added and "alternate_codes" not in added
        got = spark.table("migrated").orderBy("own").collect()
        assert [(r["own"], r["cardinality"], r["is_active"], r["description"]) for r in got] == [(k, "single", True, None) for k in range(5)]
        assert [r["key"] for r in code_index.lookup(spark, str(tmp_path / "index"), "V", "3").collect()] == ["a3"]
        assert sql_functions.migrate(spark, "migrated") == []
    finally:
        spark.sql("DROP TABLE migrated")
    spark.range(2).select(F.col("id").alias("is_active")).write.option("path", str(tmp_path / "u")).saveAsTable("unfit")
    try:
        with pytest.raises(ValueError, match="is_active bigint"):
            sql_functions.migrate(spark, "unfit")
        assert spark.table("unfit").columns == ["is_active"]
    finally:
        spark.sql("DROP TABLE unfit")


def test_entries(spark):
    """Null lists and entries have no row; a hot key's entries are rows with counts."""
    df = spark.createDataFrame([(None, "p|q", ["x"])] * 40 + [(None, " q", None), ("1", None, [None, "y", "y"]), ("2", None, None)], "k string, names string, c array<string>")
    got = {tuple(r) for r in dedup.entries(df, ["k"], {"n": dedup.tokens("names"), "c": F.col("c")}).collect()}
    assert got == {(None, "n", "p", 40), (None, "n", "q", 41), (None, "c", "x", 40), ("1", "c", "y", 2)}


def test_name_classes(spark):
    df = spark.createDataFrame([(1, "Body  Weight", "a"), (2, "body-weight", "b"), (2, "BODY WEIGHT", "b"), (3, "height", "a"), (4, "Height", "a"), (5, None, "b"), (None, "body weight", "c")], "id long, text string, source string")
    got = {tuple(r) for r in edges.name_classes(df, "id", "text", "source").collect()}
    assert got == {("body weight", 1, 1, 2, 2), ("body weight", 2, 1, 2, 2)}


def test_search_in_blocks(spark, monkeypatch):
    """Many blocks of queries and rows, and tags that mustn't meet, against a plain search."""
    monkeypatch.setattr(routing, "SIDE_BYTES", 1)
    monkeypatch.setattr(routing, "LEAST_SIDE", 7)
    rng = np.random.default_rng(3)
    m, tags = rng.integers(-3, 4, (60, 4)).astype(float), [None if k % 5 == 0 else k % 3 for k in range(60)]
    df = spark.createDataFrame([(k, m[k].tolist(), tags[k]) for k in range(60)], "vec_id long, embedding array<double>, label int")
    for group in (None, "label"):
        got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in vectors.exact_search(df, df.filter("vec_id % 2 = 0"), 4, group=group).collect()}
        want = set()
        for q in range(0, 60, 2):
            near = sorted((c for c in range(60) if group is None or tags[c] != tags[q]), key=lambda c, q=q: (-(m[q] @ m[c]), c))[:4]
            want |= {(q, k + 1, c, float(m[q] @ m[c])) for k, c in enumerate(near)}
        assert got == want
    assert vectors.exact_search(df.limit(0), df).count() == 0 and vectors.exact_search(df, df.limit(0)).count() == 0


def test_random_pairs(spark):
    """No row of two or more is its own random pair."""
    unit = lambda k: [1.0 if j == k else 0.0 for j in range(6)]
    for n, random in ((6, 0.0), (2, 0.0), (1, None)):
        pairs = spark.createDataFrame([(k, unit(k), unit(k)) for k in range(n)], "row_id long, a array<double>, b array<double>")
        got = vectors.cosine_gap(pairs).first()
        assert (got["true_pairs"], got["random_pairs"]) == (1.0, random)


def test_firsts(spark):
    """Null keys are a key of their own; the edge of the greatest ordinal counts."""
    claims = spark.createDataFrame([(None, 4), (None, 2), ("x", 3), ("x", 3), ("x", None)], "key string, accession long")
    assert sorted((r["key"] or "", r["accession"] or 0, r["replaced_by"], r["is_active"]) for r in reports.curation_winners(claims, ["key"]).collect()) == [("", 2, None, True), ("", 4, 2, False), ("x", 0, None, True), ("x", 3, None, True), ("x", 3, None, True)]
    visits = spark.createDataFrame([(None, "2020-01-01"), (None, "2021-01-01"), (1, "2020-06-01")], "s long, day string")
    assert sorted(round(r["years_from_baseline"] * 365.25) for r in reports.years_from_baseline(visits, ["s"], "day").collect()) == [0, 0, 366]
    concepts = spark.createDataFrame([(1, "LOINC", "lab"), (2, "LOINC", "old"), (3, "LOINC", "new")], "concept_id long, vocabulary_id string, concept_name string")
    links = spark.createDataFrame([(1, 2, "Has system", None, 1), (1, 3, "Has system", None, 2), (1, 2, "Has property", None, None)], "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string, at long")
    (row,) = sixaxis.six_axes_last(concepts, links, "at").collect()
    assert (row["axis_system"], row["axis_property"], row["axis_method"]) == ("new", "old", None)


def test_tree_alone(spark, tmp_path):
    """A bundle without the flat digest; the tree tells of a changed element."""
    from concordia.schema import to_elements

    rows = [("a", "d", "OMOP", "1", "2024-01-01"), ("b", "d", "OMOP", "1", "2024-01-01")]
    made = lambda r: to_elements(spark.createDataFrame(r, "item string, description string, source_authority string, source_version string, source_retrieved_date string"))
    manifests = [bundle.write_bundle(made(r), str(tmp_path / str(k)), "1", flat_hash=False, index=False) for k, r in enumerate((rows, rows[::-1], [rows[0], ("b", "e", *rows[1][2:])]))]
    assert "rollup_hash" not in manifests[0] and manifests[0]["rollup_tree"] == manifests[1]["rollup_tree"] != manifests[2]["rollup_tree"]
