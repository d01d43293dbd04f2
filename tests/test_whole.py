"""Queries that must do the whole of their job: recall of the indexes, all rows, all patterns."""

import numpy as np

from concordia.operators import vectors
from concordia.plans.catalog import QUERIES
from concordia.schema import to_elements


def pairs(df, key="vec_id"):
    return {(r["query_id"], r[key]) for r in df.collect()}


def test_ivf_recall(spark, sf):
    """The registered index query finds 0.9 of the exact 10 nearest of every stated query."""
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    exact = pairs(vectors.exact_search(e, e.filter("vec_id % 20 = 0"), 10))
    found = pairs(QUERIES["ivf_topk"](spark, sf))
    assert {q for q, _ in found} == {q for q, _ in exact}
    assert len(exact & found) / len(exact) >= 0.9


def test_bundle_recall(spark, sf, tmp_path):
    """So does the index that a bundle ships, with the probes that are stored in it."""
    from pyspark.sql import functions as F

    from concordia import bundle

    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    made = e.select(
        F.col("vec_id").cast("string").alias("accession"), F.col("embedding").cast("array<float>").alias("embedding"), F.lit("i").alias("item"), F.lit("d").alias("description"),
        F.lit("OMOP").alias("source_authority"), F.lit("1").alias("source_version"), F.lit("2024-01-01").alias("source_retrieved_date"),
    )
    bundle.write_bundle(to_elements(made), str(tmp_path / "b"), "1")
    q = e.filter("vec_id % 20 = 0")
    index = vectors.CellIndex.read(spark, str(tmp_path / "b" / "index"))
    exact = pairs(vectors.exact_search(e, q, 10))
    found = {(int(a), int(b)) for a, b in pairs(index.search(q.withColumnRenamed("vec_id", "accession"), 10, key="accession"), "accession")}
    assert len(exact & found) / len(exact) >= 0.9


def test_stated_queries(spark, sf):
    """Every row divisible by 20 is asked; self-recall is counted here, not by a constant."""
    asked = {r[0] for r in spark.read.parquet(f"{sf}/embeddings.parquet").filter("vec_id % 20 = 0").select("vec_id").collect()}
    for name in ("cosine_topk", "cross_label_knn", "cosine_triage"):
        assert {r["query_id"] for r in QUERIES[name](spark, sf).collect()} == asked
    e = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    m = {r["vec_id"]: np.array(r["embedding"], float) for r in e}
    want = np.mean([max(m, key=lambda k, q=q: (m[q] @ m[k], -k)) == q for q in asked])
    assert QUERIES["self_recall"](spark, sf).first()["recall_1"] == want


def test_whole_edges(spark, sf):
    """All rows of lineitem, against plain loops."""
    edges = {(r[0], r[1]) for r in spark.read.parquet(f"{sf}/lineitem.parquet").select("l_partkey", "l_suppkey").collect()}
    by = {}
    for p, s in edges:
        by.setdefault(s, set()).add(p)
    got = {(r["target_code"], r["id"], r["representative"], r["links"]) for r in QUERIES["coreference_classes"](spark, sf).collect()}
    assert got == {(s, p, min(ps), len(ps) - 1) for s, ps in by.items() for p in ps}
    want = {(min(a, b), max(a, b)) for ps in by.values() for a in ps if a % 20 == 0 for b in ps if a != b}
    assert {tuple(r) for r in QUERIES["coreference_search"](spark, sf).select("id_a", "id_b").collect()} == want
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for p, s in edges:
        a, b = sorted((top(p), top(s + 10000000)))
        up[b] = a
    assert {r["node"]: r["component"] for r in QUERIES["connected_components"](spark, sf).collect()} == {x: top(x) for x in up}


def test_long_lineage(spark):
    """A mismatch more than 64 generations up is found."""
    from concordia.operators import validation

    samples = spark.createDataFrame([(k, k - 1 if k else None, 1 if k else 9) for k in range(70)], "sample_id long, parent_id long, subject_id long")
    found = validation.lineage_findings(samples).collect()
    assert {(r["code"], r["item"]) for r in found} == {("SUBJECT_MISMATCH", str(k)) for k in range(1, 70)}


def test_all_patterns(spark, tmp_path):
    """A document for each of the nine patterns, and one without any."""
    texts = {
        "private_key": "-----BEGIN RSA PRIVATE KEY-----", "aws_key": "AKIA" + "A1" * 8, "github_token": "ghp_" + "aB3" * 12, "password": "Password: hunter22", "api_key": "api-key = 123456789", "secret": "SECRET=abcdefgh",
        "bearer": "Bearer " + "a.b-" * 6, "connection": "postgres://u:p@host", "email": "a@b.org",
    }
    rows = [(k, f"some words\n{t} end") for k, t in enumerate(texts.values())] + [(9, "some words")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["doc_id"], r["pattern"], r["line"], r["snippet"][:5]) for r in QUERIES["security_scan"](spark, str(tmp_path)).collect()}
    assert got == {(k, name, 2, t[:5]) for k, (name, t) in enumerate(texts.items())}


def test_lines_of_hits(spark):
    """Line ends inside a match count for what follows it."""
    from concordia.operators import reports

    files = spark.createDataFrame([("a.txt", "x\npassword:\nhunter22 a\npassword=hunter33\n\napi_key\n=\n12345678 b@c.de")], "path string, text string")
    got = {(r["pattern"], r["line"], r["snippet"]) for r in reports.screen_content(files, "path", "text").collect()}
    assert got == {("password", 2, "password:\nhunter22"), ("password", 4, "password=hunter33"), ("api_key", 6, "api_key\n=\n12345678"), ("email", 8, "b@c.de")}


def test_lineage_ends(spark):
    """A chain of 200 with a missing root, a long circle with a tail, and unknown subjects."""
    from concordia.operators import validation

    chain = [(k, k - 1, 1) for k in range(1, 201)]
    circle = [(1000 + k, 1000 + (k + 1) % 130, 1) for k in range(130)] + [(2000 + k, 2001 + k if k < 9 else 1000, 1) for k in range(10)]
    subjects = [(3000, None, 2), (3001, 3000, None), (3002, 3001, 1)]
    samples = spark.createDataFrame(chain + circle + subjects, "sample_id long, parent_id long, subject_id long")
    found = {(r["code"], int(r["item"]), r["message"]) for r in validation.lineage_findings(samples).collect()}
    assert {f for f in found if f[0] == "PARENT_MISSING"} == {("PARENT_MISSING", k, "at 0") for k in range(1, 201)}
    assert {f[1] for f in found if f[0] == "LINEAGE_CIRCLE"} == {k for k, _, _ in circle} and len(found) == 340
    assert validation.lineage_findings(samples.limit(0)).count() == 0


def test_sets_and_variants(spark):
    """A hot key's entries are gathered each once, and its metadata is a table."""
    from pyspark.sql import functions as F

    from concordia.operators import dedup

    df = spark.createDataFrame([("a", None, "p|q", ["x"], "m1")] * 50 + [("a", None, " q |r", None, "m2"), ("a", "1", None, [None, "y"], None)], "source_authority string, source_code string, names string, c array<string>, metadata_ string")
    got = {r["source_code"]: (r["n"], r["c"]) for r in dedup.sets_by_key(df, ["source_authority", "source_code"], {"n": dedup.tokens("names"), "c": F.col("c")}).collect()}
    assert got == {None: (["p", "q", "r"], ["x"]), "1": ([], ["y"])}
    assert {(r["source_code"], r["metadata_"], r["n"]) for r in dedup.metadata_variants(df).collect()} == {(None, "m1", 50), (None, "m2", 1)}


def test_append_and_gap(spark):
    import pytest

    from concordia.operators import dedup

    v = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(9)], "vec_id long, embedding array<double>")
    assert dedup.append_vectors(v.filter("vec_id < 5"), v.filter("vec_id >= 5"), "vec_id").count() == 9
    with pytest.raises(ValueError, match="10 vectors for 9 keys"):
        dedup.append_vectors(v, v.limit(1), "vec_id")
    rng = np.random.default_rng(0)
    m = rng.standard_normal((400, 8))
    pairs = spark.createDataFrame([(k, x.tolist(), (2 * x).tolist()) for k, x in enumerate(m)], "row_id long, a array<double>, b array<double>")
    gap = vectors.cosine_gap(pairs).first()
    assert abs(gap["true_pairs"] - 1) < 1e-9 and gap["gap"] == gap["true_pairs"] - gap["random_pairs"]


def test_best_of():
    rng = np.random.default_rng(1)
    for n, k in ((3, 5), (40, 5), (40, 40)):
        s, keys = rng.integers(0, 4, (7, n)).astype(float), rng.permutation(n)
        s[0, 0] = -np.inf
        row, column = vectors._best_of(s, keys, k)
        want = [(r, c) for r in range(7) for c in sorted((c for c in range(n) if np.isfinite(s[r, c])), key=lambda c, r=r: (-s[r, c], keys[c]))[:k]]
        assert list(zip(row.tolist(), column.tolist(), strict=True)) == want


def test_edges_written(spark, tmp_path):
    """Edges are counted as they are written; without any there is no table."""
    from concordia.plans.build import write_edges

    e = spark.createDataFrame([("a", "b")], "src string, target string")
    assert write_edges(e, str(tmp_path / "e")) == 1 and spark.read.parquet(str(tmp_path / "e")).count() == 1
    assert write_edges(e.limit(0), str(tmp_path / "none")) == 0 and not (tmp_path / "none").exists()


def test_versions_and_synonyms(spark, tmp_path):
    """The last of a vocabulary's rows counts; names keep the file's order and their repeats."""
    from concordia.sources import delimited

    (tmp_path / "v.csv").write_text("vocabulary_id,vocabulary_version\nA,z\nB,1\nA,b\nB, \n")
    (tmp_path / "s.csv").write_text("concept_id,concept_synonym_name\n1,z\n1,a\n2, \n1,z\n")
    read = lambda n: delimited.read_delimited(spark, f"{tmp_path}/{n}.csv")
    assert {tuple(r) for r in delimited.vocabulary_versions(read("v")).collect()} == {("A", "b"), ("B", "unknown")}
    assert [tuple(r) for r in delimited.synonym_lists(read("s")).collect()] == [(1, ["z", "a", "z"])]


def test_find_and_stage(spark, tmp_path):
    import pytest

    from concordia.functions import sql_functions
    from concordia.sources import registry

    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "deep" / "hp.obo").write_text("[Term]\nid: HP:1\nname: One\n")
    assert registry.find("hpo", str(tmp_path / "in")).endswith("deep/hp.obo")
    with pytest.raises(FileNotFoundError):
        registry.find("concepts", str(tmp_path / "in"))
    assert registry.stage(spark, "hpo", str(tmp_path / "out"), path=registry.find("hpo", str(tmp_path / "in")), version="v") == 1
    for name in sql_functions.create_tables(spark):
        assert spark.table(name).count() == 0
        spark.sql(f"DROP TABLE {name}")


def test_order_by_alternates(spark, sf):
    got = [(r["num_alternates"], r["s_suppkey"]) for r in QUERIES["alternates_order"](spark, sf).collect()]
    assert got == sorted(got, key=lambda x: (-x[0], x[1]))
