"""Cells, routes and the threshold join, against brute force."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordia.operators import routing, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def made(spark, v, labels):
    return spark.createDataFrame([(k, None if x is None else [float(c) for c in x], lab) for k, (x, lab) in enumerate(zip(v, labels, strict=True))], SCHEMA)


@pytest.mark.parametrize("least", [0.3, 0.92, 1 - 1e-9])
def test_links_equal_brute_force(spark, monkeypatch, least):
    """Clusters, scattered vectors, copies of several labels and unusable rows; small groups, so that blocks and parts are several."""
    monkeypatch.setattr(routing, "ROWS", 16)
    monkeypatch.setattr(routing, "ASKERS", 8)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 8))
    v = [*(centre[k % 6] + rng.normal(size=8) * 0.15 * (k % 4) for k in range(90)), *rng.normal(size=(40, 8)), *[centre[0]] * 30, *[np.ones(8)] * 5, *[np.ones(8) * 2] * 3]
    v = [np.float32(x) for x in v] + [None, np.zeros(8), np.full(8, np.nan)]
    labels = [None if k % 5 == 0 else k % 3 for k in range(len(v))]
    got = {r["vec_id"]: tuple(r)[1:] for r in routing.link_counts(made(spark, v, labels), least, pivots=12).collect()}
    m = np.array([x.astype(np.float64) / np.linalg.norm(x.astype(np.float64)) for x in v[:-3]])
    near = m @ m.T >= least
    for k in range(len(m)):
        others = [j for j in np.flatnonzero(near[k]) if j != k]
        if least < 0.99:
            assert got[k][1:] == (len(others), sum(labels[j] != labels[k] for j in others)), k
        assert got[k][0] <= k and np.allclose(m[got[k][0]], m[k])
    assert set(got) == set(range(len(m)))


def test_no_cross_join(spark, sf):
    plan = routing.link_counts(spark.read.parquet(f"{sf}/embeddings.parquet"), 0.92)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty(spark):
    assert routing.link_counts(made(spark, [], []), 0.9).collect() == []
    assert routing.link_counts(made(spark, [None], [1]), 0.9).collect() == []


def test_recall_of_all_rows(spark, tmp_path):
    """Every row of the largest table asks; recall@10 of the tuned probes, what is read, and rows added later."""
    folder = os.environ.get("RECALL_SF_DIR", "/root/testdata/sf0.1")
    e = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    path = str(tmp_path / "index")
    vectors.CellIndex.build(e.filter("vec_id % 4 <> 1"), 24).write(path)
    index = vectors.CellIndex.append(spark, path, e.filter("vec_id % 4 = 1"))
    exact = {(r["query_id"], r["vec_id"]) for r in vectors.exact_search(e, e, 10).collect()}
    found = {(r["query_id"], r["vec_id"]) for r in index.search(e, 10).collect()}
    assert len(exact & found) >= 0.9 * len(exact)
    added = {p for p in exact if p[1] % 4 == 1}
    assert len(added & found) >= 0.9 * len(added)
    one = e.filter("vec_id = 7")
    files = []
    for probes in (1, 4, 24):
        cells = [r["cell"] for r in one.select(F.explode(vectors.nearest_cells(index.centroids, probes)("embedding")).alias("cell")).collect()]
        files.append(index.cells.filter(F.col("cell").isin(cells)).select("_metadata.file_path").distinct().count())
        plan = index.search(one, 10, probes=probes)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [cell" in plan or "PartitionFilters: [isnotnull(cell" in plan
    assert files[0] < files[1] < files[2]
    assert index.search(one, 3, probes=1).filter("rank = 1").first()["vec_id"] == 7
