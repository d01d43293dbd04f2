"""The queries that have SQL, against DuckDB on the same tables."""

import duckdb
import pytest

from concordia.llm import queries


def plain(v):
    return round(v, 5) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, sf), con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    order = sorted(range(len(names)), key=lambda k: names[k])
    expected = sorted((tuple(plain(r[k]) for k in order) for r in want.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in sorted(names)) for r in got.collect()), key=repr) == expected and expected


def test_mixing_sql_rows(spark, tmp_path):
    """The SQL of the mix and the query agree on rows that share an id, or have none, and on null sources."""
    items = [(None if k % 4 == 0 else k % 9, "w " * (k % 6), ("a", "b", None)[k % 3]) for k in range(120)] + [(1, None, "a"), (1, "", "a")]
    spark.createDataFrame(items, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(queries.ORACLES["op3_mixing"]).fetchall()
    got = queries.QUERIES["op3_mixing"](spark, str(tmp_path)).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted((tuple(plain(v) for v in r) for r in got), key=repr) == sorted((tuple(plain(v) for v in r) for r in want), key=repr)
