"""Every query that has SQL, against DuckDB on the same tables."""

import duckdb
import pytest

from concordia.plans.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 5)
    return str(v) if hasattr(v, "isoformat") else v


def as_set(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted([tuple(plain(r[k]) for k in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf, duck, name):
    got = QUERIES[name](spark, sf)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    expected = as_set(names, want.fetchall())
    found = as_set(got.columns, [tuple(r) for r in got.collect()])
    assert len(found) == len(expected)
    assert found == expected
    assert expected, "a query without rows shows nothing"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
