"""Canonical JSON without Python workers, against json.dumps."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from concordia.functions import canonical, hashing

ODD = 'aZ "\\/\n\r\t\b\f\x00\x1f\x7fé中\U0001f600 ￿{}[]:,0'


def dumped(text):
    return json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"))


def shown(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return [r["c"] for r in df.select("k", canonical.canonical(F.col("t")).alias("c")).orderBy("k").collect()]


def value(rng, depth=0):
    text = lambda: "".join(rng.choice(ODD) for _ in range(rng.randint(0, 8)))
    kind = rng.randint(0, 9 if depth < 4 else 6)
    if kind < 2:
        return rng.choice((None, True, False))
    if kind == 2:
        return rng.randint(-(10 ** rng.randint(1, 30)), 10**5)
    if kind == 3:
        return rng.choice((rng.uniform(-1e6, 1e6), round(rng.uniform(-9, 9), 2), 10.0 ** rng.randint(-30, 30)))
    if kind <= 6:
        return text()
    return {text(): value(rng, depth + 1) for _ in range(rng.randint(0, 5))} if kind <= 8 else [value(rng, depth + 1) for _ in range(rng.randint(0, 5))]


def test_random_values(spark):
    rng = random.Random(3)
    texts = [json.dumps(value(rng), ensure_ascii=rng.random() < 0.5, indent=rng.choice((None, 2))) for _ in range(1500)]
    assert shown(spark, texts) == [dumped(t) for t in texts]


def test_stated_values(spark):
    texts = ["-0", "1E5", " [1.0, 2.50,-0.0,1e400] ", '{"b":[], "a":{}}', '"\\/\\u00e9\\ud83d\\ude00"', '""', '"' + "a" * 100_000 + '\\n"', "[" * 40 + "]" * 40, '{"\\u0062":1,"a":2}', "123456789012345678901234567890"]
    assert shown(spark, texts) == [dumped(t) for t in texts]
    assert shown(spark, [None]) == [None]
    for bad in ("{", "[1,]", '{"a":1,"a":2}', "nothing"):
        with pytest.raises(Exception, match="MALFORMED|VARIANT|malformed"):
            shown(spark, [bad])


def test_numbers(spark):
    rng = random.Random(5)
    xs = [5e-324, 2.0**-44, 0.1, 1e15, 1e16, 1e-4, 1e-5, -0.0, 0.0, 1e22, 1e23, 1.7976931348623157e308, 9999999.999, float("inf"), float("-inf"), 2e-3]
    xs += [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 12) for _ in range(20_000)] + [round(rng.uniform(-1000, 1000), 3) for _ in range(2000)]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "k int, x double")
    got = [r["s"] for r in df.select("k", canonical.json_float(F.col("x")).alias("s")).orderBy("k").collect()]
    assert got == [json.dumps(x) for x in xs]


def test_content_hash_of_odd_elements(spark):
    """Every hashed field, in texts of any script, and no Python worker in the plan."""
    rows = [
        {"description": "Größe \U0001f600\n", "alternate_names": "b||é|a", "member_of_collections": ["z", "é", "a"], "metadata_": '{"z":1.50,"a":[1e-7,{"é":null}]}', "plausible_min": 1e-7, "plausible_max": 3.0, "numeric_precision": 2},
        {"description": None, "alternate_names": "", "member_of_collections": None, "metadata_": "", "plausible_min": None, "plausible_max": float("nan"), "numeric_precision": None},
    ]
    df = spark.createDataFrame(rows, "description string, alternate_names string, member_of_collections array<string>, metadata_ string, plausible_min double, plausible_max double, numeric_precision int")
    hashed = df.select(hashing.content_hash(df).alias("h"))
    assert "Python" not in hashed._jdf.queryExecution().executedPlan().toString()
    want = []
    for r in rows:
        p = {f: r.get(f) for f in hashing.HASHED}
        p["alternate_names"] = sorted(r["alternate_names"].split("|")) if r["alternate_names"] else None
        p["collections"] = sorted(r["member_of_collections"] or [])
        p["metadata_"] = json.loads(r["metadata_"]) if r["metadata_"] else None
        p["plausible_max"] = 3.0 if r["plausible_max"] == 3 else None
        want.append(hashlib.sha256(json.dumps(p, sort_keys=True, separators=(",", ":")).encode()).hexdigest())
    assert [r["h"] for r in hashed.collect()] == want
