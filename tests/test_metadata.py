"""Metadata merged path by path, against a plain merge."""

import json
import random
from collections import Counter

from concordia.operators import metadata


def flat(v, path=()):
    if isinstance(v, dict) and v:
        for k, x in v.items():
            yield from flat(x, (*path, k))
    else:
        yield path, json.dumps(v, separators=(",", ":"), ensure_ascii=False)


def plain(variants):
    counts = {}
    for v in variants:
        for path, value in flat(v):
            counts.setdefault(path, Counter())[value] += 1
    out = {}
    for path in sorted(counts):
        if any(p[: len(path)] == path and len(p) > len(path) for p in counts):
            continue
        value = min(counts[path], key=lambda x: (-counts[path][x], x))
        if not path:
            return json.loads(value)
        at = out
        for name in path[:-1]:
            at = at.setdefault(name, {})
        at[path[-1]] = json.loads(value)
    return out


def value(rng, depth):
    if depth and rng.random() < 0.5:
        return {rng.choice(["a", "b", 'q"uo', "é"]): value(rng, depth - 1) for _ in range(rng.randrange(3))}
    return rng.choice([1, 2, True, None, "x", "ü\n", [1, {"a": 2}], [], 1.5])


def test_merge(spark):
    rng = random.Random(5)
    rows, own = [], {}
    for _ in range(300):
        key = (rng.choice(["A", None]), rng.choice("12345678"))
        v = {k: value(rng, 3) for k in rng.sample("abcd", rng.randrange(4))}
        own.setdefault(key, []).append(v)
        rows.append((*key, json.dumps(v)))
    rows += [("A", "1", None), ("A", "1", "no json"), ("A", "1", "[1]"), ("B", "1", "7"), ("C", "1", "{}")]
    own[("C", "1")] = [{}]
    df = spark.createDataFrame(rows, "authority string, code string, metadata_ string").repartition(5)
    got = {(r["authority"], r["code"]): json.loads(r["metadata_"]) for r in metadata.merged(df, ["authority", "code"]).collect()}
    assert got == {k: plain(v) for k, v in own.items()}
    assert metadata.merged(df.limit(0), ["authority", "code"]).collect() == []
