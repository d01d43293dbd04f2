"""Releases merged one after the other, against a plain walk."""

import random

from concordia.operators import lifecycle

KEYS = ["authority", "code"]
ELEMENTS = "authority string, code string, content_hash string, source_version string, claim string, accession long, is_active boolean"
RELEASE = "authority string, code string, content_hash string, source_version string, claim string"


def plain(elements, release, number):
    """elements: key -> [hash, version, claim, accession, active]; the same after the release, with states."""
    come = {}
    for key, *rest in release:
        low = lambda r: [(x is not None, x or "") for x in r]  # noqa: E731  nulls first, as Spark orders them
        come[key] = min(come.get(key, rest), rest, key=low)
    out = {}
    for key in elements.keys() | come.keys():
        old, new = elements.get(key), come.get(key)
        if old is None:
            out[key] = [*new, number, True, "new"]
        elif new is None:
            out[key] = [*old[:4], False, "retired" if old[4] else "gone"]
        else:
            out[key] = [*new, old[3], True, "changed" if old[0] != new[0] else "same" if old[4] else "returned"]
    best = {}
    nulls = lambda key: [(x is not None, x or "") for x in key]
    for key, (_, _, claim, accession, active, _) in out.items():
        if active and claim is not None:
            best[claim] = min(best.get(claim, (accession, nulls(key), key)), (accession, nulls(key), key))
    for key, row in out.items():
        if row[4] and row[2] is not None and best[row[2]][2] != key:
            row[4:] = [False, "replaced"]
    return out


def test_releases(spark):
    rng = random.Random(11)
    held, frame = {}, spark.createDataFrame([], ELEMENTS)
    keys = [(a, c) for a in ("A", None) for c in [*map(str, range(25)), None]]
    seen = set()
    for number in range(1, 5):
        release = [(rng.choice(keys), rng.choice(["h1", "h2", None]), f"v{number}", rng.choice([None, None, "x", "y", "z"])) for _ in range(45)]
        incoming = spark.createDataFrame([(*k, *r) for k, *r in release], RELEASE)
        merged = lifecycle.merge(frame, incoming, KEYS, number).cache()
        got = {(r["authority"], r["code"]): [r["content_hash"], r["source_version"], r["claim"], r["accession"], r["is_active"], r["state"]] for r in merged.collect()}
        want = plain(held, release, number)
        assert got == want
        seen |= {r[5] for r in got.values()}
        again = lifecycle.merge(merged.select(*KEYS, *lifecycle.KEPT), incoming, KEYS, number + 100).collect()
        assert {(r["authority"], r["code"]): r["is_active"] for r in again} == {k: r[4] for k, r in want.items()}
        assert {r["state"] for r in again} <= {"same", "gone", "replaced", "returned"}
        told = lifecycle.history(merged, KEYS, number).collect()
        assert {(r["authority"], r["code"]) for r in told} >= {k for k, r in want.items() if r[5] in ("new", "changed", "returned", "retired")}
        frame = spark.createDataFrame(merged.select(*KEYS, *lifecycle.KEPT).collect(), ELEMENTS)
        held = {k: r[:5] for k, r in want.items()}
        for r in merged.filter("replaced_by is not null").collect():
            winner = want[tuple(r["replaced_by"])]
            assert winner[4] and winner[2] == r["claim"] and winner[3] <= r["accession"]
    assert seen == {"new", "same", "changed", "returned", "retired", "gone", "replaced"}


def test_embeddings_follow_hashes(spark):
    first = spark.createDataFrame([("A", "1", "h1", "v1", None), ("A", "2", "h2", "v1", None), ("A", "3", "h3", "v1", None)], RELEASE)
    merged = lifecycle.merge(spark.createDataFrame([], ELEMENTS), first, KEYS, 1)
    assert sorted(r[0] for r in lifecycle.to_embed(merged, merged.limit(0)).collect()) == ["h1", "h2", "h3"]
    second = spark.createDataFrame([("A", "1", "h1", "v2", None), ("A", "2", "h9", "v2", None), ("A", "4", "h1", "v2", None)], RELEASE)
    after = lifecycle.merge(merged, second, KEYS, 2)
    assert [r[0] for r in lifecycle.to_embed(after, merged).collect()] == ["h9"]
    assert {r["code"]: (r["state"], r["source_version"]) for r in after.collect()} == {"1": ("same", "v2"), "2": ("changed", "v2"), "3": ("retired", "v1"), "4": ("new", "v2")}
