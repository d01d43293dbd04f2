"""Line dedup, periodic runs and vector codes against plain computations, and their edges."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from concordia.llm import codes, lines, periods, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
EXTRA = "row_a int, row_b int, places int, line string, a int, b int, n int, keeper int"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def table(spark, items, parts=3):
    return spark.createDataFrame([(i, t, 1, 2, 3, "x", 4, 5, 6, 7) for i, t in items], "doc_id long, text string, " + EXTRA).repartition(parts)


# ---- lines


def plain_lines(items):
    keys = [[k.strip(" \t\n\x0b\x0c\r").translate(LOWER) for k in (t or "").split("\n")] for _, t in items]
    holders = {}
    for (doc, _), own in zip(items, keys):
        for k in {k for k in own if len(k) >= 40}:
            holders.setdefault(k, []).append(-1 if doc is None else doc)
    out = []
    for (doc, text), own in zip(items, keys):
        all_lines = (text or "").split("\n")
        stay = [x for x, k in zip(all_lines, own) if len(holders.get(k, [])) < 5 or max(holders[k]) == (-1 if doc is None else doc)]
        out.append((doc, len(all_lines), len(all_lines) - len(stay), "\n".join(stay)))
    return out


def same_lines(spark, items):
    got = lines.dedup(table(spark, items)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(plain_lines(items), key=repr)


def test_lines_random(spark):
    rng = random.Random(3)
    pool = [f"  Shared line {k} with É words enough to be over the bound of forty\t" for k in range(6)] + ["short", "", " \t", "x" * 39, "y" * 40, "Z" * 40]
    items = [(k, "\n".join(rng.choice(pool).upper() if rng.random() < 0.2 else rng.choice(pool) for _ in range(rng.randrange(9)))) for k in range(60)]
    same_lines(spark, items)


def test_lines_edges(spark):
    common = "a line that very many documents have, long enough"
    long_text = "\n".join([common] * 3 + [f"line {k} of a very long text, different each" for k in range(60_000)] + [common.upper()])
    items = [(None, None), (1, None), (1, ""), (2, "\n\n"), (None, common), (None, common), (3, common), (3, common), (4, common + "\r\n" + common), (4, long_text), (5, "É" * 40), (6, "é" * 40)]
    same_lines(spark, items)
    only_null = [(None, common + f"\n{k}") for k in range(6)]
    assert all(r["n_dropped"] == 0 for r in rows(lines.dedup(table(spark, only_null))))
    assert rows(lines.dedup(table(spark, []))) == []


def test_lines_are_native_and_narrow(spark, sf):
    plan = queries.QUERIES["op11_lines"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# ---- periodic runs


def plain_runs(w, words=24, times=3):
    n, found = len(w), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(words, times * q):
                found.setdefault((start, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def numbers(w):
    seen = {}
    return np.array([seen.setdefault(x, len(seen)) for x in w], np.int64)


def thue_morse(n):
    return [bin(k).count("1") % 2 for k in range(n)]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def sequences():
    rng = random.Random(7)
    yield from ([0] * n for n in (0, 1, 23, 24, 25, 100, 700))
    yield from (thue_morse(600), fibonacci(800), ([0] * 19 + [1]) * 30, ([0] * 40 + [1] + [0] * 41 + [1]) * 9)
    for p in (1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33, 63, 64, 65, 100):
        unit = [rng.randrange(40) for _ in range(p)]
        for extra in (-1, 0, 1):
            pad = [100 + k for k in range(rng.randrange(20))]
            yield pad + (unit * 5)[: max(24, 3 * p) + extra] + [200 + k for k in range(rng.randrange(9))]
    for k in range(250):
        letters, w = rng.choice([1, 2, 2, 3, 20]), []
        while len(w) < rng.choice([60, 200, 500]):
            unit = [rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 21, 34]))]
            w += (unit * rng.randrange(1, 9))[: rng.randrange(1, 150)]
            if rng.random() < 0.3:
                w += w[-rng.randrange(1, 60) :] * rng.randrange(1, 4)
        yield w[:600]


def test_runs_equal_brute_force():
    hit = 0
    for w in sequences():
        got = [tuple(r) for r in periods.find_runs(numbers(w))]
        assert got == plain_runs(w), w
        hit += len(got)
    assert hit > 500


def test_runs_in_segments(monkeypatch):
    monkeypatch.setattr(periods, "SEGMENT", 64)
    for k, w in enumerate(sequences()):
        if k % 5 == 0:
            assert [tuple(r) for r in periods.find_runs(numbers(w))] == plain_runs(w)


def test_runs_of_long_texts():
    """A long text of one word, and long periods, take no square of their length."""
    assert periods.find_runs(np.zeros(1_000_000, np.int64)) == [(0, 1_000_000, 1)]
    unit = np.arange(60_000)
    assert periods.find_runs(np.concatenate([[70_000], unit, unit, unit, unit[:5]])) == [(1, 180_005, 60_000)]
    with pytest.raises(ValueError):
        periods.find_runs(unit, words=10)


def plain_periods(doc, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n and doc is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(numbers(w).tolist())
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, n_run, q in runs for i in range(s + q, s + n_run)}
    return {
        "doc_id": doc, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2], "exponent_milli": None if best[0] is None else 1000 * best[1] // best[2],
        "runs_sha256": sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), "collapsed_sha256": sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    }


def test_op12(spark, tmp_path, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = [(r[0], r[1]) for r in docs if len(r[1] or "") < 9000]
    items += [(None, "a b " * 40), (None, None), (7, ""), (7, "x\ty " * 30), (8, "é z " * 90), (8, "é z " * 90)] + [(10_000 + k, "one two three four five six " * (k % 5)) for k in range(60)]
    table(spark, items).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(queries.QUERIES["op12_periods"](spark, str(tmp_path)))
    want = [plain_periods(*x) for x in items]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert sum(w["n_runs"] > 0 for w in want) > 20
    assert rows(periods.collapse(table(spark, []))) == []


# ---- vector codes


def plain_codes(kept, rounds=6):
    """kept: (vec_id, label, components) in order of vec_id, one length."""
    x = [[int(np.floor(4096 * np.float64(c))) for c in v] for _, _, v in kept]
    width = len(x[0])
    cut = [k * width // 8 for k in range(9)]
    out, books = [], []
    for k in range(8):
        part = [tuple(v[cut[k] : cut[k + 1]]) for v in x]
        book = list(part[:16])
        near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))  # noqa: E731, B023
        for _ in range(rounds):
            own = [near(v)[1] for v in part]
            book = [tuple(sum(c) // len(c) for c in zip(*m)) if (m := [v for v, i in zip(part, own) if i == e]) else book[e] for e in range(len(book))]
        out.append([near(v) for v in part])
        books.append(book)
    error = [sum(out[k][r][0] for k in range(8)) for r in range(len(x))]
    labels = {}
    for (_, label, _), e in zip(kept, error):
        labels[label] = labels.get(label, 0) + e
    digest = sha(",".join(str(c) for b in books for e in b for c in e))
    return [(i, "".join(f"{out[k][r][1]:02x}" for k in range(8)), error[r], labels[label], digest) for r, (i, label, _) in enumerate(kept)]


VECTORS = "vec_id long, embedding array<float>, label int, code int, error string, own int, v int, width int"


def test_codes_equal_plain(spark):
    rng = np.random.default_rng(5)
    v = (rng.normal(size=(150, 16)) * rng.choice([0.01, 1, 30], size=(150, 1))).astype(np.float32)
    v[20:40], v[3], v[5] = v[0], v[2], 0
    bad = [(900, None), (901, [None] + [1.0] * 15), (902, [float("nan")] + [1.0] * 15), (903, [float("-inf")] + [1.0] * 15)]
    kept = [(k // 2, None if k % 7 == 0 else k % 3, v[k].tolist()) for k in range(150)]
    kept.sort(key=lambda r: (r[0], r[2]))
    items = [(i, e, label, 1, "e", 2, 3, 4) for i, label, e in kept] + [(i, e, 1, 1, "e", 2, 3, 4) for i, e in bad]
    frame = spark.createDataFrame(items, VECTORS).repartition(5)
    got = codes.with_label_errors(codes.compress(frame)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(plain_codes(kept))


def test_codes_edges(spark):
    few = [(5, [1.0] * 8, 1), (None, [2.0] * 8, None), (6, [0.25] * 3, None), (7, [], 2), (7, [], 2), (8, [0.5] * 8, None)]
    frame = spark.createDataFrame([(*x, 1, "e", 2, 3, 4) for x in few], VECTORS)
    got = codes.with_label_errors(codes.compress(frame)).collect()
    assert len(got) == 6 and all(r["error"] == 0 and r["label_error"] == 0 and len(r["code"]) == 16 for r in got)
    assert rows(codes.compress(frame.limit(0))) == [] and rows(codes.with_label_errors(codes.compress(frame.filter("vec_id > 99")))) == []
    with pytest.raises(ValueError):
        codes.whole_numbers(pa.array([[5000.0]]), 1)


def test_search_is_exact_and_skips():
    """Exponion search from any entry gives the nearest, the lowest of equals, and looks at few entries."""
    rng = np.random.default_rng(2)
    book = codes.Codebook(np.concatenate([rng.integers(-300, 300, size=(15, 4)), [[7, 7, 7, 7]]])[[15, *range(15)]])
    book.entries[9] = book.entries[4]
    book = codes.Codebook(book.entries)
    x = np.concatenate([rng.integers(-300, 300, size=(500, 4)), book.entries])
    away = ((x[:, None] - book.entries[None]) ** 2).sum(axis=2)
    for start in range(16):
        entry, least = book.nearest(x, np.full(len(x), start))
        assert (entry == away.argmin(axis=1)).all() and (least == away.min(axis=1)).all()
