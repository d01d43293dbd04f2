"""The two classifiers against plain versions over small tables, and their accuracy on documents that training never reads."""

import math
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from concordia.llm import quality, queries, toxicity
from concordia.llm.common import text_buffers

LARGE = "/root/testdata/sf0.1"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def corpus(spark, sf):
    """200 documents with labels of both kinds."""
    docs = rows(spark.read.parquet(f"{sf}/documents.parquet"))[:200]
    labels = [(d["doc_id"], int(k % 3 == 0), int(k % 4 == 0)) for k, d in enumerate(docs)]
    # Words that tell, so that there is something to learn.
    texts = [(d["doc_id"], f"{d['text'] or ''} {'Vile Scum éé' if toxic else 'kind friend'} {'!!! ### ' * 20 if not good else 'A calm end.'}") for d, (_, good, toxic) in zip(docs, labels, strict=True)]
    return texts, labels


def plain_grams(text):
    found = set()
    low = "".join(c.lower() if len(c.lower()) == 1 and ord(c) < 1 << 16 else c for c in text)
    low = " " + "".join(" " if ord(c) <= 32 or c == "\xa0" else c for c in low) + " "
    for n in toxicity.GRAMS:
        found |= {low[k : k + n] for k in range(len(low) - n + 1)}
    return found


def test_toxicity_plain(spark, corpus):
    """N-grams as strings, their counts, log-count ratios and a dense logistic regression give the same scores."""
    texts, labels = corpus
    docs, known = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, known)
    label = {i: t for i, _, t in labels if not held_out(i)}
    train = [(plain_grams(t), label[i]) for i, t in texts if i in label]
    total = Counter(y for _, y in train)
    counts = defaultdict(lambda: [0, 0])
    for grams, y in train:
        for g in grams:
            counts[g][y] += 1
    ratio = {}
    for g, (clean, toxic) in counts.items():
        r = math.log(((toxic + 1) / (total[1] + 2)) / ((clean + 1) / (total[0] + 2)))
        if clean + toxic >= 3 and abs(r) / math.sqrt(1 / (toxic + 1) + 1 / (clean + 1)) > toxicity.LEAST_STRENGTH:
            ratio[g] = r
    assert 20 < len(ratio) < toxicity.FEATURES and abs(len(model.keys) - len(ratio)) <= 0.01 * len(ratio)  # hashes may meet
    names = sorted(ratio)
    scale = np.array([ratio[g] for g in names])
    dense = lambda sets: np.array([[float(g in s) for g in names] for s in sets])
    x, y = dense([g for g, _ in train]) * scale, np.array([y for _, y in train], float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    step = 1 / (0.25 * (weight * ((x * x).sum(axis=1) + 1)).sum() + 1 / len(y))
    w = w_at = np.zeros(len(names))
    b = b_at = 0.0
    t = 1.0
    for _ in range(600):
        slope = weight * (1 / (1 + np.exp(-(x @ w_at + b_at))) - y)
        w_new, b_new = w_at - step * (x.T @ slope + 0.01 / len(y) * w_at), b_at - step * slope.sum()
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        w_at, b_at = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    want = 1 / (1 + np.exp(-(dense([plain_grams(t) for _, t in texts]) * scale @ w + b)))
    got = {r["doc_id"]: r["score"] for r in rows(toxicity.score(docs, model))}
    assert np.abs(np.array([got[i] for i, _ in texts]) - want).max() < 0.02
    assert {i for i, s in got.items() if s >= 0.7} == {i for (i, _), s in zip(texts, want, strict=True) if s >= 0.7}


def test_statistics_plain():
    """Statistics of a chunk of texts against sums over one text at a time."""
    import pyarrow as pa

    texts = ["", " \n", "One two two, three!", "a b c\na b c\n\nx|y [z] 12 #5", "word " * 130 + "!!! ### END", None, "é ü 日本 ok"]
    got = quality.statistics(*text_buffers(pa.array(texts)))
    for text, row in zip(texts, got.tolist(), strict=True):
        raw = (text or "").encode()
        words, n = raw.split(), max(1, len(raw))
        lengths = [len(w) for w in words]
        share = lambda some: sum(c in some for c in raw) / n
        mean = sum(lengths) / max(1, len(words))
        seen = Counter(words)
        lines = [x for x in raw.split(b"\n") if x]
        want = [
            math.log1p(len(words)), math.log1p(len(raw)), mean, math.sqrt(max(0, sum(x * x for x in lengths) / max(1, len(words)) - mean * mean)), share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
            share(b"abcdefghijklmnopqrstuvwxyz"), share(b"0123456789"), share(b".,;:?'\"()-"), share(b"!"), share(b"#$%&*@^~=+<>\\/"), share(b"|"), share(b"[]{}_`"),
            sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words)), sum(w[:1].isupper() for w in words) / max(1, len(words)),
            sum(not (w[-1:].isalnum() or w[-1] >= 128 or w[-1:] in b".,;:?") for w in words) / max(1, len(words)), len(seen) / max(1, len(words)), max(seen.values(), default=0) / max(1, len(words)),
            math.log1p(len(lines)), (len(lines) - len(set(lines))) / max(1, len(lines)),
        ]
        assert row[: len(want)] == pytest.approx(want, abs=1e-5), text
        worst = [0.0] * 7
        for k in range(0, len(words), quality.SEGMENT):
            part = words[max(0, min(k, len(words) - quality.SEGMENT)) : min(len(words), k + quality.SEGMENT)]
            at = [x.start() for x in __import__("re").finditer(rb"[^\x20\x09-\x0D]+", raw)]
            first = max(0, min(k, len(words) - quality.SEGMENT))
            stretch = raw[at[first] : at[first + len(part) - 1] + len(part[-1])]
            own = [sum(c in some for c in stretch) / len(stretch) for some in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!", b"#$%&*@^~=+<>\\/", b"|")]
            same = [j > 0 and words[j] == words[j - 1] for j in range(first, first + len(part))]
            odd = [not (w[-1:].isalnum() or w[-1] >= 128 or w[-1:] in b".,;:?") for w in part]
            worst = [max(a, b) for a, b in zip(worst, [*own, sum(same) / len(part), sum(odd) / len(part)], strict=True)]
        assert row[len(want) :] == pytest.approx(worst, abs=1e-5), text


def plain_isotonic(x, y, w):
    """Rising fit at each point by the max-min formula over averages of ranges."""
    s, t = np.concatenate([[0], np.cumsum(y * w)]), np.concatenate([[0], np.cumsum(w)])
    mean = lambda a, b: (s[b + 1] - s[a]) / (t[b + 1] - t[a])
    return np.array([max(min(mean(a, b) for b in range(k, len(x))) for a in range(k + 1)) for k in range(len(x))])


def test_isotonic_plain():
    rng = np.random.default_rng(0)
    for n in (1, 2, 9, 40):
        x, y, w = np.arange(n, dtype=float), rng.integers(0, 2, n).astype(float), rng.integers(1, 5, n).astype(float)
        px, py = quality.pool_adjacent(x, y, w)
        assert np.interp(x, px, py) == pytest.approx(plain_isotonic(x, y, w))


def test_quality_plain(spark, corpus):
    """One ridge solve over all rows in place of partition sums, and the plain isotonic fit, give the same scores."""
    import pyarrow as pa

    texts, labels = corpus
    docs, known = spark.createDataFrame(texts, "doc_id long, text string").repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in rows(quality.score(docs, known))}
    folds = {r["doc_id"]: r["f"] for r in rows(docs.selectExpr("doc_id", f"cast(pmod(xxhash64('fold', doc_id), {quality.FOLDS}) as int) as f"))}
    x = quality.statistics(*text_buffers(pa.array([t for _, t in texts]))).astype(float)
    label = {i: q for i, q, _ in labels}
    train = np.array([not held_out(i) for i, _ in texts])
    y, fold = np.array([label[i] for i, _ in texts], float), np.array([folds[i] for i, _ in texts])
    z = quality.Features(x[train].mean(axis=0), x[train].std(axis=0, ddof=1), 42)(x)

    def solve(some):
        a = z[some].T @ z[some]
        loss = np.eye(len(a)) * 1e-3 * max(1.0, some.sum())
        loss[-1, -1] = 1e-9
        return np.linalg.solve(a + loss, z[some].T @ y[some])

    cross = np.zeros(len(y))
    for k in range(quality.FOLDS):
        cross[fold == k] = z[fold == k] @ solve(train & (fold != k))
    bins = np.round(np.clip(cross, -1, 2) * quality.BINS / 3).astype(int)
    by = {b: y[train & (bins == b)] for b in sorted(set(bins[train]))}
    at = np.array(list(by)) * 3 / quality.BINS
    fit = plain_isotonic(at, np.array([v.mean() for v in by.values()]), np.array([len(v) for v in by.values()], float))
    raw = z @ solve(train)
    want = np.interp(raw, at, fit) * 0.999 + 0.001 / (1 + np.exp(-raw))
    assert np.array([got[i] for i, _ in texts]) == pytest.approx(want, abs=0.02)


def auc(scores, truth):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    n = truth.sum()
    return (rank[truth == 1].sum() - n * (n - 1) / 2) / (n * (len(truth) - n))


@pytest.mark.skipif(not os.path.exists(LARGE), reason="needs labels enough")
@pytest.mark.parametrize(("name", "column"), [("op1_toxicity", "toxic"), ("op2_quality", "quality")])
def test_held_out_accuracy(spark, name, column):
    truth = {r["doc_id"]: r[column] for r in rows(spark.read.parquet(f"{LARGE}/labels.parquet")) if r[column] is not None}
    got = [(r["score"], truth[r["doc_id"]], r["predicted"]) for r in rows(queries.QUERIES[name](spark, LARGE)) if r["held_out"] and r["doc_id"] in truth]
    s, t, p = (np.array(c) for c in zip(*got, strict=True))
    assert len(got) > 500 and auc(s, t) > 0.97
    assert (t[p == 1] == 1).mean() > 0.93 and (p[t == 1] == 1).mean() > 0.8
