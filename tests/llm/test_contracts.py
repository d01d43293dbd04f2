"""Each query against a plain, slow computation of its contract over a small table."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
import zlib

from concordia.llm import queries

pytestmark = pytest.mark.filterwarnings("ignore")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


@pytest.fixture(scope="module")
def documents(spark, sf):
    return {r["doc_id"]: r for r in rows(spark.read.parquet(f"{sf}/documents.parquet"))}


def words(text):
    return WORD.findall(text or "")


def test_op3(spark, sf, documents):
    got = rows(queries.QUERIES["op3_mixing"](spark, sf))
    assert sorted(r["doc_id"] for r in got) == sorted(documents)
    sizes = {}
    for d in documents.values():
        sizes[d["source"]] = sizes.get(d["source"], 0) + len(words(d["text"]))
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        for s in over or free:
            target[s] = 3.0 * sizes[s] if over else level * weight[s]
            left -= target[s]
        free -= over or set(free)
    taken = {}
    for r in got:
        d = documents[r["doc_id"]]
        assert r["size"] == len(words(d["text"])) and r["source_size"] == sizes[d["source"]]
        assert r["target"] == pytest.approx(target[d["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken.setdefault(d["source"], []).append((r["taken"], r["size"]))
    for s, t in taken.items():
        assert abs(sum(x for x, _ in t) - target[s]) <= 2 * max(y for _, y in t)
    again = rows(queries.QUERIES["op3_mixing"](spark, sf))
    assert {r["doc_id"]: r["taken"] for r in got} == {r["doc_id"]: r["taken"] for r in again}


def plain_fingerprint(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """Smallest id that links within 2 bits reach, by flooding."""
    ids, found = sorted(prints), {}
    for i in ids:
        if i in found:
            continue
        todo = [i]
        found[i] = i
        while todo:
            a = todo.pop()
            for b in ids:
                if b not in found and bin(prints[a] ^ prints[b]).count("1") <= 2:
                    found[b] = i
                    todo.append(b)
    return found


def test_op5(spark, sf, documents):
    prints = {i: plain_fingerprint(d["text"]) for i, d in documents.items()}
    groups = plain_components(prints)
    got = rows(queries.QUERIES["op5_simhash"](spark, sf))
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{f:016x}", groups[i]) for i, f in prints.items()}


def test_op7(spark, sf):
    chats = {-1: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for r in rows(spark.read.parquet(f"{sf}/conversations.parquet")):
        chats.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    want = {}
    for c, turns in chats.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        want[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = rows(queries.QUERIES["op7_chat"](spark, sf))
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == want
    assert all(r["formatted_chars"] >= r["loss_chars"] for r in got)


def test_op8(spark, sf):
    vectors = [(r["vec_id"], np.array(r["embedding"], float)) for r in rows(spark.read.parquet(f"{sf}/embeddings.parquet")) if r["embedding"]]
    ids, m = np.array([i for i, _ in vectors]), np.stack([v for _, v in vectors])
    got = {}
    for r in sorted(rows(queries.QUERIES["op8_ann"](spark, sf)), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = all_ = 0
    for q in ids[ids % 20 == 0].tolist():
        s = m @ m[ids == q][0]
        best = [i for _, i in sorted((-x, i) for x, i in zip(s.tolist(), ids.tolist()) if i != q)[:20]]
        assert [r for r, _, _ in got[q]] == list(range(1, len(got[q]) + 1))
        assert [(-x, i) for _, i, x in got[q]] == sorted((-x, i) for _, i, x in got[q])
        for _, i, x in got[q]:
            assert i != q and x == pytest.approx(float(s[ids == i][0]), abs=1e-12)
        hit, all_ = hit + len(set(best) & {i for _, i, _ in got[q]}), all_ + len(best)
    assert hit / all_ >= 0.9


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            luhn = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits))) % 10 == 0
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), place, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def test_op9(spark, sf, documents):
    got = rows(queries.QUERIES["op9_pii"](spark, sf))
    assert sorted(r["doc_id"] for r in got) == sorted(documents)
    for r in got:
        base = plain_spans(documents[r["doc_id"]]["text"] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        for k in PLAIN:
            assert r[f"n_{k}"] == sum(s.startswith(k) for s in base)
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("term:")] == base
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


@pytest.mark.parametrize("text", [
    "a@b@c.de x..y@z-.q.-", "1.2.3.4.5.6.7.8 999.1.1.1.1 01.002.3.255", "4111 1111 1111 1111 4111-1111-1111-1111-1 4111111111111111",
    "+49 (30) 123.456-78 +1 +12345678901234567 +1(2)3-4.5 678 901", "@a.b x@ @ @@ a%+-._@b.c.", "é1@ü.de 1é.2.3.4 ++49123456789", "", "0" * 300 + ".1.1.1",
])
def test_patterns(text):
    from concordia.llm import pii

    assert [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in pii.base_spans(text)] == plain_spans(text)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_op1(spark, sf, documents):
    got = rows(queries.QUERIES["op1_toxicity"](spark, sf))
    assert sorted(r["doc_id"] for r in got) == sorted(documents)
    for r in got:
        assert r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)


def test_op2(spark, sf, documents):
    got = rows(queries.QUERIES["op2_quality"](spark, sf))
    assert sorted(r["doc_id"] for r in got) == sorted(documents)
    for r in got:
        assert r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)


def plain_removed(texts, window=50):
    """(words, which are removed) of each id."""
    seen, out = {}, {}
    for i in sorted(texts):
        w = words(texts[i])
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen.setdefault(tuple(w[k : k + window]), i) < i:
                gone[k : k + window] = [True] * window
        out[i] = (w, gone)
    return out


def test_op10(spark, sf, documents):
    got = {r["doc_id"]: r for r in rows(queries.QUERIES["op10_substring"](spark, sf))}
    want = plain_removed({i: d["text"] for i, d in documents.items()})
    assert set(got) == set(want)
    for i, (w, gone) in want.items():
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("held", [1, 40, 1 << 20])
def test_op10_crowded(spark, monkeypatch, held):
    """Crowded anchors go another way, and workers hold few entries at once, and it gives the same."""
    from concordia.llm import substring

    monkeypatch.setattr(substring, "HELD", held)
    monkeypatch.setattr(substring, "SALTS", 3)

    passage = " ".join(f"p{k}" for k in range(70))
    texts = {i: f"{' '.join(f'a{i}x{k}' for k in range(i % 40))} {passage if i % 3 else ''} {' '.join(f'b{i % 7}x{k}' for k in range(60))}" for i in range(300)}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()] + [(1000, None), (1001, "")], "doc_id long, text string")
    monkeypatch.setattr(substring, "LEAST_CROWD", 2)
    assert len(substring.crowded_anchors(docs)[0])
    want = plain_removed(texts | {1000: "", 1001: ""})
    got = {r["doc_id"]: r for r in rows(substring.dedup(docs))}
    assert {i: (r["n_removed"], r["kept"]) for i, r in got.items()} == {i: (sum(g), " ".join(x for x, y in zip(w, g) if not y)) for i, (w, g) in want.items()}


def test_op6(spark, sf, documents):
    from tokenizers import Tokenizer

    from concordia.llm import repair

    tokenizer = Tokenizer.from_file(repair.tokenizer_path())
    start, want = 0, {}
    for i in sorted(documents):
        ids = [*tokenizer.encode(documents[i]["text"] or "", add_special_tokens=False).ids, 2]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = rows(queries.QUERIES["op6_repair"](spark, sf))
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want


def plain_distance(item, text):
    """Fewest edits of item anywhere in text."""
    above = list(range(len(item) + 1))
    best = above[-1]
    for c in text:
        row = [0]
        for k, p in enumerate(item, 1):
            row.append(min(above[k] + 1, row[-1] + 1, above[k - 1] + (p != c)))
        above = row
        best = min(best, row[-1])
    return best


def test_myers():
    import random

    from concordia.llm import decontaminate

    rng = random.Random(5)
    for _ in range(200):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 40)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.7:
            edited = "".join(c for c in item if rng.random() < 0.9)
            text = text[:20] + edited + text[20:]
        hit, want = decontaminate.myers(item, text, 5), plain_distance(item, text)
        assert (hit[0] if hit else None) == (want if want <= 5 else None)


def test_op4(spark, sf, documents):
    """Every item that stands within its budget is found, on short documents by plain dynamic programming."""
    import random

    from concordia.llm import decontaminate

    items = [(r["item_id"], r["text"]) for r in rows(spark.read.parquet(f"{sf}/benchmark.parquet"))][:8]
    rng, texts = random.Random(3), {}
    for i in range(60):
        item = items[i % 8][1]
        k = int(decontaminate.ERRORS * len(item)) + (i % 3 == 2) * 12
        chars = list(item)
        for _ in range(rng.randint(0, k)):
            at = rng.randrange(len(chars))
            chars[at : at + 1] = rng.choice([[], ["x"], [chars[at], "y"], [chars[at].upper()]])
        texts[i] = f"{'before words ' * rng.randint(0, 3)}{''.join(chars) if i % 5 else ''}{' after it' * rng.randint(0, 3)}"
    docs = spark.createDataFrame([*texts.items(), (100, None), (101, "")], "doc_id long, text string")
    bench = spark.createDataFrame([*items, (900, None), (901, "short"), (902, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in rows(decontaminate.matches(docs, bench))}
    want = {}
    for i, t in texts.items():
        for item, text in items:
            text = decontaminate.normal(text).strip()
            d = plain_distance(text, decontaminate.normal(t))
            if d <= int(decontaminate.ERRORS * len(text)):
                want[i, item] = d
    assert {k: r["edits"] for k, r in got.items()} == want and len(want) > 20
    for (i, _), r in got.items():
        assert 0 <= r["start"] < r["end"] <= len(texts[i])
    kept = {r["doc_id"] for r in rows(decontaminate.clean(docs, bench))}
    assert kept == {100, 101, *texts} - {i for i, _ in want}
