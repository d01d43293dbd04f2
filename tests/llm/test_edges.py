"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns: nothing crashes, each has its result."""

import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from concordia.llm import ann, chat, decontaminate, mixing, pii, quality, queries, repair, simhash, substring, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, copies int, label int, score double, fp long, start int, key string, __x int"
LONG = " ".join(f"w{k}" for k in range(400_000))


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def made(items):
    """Rows of (doc_id, text, source) with other columns that clash with what the operators make."""
    return [(i, t, "en", s, None if t is None else len(t), 7, 3, 1, 0.5, 1, 2, "k", 4) for i, t, s in items]


ITEMS = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one", "b"), (5, "two words", "b"), (None, "no id here", "a"), (6, "same same same text again", "c"), (6, "same same same text again", "c"),
    (7, "é ü 日本語 😀 <|endoftext|> it's a b", None), (8, LONG, "d"), (9, LONG, "d"), (10, "you idiot scum " * 5, "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(ITEMS), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(10, 0, 1), (4, 1, 0), (5, 1, 0), (1, None, None), (None, 1, 1), (6, 1, 0), (6, 0, 0), (99, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")


def test_toxicity(spark, docs, none, labels):
    model = toxicity.fit(docs, labels)
    got = rows(toxicity.judged(toxicity.score(docs, model), 0.7))
    assert len(got) == len(ITEMS) and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    assert toxicity.kept(docs, model).columns == docs.columns
    assert rows(toxicity.score(none, model)) == [] and toxicity.kept(none, model).count() == 0
    blank = toxicity.fit(docs, labels.limit(0))
    assert all(r["score"] < 1e-9 for r in rows(toxicity.score(docs, blank)))


def test_quality(docs, none, labels):
    got = rows(quality.score(docs, labels))
    assert len(got) == len(ITEMS) and all(0 <= r["score"] <= 1 for r in got)
    assert rows(quality.score(none, labels)) == [] and {r["score"] for r in rows(quality.score(docs, labels.limit(0)))} == {0.0}


def test_mixing(docs, none):
    got = rows(mixing.mix(docs))
    assert len(got) == len(ITEMS) and all(r["taken"] <= 3 * r["size"] for r in got)
    assert {r["source_size"] for r in got if r["source"] is None} == {8} and {r["taken"] for r in got if not r["size"]} == {0}
    assert mixing.emitted(docs).columns == docs.columns and rows(mixing.mix(none)) == [] and mixing.emitted(none).count() == 0


def test_mixing_repeats(spark):
    """Whole multiples are exact, and a source that is small is taken three times at most."""
    items = [(k, "w " * (k % 9), "big") for k in range(200)] + [(1000 + k, "w w w", "tiny") for k in range(4)]
    got = rows(mixing.mix(spark.createDataFrame(made(items), DOCS)))
    assert {r["copies"] for r in got if r["source"] == "tiny"} == {3}


def test_mixing_rows(spark):
    """Rows without an id, and rows that share one, are each taken for themselves; equal rows as often as all of them are."""
    items = [(None, "w " * (k % 7 + 1), "big") for k in range(59)] + [(5, "w " * (k % 5 + 1), "small") for k in range(20)] + [(6, "w w w", "tiny")] * 3
    df = spark.createDataFrame(made(items), DOCS)
    taken, emitted = Counter(), Counter()
    for r in rows(mixing.mix(df)):
        taken[r["source"]] += r["taken"]
    for r in rows(mixing.emitted(df)):
        emitted[r["source"]] += len(r["text"].split())
    assert taken == emitted and emitted["tiny"] == 27
    assert sorted(map(repr, rows(mixing.emitted(df)))) == sorted(map(repr, rows(mixing.emitted(df.repartition(7)))))


def test_simhash(docs, none):
    got = rows(simhash.near_duplicates(docs))
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(ITEMS) and {by[k]["component_id"] for k in (1, 2, 3)} == {1} and by[1]["fp"] == 0 and by[9]["component_id"] == 8
    assert rows(simhash.near_duplicates(none)) == []


def test_simhash_crowded(spark):
    """Crowded buckets link through whole balls and give the same groups."""
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(-(1 << 62), 1 << 62, 6)]
    prints = sorted({b ^ sum(1 << int(k) for k in rng.choice(63, rng.integers(0, 5), replace=False)) for b in base for _ in range(60)})
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long")
    from concordia.llm.graph import components

    label = {p: p for p in prints}
    for a in prints:
        for b in prints:
            if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2 and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {p: low if x == high else x for p, x in label.items()}
    sizes = Counter(label.values())
    for crowd in (1, 5, 1000):
        found = {r["node"]: r["component"] for r in rows(components(simhash.links(nodes, crowd=crowd)))}
        assert found == {p: x for p, x in label.items() if sizes[x] > 1}


def test_simhash_null_ids(spark):
    """Rows without an id carry links; a component's id is the smallest that any of its rows has."""
    same, other = "alpha beta gamma delta", "quite another text than that"
    df = spark.createDataFrame([(5, same), (None, same), (2, same), (None, other), (None, other), (2, other + " x"), (9, "")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["fp"], r["component_id"]) for r in rows(simhash.near_duplicates(df))), key=repr)
    f, g, h = (int(np.uint64(simhash.fingerprint(t)).view(np.int64)) for t in (same, other, other + " x"))
    assert got == sorted([(5, f, 2), (None, f, 2), (2, f, 2), (None, g, None), (None, g, None), (2, h, 2), (9, 0, 9)], key=repr)


def test_simhash_link_by_null(spark, monkeypatch):
    """Fingerprints 0, 3 and 15 are one component though the middle row has no id."""
    prints = spark.createDataFrame([(1, 0), (None, 3), (2, 15), (2, 127 << 40)], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, **_: docs)
    assert sorted((repr(r["doc_id"]), r["fp"], r["component_id"]) for r in rows(simhash.near_duplicates(prints))) == [("1", 0, 1), ("2", 15, 1), ("2", 127 << 40, 2), ("None", 3, 1)]


def test_one_of_each(spark):
    """Rows that share an id but no text both stay; of equal rows one does; null ids go only for rows with ids."""
    w, z, q = "one text of some words that is long enough", "another text altogether which shares nothing with it", "a third text without any id at all in it"
    items = [(1, w, "a"), (1, z, "a"), (3, w, "b"), (None, w, "c"), (None, q, "d"), (None, q, "d"), (None, q, "e"), (7, None, "a"), (8, "", "a")]
    df = spark.createDataFrame(made(items), DOCS)
    got = sorted(((r["doc_id"], r["text"], r["source"]) for r in rows(simhash.one_of_each(df))), key=repr)
    assert [x[:2] for x in got] == sorted([(1, w), (1, z), (7, None), (None, q)], key=repr)


def test_decontaminate(spark, docs, none):
    bench = spark.createDataFrame([(1, None), (None, "x" * 50), (2, " ".join(f"w{k}" for k in range(50, 70))), (3, " ".join(f"w{k}" for k in range(50, 70)))], "item_id long, text string")
    got = rows(decontaminate.matches(docs, bench))
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(8, 2), (8, 3), (9, 2), (9, 3)]
    assert decontaminate.clean(docs, bench).count() == len(ITEMS) - 2 and rows(decontaminate.matches(none, bench)) == [] and rows(decontaminate.matches(docs, bench.limit(0))) == []
    assert decontaminate.clean(docs, bench).columns == docs.columns
    held = spark.createDataFrame([(None, " ".join(f"w{k}" for k in range(50, 70))), (None, None)], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in sorted(rows(decontaminate.matches(docs, held)), key=repr)] == [(8, None), (9, None)]
    assert {8, 9} & {r["doc_id"] for r in rows(decontaminate.clean(docs, held))} == set()
    short = spark.createDataFrame([(1, "ONE"), (2, "wo"), (3, "  "), (4, "two words"), (5, "same same same text again")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"], r["edits"], r["start"], r["end"]) for r in rows(decontaminate.matches(docs, short)) if r["doc_id"] < 8) == [(4, 1, 0, 0, 3), (5, 4, 0, 0, 9), (6, 5, 0, 0, 25), (6, 5, 0, 0, 25)]


def test_repair(docs, none):
    got = sorted(rows(repair.written_and_read(docs)), key=lambda r: r["start"])
    assert len(got) == len(ITEMS) and got[0]["doc_id"] is None and [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]
    assert {r["doc_id"]: r["n_tokens"] for r in got}[1] == 1 and rows(repair.written_and_read(none)) == []


def test_grammar_round_trip():
    rng = np.random.default_rng(0)
    for n_docs, top in ((1, 2), (7, 3), (40, 5), (300, 50)):
        ids = [np.append(rng.integers(0, top, rng.integers(0, 400)), 2).astype(np.uint32) for _ in range(n_docs)]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
        shard = repair.Shard.read(repair.Shard.build(np.arange(n_docs), np.concatenate(ids), bounds).body())
        whole, ends = shard.all()
        assert (whole == np.concatenate(ids)).all() and (ends == bounds).all()
        for k in range(0, n_docs, 5):
            assert (shard.document(k) == ids[k]).all()
        for _ in range(20):
            a = int(rng.integers(0, len(whole)))
            n = int(rng.integers(0, len(whole) - a + 1))
            assert (shard.stretch(a, n) == whole[a : a + n]).all()


def test_grammar_ends():
    """Rules are replaced until no pair has enough uses, and a shard is smaller than plain 16-bit ids."""
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 3000, rng.integers(1, 6)) for _ in range(400)]
    docs = [np.append(np.concatenate([words[int(k)] for k in rng.zipf(1.3, 300) % 400]), 3001).astype(np.uint32) for _ in range(60)] + [np.array([7] * 500 + [3001], np.uint32)]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    ids = np.concatenate(docs)
    last = np.zeros(len(ids), bool)
    last[bounds[1:] - 1] = True
    pairs, symbols, last = repair.grammar(ids, last, 3002)
    uses, free = Counter(), {}
    for k in range(len(symbols) - 1):
        pair = (int(symbols[k]), int(symbols[k + 1]))
        if not last[k] and free.get(pair, -1) < k:
            uses[pair] += 1
            free[pair] = k + 1
    assert max(uses.values()) < repair.LEAST_USES and len(pairs) > 100 and (pairs < 3002 + np.arange(len(pairs))[:, None]).all()
    shard = repair.Shard.build(np.arange(len(docs)), ids, bounds)
    assert len(shard.body()) < 0.6 * 2 * len(ids)
    assert (shard.widths == [len(repair.expand(np.array([3002 + k]), pairs, 3002)) for k in range(len(pairs))]).all()


def test_chat(spark):
    turns = spark.createDataFrame([(1, 0, "user", None, "p"), (1, 0, "user", "a", "p"), (1, None, None, "[x] & <s>\n&lt;", "p"), (None, 1, "assistant", "", "p"), (2, 1, "as<s>\nist", LONG, "p"), (3, 0, "assistant", "</s>\n&amp;&#91;", "p")], "conv_id long, turn long, role string, text string, prompt string")
    formatted = chat.format_chats(chat.table_turns(turns))
    got = {r["conv_id"]: r["turns"] for r in rows(formatted.select("conv_id", chat.parse_turns(formatted.formatted).alias("turns")))}
    assert [(t["role"], t["text"]) for t in got[1]] == [("", "[x] & <s>\n&lt;"), ("user", ""), ("user", "a")]
    assert got[2] == [{"role": "as<s>\nist", "text": LONG}] and got[None] == [{"role": "assistant", "text": ""}]
    assert {r["conv_id"]: r["x"] for r in rows(formatted.select("conv_id", chat.masked_texts(formatted.formatted, formatted.loss_mask).alias("x")))}[3] == ["</s>\n&amp;&#91;"]
    assert rows(chat.format_chats(chat.table_turns(turns.limit(0)))) == []


def test_chat_layouts(spark):
    """Records of mixed layouts, by the fingerprints of their paths."""
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]}, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"instruction": "q", "output": "a", "input": ""}, {"output": "a", "instruction": "q"}, {"prompt": "q", "response": "a"}, {"prompt": "q", "completion": "a"}, {"question": "q", "answer": "a"},
        {"instruction": "do", "input": "this", "output": None, "system": "s"}, {"unknown": {"deep": [1]}}, {"messages": [{"role": "user", "content": None}]},
    ]
    lines = [*map(json.dumps, records), "not json", None, "{}", "[]", "3"]
    df = spark.createDataFrame(list(enumerate(lines)), "conv_id long, record string")
    got = {}
    for r in sorted(rows(chat.json_turns(df)), key=lambda r: (r["conv_id"], r["turn"] or 0)):
        got.setdefault(r["conv_id"], []).append((r["layout"], r["turn"], r["role"], r["text"]))
    for k, layout in enumerate(("messages", "sharegpt", "instruction", "instruction", "prompt_response", "prompt_completion", "question_answer")):
        assert got[k] == [(layout, got[k][0][1], "user", "q"), (layout, got[k][1][1], "assistant", "a")], k
    assert got[7] == [("instruction", 0, "system", "s"), ("instruction", 1, "user", "do\nthis"), ("instruction", 2, "assistant", None)]
    assert got[9] == [("messages", 0, "user", None)]
    assert all(got[k] == [(None, None, None, None)] for k in (8, 10, 11, 12, 13, 14))


def test_chat_other_fields(spark):
    """Fields that no mapping names don't matter; of several layouts the one that names most counts; an empty list has no turns."""
    records = [
        {"id": 7, "meta": {"a": [1, {"b": None}]}, "messages": [{"role": "user", "content": "q", "name": "x"}, {"content": "a", "role": "assistant", "weight": 1, "tool": {"n": 1}}]},
        {"prompt": "q", "response": "a", "conv_id": 99, "layout": "x", "v": 1, "paths": ["y"]}, {"prompt": "q", "response": "a", "system": "s", "question": "?", "answer": "!"},
        {"messages": []}, {"messages": [], "source": "x"}, {"messages": ["q"]}, {"messages": "q"}, {"prompt": {"text": "q"}, "response": "a"}, {"messages": [{"role": "user"}]},
        {"conv_id": 5, "turn": 2, "role": "user", "text": "t", "extra": True}, {"prompt": "q", "response": "a", "completion": "c"},
    ]
    df = spark.createDataFrame(list(enumerate(map(json.dumps, records))), "conv_id long, record string").withColumn("layout", F.lit("mine")).withColumn("v", F.lit(0))
    got = {}
    for r in sorted(rows(chat.json_turns(df)), key=lambda r: (r["conv_id"], r["turn"] or 0)):
        got.setdefault(r["conv_id"], []).append((r["layout"], r["turn"], r["role"], r["text"]))
    assert got[0] == [("messages", 0, "user", "q"), ("messages", 1, "assistant", "a")]
    assert [g[2:] for g in got[1]] == [("user", "q"), ("assistant", "a")] and got[1][0][0] == got[10][0][0] == "prompt_response"
    assert [g[2:] for g in got[2]] == [("system", "s"), ("user", "q"), ("assistant", "a")]
    assert got[3] == got[4] == [("messages", None, None, None)]
    assert got[6] == got[7] == got[8] == [(None, None, None, None)]
    assert got[5] == [("turn_rows", 2, "user", "t"), (None, None, None, None)] or got[5] == [(None, None, None, None), ("turn_rows", 2, "user", "t")]


def test_other_tokenizers(spark):
    """A file that splits in another way than by bytes is read by the library alone; both ways give the library's ids."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from concordia.llm import encode

    texts = ["", "Hello  world, it's 12 o'clock\n\n  end ", "naïve Straße 漢字 😀 <|endoftext|> x", LONG[:5000]]
    raw = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    for name, own in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        path = public_tokenizers.path(name)
        e = encode.Encoder(path)
        assert e.own_split == own
        ids, bounds = e.encode(np.frombuffer(b"".join(raw), np.uint8), offs)
        library = Tokenizer.from_file(path)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_ann(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (40, None), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [None, 1.0]), (120, [inf, 0.0]), (3, [0.5, 0.5]), (4, [1.0, 0.0]), (4, [1.0, 0.0]), (None, [1.0, 1.0]), (140, [1.0]), (5, [3.0, -4.0])]
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in data], "vec_id long, embedding array<double>, rank int, score double")
    got = {}
    for r in sorted(rows(ann.search(df, df.filter("vec_id % 20 = 0"))), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == {0: [(5, 3.0), (4, 1.0), (4, 1.0), (20, 1.0), (3, 0.5)], 20: [(5, 3.0), (0, 1.0), (4, 1.0), (4, 1.0), (3, 0.5)]}
    assert rows(ann.search(df.limit(0), df)) == [] and rows(ann.search(df, df.limit(0))) == []


def test_ann_copies(spark):
    """Thousands of copies of one vector: the smallest ids win."""
    rng = np.random.default_rng(2)
    v = rng.standard_normal((400, 16))
    data = [(i, v[i].tolist()) for i in range(400)] + [(1000 + i, v[0].tolist()) for i in range(3000)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = [r["vec_id"] for r in sorted(rows(ann.search(df, df.filter("vec_id = 0"))), key=lambda r: r["rank"])]
    best = sorted(((-float(v[0] @ np.array(x)), i) for i, x in data if i != 0))[:20]
    assert got == [i for _, i in best]


def test_ann_rows(spark):
    """Repeated query rows ask once; vectors of each length are searched among themselves."""
    data = [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [1.0, 0.0, 2.0]), (7, [0.5, 0.0, 1.0]), *((k, [1.0 / k, 1.0]) for k in range(101, 140))]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(rows(ann.search(df, df.filter("vec_id % 20 = 0"))), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got[20] == list(range(101, 121)) and got[40] == [7]
    assert got[120] == list(range(101, 120)) + [121]


@pytest.mark.parametrize("kind", ["even", "clustered"])
def test_ann_blocks(spark, tmp_path, monkeypatch, kind):
    """Recall over many blocks and several chunks of queries, and how many vectors are verified."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    monkeypatch.setattr(ann, "CHUNK_ROWS", 100)
    rng = np.random.default_rng(7)
    n = 50_000
    v = rng.standard_normal((n, 64))
    if kind == "clustered":
        v = v * 0.3 + rng.standard_normal((200, 64))[rng.integers(0, 200, n)]
    v[1000:1400] = v[999]
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": pa.array(list(v), pa.list_(pa.float32()))}), f"{tmp_path}/v.parquet")
    df = spark.read.parquet(f"{tmp_path}/v.parquet")
    index = ann.build_index(df)
    got = {}
    for r in sorted(rows(ann.search_index(index, df.filter("vec_id % 200 = 0"))), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    x, hit = v.astype(float), 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -9
        order = np.lexsort((np.arange(n), -np.round(s, 12)))[:20]
        assert len(found) == 20 and all(abs(score - s[i]) < 1e-12 for i, score in found) and found == sorted(found, key=lambda f: (-f[1], f[0]))
        hit += len(set(order.tolist()) & {i for i, _ in found})
    assert len(got) == n // 200 and hit / (20 * len(got)) >= 0.9
    # A search as it runs: the query's own block first, then, with its bound, the others.
    top = ann.Top.read(bytes(index.filter("block = -1").first()["body"]))
    blocks = [(r["cell"], ann.Block.read(r["body"])) for r in index.filter("block >= 0").collect()]
    assert sum(len(b.ids) for _, b in blocks) == n and len(blocks) >= 7 and len({c for c, _ in blocks}) == len(blocks)
    gauss, stop = ann._directions(64, 16, 42), ann.chi_square_quantile(0.9, 16)
    ids = np.arange(0, n, 2000)
    q, points = x[ids], x[ids] @ gauss[:-1]
    home, carried, verified, came = top.cells(points), ann.Carried(len(ids), 20), 0, 0
    for cell, b in blocks:
        verified += sum(v for _, _, v in ann.ask(b, home == cell, ids, q, points, carried, 20, stop))
    for cell, b in blocks:
        for _, hits, v in ann.ask(b, home != cell, ids, q, points, carried, 20, stop):
            verified, came = verified + v, came + len(hits)
    share = verified / (n * 25)
    print(f"{kind}: recall {hit / (20 * len(got)):.3f}, verified {share:.3f}, rows a query from other blocks {came / 25:.1f} of {len(blocks)} blocks")
    assert share < (0.5 if kind == "even" else 0.1)


def test_pii(docs, none):
    got = rows(pii.find(docs))
    assert len(got) == len(ITEMS) and {r["spans"] for r in got} == {""} and rows(pii.find(none)) == []


def test_pii_terms(spark):
    """A word that only stands beside one address gives it away; common words don't."""
    texts = [f"common words here secretname a{k % 2}@x.org more common words" if k < 6 else f"common words here and more number {k}" for k in range(60)]
    texts = [t.replace("secretname", f"secretname{k % 2}") for k, t in enumerate(texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in rows(pii.find(df))}
    assert got[0] == "term:18:29,email:30:38" and got[10] == ""
    clean = {r["doc_id"]: r["text"] for r in rows(pii.sanitised(df))}
    assert clean[0] == "common words here  [EMAIL] more common words" and clean[10] == texts[10]


def test_pii_whole_documents(spark):
    """A term far from its entity discloses it as one beside it does, at every place in the documents; long words don't hide it."""
    far, long = " ".join(["common"] * 40), "x" * 300
    texts = [f"faraway {far}. {long} near a@x.org {far} faraway" if k < 4 else f"{far} {long} near number" for k in range(40)]
    made = [(None if k == 3 else k, t) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    last = len(texts[0])
    for i in (0, 1, 2, None):
        spans = got[i]["spans"].split(",")
        assert "term:0:7" in spans and f"term:{last - 7}:{last}" in spans
        assert got[i]["n_term"] == 3 and "near" not in {texts[0][int(s.split(":")[1]) : int(s.split(":")[2])] for s in spans}
    assert got[10]["spans"] == ""


def test_pii_long_words(spark):
    """Terms are found however far from the entity and however long the words between; copies under one id and under two count alike."""
    long = "x" * 1000
    texts = [f"telling{k % 2} {long} {long} {long} some words a{k % 2}@x.org" if k < 8 else f"some words {long} {k}" for k in range(80)]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"].split(",")[0] for r in rows(pii.find(df))}
    assert {got[k] for k in range(8)} == {"term:0:8"} and got[20] == ""
    shared = spark.createDataFrame([(None if k % 3 == 0 else 4, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert Counter(r["spans"].split(",")[0] for r in rows(pii.find(shared))) == Counter(got.values())
    assert Counter(r["text"] for r in rows(pii.sanitised(shared))) == Counter(r["text"] for r in rows(pii.sanitised(df)))


def test_pii_copies_are_no_evidence(spark):
    """Without copies as evidence, a text that stands often tells nothing; words that stand with an address in different texts do."""
    far = [f"plain words number {k}" for k in range(60)]
    twice = ["onlyhere rareword once@x.org plain words"] * 3
    told = [f"Secretname wrote {k} times to known@x.org" for k in range(3)]
    df = spark.createDataFrame(list(enumerate(far + twice + told)), "doc_id long, text string")
    with_copies = {r["doc_id"]: r["n_term"] for r in rows(pii.find(df))}
    got = {r["doc_id"]: r["spans"] for r in rows(pii.find(df, copies=False))}
    assert with_copies[60] >= 2 and got[60] == got[62] == "email:18:28"
    assert got[63].startswith("term:0:10,") and got[5] == ""


@pytest.mark.parametrize("support", [1, 2, 3])
def test_pii_different_texts_plain(spark, support):
    """Support by different texts against a plain count, with copies and null ids."""
    import math
    import random

    rng, texts = random.Random(10 + support), []
    for k in range(100):
        words = [rng.choice("abcdefghij") + str(rng.randint(0, 3)) for _ in range(rng.randint(1, 10))]
        for who in rng.sample(range(6), rng.choice([0, 0, 1, 2])):
            words += [f"u{who}@m.org"] + [f"name{who}"] * (rng.random() < 0.8)
        texts.append(" ".join(words))
    texts += texts[:30] * 2
    split = [(t, {w for w in t.split() if "@" in w}, set(t.split())) for t in texts]
    n, telling = len(texts), set()
    for e in set().union(*(s[1] for s in split)):
        e_df = sum(e in s[1] for s in split)
        for t in set().union(*(s[2] for s in split)):
            both = [s[0] for s in split if e in s[1] and t in s[2]]
            if len(set(both)) >= support and n > e_df and math.log2(len(both) * n / (sum(t in s[2] for s in split) * e_df)) >= 0.9 * math.log2(n / e_df):
                telling.add((t, e))
    want = Counter()
    for k, (text, own, _) in enumerate(split):
        want[None if k % 7 == 0 else k, sum(any((w, e) in telling for e in own) for w in text.split() if w not in own)] += 1
    df = spark.createDataFrame([(None if k % 7 == 0 else k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert Counter((r["doc_id"], r["n_term"]) for r in rows(pii.find(df, support=support, copies=False))) == want
    assert any(c for _, c in want)


@pytest.mark.parametrize("support", [1, 2])
def test_pii_terms_plain(spark, support):
    """Terms against a plain count over random documents, with copies, repeated ids and null ids."""
    import math
    import random

    rng, texts = random.Random(support), []
    for k in range(120):
        words = [rng.choice("abcdefghij") + str(rng.randint(0, 3)) for _ in range(rng.randint(0, 12))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            who = rng.randint(0, 6)
            words.insert(rng.randint(0, len(words)), f"u{who}@m.org")
            if rng.random() < 0.8:
                words.insert(rng.randint(0, len(words)), f"Name{who}")
        texts.append(" ".join(words))
    texts += texts[:30]
    ids = [None if k % 11 == 0 else k % 50 for k in range(len(texts))]
    entity = [{w for w in t.split() if "@" in w} for t in texts]
    terms = [{w.lower() for w in t.split()} for t in texts]
    n = len(texts)
    telling = set()
    for e in set().union(*entity):
        e_df = sum(e in x for x in entity)
        for t in set().union(*terms):
            co = sum(e in x and t in y for x, y in zip(entity, terms, strict=True))
            if co >= support and n > e_df and math.log2(co * n / (sum(t in y for y in terms) * e_df)) >= 0.9 * math.log2(n / e_df):
                telling.add((t, e))
    want = Counter()
    for i, text, own in zip(ids, texts, entity, strict=True):
        at, spans = 0, []
        for w in text.split(" "):
            if w in own:
                spans.append(f"email:{at}:{at + len(w)}")
            elif any((w.lower(), e) in telling for e in own):
                spans.append(f"term:{at}:{at + len(w)}")
            at += len(w) + 1
        want[i, ",".join(spans)] += 1
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    assert Counter((r["doc_id"], r["spans"]) for r in rows(pii.find(df, support=support))) == want
    assert any("term" in s for _, s in want)


def test_substring_rows(spark):
    """Rows that share an id are judged each by its own words."""
    w, z = " ".join(f"w{k}" for k in range(60)), " ".join(f"z{k}" for k in range(60))
    df = spark.createDataFrame([(1, w), (2, w), (2, z), (2, w), (None, w), (None, z), (3, z), (3, "head " + z)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["kept"], r["n_removed"]) for r in rows(substring.dedup(df))), key=repr)
    assert got == sorted([(1, w, 0), (2, "", 60), (2, "", 60), (2, z, 0), (None, w, 0), (None, z, 0), (3, "", 60), (3, "head", 60)], key=repr)


def test_substring_factors(spark):
    """A factor copies its words from the place that it names."""
    import random

    rng = random.Random(4)
    base = [[f"b{j}x{k}" for k in range(120)] for j in range(4)]
    texts = {}
    for i in range(30):
        t = []
        for _ in range(rng.randint(1, 4)):
            b, a = rng.choice(base), rng.randint(0, 60)
            t += b[a : a + rng.randint(20, 60)] + [f"own{i}"] * rng.randint(0, 2)
        texts[i] = t
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    n = 0
    for r in rows(substring.factors(df)):
        for p in r["pieces"]:
            length = p["n"] + substring.WINDOW - 1
            assert p["source"] < r["doc_id"] and texts[p["source"]][p["source_start"] : p["source_start"] + length] == texts[r["doc_id"]][p["start"] : p["start"] + length]
            n += 1
    assert n > 5


def test_substring(docs, none):
    got = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in rows(substring.digests(docs))}
    assert {(8, 400_000, 0), (9, 400_000, 400_000), (1, 0, 0), (None, 3, 0), (6, 5, 0)} <= got and len(rows(substring.digests(docs))) == len(ITEMS)
    assert rows(substring.digests(none)) == []


def test_pipeline_stages(spark, docs, none, tmp_path):
    """Every stage takes odd rows and none at all, and keeps the columns; clean documents stay."""
    sf = str(tmp_path)
    spark.createDataFrame([(10, 0, 1), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "not in any document at all, this one item")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for source in (docs, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, source, sf)
            assert name == "token_output" or out.columns == source.columns
            out.count()
    kept = {r["doc_id"] for r in rows(corpus_pipeline.STAGES[1][1](spark, docs, sf))}
    assert kept == {None, 1, 4, 5, 6, 7, 8, 10}


def test_pipeline(spark, sf):
    """The pipeline's result against its stages, each by its plain form."""
    from test_contracts import plain_components, plain_distance, plain_fingerprint

    documents = {r["doc_id"]: r for r in rows(spark.read.parquet(f"{sf}/documents.parquet"))}
    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in rows(toxicity.score(spark.read.parquet(f"{sf}/documents.parquet"), model))}
    stay = {i: d for i, d in documents.items() if scores[i] < toxicity.THRESHOLD}
    groups = plain_components({i: plain_fingerprint(d["text"]) for i, d in stay.items()})
    stay = {i: d for i, d in stay.items() if groups[i] == i}
    items = [decontaminate.normal(r["text"]).strip() for r in rows(spark.read.parquet(f"{sf}/benchmark.parquet"))]
    stay = {i: d for i, d in stay.items() if not any(t in decontaminate.normal(d["text"]) for t in items)}
    mixed = rows(mixing.mix(spark.createDataFrame([(i, d["text"], d["source"]) for i, d in stay.items()], "doc_id long, text string, source string")))
    want = sorted(r["doc_id"] for r in mixed for _ in range(r["copies"]))
    result = corpus_pipeline.run(spark, sf)
    got, shards = rows(result), repair.shards_path(result)
    assert sorted(r["doc_id"] for r in got) == want
    assert sorted(map(str, rows(repair.read(spark, shards)))) == sorted(map(str, got))
    assert plain_distance("ab", "xaby") == 0 and set(queries.QUERIES) >= {"op6_repair"}


def test_items_that_begin_alike():
    """Thousands of items with a common beginning: a text is about as quick as with distinct ones, and nothing is lost."""
    import random
    import time

    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    preamble = " ".join(word() for _ in range(40))
    rests = [" ".join(word() for _ in range(60)) for _ in range(3000)]
    alike = decontaminate.Items([(k, f"{preamble} {r}") for k, r in enumerate(rests)])
    apart = decontaminate.Items([(k, f"{' '.join(word() for _ in range(40))} {r}") for k, r in enumerate(rests)])
    typo = rests[7][:50] + "XY" + rests[7][52:]
    text = " ".join([*(word() for _ in range(300)), preamble, typo, *(word() for _ in range(300)), preamble])
    took = []
    for items in (apart, alike):
        start = time.perf_counter()
        found = items.find(text)
        took.append(time.perf_counter() - start)
    assert [f[:2] for f in found] == [(7, 2)]
    assert took[1] < 10 * took[0] + 0.05


def test_number_of_parts():
    """Parts follow the texts' size up to a bound that Spark's bookkeeping can bear."""
    assert [repair.parts_of(n) for n in (0, 1, repair.PART_BYTES, repair.PART_BYTES + 1, 10**14)] == [1, 1, 1, 2, repair.MOST_PARTS]
