"""Personal data: base spans by pattern, and terms that reveal them by corpus co-occurrence.

Base spans are protected entities. A term in an entity's documents discloses it by its pointwise mutual
information with it, log2(p(term, entity) / (p(term) p(entity))), measured against the entity's own
information, -log2 p(entity): at 1, whoever reads the term knows the entity. Probabilities are shares
of documents, counted over the whole corpus. A pair that co-occurs in enough documents and whose share
reaches the threshold is disclosing: all of the term's occurrences in documents with the entity become
spans of kind "term", which are removed; base spans are generalised to their kind.

Offsets are code points, ends exclusive. The patterns are matched so that no text takes more than
linear time: an e-mail is found from its @ backwards, digits are never tried twice.

Counts and spans follow texts, not ids: rows of equal texts have equal spans, whatever their ids, and each
row counts as a document in all counts, those of terms, of entities, of pairs and of the whole. Whether copies of
one text are evidence is a choice: with copies=False a pair must co-occur in enough different texts, so that a text
that stands twice doesn't make each of its rare words telling; shares of documents stay shares of rows.

Defined results: a null text is empty and has no spans; rows without a doc_id and rows that share one are
documents of their own; of spans that begin together base ones come first, by kind; an empty table gives no
rows; a text is never cut, so the longest one is the least that a worker holds; other columns, whatever
their names, take no part, and sanitised() passes them on.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_chunks, tidied, word_bounds, word_hashes

#: Fixed order of kinds.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# Fixed patterns of the contract, in linear form: possessive where nothing that follows can be given back to.
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPACES = frozenset(" \t\n\x0b\x0c\r")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            yield begin, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end), sorted."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    found.sort()
    return found


def _written(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _hashes(words: list[str]) -> np.ndarray:
    """Term hashes of words, the same as in the corpus counts."""
    if not words:
        return np.zeros(0, np.int64)
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = word_bounds(raw, np.array([0, len(raw)]))
    return word_hashes(_LOWER[raw], starts, ends).view(np.int64)


def _text_key(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _entities(text: str, spans) -> list[int]:
    """The distinct entities of a text, as hashes."""
    return sorted({int.from_bytes(hashlib.blake2b(f"{kind}:{text[a:b].lower()}".encode(), digest_size=8).digest(), "little", signed=True) for a, kind, b in spans})


def _words(text: str, spans) -> list[dict]:
    """Every word of a text that no span touches: term hash, start, stop."""
    out, at = [], 0
    reached = np.maximum.accumulate([b for _, _, b in spans])  # spans are sorted by start
    words = list(_WORD.finditer(text))
    for m, h in zip(words, _hashes([m[0] for m in words]), strict=True):
        while at < len(spans) and spans[at][0] < m.end():
            at += 1
        if not at or reached[at - 1] <= m.start():
            out.append({"term": int(h), "start": m.start(), "stop": m.end()})
    return out


SCAN = "doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, entities array<long>, words array<struct<term:long,start:int,stop:int>>, term long, df long"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("base", pa.string()),
    ("entities", pa.list_(pa.int64())), ("words", pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())]))), ("term", pa.int64()), ("df", pa.int64()),
])
#: Distinct terms that a worker counts before it hands them on.
COUNTED = 1 << 20


def _scan():
    def counted(parts: list) -> pa.RecordBatch:
        terms, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n = np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
        own = {"term": pa.array(terms.view(np.int64)), "df": pa.array(n)}
        return pa.record_batch([own.get(f.name, pa.nulls(len(terms), f.type)) for f in _ARROW], schema=_ARROW)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, raw, offs in text_chunks(batch.column(1)):
                starts, ends, before = word_bounds(raw, offs)
                hashes = word_hashes(_LOWER[raw], starts, ends)
                doc = np.repeat(np.arange(hi - lo, dtype=np.uint64), np.diff(before))
                # One entry for each term of a document: sorted by term, then document.
                order = np.lexsort((doc, hashes))
                h, d = hashes[order], doc[order]
                first = np.ones(len(h), bool)
                first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                terms, n = np.unique(h[first], return_counts=True)
                parts.append((terms, n.astype(np.float64)))
                held += len(terms)
                if held > COUNTED:
                    merged = counted(parts)
                    if merged.num_rows * 2 > COUNTED:
                        yield merged
                        parts, held = [], 0
                    else:
                        parts = [(merged.column("term").to_numpy().view(np.uint64), merged.column("df").to_numpy().astype(np.float64))]
                        held = merged.num_rows
                yield _documents(ids.slice(lo, hi - lo), raw, offs)
        if parts:
            yield counted(parts)

    return scan


def _documents(ids: pa.Array, raw: np.ndarray, offs: np.ndarray) -> pa.RecordBatch:
    data = raw.tobytes()
    rows: dict[str, list] = {f.name: [] for f in _ARROW}
    for k in range(len(ids)):
        own = data[offs[k] : offs[k + 1]]
        text = own.decode("utf-8", "replace")
        spans = base_spans(text)
        named = _written((a, KINDS[k], b) for a, k, b in spans)
        for kind, name in enumerate(KINDS):
            rows[f"n_{name}"].append(sum(s[1] == kind for s in spans))
        rows["text_key"].append(_text_key(own) if spans else None)
        rows["base_sha256"].append(hashlib.sha256(named.encode()).hexdigest())
        rows["base"].append(named)
        rows["entities"].append(_entities(text, spans) if spans else None)
        rows["words"].append(_words(text, spans) if spans else None)
    own = {"doc_id": ids.cast(pa.int64())}
    none = len(ids)
    return pa.record_batch([own[f.name] if f.name in own else pa.nulls(none, f.type) if f.name in ("term", "df") else pa.array(rows[f.name], f.type) for f in _ARROW], schema=_ARROW)


def find(docs: DataFrame, *, support: int = 2, threshold: float = 0.9, copies: bool = True) -> DataFrame:
    """One row per document: doc_id, n_<kind>, base_sha256, spans, n_term, text_key.

    text_key: 64 bits of the text's digest, null where it has no spans. support: documents in which a pair must co-occur, wherever in them. threshold: share of the entity's
    information that a term must give away. copies: whether rows of equal texts count each as support, or as one.
    """
    scanned = staged(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(_scan()), SCAN), "pii")
    rows = scanned.filter(F.col("base_sha256").isNotNull())
    total = rows.count()
    # Copies of a text have the same entities and words: each text is opened once, with its number of rows.
    held = rows.filter(F.col("text_key").isNotNull())
    asked = held.select("text_key", F.explode("entities").alias("entity")).groupBy("text_key", "entity").agg(F.count(F.lit(1)).alias("n"))
    # A pair is in no more documents than its entity, so entities without support have none.
    evidence = F.sum("n") if copies else F.count(F.lit(1))  # a row for each different text here, and of each pair below
    entities = asked.groupBy("entity").agg(F.sum("n").alias("entity_df"), evidence.alias("seen")).filter(F.col("seen") >= support).drop("seen")
    asked = asked.join(entities, "entity")
    words = held.join(asked.select("text_key").distinct(), "text_key", "left_semi").select("text_key", F.inline("words")).distinct()
    words = staged(words, "pii_words")
    asked = staged(asked, "pii_entities")
    # A term tells of an entity only if it is rare enough itself, as a pair is in no more documents than its
    # entity: its information must reach the threshold's share of the entity's. That leaves the common words of
    # a text out before terms and entities meet, and a text's pairs are compared, not written out.
    information = lambda n: F.log2(F.lit(float(max(total, 1))) / F.col(n))
    asked = asked.withColumn("needed", threshold * information("entity_df"))
    # Each text has a bound of its own, so one common entity doesn't let common words in everywhere.
    bounds = asked.groupBy("text_key").agg(F.min("needed").alias("least"))
    held = words.select("text_key", "term").distinct()
    # A pair is in no more documents than its term, nor in more texts. Counts are summed before they meet the terms asked for.
    own = held.groupBy("term").agg(F.count(F.lit(1)).alias("seen"))
    terms = scanned.filter(F.col("term").isNotNull() & F.col("doc_id").isNull() & F.col("base_sha256").isNull()).groupBy("term").agg(F.sum("df").alias("term_df"))
    enough = F.col("term_df") if copies else F.col("seen")
    terms = terms.join(own, "term").filter(enough >= support).select("term", "term_df", information("term_df").alias("information"))
    rare = held.join(terms, "term").join(bounds, "text_key").filter(F.col("information") >= F.col("least") - 1e-9).drop("least")
    near = rare.join(asked, "text_key").filter(F.col("information") >= F.col("needed") - 1e-9)
    counted = near.groupBy("term", "entity", "entity_df", "term_df").agg(F.sum("n").alias("co"), evidence.alias("seen")).filter(F.col("seen") >= support)
    shared = F.log2(F.col("co") * F.lit(float(total)) / (F.col("term_df") * F.col("entity_df")))
    own = F.log2(F.lit(float(total)) / F.col("entity_df"))
    telling = counted.filter((own > 0) & (shared >= threshold * own)).select("term", "entity")
    marked = asked.join(telling, "entity").select("text_key", "term").distinct()
    added = words.join(marked, ["text_key", "term"]).groupBy("text_key").agg(F.collect_set(F.struct("start", F.col("stop").alias("end"))).alias("terms"))
    out = rows.select("doc_id", "text_key", *[f"n_{k}" for k in KINDS], "base_sha256", "base")
    plain = out.filter(F.col("text_key").isNull()).withColumn("terms", F.lit(None).cast("array<struct<start:int,end:int>>"))
    out = plain.unionByName(out.filter(F.col("text_key").isNotNull()).join(added, "text_key", "left").select(*plain.columns))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", _all_spans("base", "terms").alias("spans"), F.coalesce(F.size("terms"), F.lit(0)).cast("long").alias("n_term"), "text_key")


def _all_spans(base: str, terms: str) -> F.Column:
    """Base spans and added ones in one string, by start; at the same start base spans first."""
    part = lambda x, k: F.split_part(x, F.lit(":"), F.lit(k))
    own = F.when(F.col(base) != "", F.transform(F.split(base, ","), lambda x, i: F.struct(part(x, 2).cast("int").alias("at"), i.alias("place"), x.alias("span"))))
    none = F.array().cast("array<struct<at:int,place:int,span:string>>")
    more = F.transform(F.col(terms), lambda x: F.struct(x["start"].alias("at"), F.lit(1 << 30).alias("place"), F.concat_ws(":", F.lit(TERM), x["start"].cast("string"), x["end"].cast("string")).alias("span")))
    both = F.concat(F.coalesce(own.cast("array<struct<at:int,place:int,span:string>>"), none), F.coalesce(more.cast("array<struct<at:int,place:int,span:string>>"), none))
    return F.when(F.size(both) == 0, "").otherwise(F.array_join(F.transform(F.sort_array(both), lambda x: x["span"]), ","))


def sanitise(text: str, spans: str) -> str:
    """The text with base spans generalised to their kind and disclosing terms removed."""
    out, done = [], 0
    for item in filter(None, spans.split(",")):
        kind, a, b = item.split(":")
        a, b = int(a), int(b)
        if b <= done:
            continue
        out += [text[done : max(a, done)], "" if kind == TERM else f"[{kind.upper()}]"]
        done = b
    return "".join(out) + text[done:]


def sanitised(docs: DataFrame, **options) -> DataFrame:
    """Documents with their texts sanitised. Spans are those of the text, so they are looked up by its key."""
    spans = find(docs, **options).filter("text_key is not null").groupBy("text_key").agg(F.first("spans").alias("__spans"))

    @F.pandas_udf("long")
    def key(texts):
        return pd.Series([None if t is None or not base_spans(t) else _text_key(t.encode("utf-8", "replace")) for t in texts], dtype="Int64")

    @F.pandas_udf("string")
    def clean(texts, all_spans):
        return texts.combine(all_spans, lambda t, s: t if t is None or s is None else sanitise(t, s))

    joined = docs.withColumn("__key", key(F.col("text").cast("string"))).join(spans.withColumnRenamed("text_key", "__text_key"), F.col("__key") == F.col("__text_key"), "left")
    return joined.withColumn("text", clean("text", "__spans")).select(*docs.columns)
