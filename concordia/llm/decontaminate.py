"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may stand in a document with up to k = ERRORS * n edits. Cut into k + 1
pieces, at least one piece of it then stands there unchanged. One automaton over all pieces finds the
exact hits in a pass over a text; hits of an item whose places agree to k characters are one candidate,
and Myers' bit-parallel algorithm verifies the whole item on the stretch of text around it.

Texts are compared in lower case with white space characters alike, one character for one, so spans are
code points of the text itself. Items are the query set: they are read in blocks of bounded size, each
sent with the tasks that read all documents.

Items too short for an edit, under 1 / ERRORS characters, are matched exactly and between word boundaries, so
that one word of an item isn't found inside another word.

Defined results: null and blank items are nowhere found, null and empty texts hold none; items without an
item_id are found like any other, and reported with a null one; equal items are each reported; repeated rows are reported each, and rows without a
doc_id with a null one; an item that a document holds several times is reported once, where it has fewest
edits, then first; empty tables give no rows. Texts are whole: the longest is the least that a worker holds.
Other columns, whatever their names, take no part, and clean() passes them on.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_chunks, tidied

#: Edits for each character of an item; characters of items in a block, whose automaton takes some 60 bytes for each.
ERRORS, BLOCK_CHARS = 0.06, 2 << 20
#: Other items with the same beginning, or end, beyond which pieces are cut elsewhere; and characters of such a piece at least.
CROWD, LEAST_PIECE = 16, 8


def normal(text: str) -> str:
    """Lower case and plain spaces, one character for each character."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for c in "\t\n\x0b\x0c\r\xa0":
        if c in low:
            low = low.replace(c, " ")
    return low


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """(fewest edits, end in text of the first such match) of pattern anywhere in text, if at most most."""
    m = len(pattern)
    mask, high = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for k, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << k
    plus, minus, edits = mask, 0, m
    best = (m, 0) if m <= most else None
    for at, c in enumerate(text, 1):
        eq = where.get(c, 0)
        across = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(across | plus) & mask
        down = plus & across
        if up & high:
            edits += 1
        elif down & high:
            edits -= 1
        up = up << 1 & mask  # a match may begin anywhere: the top row costs nothing
        down = down << 1 & mask
        vertical = eq | minus
        plus = down | ~(vertical | up) & mask
        minus = up & vertical
        if edits <= most and (best is None or edits < best[0]):
            best = (edits, at)
    return best


def _bounded(text: str, start: int, end: int) -> bool:
    """Whether neither end of text[start:end] lies inside a word."""
    inside = lambda at: 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()
    return not inside(start) and not inside(end)


def _shared(texts: list[str], crowd: int = CROWD) -> list[int]:
    """For each text the length of the beginning that crowd other texts have too."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    same = lambda a, b: len(os.path.commonprefix([texts[a], texts[b]]))
    out = [0] * len(texts)
    # Of texts in order, any crowd + 1 in a row share what the first and the last of them do.
    for at in range(len(order) - crowd):
        n = same(order[at], order[at + crowd])
        for k in order[at : at + crowd + 1]:
            out[k] = max(out[k], n)
    return out


class Items:
    """A block of test items and the automaton over their pieces.

    Any budget + 1 pieces of an item that don't overlap will do. Where many items begin or end alike, as
    questions of one set do, the pieces are cut from what is between: else a document with the common
    words would have every such item verified against it.
    """

    def __init__(self, items: list[tuple[int | None, str]], errors: float = ERRORS):
        self.ids, self.texts, self.budgets = [i for i, _ in items], [t for _, t in items], [int(errors * len(t)) for _, t in items]
        pieces: dict[str, list[tuple[int, int]]] = {}
        heads, tails = _shared(self.texts), _shared([t[::-1] for t in self.texts])
        for k, (text, budget) in enumerate(zip(self.texts, self.budgets, strict=True)):
            lo, hi = heads[k], len(text) - tails[k]
            if hi - lo < LEAST_PIECE * (budget + 1):
                lo, hi = 0, len(text)
            cuts = [lo + (hi - lo) * j // (budget + 1) for j in range(budget + 2)] if budget else [0, len(text)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                pieces.setdefault(text[a:b], []).append((k, a))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item's id, edits, start, end) of each item that the text holds."""
        if self.empty:
            return []
        text = normal(text)
        begins: dict[int, set[int]] = {}
        for end, (length, places) in self.automaton.iter(text):
            for k, a in places:
                begins.setdefault(k, set()).add(end + 1 - length - a)
        out = []
        for k, places in begins.items():
            found = self._verify(k, text, sorted(places))
            if found:
                out.append((self.ids[k], *found))
        return out

    def _verify(self, k: int, text: str, begins: list[int]) -> tuple[int, int, int] | None:
        item, budget = self.texts[k], self.budgets[k]
        if not budget:  # the one piece is the item
            return next(((0, b, b + len(item)) for b in begins if _bounded(text, b, b + len(item))), None)
        for b in begins:
            if b >= 0 and text.startswith(item, b):
                return 0, b, b + len(item)
        best: tuple[int, int, int] | None = None
        lo = begins[0]
        for b, after in zip(begins, [*begins[1:], None], strict=True):
            # Candidates whose stretches overlap are verified as one, up to a few items' length at once.
            if after is not None and after - b <= budget and after - lo <= 4 * len(item):
                continue
            at = max(0, lo - budget)
            stretch = text[at : b + len(item) + budget]
            hit = myers(item, stretch, budget)
            if hit and (best is None or hit[0] < best[0]):
                end = at + hit[1]
                # Where the match begins: the same search backwards from its end.
                back = myers(item[::-1], text[max(0, end - len(item) - budget) : end][::-1], hit[0])
                best = (hit[0], end - back[1] if back else max(0, end - len(item)), end)
            if after is not None:
                lo = after
        return best


_BLOCKS: dict[str, Items] = {}


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of bounded size, read one row at a time."""
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text is not null").toLocalIterator():
        text = normal(row["text"]).strip()
        if not text:
            continue
        held.append((row["item_id"], text))
        size += len(text)
        if size >= BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _items(key: str, block: list[tuple[int, str]], errors: float) -> Items:
    """This worker's automaton of a block; the last one is kept."""
    if key not in _BLOCKS:
        _BLOCKS.clear()
        _BLOCKS[key] = Items(block, errors)
    return _BLOCKS[key]


def matches(docs: DataFrame, benchmark: DataFrame, *, errors: float = ERRORS) -> DataFrame:
    """(doc_id, item_id, edits, start, end): test items that documents hold."""
    spark, schema = docs.sparkSession, "doc_id long, item_id long, edits int, start long, end long"
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = None
    for block in blocks(benchmark):
        # A block goes with the tasks; Spark lets go of it with the plan.
        def scan(batches: Iterator[pa.RecordBatch], key=uuid.uuid4().hex, block=block) -> Iterator[pa.RecordBatch]:
            items = _items(key, block, errors)
            for batch in batches:
                for lo, _, raw, offs in text_chunks(batch.column(1)):
                    data, rows = raw.tobytes(), []
                    for k, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
                        rows += [(lo + k, *hit) for hit in items.find(data[a:b].decode("utf-8", "replace"))]
                    if rows:
                        at, item, edits, start, end = zip(*sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2:])), strict=True)
                        yield pa.record_batch([batch.column(0).take(pa.array(at)), pa.array(item, pa.int64()), pa.array(edits, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["doc_id", "item_id", "edits", "start", "end"])

        part = own.mapInArrow(tidied(scan), schema)
        found = part if found is None else found.union(part)
    return found if found is not None else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, *, errors: float = ERRORS) -> DataFrame:
    """docs without the rows whose text holds a test item; one pass, and no shuffle, for each block of items."""
    at = docs.columns.index("text")
    for block in blocks(benchmark):

        def scan(batches: Iterator[pa.RecordBatch], key=uuid.uuid4().hex, block=block) -> Iterator[pa.RecordBatch]:
            items = _items(key, block, errors)
            for batch in batches:
                for lo, hi, raw, offs in text_chunks(batch.column(at)):
                    data = raw.tobytes()
                    keep = [not items.find(data[a:b].decode("utf-8", "replace")) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
                    yield batch.slice(lo, hi - lo).filter(pa.array(np.array(keep, bool)))

        docs = docs.mapInArrow(tidied(scan), docs.schema)
    return docs
