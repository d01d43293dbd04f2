"""Periodic runs: stretches of words that repeat with a fixed distance at least three times.

A run of period q and length L >= max(24, 3q) has L - q words whose like stands q further on, and
L - q >= max(16, 2q). Of those words every block size B, a power of two with B <= q < 2B (B = 8 for all
q below 16), has at least one aligned block, as any 2B - 1 words have. So for each B the aligned blocks
of a document, or their first 64 words, are the keys of an automaton over word numbers, which the document
is searched with; an occurrence at a distance of that scale is a seed, extended word by word to both sides.
No run is missed.

What is not searched, by proof:
- Words whose next like is 2B or more away can't be in a run of the scale, so only stretches of at least 2B
  words with nearer ones are looked at. Prose has next to none.
- A whole block that lies three blocks deep in a run of period p <= B has, within the scale, only occurrences
  at multiples of p, which extend to that same run. Long runs are searched at their own scale only.
- A seed whose two sides lie in different runs of one period p, at most half a key, stops where the nearer
  run ends, short of three periods, unless the runs' starts or ends are as far apart as the seed's sides.
A stretch is searched in segments of a bounded number of words, so that automata stay small.

A stretch has the smallest of its periods: those that divide it are found at the same place before it.

Defined results: null and empty texts have no runs and an empty collapsed text; rows are judged alone, so
repeated rows and rows that share an id, or have none, have each their own; of runs with equal exponents
the first, then that of the smallest period is best; an empty table gives no rows; a text is never cut, so
the longest is the least that a worker holds; other columns, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, text_chunks, tidied

#: Words of a run, and times that its period stands in it, at least. The proof above needs these or more.
LEAST_WORDS, LEAST_TIMES = 24, 3
#: The smallest block, the words of a key at most, and words of an automaton's segment.
FIRST_BLOCK, KEY_WORDS, SEGMENT = 8, 64, 1 << 16


class Run(NamedTuple):
    start: int
    length: int
    period: int


def _next_like(ids: np.ndarray) -> np.ndarray:
    """For each word the distance to its next like, or the text's length."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    gaps = np.full(n, n, np.int64)
    same = ids[order[1:]] == ids[order[:-1]]
    gaps[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gaps


def _stretches(mask: np.ndarray, least: int) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= least]


def _agree(ids: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from a and from b > a on are the same, going right (step 1) or left (-1)."""
    room = len(ids) - b if step > 0 else a + 1
    done, size = 0, 32
    while done < room:
        m = min(size, room - done)
        if step > 0:
            differ = ids[a + done : a + done + m] != ids[b + done : b + done + m]
        else:
            differ = (ids[a - done - m + 1 : a - done + 1] != ids[b - done - m + 1 : b - done + 1])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, size = done + m, size * 2
    return room


def _seeds(ids: np.ndarray, starts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of the occurrences, at distances of the scale, of the aligned blocks at the starts."""
    near, far = (1, 2 * FIRST_BLOCK - 1) if block == FIRST_BLOCK else (block, 2 * block - 1)
    width = min(block, KEY_WORDS)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # Blocks whose reach overlaps are one stretch, cut into segments.
    breaks = np.flatnonzero((np.diff(starts) > 2 * block)) + 1
    for group in np.split(starts, breaks):
        for lo in range(0, len(group), max(4, SEGMENT // block)):
            own = group[lo : lo + max(4, SEGMENT // block)]
            base, end = int(own[0]), min(len(ids), int(own[-1]) + 3 * block)
            words = tuple(ids[base:end].tolist())
            trie, kinds = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE), {}
            kind_at = np.full((end - base) // block + 1, -1, np.int64)
            for j in (own - base).tolist():
                key = words[j : j + width]
                kind = kinds.setdefault(key, len(kinds))
                kind_at[j // block] = kind
                trie.add_word(key, kind)
            trie.make_automaton()
            hits = np.array(list(trie.iter(words)), np.int64).reshape(-1, 2)
            place, kind = hits[:, 0] - width + 1, hits[:, 1]
            at = (place - near) // block * block  # the last aligned block that is near enough
            for back in range(0, far - near + 1, block):
                j = at - back
                good = (j >= 0) & (place - j <= far)
                good[good] = kind_at[j[good] // block] == kind[good]
                found.append((j[good] + base, (place - j)[good]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


class _Known:
    """Runs found so far, to be asked which of them holds a stretch."""

    def __init__(self, runs: dict[tuple[int, int], int], most: int):
        """most: the longest period of the runs that are asked."""
        self.run = np.array([(s, e, p) for (s, e), p in sorted(runs.items()) if p <= most], np.int64).reshape(-1, 3)
        if len(self.run):
            last = np.maximum.accumulate(self.run[:, 1])
            self.longest = np.maximum.accumulate(np.where(self.run[:, 1] == last, np.arange(len(self.run)), 0))

    def holding(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The run that ends last of those that start no later, where it holds the stretch; else -1.

        Where the periods of two runs add up to the stretch's length or less, no more than one holds it.
        """
        if not len(self.run):
            return np.full(len(start), -1)
        at = np.searchsorted(self.run[:, 0], start, "right") - 1
        own = self.longest[np.maximum(at, 0)]
        return np.where((at >= 0) & (self.run[own, 1] >= end), own, -1)


def _settled(runs: dict[tuple[int, int], int], j: np.ndarray, q: np.ndarray, block: int) -> np.ndarray:
    """Which seeds can't give a run that isn't known."""
    width = min(block, KEY_WORDS)
    known = _Known(runs, block)
    own = known.holding(j, j + q + width)
    settled = own >= 0
    period = known.run[own[settled], 2]
    settled[settled] = (q[settled] % period == 0) & (period < q[settled])
    short = _Known(runs, width // 2)
    one, other = short.holding(j, j + width), short.holding(j + q, j + q + width)
    two = (one >= 0) & (other >= 0) & (one != other)
    a, b = short.run[one[two]], short.run[other[two]]
    settled[two] |= (a[:, 2] == b[:, 2]) & (b[:, 0] - a[:, 0] != q[two]) & (b[:, 1] - a[:, 1] != q[two])
    return settled


def find_runs(ids: np.ndarray, *, words: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[Run]:
    """All runs of a sequence of word numbers, by start, then period."""
    if words < LEAST_WORDS or times < LEAST_TIMES:
        raise ValueError(f"blocks find all runs of at least {LEAST_WORDS} words and {LEAST_TIMES} periods, not shorter ones")
    n = len(ids)
    runs: dict[tuple[int, int], int] = {}
    if n < words:
        return []
    gaps = _next_like(ids)
    block = FIRST_BLOCK
    while block == FIRST_BLOCK or times * block <= n:
        stretches = _stretches(gaps < 2 * block, 2 * block)
        settled = np.zeros(n + 1, np.int64)
        for (s, e), p in runs.items():
            if p <= block and e - 3 * block >= s:
                settled[s] += 1
                settled[e - 3 * block + 1] -= 1
        deep = np.cumsum(settled) > 0
        starts = [np.arange(-(-a // block) * block, b - block + 1, block) for a, b in stretches]
        open_ = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        open_ = open_[~deep[open_]]
        if len(open_):
            j, q = _seeds(ids, open_, block)
            width = min(block, KEY_WORDS)
            fresh = ~_settled(runs, j, q, block)
            j, q = j[fresh], q[fresh]
            order = np.lexsort((j, q))
            j, q = j[order], q[order]
            edges = np.flatnonzero(np.diff(q, prepend=-1, append=-1))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                period, own, k = int(q[a]), j[a:b], 0
                while k < len(own):
                    seed = int(own[k])
                    start = seed - _agree(ids, seed - 1, seed + period - 1, -1)
                    end = seed + period + width + _agree(ids, seed + width, seed + period + width, 1)
                    if end - start >= max(words, times * period):
                        runs.setdefault((start, end), period)
                    k = max(k + 1, int(np.searchsorted(own, end - period - width, "right")))
        block *= 2
    return sorted((Run(s, e - s, p) for (s, e), p in runs.items()), key=lambda r: (r.start, r.period))


def best_run(runs: list[Run]) -> Run | None:
    """The run of the greatest exponent; of equal ones the first, then that of the smallest period."""
    return min(runs, key=lambda r: (-Fraction(r.length, r.period), r.start, r.period), default=None)


def repeated_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stand in a run behind its first period."""
    edge = np.zeros(n + 1, np.int64)
    for r in runs:
        edge[r.start + r.period] += 1
        edge[r.start + r.length] -= 1
    return np.cumsum(edge[:-1]) > 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN = "struct<start:long,length:long,period:long>"


def collapse(docs: DataFrame, *, words: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """One row for each row of docs: doc_id, runs, best (null without runs), collapsed.

    collapsed: the words that no run holds behind its first period, joined by spaces.
    """
    find_runs(np.zeros(0, np.int64), words=words, times=times)  # refuses limits here rather than in a task

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offs in text_chunks(batch.column(1)):
                data, all_runs, best, collapsed = raw.tobytes(), [], [], []
                for k in range(hi - lo):
                    own, numbers = data[offs[k] : offs[k + 1]].split(), {}  # bytes: ASCII space only
                    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), np.int64, len(own))
                    runs = find_runs(ids, words=words, times=times) if len(numbers) < len(own) else []
                    if runs:
                        gone = repeated_words(len(own), runs)
                        own = [w for w, g in zip(own, gone.tolist(), strict=True) if not g]
                    top = best_run(runs)
                    all_runs.append([r._asdict() for r in runs])
                    best.append(None if top is None else top._asdict())
                    collapsed.append(b" ".join(own).decode("utf-8", "replace"))
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(all_runs, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(collapsed, pa.string())]
                yield pa.record_batch(columns, names=["doc_id", "runs", "best", "collapsed"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(tidied(scan), f"doc_id long, runs array<{RUN}>, best {RUN}, collapsed string")


def with_planted(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with the query's planted repeats: of one document in ten the words from a on repeat with period p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0))
    n = F.greatest(F.size(words), F.lit(1))
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    copies = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(copies, F.lit(1), n - a)), " ")
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """collapse's rows as the numbers and checksums of the query."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    milli = (F.lit(1000) * F.col("best.length") - (F.lit(1000) * F.col("best.length")) % F.col("best.period")) / F.col("best.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        milli.cast("long").alias("exponent_milli"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
