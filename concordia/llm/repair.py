"""Token ids in files compressed by Re-Pair, a grammar for each shard.

A shard is some consecutive documents in ascending order of id. Its pairs of neighbouring symbols are counted
exactly, and the most frequent are replaced by new nonterminals, again and again and never across documents,
until no pair is left with LEAST_USES uses. (A rule takes some 8 bytes and a use of it saves 2; rules of fewer
uses make symbols a bit wider, and with them shards came out larger.) A round takes all pairs with at least a
SHARE-th of the largest count; where two of them overlap the more frequent one wins.

A shard stores its rules, the expansion length of each, its documents' ids and the ends of their symbols, and
the symbols, rules and symbols packed in as few bits as the largest symbol needs. Every symbol has its place,
so any document, and any stretch of the shard's ids, is decoded without the rest.

Shards are rows of a Parquet table in the shared folder (part, shard, n_docs, n_tokens, body), written by
Spark's committer, so a lost executor's tasks are written again and nothing of them counts twice.

Defined results: a null text is empty and has the end id alone; rows that share a doc_id are separate
documents, in order of a hash of their texts; equal rows are each encoded; a null doc_id comes first; an
empty table gives no rows; texts are whole, and the longest one, with the symbols of a shard, is the least
that a worker holds; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import product_path, text_chunks, tidied
from .encode import encoder

MAGIC = b"RPSH0002"
#: Ids in a shard, about; uses that a rule needs; share of the largest count that pairs of a round have; bytes of text in a part.
SHARD_IDS, LEAST_USES, SHARE, PART_BYTES = 1 << 20, 8, 64, 24 << 20
#: Bits of the hash by which pairs that can't have enough uses are set aside before counting; parts in a group of prefix sums.
SIEVE_BITS, GROUP_BITS = 19, 11
#: Range partitions at most.
MOST_PARTS = 1 << 13
#: Of this many documents one is read by itself.
ALONE = 64
NO_ID = -(1 << 63)


def _frequent(symbols: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, number of the pair at each, pairs of the round, places whose pair has uses enough to come later).

    Of a run of places of one pair, which overlap, every other one is given.
    """
    key = symbols[place].astype(np.uint64) << np.uint64(32) | symbols[place + 1]
    sieve = (key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SIEVE_BITS)).view(np.int64)
    some = np.flatnonzero((np.bincount(sieve, minlength=1 << SIEVE_BITS) >= LEAST_USES)[sieve])
    place, key, sieve = place[some], key[some], sieve[some]
    order = np.sort(key)
    new = np.ones(len(order), bool)
    np.not_equal(order[1:], order[:-1], out=new[1:])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(order)))
    pairs, count = order[first[count >= LEAST_USES]], count[count >= LEAST_USES]
    if not len(pairs):
        return place[:0], sieve[:0], pairs, place[:0]
    # A place finds its pair by the sieve's hash; of pairs that share one the most frequent comes now, the others later.
    at, own = (pairs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SIEVE_BITS)).view(np.int64), np.arange(len(pairs), dtype=np.int32)
    number = np.zeros(1 << SIEVE_BITS, np.int32)
    number[at] = own
    behind = np.zeros(1 << SIEVE_BITS, bool)
    behind[at[number[at] != own]] = True
    clash = np.flatnonzero(behind[at])
    clash = clash[np.argsort(count[clash], kind="stable")]
    number[at[clash]] = clash
    now = count >= max(LEAST_USES, int(count.max()) // SHARE)
    mine = number[sieve]
    hit = pairs[mine] == key
    waits = np.where(hit, ~now[mine], behind[sieve])
    later, hit = place[np.flatnonzero(waits)], np.flatnonzero(hit & ~waits)
    place, mine = place[hit], mine[hit]
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(place) != 1) | (mine[1:] != mine[:-1])
    nth = np.arange(len(place))
    own = (nth - np.maximum.accumulate(np.where(new, nth, 0))) % 2 == 0
    return place[own], mine[own], pairs, np.concatenate([later, place[~own]])


def grammar(symbols: np.ndarray, last: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules as pairs, symbols left, whether each is the last of its document).

    A pair's count can't rise: its symbols only ever stand side by side where they did before. So a place is
    looked at until its pair has too few uses, and again when a neighbour is replaced.
    """
    made: list[np.ndarray] = []
    symbols, last, open_ = symbols.copy(), last.copy(), ~last
    open_[-1:] = False
    while True:
        place, number, pairs, later = _frequent(symbols, np.flatnonzero(open_))
        if not len(pairs):
            break
        uses = np.bincount(number, minlength=len(pairs))
        enough = uses >= LEAST_USES  # a pair's places may overlap, which leaves fewer uses than it counts
        weight = uses * len(pairs) - np.arange(len(pairs))  # by uses, then by the smaller pair: no two are alike
        own = enough[number]
        place, number = place[own], number[own]
        # Where places of two pairs overlap the more frequent pair wins; the loser is counted again in the next round.
        order, touch = weight[number], np.diff(place) == 1
        win = np.ones(len(place), bool)
        win[1:] &= ~(touch & (order[1:] < order[:-1]))
        win[:-1] &= ~(touch & (order[:-1] < order[1:]))
        lost = place[~win]
        place, number = place[win], number[win]
        kept = np.bincount(number, minlength=len(pairs)) >= LEAST_USES
        own = kept[number]
        lost = np.concatenate([lost, place[~own]])
        place, number = place[own], (np.cumsum(kept) - 1)[number[own]]
        made.append(pairs[kept])
        symbols[place] = (base + sum(map(len, made[:-1])) + number).astype(np.uint32)
        last[place] = last[place + 1]
        # Open are the places that come later, those that lost, and the replaced symbols with the ones before them.
        open_[:] = False
        open_[later] = open_[lost] = open_[place] = True
        open_[np.maximum(place - 1, 0)] = True
        stay = np.ones(len(symbols), bool)
        stay[place + 1] = False
        # Where two replaced symbols meet, the one before is a replaced symbol too, which is open.
        stay = np.flatnonzero(stay)
        symbols, last, open_ = symbols[stay], last[stay], open_[stay]
        open_ &= ~last
        open_[-1:] = False
    rules = np.concatenate([np.zeros(0, np.uint64), *made])
    return np.stack([rules >> np.uint64(32), rules & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32), symbols, last


def lengths_of(pairs: np.ndarray, base: int) -> np.ndarray:
    """Expansion length of each rule; a rule's symbols are older than it."""
    out = np.ones(len(pairs), np.uint32)
    while True:
        side = [np.where(pairs[:, k] < base, 1, out[np.maximum(0, pairs[:, k].astype(np.int64) - base)]) for k in (0, 1)] if len(pairs) else [out, out]
        new = (side[0] + side[1]).astype(np.uint32)
        if (new == out).all():
            return out
        out = new


def expand(symbols: np.ndarray, pairs: np.ndarray, base: int) -> np.ndarray:
    """Ids of some symbols, from the rules that they use alone."""
    while len(symbols) and len(pairs):
        rule = symbols >= base
        if not rule.any():
            break
        width = np.where(rule, 2, 1)
        at = np.cumsum(width) - width
        out = np.empty(int(width.sum()), np.uint32)
        out[at] = np.where(rule, pairs[np.where(rule, symbols.astype(np.int64) - base, 0), 0], symbols)
        out[at[rule] + 1] = pairs[symbols[rule].astype(np.int64) - base, 1]
        symbols = out
    return symbols.astype(np.uint32)


def pack(values: np.ndarray, bits: int) -> bytes:
    """Numbers in so many bits each, lowest bit first."""
    if bits == 16:
        return values.astype("<u2").tobytes()
    place, out = np.arange(bits, dtype=np.uint32), []
    for at in range(0, len(values), 1 << 16):  # a multiple of 8 numbers ends at a byte
        out.append(np.packbits((values[at : at + (1 << 16), None] >> place & np.uint32(1)).astype(np.uint8), bitorder="little").tobytes())
    return b"".join(out)


def unpack(data: np.ndarray, bits: int, start: int, stop: int) -> np.ndarray:
    """The numbers from place start to stop, from the bytes that hold them alone."""
    if bits == 16:
        return data[2 * start : 2 * stop].view("<u2").astype(np.uint32)
    out, weight = [np.zeros(0, np.uint32)], (np.uint32(1) << np.arange(bits, dtype=np.uint32))[None]
    for a in range(start, stop, 1 << 16):
        n = min(1 << 16, stop - a)
        first = a * bits
        held = np.unpackbits(data[first // 8 : -(-(first + n * bits) // 8)], bitorder="little")[first % 8 :][: n * bits]
        out.append((held.reshape(n, bits) * weight).sum(axis=1, dtype=np.uint32))
    return np.concatenate(out)


class Shard:
    """A shard's content: written by body(), read back by Shard.read()."""

    HEAD = struct.Struct("<8sIIIIQ")

    def __init__(self, base: int, pairs: np.ndarray, widths: np.ndarray, doc_ids: np.ndarray, ends: np.ndarray, tokens: np.ndarray, bits: int, symbols: np.ndarray):
        self.base, self.pairs, self.widths, self.doc_ids, self.ends, self.tokens, self.bits, self.packed = base, pairs, widths, doc_ids, ends, tokens, bits, symbols

    @classmethod
    def build(cls, doc_ids: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> Shard:
        base = int(ids.max()) + 1 if len(ids) else 1
        last = np.zeros(len(ids), bool)
        last[bounds[1:] - 1] = True  # every document has its end id
        pairs, symbols, last = grammar(ids, last, base)
        bits = (base + len(pairs)).bit_length()
        return cls(base, pairs, lengths_of(pairs, base), doc_ids, np.flatnonzero(last) + 1, np.diff(bounds), bits, np.frombuffer(pack(symbols, bits), np.uint8))

    def body(self) -> bytes:
        n = len(self.doc_ids)
        head = self.HEAD.pack(MAGIC, self.bits, self.base, len(self.pairs), n, int(self.ends[-1]) if n else 0)
        return b"".join([
            head, self.widths.astype("<u4").tobytes(), self.doc_ids.astype("<i8").tobytes(), self.ends.astype("<u8").tobytes(), self.tokens.astype("<u8").tobytes(),
            pack(self.pairs.reshape(-1), self.bits), self.packed.tobytes(),
        ])

    @classmethod
    def read(cls, body: bytes) -> Shard:
        magic, bits, base, n_rules, n_docs, _ = cls.HEAD.unpack_from(body)
        if magic != MAGIC:
            raise ValueError("not a shard")
        at, out = cls.HEAD.size, []
        for kind, n in (("<u4", n_rules), ("<i8", n_docs), ("<u8", n_docs), ("<u8", n_docs), ("u1", -(-2 * n_rules * bits // 8))):
            out.append(np.frombuffer(body, kind, n, at))
            at += out[-1].nbytes
        pairs = unpack(out[4], bits, 0, 2 * n_rules).reshape(-1, 2)
        return cls(base, pairs, out[0], out[1], out[2].astype(np.int64), out[3].astype(np.int64), bits, np.frombuffer(body, np.uint8, offset=at))

    def symbols(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        n = int(self.ends[-1]) if len(self.ends) else 0
        return unpack(self.packed, self.bits, start, n if stop is None else stop)

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, from its own symbols."""
        return expand(self.symbols(int(self.ends[k - 1]) if k else 0, int(self.ends[k])), self.pairs, self.base)

    def stretch(self, start: int, n: int) -> np.ndarray:
        """n ids from place start on: the documents' lengths and the symbols' expansion lengths lead to the symbols that hold them."""
        if not n:
            return np.zeros(0, np.uint32)
        bounds = np.cumsum(self.tokens)
        a, b = int(np.searchsorted(bounds, start, "right")), int(np.searchsorted(bounds, start + n, "left"))
        symbols = self.symbols(int(self.ends[a - 1]) if a else 0, int(self.ends[b]))
        skip = start - (int(bounds[a - 1]) if a else 0)
        ends = np.cumsum(self._width(symbols))
        first, stop = int(np.searchsorted(ends, skip, "right")), int(np.searchsorted(ends, skip + n, "left")) + 1
        skip -= int(ends[first - 1]) if first else 0
        return expand(symbols[first:stop], self.pairs, self.base)[skip : skip + n]

    def _width(self, symbols: np.ndarray) -> np.ndarray:
        return np.append(np.ones(1, np.int64), self.widths)[np.maximum(0, symbols.astype(np.int64) - self.base + 1)]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the shard, bounds of its documents): every rule is expanded once."""
        symbols, first = self.symbols(), np.cumsum(self.widths, dtype=np.int64) - self.widths
        pool = np.concatenate([np.arange(self.base, dtype=np.uint32), expand(np.arange(self.base, self.base + len(self.pairs)), self.pairs, self.base)])
        start = np.concatenate([np.arange(self.base), self.base + first])[symbols]
        width = self._width(symbols)
        ends = np.cumsum(width)
        ids = pool[np.repeat(start - (ends - width), width) + np.arange(int(width.sum()))]
        return ids, np.concatenate([[0], np.cumsum(self.tokens)])


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def write(docs: DataFrame, path: str, *, tokenizer: str | None = None, end_id: int = 2) -> None:
    """Encode whole texts and write their shards, in ascending doc_id order, to path."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("place"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer or tokenizer_path()).encode
        part, shard = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = 0

        def made() -> pa.RecordBatch:
            widths = np.concatenate([h[2] for h in held])
            s = Shard.build(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), np.concatenate([[0], np.cumsum(widths)]))
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(widths)], pa.int64()), pa.array([int(widths.sum())], pa.int64()), pa.array([s.body()], pa.binary())], names=["part", "shard", "n_docs", "n_tokens", "body"])

        for batch in batches:
            doc_ids = batch.column(0).fill_null(NO_ID).to_numpy()
            for lo, hi, raw, offs in text_chunks(batch.column(1)):
                ids, bounds = encode(raw, offs)
                ids = np.insert(ids, bounds[1:], np.uint32(end_id))
                held.append((doc_ids[lo:hi], ids, np.diff(bounds) + 1))
                count += len(ids)
                if count >= SHARD_IDS:
                    yield made()
                    held, count, shard = [], 0, shard + 1
        if held:
            yield made()

    # The hash keeps texts of one id, or of none, apart.
    ordered = own.repartitionByRange(parts_of(size), "doc_id", "place").sortWithinPartitions("doc_id", "place", "text")
    ordered.mapInArrow(tidied(build), "part int, shard int, n_docs long, n_tokens long, body binary").write.option("compression", "zstd").parquet(path)


def parts_of(size: int) -> int:
    """Range partitions for texts of size bytes: PART_BYTES each, and MOST_PARTS at most, as a shuffle's bookkeeping follows
    their number. A part is written in shards of SHARD_IDS ids as it is read, so a larger part takes time, not memory."""
    return min(MOST_PARTS, max(1, -(-size // PART_BYTES)))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files at path."""
    shards = spark.read.schema("part int, shard int, n_docs long, n_tokens long, body binary").parquet(path)
    # Prefix sums of shards in their part, parts in their group, and groups: the last are one for 2^GROUP_BITS parts.
    counts = shards.select("part", "shard", "n_tokens", F.shiftright("part", GROUP_BITS).alias("group"))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = counts.groupBy("group", "part").agg(F.sum("n_tokens").alias("n"))
    groups = parts.groupBy("group").agg(F.sum("n").alias("n")).select("group", before("n", Window.orderBy("group")).alias("group_start"))
    parts = parts.withColumn("part_start", before("n", Window.partitionBy("group").orderBy("part"))).join(groups, "group")
    places = counts.drop("group").withColumn("shard_start", before("n_tokens", Window.partitionBy("part").orderBy("shard"))).join(parts, "part")
    places = places.select("part", "shard", (F.col("group_start") + F.col("part_start") + F.col("shard_start")).alias("shard_start"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = Shard.read(batch.column(2)[k].as_py())
                ids, bounds = shard.all()
                data = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                for j in range(0, len(crc), ALONE):  # some documents are read by themselves: both ways must agree
                    if zlib.crc32(shard.document(j).astype("<u4").tobytes()) != crc[j]:
                        raise ValueError("a document read alone differs from the shard's")
                n = len(crc)
                yield pa.record_batch([
                    pa.array([batch.column(0)[k].as_py()] * n, pa.int32()), pa.array([batch.column(1)[k].as_py()] * n, pa.int32()), pa.array(shard.doc_ids, pa.int64(), mask=shard.doc_ids == NO_ID),
                    pa.array(bounds[:-1], pa.int64()), pa.array(shard.tokens, pa.int64()), pa.array(crc, pa.int64()),
                ], names=["part", "shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = shards.select("part", "shard", "body").mapInArrow(tidied(decode), "part int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(places, ["part", "shard"]).select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def written_and_read(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """read()'s rows of the shards that docs are written to: at path, or in a folder of their own in the shared one.

    The shards are a product and stay; shards_path() of the result, also when it was written and read again, says where.
    """
    path = path or product_path(docs.sparkSession, "tokens")
    write(docs, path, **options)
    return read(docs.sparkSession, path).withMetadata("doc_id", {"shards": path})


def shards_path(found: DataFrame) -> str:
    """Where the shards are that found tells of."""
    return found.schema["doc_id"].metadata["shards"]
