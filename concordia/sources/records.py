"""Records of delimited files whose quoted fields may hold line ends, read in parallel however large a file is.

Spark cuts a file anywhere, so a cut may lie inside a quoted field, and a line alone doesn't tell. A first
pass gives, for each cut, what its lines do to either state that it may begin in (outside of quotes, or
within), and where its last record begins in either case: one narrow row a cut. Composing those in order
tells the state that each cut does begin in. A second pass then joins lines to records cut by cut, without
a shuffle; only records that lie across cuts are put together from their pieces by a grouping.

Every record has a place: path, file and line that it begins in. Order of places is order of records.

Defined results: quotes count at the beginning of a field alone, and are doubled within quotes; a quoted
field that goes on after its closing quote ends at the next separator; a quote that is never closed holds
the rest of its file; empty lines outside of quotes are no records; missing fields are null, surplus ones
are left out; columns without a name are _c and their number, names that occur twice get their number; an
empty file has no columns and no rows. Line ends within quotes are line feeds where the file's own are.
A compressed file can't be cut and is one task.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written

#: Cuts whose states are sent to all tasks (some 100 bytes each); of more, lines are shuffled to their cut's state.
MOST_SENT = 1 << 18

PLACE = "__place"


def ends_open(line: str, sep: str, quote: str, open_: bool) -> bool:
    """Whether a line that begins in a state ends within quotes."""
    at, n = 0, len(line)
    while True:
        if open_ or (at < n and line[at] == quote):
            at += not open_
            open_ = False
            while True:
                at = line.find(quote, at)
                if at < 0:
                    return True
                if line[at + 1 : at + 2] != quote:
                    break
                at += 2
        at = line.find(sep, at)
        if at < 0:
            return False
        at += 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("cut"))


def _stretches(batch: pa.RecordBatch, *keys: int) -> Iterator[pa.RecordBatch]:
    """A batch's runs of rows with the same keys."""
    n, lo = batch.num_rows, 0
    changed = [False] * n
    for k in keys:
        column = batch.column(k)
        if n > 1:
            differs = pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_pylist()
            changed[1:] = [a or b for a, b in zip(changed[1:], differs, strict=True)]
    for hi in [*(i for i in range(n) if changed[i]), n]:
        if hi > lo:
            yield batch.slice(lo, hi - lo)
            lo = hi


CUT = "file string, cut long, n long, closed boolean, open boolean, last_closed long, last_open long, returns boolean"


def cuts(lines: DataFrame, sep: str, quote: str) -> DataFrame:
    """For each cut: its lines, the state that it ends in and its last record's line after either beginning, and whether lines end in returns."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        n, ends, last, returns = 0, [False, True], [None, None], False

        def done() -> pa.RecordBatch:
            for s in (0, 1):
                if not ends[s] and n > after[s]:  # lines behind the last quote begin records
                    last[s] = n - 1
            values = [at[0], at[1], n, ends[0], ends[1], last[0], last[1], returns]
            types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_())
            names = [c.split()[0] for c in CUT.split(", ")]
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

        after = [0, 0]
        for batch in batches:
            for own in _stretches(batch, 1, 2):
                key = (own.column(1)[0].as_py(), own.column(2)[0].as_py())
                if key != at:
                    if at is not None:
                        yield done()
                    at, n, ends, last, after = key, 0, [False, True], [None, None], [0, 0]
                    returns = own.column(0)[0].as_py().endswith("\r")
                for i in pc.indices_nonzero(pc.match_substring(own.column(0), quote)).to_pylist():
                    line = own.column(0)[i].as_py()
                    for s in (0, 1):
                        if not ends[s]:
                            last[s] = n + i
                        ends[s] = ends_open(line, sep, quote, ends[s])
                        after[s] = n + i + 1
                n += own.num_rows
        if at is not None:
            yield done()

    return lines.mapInArrow(scan, CUT)


def states(found: DataFrame) -> DataFrame:
    """cuts with the state that each begins in (within), its first line's number, the line of the record that it begins in, and its file's number.

    A cut keeps the state, changes it, or sets it: the state is that of the last cut that set it, changed as often as cuts did since.
    """
    order = Window.partitionBy("file").orderBy("cut")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    changes = found.withColumn("changes", F.sum((F.col("closed") & ~F.col("open")).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    setter = F.when(F.col("closed") == F.col("open"), F.struct("closed", "changes"))
    known = changes.withColumn("set", F.last(setter, ignorenulls=True).over(before)).withColumn("so_far", F.coalesce(F.lag("changes").over(order), F.lit(0)))
    odd = (F.col("so_far") - F.coalesce("set.changes", F.lit(0))) % 2 == 1
    begun = known.withColumn("within", F.coalesce("set.closed", F.lit(False)) != odd).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    last = F.col("first") + F.when(F.col("within"), F.col("last_open")).otherwise(F.col("last_closed"))
    ends = F.when(F.col("within"), F.col("open")).otherwise(F.col("closed"))
    carried = begun.withColumn("last", last).withColumn("record", F.last("last", ignorenulls=True).over(before)).withColumn("across", F.col("within") | ends)
    returns = carried.withColumn("returns", F.first("returns").over(order))
    # One row a file is ranked, not one a cut.
    files = found.select("file").distinct().withColumn("file_no", F.row_number().over(Window.orderBy("file")) - 1)
    return returns.join(files, "file").select("file", "cut", "file_no", "within", "first", "record", "across", "returns")


PIECE = "file_no int, line long, piece long, text string"


def _stitched(lines: DataFrame, sep: str, quote: str) -> DataFrame:
    """Records of lines with their cuts' states: whole ones (piece is null), and pieces of those across cuts with their line."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, begun, open_, line, cut_off = None, [], 0, False, 0, False

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            types = (pa.int32(), pa.int64(), pa.int64(), pa.string())
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file_no", "line", "piece", "text"])

        for batch in batches:
            for own in _stretches(batch, 1, 2):
                file_no, cut, within, first, record, returns = (own.column(k)[0].as_py() for k in range(1, 7))
                out = []
                if key is None or key[:2] != (file_no, cut):
                    if held:
                        out.append((key[0], begun, first_piece, "\n".join(held)))
                    key, held, open_, line = (file_no, cut), [], within, first
                    begun, first_piece, cut_off = (record, first, True) if within else (0, 0, False)
                values = own.column(0)
                if returns:
                    values = pc.replace_substring_regex(values, "\r$", "")
                if not open_ and not pc.any(pc.match_substring(values, quote)).as_py():
                    if out:
                        yield made(out)
                    n = own.num_rows
                    lines_ = pa.array(range(line, line + n), pa.int64())
                    yield pa.record_batch([pa.array([file_no] * n, pa.int32()), lines_, pa.nulls(n, pa.int64()), values], names=["file_no", "line", "piece", "text"])
                    line += n
                    continue
                for text in values.to_pylist():
                    if not open_:
                        begun, first_piece, cut_off = line, line, False
                    held.append(text)
                    if quote in text:
                        open_ = ends_open(text, sep, quote, open_)
                    if not open_:
                        out.append((file_no, begun, first_piece if cut_off else None, "\n".join(held)))
                        held = []
                    line += 1
                if out:
                    yield made(out)
        if held:
            yield made([(key[0], begun, first_piece, "\n".join(held))])

    own = lines.select("value", "file_no", "cut", "within", "first", "record", "returns")
    return own.mapInArrow(scan, PIECE)


def header(spark: SparkSession, path: str, sep: str, quote: str) -> list[str]:
    """Names of a file's columns: its first record, read from as many lines as that takes."""
    n = 1
    while True:
        lines = [r[0].rstrip("\r") for r in _lines(spark, path).filter("cut = 0").select("value").take(n)]
        open_ = False
        for k, line in enumerate(lines):
            open_ = ends_open(line, sep, quote, open_)
            if not open_:
                lines = lines[: k + 1]
                break
        if not open_ or len(lines) < n:
            break
        n *= 4
    names = next(csv.reader(["\n".join(lines).lstrip("﻿")], delimiter=sep, quotechar=quote), []) if lines else []
    folded = [x.lower() for x in names]
    return [f"_c{i}" if not x else f"{x}{i}" if folded.count(x.lower()) > 1 else x for i, x in enumerate(names)]


def records(spark: SparkSession, path: str, sep: str, quote: str, *, most_sent: int = MOST_SENT) -> DataFrame:
    """(file_no, line, text) of all records of the files at a path, headers included."""
    lines = _lines(spark, path)
    known = written(states(cuts(lines, sep, quote)), "cuts")
    own = lines.withColumn("pos", F.monotonically_increasing_id())
    if known.count() <= most_sent:
        joined = own.join(F.broadcast(known), ["file", "cut"])
    else:
        joined = own.join(known.hint("shuffle_merge"), ["file", "cut"]).repartition("file_no", "cut").sortWithinPartitions("file_no", "cut", "pos")
    if known.filter("across").isEmpty():
        return _stitched(joined, sep, quote).select("file_no", "line", "text")
    whole = _stitched(joined, sep, quote).filter("piece is null").select("file_no", "line", "text")
    pieces = _stitched(joined.filter("across"), sep, quote).filter("piece is not null")
    put = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "text"))), lambda x: x["text"]), "\n")
    return whole.union(pieces.groupBy("file_no", "line").agg(put.alias("text")))


def read_records(spark: SparkSession, path: str, sep: str, *, quote: str = '"', number: int = 0, most_sent: int = MOST_SENT) -> DataFrame:
    """All columns as strings, and each record's place; number: the path's own, where several are read."""
    files = sorted(spark.read.text(path).inputFiles())
    names = header(spark, unquote(files[0]), sep, quote) if files else []
    if not names:
        return spark.range(0).select(F.struct(F.lit(number).alias("path"), F.lit(0).alias("file"), F.col("id").alias("line")).alias(PLACE))
    own = records(spark, path, sep, quote, most_sent=most_sent).filter("line > 0 and text <> ''")
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    fields = F.from_csv("text", schema, {"sep": sep, "quote": quote, "escape": quote, "mode": "PERMISSIVE"})
    place = F.struct(F.lit(number).alias("path"), F.col("file_no").alias("file"), F.col("line").alias("line"))
    parsed = own.select(fields.alias("r"), place.alias(PLACE))
    return parsed.select(*[F.col(f"r.c{i}").alias(x) for i, x in enumerate(names)], PLACE)
