"""Delimited files cut anywhere: the same records, in the same order, as a reader that takes a file as one task."""

import random

import pytest
from pyspark.sql import functions as F

from concordia.sources import delimited, records


def field(rng, sep):
    kind = rng.randrange(9)
    word = "".join(rng.choice("abé x") for _ in range(rng.randrange(1, 9)))
    if kind < 3:
        return word.strip() or "k"
    if kind == 3:
        return ""
    if kind == 4:
        return word.strip() + '5" pipe'  # a quote that opens nothing
    inner = rng.choice([f"{word}{sep}{word}", f"{word}\n{word}", 'say ""no""', "\n\n", f'""{sep}\n', word * 12, "l\n" * rng.randrange(1, 30)])
    return f'"{inner}"'


def content(seed, sep, end="\n", rows=60):
    rng = random.Random(seed)
    lines = [sep.join(["id", "name", "note"])]
    for k in range(rows):
        lines.append(sep.join([str(k), field(rng, sep), field(rng, sep)][: 3 if rng.random() < 0.9 else 2]))
        if rng.random() < 0.05:
            lines.append("")
    return end.join(lines).replace("\n", end).replace("\r\r", "\r") + (end if seed % 2 else "")


def one_task(spark, path, sep):
    options = {"header": True, "sep": sep, "quote": '"', "escape": '"', "multiLine": True}
    return [tuple(r) for r in spark.read.options(**options).csv(path).collect()]


@pytest.fixture
def small_cuts(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, str(n))
    spark.conf.set(key, before)


def in_order(df):
    return [tuple(r)[:-1] for r in df.orderBy(records.PLACE).collect()]


@pytest.mark.parametrize("seed, sep, end, size", [(1, ",", "\n", 150), (2, "\t", "\n", 40), (3, ",", "\r\n", 90), (4, ",", "\n", 1 << 20)])
def test_cut_files_equal_one_task(spark, small_cuts, tmp_path, seed, sep, end, size):
    path = tmp_path / "f.csv"
    path.write_bytes(content(seed, sep, end).encode())
    want = one_task(spark, str(path), sep)
    small_cuts(size)
    n = records._lines(spark, str(path)).select("cut").distinct().count()
    assert (n > 5) == (size < 1000) and len(want) > 55
    assert in_order(records.read_records(spark, str(path), sep)) == want


def test_more_cuts_than_are_sent(spark, small_cuts, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text(content(5, ","))
    want = one_task(spark, str(path), ",")
    small_cuts(100)
    assert in_order(records.read_records(spark, str(path), ",", most_sent=0)) == want


def test_states_compose(spark):
    """States of either beginning agree with a walk over the whole text, for any cuts."""
    for seed in range(30):
        text = content(seed, ",").split("\n")
        open_, begins = False, []
        for line in text:
            begins.append(open_)
            open_ = records.ends_open(line, ",", '"', open_)
        assert any(begins)
        for line, begin, end in zip(text, begins, [*begins[1:], open_], strict=True):
            assert records.ends_open(line, ",", '"', begin) == end
            if '"' not in line:
                assert end == begin


def test_odd_files(spark, small_cuts, tmp_path):
    small_cuts(30)
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text('﻿"first\nname",b,b,\n1,2,3,4\n')
    (folder / "b.csv").write_text('"first\nname",b,b,\n5,6,7,8,9\n\n10\n"never closed,\nto the end')
    got = records.read_records(spark, str(folder), ",")
    assert got.columns[:-1] == ["first\nname", "b1", "b2", "_c3"]
    assert in_order(got) == [("1", "2", "3", "4"), ("5", "6", "7", "8"), ("10", None, None, None), ("never closed,\nto the end", None, None, None)]
    (tmp_path / "empty.csv").write_text("")
    assert records.read_records(spark, str(tmp_path / "empty.csv"), ",").collect() == []
    (tmp_path / "head.csv").write_text("a,b")
    assert delimited.read_delimited(spark, str(tmp_path / "head.csv")).filter(F.col("a").isNotNull()).collect() == []
