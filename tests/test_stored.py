"""Encoding that is stopped and goes on, and the index of codes."""

import pytest

from concordia.operators import code_index, encoding, vectors


def counting(log, fail_on=None):
    """A stand-in encoder that notes every text, and breaks on one."""
    plain = vectors.hashing_encoder(8)

    def make():
        model = plain()

        def encode(texts):
            if fail_on in texts:
                raise RuntimeError("stopped")
            with open(log, "a") as f:
                f.writelines(t + "\n" for t in texts)
            return model(texts)

        return encode

    return make


def test_encoding_goes_on(spark, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "stored")
    rows = [(f"k{i}", f"text {i}") for i in range(60)] + [("k0", "text 0"), (None, "no key"), ("none", None)]
    df = spark.createDataFrame(rows, "content_hash string, text string")
    with pytest.raises(Exception, match="stopped"):
        encoding.resume(df, "text", counting(log, fail_on="text 33"), path, batches=8)
    some = encoding.stored(spark, path).count()
    assert 0 <= some < 61
    before = open(log).read().splitlines() if some else []
    part = encoding.resume(df, "text", counting(log), path, stop_after=1)
    assert some < part.count() < 61
    full = encoding.resume(df, "text", counting(log), path).collect()
    assert sorted(r["content_hash"] for r in full) == sorted({k for k, _ in rows if k})
    # What was finished when the run broke off isn't encoded again: only the batch that broke may be, in part.
    kept = [r["content_hash"] for r in full]
    texts = open(log).read().splitlines()
    again = [t for t in set(texts) if texts.count(t) > 1]
    assert len(kept) == len(set(kept)) and len(again) <= 61 - some and len(texts) >= 61 and len(before) >= some
    whole = {r["content_hash"]: r["embedding"] for r in vectors.encode(df.filter("content_hash is not null").dropDuplicates(["content_hash"]), "text", vectors.hashing_encoder(8)).collect()}
    assert {r["content_hash"]: r["embedding"] for r in full} == whole
    n = len(texts)
    encoding.resume(df, "text", counting(log), path)
    assert len(open(log).read().splitlines()) == n
    more = df.union(spark.createDataFrame([("late", "late text")], df.schema))
    assert encoding.resume(more, "text", counting(log), path).count() == 62
    assert open(log).read().splitlines()[n:] == ["late text"]
    assert encoding.resume(df.limit(0), "text", counting(log), str(tmp_path / "none"), batches=2).collect() == []


def read_rows(df):
    """Rows that the scan of a plan without shuffles handed on."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_lookup_reads_one_group(spark, tmp_path):
    path, n = str(tmp_path / "codes"), 60_000
    elements = spark.range(n).selectExpr("id", "array(struct('V' || id % 3 AS vocabulary, lpad(id, 9, '0') AS code), struct('V' || id % 3 AS vocabulary, lpad(id, 9, '0') AS code), struct('' AS vocabulary, 'x' AS code), struct('W' AS vocabulary, CAST(NULL AS STRING) AS code)) AS alternate_codes")
    code_index.write(elements.filter("id % 10 > 0"), path, "id", group_bytes=64 << 10)
    found = code_index.lookup(spark, path, "V1", "000030001")
    assert [tuple(r) for r in found.collect()] == [(30001, "000030001")]
    assert 0 < read_rows(code_index.lookup(spark, path, "V1", "000030001")) < n / 10
    assert read_rows(code_index.lookup(spark, path, "V1", "000030001x")) == 0  # within the bounds of a group, and not in its filter
    assert code_index.lookup(spark, path, "V0", "000000030").collect() == []
    code_index.append(elements, path, "id", group_bytes=64 << 10)
    assert [r["key"] for r in code_index.lookup(spark, path, "V0", "000000030").collect()] == [30]
    assert spark.read.parquet(path).count() == n and code_index.lookup(spark, path, "V2").count() == n // 3
    code_index.compact(spark, path, str(tmp_path / "one"))
    wanted = spark.createDataFrame([("V0", "000000030", 1), ("V1", "000030001", 2), ("V1", "none", 3)], "vocabulary string, code string, n int")
    assert sorted((r["n"], r["key"]) for r in code_index.lookup_all(spark, str(tmp_path / "one"), wanted).collect()) == [(1, 30), (2, 30001)]
