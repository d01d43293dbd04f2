"""Staged tables, row keys, the encoder's table, and the memory of a worker."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from concordia.llm import common, encode

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_release(spark):
    """Tables staged since a mark go, but for one to keep."""
    before = common.staged(spark.range(3), "a")
    mark = common.staged_so_far()
    kept, gone = common.new_path(spark, "kept"), common.staged(spark.range(5), "b")
    spark.range(7).write.parquet(kept)
    path = common._STAGED[-1]
    common.release(spark, mark, keep=kept)
    assert before.count() == 3 and spark.read.parquet(kept).count() == 7 and kept in common._STAGED
    assert path not in common._STAGED and not os.path.exists(path.removeprefix("file://"))
    with pytest.raises(Exception, match="(?i)does not exist|not found|FAILED_READ"):
        gone.collect()
    common.discard(spark, kept)
    assert common.staged_so_far() == mark


def test_row_key(spark):
    """Rows have one key exactly if they are equal in every column, nulls included."""
    items = [(1, "a", None), (1, "a", None), (None, "a", None), (1, None, "a"), (1, "", "a"), (1, "a\u0000", None), (1, 'a","c":"', None), (None, None, None)]
    df = spark.createDataFrame(items, "doc_id long, text string, c string")
    keys = [r[0] for r in df.select(common.row_key(df)).collect()]
    assert keys[0] == keys[1] and len(set(keys)) == len(items) - 1


def test_batches_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    try:
        for given, want in (("10000", common.BATCH_ROWS), ("0", common.BATCH_ROWS), ("7", 7)):
            spark.conf.set(key, given)
            common.bounded_batches(spark)
            assert int(spark.conf.get(key)) == want
    finally:
        spark.conf.set(key, old)


def test_table():
    """Numbers of hashes that crowd at one place and go round the end, against a dict."""
    rng = np.random.default_rng(0)
    table, known = encode.Table(8), {}
    for _ in range(12):
        new = np.unique(np.concatenate([rng.integers(1, 1 << 60, 5), rng.integers(1, 9, 4), ~rng.integers(1, 9, 4)]).astype(np.uint64))
        new = new[[int(h) not in known for h in new]]
        table.add(new, len(known))
        known |= {int(h): len(known) + k for k, h in enumerate(new)}
        asked = np.concatenate([np.array(list(known), np.uint64), rng.integers(1 << 61, 1 << 62, 20).astype(np.uint64)])
        assert table.find(asked).tolist() == [known.get(int(h), -1) for h in asked]


def test_encoder_forgets(monkeypatch):
    """A worker that remembers few pieces gives the same ids."""
    import pyarrow as pa

    from concordia.llm import repair

    texts = [f"some words {k} and {k * 7} 'll go on, été {k}!" for k in range(200)]
    column = pa.array(texts)
    want = encode.Encoder(repair.tokenizer_path()).encode(*common.text_buffers(column))
    monkeypatch.setattr(encode, "REMEMBERED", 60)
    few = encode.Encoder(repair.tokenizer_path())
    parts = [few.encode(raw, offs)[0] for _, _, raw, offs in common.text_chunks(column, 500)]
    assert (np.concatenate(parts) == want[0]).all()


MEMORY = """
import re, sys
sys.path.insert(0, {root!r})
import numpy as np, pyarrow as pa
import pyspark.worker
from concordia.llm import toxicity as T
texts = [" ".join("word%d" % ((k * 31 + j * j) % 5000) for j in range(300)) for k in range(1000)]
column = pa.array(texts)
assert column.nbytes > 2e6
model = T.Model(np.arange(6000) * 97, np.ones(6000), 0.0)
place = model.table()
for lo, hi, raw, offs in T.gram_chunks(column):
    model.score(raw, offs, place)
    T._features(raw, offs)
print(sum(map(int, re.findall(r"VmHWM:\\s+(\\d+)", open("/proc/self/status").read()))) // 1024)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/status"), reason="reads the peak from /proc")
def test_worker_memory():
    """Scoring and counting n-grams of 2 MB of text take less than 250 MB, modules included."""
    found = subprocess.run([sys.executable, "-c", MEMORY.format(root=ROOT)], capture_output=True, text=True, check=True, timeout=120)
    assert int(found.stdout.split()[-1]) < 250


def test_let_go(spark):
    common.let_go(spark)
    assert spark.range(3).agg(F.sum("id")).first()[0] == 3


def test_entry_hides_nothing_else():
    """The entry module does without the subpackage, but not without what the subpackage needs."""
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__"
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=120, check=False)
    assert found.returncode and "ahocorasick" in found.stderr
    code = "import sys; sys.modules['concordia.llm'] = None; import __spark_entry__ as e; print(sorted(set(e.queries()) & {'pipeline', 'op1_toxicity', 'totals'}))"
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=120, check=True)
    assert found.stdout.split() == ["['totals']"]
