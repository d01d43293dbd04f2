"""The stateful stream of accessions: replays, late rows, repeated rows, timers, and a stop between batches."""

from datetime import datetime, timedelta

from concordia.streaming import accessions

START = datetime(2024, 1, 1)
SCHEMA = "acc string, at timestamp, content string, state string"


def test_replay(spark, tmp_path):
    inbox, history, state = (str(tmp_path / n) for n in ("in", "history", "state"))

    def give(*rows):
        """Each call is a run of its own, which goes on from the checkpoint of the one before."""
        made = [(a, None if h is None else START + timedelta(hours=h), c, "a clashing column") for a, h, c in rows]
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(SCHEMA).parquet(inbox)
        accessions.run(accessions.changes(stream, "acc", "at", "content", late="2 hours", expiry_ms=10 * 3600_000), history, state)
        rows = accessions.latest(spark, history).collect()
        return {r["accession"]: (r["state"], round((r["as_of"] - START).total_seconds() / 3600), r["content_hash"]) for r in rows}

    got = give(("a", 10, "x"), ("a", 9, "w"), ("b", 10, "y"), ("b", 10, "y"), ("c", 10, None), (None, 10, "x"), ("d", None, "x"))
    assert got == {"a": ("new", 10, "x"), "b": ("new", 10, "y"), "c": ("new", 10, None)}
    n = spark.read.parquet(history).count()
    same = give(("a", 10, "x"), ("a", 9, "w"), ("b", 10, "y"))  # a replay
    assert same == got and spark.read.parquet(history).count() == n
    # Changed; older than what is known; later with the same content; and older than the watermark.
    got = give(("a", 11, "z"), ("b", 9, "q"), ("c", 12, None), ("e", 3, "late"))
    assert got == {"a": ("changed", 11, "z"), "b": ("new", 10, "y"), "c": ("new", 10, None)}
    # The watermark comes to 23: what was last seen at 11 and 12 retires, f doesn't.
    got = give(("f", 25, "f"))
    assert got == {"a": ("retired", 11, "z"), "b": ("retired", 10, "y"), "c": ("retired", 12, None), "f": ("new", 25, "f")}
    got = give(("a", 26, "z"), ("b", 12, "q"))
    assert got["a"] == ("returned", 26, "z") and got["b"] == ("retired", 10, "y")


def test_no_rows(spark, tmp_path):
    inbox = str(tmp_path / "in")
    spark.createDataFrame([], SCHEMA).write.parquet(inbox)
    stream = spark.readStream.schema(SCHEMA).parquet(inbox)
    accessions.run(accessions.changes(stream, "acc", "at", "content"), str(tmp_path / "history"), str(tmp_path / "state"))
    assert not (tmp_path / "history").exists() or accessions.latest(spark, str(tmp_path / "history")).count() == 0
