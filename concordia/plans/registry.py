"""Queries by name, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLES[name or f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, *names: str):
    found = [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
    return found[0] if len(found) == 1 else found
