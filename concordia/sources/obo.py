"""Ontology files as a Spark data source: spark.read.format("obo").

A file is cut by bytes; a cut owns the stanzas that begin in it, and its reader goes on to the end of the
last of them. Lines go through one state machine, so line ends may be CRLF, lines may have blanks at their
ends, and stanzas may follow each other with no line between. What the option kinds rules out is never made
a row; with the option pushFilters, nor is what a query's filters on kind and id do. That is an option because
Spark 4.1 keeps one reader for each loaded table, with the filters that were pushed to it last: a table with
pushed filters may stand in a query once. Load it again for another use.

Defined results: a line "[X]" begins a stanza of kind X; a blank line ends one, and what follows up to the
next is no part of any; a line is a key, ": " and a value, whose comment behind "!" is cut off; other lines
are passed over; of a key that stands once the last value counts, others are lists in order, empty without
any; bytes that aren't UTF-8 become replacement characters; an empty file has no rows.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith
from pyspark.sql.types import StructType

#: Keys of a stanza that may repeat, and others (fixed values).
LISTED = ("synonym", "xref", "is_a", "alt_id", "subset", "property_value", "consider", "intersection_of")
SINGLE = ("id", "name", "def", "is_obsolete", "replaced_by")
SPLIT_BYTES = 32 << 20

SCHEMA = ", ".join(["kind string", *[f"`{k}` string" for k in SINGLE], *[f"{k} array<string>" for k in LISTED], "file string", "at long"])
_COMMENT = re.compile(r"\s*!\s*.*$")


def file_system(path: str):
    """(pyarrow's file system, path in it): local paths, and URIs of stores that pyarrow knows; others raise."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"\w+:", path) else (fs.LocalFileSystem(), path)


@dataclass
class Cut(InputPartition):
    path: str
    start: int
    end: int


def stanzas(lines: Iterator[tuple[int, str]], end: int) -> Iterator[tuple[str, int, list[tuple[str, str]]]]:
    """(kind, place, pairs) of the stanzas that begin before end; lines: (place, line)."""
    kind, begun, pairs, inside = None, 0, [], False
    for at, raw in lines:
        line = raw.strip()
        if line.startswith("[") and line.endswith("]"):
            if kind is not None:
                yield kind, begun, pairs
            if at >= end:
                return
            kind, begun, pairs, inside = line[1:-1], at, [], True
        elif not line:
            inside = False
        elif inside:
            key, found, value = line.partition(": ")
            if found:
                pairs.append((key, _COMMENT.sub("", value).strip()))
    if kind is not None:
        yield kind, begun, pairs


class OboReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.size = options["path"], int(options.get("splitBytes", SPLIT_BYTES))
        self.kinds: set[str] | None = set(options["kinds"].split(",")) if options.get("kinds") else None
        self.ids: set[str] | None = None
        self.prefixes: list[str] = []

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, root = file_system(self.path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info]
        if info.type == fs.FileType.Directory:
            found = system.get_file_info(fs.FileSelector(root, recursive=True))
            files = sorted((f for f in found if f.type == fs.FileType.File and f.base_name[:1] not in "._"), key=lambda f: f.path)
        return [Cut(f.path, at, min(f.size, at + self.size)) for f in files for at in range(0, f.size, self.size)]

    def _wanted(self, kind: str, own: str | None) -> bool:
        if self.kinds is not None and kind not in self.kinds or self.ids is not None and own not in self.ids:
            return False
        return all(own is not None and own.startswith(p) for p in self.prefixes)

    def read(self, partition: Cut) -> Iterator[tuple]:
        if not isinstance(partition, Cut):  # Spark reads once where there is nothing to read
            return
        system, _ = file_system(self.path)
        with io.BufferedReader(system.open_input_file(partition.path), 1 << 20) as f:
            for kind, at, pairs in stanzas(_numbered(f, partition.start), partition.end):
                single = dict(pairs)
                if self._wanted(kind, single.get("id")):
                    lists = [[v for k, v in pairs if k == name] for name in LISTED]
                    yield (kind, *[single.get(k) for k in SINGLE], *lists, partition.path, at)


class FilteringReader(OboReader):
    """A reader that takes filters; for tables that a query reads once."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is not None and f.attribute == ("kind",):
                self.kinds = values if self.kinds is None else self.kinds & values
            elif values is not None and f.attribute == ("id",):
                self.ids = values if self.ids is None else self.ids & values
            elif isinstance(f, StringStartsWith) and f.attribute == ("id",):
                self.prefixes.append(f.value)
            elif not (isinstance(f, IsNotNull) and f.attribute == ("kind",)):  # every stanza has a kind
                yield f


def _numbered(f: io.BufferedReader, start: int) -> Iterator[tuple[int, str]]:
    """(place, line) of the lines that begin at start or later."""
    at = max(0, start - 1)
    f.seek(at)
    if start:
        at += len(f.readline())
    for line in f:
        yield at, line.decode("utf-8", "replace").removeprefix("﻿" if not at else "")
        at += len(line)


class OboSource(DataSource):
    """Stanzas of ontology files. Options: path (a file or a folder), splitBytes, kinds (joined by commas), pushFilters."""

    @classmethod
    def name(cls) -> str:
        return "obo"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        push = self.options.get("pushFilters", "false").lower() == "true"
        return (FilteringReader if push else OboReader)(self.options)


def read_stanzas(spark: SparkSession, path: str, **options) -> DataFrame:
    """Stanzas of the files at a path, by the data source."""
    if options.get("pushFilters"):
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(OboSource)
    return spark.read.format("obo").options(**options).load(path)
