"""Versioned, checksummed bundles."""

from __future__ import annotations

import datetime as dt
import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.hashing import content_hash, rollup_hash, rollup_tree
from .functions.numbers import human_size
from .functions.text import search_text_library
from .operators.vectors import CellIndex, cell_count

README = """# Element bundle {bundle_version}

Made {created}. {n_elements} elements, {n_with_embedding} with embeddings.

Sources:
{sources}

elements/    the elements, without embeddings
embeddings/  accession, embedding
cells/       the cells of the search index, with centroids/
manifest.json lists every file with its size and SHA-256.
"""


LICENSE = """# Terms of use

The table's structure and the bundle's own notes are free to use. Its elements name concepts of other
authorities, each under that authority's terms; source_code and source_url lead to the definitions there:

{sources}

Content that its authority doesn't let others pass on is named by code only: ask the authority first.
"""


def derived(elements: DataFrame) -> DataFrame:
    """elements with search text and content hash where they lack them."""
    text = search_text_library("description", "source_authority", "source_code", "collection", "member_of_collections", "metadata_")
    out = elements.withColumn("search_text", F.coalesce("search_text", text))
    return out.withColumn("content_hash", F.coalesce("content_hash", content_hash(out)))


def write_bundle(elements: DataFrame, out: str, version: str, *, key: str = "accession", created: dt.date | None = None, index: bool = True, flat_hash: bool = True) -> dict:
    """Write elements, embeddings, index, manifest and notes below out; the manifest.

    rollup_tree is a digest of all content hashes that no single place has to read. With flat_hash there is
    rollup_hash as well, which other bundles have and which reads every hash in one order: leave it out of large ones.
    """
    spark = elements.sparkSession
    full = derived(elements)
    full.drop("embedding").write.option("compression", "zstd").parquet(f"{out}/elements")
    vectors = full.filter("embedding is not null").select(key, "embedding")
    unkeyed, repeated = vectors.agg(F.count_if(F.col(key).isNull()), F.count(key) - F.count_distinct(key)).first()
    if unkeyed or repeated:
        raise ValueError(f"{unkeyed} embeddings without {key}, {repeated} that share one")
    vectors.write.option("compression", "zstd").parquet(f"{out}/embeddings")
    written, stored = spark.read.parquet(f"{out}/elements"), spark.read.parquet(f"{out}/embeddings")
    n_vectors = stored.count()
    if index and n_vectors:
        CellIndex.build(stored, cell_count(n_vectors), key=key).write(f"{out}/index")
    manifest = {
        "bundle_version": version, "created": (created or dt.date.today()).isoformat(), "n_elements": written.count(), "n_with_embedding": n_vectors,
        "rollup_tree": rollup_tree(written).first()[0], **({"rollup_hash": rollup_hash(written).first()[0]} if flat_hash else {}),
        "sources": {r[0]: r[1] for r in written.groupBy("source_authority").agg(F.max("source_version")).orderBy("source_authority").collect()},
        "by_authority": {r[0]: r[1] for r in written.groupBy("source_authority").count().orderBy("source_authority").collect()},
        "files": file_manifest(spark, out),
    }
    _put(spark, f"{out}/manifest.json", json.dumps(manifest, indent=2, sort_keys=True))
    _put(spark, f"{out}/LICENSE.md", LICENSE.format(sources="\n".join(f"- {a}, version {v}" for a, v in sorted(manifest["sources"].items()))))
    _put(spark, f"{out}/README.md", README.format(**manifest | {"sources": "\n".join(f"- {a}: {v}" for a, v in manifest["sources"].items())}))
    return manifest


def file_manifest(spark: SparkSession, folder: str) -> list[dict]:
    """Path, size and SHA-256 of each file below a folder, hashed where the files are."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    rows = files.select("path", "length", F.sha2("content", 256).alias("sha256")).orderBy("path").collect()  # as many as files
    root = rows[0]["path"].split(folder.rstrip("/").split("://")[-1], 1)[0] if rows else ""
    return [{"path": r["path"].removeprefix(root).removeprefix(folder.split("://")[-1]).lstrip("/"), "bytes": r["length"], "size": human_size(r["length"]), "sha256": r["sha256"]} for r in rows]


def verify(spark: SparkSession, folder: str) -> list[str]:
    """Paths whose files are missing or differ from the manifest."""
    want = {f["path"]: f["sha256"] for f in json.loads(_get(spark, f"{folder}/manifest.json"))["files"]}
    have = {f["path"]: f["sha256"] for f in file_manifest(spark, folder)}
    return sorted(p for p, h in want.items() if have.get(p) != h)


def package_manifest(spark: SparkSession, folder: str, version: str, *, created: dt.date | None = None) -> dict:
    """Write folder/package.json: a finished bundle's tables with their rows and sizes, all counted; the manifest."""
    files = file_manifest(spark, folder)
    tables = {}
    for name in sorted({f["path"].split("/")[0] for f in files if f["path"].endswith(".parquet") and "/" in f["path"]}):
        own = [f for f in files if f["path"].startswith(f"{name}/")]
        rows = spark.read.option("recursiveFileLookup", "true").parquet(*[f"{folder}/{f['path']}" for f in own if f["path"].endswith(".parquet")]).count() if name != "index" else None
        tables[name] = {"rows": rows, "files": len(own), "bytes": sum(f["bytes"] for f in own), "size": human_size(sum(f["bytes"] for f in own))}
    total = sum(f["bytes"] for f in files)
    manifest = {"package_version": version, "created": (created or dt.date.today()).isoformat(), "tables": tables, "total_bytes": total, "total_size": human_size(total), "checksums": {f["path"]: f["sha256"] for f in files}}
    _put(spark, f"{folder}/package.json", json.dumps(manifest, indent=2, sort_keys=True))
    return manifest


def ingest_manifest(spark: SparkSession, path: str, downloads: list[dict], counts: dict[str, int], failures: dict[str, str] | None = None) -> dict:
    """Write what was fetched and staged, and what failed, as JSON; the manifest."""
    manifest = {
        "created": dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds"), "downloads": downloads, "sources": counts, "failures": failures or {}, "total_bytes": sum(d.get("bytes", 0) for d in downloads),
        "total_elements": sum(counts.values()),
    }
    _put(spark, path, json.dumps(manifest, indent=2, sort_keys=True))
    return manifest


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _put(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _path(spark, path)
    stream = fs.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def _get(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())


def text_sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
