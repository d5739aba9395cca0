"""Sinks: Markdown files, Parquet, JSON lines, SQLite, checksums and archives."""

from __future__ import annotations

import hashlib
import json
import sqlite3
import tarfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.sources import akn

DOCUMENTS = ("urn", "codice_redazionale", "tipo", "data", "titolo", "stato_atto", "valid_from", "valid_to", "path", "text")
ARTICLES = ("document_urn", "anchor", "version", "valid_from", "valid_to", "text")


def write_tables(folder: str, **tables: DataFrame) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}.parquet")


def write_jsonl(table: DataFrame, folder: str) -> None:
    """One record a document in order of path, keys sorted; range-partitioned, so parts in order are the whole."""
    table.select(*sorted(table.columns)).orderBy("path").write.mode("overwrite").option("ignoreNullFields", "false").option("compression", "gzip").json(folder)


def write_rejected(parsed: DataFrame, raw_members: DataFrame, folder: str) -> None:
    """Rejected payloads (name, collection, source, error, raw), named by the digest of their collection and source.

    A source that repeats has one row for each of its payloads that fails.
    """
    bad = parsed.where("error IS NOT NULL").select("collection", "source", "error").distinct()
    failed = raw_members.join(bad.select("collection", "source").distinct(), ["collection", "source"], "left_semi")
    again = akn.parse_members(failed.withColumn("source_format", F.lit("")).select("collection", "source_format", "source", "raw"), keep_raw=True)
    rows = again.where("error IS NOT NULL").withColumn("name", F.concat(F.sha2(F.concat_ws("/", "collection", "source"), 256), F.lit(".xml")))
    rows.select("name", "collection", "source", "error", "raw").write.mode("overwrite").parquet(folder)


def write_sqlite(document_table: DataFrame, article_table: DataFrame, path: str) -> None:
    """An export for single machines: rows stream to the driver partition by partition."""
    with sqlite3.connect(path) as db:
        db.executescript(
            f"""CREATE TABLE documents ({', '.join(DOCUMENTS)}, PRIMARY KEY (urn));
            CREATE TABLE articles ({', '.join(ARTICLES)}, PRIMARY KEY (document_urn, anchor, version));
            CREATE VIRTUAL TABLE documents_fts USING fts5(urn UNINDEXED, titolo, text);
            CREATE INDEX documents_filters ON documents (tipo, data, stato_atto, valid_from, valid_to);
            CREATE INDEX articles_validity ON articles (document_urn, valid_from, valid_to);"""
        )
        for name, columns, table in (("documents", DOCUMENTS, document_table), ("articles", ARTICLES, article_table)):
            insert = f"INSERT INTO {name} VALUES ({', '.join('?' * len(columns))})"
            db.executemany(insert, map(tuple, table.select(*columns).toLocalIterator()))
        db.execute("INSERT INTO documents_fts SELECT urn, titolo, text FROM documents")


def write_texts(files: DataFrame, folder: str) -> DataFrame:
    """Writes rows (path, text) as files below folder (any URI of Arrow's file systems) and returns path and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            sizes = []
            for path, text in zip(*(c.to_pylist() for c in batch.columns)):
                fs.create_dir(f"{root}/{path}".rpartition("/")[0], recursive=True)
                with fs.open_output_stream(f"{root}/{path}") as out:
                    out.write(raw := text.encode())
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["path", "bytes"])

    return files.select("path", "text").mapInArrow(run, "path string, bytes long")


def write_markdown(rendered: DataFrame, folder: str) -> DataFrame:
    """Writes every act's file."""
    return write_texts(rendered.select(F.col("repo_path").alias("path"), F.col("markdown").alias("text")), folder)


def write_collections(collections: DataFrame, folder: str) -> DataFrame:
    """Writes every collection's file (slug, json)."""
    return write_texts(collections.select(F.concat(F.lit("collections/"), "slug", F.lit(".json")).alias("path"), F.concat("json", F.lit("\n")).alias("text")), folder)


def _store(spark: SparkSession, path: str):
    """Spark's file system of a path, and the path; for single small files of the driver."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def write_text(spark: SparkSession, text: str, path: str) -> None:
    fs, at = _store(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; null if there is none, or none that can be read."""
    fs, at = _store(spark, path)
    try:
        return spark.read.text(path, wholetext=True).first()["value"] if fs.exists(at) else None
    except (PySparkException, Py4JJavaError):
        return None


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    write_text(spark, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n", path)


def read_json(spark: SparkSession, path: str) -> dict:
    """A small JSON file; empty if there is none or it is damaged."""
    try:
        value = json.loads(read_text(spark, path) or "{}")
    except ValueError:
        return {}
    return value if isinstance(value, dict) else {}


CHUNK = 8 << 20
#: Their own checksums would change with them.
UNSUMMED = ("SHA256SUMS",)


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """name, sha256 of what lies in a folder: of each file its digest, of each table that of its files' names and digests.

    Files are read by pieces in tasks; only their names go through the driver.
    """
    fs, at = _store(spark, folder)
    found, root = [], fs.makeQualified(at).toString().rstrip("/")
    listing = fs.listFiles(at, True)
    while listing.hasNext():
        path = listing.next().getPath().toString()
        inner = path[len(root) + 1 :]
        hidden = any(part[0] in "._" for part in inner.split("/"))
        if not hidden and inner not in UNSUMMED:
            found.append((inner.split("/")[0], inner, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for path in batch.column(2).to_pylist():
                store, name = pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
                digest = hashlib.sha256()
                with store.open_input_stream(name) as source:
                    while piece := source.read(CHUNK):
                        digest.update(piece)
                sums.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sums, pa.string())], names=["name", "path", "sha256"])

    files = spark.createDataFrame(found, "name string, path string, uri string")
    summed = files.repartition(max(1, len(found)), "uri").mapInArrow(run, "name string, path string, sha256 string")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "sha256"))), lambda f: F.concat(f["sha256"], F.lit("  "), f["path"])), "\n")
    whole = F.when(F.max("path") == F.col("name"), F.max("sha256")).otherwise(F.sha2(listed, 256))
    return summed.groupBy("name").agg(whole.alias("sha256"))


def write_checksums(spark: SparkSession, folder: str) -> None:
    """SHA256SUMS of a folder's files and tables, by name."""
    rows = [f"{r['sha256']}  {r['name']}" for r in digests(spark, folder).orderBy("name").collect()]  # a row a table
    write_text(spark, "\n".join([*rows, ""]), f"{folder}/SHA256SUMS")


def write_tar(folder: str, path: str, level: int = 10) -> None:
    """A tar.zst of a local folder that depends on names and contents alone; files pass through by pieces."""
    with open(path, "wb") as out, zstandard.ZstdCompressor(level=level, threads=-1).stream_writer(out) as packed, tarfile.open(fileobj=packed, mode="w|") as tar:
        for p in sorted(x for x in Path(folder).rglob("*") if x.is_file()):
            info = tarfile.TarInfo(p.relative_to(folder).as_posix())
            info.size, info.mtime = p.stat().st_size, 0
            with p.open("rb") as source:
                tar.addfile(info, source)
