"""Sources: archives of members, folders of XML, Markdown trees, collection listings and caches."""

from __future__ import annotations

import io
import stat
import zipfile
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.functions import text as T

SAMPLE_MEMBERS = 1000
CHUNK = 8 << 20
_MEMBERS = "archive string, member_no int, name string, raw binary, error string"


def safe_members(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    """Files of an archive; one absolute path, parent step or symbolic link rejects the whole archive, as does none at all."""
    found = []
    for info in archive.infolist():
        path = info.filename.replace("\\", "/")
        if path.startswith("/") or ".." in path.split("/") or stat.S_ISLNK(info.external_attr >> 16):
            raise ValueError(f"unsafe archive member: {info.filename}")
        if not info.is_dir():
            found.append(info)
    if not found:
        raise ValueError("archive without files")
    return found


def tested_members(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    """safe_members() of an archive of which every file can be read and has the right checksum; else ValueError.

    Encrypted files, unknown methods and damaged data raise different errors, all of which are told as one.
    """
    members = safe_members(archive)
    for info in members:
        try:
            with archive.open(info) as source:
                while source.read(CHUNK):
                    pass
        except (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError, NotImplementedError) as error:
            raise ValueError(f"unreadable archive member {info.filename}: {error}") from error
    return members


def zip_members(spark: SparkSession, path: str, sample: int | None = None, suffix: str = ".xml") -> DataFrame:
    """archive, member_no, name, raw, error of all members whose name ends in suffix, in archive order.

    Names are tested before anything is decompressed, and all files before any member is given. sample: only the
    first so many of each archive. A broken, unsafe or empty archive gives one row with its error and no member. An
    archive is one task's work; its members are given in batches of some MB.
    """

    types = (pa.string(), pa.int32(), pa.string(), pa.binary(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=["archive", "member_no", "name", "raw", "error"])

        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as z:
                        members = [m for m in tested_members(z) if m.filename.casefold().endswith(suffix)]
                        held, size = [], 0
                        for number, member in enumerate(members[:sample]):
                            held.append((archive, number, member.filename, z.read(member), None))
                            size += member.file_size
                            if size >= CHUNK:
                                yield rows(held)
                                held, size = [], 0
                        if held:
                            yield rows(held)
                except (ValueError, zipfile.BadZipFile) as error:
                    yield rows([(archive, None, None, None, str(error))])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content").mapInArrow(run, _MEMBERS)


def xml_folder(spark: SparkSession, path: str) -> DataFrame:
    """source, raw of all XML files below a folder; sort by order_of(source) where their order matters."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").load(path)
    return files.select(F.col("path").alias("source"), F.col("content").alias("raw"))


def order_of(path: str) -> Column:
    """Paths in the order in which folders are walked: part by part, without case."""
    return F.split(T.casefold(F.col(path)), "/")


def markdown_tree(spark: SparkSession, path: str) -> DataFrame:
    """path, raw and the head's map of all Markdown files; bad is true where the head cannot be read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(path)
    raw = files.select("path", F.decode("content", "UTF-8").alias("raw"))
    return raw.withColumns({"head": T.read_front_matter("raw"), "bad": ~F.startswith("raw", F.lit("---")) | (F.size(T.head_errors("raw")) > 0)})


def urn_index(tree: DataFrame, last_wins: bool = False) -> DataFrame:
    """urn, path: the first path of each urn (the last, for updates); files that cannot be read are left out.

    Paths are compared part by part, as file trees are walked.
    """
    known = tree.where("NOT bad").select(F.col("head")["urn"].alias("urn"), "path").where("urn IS NOT NULL")
    order = F.split("path", "/")
    return known.groupBy("urn").agg((F.max_by if last_wins else F.min_by)("path", order).alias("path"))


def updated_index(index: DataFrame, changed: DataFrame) -> DataFrame:
    """index with the rows of changed put in or replaced."""
    return index.join(changed, "urn", "left_anti").unionByName(changed)


def collections(spark: SparkSession, path: str) -> DataFrame:
    """A saved listing of collections, with the position of each row; TypeError if it is no list."""
    if (spark.read.text(path, wholetext=True).first() or [""])[0].lstrip()[:1] != "[":
        raise TypeError("a listing of collections must be a list")
    rows = spark.read.option("multiLine", "true").schema("nomeCollezione string, nome string, formatoCollezione string, dataCreazione string").json(path)
    return rows.withColumn("pos", F.monotonically_increasing_id())


def download_params(rows: DataFrame) -> DataFrame:
    """What is asked of the archive service for each collection; a format that is not known becomes V."""
    wanted = F.upper(F.trim(F.coalesce("formatoCollezione", F.lit(""))))
    return rows.select(F.coalesce("nomeCollezione", F.lit("")).alias("nome"), F.coalesce("dataCreazione", F.lit("")).alias("data"), F.when(wanted.isin("O", "V", "M"), wanted).otherwise("V").alias("formato"))


def cache_check(spark: SparkSession, path: str, inventory: DataFrame) -> DataFrame:
    """name, valid of cached archives: every file must be readable, and digest, size and number of files those of the inventory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for content in batch.column(3):
                try:
                    with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as z:
                        counts.append(len(tested_members(z)))
                except (ValueError, zipfile.BadZipFile):
                    counts.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.int64())], names=["name", "have_sha256", "have_size", "have_members"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    have = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("have_sha256"), F.col("length").alias("have_size"), "content")
    both = have.mapInArrow(run, "name string, have_sha256 string, have_size long, have_members long").join(inventory.select("name", "sha256", "size", "members"), "name", "left")
    same = reduce(Column.__and__, (F.col(f"have_{c}") == F.col(c) for c in ("sha256", "size", "members")))
    return both.select("name", F.coalesce(same, F.lit(False)).alias("valid"))


def article_counts(candidates: DataFrame, code: str = "codice_redazionale", articles: str = "source_articles") -> DataFrame:
    """code, max_articles: the most articles that any candidate of a code has."""
    return candidates.groupBy(F.col(code).alias("code")).agg(F.max(articles).alias("max_articles"))


def missing_sources(sources: DataFrame, article_counts: DataFrame) -> DataFrame:
    """Sources (code, min_articles, ...) of which fewer articles were seen than they need."""
    return sources.join(article_counts.select("code", "max_articles"), "code", "left").where("coalesce(max_articles, 0) < min_articles").drop("max_articles")


def article_rows(texts: DataFrame) -> DataFrame:
    """Articles of side sources (source, pos, number, text) with ids: a number that comes again gets _2, _3 and so on."""
    nth = F.row_number().over(Window.partitionBy("source", "number").orderBy("pos"))
    again = F.when(F.col("nth") > 1, F.concat(F.lit("_"), F.col("nth").cast("string"))).otherwise(F.lit(""))
    return texts.withColumn("nth", nth).select("source", "pos", "number", F.concat(F.lit("art_"), "number", again).alias("eid"), F.split("text", r"\R").alias("paragraphs"))


def xml_text(value: Column) -> Column:
    """Text as XML character data or as an attribute; characters that XML cannot hold become U+FFFD."""
    out = F.regexp_replace(F.coalesce(value, F.lit("")), r"[^\t\n\r\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]", "\uFFFD")
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def side_members(sources: DataFrame, articles: DataFrame, collection: str, source_format: str = "V") -> DataFrame:
    """Raw members (collection, source_format, source, raw) made of side sources (code, urn, type, number, date, title) and article_rows().

    A source without articles has no member. A source's articles meet in one row, as its file does.
    """
    lines = F.array_join(F.transform("paragraphs", lambda p: F.concat(F.lit("<p>"), xml_text(p), F.lit("</p>"))), "")
    article = F.concat(F.lit('<article eId="'), xml_text(F.col("eid")), F.lit('"><num>Art. '), xml_text(F.col("number")), F.lit("</num><paragraph><content>"), lines, F.lit("</content></paragraph></article>"))
    bodies = articles.select(F.col("source").alias("code"), "pos", article.alias("xml")).groupBy("code").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "xml"))), lambda x: x["xml"]), "").alias("body"))
    of = {c: xml_text(F.col(c)) for c in ("code", "urn", "type", "number", "date", "title")}
    whole = F.concat(
        F.lit('<akomaNtoso xmlns="http://docs.oasis-open.org/legaldocml/ns/akn/3.0" xmlns:eli="http://data.europa.eu/eli/ontology#"><act><meta><identification><FRBRWork><FRBRalias name="urn:nir" value="'), of["urn"],
        F.lit('"/></FRBRWork></identification><proprietary><eli:id_local>'), of["code"], F.lit("</eli:id_local></proprietary></meta><preface><docType>"), of["type"], F.lit("</docType><docNumber>"), of["number"],
        F.lit('</docNumber><docDate date="'), of["date"], F.lit('"/><docTitle>'), of["title"], F.lit("</docTitle></preface><body>"), F.col("body"), F.lit("</body></act></akomaNtoso>"),
    )
    return sources.join(bodies, "code").select(F.lit(collection).alias("collection"), F.lit(source_format).alias("source_format"), F.concat("code", F.lit(".xml")).alias("source"), F.encode(whole, "UTF-8").alias("raw"))
