"""Snapshot tables: counts, indexes, manifest, delta, and their verification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions import text as T


def collection_counts(parsed: DataFrame, rendered: DataFrame) -> DataFrame:
    """collection, xml_received, skipped (of all members) and converted, articles (credited to the winner's collection)."""
    seen = parsed.groupBy("collection").agg(F.count(F.lit(1)).alias("xml_received"), F.count_if(F.col("error").isNotNull()).alias("skipped"))
    made = rendered.groupBy("collection").agg(F.count(F.lit(1)).alias("converted"), F.sum(F.size("intervals")).alias("articles"))
    return seen.join(made, "collection", "full").na.fill(0)


def by_type(documents: DataFrame) -> DataFrame:
    return documents.groupBy(F.coalesce(F.nullif("tipo", F.lit("")), F.lit("ignoto")).alias("tipo")).agg(F.count(F.lit(1)).alias("n"))


def by_year(documents: DataFrame) -> DataFrame:
    return documents.groupBy(T.year_bucket("data").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def urn_index(names: DataFrame) -> DataFrame:
    """urn, path, code of every act."""
    return names.select("urn", F.col("repo_path").alias("path"), F.col("codice_redazionale").alias("code"))


def files(rendered: DataFrame) -> DataFrame:
    return rendered.select(F.col("repo_path").alias("path"), T.sha256_text("markdown").alias("sha256"))


def delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """change (added, removed, modified), path, before, after of two tables (path, sha256); what is equal is left out."""
    both = before.select("path", F.col("sha256").alias("before")).join(after.select("path", F.col("sha256").alias("after")), "path", "full")
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("modified")
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).select(change.alias("change"), "path", "before", "after")


def collection_files(memberships: DataFrame) -> DataFrame:
    """slug, name, json of each collection's file."""
    urns = memberships.groupBy(F.col("collection").alias("name")).agg(F.sort_array(F.collect_set("urn")).alias("urns"))
    slug = F.array_join(F.filter(F.split(F.lower("name"), r"\s+"), lambda w: w != ""), "-")
    return urns.select(slug.alias("slug"), "name", F.to_json(F.struct(F.lit(T.SCHEMA_VERSION).alias("schema_version"), "name", "urns")).alias("json"))


def documents(rendered: DataFrame, null_text: bool = False) -> DataFrame:
    """The table that serves documents. null_text writes missing values as the text null, as heads do."""
    shown = lambda c: F.coalesce(F.col(c), F.lit("null")) if null_text else F.col(c)
    return rendered.select("urn", "codice_redazionale", shown("tipo").alias("tipo"), shown("data").alias("data"), shown("titolo").alias("titolo"), "stato_atto", shown("entrata_in_vigore").alias("valid_from"), shown("abrogazione_data").alias("valid_to"), F.col("repo_path").alias("path"), F.regexp_replace("body", r"\A\s+|\s+\z", "").alias("text"))


def index_failures(index: DataFrame, inverted: DataFrame) -> DataFrame:
    """Failures of index rows (urn, path, code) that the inverted index (code, documents) lacks."""
    listed = inverted.select("code", F.explode("documents").alias("d")).select("code", "d.path", "d.urn")
    return index.join(listed, ["code", "path", "urn"], "left_anti").select(F.concat(F.lit("index reference: "), "urn").alias("failure"))


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two tables has; empty if their sets are equal."""
    both = left.select(key, F.lit(1).alias("l")).distinct().join(right.select(key, F.lit(1).alias("r")).distinct(), key, "full")
    return both.where("l IS NULL OR r IS NULL").select(key)


def orphans(article_table: DataFrame, document_table: DataFrame) -> DataFrame:
    return article_table.join(document_table.select(F.col("urn").alias("document_urn")), "document_urn", "left_anti").select("document_urn").distinct()


def checksum_failures(sums: DataFrame, have: DataFrame) -> DataFrame:
    """Failures of lines (line) of a checksum file against files (name, sha256)."""
    cut = F.split("line", "  ", 2)
    rows = sums.select("line", F.get(cut, F.lit(0)).alias("digest"), F.get(cut, F.lit(1)).alias("name"))
    good = F.coalesce((F.length("digest") == 64) & (F.col("name") != "") & ~F.contains("name", F.lit("/")), F.lit(False))
    bad = rows.where(~good).select(F.concat(F.lit("malformed checksum line: "), "line").alias("failure"))
    wrong = rows.where(good).join(have.select("name", F.col("sha256").alias("digest")), ["name", "digest"], "left_anti").select(F.concat(F.lit("checksum: "), "name").alias("failure"))
    return bad.unionByName(wrong)


def verify(document_table: DataFrame, article_table: DataFrame, index: DataFrame, inverted: DataFrame, acts: int | None, articles: int | None) -> DataFrame:
    """All failures of a snapshot's tables against each other and against the manifest's counts; an empty one is verified."""
    told = lambda df, text: df.limit(1).select(F.lit(text).alias("failure"))
    count = lambda df, n: df.agg(F.count(F.lit(1)).alias("n")).where(~F.col("n").eqNullSafe(F.lit(n)))
    return reduce(
        DataFrame.unionByName,
        (
            index_failures(index, inverted),
            told(orphans(article_table, document_table), "foreign keys of articles"),
            told(set_difference(document_table, index, "urn"), "document references"),
            told(count(document_table, acts), "document count"),
            told(count(article_table, articles), "article count"),
        ),
    )
