"""Articles with half-open validity [valid_from, valid_to): extraction, versions, point-in-time lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_MARK = r'<a id="([^"]+)" data-akn-name="article"(?: data-valid-from="([^"]+)")?(?: data-valid-to="([^"]+)")?></a>\n'


def in_force(day: str | Column, valid_from: str = "valid_from", valid_to: str = "valid_to") -> Column:
    day = F.lit(day) if isinstance(day, str) else day
    start, end = F.col(valid_from), F.col(valid_to)
    return (start.isNull() | (start <= day)) & (end.isNull() | (end > day))


def articles(documents: DataFrame) -> DataFrame:
    """document_urn, anchor, version, valid_from, valid_to, text of documents (urn, text), from their anchors.

    Text runs to the next article's anchor; version counts an anchor's occurrences in text order.
    """
    split = F.split("text", rf"(?={_MARK.replace('(', '(?:').replace('(?:?:', '(?:')}#+ )")
    parts = documents.select(F.col("urn").alias("document_urn"), F.posexplode(split).alias("pos", "part"))
    group = lambda i: F.regexp_extract("part", rf"\A{_MARK}(?=#+ )", i)
    rows = parts.select("document_urn", "pos", group(1).alias("anchor"), F.nullif(group(2), F.lit("")).alias("valid_from"), F.nullif(group(3), F.lit("")).alias("valid_to"), F.regexp_replace(F.regexp_replace("part", rf"\A{_MARK}", ""), r"\A\s+|\s+\z", "").alias("text"))
    return numbered(rows.where("anchor != ''"), ["document_urn", "anchor"], "pos").select("document_urn", "anchor", "version", "valid_from", "valid_to", "text")


def numbered(rows: DataFrame, keys: list[str], *order: str, name: str = "version") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def latest(rows: DataFrame, *keys: str) -> DataFrame:
    """The applicable row of each key: latest valid_from (none is earliest), then highest version; no sort."""
    best = F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), F.struct(F.coalesce("valid_from", F.lit("")), "version"))
    return rows.groupBy(*keys).agg(best.alias("best")).select(*keys, "best.*")


def article_as_of(article_table: DataFrame, urn: str, anchor: str, day: str | None = None) -> DataFrame:
    """At most one row: the article, as in force on the day if one is given."""
    rows = article_table.where((F.col("document_urn") == urn) & (F.col("anchor") == anchor))
    return latest(rows.where(in_force(day)) if day else rows, "document_urn", "anchor")
