"""Canonical selection: one candidate an identifier, paths for those that share an editorial code, memberships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexspark.functions import text as T

#: Which source format is canonical; downloads prefer another order.
CANONICAL_ORDER = {"V": 0, "M": 1, "O": 2}
DOWNLOAD_ORDER = ("V", "O", "M")


#: What rank() and links need of a candidate; its body is not.
RANKED = ("codice_redazionale", "links", "folded_collection", "folded_source", "source", "collection", "source_format", "digest")


def rank(priorities: tuple[str, ...] = ("codici",)) -> Column:
    """Format, first priority name within the collection's name, collection, source; smaller is better.

    What is equal in all of these goes by source, collection and a digest of the content, so only equal rows tie.
    """
    place = F.coalesce(*[F.when(F.contains("folded_collection", F.lit(p.strip().casefold())), F.lit(i)) for i, p in enumerate(priorities) if p.strip()], F.lit(len(priorities)))
    formats = F.create_map(*[F.lit(x) for kv in CANONICAL_ORDER.items() for x in kv])
    names = [F.col(c) for c in ("folded_collection", "folded_source", "source", "collection", "digest")]
    return F.struct(F.coalesce(F.try_element_at(formats, F.col("source_format")), F.lit(9)).alias("format"), place.alias("place"), *names)


def best_of(candidates: DataFrame, priorities: tuple[str, ...] = ("codici",)) -> DataFrame:
    """urn, rank, codice_redazionale, path_suffix, repo_path of each urn's best candidate: no body is moved."""
    ranks = candidates.select("urn", "codice_redazionale", rank(priorities).alias("rank"))
    best = ranks.groupBy("urn").agg(F.min("rank").alias("rank"), F.min_by("codice_redazionale", "rank").alias("codice_redazionale"))
    return with_paths(best)


def picked(candidates: DataFrame, best: DataFrame, priorities: tuple[str, ...] = ("codici",)) -> DataFrame:
    """The rows of candidates that best names by urn and rank, with its other columns: bodies are shuffled at most once."""
    more = best.select("urn", "rank", *[c for c in best.columns if c not in candidates.columns and c != "rank"])
    return candidates.withColumn("rank", rank(priorities)).join(more, ["urn", "rank"]).dropDuplicates(["urn", "rank"]).drop("rank")


def select_canonical(candidates: DataFrame, priorities: tuple[str, ...] = ("codici",)) -> DataFrame:
    """The best candidate of each urn with path_suffix and repo_path."""
    return picked(candidates, best_of(candidates, priorities), priorities)


def with_paths(chosen: DataFrame, code: str = "codice_redazionale", urn: str = "urn") -> DataFrame:
    """chosen with path_suffix and repo_path; a code that several rows share is told apart by a digest of the urn."""
    shared = chosen.groupBy(code).agg((F.count(F.lit(1)) > 1).alias("shared"))
    joined = chosen.join(shared, code)
    suffix = F.when(F.col("shared"), T.collision_suffix(urn)).otherwise(F.lit(""))
    return joined.withColumn("path_suffix", suffix).withColumn("repo_path", T.repo_path(code, "path_suffix")).drop("shared")


def duplicate_count(candidates: DataFrame, urn: str = "urn") -> DataFrame:
    return candidates.agg((F.count(F.lit(1)) - F.count_distinct(urn)).alias("duplicates"))


def memberships(candidates: DataFrame) -> DataFrame:
    """collection, urn over all candidates, not only canonical ones."""
    return candidates.select("collection", "urn").distinct()


def inverted_index(documents: DataFrame, code: str = "codice_redazionale") -> DataFrame:
    """For each code its (path, urn) pairs in order of urn."""
    pairs = F.array_sort(F.collect_list(F.struct("urn", "repo_path")))
    return documents.groupBy(code).agg(F.transform(pairs, lambda p: F.struct(p["repo_path"].alias("path"), p["urn"].alias("urn"))).alias("documents"))


def merge_collections(rows: DataFrame, pos: str = "pos") -> DataFrame:
    """One row a collection name in order of first sight: the format to ask for, its first row, all formats."""
    name = F.trim(F.coalesce(F.nullif("nomeCollezione", F.lit("")), "nome", F.lit("")))
    code = F.upper(F.trim(F.coalesce("formatoCollezione", F.lit(""))))
    preference = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, DOWNLOAD_ORDER)), code), F.lit(0)), F.lit(9))
    named = rows.select(name.alias("name"), code.alias("code"), preference.alias("preference"), F.col(pos).alias("pos"), "dataCreazione").where("name != ''")
    # Without any known format the request falls back to the first, and no row of it exists: the first row is taken.
    best = F.min_by(F.struct("code", "dataCreazione", "preference"), F.struct("preference", "pos"))
    grouped = named.groupBy("name").agg(F.min("pos").alias("pos"), best.alias("best"), F.array_sort(F.collect_set(F.when(F.col("preference") < 9, F.col("code")))).alias("formatiDisponibili"))
    chosen = F.when(F.col("best.preference") < 9, F.col("best.code")).otherwise(DOWNLOAD_ORDER[0])
    return grouped.select(F.col("name").alias("nomeCollezione"), chosen.alias("formatoCollezione"), F.col("best.dataCreazione").alias("dataCreazione"), "formatiDisponibili", "pos")
