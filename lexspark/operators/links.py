"""References between acts: resolved by one join with the complete index, then put into templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.sources.akn import LINK


def references(chosen: DataFrame) -> DataFrame:
    """urn, repo_path, pos, href, label of every open link of acts (urn, repo_path, links)."""
    return chosen.select("urn", "repo_path", F.posexplode("links").alias("pos", "link")).select("urn", "repo_path", "pos", "link.href", "link.label")


def _same_folder_link(path: Column) -> Column:
    return T.encode_link(F.element_at(F.split(path, "/"), -1))


def resolve(refs: DataFrame, index: DataFrame) -> DataFrame:
    """refs with `target`, `kind` and `rendered`. index: urn, path of all acts, which lie in one folder.

    The link is internal if the index has its urn, else external if it names anything, else unresolved. Spark
    broadcasts the index only while its size allows it.
    """
    keyed = refs.withColumn("lookup", T.lookup_urn("href"))
    joined = keyed.join(index.select(F.col("urn").alias("lookup"), F.col("path").alias("target")), "lookup", "left")
    own = T.fragment_slug(T.fragment("href"))
    inside = F.concat(_same_folder_link(F.col("target")), F.when(T.fragment("href") != "", F.concat(F.lit("#"), T.encode_link(own))).otherwise(F.lit("")))
    link = F.coalesce(inside, T.resolver_url("href"))
    empty = F.col("href") == ""
    rendered = F.when(empty, F.col("label")).otherwise(F.concat(F.lit("["), "label", F.lit("]("), link, F.lit(")")))
    kind = F.when(empty, "unresolved").when(F.col("target").isNotNull(), "internal").when(F.col("lookup") != "", "external").otherwise("unresolved")
    return joined.withColumn("kind", kind).withColumn("rendered", rendered).drop("lookup")


def edges(resolved: DataFrame) -> DataFrame:
    """source path, target path and number of references: the graph of acts."""
    return resolved.where("kind = 'internal'").groupBy(F.col("repo_path").alias("source"), "target").agg(F.count(F.lit(1)).alias("n_links"))


def shown(resolved: DataFrame) -> DataFrame:
    """urn, shown (its links as written, in order) and how many there are of each kind."""
    counts = [F.count_if(F.col("kind") == k).alias(f"{k}_links") for k in ("internal", "external", "unresolved")]
    return resolved.groupBy("urn").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "rendered"))), lambda x: x["rendered"]).alias("shown"), *counts)


def render(joined: DataFrame) -> DataFrame:
    """Acts with their columns of shown(), if they have links, as acts with body, markdown and link counts: link marks are filled in order."""
    parts = F.split("template", LINK)
    filled = F.array_join(F.transform(parts, lambda p, i: F.concat(p, F.coalesce(F.get("shown", i), F.lit("")))), "")
    counted = joined.withColumn("body", filled).withColumns({f"{k}_links": F.coalesce(f"{k}_links", F.lit(0)) for k in ("internal", "external")} | {"unresolved_links": F.coalesce("unresolved_links", F.lit(0)) + F.col("dead_links")})
    return counted.withColumn("markdown", F.concat(T.front_matter(), "body", F.lit("\n"))).drop("shown", "template", "links", "dead_links")
