"""A snapshot from raw members: parse, choose, resolve, render, check, write. Nothing is published unless every gate passes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import canonical, gates, links, search, snapshot, temporal
from lexspark.sources import akn, sinks
from lexspark.staging import new_folder, staged


@dataclass(frozen=True)
class Snapshot:
    """Tables of a snapshot. parsed and names (one narrow row an act) are staged; the others are read from these."""

    parsed: DataFrame
    candidates: DataFrame
    errors: DataFrame
    names: DataFrame
    resolved: DataFrame
    rendered: DataFrame
    documents: DataFrame
    articles: DataFrame


def plan(raw_members: DataFrame, priorities: tuple[str, ...] = ("codici",)) -> Snapshot:
    """All tables of a snapshot. Members are parsed once, here, into the shared folder."""
    return plan_parsed(staged(akn.parse_members(raw_members), "parsed"), priorities)


def plan_parsed(parsed: DataFrame, priorities: tuple[str, ...] = ("codici",)) -> Snapshot:
    """All tables of a snapshot from a stored table of parsed members.

    What is chosen, named and linked is found over narrow rows and staged; each body is then joined with its own row
    of these once.
    """
    candidates = akn.candidates(parsed)
    best = staged(canonical.best_of(candidates, priorities), "best")
    linked = canonical.picked(candidates.select("urn", *canonical.RANKED), best, priorities)
    resolved = links.resolve(links.references(linked), best.select("urn", F.col("repo_path").alias("path")))
    names = staged(best.join(links.shown(resolved), "urn", "left"), "names")
    rendered = links.render(canonical.picked(candidates, names, priorities))
    documents = snapshot.documents(rendered)
    return Snapshot(parsed, candidates, akn.errors(parsed), names, resolved, rendered, documents, temporal.articles(documents))


def gathered(*members: DataFrame) -> DataFrame:
    """Members of archives and of side sources as one table of raw members."""
    return reduce(DataFrame.unionByName, (m.select("collection", "source_format", "source", "raw") for m in members))


@dataclass(frozen=True)
class Rules:
    """What a snapshot is held against. day: that on which exceptions must not have expired.

    required: code, min_articles, required_anchors; exceptions: see gates.allowed_errors; previous: the folder of the
    snapshot before. None of them is checked if it isn't given.
    """

    day: str
    required: DataFrame | None = None
    exceptions: DataFrame | None = None
    previous: str | None = None
    known_gaps: tuple[str, ...] = ()


@dataclass(frozen=True)
class Asked:
    """How many collections were asked for and received."""

    requested: int = 0
    downloaded: int = 0


EXCEPTIONS = "metric string, collection string, expected_value int, expected_sources array<string>, message string, reason string, expires string"


def metrics(made: Snapshot) -> DataFrame:
    """collection (`*`: all), metric, value: every count that a manifest has."""
    whole = made.rendered.agg(F.count(F.lit(1)).alias("acts"), F.coalesce(F.sum(F.size("intervals")), F.lit(0)).alias("articles"), *(F.coalesce(F.sum(f"{k}_links"), F.lit(0)).alias(f"{k}_links") for k in ("internal", "external", "unresolved")))
    seen = made.parsed.agg(F.count(F.lit(1)).alias("xml_received"), F.count_if(F.col("error").isNotNull()).alias("skipped"))
    frames = [whole, seen, canonical.duplicate_count(made.candidates)]
    rows = [df.select(F.lit("*").alias("collection"), F.explode(F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(c).cast("long"))])).alias("metric", "value")) for df in frames]
    each = snapshot.collection_counts(made.parsed, made.rendered)
    counted = F.explode(F.create_map(*[x for c in each.columns if c != "collection" for x in (F.lit(c), F.col(c).cast("long"))])).alias("metric", "value")
    return reduce(DataFrame.unionByName, [*rows, each.select("collection", counted)])


def manifest(made: Snapshot, coverage_date: str, generated_at: str, counts: DataFrame | None = None, asked: Asked = Asked(), known_gaps: Iterable[str] = ()) -> dict:
    """The manifest, from aggregates. What grows with the corpus (files, errors) are tables beside it."""
    by_collection: dict[str, dict[str, int]] = {}
    for r in (metrics(made) if counts is None else counts).orderBy("collection", "metric").collect():  # some rows a collection
        by_collection.setdefault(r["collection"], {})[r["metric"]] = r["value"]
    tags = made.rendered.select(F.explode("unsupported_tags").alias("t")).distinct().orderBy("t").collect()
    return {
        "schema_version": T.SCHEMA_VERSION,
        "generated_at": generated_at,
        "coverage_date": coverage_date,
        "source_format": "AKN",
        "collections": {"requested": asked.requested, "downloaded": asked.downloaded},
        "counts": by_collection.pop("*", {}),
        "by_collection": by_collection,
        "by_type": {r["tipo"]: r["n"] for r in snapshot.by_type(made.rendered).orderBy("tipo").collect()},
        "by_year": {r["year"]: r["n"] for r in snapshot.by_year(made.rendered).orderBy("year").collect()},
        "unsupported_tags": [r["t"] for r in tags],
        "known_gaps": list(known_gaps),
    }


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def failures(spark: SparkSession, folder: str, made: Snapshot, rules: Rules) -> DataFrame:
    """All failures of a written draft: of its report, its coverage, and against the snapshot before."""
    none = spark.createDataFrame([], EXCEPTIONS)
    excused = none if rules.exceptions is None else gates.active(rules.exceptions, rules.day)
    documents, counts = stored(spark, folder, "documents"), stored(spark, folder, "metrics")
    errors = stored(spark, folder, "errors").withColumn("error_id", F.sha2(F.concat_ws("\n", "collection", "source", "message"), 256))
    one = documents.agg(F.count(F.lit(1)).alias("converted"), F.count_distinct("urn").alias("urns"), F.count_if(F.coalesce("codice_redazionale", F.lit("")) != "").alias("codes"))
    skipped = counts.where("collection = '*' AND metric = 'skipped'").agg(F.coalesce(F.max("value"), F.lit(0)).alias("skipped"))
    found = [gates.report_failures(one.crossJoin(skipped), errors, excused)]  # one row each
    if rules.required is not None:
        anchors = made.rendered.select(F.col("codice_redazionale").alias("code"), F.explode(T.anchors("body")).alias("anchor")).join(rules.required.select("code").distinct(), "code", "left_semi").distinct()
        acts = made.rendered.select(F.col("codice_redazionale").alias("code"), F.col("repo_path").alias("path"), F.size("intervals").alias("articles"))
        found.append(gates.coverage_failures(rules.required, acts, anchors))
    if rules.previous:
        before = stored(spark, rules.previous, "metrics")
        found.append(gates.regressions(counts, before, excused))
        found.append(gates.disappeared(stored(spark, folder, "files"), stored(spark, rules.previous, "files"), excused))
    return reduce(DataFrame.unionByName, found)


def write(made: Snapshot, folder: str) -> None:
    """Tables of a snapshot, without its manifest: a draft that nothing serves yet."""
    spark = made.parsed.sparkSession
    sinks.write_tables(
        folder,
        documents=made.documents,
        errors=made.errors,
        files=snapshot.files(made.rendered),
        metrics=metrics(made),
        urn_index=snapshot.urn_index(made.names),
        code_index=canonical.inverted_index(made.names.withColumnRenamed("codice_redazionale", "code"), "code"),
        memberships=canonical.memberships(made.candidates),
        references=made.resolved,
        edges=links.edges(made.resolved),
    )
    documents = stored(spark, folder, "documents")
    sinks.write_tables(folder, articles=temporal.articles(documents), postings=search.postings(documents), totals=search.totals(documents), collections=snapshot.collection_files(stored(spark, folder, "memberships")))


def publish(made: Snapshot, folder: str, rules: Rules, generated_at: str, asked: Asked = Asked()) -> dict | None:
    """Writes a snapshot below a new folder and returns its manifest; null if no file differs from the snapshot before.

    Gates read the draft. If one fails, QualityGateError tells all failures and the draft stays without a manifest, so
    no reader takes it. The manifest is written after all else, and the checksums of what is served after that.
    """
    spark = made.parsed.sparkSession
    write(made, folder)
    gates.enforce(failures(spark, folder, made, rules))
    files = stored(spark, folder, "files")
    before = stored(spark, rules.previous, "files") if rules.previous else files.limit(0)
    sinks.write_tables(folder, delta=snapshot.delta(before, files))
    if rules.previous and stored(spark, folder, "delta").isEmpty():
        return None
    made_manifest = manifest(made, rules.day, generated_at, stored(spark, folder, "metrics"), asked, rules.known_gaps)
    old = sinks.read_json(spark, f"{rules.previous}/manifest.json") if rules.previous else {}
    head = {"schema_version": T.SCHEMA_VERSION, "from": old.get("coverage_date"), "to": rules.day}
    sinks.write_json(spark, head, f"{folder}/delta.json")
    sinks.write_json(spark, {"schema_version": T.SCHEMA_VERSION}, f"{folder}/urn-index.json")
    sinks.write_json(spark, made_manifest, f"{folder}/manifest.json")
    sinks.write_checksums(spark, folder)
    return made_manifest


def build(raw_members: DataFrame, folder: str | None, rules: Rules, generated_at: str, asked: Asked = Asked(), side_members: DataFrame | None = None, dry_run: bool = True, smoke: bool = False) -> dict | None:
    """A snapshot from members of archives (and of side sources, if given), checked and written.

    smoke: members are a sample, so coverage and side sources are not asked for; only a dry run may do so. A dry run
    writes below the shared folder unless it is told where; any other must be told.
    """
    if smoke and not dry_run:
        raise ValueError("a smoke test must be a dry run")
    if not dry_run and not folder:
        raise ValueError("a folder to publish to is needed")
    members = raw_members if smoke or side_members is None else gathered(raw_members, side_members)
    held = Rules(rules.day, exceptions=rules.exceptions, previous=rules.previous) if smoke else rules
    return publish(plan(members), folder or new_folder(raw_members.sparkSession, "snapshot"), held, generated_at, asked)
