"""get, search and verify over a published snapshot. Exit codes: 0 found, 1 nothing found or failed, 2 error."""

from __future__ import annotations

import argparse
import json
import sys
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.functions.text import SCHEMA_VERSION
from lexspark.operators import search, snapshot, temporal
from lexspark.sources import sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lexspark")
    verbs = top.add_subparsers(dest="verb", required=True)
    for name in ("get", "search", "verify"):
        verb = verbs.add_parser(name)
        verb.add_argument("--snapshot", required=True)
        verb.add_argument("--json", action="store_true")
        if name != "verify":
            verb.add_argument("key")
            verb.add_argument("--vigente-al")
    verbs.choices["get"].add_argument("--article")
    verbs.choices["search"].add_argument("--limit", type=int, default=20)
    return top


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def verify(spark: SparkSession, folder: str) -> list[str]:
    """Failures of a published snapshot: its checksums, schemas, counts and references, each against what was stored apart."""
    sums = sinks.read_text(spark, f"{folder}/SHA256SUMS")
    manifest = sinks.read_json(spark, f"{folder}/manifest.json")
    index_head = sinks.read_json(spark, f"{folder}/urn-index.json")
    told = [text for bad, text in ((sums is None, "SHA256SUMS missing"), (manifest.get("schema_version") != SCHEMA_VERSION, "manifest schema"), (index_head.get("schema_version") != SCHEMA_VERSION, "urn index schema")) if bad]
    counts = manifest.get("counts", {})
    lines = spark.createDataFrame([(line,) for line in (sums or "").splitlines()], "line string")
    tables = [_table(spark, folder, name) for name in ("documents", "articles", "urn_index", "code_index")]
    found = [snapshot.checksum_failures(lines, sinks.digests(spark, folder)), snapshot.verify(*tables, counts.get("acts"), counts.get("articles"))]
    return told + sorted(r["failure"] for r in reduce(DataFrame.unionByName, found).collect())


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("lexspark").getOrCreate()
    folder = args.snapshot
    try:
        if args.verb == "verify":
            found = verify(spark, folder)
            print(json.dumps({"ok": not found, "failures": found}))
            return 1 if found else 0
        if sinks.read_text(spark, f"{folder}/manifest.json") is None:
            print("error: not a published snapshot", file=sys.stderr)
            return 2
        documents = _table(spark, folder, "documents")
        if args.verb == "search":
            rows = [r.asDict() for r in search.search(documents, args.key, args.limit, args.vigente_al, index=_table(spark, folder, "postings"), counts=_table(spark, folder, "totals")).collect()]
        elif args.article:
            rows = [r.asDict() for r in temporal.article_as_of(_table(spark, folder, "articles"), args.key, args.article, args.vigente_al).collect()]
        else:
            rows = [r.asDict() for r in documents.where(F.col("urn") == args.key).limit(1).collect()]
    except (PySparkException, search.MatchError) as error:
        print(f"error: {error}", file=sys.stderr)
        return 2
    if not rows:
        return 1
    shown = "\n\n".join(f"{r['urn']}\n{r['titolo']}" for r in rows) if args.verb == "search" else rows[0]["text"]
    print(json.dumps(rows if args.verb == "search" else rows[0], ensure_ascii=False, default=str) if args.json else shown)
    return 0


if __name__ == "__main__":
    sys.exit(main())
