"""Fail-closed gates: every rule is a table of failures, and enforce() raises if there is any."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHOWN = 20
ACCOUNTED = ("invalid_xml", "render_error")
NOT_LESS = ("acts", "articles", "internal_links")
NOT_MORE = ("external_links",)
BY_COLLECTION = ("xml_received", "converted", "articles")


class QualityGateError(RuntimeError):
    pass


def active(exceptions: DataFrame, as_of: str) -> DataFrame:
    """Exceptions with a reason that have not expired on the day, which is always given."""
    return exceptions.where((F.coalesce("reason", F.lit("")) != "") & (F.coalesce("expires", F.lit("")) >= as_of))


def allowed_errors(errors: DataFrame, exceptions: DataFrame) -> DataFrame:
    """error_id of errors that exceptions allow.

    exceptions: metric, collection, expected_value (int) or expected_sources (array), message. A list allows
    errors whose source contains one of its values; a number with a message allows the errors with that message,
    if there are exactly so many. Exceptions are few and joined by metric and collection.
    """
    rules = exceptions.withColumn("exception_id", F.xxhash64(*exceptions.columns)).dropDuplicates(["exception_id"])
    both = errors.join(rules.withColumnRenamed("message", "wanted"), ["metric", "collection"])
    listed = both.where(F.exists("expected_sources", lambda v: F.contains("source", v)))
    counted = both.where(F.col("expected_value").isNotNull() & (F.coalesce("wanted", F.lit("")) != "") & F.contains("message", F.col("wanted")))
    right = counted.groupBy("exception_id").agg(F.count(F.lit(1)).alias("n"), F.first("expected_value").alias("expected")).where("n = expected")
    return listed.select("error_id").union(counted.join(right, "exception_id", "left_semi").select("error_id")).distinct()


def unallowed(errors: DataFrame, exceptions: DataFrame) -> DataFrame:
    return errors.join(allowed_errors(errors, exceptions), "error_id", "left_anti")


def _excused(changed: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Rows (metric, collection, new) that no exception with exactly this value excuses."""
    own = exceptions.where("expected_value IS NOT NULL").select("metric", "collection", F.col("expected_value").cast("long").alias("new")).distinct()
    return changed.join(own, ["metric", "collection", "new"], "left_anti")


def regressions(current: DataFrame, previous: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Failures of counts (collection, metric, value), `*` being all: those that fell, and external links that rose."""
    both = previous.select("collection", "metric", F.col("value").alias("old")).join(current.select("collection", "metric", F.col("value").alias("new")), ["collection", "metric"], "left").withColumn("new", F.coalesce("new", F.lit(0)).cast("long"))
    whole = F.col("collection") == "*"
    fell = (F.col("new") < F.col("old")) & ((whole & F.col("metric").isin(*NOT_LESS)) | (~whole & F.col("metric").isin(*BY_COLLECTION)))
    rose = (F.col("new") > F.col("old")) & whole & F.col("metric").isin(*NOT_MORE)
    name = F.when(whole, F.col("metric")).otherwise(F.concat_ws(".", "collection", "metric"))
    said = F.concat(name, F.when(fell, F.lit(" regressed from ")).otherwise(F.lit(" increased from ")), F.col("old").cast("string"), F.lit(" to "), F.col("new").cast("string"))
    return _excused(both.where(fell | rose), exceptions).select(said.alias("failure"))


def disappeared(current_files: DataFrame, previous_files: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Failures of documents (path, sha256) that are gone; one exception for removed files excuses all."""
    gone = previous_files.join(current_files, "path", "left_anti").withColumns({"metric": F.lit("removed_files"), "collection": F.lit("*"), "new": F.lit(1).cast("long")})
    return _excused(gone, exceptions).select(F.concat(F.lit("previous document disappeared: "), "path", F.lit(" ("), F.substring("sha256", 1, 12), F.lit(")")).alias("failure"))


def report_failures(totals: DataFrame, errors: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Failures of one row of totals (skipped, converted, urns, codes) and the errors (error_id, source, message, collection, metric)."""
    open_ = unallowed(errors, exceptions)
    facts = totals.crossJoin(errors.agg(F.count_if(F.col("metric").isin(*ACCOUNTED)).alias("accounted"))).crossJoin(open_.agg(F.count(F.lit(1)).alias("open")))  # one row each
    said = F.array_compact(
        F.array(
            F.when(F.col("skipped") > F.col("accounted"), F.concat((F.col("skipped") - F.col("accounted")).cast("string"), F.lit(" skipped XML lack an error record"))),
            F.when(F.col("open") > 0, F.concat(F.col("skipped").cast("string"), F.lit(" XML skipped, "), F.col("open").cast("string"), F.lit(" unexcepted errors"))),
            F.when((F.col("converted") != F.col("urns")) | (F.col("converted") != F.col("codes")), F.lit("not every document has one URN and editorial code")),
            F.when(F.col("converted") == 0, F.lit("empty corpus")),
        )
    )
    first = open_.orderBy("error_id").limit(SHOWN).select(F.concat_ws(": ", "source", "message").alias("failure"))
    return facts.select(F.explode(said).alias("failure")).unionByName(first)


def coverage_failures(required: DataFrame, documents: DataFrame, anchors: DataFrame) -> DataFrame:
    """Failures of required acts (code, min_articles, required_anchors) against documents (code, path, articles) and anchors (code, anchor).

    Codes are looked up as such, so an act whose path has a suffix is found too.
    """
    both = required.join(documents.select("code", "path", "articles"), "code", "left")
    absent = both.where("articles IS NULL").select(F.concat(F.lit("required act missing: "), "code").alias("failure"))
    few = both.where("articles < coalesce(min_articles, 1)").select(F.concat("path", F.lit(" has "), F.col("articles").cast("string"), F.lit(" articles, expected at least "), F.coalesce("min_articles", F.lit(1)).cast("string")).alias("failure"))
    wanted = both.select("code", F.coalesce("path", T_path("code")).alias("path"), F.explode("required_anchors").alias("anchor"))
    lacking = wanted.join(anchors.select("code", "anchor"), ["code", "anchor"], "left_anti").select(F.concat("path", F.lit(" is missing required anchor "), "anchor").alias("failure"))
    return reduce(DataFrame.unionByName, (absent, few, lacking))


def T_path(code: str):
    return F.concat(F.lit("atti/"), F.col(code), F.lit(".md"))


def only_links_changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row, refuse: whether documents (path, markdown) of both changed, and only in the targets of links."""
    from lexspark.functions.text import without_link_targets

    both = before.select("path", F.col("markdown").alias("old")).join(after.select("path", F.col("markdown").alias("new")), "path").where("old != new")
    return both.agg(F.coalesce(F.bool_and(without_link_targets("old") == without_link_targets("new")), F.lit(False)).alias("refuse"))


def enforce(failures: DataFrame, title: str = "quality gate failed", shown: int = 1000) -> None:
    found = [r["failure"] for r in failures.limit(shown).collect()]
    if found:
        raise QualityGateError(f"{title}:\n- " + "\n- ".join(found))
