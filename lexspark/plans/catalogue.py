"""Registered queries over the driver's tables, and the SQL that gives the same rows.

The tables hold no legal XML, so most operators run on what comes nearest: documents as candidates (a text's
digest as urn, its source as code or collection), pages as sources of links, events and conversations as versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import canonical, gates, links, search, snapshot, temporal
from lexspark.plans import build
from lexspark.sources import akn, archives
from lexspark.sources.archives import article_counts, xml_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(sql: str | None = None):
    def add(query: Callable[[SparkSession, str], DataFrame]):
        QUERIES[query.__name__] = query
        if sql:
            ORACLE_SQL[query.__name__] = sql
        return query

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _urn() -> F.Column:
    return T.sha256_text("text")


def _n() -> F.Column:
    return F.count(F.lit(1))


@_register("SELECT sha256(text) AS urn, arg_min(doc_id, (lang, source, doc_id)) AS doc_id, count(*) AS n_candidates FROM documents GROUP BY 1")
def canonical_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.groupBy(_urn().alias("urn")).agg(F.min_by("doc_id", F.struct("lang", "source", "doc_id")).alias("doc_id"), _n().alias("n_candidates"))


@_register(
    """SELECT sha256(text) AS urn, doc_id FROM documents
    QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY lang, source, doc_id) = 1"""
)
def canonical_rank_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(_urn().alias("urn"), "lang", "source", "doc_id")
    place = F.row_number().over(Window.partitionBy("urn").orderBy("lang", "source", "doc_id"))
    return docs.withColumn("place", place).where("place = 1").select("urn", "doc_id")


@_register("SELECT count(*) - count(DISTINCT sha256(text)) AS duplicates FROM documents")
def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.duplicate_count(_table(spark, sf_dir, "documents").select(_urn().alias("urn")))


@_register(
    """SELECT doc_id, path_suffix, 'atti/' || code || path_suffix || '.md' AS repo_path FROM (
      SELECT doc_id, source || '-' || lang AS code,
        CASE WHEN count(*) OVER (PARTITION BY source || '-' || lang) > 1 THEN '-' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 12) ELSE '' END AS path_suffix
      FROM documents)"""
)
def collision_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("-", "source", "lang").alias("code"), F.col("doc_id").cast("string").alias("urn"))
    return canonical.with_paths(docs, "code", "urn").select("doc_id", "path_suffix", "repo_path")


@_register("SELECT DISTINCT source AS collection, sha256(text) AS urn FROM documents")
def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.memberships(_table(spark, sf_dir, "documents").select(F.col("source").alias("collection"), _urn().alias("urn")))


@_register(
    """SELECT source AS code, count(*) AS n, string_agg(lpad(CAST(doc_id AS VARCHAR), 12, '0') || '@atti/' || source || '.md', ',' ORDER BY lpad(CAST(doc_id AS VARCHAR), 12, '0')) AS documents
    FROM documents GROUP BY 1"""
)
def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(F.col("source").alias("code"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("urn"), T.repo_path("source", F.lit("")).alias("repo_path"))
    index = canonical.inverted_index(docs, "code")
    return index.select("code", F.size("documents").cast("long").alias("n"), F.array_join(F.transform("documents", lambda d: F.concat_ws("@", d["urn"], d["path"])), ",").alias("documents"))


@_register(
    """SELECT d.source AS collection, count(*) AS received, count(l.doc_id) AS labelled, coalesce(sum(l.quality), 0)::BIGINT AS good, count(*) FILTER (l.toxic = 1) AS toxic
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1"""
)
def collection_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _table(spark, sf_dir, "documents").select("doc_id", "source").join(_table(spark, sf_dir, "labels"), "doc_id", "left")
    return both.groupBy(F.col("source").alias("collection")).agg(_n().alias("received"), F.count("quality").alias("labelled"), F.coalesce(F.sum("quality"), F.lit(0)).cast("long").alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic"))


@_register("SELECT count(*) AS acts, sum(n_chars)::BIGINT AS chars, count(DISTINCT source) AS collections, max(n_chars) AS longest FROM documents")
def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").agg(_n().alias("acts"), F.sum("n_chars").alias("chars"), F.count_distinct("source").alias("collections"), F.max("n_chars").alias("longest"))


@_register("SELECT coalesce(nullif(o_orderpriority, ''), 'ignoto') AS tipo, substr(strftime(o_orderdate, '%Y-%m-%d'), 1, 4) AS year, count(*) AS n FROM orders GROUP BY 1, 2")
def count_by_type_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select(F.coalesce(F.nullif("o_orderpriority", F.lit("")), F.lit("ignoto")).alias("tipo"), T.year_bucket(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("year"))
    return rows.groupBy("tipo", "year").agg(_n().alias("n"))


@_register("SELECT source AS code, max(n_chars) AS max_articles FROM documents GROUP BY 1")
def max_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return article_counts(_table(spark, sf_dir, "documents"), "source", "n_chars")


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the documents, every row in at least one: every fifth is added, every seventh removed, every eleventh of the later version changed.

    What is both a fifth and a seventh stays as it is, as do rows without an id, whose path is that of their text.
    """
    path = F.concat(F.lit("atti/"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null-"), F.coalesce(T.sha256_text("text"), F.lit("null")))))
    stays = F.coalesce(F.col("doc_id") % 35 == 0, F.lit(True))
    docs = _table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text", stays.alias("stays"))
    before = docs.where("stays OR doc_id % 5 != 0").select("path", T.sha256_text("text").alias("sha256"))
    changed = ~F.col("stays") & (F.col("doc_id") % 11 == 0)
    after = docs.where("stays OR doc_id % 7 != 0").select("path", T.sha256_text(F.when(changed, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("sha256"))
    return before, after


_VERSIONS_SQL = """WITH b AS (SELECT 'atti/' || doc_id AS path, sha256(text) AS sha256 FROM documents WHERE doc_id % 5 <> 0),
    a AS (SELECT 'atti/' || doc_id AS path, sha256(CASE WHEN doc_id % 11 = 0 THEN text || '!' ELSE text END) AS sha256 FROM documents WHERE doc_id % 7 <> 0)"""


@_register(
    _VERSIONS_SQL
    + """ SELECT CASE WHEN b.path IS NULL THEN 'added' WHEN a.path IS NULL THEN 'removed' ELSE 'modified' END AS change,
    coalesce(a.path, b.path) AS path, b.sha256 AS before, a.sha256 AS after FROM b FULL JOIN a ON a.path = b.path WHERE a.sha256 IS DISTINCT FROM b.sha256"""
)
def snapshot_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.delta(*_versions(spark, sf_dir))


@_register(_VERSIONS_SQL + " SELECT 'previous document disappeared: ' || path || ' (' || substr(sha256, 1, 12) || ')' AS failure FROM b WHERE path NOT IN (SELECT path FROM a)")
def missing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _versions(spark, sf_dir)
    return gates.disappeared(after, before, _no_exceptions(spark))


@_register(_VERSIONS_SQL + " SELECT path FROM (SELECT path FROM a UNION SELECT path FROM b) WHERE (path IN (SELECT path FROM a)) <> (path IN (SELECT path FROM b))")
def key_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _versions(spark, sf_dir)
    return snapshot.set_difference(before, after, "path")


_EXCEPTIONS = "metric string, collection string, expected_value int, expected_sources array<string>, message string, reason string, expires string"


def _exceptions(spark: SparkSession, *rows: str) -> DataFrame:
    names = [c.split()[0] for c in _EXCEPTIONS.split(", ")]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(rows)).toDF(*names)


def _no_exceptions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _EXCEPTIONS)


@_register(
    """WITH t AS (SELECT l_returnflag AS c, count(*) AS old, count(*) FILTER (l_linenumber <> 1) AS new FROM lineitem GROUP BY 1),
    w AS (SELECT count(*) AS old, count(*) FILTER (l_linenumber <> 1) AS new FROM lineitem)
    SELECT c || '.articles regressed from ' || old || ' to ' || new AS failure FROM t WHERE new < old AND c <> 'A'
    UNION ALL SELECT 'articles regressed from ' || old || ' to ' || new FROM w WHERE new < old
    UNION ALL SELECT 'external_links increased from ' || new || ' to ' || old FROM w WHERE new < old"""
)
def regression_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    counts = lines.groupBy("l_returnflag").agg(_n().alias("old"), F.count_if(F.col("l_linenumber") != 1).alias("new"))
    whole = counts.agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
    per = lambda df, c, metric, old, new: df.select(c.alias("collection"), F.lit(metric).alias("metric"), F.col(old).alias("old"), F.col(new).alias("new"))
    metrics = per(counts, F.col("l_returnflag"), "articles", "old", "new").unionByName(per(whole, F.lit("*"), "articles", "old", "new")).unionByName(per(whole, F.lit("*"), "external_links", "new", "old"))
    excused = counts.where("l_returnflag = 'A'").select(F.lit("articles").alias("metric"), F.col("l_returnflag").alias("collection"), F.col("new").cast("int").alias("expected_value"))
    value = lambda c: metrics.select("collection", "metric", F.col(c).alias("value"))
    return gates.regressions(value("new"), value("old"), excused)


@_register(
    """WITH r AS (SELECT 'src' || item_id AS code, 30 + item_id AS least, 'anchor-' || item_id AS anchor FROM benchmark),
    d AS (SELECT source AS code, 'atti/' || source || '.md' AS path, count(*) AS articles FROM documents GROUP BY 1, 2),
    k AS (SELECT DISTINCT source AS code, 'anchor-' || (doc_id % 40) AS anchor FROM documents)
    SELECT 'required act missing: ' || code AS failure FROM r WHERE code NOT IN (SELECT code FROM d)
    UNION ALL SELECT path || ' has ' || articles || ' articles, expected at least ' || least FROM r JOIN d USING (code) WHERE articles < least
    UNION ALL SELECT 'atti/' || r.code || '.md is missing required anchor ' || r.anchor FROM r ANTI JOIN k ON k.code = r.code AND k.anchor = r.anchor"""
)
def coverage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    required = _table(spark, sf_dir, "benchmark").select(F.concat(F.lit("src"), F.col("item_id").cast("string")).alias("code"), (F.col("item_id") + 30).alias("min_articles"), F.array(F.concat(F.lit("anchor-"), F.col("item_id").cast("string"))).alias("required_anchors"))
    acts = docs.groupBy(F.col("source").alias("code")).agg(_n().alias("articles")).withColumn("path", T.repo_path("code", F.lit("")))
    have = docs.select(F.col("source").alias("code"), F.concat(F.lit("anchor-"), (F.col("doc_id") % 40).cast("string")).alias("anchor")).distinct()
    return gates.coverage_failures(required, acts, have)


@_register(
    """WITH e AS (SELECT doc_id AS error_id, source, 'bad ' || lang AS message FROM documents),
    n AS (SELECT count(*) AS n FROM e WHERE message LIKE '%bad es%')
    SELECT error_id FROM e WHERE NOT (contains(source, 'src1')) AND NOT (message LIKE '%bad es%' AND (SELECT n FROM n) = (SELECT count(*) FROM documents WHERE lang = 'es'))"""
)
def exception_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    errors = docs.select(F.col("doc_id").alias("error_id"), "source", F.concat(F.lit("bad "), "lang").alias("message"), F.lit("*").alias("collection"), F.lit("invalid_xml").alias("metric"))
    listed = _exceptions(spark, "('invalid_xml', '*', CAST(NULL AS INT), array('src1'), CAST(NULL AS STRING), 'known', '2999-01-01')", "('invalid_xml', '*', 1, array('src'), 'bad', 'expired', '1999-01-01')")
    counted = docs.where("lang = 'es'").agg(_n().cast("int").alias("expected_value")).selectExpr("'invalid_xml' AS metric", "'*' AS collection", "expected_value", "CAST(NULL AS ARRAY<STRING>) AS expected_sources", "'bad es' AS message", "'known' AS reason", "'2999-01-01' AS expires")
    return gates.unallowed(errors, gates.active(listed.unionByName(counted), "2026-01-01")).select("error_id")


@_register(
    """WITH e AS (SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
      strftime(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), '%Y-%m-%d %H:%M:%S.%f') AS valid_to FROM events),
    d AS (SELECT strftime(max(ts), '%Y-%m-%d 00:00:00.000000') AS day FROM events)
    SELECT user_id, event_id, event_type, valid_from FROM e, d WHERE valid_from <= day AND (valid_to IS NULL OR valid_to > day)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY valid_from DESC, event_id DESC) = 1"""
)
def asof_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    events = _table(spark, sf_dir, "events")
    own = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = events.select("user_id", "event_id", "event_type", stamp("ts").alias("valid_from"), stamp(F.lead("ts").over(own)).alias("valid_to"), F.col("event_id").alias("version"))
    day = events.agg(F.date_format(F.max("ts"), "yyyy-MM-dd 00:00:00.000000").alias("day")).first()["day"]  # the last midnight
    return temporal.latest(rows.where(temporal.in_force(day)), "user_id").select("user_id", "event_id", "event_type", "valid_from")


@_register("SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS version FROM conversations")
def version_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = temporal.numbered(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id", "role"], "turn")
    return rows.withColumn("version", F.col("version").cast("long"))


@_register(
    r"""WITH p AS (SELECT page_id, unnest(range(1, len(string_split(html, '<a ')))) AS pos, string_split(html, '<a ') AS parts FROM pages)
    SELECT page_id, pos, regexp_extract(parts[pos + 1], '^href="([^"]*)"', 1) AS anchor, CAST(len(parts[pos + 1]) AS BIGINT) AS span FROM p"""
)
def span_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans from one anchor to the next, as the next anchor's place less its own."""
    parts = _table(spark, sf_dir, "pages").select("page_id", F.length("html").alias("total"), F.posexplode(F.split("html", "<a ")).alias("pos", "part"))
    own = Window.partitionBy("page_id").orderBy("pos")
    placed = parts.withColumn("start", F.sum(F.length("part") + 3).over(own) - F.length("part"))
    spans = placed.withColumn("span", F.coalesce(F.lead("start").over(own) - 3, F.col("total") + 3) - F.col("start"))
    return spans.where("pos > 0").select("page_id", F.col("pos").cast("long").alias("pos"), F.regexp_extract("part", '^href="([^"]*)"', 1).alias("anchor"), "span")


@_register(
    r"""SELECT page_id, coalesce(nullif(trim(regexp_replace(replace(lower(url), '°', ''), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'x') AS slug,
    trim(regexp_replace(lower(CASE WHEN contains(url, '#') THEN substr(url, instr(url, '#') + 1) ELSE '' END), '[^a-z0-9]+', '-', 'g'), '-') AS fragment FROM pages"""
)
def slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", T.slug("url").alias("slug"), T.fragment_slug(T.fragment("url")).alias("fragment"))


def _hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages, half of them written as paths of acts."""
    pages = _table(spark, sf_dir, "pages")
    links_ = pages.select(F.col("page_id"), F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("pos", "raw"))
    act = F.concat(F.lit("/akn/it/act/decretoLegge/STATO_x/2020-01-01/"), F.btrim(F.col("raw"), F.lit("/")), F.lit("#Art 1"))
    return links_.select("page_id", F.col("pos").cast("long").alias("pos"), "raw", F.when(F.col("pos") % 2 == 0, act).otherwise(F.col("raw")).alias("href"))


_HREFS_SQL = """WITH x AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages),
    y AS (SELECT page_id, unnest(range(len(l))) AS pos, l FROM x),
    h AS (SELECT page_id, pos, l[pos + 1] AS raw, CASE WHEN pos % 2 = 0 THEN '/akn/it/act/decretoLegge/STATO_x/2020-01-01/' || trim(l[pos + 1], '/') || '#Art 1' ELSE l[pos + 1] END AS href FROM y),
    u AS (SELECT page_id, pos, href, split_part(href, '#', 1) AS path, CASE WHEN contains(href, '#') THEN substr(href, instr(href, '#') + 1) ELSE '' END AS fragment,
      CASE WHEN pos % 2 = 0 AND len(string_split(trim(split_part(href, '#', 1), '/'), '/')) >= 7 THEN 'urn:nir:stato.x:decreto.legge:2020-01-01;' || string_split(trim(split_part(href, '#', 1), '/'), '/')[7] END AS urn FROM h)"""


@_register(_HREFS_SQL + " SELECT page_id, pos, href, urn, 'https://www.normattiva.it/uri-res/N2Ls?' || coalesce(urn, path) || CASE WHEN fragment <> '' THEN '#' || fragment ELSE '' END AS url FROM u")
def href_to_urn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hrefs(spark, sf_dir).select("page_id", "pos", "href", T.href_to_urn("href").alias("urn"), T.resolver_url("href").alias("url"))


@_register(
    _HREFS_SQL
    + """, i AS (SELECT 'urn:nir:stato.x:decreto.legge:2020-01-01;' || trim(raw, '/') AS key, 'atti/' || min(page_id) || ' (x).md' AS target FROM h WHERE trim(raw, '/') <> '' AND NOT contains(raw, '#') AND NOT contains(trim(raw, '/'), '/') GROUP BY 1 HAVING min(page_id) % 2 = 0)
    SELECT page_id, pos, CASE WHEN target IS NOT NULL THEN 'internal' WHEN coalesce(urn, path) <> '' THEN 'external' ELSE 'unresolved' END AS kind,
    CASE WHEN href = '' THEN 'see' WHEN target IS NOT NULL THEN '[see](' || replace(replace(replace(substr(target, 6), ' ', '%20'), '(', '%28'), ')', '%29') || CASE WHEN fragment <> '' THEN '#' || trim(regexp_replace(lower(fragment), '[^a-z0-9]+', '-', 'g'), '-') ELSE '' END || ')'
    ELSE '[see](https://www.normattiva.it/uri-res/N2Ls?' || coalesce(urn, path) || CASE WHEN fragment <> '' THEN '#' || fragment ELSE '' END || ')' END AS rendered
    FROM u LEFT JOIN i ON i.key = coalesce(urn, path)"""
)
def link_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = _hrefs(spark, sf_dir)
    name = F.btrim(F.col("raw"), F.lit("/"))
    own = refs.where((name != "") & ~F.contains("raw", F.lit("#")) & ~F.contains(name, F.lit("/")))
    index = own.groupBy(F.concat(F.lit("urn:nir:stato.x:decreto.legge:2020-01-01;"), name).alias("urn")).agg(F.min("page_id").alias("p")).where("p % 2 = 0").select("urn", F.concat(F.lit("atti/"), F.col("p").cast("string"), F.lit(" (x).md")).alias("path"))
    return links.resolve(refs.withColumn("label", F.lit("see")), index).select("page_id", "pos", "kind", "rendered")


@_register(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND d <= '1995-06-17' THEN 'abrogato' WHEN d > '1997-01-01' THEN 'futuro' WHEN o_orderstatus IN ('P', 'F') THEN 'vigente' ELSE 'ignoto' END AS status_o,
    CASE o_orderstatus WHEN 'O' THEN 'originale' WHEN 'P' THEN 'multivigente' WHEN 'F' THEN 'vigente' ELSE 'ignoto' END AS label
    FROM (SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)"""
)
def status_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    own = rows.withColumn("format", F.when(F.col("o_orderstatus") == "P", "m").when(F.col("o_orderstatus") == "F", "V").when(F.col("o_orderstatus") == "O", "O"))
    repealed = F.when(F.col("o_orderstatus") == "F", F.col("d"))
    reference = F.when(F.col("o_orderstatus") == "F", F.lit("1995-06-17")).otherwise(F.lit("1997-01-01"))
    stated = T.status(reference, F.lit(""), F.when((F.col("d") > "1997-01-01"), F.lit("9999")), repealed, F.coalesce("format", F.lit("")))
    return own.select("o_orderkey", stated.alias("status_o"), T.format_label("format").alias("label"))


@_register()
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", T.html_text("html", "article", None).alias("text"))


@_register("SELECT doc_id, 'a \"b\\' || source AS titolo, lang AS tipo, 'null' AS numero FROM documents")
def front_matter_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {k: F.lit(None).cast("string") for k in T.FRONT_MATTER} | {"titolo": F.concat(F.lit('a "b\\'), "source"), "tipo": F.col("lang")}
    head = T.read_front_matter(F.concat(T.front_matter(columns), "text"))
    return _table(spark, sf_dir, "documents").select("doc_id", head.alias("head")).select("doc_id", F.col("head")["titolo"].alias("titolo"), F.col("head")["tipo"].alias("tipo"), F.col("head")["numero"].alias("numero"))


@_register("""SELECT page_id, len(l) AS n, array_to_string(l, '|') AS anchors FROM (SELECT page_id, regexp_extract_all(replace(html, '<a href', '<a id'), '<a id="([^"]+)"', 1) AS l FROM pages)""")
def anchor_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _table(spark, sf_dir, "pages").select("page_id", T.anchors(F.replace("html", F.lit("<a href"), F.lit("<a id"))).alias("l"))
    return found.select("page_id", F.size("l").cast("long").alias("n"), F.array_join("l", "|").alias("anchors"))


@_register("SELECT upper(lang) AS \"nomeCollezione\", 'V' AS \"formatoCollezione\", 'M,O,V' AS formati, min(doc_id) AS pos FROM documents GROUP BY 1")
def merge_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(F.lit("o"), F.lit("V"), F.lit(" m ")), (F.col("doc_id") % 3 + 1).cast("int"))
    rows = _table(spark, sf_dir, "documents").select(F.concat(F.lit(" "), F.upper("lang")).alias("nomeCollezione"), F.lit("").alias("nome"), code.alias("formatoCollezione"), F.col("doc_id").cast("string").alias("dataCreazione"), F.col("doc_id").alias("pos"))
    return canonical.merge_collections(rows).select("nomeCollezione", "formatoCollezione", F.array_join("formatiDisponibili", ",").alias("formati"), "pos")


@_register("SELECT source || ' ' || lang AS name, count(DISTINCT sha256(text)) AS n, array_to_string(list_sort(list(DISTINCT sha256(text))), ',') AS urns, source || '-' || lang AS slug FROM documents GROUP BY source, lang")
def collection_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot.collection_files(_table(spark, sf_dir, "documents").select(F.concat_ws(" ", "source", "lang").alias("collection"), _urn().alias("urn")))
    urns = F.from_json("json", "schema_version int, name string, urns array<string>")["urns"]
    return rows.select("name", F.size(urns).cast("long").alias("n"), F.array_join(urns, ",").alias("urns"), "slug")


_FTS_SQL = """WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(lower(text), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[^\\p{L}\\p{N}\\p{Co}]+'), lambda w: w <> '') AS w FROM documents),
    l AS (SELECT doc_id, len(w) + 1 AS n, len(list_filter(w, lambda x: x = 'that')) AS a, len(list_filter(w, lambda x: starts_with(x, 'thin'))) AS b, len(list_filter(w, lambda x: x = 'de')) AS c FROM t),
    s AS (SELECT count(*) AS nd, avg(n) AS av, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db, count(*) FILTER (c > 0) AS dc FROM l),
    i AS (SELECT *, CASE WHEN ln((nd - da + 0.5e0) / (da + 0.5e0)) > 0 THEN ln((nd - da + 0.5e0) / (da + 0.5e0)) ELSE 1e-6 END AS ia, CASE WHEN ln((nd - db + 0.5e0) / (db + 0.5e0)) > 0 THEN ln((nd - db + 0.5e0) / (db + 0.5e0)) ELSE 1e-6 END AS ib, CASE WHEN ln((nd - dc + 0.5e0) / (dc + 0.5e0)) > 0 THEN ln((nd - dc + 0.5e0) / (dc + 0.5e0)) ELSE 1e-6 END AS ic FROM s)
    SELECT doc_id, round(-(ia * a * 2.2e0 / (a + 1.2e0 * (0.25e0 + 0.75e0 * n / av)) + ib * b * 2.2e0 / (b + 1.2e0 * (0.25e0 + 0.75e0 * n / av)) + ic * c * 2.2e0 / (c + 1.2e0 * (0.25e0 + 0.75e0 * n / av))), 6) AS score
    FROM l, i WHERE a > 0 AND b > 0 AND NOT c > 0 ORDER BY 2, 1 LIMIT 20"""


@_register(_FTS_SQL)
def fts_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("urn"), F.lit("x").alias("titolo"), "text")
    found = search.search(docs, "that thin* NOT de", limit=None)
    rounded = found.select(F.col("urn").alias("doc_id"), F.round("score", 6).alias("score"))
    return rounded.orderBy("score", "doc_id").limit(20)


@_register("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')")
def foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").where("o_orderstatus != 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").join(orders, "l_orderkey", "left_anti")


@_register(
    """SELECT page_id, regexp_replace(html, '\\]\\([^)]+\\)', '](LINK)', 'g') = html AS same, len(list_filter(list_transform(string_split(url, '/'), lambda x: trim(x)), lambda x: x <> '')) AS parts FROM pages"""
)
def link_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", (T.without_link_targets("html") == F.col("html")).alias("same"), F.size(T.clean_lines(F.replace("url", F.lit("/"), F.lit("\n")))).cast("long").alias("parts"))


_ACT = """<akomaNtoso xmlns="http://docs.oasis-open.org/legaldocml/ns/akn/3.0" xmlns:eli="http://data.europa.eu/eli/ontology#"><act><meta>
<identification><FRBRWork><FRBRalias name="urn:nir" value="urn:nir:stato:legge:2001-01-01;%s"/></FRBRWork></identification>
<lifecycle><eventRef eId="e1" date="2001-01-01" type="generation"/><eventRef eId="e2" date="2011-01-01" type="amendment"/></lifecycle>
<temporalData><timeInterval eId="t1" start="#e1" end="#e2"/><timeInterval eId="t2" start="#e2"/></temporalData>
<proprietary><eli:id_local>%s</eli:id_local></proprietary></meta>
<preface><docType>LEGGE</docType><docNumber>%s</docNumber><docDate date="2001-01-01"/><docTitle>Act %s</docTitle></preface><body>
<article eId="art_1" period="#t1"><num>Art. 1</num><paragraph><content><p>First of %s.</p></content></paragraph></article>
<article eId="art_1" period="#t2"><num>Art. 1</num><paragraph><content><p>Now see <ref href="urn:nir:stato:legge:2001-01-01;%s#Art 1">the next</ref></p></content></paragraph></article>
</body></act></akomaNtoso>"""


#: Failures of members, in the order in which rejected acts have them.
REJECTED = ("payload is not XML", "base64-wrapped HTML, not AKN XML", "XML root is not Akoma Ntoso", "missing URN", "missing codice_redazionale", "base64 payload is not UTF-8 XML")


def acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members in AKN, one a document with its whole text: every seventh is rejected, for all reasons in turn, every fifth shares its neighbour's code."""
    ident = F.col("doc_id").cast("string")
    code = (F.col("doc_id") - F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0)).cast("string")
    text = xml_text(F.col("text"))
    xml = F.encode(F.format_string(_ACT, ident, code, ident, F.col("source"), text, (F.col("doc_id") + 1).cast("string")), "UTF-8")
    unwrapped = lambda raw: F.encode(F.replace(F.base64(raw), F.lit("\r\n"), F.lit("")), "UTF-8")  # noqa: E731  Spark breaks base64 into lines
    without = lambda part, other: F.encode(F.replace(F.decode(xml, "UTF-8"), F.lit(part), F.lit(other)), "UTF-8")
    bad = (
        F.encode(F.concat(F.lit("!"), text), "UTF-8"),
        unwrapped(F.encode(F.concat(F.lit("<html>"), text, F.lit("</html>")), "UTF-8")),
        F.encode(F.concat(F.lit("<root>"), text, F.lit("</root>")), "UTF-8"),
        without('name="urn:nir"', 'name="urn"'),
        without("eli:id_local", "eli:id"),
        unwrapped(F.concat(F.unhex(F.lit("FF")), F.encode(text, "UTF-8"))),
    )
    kind = F.floor(F.col("doc_id") / 7) % len(bad)
    raw = F.when(F.col("doc_id") % 7 != 0, xml)
    for i, member in enumerate(bad):
        raw = raw.when(kind == i, member)
    return _table(spark, sf_dir, "documents").select(F.col("source").alias("collection"), F.lit("V").alias("source_format"), ident.alias("source"), raw.otherwise(xml).alias("raw"))


@_register("SELECT ['" + "', '".join(REJECTED) + "'][(doc_id // 7) % 6 + 1] AS message, source AS collection, count(*) AS n FROM documents WHERE doc_id % 7 = 0 GROUP BY ALL")
def rejected_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = akn.errors(akn.parse_members(acts(spark, sf_dir)))
    return made.groupBy("message", "collection").agg(_n().alias("n"))


@_register(
    """SELECT source AS collection, count(*) AS xml_received, count(*) FILTER (doc_id % 7 = 0) AS skipped, count(*) FILTER (doc_id % 7 <> 0) AS converted, 2 * count(*) FILTER (doc_id % 7 <> 0) AS articles FROM documents GROUP BY 1"""
)
def validation_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = build.plan(acts(spark, sf_dir))
    return snapshot.collection_counts(made.parsed, made.rendered).select("collection", *[F.col(c).cast("long").alias(c) for c in ("xml_received", "skipped", "converted", "articles")])


@_register(
    """WITH c AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN doc_id - 1 ELSE doc_id END AS code FROM documents WHERE doc_id % 7 <> 0),
    p AS (SELECT doc_id, 'atti/' || code || CASE WHEN count(*) OVER (PARTITION BY code) > 1 THEN '-' || substr(sha256('urn:nir:stato:legge:2001-01-01;' || doc_id), 1, 12) ELSE '' END || '.md' AS path FROM c)
    SELECT 'urn:nir:stato:legge:2001-01-01;' || a.doc_id AS urn, a.path AS path, CASE WHEN b.doc_id IS NULL THEN 'external' ELSE 'internal' END AS kind,
    '[the next](' || CASE WHEN b.doc_id IS NULL THEN 'https://www.normattiva.it/uri-res/N2Ls?urn:nir:stato:legge:2001-01-01;' || (a.doc_id + 1) || '#Art 1' ELSE substr(b.path, 6) || '#art-1' END || ')' AS link
    FROM p a LEFT JOIN p b ON b.doc_id = a.doc_id + 1"""
)
def akn_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = build.plan(acts(spark, sf_dir))
    kind = F.when(F.col("internal_links") == 1, "internal").otherwise("external")
    return made.rendered.select("urn", F.col("repo_path").alias("path"), kind.alias("kind"), F.regexp_extract("body", r"\n\nNow see (\[the next\]\([^)\n]*\))\z", 1).alias("link"))


_AS_OF = "SELECT 'urn:nir:stato:legge:2001-01-01;' || doc_id AS document_urn, 'art-1' AS anchor, {version}::BIGINT AS version, {dates} FROM documents WHERE doc_id % 7 <> 0"
_FIRST, _SECOND = "'2001-01-01' AS valid_from, '2011-01-01' AS valid_to", "'2011-01-01' AS valid_from, NULL::VARCHAR AS valid_to"


@_register(_AS_OF.format(version=1, dates=_FIRST))
def articles_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = build.plan(acts(spark, sf_dir))
    found = temporal.latest(made.articles.where(temporal.in_force("2010-12-31")), "document_urn", "anchor")
    return found.select("document_urn", "anchor", F.col("version").cast("long").alias("version"), "valid_from", "valid_to")


@_register(" UNION ALL ".join(f"SELECT '{day}' AS day, * FROM ({_AS_OF.format(version=v, dates=d)})" for day, v, d in (("2001-01-01", 1, _FIRST), ("2010-12-31", 1, _FIRST), ("2011-01-01", 2, _SECOND))))
def articles_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends of half-open intervals: the day before the first, the first and last day of one version, the next one's first."""
    made = build.plan(acts(spark, sf_dir))
    days = F.array(*map(F.lit, ("2000-12-31", "2001-01-01", "2010-12-31", "2011-01-01")))
    asked = made.articles.select("document_urn", "anchor", "version", "valid_from", "valid_to", F.explode(days).alias("day"))
    found = temporal.latest(asked.where(temporal.in_force(F.col("day"))), "document_urn", "anchor", "day")
    return found.select("day", "document_urn", "anchor", F.col("version").cast("long").alias("version"), "valid_from", "valid_to")


@_register(
    """WITH d AS (SELECT a.doc_id, a.source, a.doc_id % 7 = 0 AS bad, b.doc_id IS NOT NULL AS inside FROM documents a LEFT JOIN (SELECT doc_id FROM documents WHERE doc_id % 7 <> 0) b ON b.doc_id = a.doc_id + 1),
    w AS (SELECT '*' AS collection, count(*) FILTER (NOT bad) AS acts, 2 * count(*) FILTER (NOT bad) AS articles, count(*) FILTER (NOT bad AND inside) AS internal_links, count(*) FILTER (NOT bad AND NOT inside) AS external_links,
      0::BIGINT AS unresolved_links, count(*) AS xml_received, count(*) FILTER (bad) AS skipped, 0::BIGINT AS duplicates FROM d),
    c AS (SELECT source AS collection, count(*) AS xml_received, count(*) FILTER (bad) AS skipped, count(*) FILTER (NOT bad) AS converted, 2 * count(*) FILTER (NOT bad) AS articles FROM d GROUP BY 1)
    SELECT collection, metric, value FROM (UNPIVOT w ON COLUMNS(* EXCLUDE (collection)) INTO NAME metric VALUE value) UNION ALL SELECT collection, metric, value FROM (UNPIVOT c ON COLUMNS(* EXCLUDE (collection)) INTO NAME metric VALUE value)"""
)
def snapshot_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.metrics(build.plan(acts(spark, sf_dir)))


@_register(
    """SELECT sha256(coalesce(text, '')) AS urn, arg_min(doc_id, (CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE 9 END, CASE WHEN contains(coalesce(source, ''), 'src1') THEN 0 ELSE 1 END, coalesce(source, ''), lpad(CAST(doc_id AS VARCHAR), 12, '0'))) AS doc_id FROM documents GROUP BY 1"""
)
def canonical_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator's own ranks: format, priority, collection, source."""
    formats = F.when(F.col("lang") == "en", "V").when(F.col("lang") == "de", "M").when(F.col("lang") == "fr", "O").otherwise("")
    names = {"collection": F.coalesce("source", F.lit("")), "source": F.lpad(F.col("doc_id").cast("string"), 12, "0")}
    known = {"urn": T.sha256_text(F.coalesce("text", F.lit(""))), "codice_redazionale": F.col("doc_id").cast("string"), "source_format": formats} | names | {f"folded_{k}": v for k, v in names.items()}
    docs = _table(spark, sf_dir, "documents").select(*[v.alias(k) for k, v in (known | {k: F.lit("") for k in canonical.RANKED if k not in known}).items()])
    return canonical.best_of(docs, ("src1",)).select("urn", F.col("codice_redazionale").cast("long").alias("doc_id"))


@_register("SELECT DISTINCT l_orderkey AS document_urn FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("urn"))
    return snapshot.orphans(_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document_urn")), orders)


@_register("SELECT 'index reference: ' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS failure FROM documents WHERE source IS NULL OR (doc_id % 13 = 0)")
def index_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index against an inverted one that lacks some of its rows."""
    index = _table(spark, sf_dir, "documents").select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("urn"), T.repo_path("source", F.lit("")).alias("path"), F.col("source").alias("code"), (F.col("doc_id") % 13 == 0).alias("lost"))
    inverted = canonical.inverted_index(index.where("NOT lost").select("urn", F.col("path").alias("repo_path"), "code"), "code")
    return snapshot.index_failures(index.drop("lost"), inverted)


@_register(
    """WITH l AS (SELECT page_id, sha256(url) AS digest, CASE WHEN page_id % 7 = 0 THEN 'bad' WHEN page_id % 11 = 0 THEN sha256(url) || '  a/' || page_id ELSE sha256(url) || '  ' || page_id END AS line FROM pages)
    SELECT CASE WHEN page_id % 7 = 0 OR page_id % 11 = 0 THEN 'malformed checksum line: ' || line ELSE 'checksum: ' || page_id END AS failure FROM l WHERE page_id % 7 = 0 OR page_id % 11 = 0 OR page_id % 5 = 0"""
)
def checksum_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, digest = F.col("page_id").cast("string"), T.sha256_text("url")
    line = F.when(F.col("page_id") % 7 == 0, "bad").when(F.col("page_id") % 11 == 0, F.concat(digest, F.lit("  a/"), name)).otherwise(F.concat(digest, F.lit("  "), name))
    pages = _table(spark, sf_dir, "pages")
    have = pages.select(name.alias("name"), F.when(F.col("page_id") % 5 == 0, T.sha256_text("html")).otherwise(digest).alias("sha256"))
    return snapshot.checksum_failures(pages.select(line.alias("line")), have)


@_register(
    """WITH e AS (SELECT doc_id, source, NOT contains(source, 'src1') AS open FROM documents WHERE lang = 'es'), n AS (SELECT count(*) AS accounted, count(*) FILTER (open) AS open FROM e)
    SELECT '3 skipped XML lack an error record' AS failure UNION ALL SELECT (accounted + 3) || ' XML skipped, ' || open || ' unexcepted errors' FROM n WHERE open > 0
    UNION ALL SELECT 'not every document has one URN and editorial code' FROM (SELECT count(*) AS a, count(DISTINCT source) AS b FROM documents) WHERE a <> b
    UNION ALL SELECT * FROM (SELECT source || ': bad es' FROM e WHERE open ORDER BY doc_id LIMIT 20)"""
)
def report_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    errors = docs.where("lang = 'es'").select(F.col("doc_id").alias("error_id"), "source", F.lit("bad es").alias("message"), F.lit("*").alias("collection"), F.lit("invalid_xml").alias("metric"))
    listed = _exceptions(spark, "('invalid_xml', '*', CAST(NULL AS INT), array('src1'), CAST(NULL AS STRING), 'known', '2999-01-01')")
    totals = docs.agg((F.count_if(F.col("lang") == "es") + 3).alias("skipped"), _n().alias("converted"), _n().alias("urns"), F.count_distinct("source").alias("codes"))
    return gates.report_failures(totals, errors, gates.active(listed, "2026-01-01"))


@_register(
    r"""SELECT page_id, substr(coalesce(nullif(trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '[ _/\\(),]', '-', 'g'), '[^\p{L}\p{N}.\-]', '', 'g'), '-{2,}', '-', 'g'), '-.'), ''), 'collezione'), 1, 100) AS repo_name,
    coalesce(nullif(trim(regexp_replace(regexp_replace(replace(trim(url), '/', '-'), '\s+', ' ', 'g'), '[^\p{L}\p{N} ._\-]', '', 'g'), ' .-_'), ''), 'document') AS file_name,
    replace(url, 'https://', 'https://***@') || ' Authorization: basic ***' AS log FROM pages"""
)
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.replace("url", F.lit("https://"), F.lit("https://me:word@")), F.lit(" Authorization: basic c2VjcmV0"))
    return _table(spark, sf_dir, "pages").select("page_id", T.safe_repo_name("url").alias("repo_name"), T.safe_filename("url").alias("file_name"), T.redact(said).alias("log"))


@_register("SELECT doc_id, '../' || lang || '/y.md' AS link, replace(lower(lang || 'STRASSE'), 'ß', 'ss') AS folded, lang || ' 2020' AS folder FROM documents WHERE lang IS NOT NULL")
def relative_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").where("lang IS NOT NULL")
    paths = docs.select("doc_id", "lang", F.lit("atti/here/x.md").alias("a"), F.concat(F.lit("atti/"), "lang", F.lit("/y.md")).alias("b"))
    return paths.select("doc_id", T.relative_link("a", "b").alias("link"), T.casefold(F.concat("lang", F.lit("Straße"))).alias("folded"), T.collection_folder(F.concat("lang", F.lit("-2020"))).alias("folder"))


@_register("SELECT conv_id, turn, 'art_' || role || CASE WHEN n > 1 THEN '_' || n ELSE '' END AS eid FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM conversations)")
def article_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("source"), F.col("turn").alias("pos"), F.col("role").alias("number"), "text")
    return archives.article_rows(turns).select(F.col("source").alias("conv_id"), F.col("pos").alias("turn"), "eid")


@_register("WITH c AS (SELECT source AS code, max(n_chars) AS n FROM documents GROUP BY 1) SELECT 'src' || item_id AS code FROM benchmark LEFT JOIN c ON c.code = 'src' || item_id WHERE coalesce(n, 0) < 3000 + 100 * item_id")
def missing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _table(spark, sf_dir, "benchmark").select(F.concat(F.lit("src"), F.col("item_id").cast("string")).alias("code"), (3000 + 100 * F.col("item_id")).alias("min_articles"))
    return archives.missing_sources(wanted, article_counts(_table(spark, sf_dir, "documents"), "source", "n_chars")).select("code")


@_register("SELECT 'targets' AS what, true AS refuse UNION ALL SELECT 'texts', false UNION ALL SELECT 'nothing', false")
def only_links_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), "url", "html")
    made = lambda target, text: pages.select("path", F.concat(F.lit("see [a]("), target, F.lit(") "), text).alias("markdown"))
    before = made(F.concat(F.lit("x"), "url"), F.lit("text"))
    cases = {"targets": made(F.concat(F.lit("y"), "url"), F.lit("text")), "texts": made(F.concat(F.lit("y"), "url"), F.lit("other")), "nothing": before}
    rows = [gates.only_links_changed(before, after).select(F.lit(what).alias("what"), "refuse") for what, after in cases.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@_register(
    r"""SELECT doc_id FROM documents WHERE list_contains(regexp_split_to_array(lower(text), '[^\p{L}\p{N}\p{Co}]+'), 'that')
    AND (doc_id % 3 = 0 OR (doc_id % 3 = 1 AND doc_id % 5 > 0))"""
)
def search_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a word and are in force on the day: without dates, or begun that day at the latest and not ended by it."""
    begun = F.when(F.col("doc_id") % 3 == 1, "2020-01-01").when(F.col("doc_id") % 3 == 2, "2020-01-02")
    ended = F.when((F.col("doc_id") % 3 == 1) & (F.col("doc_id") % 5 == 0), "2020-01-01")
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("urn"), F.lit("x").alias("titolo"), "text", begun.alias("valid_from"), ended.alias("valid_to"))
    return search.search(docs, "text:that", limit=None, day="2020-01-01").select(F.col("urn").alias("doc_id"))


@_register("SELECT conv_id::VARCHAR AS document_urn, role AS anchor, max(turn)::BIGINT AS version FROM conversations WHERE conv_id = (SELECT min(conv_id) FROM conversations) AND role = 'user' GROUP BY 1, 2")
def article_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    least = str(turns.agg(F.min("conv_id").alias("least")).first()["least"])
    table = turns.select(F.col("conv_id").cast("string").alias("document_urn"), F.col("role").alias("anchor"), F.col("turn").cast("long").alias("version"), F.lit(None).cast("string").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"))
    return temporal.article_as_of(table, least, "user", "2020-01-01").select("document_urn", "anchor", "version")


@_register("SELECT 'urn:nir:borgo:' || item_id AS urn, 'T & <' || item_id AS titolo, 'art-1,art-1-2' AS anchors, (length(coalesce(text, '')) + length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')))::BIGINT AS chars FROM benchmark")
def side_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Side sources as members that the parser takes: two articles of one number, the second with an item's whole text, whose lines are paragraphs."""
    items = _table(spark, sf_dir, "benchmark").withColumn("code", F.concat(F.lit("b"), F.col("item_id").cast("string")))
    sources = items.select("code", F.concat(F.lit("urn:nir:borgo:"), F.col("item_id").cast("string")).alias("urn"), F.lit("t").alias("type"), F.lit("1").alias("number"), F.lit("2020-01-01").alias("date"), F.concat(F.lit("T & <"), F.col("item_id").cast("string")).alias("title"))
    texts = items.select(F.col("code").alias("source"), F.explode(F.array(F.struct(F.lit(0).alias("pos"), F.lit("first").alias("text")), F.struct(F.lit(1).alias("pos"), F.coalesce("text", F.lit("")).alias("text")))).alias("a")).select("source", "a.pos", F.lit("1").alias("number"), "a.text")
    parsed = akn.parse_members(archives.side_members(sources, archives.article_rows(texts), "Fonti"))
    last = F.element_at(F.split("template", "## Art. 1"), -1)
    return parsed.where("error IS NULL").select("urn", "titolo", F.array_join(F.col("intervals")["anchor"], ",").alias("anchors"), F.length(F.btrim(last, F.lit("\n"))).cast("long").alias("chars"))
