"""Every registered query of the catalogue against its SQL on the small tables."""

import html
import os
import re

import duckdb
import pytest

from lexspark.plans.catalogue import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")


def rows_of(rows, columns, order):
    at = [columns.index(c) for c in order]
    return sorted(tuple("null" if r[i] is None else f"{r[i]:.6f}" if isinstance(r[i], float) else str(r[i]) for i in at) for r in rows)


def test_page_text(spark):
    """Against a plain search for the outermost elements; these pages nest no article in another."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{DIR}/pages.parquet").collect()}
    for r in QUERIES["html_text"](spark, DIR).collect():
        inner = "".join(re.findall(r"(?s)<article\b[^>]*>(.*?)(?:</article>|\Z)", pages[r["page_id"]]))
        lines = html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<(?:p|br|li|h[123])\b[^>]*>", "\n", inner))).splitlines()
        assert r["text"] == "\n".join(x.strip() for x in lines if x.strip())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, DIR)
    rows = found.collect()
    if name not in ORACLE_SQL:
        assert rows
        return
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    wanted = db.sql(ORACLE_SQL[name])
    order = sorted(found.columns)
    assert order == sorted(wanted.columns)
    assert rows_of(rows, found.columns, order) == rows_of(wanted.fetchall(), wanted.columns, order)
