"""The two versions that snapshot comparisons read hold every row of the table."""

import duckdb
import pytest

from lexspark.plans import catalogue

NULLS = ["no id", "no id either", "", None]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("versions"))
    rows = [(i, f"text {i}" if i % 50 else None, "it", "s1") for i in range(800)] + [(None, t, "it", "s1") for t in NULLS]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{path}/documents.parquet")
    return path


def test_every_row_is_in_a_version(spark, folder):
    before, after = ({r["path"]: r["sha256"] for r in v.collect()} for v in catalogue._versions(spark, folder))
    assert {f"atti/{i}" for i in range(800)} <= before.keys() | after.keys() and len(before.keys() | after.keys()) == 800 + len(NULLS)
    stays = {f"atti/{i}" for i in range(0, 800, 35)} | {p for p in before if p.startswith("atti/null-")}
    assert len(stays) == 23 + len(NULLS) and all(p in before and p in after and before[p] == after[p] for p in stays)


@pytest.mark.parametrize("name", ["snapshot_delta", "missing_documents", "key_set_difference"])
def test_comparisons_follow_their_sql(spark, folder, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    wanted = db.sql(catalogue.ORACLE_SQL[name])
    found = catalogue.QUERIES[name](spark, folder).select(*wanted.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, found.collect())) == sorted(map(key, wanted.fetchall()))
