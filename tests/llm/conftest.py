import pytest

EXTRA = ("words", "rules", "found", "size", "unit", "kind", "n", "payload", "node", "bucket", "fold", "ids", "media", "row_key", "target", "label")

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [
        (None, None, None, None, None),
        (None, "a null id with a text of its own that has some words in it", "en", "s1", 60),
        (1, "", "en", None, 0),
        (2, " \n\t ", "en", "s1", 4),
        (3, "one two three four five six seven eight nine ten eleven", "en", "s2", 50),
        (3, "one two three four five six seven eight nine ten eleven", "en", "s2", 50),
        (4, "One TWO three four five six seven eight nine ten eleven", None, "s3", 50),
        (5, LONG, "en", "s1", len(LONG)),
        (6, "x" * 20_000, "en", "s1", 20_000),
        (7, "ünï 🙂   token = 'abcdefghijkl' AKIA" + "Q" * 16 + " deadbeefdeadbeef00", "de", "s4", 60),
        (8, None, "fr", "s4", None),
        (9, "Der Hund und die Katze " * 30, "de", "s4", 600),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in EXTRA:
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    """The smallest documents table, with rows of it as Python."""
    import os

    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no tables")
    df = spark.read.parquet(f"{path}/documents.parquet")
    return df, sorted((r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect())
