"""The registered snapshot queries put whole texts through parsing, rendering and article extraction."""

import base64
import re

import pytest

from lexspark.plans import build, catalogue
from lexspark.sources import akn

ODD = "  1 < 2 && \"3\" > '4' ]]> &amp; <b>è 🙂</b>\r\n\tline\rtwo\n\nNow see [the next](no)\n\nend  " + "x1 é, " * 40_000 + "\x01\x0b\ufffe \xa0\n"
TEXTS = {1: ODD, 2: "", 3: None, 4: "short 1.", 7: ODD}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame([(i, t, "it", "s1") for i, t in TEXTS.items()], "doc_id long, text string, lang string, source string").write.parquet(f"{path}/documents.parquet")
    return path


def shown(text):
    return re.sub("[\x01\x0b\ufffe]", "\ufffd", text or "")


def test_members_hold_whole_texts(spark, folder):
    raw = {int(r["source"]): bytes(r["raw"]) for r in catalogue.acts(spark, folder).collect()}
    assert akn.parse_member(raw[7]) == {"error": "base64-wrapped HTML, not AKN XML"}
    assert len(base64.b64decode(raw[7], validate=True)) > len(ODD.encode())
    for i in (1, 2, 3, 4):
        assert akn.parse_member(raw[i])["template"].split("\n\nFirst of ", 1)[1].split(".\n\n<a id=", 1)[0] == shown(TEXTS[i])


def test_articles_hold_whole_texts(spark, folder):
    made = build.plan(catalogue.acts(spark, folder))
    articles = {int(r["document_urn"].split(";")[1]): r["text"] for r in made.articles.where("version = 1").collect()}
    bodies = {int(r["urn"].split(";")[1]): r["text"] for r in made.documents.collect()}
    assert articles == {i: f"## Art. 1\n\nFirst of {shown(TEXTS[i])}." for i in (1, 2, 3, 4)}
    assert all(articles[i] in bodies[i] for i in articles)


def test_link_is_that_of_the_second_article(spark, folder):
    links = {int(r["urn"].split(";")[1]): r["link"] for r in catalogue.akn_render(spark, folder).collect()}
    assert links == {1: "[the next](2.md#art-1)", 2: "[the next](3.md#art-1)", 3: "[the next](4.md#art-1)", 4: "[the next](https://www.normattiva.it/uri-res/N2Ls?urn:nir:stato:legge:2001-01-01;5#Art 1)"}
