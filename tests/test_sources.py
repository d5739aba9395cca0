import hashlib
import re
import sqlite3
import unicodedata
import zipfile

import pytest
from akn_samples import MARKET
from pyspark.sql import functions as F

from lexspark.functions import text as T
from lexspark.operators import canonical, search
from lexspark.sources import acquire, akn, archives
from lexspark.streaming import ingest


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        for name in ("a.xml", "B.XML", "c.txt", "d/e.xml"):
            z.writestr(name, MARKET)
    with zipfile.ZipFile(tmp_path / "evil.zip", "w") as z:
        z.writestr("a.xml", "x")
        z.writestr("../escape.xml", "x")
    (tmp_path / "broken.zip").write_bytes(b"PK")
    rows = archives.zip_members(spark, str(tmp_path)).collect()
    assert sorted(r["name"] for r in rows if r["raw"]) == ["B.XML", "a.xml", "d/e.xml"]
    assert sorted("unsafe" in r["error"] for r in rows if r["error"]) == [False, True]
    assert archives.zip_members(spark, str(tmp_path), sample=1).where("raw IS NOT NULL").count() == 1
    good = (tmp_path / "good.zip").read_bytes()
    schema = "name string, sha256 string, size long, members long"
    for members, valid in ((4, 1), (3, 0)):
        inventory = spark.createDataFrame([("good.zip", hashlib.sha256(good).hexdigest(), len(good), members)], schema)
        assert archives.cache_check(spark, str(tmp_path), inventory).where("valid").count() == valid


def damaged_zip(path, damage):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.xml", MARKET)
        z.writestr("b.xml", MARKET * 3)
    raw = bytearray(path.read_bytes())
    damage(raw)
    path.write_bytes(raw)


def overwrite(raw, at, by):
    raw[at : at + len(by)] = by


def test_damaged_archives_give_one_error_and_no_member(spark, tmp_path):
    """Bad deflate data, wrong checksums, encrypted files, unknown methods and archives without files."""
    second = lambda raw: raw.index(b"PK\x03\x04", 4)
    entry = lambda raw: raw.rindex(b"PK\x01\x02")
    damaged_zip(tmp_path / "data.zip", lambda raw: overwrite(raw, second(raw) + 40, b"\xff" * 30))
    damaged_zip(tmp_path / "crc.zip", lambda raw: (overwrite(raw, entry(raw) + 16, b"\1\2\3\4"), overwrite(raw, second(raw) + 14, b"\1\2\3\4")))
    damaged_zip(tmp_path / "locked.zip", lambda raw: (overwrite(raw, entry(raw) + 8, b"\1\0"), overwrite(raw, second(raw) + 6, b"\1\0")))
    damaged_zip(tmp_path / "method.zip", lambda raw: (overwrite(raw, entry(raw) + 10, b"\x63\0"), overwrite(raw, second(raw) + 8, b"\x63\0")))
    zipfile.ZipFile(tmp_path / "none.zip", "w").close()
    damaged_zip(tmp_path / "whole.zip", lambda raw: None)
    rows = archives.zip_members(spark, str(tmp_path)).collect()
    errors = {r["archive"].rpartition("/")[2]: r["error"] for r in rows if r["error"]}
    assert sorted(errors) == ["crc.zip", "data.zip", "locked.zip", "method.zip", "none.zip"] and errors["none.zip"] == "archive without files"
    assert [(r["archive"].rpartition("/")[2], r["name"]) for r in rows if r["raw"]] == [("whole.zip", "a.xml"), ("whole.zip", "b.xml")]


class Server:
    """Serves one archive by format, and breaks where it is told to."""

    def __init__(self, archives, breaks=(), etag="t1", ranges=True):
        self.archives, self.breaks, self.etag, self.ranges, self.asked = archives, list(breaks), etag, ranges, []

    def __call__(self, collection, source_format, offset):
        self.asked.append((source_format, offset))
        if source_format not in self.archives:
            raise ConnectionError("not offered")
        raw = self.archives[source_format]
        start = offset if offset and self.ranges else None
        return acquire.Answer(start, self.etag, self.pieces(raw[start or 0 :]))

    def pieces(self, raw):
        if self.breaks:
            yield raw[: self.breaks.pop(0)]
            raise ConnectionError("broken")
        yield raw


@pytest.fixture
def archive(tmp_path):
    damaged_zip(tmp_path / "one.zip", lambda raw: None)
    return (tmp_path / "one.zip").read_bytes()


def test_downloads_go_on_and_are_cached(tmp_path, archive):
    cache, server = acquire.Cache(tmp_path / "cache"), Server({"V": archive}, breaks=[100, 50])
    path, cached = acquire.download(server, cache, "Borgo", "V", "borgo-V-2020.zip")
    assert path.read_bytes() == archive and not cached and server.asked == [("V", 0), ("V", 100), ("V", 150)]
    assert acquire.download(server, cache, "Borgo", "V", "borgo-V-2020.zip") == (path, True) and len(server.asked) == 3
    assert sorted(p.name for p in cache.folder.iterdir()) == ["borgo-V-2020.zip", "borgo-V-2020.zip.sha256", "inventory.json"]
    path.write_bytes(archive[:-1])  # evicted and got again
    assert acquire.download(server, cache, "Borgo", "V", "borgo-V-2020.zip")[1] is False and path.read_bytes() == archive
    (cache.folder / "inventory.json").write_text("{")
    assert cache.entries() == {} and cache.get("borgo-V-2020.zip") is None and not path.exists()


def test_parts_of_another_archive_are_thrown_away(tmp_path, archive):
    cache, broken = acquire.Cache(tmp_path / "cache"), Server({"V": archive}, breaks=[100] * 3)
    with pytest.raises(acquire.NotAvailable, match="after 1 attempts"):
        acquire.download(broken, cache, "Borgo", "V", "borgo-V-2020.zip", attempts=1)
    other = Server({"V": archive}, etag="t2")
    assert acquire.download(other, cache, "Borgo", "V", "borgo-V-2021.zip")[0].read_bytes() == archive and other.asked == [("V", 100), ("V", 0)]
    whole = Server({"V": archive}, ranges=False)
    (cache.folder / "borgo-V.part").write_bytes(b"old")
    assert acquire.download(whole, cache, "Borgo", "V", "borgo-V-2022.zip")[0].read_bytes() == archive  # the server begins anew
    empty = Server({"V": b""})
    with pytest.raises(acquire.NotAvailable):
        acquire.download(empty, cache, "Borgo", "V", "borgo-V-2023.zip")


def test_other_formats_are_tried(tmp_path, archive):
    cache, server = acquire.Cache(tmp_path / "cache"), Server({"M": archive})
    path, source_format, _ = acquire.collect(server, cache, "Borgo", "borgo", "V", ["M", "O", "V"], "2020-01-01")
    assert source_format == "M" and path.name == "borgo-M-2020-01-01.zip" and [f for f, _ in server.asked] == ["V"] * 3 + ["O"] * 3 + ["M"]
    assert acquire.formats_to_try("O", ["V", "M", "O"]) == ["O", "V", "M"]
    nothing = Server({})
    assert acquire.collect(nothing, cache, "Mare", "mare", "V", smoke=True) is None
    with pytest.raises(acquire.NotAvailable, match="no format"):
        acquire.collect(nothing, cache, "Mare", "mare", "V", ["O"])


def test_listed_articles(spark):
    one = """<a onclick="return showArticle('/x?a=1&amp;b=2', 1)" class="numero_articolo">%s</a>"""
    page = one % " 1 " + one.replace("a=1", "a=3") % "2" + one % "1" + one.replace("numero", "other") % "3"
    row = spark.createDataFrame([(page,)], "p string").select(T.article_links("p").alias("l")).first()
    assert [tuple(x) for x in row["l"]] == [("/x?a=1&b=2", "1"), ("/x?a=3&b=2", "2")]
    files = spark.createDataFrame([(p,) for p in ("b/A.xml", "B/a.xml", "b.xml", "a/z.xml")], "source string")
    assert [r[0] for r in files.orderBy(archives.order_of("source"), "source").collect()] == ["a/z.xml", "B/a.xml", "b/A.xml", "b.xml"]


def test_a_listing_must_be_a_list(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"error": "x"}')
    with pytest.raises(TypeError):
        archives.collections(spark, str(tmp_path / "l.json"))


def test_the_last_of_repeated_keys_counts(spark):
    row = spark.createDataFrame([('---\nurn: a\ntipo: x\nurn: b\n urn : c\n---\nbody',)], "raw string").select(T.read_front_matter("raw").alias("head")).first()
    assert row["head"] == {"tipo": "x", "urn": "c"}


def test_markdown_tree(spark, tmp_path):
    for name, urn in (("a/x.md", "u1"), ("a-b.md", "u1"), ("z.md", "u2")):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(f'---\nurn: {urn}\ntitolo: "a \\"b\\\\"\n---\nbody\n')
    (tmp_path / "bad.md").write_text("no head")
    tree = archives.markdown_tree(spark, str(tmp_path))
    index = {r["urn"]: r["path"] for r in archives.urn_index(tree).collect()}
    assert index["u1"].endswith("a/x.md") and index["u2"].endswith("z.md")
    assert {r["urn"]: r["path"] for r in archives.urn_index(tree, last_wins=True).collect()}["u1"].endswith("a-b.md")
    assert tree.where("bad").count() == 1 and tree.where("NOT bad").select(F.col("head")["titolo"]).first()[0] == 'a "b\\'
    assert archives.xml_folder(spark, str(tmp_path)).count() == 0


def test_listing_and_side_sources(spark, tmp_path):
    (tmp_path / "l.json").write_text('[{"nomeCollezione":" A ","formatoCollezione":"o"},{"nome":"A","formatoCollezione":"M","dataCreazione":"2"},{"nomeCollezione":"B","formatoCollezione":"?"},{"nomeCollezione":""}]')
    rows = archives.collections(spark, str(tmp_path / "l.json"))
    merged = {r[0]: (r[1], r[3]) for r in canonical.merge_collections(rows).collect()}
    assert merged == {"A": ("O", ["M", "O"]), "B": ("V", [])}
    assert [r["formato"] for r in archives.download_params(rows).collect()] == ["O", "M", "V", "V"]
    texts = spark.createDataFrame([("s", 0, "1", "a\nb"), ("s", 1, "1", "c"), ("s", 2, "2", "d")], "source string, pos int, number string, text string")
    assert sorted(r["eid"] for r in archives.article_rows(texts).collect()) == ["art_1", "art_1_2", "art_2"]
    sources = spark.createDataFrame([("X", 100), ("Y", 1)], "code string, min_articles int")
    counts = spark.createDataFrame([("X", 5), ("Y", 1)], "code string, max_articles int")
    assert [r["code"] for r in archives.missing_sources(sources, counts).collect()] == ["X"]


@pytest.mark.parametrize(
    "function,value,expected",
    [
        (T.slug, "Art. 1°-bis", "art-1-bis"), (T.slug, "°", "x"), (T.fragment_slug, "1°a", "1-a"), (T.fragment_slug, "°", ""), (T.camel_to_dots, "decretoLegge", "decreto.legge"),
        (T.href_to_urn, "urn:nir:x;1#a", "urn:nir:x;1"), (T.href_to_urn, "/akn/it/act/decretoLegge/STATO_A/2020-01-01/5/x", "urn:nir:stato.a:decreto.legge:2020-01-01;5"), (T.href_to_urn, "/akn/it/act/a", None),
        (T.encode_link, 'a (b)[c]#"<>\\%', "a%20%28b%29%5Bc%5D%23%22%3C%3E%5C%"), (T.year_bucket, None, "igno"), (T.year_bucket, "2020-01-01", "2020"), (T.squeezed, "a \n b ", "a b"), (T.squeezed, "  ", None),
        (T.safe_repo_name, " Leggi (2020)/Codici ", "leggi-2020-codici"), (T.safe_repo_name, None, "collezione"), (T.safe_filename, "a/b:  c.", "a-b c"), (T.collection_folder, "a-b: c", "a b c"), (T.casefold, "Straße", "strasse"),
        (T.redact, "https://u:p@x.it Authorization: basic abc", "https://***@x.it Authorization: basic ***"), (T.title_unescape, 'a\\"\\\\n', 'a"\\n'), (T.fit_basename, "é" * 150, T.fitted("é" * 150)),
    ],
)
def test_text_functions(spark, function, value, expected):
    assert spark.createDataFrame([(value,)], "v string").select(function("v")).first()[0] == expected


def test_names_fit_and_pages_give_text(spark):
    assert len(T.fitted("é" * 150).encode()) <= 200 and T.fitted("short") == "short"
    page = '<nav>x</nav><div class="bodyTesto"><h2>Titolo</h2><div>in</div><p>Testo <b>vigente</b>.</p></div><p>out</p>'
    assert T.html_block_text(page).splitlines() == ["Titoloin", "Testo vigente."]
    nested = '<div class="x bodyTesto">a<div>b<br>c</div>&amp;lt; d</div>e<div class="bodyTesto"><ul><li>f</ul></div>'
    assert T.html_block_text(nested) == "ab\nc&lt; d\nf"
    row = spark.createDataFrame([("atti/a/b.md", "atti/c.md")], "s string, t string").select(T.relative_link("s", "t")).first()
    assert row[0] == "../c.md"


DOCS = [("u1", "Legge sulla libertà", "la libertà di stampa e la libertà"), ("u2", "Codice", "omicidio doloso e omicidi"), ("u3", "Altro", "stampa di libri"), ("u4", "Vuoto", ""), ("u5", "Nulla", "qui niente altro"), ("u6", "Sei", "testo semplice"), ("u7", "Sette", "ancora testo")]


@pytest.mark.parametrize("query", ["liberta", "stampa liberta", "stampa OR omicid*", "stampa NOT libri", '"liberta di stampa"', "titolo:codice", "(stampa OR doloso) AND omicidio", "text:altro", "testo AND ancora"])
def test_search_scores_as_sqlite_does(spark, query):
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE f USING fts5(urn UNINDEXED, titolo, text)")
    db.executemany("INSERT INTO f VALUES (?, ?, ?)", DOCS)
    expected = db.execute("SELECT urn, round(bm25(f), 5) FROM f WHERE f MATCH ? ORDER BY rank, urn", (query,)).fetchall()
    docs = spark.createDataFrame(DOCS, "urn string, titolo string, text string")
    found = [(r["urn"], round(r["score"], 5)) for r in search.search(docs, query).collect()]
    stored = search.search(docs, query, index=search.postings(docs), counts=search.totals(docs)).collect()
    assert [(r["urn"], round(r["score"], 5)) for r in stored] == found
    if " OR " in query or " NOT " in query or "*" in query:  # unmatched branches may be scored differently
        assert {u for u, _ in found} == {u for u, _ in expected}
    else:
        assert found == expected


def test_marks_are_stripped_as_sqlite_does(spark):
    letters = [c for c in map(chr, (*range(0xC0, 0x180), *range(0x1E00, 0x1F00))) if c.isalpha() and len(c.lower()) == 1 and len(unicodedata.normalize("NFD", c)) > 1 and not unicodedata.decomposition(c).startswith("<")]
    db = sqlite3.connect(":memory:")
    db.execute("CREATE VIRTUAL TABLE f USING fts5(t, tokenize='unicode61 remove_diacritics 2')")
    db.execute("CREATE VIRTUAL TABLE v USING fts5vocab(f, row)")
    for c in letters:
        db.execute("INSERT INTO f VALUES (?)", (f"x{c}y{ord(c)}",))
    wanted = {r[0] for r in db.execute("SELECT term FROM v")}
    found = spark.createDataFrame([(f"x{c}y{ord(c)}",) for c in letters], "t string").select(search.tokens(F.col("t")).alias("t")).collect()
    assert {t for r in found for t in r["t"]} == wanted


@pytest.mark.parametrize("query", ["", "a-b", "dell'atto", "x:y", "(a", "NOT", '"', "a OR"])
def test_bad_queries(query):
    with pytest.raises(search.MatchError):
        search.parse_match(query)


def test_stream_keeps_the_best(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("b.xml", "c.xml", "a.xml"):
        (tmp_path / "in" / name).write_text(MARKET)
        stream = ingest.member_stream(spark, str(tmp_path / "in"), "Codici")
        ingest.keep_best(spark, stream, str(tmp_path / "t"), str(tmp_path / "c")).start().awaitTermination()
    newest = spark.read.parquet(str(tmp_path / "t/v=2"))
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["v=1", "v=2"]
    assert newest.count() == 1 and newest.first()["source"].endswith("a.xml")
    assert akn.errors(akn.parse_members(spark.createDataFrame([], "collection string, source_format string, source string, raw binary"))).count() == 0
