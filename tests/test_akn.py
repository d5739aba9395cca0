import json

import pytest
from akn_samples import BOUND, BRIDGE, FERRY, MARKET, act, b64
from pyspark.sql import functions as F

from lexspark import staging
from lexspark.operators import canonical, gates, snapshot, temporal
from lexspark.plans import build, cli
from lexspark.sources import akn, archives, sinks

FERRY_URN, MARKET_URN, BRIDGE_URN = "urn:nir:borgo:ordinanza:2013-03-04;31", "urn:nir:borgo:regolamento.comunale:1998-11-20;412", "urn:nir:borgo:ordinanza:2015-05-05;77"
FAILURES = [
    (b64("<HTML></HTML>"), "base64-wrapped HTML, not AKN XML"),
    (b64(" <!DOCTYPE html><p/>"), "base64-wrapped HTML, not AKN XML"),
    (b64("<town/>"), "XML root is not Akoma Ntoso"),
    (act(urn=False).encode(), "missing URN"),
    (act(code="").encode(), "missing codice_redazionale"),
    (b"<" * (1 << 20), "source payload is exactly 1 MiB and appears truncated"),
    (b"?" * (1 << 20), "source payload is exactly 1 MiB and appears truncated"),
    (b"a ferry", "payload is not XML"),
    (b" \n", "payload is not XML"),
    (b64(b"<town>\xfe</town>"), "base64 payload is not UTF-8 XML"),
    (b"", "Empty content"),
    (None, "Empty content"),
]


@pytest.mark.parametrize("raw,message", FAILURES)
def test_rejected_members(raw, message):
    assert akn.parse_member(raw)["error"] == message


def test_accepted_members():
    assert akn.parse_member(b64(FERRY))["urn"] == FERRY_URN
    assert "error" not in akn.parse_member(MARKET.replace("Stalls", "Sta\x07lls").encode())
    assert "\ufffd" in akn.parse_member(MARKET.encode().replace(b"Stalls", b"Sta\xfflls"))["template"]
    found = akn.parse_member(BOUND.encode())
    assert [i["anchor"] for i in found["intervals"]] == ["art-9-ter", "statute-of-mills-art-3"] and found["source_articles"] == 2
    assert found["template"] == '<a id="art-9-ter" data-akn-name="article"></a>\n## Art. 9 ter\n\nRopes.\n\n<a id="statute-of-mills-art-3" data-akn-name="article"></a>\n## Art. 3\n\nWheels.\n\nWords.'
    ferry = akn.parse_member(FERRY.encode())
    assert (ferry["entrata_in_vigore"], ferry["titolo"], ferry["tipo"]) == ("2013-04-01", 'Act "31" of the town', "Ordinanza")
    assert [tuple(i.values()) for i in ferry["intervals"]] == [("art-4", "2013-04-01", "2017-07-01"), ("art-4", "2017-07-01", None), ("art-4-bis", "2018-12-01", "2019-03-01"), ("fares", None, None)]


def members(spark, *rows):
    return spark.createDataFrame([(c, f, s, bytearray(x.encode() if isinstance(x, str) else x)) for c, f, s, x in rows], "collection string, source_format string, source string, raw binary")


ROWS = (("Ordinanze", "V", "a.xml", FERRY), ("Codici", "V", "b.xml", MARKET), ("Altro", "V", "c.xml", MARKET), ("Ordinanze", "V", "d.xml", BRIDGE), ("Ordinanze", "V", "e.xml", b"bad"))


@pytest.fixture(scope="module")
def made(spark):
    return build.plan(members(spark, *ROWS))


def test_members_are_parsed_once(made):
    """Only staged tables are read: no plan of a result has the parser in it."""
    for table in (made.rendered, made.documents, made.articles, made.resolved, made.errors):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and "Python" not in plan


def test_canonical_and_rendering(made):
    rows = {r["urn"]: r for r in made.rendered.collect()}
    assert rows[MARKET_URN]["collection"] == "Codici"
    row = rows[BRIDGE_URN]
    text = row["markdown"]
    assert "As in [the market rules](998M0412.md#art-12) and [the tolls](https://www.normattiva.it/uri-res/N2Ls?http://bridge.example/toll), nowhere." in text
    assert "| Cart | Toll | Note |\n| --- | --- | --- |\n| empty | 2 |  |\n|  |  |  |\n\na drawing\n" in text
    assert (row["internal_links"], row["external_links"], row["unresolved_links"], row["unsupported_tags"]) == (1, 1, 1, ["map"])
    assert row["stato_atto"] == "futuro" and text.startswith('---\nschema_version: 4\ntipo: Ordinanza\n') and 'titolo: "Act \\"77\\" of the town"' in text
    assert rows[MARKET_URN]["body"] == '<a id="part-part-2"></a>\n## Part 2 — Stalls\n\n<a id="part-part-2-art-art-12" data-akn-name="article"></a>\n### Art. 12 — Fish\n\nFish is sold before noon.'


def test_articles_and_points_in_time(made):
    at = lambda anchor, day: [(r["version"], r["text"]) for r in temporal.article_as_of(made.articles, FERRY_URN, anchor, day).collect()]
    early, late = (1, "### Art. 4\n\nThe ferry leaves at nine."), (2, "### Art. 4\n\nThe ferry leaves at eight;\n\non feast days at ten.")
    assert [at("art-4", d) for d in ("2013-03-31", "2013-04-01", "2017-06-30", "2017-07-01")] == [[], [early], [early], [late]]
    assert not at("art-4-bis", "2018-11-30") and at("art-4-bis", "2018-12-01") and not at("art-4-bis", "2019-03-01")
    assert at("fares", "1900-01-01") == [(1, "## Table of fares\n\nOne coin.")] or "One coin." in at("fares", "1900-01-01")[0][1]


def test_manifest_counts(made):
    found = build.manifest(made, "2026-01-01", "2026-01-01T00:00:00+00:00", asked=build.Asked(4, 3), known_gaps=["maps"])
    assert found["counts"] == {"acts": 3, "articles": 6, "internal_links": 1, "external_links": 1, "unresolved_links": 1, "duplicates": 1, "xml_received": 5, "skipped": 1}
    assert found["by_year"] == {"1998": 1, "2013": 1, "2015": 1} and found["by_collection"]["Altro"]["converted"] == 0 and found["by_type"] == {"Ordinanza": 2, "Regolamento.Comunale": 1}
    assert found["collections"] == {"requested": 4, "downloaded": 3} and found["known_gaps"] == ["maps"] and found["unsupported_tags"] == ["map"]


KNOWN = ("invalid_xml", "Ordinanze", None, ["e.xml"], None, "a scan", "2030-01-01")
NOW = "2026-01-01T00:00:00+00:00"


def rules(spark, *exceptions, **more):
    return build.Rules("2026-01-01", exceptions=spark.createDataFrame(list(exceptions), build.EXCEPTIONS), **more)


@pytest.fixture(scope="module")
def published(spark, made, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("published"))
    manifest = build.publish(made, folder, rules(spark, KNOWN), NOW)
    return folder, manifest


def test_published_snapshot_serves_the_command_line(published, spark, capsys):
    folder, manifest = published
    assert manifest["counts"]["acts"] == 3 and json.load(open(f"{folder}/manifest.json")) == manifest
    assert json.load(open(f"{folder}/delta.json"))["from"] is None and spark.read.parquet(f"{folder}/delta.parquet").count() == 3
    run = lambda *a: cli.main([a[0], "--snapshot", folder, *a[1:]], spark)
    assert run("get", FERRY_URN, "--article", "art-4", "--vigente-al", "2014-01-01") == 0
    assert "leaves at nine" in capsys.readouterr().out
    assert run("get", "urn:none") == 1 and run("search", "feast") == 0 and run("search", "absent") == 1 and run("search", "a-b") == 2 and run("verify") == 0
    assert cli.main(["get", "--snapshot", folder + "/no", "x"], spark) == 2


def test_verify_finds_what_is_damaged(published, spark, tmp_path):
    import shutil

    folder = str(tmp_path / "damaged")
    shutil.copytree(published[0], folder)
    assert cli.verify(spark, folder) == []
    table = lambda name: spark.read.parquet(f"{published[0]}/{name}.parquet")
    table("code_index").where("code != '015P0077'").write.mode("overwrite").parquet(f"{folder}/code_index.parquet")
    table("documents").where(F.col("urn") != FERRY_URN).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    (tmp_path / "damaged/.manifest.json.crc").unlink()
    (tmp_path / "damaged/manifest.json").write_text('{"schema_version": 3, "counts": {"acts": 3, "articles": 7}}')
    assert set(cli.verify(spark, folder)) == {"manifest schema", "checksum: code_index.parquet", "checksum: documents.parquet", "checksum: manifest.json", f"index reference: {BRIDGE_URN}", "foreign keys of articles", "document references", "document count", "article count"}
    (tmp_path / "damaged/SHA256SUMS").unlink()
    assert "SHA256SUMS missing" in cli.verify(spark, folder)


def test_a_draft_that_fails_is_not_published(made, published, spark, tmp_path):
    required = spark.createDataFrame([("998M0412", 2, ["part-part-2", "art-9"]), ("000X", 1, [])], "code string, min_articles int, required_anchors array<string>")
    with pytest.raises(gates.QualityGateError) as told:
        build.publish(made, str(tmp_path / "a"), rules(spark, required=required), NOW)
    for failure in ("1 XML skipped, 1 unexcepted errors", "e.xml: payload is not XML", "required act missing: 000X", "atti/998M0412.md has 1 articles, expected at least 2", "atti/998M0412.md is missing required anchor art-9"):
        assert failure in str(told.value)
    assert "part-part-2" not in str(told.value) and not (tmp_path / "a/manifest.json").exists()
    assert cli.main(["search", "--snapshot", str(tmp_path / "a"), "ferry"], spark) == 2


def test_the_snapshot_before_is_a_measure(made, published, spark, tmp_path):
    held = rules(spark, KNOWN, previous=published[0])
    assert build.publish(made, str(tmp_path / "same"), held, NOW) is None and not (tmp_path / "same/manifest.json").exists()
    fewer = members(spark, *ROWS[:1], *ROWS[3:])
    with pytest.raises(gates.QualityGateError) as told:
        build.build(fewer, str(tmp_path / "fewer"), held, NOW)
    for failure in ("acts regressed from 3 to 2", "articles regressed from 6 to 5", "internal_links regressed from 1 to 0", "external_links increased from 1 to 2", "previous document disappeared: atti/998M0412.md", "Codici.converted regressed from 1 to 0"):
        assert failure in str(told.value)
    side = archives.side_members(
        spark.createDataFrame([("998M0412", MARKET_URN, "Regolamento", "412", "1998-11-20", 'Fish & "salt"')], "code string, urn string, type string, number string, date string, title string"),
        archives.article_rows(spark.createDataFrame([("998M0412", 1, "2", "b"), ("998M0412", 0, "1", "a < b\r\nc"), ("998M0412", 2, "2", "d")], "source string, pos int, number string, text string")),
        "Fonti",
    )
    with pytest.raises(gates.QualityGateError) as told:
        build.build(fewer, str(tmp_path / "side"), held, NOW, side_members=side)
    assert "acts regressed" not in str(told.value) and "disappeared" not in str(told.value) and "Codici.converted regressed" in str(told.value)
    text = spark.read.parquet(f"{tmp_path}/side/documents.parquet").where(F.col("urn") == MARKET_URN).first()
    assert text["titolo"] == 'Fish & "salt"' and "## Art. 1\n\na < b\n\nc" in text["text"] and '<a id="art-2-2"' in text["text"]


def test_modes(spark, made):
    with pytest.raises(ValueError, match="dry run"):
        build.build(None, "x", build.Rules("2026-01-01"), NOW, smoke=True, dry_run=False)
    with pytest.raises(ValueError, match="folder"):
        build.build(None, None, build.Rules("2026-01-01"), NOW, dry_run=False)


def test_sinks(made, published, spark, tmp_path):
    sinks.write_sqlite(made.documents, made.articles, str(tmp_path / "c.sqlite"))
    sinks.write_jsonl(made.documents, str(tmp_path / "jsonl"))
    assert sinks.write_markdown(made.rendered, f"file://{tmp_path}/md").count() == 3 and (tmp_path / "md/atti/998M0412.md").is_file()
    assert sinks.write_collections(spark.read.parquet(f"{published[0]}/collections.parquet"), f"file://{tmp_path}/md").count() == 3 and (tmp_path / "md/collections/altro.json").is_file()
    sinks.write_tar(str(tmp_path / "md"), str(tmp_path / "one.tar.zst"))
    sinks.write_tar(str(tmp_path / "md"), str(tmp_path / "two.tar.zst"))
    assert (tmp_path / "one.tar.zst").read_bytes() == (tmp_path / "two.tar.zst").read_bytes()
    raw = members(spark, *ROWS, ("Ordinanze", "V", "e.xml", b"worse"))
    sinks.write_rejected(akn.parse_members(raw), raw, str(tmp_path / "rejected"))
    rows = spark.read.parquet(str(tmp_path / "rejected")).collect()
    assert sorted(bytes(r["raw"]) for r in rows) == [b"bad", b"worse"] and len({r["name"] for r in rows}) == 1


def test_staged_tables_can_be_removed(spark, monkeypatch):
    monkeypatch.setattr(staging, "_made", [])
    table = staging.staged(spark.range(3), "some")
    assert table.count() == 3 and staging.remove_staged(spark) == 1 and staging.remove_staged(spark) == 0


def test_same_code_gets_suffixes_and_order_does_not_matter(spark):
    one, two = act("1", "X1"), act("2", "X1")
    for rows in ([one, two], [two, one]):
        chosen = canonical.select_canonical(akn.candidates(akn.parse_members(members(spark, *[("C", "V", f"{i}.xml", x) for i, x in enumerate(rows)]))))
        paths = sorted(r[0] for r in chosen.select("repo_path").collect())
        assert len(set(paths)) == 2 and all(len(p) == len("atti/X1-123456789012.md") for p in paths)
        assert canonical.inverted_index(chosen).select(F.size("documents")).first()[0] == 2


def test_format_beats_priority_and_source_breaks_ties(spark):
    rows = members(spark, ("Codici", "O", "a", MARKET), ("Altro", "M", "b", MARKET), ("Altro", "V", "d", MARKET), ("Altro", "V", "C", MARKET))
    best = canonical.select_canonical(akn.candidates(akn.parse_members(rows))).first()
    assert (best["source_format"], best["source"]) == ("V", "C")
    # What is equal in all names goes by its content, whatever the order of rows.
    twins = [("A", "V", "x", MARKET), ("A", "V", "x", MARKET.replace("noon", "dusk"))]
    found = {canonical.select_canonical(akn.candidates(akn.parse_members(members(spark, *t)))).first()["template"] for t in (twins, twins[::-1])}
    assert len(found) == 1


def test_gates(spark):
    errors = spark.createDataFrame([(1, "x/a.xml", "boom now", "C", "invalid_xml"), (2, "x/b.xml", "boom again", "C", "invalid_xml"), (3, "x/c.xml", "other", "C", "invalid_xml")], "error_id long, source string, message string, collection string, metric string")
    none = spark.createDataFrame([], "metric string, collection string, expected_value int, expected_sources array<string>, message string, reason string, expires string")
    rule = lambda n: spark.createDataFrame([("invalid_xml", "C", n, None, "boom", "known", "2027-01-01"), ("invalid_xml", "C", None, ["c.xml"], None, "known", "2027-01-01")], none.schema)
    assert gates.unallowed(errors, none).count() == 3 and gates.unallowed(errors, rule(2)).count() == 0 and gates.unallowed(errors, rule(1)).count() == 2
    assert gates.active(rule(2), "2026-01-01").count() == 2 and gates.active(rule(2), "2028-01-01").count() == 0
    totals = spark.createDataFrame([(4, 1, 1, 1)], "skipped long, converted long, urns long, codes long")
    with pytest.raises(gates.QualityGateError, match="1 skipped XML lack an error record"):
        gates.enforce(gates.report_failures(totals, errors, rule(2)))
    good = spark.createDataFrame([(3, 1, 1, 1)], totals.schema)
    gates.enforce(gates.report_failures(good, errors, rule(2)))
    required = spark.createDataFrame([("X", 100, ["art-1"]), ("Y", 1, [])], "code string, min_articles int, required_anchors array<string>")
    docs = spark.createDataFrame([("X", "atti/X.md", 2)], "code string, path string, articles int")
    anchors = spark.createDataFrame([("X", "art-2")], "code string, anchor string")
    assert sorted(r[0] for r in gates.coverage_failures(required, docs, anchors).collect()) == ["atti/X.md has 2 articles, expected at least 100", "atti/X.md is missing required anchor art-1", "required act missing: Y"]
    old = spark.createDataFrame([("p", "[a](x) b"), ("q", "same")], "path string, markdown string")
    new = spark.createDataFrame([("p", "[a](y) b"), ("q", "same")], "path string, markdown string")
    assert gates.only_links_changed(old, new).first()[0] and not gates.only_links_changed(old, old).first()[0]
    lines = spark.createDataFrame([("0" * 64 + "  a",), ("bad",)], "line string")
    assert snapshot.checksum_failures(lines, spark.createDataFrame([("a", "1" * 64)], "name string, sha256 string")).count() == 2
