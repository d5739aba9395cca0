"""Small acts of an invented town, for tests."""

import base64

NS = 'xmlns="http://docs.oasis-open.org/legaldocml/ns/akn/3.0" xmlns:eli="http://data.europa.eu/eli/ontology#"'


def act(number="31", code="013B0031", body="", events="", spans="", kind="ordinanza", date="2013-03-04", after="", urn=True):
    alias = f'<FRBRalias name="urn:nir" value="urn:nir:borgo:{kind}:{date};{number}"/>' if urn else ""
    local = f"<eli:id_local>{code}</eli:id_local>" if code else ""
    meta = f"<meta><identification><FRBRWork>{alias}</FRBRWork></identification><lifecycle>{events}</lifecycle><temporalData>{spans}</temporalData><proprietary>{local}</proprietary></meta>"
    preface = f'<preface><docTitle>Act "{number}" of\n the town</docTitle><docNumber>{number}</docNumber><docType>{kind.title()}</docType><docDate date="{date}">x</docDate></preface>'
    return f"<akomaNtoso {NS}><act>{meta}{preface}<body>{body}</body>{after}</act></akomaNtoso>"


FERRY = act(
    events='<eventRef eId="start" date="2013-04-01" type="entryIntoForce"/><eventRef id="change" date="2017-07-01" type="amendment"/>',
    spans='<timeInterval eId="old" start="#start" end="#change"/><timeInterval id="new" start="#change"/><timeInterval eId="winter" start="2018-12-01" end="2019-03-01"/>',
    body='<section eId="sec_1"><num>I</num><heading>The ferry</heading>'
    '<article eId="art_4" period="#old"><num>Art. 4</num><p>The ferry leaves at <i>nine</i>.</p></article>'
    '<article eId="art_4" period="#new"><num>Art. 4</num><list><item><p>The ferry leaves at eight;</p><list><item><p>on feast days at ten.</p></item></list></item></list></article>'
    '<article eId="art_4__bis" period="#winter"><num>Art. 4 bis</num><content>No ferry.</content></article></section>',
    after='<attachments><attachment><doc><mainBody><article eId="fares"><num>Table of fares</num><p>One coin.</p></article></mainBody></doc></attachment></attachments>',
)
MARKET = act("412", "998M0412", "<part><num>Part 2</num><heading>Stalls</heading><article><num>Art. 12</num><heading>Fish</heading><p>Fish is sold <b>before</b> noon.</p></article></part>", date="1998-11-20", kind="regolamento.comunale")
BRIDGE = act(
    "77",
    "015P0077",
    '<article eId="art_2"><num>Art. 2</num><p>As in <ref href="/akn/it/act/regolamentoComunale/borgo/1998-11-20/412#Art 12">the market rules</ref> and <ref href="http://bridge.example/toll">the tolls</ref>, <ref>nowhere</ref>.</p>'
    "<table><tr><th>Cart</th><th>Toll</th><th>Note</th></tr><tr><td>empty</td><td>2</td></tr><tr/></table><map>a drawing</map></article>",
    date="2015-05-05",
    events='<eventRef eId="g" date="2015-06-01" type="generation"/>',
)
BOUND = act("5", "001K0005", "", after='<attachments><doc name="Codice del Porto-art. 9 ter"><mainBody><p>Ropes.</p></mainBody></doc><doc name="Statute of Mills-Art.3"><mainBody><p>Wheels.</p></mainBody></doc><doc name="Preface"><p>Words.</p></doc></attachments>')


def b64(text):
    return base64.b64encode(text.encode() if isinstance(text, str) else text)
