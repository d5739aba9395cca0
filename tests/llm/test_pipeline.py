import corpus_pipeline
from test_operators import ENCODING, linked_groups, spans

from lexspark.llm import quality_rules


def test_stages(spark, docs):
    df, _ = docs
    made, columns = {"": df}, df.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, "")
        made[name] = df = spark.createDataFrame(out.collect(), out.schema)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert df.columns == columns
    kept = made["quality_rules"].collect()
    assert {r["doc_id"] for r in kept} == {r["doc_id"] for r in quality_rules.judge(made[""]).where("kept").collect()}
    groups = linked_groups([(r["doc_id"], r["text"]) for r in kept], 80, 5)
    assert sorted(r["doc_id"] for r in made["ngram_jaccard_join"].collect()) == sorted({c for _, _, c in groups})
    for r in made["secret_scan"].collect():
        assert not spans(r["text"]) and r["n_chars"] == len(r["text"])
    assert made["secret_scan"].count() == made["ngram_jaccard_join"].count()
    before = {r["doc_id"]: r["text"] for r in made["secret_scan"].collect()}
    mixed = made["source_mixing"].collect()
    assert mixed and all(before[r["doc_id"]] == r["text"] for r in mixed)
    for r, t in zip(sorted(made["byte_bpe"].collect(), key=lambda r: r["doc_id"]), sorted(mixed, key=lambda r: r["doc_id"])):
        assert r["ids"] == ENCODING.encode_ordinary(t["text"])


def test_run_gives_the_last_stage(spark, docs):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "ids", "ends"} <= set(out.columns) and out.count() > 0


def test_stages_take_odd_and_empty_tables(spark, odd, empty):
    for df in (odd.select("doc_id", "text", "lang", "source", "n_chars"), empty.select("doc_id", "text", "lang", "source", "n_chars")):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, df, "").count() <= 3 * df.count()
