"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm import bpe, chat, jaccard_join, language_id, language_model, media, mixing, quality_rules, secret_scan, sql, token_binary


def _path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary.read_ids(token_binary.write_ids(_table(spark, sf_dir, "documents"), _path("byte_bpe_50k.json")))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = len(secret_scan.BASE_RULES)
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.expr(f"CAST(size(filter(found, s -> s.ord = {i})) AS BIGINT) AS n_{r.kind}") for i, r in enumerate(secret_scan.BASE_RULES)]
    return found.select("doc_id", *counts, F.sha2(text(F.filter("found", lambda s: s["ord"] < base)), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_groups(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), _path("byte_bpe_50k.tiktoken"))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return media.media_features(media.encode_media(docs))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).selectExpr("-7L AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role", f"r'{said}' AS text")
    return chat.read_chat(chat.format_chat(turns.unionByName(extra)))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_id.predict(docs.select("doc_id", "text"), language_id.fit(language_id.training_rows(docs)))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_token_binary, op3_secret_scan, op4_ngram_jaccard_join, op5_byte_bpe, op6_media, op7_mixing, op8_language_model, op9_chat_format, op10_language_id)}
#: Where SQL can express the rows; tests hold the others against brute force.
ORACLE_SQL: dict[str, str] = {op3_secret_scan.__name__: sql.OP3, op4_ngram_jaccard_join.__name__: sql.OP4, op7_mixing.__name__: sql.OP7, op9_chat_format.__name__: sql.OP9}
