"""The registered queries ``opN_<name>`` and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontaminate, embed_dedup, html_extract, katz, langid, sentencepiece, sharding, simhash, spelling, suffix_dedup, token_files, toxicity, whitening
from .common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return got.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.drop("spans")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), span=200)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, toxicity.graded(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).drop("text")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_dedup(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op7_sentencepiece(spark: SparkSession, sf_dir: str, model: str = "piece_bpe_32k.model") -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(model)
    docs = table(spark, sf_dir, "documents").withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    got = sentencepiece.decode(sentencepiece.encode(docs, path, carry=["h"]), path)
    return got.select("doc_id", "n_tokens", "ids", (F.xxhash64("decoded") == F.col("h")).alias("round_trip"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.held_out())
    profiles = langid.learn(docs.where("NOT held_out"))
    return langid.identify(docs.drop("lang"), profiles).select("doc_id", "held_out", "lang_pred", "score")


def op9_token_files(spark: SparkSession, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    import public_tokenizers

    files, coder = token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(tokenizer))
    return token_files.read_token_files(files, coder)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), sharding.document_key()).select("doc_id", "slot", "shard")


def op11_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = katz.katz_scores(docs, ~katz.held_out(), order=2)
    return got.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return whitening.whiten(rows, whitening.fit(rows, components=16)).drop("deviation_wide", "eigenvalue")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_html_extraction": op4_html_extraction,
    "op5_toxicity": op5_toxicity,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_language_id": op8_language_id,
    "op9_token_files": op9_token_files,
    "op10_sharding": op10_sharding,
    "op11_katz_backoff": op11_katz_backoff,
    "op12_whitening": op12_whitening,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": decontaminate.ORACLE,
    "op10_sharding": sharding.ORACLE,
}
