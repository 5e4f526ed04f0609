"""The corpus pipeline: STAGES over ``documents``, each stage one operator of ``turnloom.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps (the last one
returns token ids). ``run`` writes each stage's result as Parquet in the shared
checkpoint folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from turnloom.llm import decontaminate, langid, sentencepiece, simhash, suffix_dedup
from turnloom.llm.common import table, write_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (``und``) go; profiles are learned from all labelled rows but the held-out ones."""
    docs = docs.select(*COLUMNS)
    profiles = langid.learn(docs.where(~langid.held_out()))
    return langid.identify(docs, profiles).where(F.col("lang_pred") != langid.UNDETERMINED).select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return simhash.keep_one(docs.select(*COLUMNS), shingle=3, max_bits=2)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that also start elsewhere are cut out of the texts."""
    got = suffix_dedup.cleaned(docs.select(*COLUMNS), span=200)
    return got.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 10 consecutive words of a benchmark item go; the others stay."""
    got = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=["text", "lang", "source", "n_chars"])
    return got.where("NOT contaminated").select(*COLUMNS)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts that are left, and whether they decode to the same text."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    src = docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    got = sentencepiece.decode(sentencepiece.encode(src, path, carry=["h"]), path)
    return got.select("doc_id", "n_tokens", "ids", (F.xxhash64("decoded") == F.col("h")).alias("round_trip"))


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

# Several stages (profiles, XXH64, byte spans, Viterbi) have no SQL form: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        docs = write_table(out, "pipeline-" + name.lower().replace(" ", "-"))
    return docs
