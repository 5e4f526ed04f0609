"""End-to-end jobs.

``prepare_dataset`` (chat/instruction JSON -> train/eval JSONL):
    scan -> parse/classify -> turns (written once) -> one exchange on conv_id ->
    runs / sample ranges / dedup, no text -> keys -> scratch table ->
    cap + split thresholds (bounded aggregations) -> two narrow filters ->
    text of the survivors -> write -> validate.

``prepare_model_inputs`` (JSONL -> fixed-length, label-masked id arrays):
    read -> (eval: subsample first, then encode) -> render -> encode (vocabulary
    shipped as one bounded map) -> truncate -> pad -> mask.
"""

from __future__ import annotations

import posixpath
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.render import render_instruct_text, render_messages_text
from ..operators.normalise import drop_blank, fill_blank
from ..operators.sampling import eval_subsample_by_text, shuffled, split
from ..operators.samples import attach_messages, pool, sample_ranges, with_sample_id
from ..operators.sequence import instruct_from_dialogue
from ..operators.tokens import MAX_LENGTH, PAD_ID, build_vocab, model_inputs
from ..operators.validate import is_valid, require_nonempty, validate
from ..session import scratch_table
from ..sources.documents import check_format, count_docs, instruct_pairs, read_documents, to_turns
from ..sources.jsonl import read_samples, write_splits


@dataclass
class PrepareResult:
    """``dropped``: how many documents or entries were left out, by reason; the rows
    themselves are written to ``paths["dropped"]`` and readable as ``quarantine``."""

    paths: dict
    counts: dict
    quarantine: DataFrame
    valid: dict = field(default_factory=dict)
    dropped: dict = field(default_factory=dict)


@contextmanager
def dataset_samples(spark: SparkSession, input_path: str, fmt: str, pairs=(8, 16), pair_mode: str = "observed"):
    """``(samples, attach, quarantine)`` of one input folder: rows with lineage and
    ``sample_id``, a function that gives text to those of them that are kept, and what was
    left out. Chats are parsed once into a table of turns (deleted at the end); their
    samples are ranges without text until ``attach``."""
    check_format(fmt)
    entries, left_out = read_documents(spark, input_path, fmt)
    turns, bad_docs = to_turns(entries, fmt)
    quarantine = pool(left_out, bad_docs.select("conv_id", "reason"))
    if fmt == "conversational":
        with scratch_table(fill_blank(turns), "turns") as stored:
            yield with_sample_id(sample_ranges(stored, pairs, pair_mode)), lambda kept: attach_messages(kept, stored, pair_mode), quarantine
        return
    from_dialogue = instruct_from_dialogue(drop_blank(turns)).select(
        "conv_id", F.col("model_turn").alias("turn"), "instruction", "response", "context"
    )
    from_files, rejects = instruct_pairs(entries)
    quarantine = quarantine.unionByName(rejects.select("conv_id", F.concat(F.lit("entry_"), "reason").alias("reason")))
    yield with_sample_id(pool(from_dialogue, from_files), ("conv_id", "turn")), lambda kept: kept, quarantine


def prepare_dataset(
    spark: SparkSession,
    input_path: str,
    out_dir: str,
    base: str = "dataset.jsonl",
    fmt: str = "instruct",
    max_samples: int | None = 4000,
    validation_split: float = 5,
    seed: int = 0,
    pairs=(8, 16),
    pair_mode: str = "observed",
) -> PrepareResult:
    with dataset_samples(spark, input_path, fmt, pairs, pair_mode) as (samples, attach, quarantine):
        # keyed samples are written once into the shared folder (chat samples as narrow
        # ranges); thresholds and the two writes read that table
        with scratch_table(shuffled(samples, seed), "samples") as keyed:
            train, evl, counts = split(keyed, validation_split, max_samples)
            require_nonempty(counts["train"], counts["eval"])
            paths = write_splits(attach(train), attach(evl), out_dir, base, fmt)
    valid = {}
    for k, p in paths.items():
        if p:
            report = validate(spark.read.text(p), fmt)
            valid[k] = is_valid(report)
            counts[f"{k}_validated"] = report.first()["n_rows"]
    if not all(valid.values()):
        raise RuntimeError(f"output failed validation: {valid}")
    paths["dropped"] = posixpath.join(out_dir, f"dropped_{base}")
    quarantine.write.mode("overwrite").json(paths["dropped"])
    quarantine = spark.read.schema("conv_id string, reason string").json(paths["dropped"])
    dropped = {r["reason"]: r["count"] for r in quarantine.groupBy("reason").count().collect()}  # one row per reason
    counts["files"] = count_docs(spark, input_path)
    return PrepareResult(paths, counts, quarantine, valid, dropped)


def prepare_model_inputs(
    spark: SparkSession,
    train_path: str,
    eval_path: str | None = None,
    fmt: str = "instruct",
    vocab: DataFrame | None = None,
    vocab_size: int = 32_000,
    max_length: int = MAX_LENGTH,
    pad_id: int | None = PAD_ID,
    eval_rows: int = 200,
    side: str = "right",
) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Returns ``(train_inputs, eval_inputs, vocab)``. The eval set is cut to
    ``eval_rows`` with a fixed seed *before* encoding (same rows, less work)."""
    check_format(fmt)

    def rendered(path: str) -> DataFrame:
        df = read_samples(spark, path, fmt)
        # (the reader wants a data column next to the corrupt-record column)
        bad = df.agg(F.count_if(F.col("_corrupt_record").isNotNull()).alias("n"), F.count(df.columns[0])).first()["n"]
        if bad:
            raise ValueError(f"{path}: {bad} lines are not valid JSON samples")
        df = df.drop("_corrupt_record")
        text = render_instruct_text("instruction", "response") if fmt == "instruct" else render_messages_text("messages")
        return df.withColumn("text", text)

    train = rendered(train_path)
    if vocab is None:
        vocab = build_vocab(train, vocab_size)
    train_inputs = model_inputs(train, vocab, max_length=max_length, pad_id=pad_id, side=side)
    eval_inputs = None
    if eval_path:
        evl = eval_subsample_by_text(rendered(eval_path), eval_rows, 42)
        eval_inputs = model_inputs(evl, vocab, max_length=max_length, pad_id=pad_id, side=side)
    return train_inputs, eval_inputs, vocab
