"""The registered queries: each reads the driver tables in ``sf_dir`` (whole tables)
and returns a DataFrame of scalar columns whose names match ``oracle.ORACLE_SQL``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.render import messages_md5, render_instruct_text, render_messages_text
from ..operators import checkpoints as ck
from ..operators.normalise import drop_blank, fill_blank
from ..operators.sampling import cap, eval_subsample, shuffled, split
from ..operators.samples import (
    attach_messages,
    block_pairs,
    conversational_samples,
    expanding_history,
    pair_windows,
    pool,
    prep_stats,
    sample_ranges,
    sample_report,
    strided_windows,
    with_sample_id,
)
from ..operators.sequence import instruct_from_dialogue, merge_runs, role_runs, trim_leading_model
from ..operators.sessions import best_k_final_sessions, best_k_sessions, with_sessions
from ..operators.tokens import PERCENTILES, build_vocab, encode, encode_by_join, length_report, length_sketches, merge_sketches, model_inputs, sketch_report
from ..operators.validate import validate
from ..session import ensure_checkpoint_dir, shared_table
from ..sources.documents import classify_docs, explode_entries, instruct_pairs, parse_docs, raw_docs, to_turns
from ..sources.jsonl import read_samples, to_json_lines, write_splits
from ..sources.large_json import large_entries, read_pieces
from ..sources.tables import turns_from_table
from ..sources.runlogs import artifacts_of, parse_trainer_states
from .adapters import eval_events, events_as_dialogue, restarted_evals, run_metrics, table, trainer_states
from .report import run_report

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the catalogue (the reference's defaults where it has one).
MAX_SAMPLES = 4000
EVAL_PERCENT = 5
SEED = 0
EVAL_ROWS, EVAL_SEED = 200, 42
BEST_K = 2
EVERY = 20
VOCAB_SIZE = 2000
MAX_LENGTH = 512


# ---------------------------------------------------------------- inputs
def ev_raw(spark, sf):
    return events_as_dialogue(table(spark, sf, "events"))


def ev_filled(spark, sf):
    return fill_blank(ev_raw(spark, sf))


def ev_counts(spark, sf):
    """Turns per user, at most: events that are no turn count as well. Cheaper to get than from the numbered turns."""
    return table(spark, sf, "events").groupBy(F.col("user_id").alias("conv_id")).agg(F.count(F.lit(1)).alias("n"))


def conv_turns(spark, sf):
    return turns_from_table(table(spark, sf, "conversations"))


def ev_samples(spark, sf, mode="observed"):
    return conversational_samples(ev_filled(spark, sf), pair_mode=mode, turn_counts=ev_counts(spark, sf))


def ev_ranges(spark, sf):
    return sample_ranges(ev_filled(spark, sf), turn_counts=ev_counts(spark, sf))


def conv_samples(spark, sf):
    return conversational_samples(fill_blank(conv_turns(spark, sf)))


def conv_split(spark, sf):
    """Train and eval samples of conversations: split as ranges, text for the survivors."""
    turns = fill_blank(conv_turns(spark, sf))
    train, evl, _ = split(stored_keys(sample_ranges(turns)), EVAL_PERCENT, MAX_SAMPLES)
    return attach_messages(train, turns), attach_messages(evl, turns)


def keyed(samples: DataFrame, seed=SEED) -> DataFrame:
    return shuffled(with_sample_id(samples), seed)


def stored_keys(ranges: DataFrame, seed=SEED) -> DataFrame:
    """Keyed ranges written once (narrow rows): thresholds and outputs read that table."""
    return shared_table(keyed(ranges, seed), "sample-keys")


def packed_dialogues(spark, sf) -> DataFrame:
    """conversations packed as one chat-export JSON document per conversation."""
    c = table(spark, sf, "conversations")
    sender = F.when(F.col("role") == "user", F.lit("User")).when(F.col("role") == "assistant", F.lit("Claude")).otherwise(F.lit("System"))
    obj = F.struct(
        sender.alias("sender"),
        F.when(F.col("role") != "assistant", F.col("text")).alias("userInput"),
        F.when(F.col("role") == "assistant", F.col("text")).alias("claudeOutputText"),
    )
    docs = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", obj.alias("o")))).alias("a"))
    return raw_docs(docs.select("conv_id", F.to_json(F.transform("a", lambda x: x["o"])).alias("raw")), "conv_id", "raw")


# Conversations in one export file of many, and turns in one part of it.
EXPORT_CONVERSATIONS, EXPORT_TURNS = 64, 10_000


def export_files(spark, sf) -> str:
    """conversations written as chat-export files of many conversations each (one JSON list
    a file, folder ``doc=<name>``) under the shared folder; returns the path."""
    c = table(spark, sf, "conversations")
    name = F.concat(
        F.lit("d"), F.coalesce(F.floor(F.col("conv_id") / EXPORT_CONVERSATIONS).cast("string"), F.lit("x")),
        F.lit("p"), F.coalesce(F.floor(F.col("turn") / EXPORT_TURNS).cast("string"), F.lit("x")),
    )
    sender = F.when(F.col("role") == "user", F.lit("User")).when(F.col("role") == "assistant", F.lit("Claude")).otherwise(F.lit("System"))
    entry = F.to_json(
        F.struct(
            sender.alias("sender"),
            F.when(F.col("role") != "assistant", F.col("text")).alias("userInput"),
            F.when(F.col("role") == "assistant", F.col("text")).alias("claudeOutputText"),
        )
    )
    w = Window.partitionBy("doc").orderBy("conv_id", "turn", "entry")
    rows = c.select(name.alias("doc"), "conv_id", "turn", entry.alias("entry"))
    before = F.when(F.row_number().over(w) == 1, F.lit("[")).otherwise(F.lit(","))
    after = F.when(F.lead("doc").over(w).isNull(), F.lit("]")).otherwise(F.lit(""))
    lines = rows.select("doc", "conv_id", "turn", "entry", F.concat(before, "entry", after).alias("value"))
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/exports-{uuid.uuid4().hex}"
    lines.repartition("doc").sortWithinPartitions("doc", "conv_id", "turn", "entry").select("doc", "value").write.partitionBy("doc").text(path)
    return path


def packed_instructions(spark, sf) -> DataFrame:
    """part packed as instruction files (JSON lists of at most 16 consecutive parts,
    so file size does not grow with the table), with non-string, blank, keyless and
    scalar entries mixed in by part size."""
    p = table(spark, sf, "part")
    size = F.col("p_size")
    entry = (
        F.when(size <= 5, F.to_json(F.struct(F.col("p_name").alias("instruction"), size.alias("output"))))
        .when(size <= 8, F.to_json(F.struct(F.col("p_name").alias("instruction"), F.lit("   ").alias("output"))))
        .when(size <= 10, F.to_json(F.struct(F.col("p_name").alias("instruction"))))
        .when(size == 50, F.col("p_partkey").cast("string"))
        .otherwise(F.to_json(F.struct(F.col("p_name").alias("instruction"), F.col("p_type").alias("output"))))
    )
    file_id = F.floor(F.col("p_partkey") / 16).alias("file_id")
    docs = p.groupBy(file_id).agg(F.array_sort(F.collect_list(F.struct("p_partkey", entry.alias("e")))).alias("a"))
    raw = docs.select("file_id", F.concat(F.lit("["), F.array_join(F.transform("a", lambda x: x["e"]), ","), F.lit("]")).alias("raw"))
    return raw_docs(raw, "file_id", "raw")


# ---------------------------------------------------------------- queries
def q_turns_normalise(spark, sf):
    return conv_turns(spark, sf)


def q_json_docs_to_turns(spark, sf):
    good, _ = parse_docs(packed_dialogues(spark, sf))
    turns, _ = to_turns(explode_entries(classify_docs(good, "conversational")), "conversational")
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "content")


def q_json_large_docs(spark, sf):
    """Export files read in byte ranges, whatever their size."""
    entries, _ = large_entries(read_pieces(spark, export_files(spark, sf), None, 0), "conversational")
    turns, _ = to_turns(entries, "conversational")
    return turns.select(F.regexp_extract("conv_id", "doc=([^/]+)", 1).alias("doc"), "turn", "role", "content")


def q_json_dialogue_instruct_pairs(spark, sf):
    good, _ = parse_docs(packed_dialogues(spark, sf))
    turns, _ = to_turns(explode_entries(classify_docs(good, "instruct"), "instruct"), "instruct")
    pairs = instruct_from_dialogue(drop_blank(turns))
    return pairs.select(F.col("conv_id").cast("long").alias("conv_id"), "user_turn", "model_turn", "instruction", "response", "context")


def q_json_quarantine(spark, sf):
    docs = table(spark, sf, "documents")
    prose = raw_docs(docs.select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("k"), "text"), "k", "text")
    chats = packed_dialogues(spark, sf).withColumn("conv_id", F.concat(F.lit("conv:"), F.col("conv_id")))
    allraw = prose.unionByName(chats)
    good, bad = parse_docs(allraw)
    return pool(
        good.select(F.col("conv_id").alias("doc_key"), F.lit("parsed").alias("status")),
        bad.select(F.col("conv_id").alias("doc_key"), F.col("reason").alias("status")),
    )


def q_instruct_json_pairs(spark, sf):
    good, _ = parse_docs(packed_instructions(spark, sf))
    pairs, _ = instruct_pairs(explode_entries(classify_docs(good, "instruct"), "instruct"))
    return pairs.select(F.col("conv_id").alias("doc_key"), "turn", "instruction", "response", "context")


def q_instruct_pairs(spark, sf):
    return instruct_from_dialogue(drop_blank(ev_raw(spark, sf)), turn_counts=ev_counts(spark, sf))


def q_placeholder_fill(spark, sf):
    return ev_filled(spark, sf)


def q_role_runs(spark, sf):
    return role_runs(ev_filled(spark, sf)).select("conv_id", "turn", "role", "rid", "is_head")


def q_merge_runs(spark, sf):
    m = trim_leading_model(merge_runs(role_runs(ev_filled(spark, sf))))
    return m.select("conv_id", "idx", "rid", "role", "content", "n_raw")


def q_block_pairs_observed(spark, sf):
    return sample_report(block_pairs(ev_filled(spark, sf), "observed"))


def q_block_pairs_raw(spark, sf):
    return sample_report(block_pairs(ev_filled(spark, sf), "raw"))


def q_expanding_history(spark, sf):
    return sample_report(expanding_history(ev_filled(spark, sf)))


def q_expanding_history_conversations(spark, sf):
    return sample_report(expanding_history(fill_blank(conv_turns(spark, sf))))


def q_pair_windows(spark, sf):
    return sample_report(pair_windows(ev_filled(spark, sf), (8, 16)))


def q_pair_windows_conversations(spark, sf):
    return sample_report(pair_windows(fill_blank(conv_turns(spark, sf)), (2, 3)))


def q_strided_windows(spark, sf):
    return sample_report(strided_windows(ev_filled(spark, sf), (4, 8, 16), 2, turn_counts=ev_counts(spark, sf)))


def q_conversational_samples(spark, sf):
    return sample_report(ev_samples(spark, sf, "observed"))


def q_conversational_samples_raw(spark, sf):
    return sample_report(ev_samples(spark, sf, "raw"))


def q_conversational_samples_conversations(spark, sf):
    return sample_report(conv_samples(spark, sf))


def q_pool_stats(spark, sf):
    et, ct = ev_filled(spark, sf), fill_blank(conv_turns(spark, sf))
    es, cs = conversational_samples(et), conversational_samples(ct)
    stats = prep_stats({"events.turns": et, "events.samples": es, "conversations.turns": ct, "conversations.samples": cs})
    pooled = pool(es.select("method"), cs.select("method")).agg(F.count(F.lit(1)).alias("n"))
    return stats.drop("is_total").unionByName(pooled.select(F.lit("pool.samples").alias("stage"), F.lit(None).cast("long").alias("conv_id"), "n"))


def _report_keys(df):
    return df.select("conv_id", "method", "start_idx", "n_msgs", "shuffle_key")


def q_shuffle_cap(spark, sf):
    return _report_keys(cap(stored_keys(ev_ranges(spark, sf)), MAX_SAMPLES))


def q_split_train(spark, sf):
    train, _, _ = split(stored_keys(ev_ranges(spark, sf)), EVAL_PERCENT, MAX_SAMPLES)
    return _report_keys(train)


def q_split_eval(spark, sf):
    _, evl, _ = split(stored_keys(ev_ranges(spark, sf)), EVAL_PERCENT, MAX_SAMPLES)
    return _report_keys(evl)


def q_eval_subsample(spark, sf):
    _, evl, _ = split(stored_keys(ev_ranges(spark, sf)), EVAL_PERCENT, None)
    return _report_keys(eval_subsample(evl, EVAL_ROWS, EVAL_SEED))


def _conv_pairs(spark, sf):
    return instruct_from_dialogue(drop_blank(conv_turns(spark, sf)))


def q_render_instruct(spark, sf):
    text = render_instruct_text("instruction", "response")
    return _conv_pairs(spark, sf).select("conv_id", "user_turn", F.md5(text).alias("text_md5"), F.length(text).alias("n_chars"))


def _rendered_samples(spark, sf):
    return conv_samples(spark, sf).select("conv_id", "method", "start_idx", "n_msgs", render_messages_text("messages").alias("text"))


def q_render_messages(spark, sf):
    r = _rendered_samples(spark, sf)
    return r.select("conv_id", "method", "start_idx", "n_msgs", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"))


def _rendered_and_vocab(spark, sf):
    """Rendered samples, built once into the shared folder, and their vocabulary."""
    texts = shared_table(_rendered_samples(spark, sf), "rendered-samples")
    return texts, build_vocab(texts, VOCAB_SIZE)


def q_vocab(spark, sf):
    return build_vocab(_rendered_samples(spark, sf), VOCAB_SIZE)


def _ids_md5(col):
    return F.md5(F.array_join(F.col(col), ","))


def q_encode(spark, sf):
    enc = encode(*_rendered_and_vocab(spark, sf))
    return enc.select("conv_id", "method", "start_idx", "n_msgs", F.size("input_ids").alias("n_ids"), _ids_md5("input_ids").alias("ids_md5"))


def q_encode_by_join(spark, sf):
    enc = encode_by_join(*_rendered_and_vocab(spark, sf))
    return enc.select("conv_id", "method", "start_idx", "n_msgs", F.size("input_ids").alias("n_ids"), _ids_md5("input_ids").alias("ids_md5"))


def q_truncate_pad_mask(spark, sf):
    mi = model_inputs(*_rendered_and_vocab(spark, sf), max_length=MAX_LENGTH)
    return mi.select(
        "conv_id", "method", "start_idx", "n_msgs",
        F.size("input_ids").alias("n_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_attended"),
        _ids_md5("input_ids").alias("ids_md5"),
        _ids_md5("labels").alias("labels_md5"),
        _ids_md5("attention_mask").alias("mask_md5"),
    )


def q_length_report(spark, sf):
    report = length_report(encode(*_rendered_and_vocab(spark, sf)), MAX_LENGTH)
    return report.withColumns({f"p{p}": F.round(f"p{p}", 4) for p in PERCENTILES})


# Fixed value: how far a sketched percentile's rank may be off.
SKETCH_ERROR = 0.02


def q_length_sketch(spark, sf):
    """Percentiles from KLL states stored per (method, start) and merged per method, each with
    the test that its exact rank is within the bound."""
    enc = encode(*_rendered_and_vocab(spark, sf)).select("method", "start_idx", "input_ids")
    stored = shared_table(length_sketches(enc, ["method", "start_idx"]), "length-sketches")
    report = sketch_report(merge_sketches(stored, ["method"]))
    found = report.select("method", "n_samples", F.explode(F.array(*[F.struct(F.lit(p).alias("percentile"), F.col(f"p{p}").alias("q")) for p in PERCENTILES])).alias("x"))
    lengths = enc.groupBy("method", F.size("input_ids").alias("n")).agg(F.count(F.lit(1)).alias("c"))
    ranks = found.select("method", "n_samples", "x.*").join(lengths, "method").groupBy("method", "n_samples", "percentile", "q").agg(
        F.sum(F.when(F.col("n") < F.col("q"), F.col("c")).otherwise(0)).alias("below"), F.sum(F.when(F.col("n") <= F.col("q"), F.col("c")).otherwise(0)).alias("upto")
    )
    want, off = F.col("percentile") / 100 * F.col("n_samples"), F.lit(SKETCH_ERROR) * F.col("n_samples") + 1
    return ranks.select("method", "n_samples", "percentile", ((F.col("below") - off <= want) & (want <= F.col("upto") + off)).alias("within"))


def q_validate_samples(spark, sf):
    conv_lines = to_json_lines(ev_samples(spark, sf), "conversational")
    ins_lines = to_json_lines(_conv_pairs(spark, sf), "instruct")
    return pool(
        validate(conv_lines, "conversational").withColumn("dataset", F.lit("events.conversational")),
        validate(ins_lines, "instruct").withColumn("dataset", F.lit("conversations.instruct")),
        validate(ins_lines, "conversational").withColumn("dataset", F.lit("instruct lines read as conversational")),
        validate(table(spark, sf, "documents").select(F.col("text").alias("value")), "instruct").withColumn("dataset", F.lit("documents.prose")),
    )


def q_jsonl_roundtrip(spark, sf):
    train, evl = conv_split(spark, sf)
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/jsonl-{uuid.uuid4().hex}"
    paths = write_splits(train, evl, base, "dataset.jsonl", "conversational")
    parts = [read_samples(spark, paths["train"], "conversational").select(F.lit("train").alias("split"), "messages")]
    if paths["eval"]:
        parts.append(read_samples(spark, paths["eval"], "conversational").select(F.lit("eval").alias("split"), "messages"))
    return pool(*parts).select("split", messages_md5("messages").alias("sample_md5"))


def q_jsonl_order(spark, sf):
    """The place of each written line (R1, S7): files in name order, lines in file order."""
    train, evl = conv_split(spark, sf)
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/jsonl-{uuid.uuid4().hex}"
    paths = write_splits(train, evl, base, "dataset.jsonl", "conversational")
    place = Window.partitionBy("split").orderBy("file", "line")  # at most MAX_SAMPLES lines
    parts = [
        read_samples(spark, p, "conversational").select(
            F.lit(s).alias("split"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"), "messages"
        )
        for s, p in paths.items()
        if p
    ]
    return pool(*parts).select("split", F.row_number().over(place).cast("long").alias("place"), messages_md5("messages").alias("sample_md5"))


def _evals(spark, sf):
    return eval_events(table(spark, sf, "events"))


def q_best_k_decisions(spark, sf):
    return ck.best_k_decisions(_evals(spark, sf), BEST_K).select("run_id", "step", "eval_loss", "saved")


def q_best_k_prunes(spark, sf):
    return ck.best_k_prunes(_evals(spark, sf), BEST_K)


def q_best_k_final(spark, sf):
    return ck.best_k_final(_evals(spark, sf), BEST_K).select("run_id", "rank", "step", "eval_loss")


def q_last_n(spark, sf):
    return ck.last_n(_evals(spark, sf), EVERY, 2).select("run_id", "rank", "step")


def artifacts_from_orders(spark, sf):
    o = table(spark, sf, "orders")
    root = F.concat(F.lit("runs/c"), F.col("o_custkey").cast("string"))
    name = (
        F.when(F.col("o_orderstatus") == "P", F.lit("final_model"))
        .when(F.col("o_orderpriority").startswith("5"), F.lit("best"))
        .otherwise(F.concat(F.lit("checkpoint-"), F.col("o_orderkey").cast("string")))
    )
    path = F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority").startswith("1")), root).otherwise(
        F.concat(root, F.lit("/"), name)
    )
    return o.select(root.alias("root"), path.alias("path"))


def q_resolve_artifact(spark, sf):
    return ck.resolve_artifact(artifacts_from_orders(spark, sf))


def q_runs(spark, sf):
    return ck.runs(_evals(spark, sf))


def q_eval_log(spark, sf):
    return ck.eval_log(run_metrics(table(spark, sf, "events")))


def _trainer_metrics(spark, sf):
    return parse_trainer_states(trainer_states(table(spark, sf, "events")))[0]


def q_run_metrics(spark, sf):
    m = _trainer_metrics(spark, sf)
    return m.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


def _marker_paths(spark, sf):
    """Marker files from orders: in an artifact's folder, or for some one level deeper."""
    o = artifacts_from_orders(spark, sf).select("root", "path")
    sub = F.when(F.length("path") % 3 == 0, F.lit("/old")).otherwise(F.lit(""))
    return o.select("root", F.concat("path", sub, F.lit("/adapter_config.json")).alias("path"))


def q_artifact_listing(spark, sf):
    m = _marker_paths(spark, sf)
    return artifacts_of(m, m)


def q_run_report(spark, sf):
    m = _marker_paths(spark, sf)
    return run_report(_trainer_metrics(spark, sf), artifacts_of(m, m), BEST_K)


def q_eval_schedule(spark, sf):
    return ck.eval_schedule(_evals(spark, sf), EVERY)


def _restarted(spark, sf):
    return with_sessions(restarted_evals(table(spark, sf, "events")))


def q_best_k_sessions(spark, sf):
    return best_k_sessions(_restarted(spark, sf), BEST_K).select("run_id", "session", "step", "eval_loss", "saved", "pruned_at_step")


def q_best_k_final_sessions(spark, sf):
    return best_k_final_sessions(_restarted(spark, sf), BEST_K).select("run_id", "session", "rank", "step", "eval_loss")


def q_session_best_k_stream(spark, sf):
    from ..streaming.session_best_k import replay_sessions

    return replay_sessions(spark, restarted_evals(table(spark, sf, "events")), BEST_K)


def q_best_k_stream(spark, sf):
    from ..streaming.best_k import replay_best_k

    got = replay_best_k(spark, _evals(spark, sf), BEST_K)
    return got.withColumn("pruned_steps", F.array_join(F.array_sort("pruned_steps"), ","))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
