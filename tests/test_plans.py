"""Physical-plan guards: exchanges and scan pruning of the headline pipelines."""

import re

from turnloom.plans import catalogue as C

from .conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_single_exchange(spark):
    turns = C.fill_blank(C.conv_turns(spark, SF["0.01"]))
    p = plan(C.sample_report(C.conversational_samples(turns, strategy="conversation")))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1, p


def test_no_window_on_a_bare_user_over_the_events(spark):
    """Rows are numbered per (user, day); the only per-user windows run over one row per
    block (numbering) or over the few candidates of each block (top-n)."""
    from turnloom.operators import checkpoints as ck
    from turnloom.plans.adapters import eval_events, table

    p = plan(eval_events(table(spark, SF["0.01"], "events")))
    windows = [line for line in p.splitlines() if "Window [" in line]
    assert any("row_number" in w and "_blk" in w.split("windowspec", 1)[1].split("],", 2)[0] for w in windows), p
    for w in windows:
        assert "_blk" in w or "_n" in w, w
    assert "props" not in p
    p = plan(ck.best_k_final(spark.read.parquet(f"{SF['0.01']}/events.parquet").selectExpr("user_id run_id", "event_id step", "value eval_loss")))
    assert len(re.findall(r"hashpartitioning\(run_id#\d+L?, _b#", p)) == 1, p


def test_no_top_k_over_unfiltered_rows(spark):
    """Vocabulary: only the tokens at the threshold count are sorted."""
    from turnloom.operators.tokens import build_vocab

    p = plan(build_vocab(spark.createDataFrame([("a b a c",), ("a b d",)], "text string"), 8))
    assert "Filter" in p[p.index("TakeOrderedAndProject") :] if "TakeOrderedAndProject" in p else True


def test_scan_prunes_columns(spark):
    df = C.q_instruct_pairs(spark, SF["0.01"])
    p = plan(df)
    assert "props" not in p  # the unused JSON column never leaves the parquet scan


def test_encode_has_no_join(spark):
    v = spark.createDataFrame([("<pad>", 0), ("a", 6)], "token string, id int")
    from turnloom.operators.tokens import encode

    p = plan(encode(spark.createDataFrame([("a b",)], "text string"), v))
    assert "Join" not in p and "Exchange" not in p


def test_split_outputs_have_no_global_sort(spark):
    from turnloom.operators.sampling import split

    train, evl, _ = split(C.keyed(C.ev_samples(spark, SF["0.01"])), 5, 4000)
    for df in (train, evl):
        p = plan(df)
        assert "rangepartitioning" not in p and "SinglePartition" not in p and "TakeOrderedAndProject" not in p, p


def test_no_text_below_the_cap(spark):
    """Dedup, keys, cap and split see narrow rows; text is attached to the survivors only."""
    from turnloom.operators.sampling import split
    from turnloom.operators.samples import attach_messages, sample_ranges

    turns = C.fill_blank(C.conv_turns(spark, SF["0.01"]))
    keyed = C.keyed(sample_ranges(turns, strategy="conversation"))
    p = plan(keyed)
    assert "messages" not in p and "Window" in p
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1, p  # D1 adds no exchange
    top = p[: p.index("Generate")]
    assert "content" not in top and "runs" not in top.replace("ri#", ""), top
    train, _, _ = split(keyed, 5, 100)
    assert "messages" not in plan(train)
    assert "messages" in plan(attach_messages(train, turns))
