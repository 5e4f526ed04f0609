"""Hand-derived edge cases for pairing, runs and samples (FIXTURES §3 #1-#19, #27)."""

import pytest
from pyspark.sql import functions as F

from turnloom.operators.normalise import drop_blank, fill_blank
from turnloom.operators.samples import (
    block_pairs,
    conversational_samples,
    expanding_history,
    pair_windows,
    strided_windows,
)
from turnloom.operators.sequence import instruct_from_dialogue, merged_turns, role_runs
from turnloom.sources.tables import turns_from_table

from .conftest import dialogue

ROLE_MAP = {"U": "user", "C": "model"}


def turns(spark, entries):
    return turns_from_table(dialogue(spark, entries), role="sender", role_map=ROLE_MAP)


def pairs(spark, entries):
    rows = instruct_from_dialogue(drop_blank(turns(spark, entries))).orderBy("model_turn").collect()
    return [(r.instruction, r.response) for r in rows]


def samples(spark, entries, mode="observed", p=(8, 16)):
    rows = conversational_samples(fill_blank(turns(spark, entries)), p, mode).orderBy("method_ord", "start_idx", "n_msgs").collect()
    return [[(m.role[0], m.content) for m in r.messages] for r in rows]


@pytest.mark.parametrize(
    "entries,expected",
    [
        ([("U", "a"), ("C", "b")], [("a", "b")]),
        ([("U", "a"), ("U", "b"), ("C", "c")], [("b", "c")]),
        ([("U", "a"), ("C", "b"), ("C", "c")], [("a", "b")]),
        ([("U", "a"), ("U", "  "), ("C", "b")], [("a", "b")]),
        ([("U", "a"), ("C", ""), ("C", "b")], [("a", "b")]),
        ([("C", "x"), ("U", "a")], []),
        ([("U", "a"), ("Tool", "z"), ("C", "b")], [("a", "b")]),
        ([("U", " a　"), ("C", "\tb\n")], [("a", "b")]),
    ],
)
def test_instruct_pairs(spark, entries, expected):
    assert pairs(spark, entries) == expected


def test_pair_and_prefix_collapse(spark):
    assert samples(spark, [("U", "a"), ("C", "b")]) == [[("u", "a"), ("m", "b")]]


def test_observed_block_pairs(spark):
    got = samples(spark, [("U", "a"), ("U", "b"), ("C", "c")])
    assert got == [[("u", "a\nb"), ("m", "c")], [("u", "b"), ("m", "c")]]


def test_raw_block_pairs(spark):
    got = samples(spark, [("U", "a"), ("U", "b"), ("C", "c")], mode="raw")
    assert got == [[("u", "a"), ("m", "c")], [("u", "b"), ("m", "c")], [("u", "a\nb"), ("m", "c")]]


def test_model_run_merged_into_reply(spark):
    assert samples(spark, [("U", "a"), ("C", "b"), ("C", "c")]) == [[("u", "a"), ("m", "b\nc")]]


def test_leading_model_trimmed(spark):
    assert samples(spark, [("C", "x"), ("U", "a"), ("C", "b")]) == [[("u", "a"), ("m", "b")]]


def test_placeholders(spark):
    assert samples(spark, [("U", ""), ("C", " ")]) == [[("u", "continue"), ("m", "huh?...")]]


@pytest.mark.parametrize("entries", [[("U", "a")], [("C", "a")]])
def test_single_turn_gives_nothing(spark, entries):
    assert samples(spark, entries) == []


def test_trailing_user_never_included(spark):
    assert samples(spark, [("U", "a"), ("C", "b"), ("U", "c")]) == [[("u", "a"), ("m", "b")]]


def test_two_exchanges(spark):
    got = samples(spark, [("U", "a"), ("C", "b"), ("U", "c"), ("C", "d")])
    assert got == [[("u", "a"), ("m", "b")], [("u", "c"), ("m", "d")], [("u", "a"), ("m", "b"), ("u", "c"), ("m", "d")]]


def test_repeated_exchange_dedup(spark):
    got = samples(spark, [("U", "a"), ("C", "b"), ("U", "a"), ("C", "b")])
    assert got == [[("u", "a"), ("m", "b")], [("u", "a"), ("m", "b"), ("u", "a"), ("m", "b")]]


def test_eight_pairs_window(spark):
    entries = [(s, f"{s}{i}") for i in range(8) for s in ("U", "C")]
    assert len(samples(spark, entries)) == 15


def test_same_conversation_in_two_files_not_deduped(spark):
    rows = [(c, i, s, t) for c in ("f1", "f2") for i, (s, t) in enumerate([("U", "a"), ("C", "b")])]
    df = spark.createDataFrame(rows, "conv_id string, turn long, sender string, text string")
    t = turns_from_table(df, role="sender", role_map=ROLE_MAP)
    assert conversational_samples(fill_blank(t)).count() == 2


def test_merged_turns_alternate(spark):
    entries = [("C", "x"), ("C", "y"), ("U", "a"), ("U", "b"), ("C", "c"), ("U", "d")]
    rows = merged_turns(fill_blank(turns(spark, entries))).orderBy("idx").collect()
    assert [(r.idx, r.role, r.content) for r in rows] == [(0, "user", "a\nb"), (1, "model", "c"), (2, "user", "d")]


def test_operator_counts_on_fixture(spark):
    from .conftest import SF
    from turnloom.plans.adapters import events_as_dialogue, table

    t = fill_blank(events_as_dialogue(table(spark, SF["0.001"], "events")))
    assert block_pairs(t).count() == 387
    assert expanding_history(t).count() == 204
    assert pair_windows(t).groupBy("method").count().orderBy("method").collect()[0]["count"] == 7
    assert strided_windows(t, (4, 8, 16), 2).count() == 423
    assert strided_windows(t, (5,), 2).count() == 260


def test_prefix_property_and_alternation(spark):
    from .conftest import SF
    from turnloom.plans.adapters import events_as_dialogue, table

    t = fill_blank(events_as_dialogue(table(spark, SF["0.001"], "events")))
    s = conversational_samples(t, dedup=False).where(F.col("method") != "pair")
    bad = s.where(
        ~F.forall(F.transform(F.sequence(F.lit(0), F.size("messages") - 1), lambda i: F.get(F.col("messages"), i)["role"] == F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("model"))), lambda b: b)
        | (F.element_at("messages", -1)["role"] != "model")
    )
    assert bad.count() == 0


def test_partition_count_invariance(spark):
    from .conftest import SF
    from turnloom.plans.adapters import events_as_dialogue, table

    t = fill_blank(events_as_dialogue(table(spark, SF["0.001"], "events")))
    a = conversational_samples(t).select("conv_id", "method", "start_idx", "n_msgs")
    b = conversational_samples(t.repartition(7)).select("conv_id", "method", "start_idx", "n_msgs")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("mode", ["observed", "raw"])
def test_spread_plan_equals_conversation_plan(spark, mode):
    from .conftest import SF
    from turnloom.operators.spread import spread_samples
    from turnloom.plans.adapters import events_as_dialogue, table

    t = fill_blank(events_as_dialogue(table(spark, SF["0.001"], "events")))
    cols = ["conv_id", "method", "method_ord", "start_idx", "n_msgs", "messages"]
    a = conversational_samples(t, pair_mode=mode, strategy="conversation").select(cols)
    b = spread_samples(t, pair_mode=mode, block_size=3).select(cols)
    assert a.count() == 645 - (14 if mode == "raw" else 0)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("mode,hot", [("observed", None), ("raw", 60)])
def test_ranges_with_text_attached_equal_the_samples(spark, mode, hot):
    from .conftest import SF
    from turnloom.operators.samples import attach_messages, sample_ranges
    from turnloom.plans.adapters import events_as_dialogue, table

    t = fill_blank(events_as_dialogue(table(spark, SF["0.001"], "events")))
    cols = ["conv_id", "method", "method_ord", "start_idx", "n_msgs", "messages"]
    want = conversational_samples(t, pair_mode=mode, strategy="conversation").select(cols)
    ranges = sample_ranges(t, pair_mode=mode, hot_turns=hot).withColumn("kept", F.lit(1))
    got = attach_messages(ranges.where("crc32(concat_ws(':', conv_id, method, start_idx, n_msgs)) % 3 > 0"), t, mode)
    want = want.where("crc32(concat_ws(':', conv_id, method, start_idx, n_msgs)) % 3 > 0")
    assert got.columns[-1] == "kept" and got.count() == want.count() > 100
    assert got.select(cols).exceptAll(want).count() == 0


def test_samples_are_equal_only_if_their_messages_are(spark):
    """D1 by digests against D1 by whole texts, on conversations full of repeats."""
    import random

    from turnloom.operators.samples import sample_ranges

    rng = random.Random(12)
    rows = [(c, i, rng.choice(["user", "model"]), rng.choice(["a", "a", "b", "", "user:a"])) for c in range(25) for i in range(rng.randrange(0, 40))]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string")
    every = conversational_samples(t, pairs=(1, 2, 3), dedup=False, strategy="conversation").collect()
    first = {}
    for r in sorted(every, key=lambda r: (r.method_ord, r.start_idx, r.n_msgs)):
        first.setdefault((r.conv_id, tuple(map(tuple, r.messages))), (r.conv_id, r.method, r.start_idx, r.n_msgs))
    for got in (sample_ranges(t, (1, 2, 3), strategy="conversation"), sample_ranges(t, (1, 2, 3), strategy="spread"), conversational_samples(t, (1, 2, 3))):
        assert sorted((r.conv_id, r.method, r.start_idx, r.n_msgs) for r in got.collect()) == sorted(first.values())
    assert len(first) < len(every)


def test_auto_routes_hot_conversations(spark):
    from .conftest import SF
    from turnloom.plans.adapters import events_as_dialogue, table

    t = fill_blank(events_as_dialogue(table(spark, SF["0.001"], "events")))
    cols = ["conv_id", "method", "start_idx", "n_msgs", "messages"]
    a = conversational_samples(t, strategy="conversation").select(cols)
    b = conversational_samples(t, hot_turns=60).select(cols)  # some users exceed 60 turns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_instruct_pairs_spread_equals_window(spark):
    from .conftest import SF
    from turnloom.plans.adapters import events_as_dialogue, table
    from turnloom.operators import spread

    t = drop_blank(events_as_dialogue(table(spark, SF["0.001"], "events")))
    a = instruct_from_dialogue(t, strategy="conversation")
    old = spread.BLOCK_TURNS
    spread.BLOCK_TURNS = 4
    try:
        b = instruct_from_dialogue(t, strategy="spread")
        c = instruct_from_dialogue(t, hot_turns=50)
        assert a.count() == 140
        for x in (b, c):
            assert a.exceptAll(x).count() == 0 and x.exceptAll(a).count() == 0
    finally:
        spread.BLOCK_TURNS = old


def test_strided_and_runs_spread_equal(spark):
    from .conftest import SF
    from turnloom.plans.adapters import events_as_dialogue, table
    from turnloom.operators.spread import spread_strided
    from turnloom.operators.sequence import role_runs

    t = fill_blank(events_as_dialogue(table(spark, SF["0.001"], "events")))
    cols = ["conv_id", "method", "method_ord", "start_idx", "n_msgs", "messages"]
    for sizes, ov in (((4, 8, 16), 2), ((5,), 2), ((3, 0, 6), 1)):
        for dd in (True, False):
            a = strided_windows(t, sizes, ov, dd, strategy="conversation").select(cols)
            b = spread_strided(t, sizes, ov, dd, block_size=5).select(cols)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    r1 = role_runs(t).select("conv_id", "turn", "is_head", "rid")
    r2 = role_runs(t, strategy="spread").select("conv_id", "turn", "is_head", "rid")
    assert r1.exceptAll(r2).count() == 0 and r2.exceptAll(r1).count() == 0


@pytest.mark.parametrize("sizes,overlap", [((4, 8, 16), 2), ((5,), 2), ((3, 0, 6), 1), ((7, 2, -1), 5)])
def test_strided_windows_brute_force(spark, sizes, overlap):
    """W8 against a direct statement of the rule on the merged lists of a small fixture."""
    from .conftest import SF
    from turnloom.plans.adapters import events_as_dialogue, table

    t = fill_blank(events_as_dialogue(table(spark, SF["0.001"], "events")))
    merged = {}
    for r in merged_turns(t).collect():
        merged.setdefault(r.conv_id, []).append((r.idx, r.role, r.content))
    expected = set()
    for conv, rows in merged.items():
        msgs = [(role, content) for _, role, content in sorted(rows)]
        msgs = msgs[: len(msgs) - len(msgs) % 2]
        cands = [("prefix", 0, i) for i in range(2, len(msgs) + 1, 2)]
        for size in sizes:
            if size > 0:
                step = max(2, size - overlap)
                cands += [(f"stride{size}", s, size) for s in range(0, len(msgs) - size + 1, step) if msgs[s + size - 1][0] == "model"]
        seen = set()
        for method, start, n in cands:
            body = tuple(msgs[start:start + n]) if method != "prefix" else tuple(msgs[:n])
            if body not in seen:
                seen.add(body)
                expected.add((conv, method, 0 if method == "prefix" else start, n))
    got = {(r.conv_id, r.method, r.start_idx, r.n_msgs) for r in strided_windows(t, sizes, overlap).collect()}
    assert got == expected


def test_null_conversation_ids_are_one_conversation_in_every_plan(spark):
    from turnloom.operators import samples as sm

    rows = [(None, 0, "user", "a"), (None, 1, "model", "b"), (None, 2, "user", "c"), (None, 3, "model", "d"), ("x", 0, "user", "e"), ("x", 1, "model", "f")]
    turns = spark.createDataFrame(rows, "conv_id string, turn long, role string, content string")
    ops = {
        "samples": lambda **k: sm.sample_report(sm.conversational_samples(turns, pairs=(1, 2), **k)),
        "strided": lambda **k: sm.sample_report(sm.strided_windows(turns, (4,), 2, **k)),
        "pairs": lambda **k: sm.sample_report(sm.block_pairs(turns, **k)),
        "raw": lambda **k: sm.sample_report(sm.block_pairs(turns, "raw", **k)),
        "prefixes": lambda **k: sm.sample_report(sm.expanding_history(turns, **k)),
        "windows": lambda **k: sm.sample_report(sm.pair_windows(turns, (1, 2), **k)),
        "runs": lambda **k: role_runs(turns, **k).select("conv_id", "turn", "rid", "is_head"),
        "instruct": lambda **k: instruct_from_dialogue(turns, **k),
    }
    for name, op in ops.items():
        want = sorted(map(str, op(strategy="conversation").collect()))
        assert want and any("None" in w for w in want), name
        assert sorted(map(str, op(strategy="spread").collect())) == want, name
        assert sorted(map(str, op(strategy="auto", hot_turns=2).collect())) == want, name
        assert sorted(map(str, op(strategy="auto", hot_turns=0).collect())) == want, name
