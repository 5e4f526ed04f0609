"""M1-M8 and ST1 (FIXTURES §3 #31-#35, replay of the stream against the batch rule)."""

import pytest

from turnloom.operators import checkpoints as ck
from turnloom.plans.adapters import eval_events, table
from turnloom.streaming.best_k import best_k_stream, replay_best_k

from .conftest import SF


def ev(spark, losses, run="r"):
    return spark.createDataFrame([(run, i + 1, v) for i, v in enumerate(losses)], "run_id string, step long, eval_loss double")


def naive(losses, k):
    """Closed form: i is saved iff fewer than k earlier losses are at most its own; it is
    pruned at the first later step by which k losses rank before it."""
    n = len(losses)
    before = lambda i, upto: sum(losses[j] <= losses[i] if j < i else losses[j] < losses[i] for j in range(upto) if j != i)
    saved = [before(i, i) < k for i in range(n)]
    pruned = {i + 1: s for i in range(n) if saved[i] for s in [next((u for u in range(i + 2, n + 1) if before(i, u) >= k), None)] if s}
    return saved, pruned, [i + 1 for i in range(n) if before(i, n) < k]


@pytest.mark.parametrize("losses,saved,pruned,final", [
    ([0.5, 0.5, 0.5, 0.4], [True, True, False, True], {2: 4}, [1, 4]),
    ([0.9, 0.7, 0.8, 0.95], [True, True, True, False], {1: 3}, [2, 3]),
])
def test_hand_cases(spark, losses, saved, pruned, final):
    d = ck.best_k_decisions(ev(spark, losses), 2).orderBy("step").collect()
    assert [r.saved for r in d] == saved
    p = {r.step: r.pruned_at_step for r in ck.best_k_prunes(ev(spark, losses), 2).collect() if r.pruned_at_step}
    assert p == pruned
    assert sorted(r.step for r in ck.best_k_final(ev(spark, losses), 2).collect()) == final


@pytest.mark.parametrize("block", [1, 2, 3, 1 << 16])
@pytest.mark.parametrize("k", [1, 2, 3])
def test_blocked_equals_naive(spark, block, k):
    import random

    rng = random.Random(k * 100 + block)
    losses = [round(rng.choice([rng.random(), 0.5, 0.25]), 2) for _ in range(40)]
    saved, pruned, final = naive(losses, k)
    d = ck.best_k_decisions(ev(spark, losses), k, block).orderBy("step").collect()
    assert [r.saved for r in d] == saved
    p = {r.step: r.pruned_at_step for r in ck.best_k_prunes(ev(spark, losses), k, block).collect() if r.pruned_at_step}
    assert p == pruned
    assert sorted(r.step for r in ck.best_k_final(ev(spark, losses), k, block).collect()) == final


def test_nan_and_null_ignored(spark):
    d = ck.best_k_decisions(ev(spark, [0.5, float("nan"), None, 0.4]), 2).collect()
    assert sorted(r.step for r in d) == [1, 4]


def test_fixture_counts(spark):
    e = eval_events(table(spark, SF["0.001"], "events"))
    assert ck.best_k_decisions(e, 2).where("saved").count() == 138
    assert ck.best_k_final(e, 2).count() == 30
    assert ck.last_n(e, 20, 2).count() == 30


@pytest.mark.parametrize("paths,expected", [
    (["checkpoint-9", "checkpoint-10"], "checkpoint-10"),
    (["checkpoint-9", "checkpoint-10", "final_model"], "final_model"),
    (["best", "checkpoint-x", "checkpoint-1"], "checkpoint-1"),
    (["", "checkpoint-3"], ""),
])
def test_resolve_artifact(spark, paths, expected):
    rows = [("o", "o/" + p if p else "o") for p in paths]
    got = ck.resolve_artifact(spark.createDataFrame(rows, "root string, path string")).first().path
    assert got == ("o/" + expected if expected else "o")


def test_runs_and_select(spark):
    e = ev(spark, [0.9, 0.5, 0.7], "a").unionByName(ev(spark, [0.3], "b"))
    r = {x.run_id: x for x in ck.runs(e).collect()}
    assert (r["a"].n_evals, r["a"].last_loss, r["a"].best_loss) == (3, 0.7, 0.5)
    assert ck.select_run(ck.runs(e), "b").count() == 1
    assert ck.select_run(ck.runs(e), "zzz").count() == 2


def test_stream_batch_mode_equals_rule(spark):
    losses = [0.5, 0.5, 0.5, 0.4, 0.45, 0.3]
    rows = best_k_stream(ev(spark, losses), 2).orderBy("step").collect()
    saved, pruned, _ = naive(losses, 2)
    assert [r.saved for r in rows] == saved
    assert {p: r.step for r in rows for p in r.pruned_steps} == pruned


def test_stream_replay_equals_batch(spark):
    e = eval_events(table(spark, SF["0.001"], "events"))
    s = replay_best_k(spark, e, 2, batches=3).select("run_id", "step", "saved")
    b = ck.best_k_decisions(e, 2).select("run_id", "step", "saved")
    assert s.count() == b.count() and s.exceptAll(b).count() == 0


def test_select_run_by_index(spark):
    e = ev(spark, [0.9], "b").unionByName(ev(spark, [0.3], "a")).unionByName(ev(spark, [0.5], "c"))
    t = ck.runs(e)
    assert [r.run_id for r in ck.select_run(t, index=2).collect()] == ["b"]
    assert ck.select_run(t, index=0).count() == 3 and ck.select_run(t, index=9).count() == 3


def test_stream_two_keys_batch(spark):
    df = spark.createDataFrame(
        [("r", 0, 1, 0.5), ("r", 0, 2, 0.4), ("r", 0, 3, 0.3), ("r", 1, 4, 0.9), ("r", 1, 5, 0.95), ("r", 1, 6, 0.2)],
        "run_id string, session int, step long, eval_loss double",
    )
    rows = best_k_stream(df, 2, keys=("run_id", "session")).orderBy("step").collect()
    # a resumed run (session 1) starts with an empty retained list
    assert [r.saved for r in rows] == [True, True, True, True, True, True]
    assert {r.step: list(r.pruned_steps) for r in rows if r.pruned_steps} == {3: [1], 6: [5]}


def test_null_run_ids_are_a_run(spark):
    losses = [1.0, 2.0, 3.0, 4.0, 5.0, 0.5, 6.0, 7.0]
    e = ev(spark, losses, None)
    saved, pruned, final = naive(losses, 2)
    for block in (2, 1 << 16):
        assert [r.saved for r in ck.best_k_decisions(e, 2, block).orderBy("step").collect()] == saved
        assert {r.step: r.pruned_at_step for r in ck.best_k_prunes(e, 2, block).collect() if r.pruned_at_step} == pruned
        assert sorted(r.step for r in ck.best_k_final(e, 2, block).collect()) == final


def test_stream_prunes_equal_batch(spark):
    e = eval_events(table(spark, SF["0.001"], "events"))
    s = replay_best_k(spark, e, 2, batches=4)
    b = best_k_stream(e, 2).select(s.columns)
    assert s.where("size(pruned_steps) > 0").count() > 0 and s.exceptAll(b).count() == 0 and s.count() == b.count()


def test_missing_artifact_is_an_error(spark):
    roots = spark.createDataFrame([("a",), ("b",)], "root string")
    arts = spark.createDataFrame([("a", "a/checkpoint-1")], "root string, path string")
    with pytest.raises(FileNotFoundError, match="b"):
        ck.require_artifact(arts, roots)
    assert ck.require_artifact(arts, roots.limit(1).where("root = 'a'")).count() == 1
