"""Restart sessions: blocked numbering, retention per session, and the stream against both."""

import random

import pytest
from pyspark.sql import functions as F

from turnloom.operators.sessions import best_k_final_sessions, best_k_sessions, with_sessions


def runs(seed, n_runs=4, n=60):
    """``(run, arrival, at, step, loss)`` of trainings that restart now and then."""
    rng = random.Random(seed)
    rows = []
    for run in [*range(n_runs), None]:
        step = 0
        for i in range(n):
            step = rng.randrange(1, max(2, step)) if rng.random() < 0.12 else step + rng.randrange(0 if rng.random() < 0.1 else 1, 9)
            loss = rng.choice([None, float("nan"), 0.5, 0.25, round(rng.random(), 2), round(rng.random(), 2), round(rng.random(), 2)])
            rows.append((run, i + 1, 1_700_000_000 + i * 600 + rng.randrange(500), step, loss))
    return rows


def naive(rows, k):
    """A plain walk in order of arrival: sessions, decisions, prunes and what is left."""
    out, left = [], []
    for run in {r[0] for r in rows}:
        session, last, held = 1, None, []
        done = []
        for _, _, _, step, loss in sorted((r for r in rows if r[0] == run), key=lambda r: r[1]):
            if last is not None and step <= last:
                session, held = session + 1, []
            last = step
            if loss is None or loss != loss:
                continue
            row = [run, session, step, loss, len(held) < k or loss < held[-1][0], None]
            done.append(row)
            if row[4]:
                if len(held) == k:
                    held.pop()[2][5] = step
                held.append((loss, step, row))
                held.sort(key=lambda x: x[:2])
        out += done
        left += [(r[0], r[1], r[2]) for r in done if r[4] and r[5] is None]
    return sorted(map(tuple, out), key=str), sorted(left, key=str)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "run_id long, arrival long, at long, step long, eval_loss double")
    return df.withColumn("at", F.timestamp_seconds("at"))


@pytest.mark.parametrize("block,k", [(3, 1), (7, 2), (1 << 16, 3)])
def test_sessions_against_a_walk(spark, block, k):
    rows = runs(block)
    want, left = naive(rows, k)
    ev = with_sessions(frame(spark, rows), block_size=block)
    got = best_k_sessions(ev, k, block).select("run_id", "session", "step", "eval_loss", "saved", "pruned_at_step").collect()
    assert sorted(map(tuple, got), key=str) == want and max(w[1] for w in want) > 3
    got = best_k_final_sessions(ev, k, block).select("run_id", "session", "step").collect()
    assert sorted(map(tuple, got), key=str) == left


def test_no_window_over_a_whole_run(spark):
    p = with_sessions(frame(spark, runs(1, 1, 5)))._jdf.queryExecution().executedPlan().toString()
    for line in p.splitlines():
        if "Window [" in line:
            assert "_blk" in line


@pytest.mark.parametrize("k", [1, 2])
def test_stream_equals_the_walk(spark, k):
    from turnloom.streaming.session_best_k import replay_sessions

    rows = [r for r in runs(30 + k, 3, 40) if r[0] is not None]
    want, _ = naive(rows, k)
    by_prune = {(w[0], w[1], w[5]): w[2] for w in want if w[5] is not None}
    got = replay_sessions(spark, frame(spark, rows).drop("arrival"), k, drops=3).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((w[0], w[1], w[2], w[3], w[4], by_prune.get((w[0], w[1], w[2])) if w[4] else None) for w in want), key=str)


def _stream(spark, batches, k=2, delay="2 hours", idle=None, initial=None):
    """Any rows in any micro-batches, each a file drop; the decisions and the state left."""
    import tempfile

    from turnloom.streaming import session_best_k as S

    mine = spark.newSession()
    mine.conf.set(S.PROVIDER_CONF, S.ROCKSDB)
    mine.conf.set("spark.sql.shuffle.partitions", "2")
    base = tempfile.mkdtemp(prefix="turnloom-sessions-")
    for rows in batches:
        df = frame(spark, rows).drop("arrival")
        df.write.mode("append").parquet(f"{base}/in")
        start = None if initial is None else mine.createDataFrame([tuple(r) for r in initial.collect()], initial.schema)
        got = S.session_best_k_stream(mine.readStream.schema(df.schema).parquet(f"{base}/in"), k, delay, idle, start)
        got.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start().awaitTermination()
    state = mine.read.format("statestore").option("stateVarName", "clock").load(f"{base}/chk").count()
    return sorted(map(tuple, spark.read.schema(got.schema).parquet(f"{base}/out").collect()), key=str), state


def test_arrival_shuffled_inside_the_watermark(spark):
    rows = [r for r in runs(77, 2, 30) if r[0] is not None]
    far = [(None, 1, 1_800_000_000, 0, None)]
    rng = random.Random(3)
    late = sorted(rows, key=lambda r: r[2] + rng.randrange(7000))  # up to two hours late
    cut = len(late) // 3
    ordered, n_kept = _stream(spark, [sorted(rows, key=lambda r: r[2]), far])
    shuffled, _ = _stream(spark, [late[:cut], late[cut : 2 * cut], late[2 * cut :], far])
    assert shuffled == ordered and len(ordered) == len(naive(rows, 2)[0])
    assert n_kept >= 2


def test_finished_runs_leave_no_state(spark):
    rows = [r for r in runs(5, 3, 10) if r[0] is not None]
    far = [(None, 1, 1_800_000_000, 0, None)]
    later = [(None, 2, 1_900_000_000, 1, None)]
    got, n_state = _stream(spark, [rows, far, later], idle="1 day")
    assert len(got) == len(naive(rows, 2)[0]) and n_state <= 1  # the far row's own


def test_initial_state_from_a_batch_job(spark):
    schema = "run_id long, session long, step long, eval_loss double, last_step long, at timestamp"
    initial = spark.sql("SELECT * FROM VALUES (1L, 4L, 10L, 0.3D, 30L, timestamp_seconds(1700000000)), (1L, 4L, 20L, 0.4D, 30L, timestamp_seconds(1700000000)) AS t(run_id, session, step, eval_loss, last_step, at)")
    assert initial.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    rows = [(1, 1, 1_700_001_000, 40, 0.5), (1, 2, 1_700_002_000, 50, 0.35), (1, 3, 1_700_003_000, 45, 0.9)]
    got, _ = _stream(spark, [rows, [(None, 1, 1_800_000_000, 0, None)]], initial=initial)
    assert got == [(1, 4, 40, 0.5, False, None), (1, 4, 50, 0.35, True, 20), (1, 5, 45, 0.9, True, None)]


def test_state_calls_are_not_paid_per_event(spark, monkeypatch):
    """Many runs: what waits is a few frames, and ids near one another stay apart beside a NULL."""
    import tempfile

    from turnloom.streaming import session_best_k as S

    monkeypatch.setattr(S, "BUCKETS", 4, raising=False)
    rows = [(2**53 + i, 1, 1_700_000_000 + 60 * j, j, 1.0 - j / 10) for i in range(60) for j in range(5)]
    got, n_state = _stream(spark, [rows + [(None, 1, 1_700_000_000, 1, 0.5)], [(None, 2, 1_800_000_000, 0, None)]])
    by_prune = {(w[0], w[1], w[5]): w[2] for w in naive(rows, 2)[0] if w[5] is not None}
    want = [(w[0], w[1], w[2], w[3], w[4], by_prune.get((w[0], w[1], w[2])) if w[4] else None) for w in naive(rows, 2)[0]]
    assert got == sorted([*want, (None, 1, 1, 0.5, True, None)], key=str) and n_state == 61

    mine = spark.newSession()
    mine.conf.set(S.PROVIDER_CONF, S.ROCKSDB)
    mine.conf.set("spark.sql.shuffle.partitions", "2")
    base = tempfile.mkdtemp(prefix="turnloom-sessions-")
    df = frame(spark, rows).drop("arrival")
    df.coalesce(1).write.parquet(f"{base}/in")
    q = S.session_best_k_stream(mine.readStream.schema(df.schema).parquet(f"{base}/in"), 2, "2 hours")
    q.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start().awaitTermination()
    assert mine.read.format("statestore").option("stateVarName", "clock").load(f"{base}/chk").count() == 0
    state = mine.read.format("statestore").option("stateVarName", "waiting").option("flattenCollectionTypes", "true").load(f"{base}/chk")
    assert 0 < state.count() <= 4
