"""ST1: best-k checkpoint retention as a stateful Structured Streaming operator.

Keyed by run (and, for resumed trainings, by session: the retained list starts
empty in every process). State per key = the retained ``(loss, step)`` list, at
most k entries, so state size is bounded whatever the stream length. Output is
append-only: one decision row per evaluation event with the steps it prunes.

Within a micro-batch a key's rows may come in several Arrow frames in any order: steps
and losses are gathered and taken in step order, without a loop over events. Across micro-batches, arrival
order is processing order (as for the live callback).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import ensure_checkpoint_dir, null_safe_join, ship_by_value

STATE_SCHEMA = T.StructType([
    T.StructField("losses", T.ArrayType(T.DoubleType())),
    T.StructField("steps", T.ArrayType(T.LongType())),
])


def _best_so_far(rank: np.ndarray, k: int) -> np.ndarray:
    """[t, i]: the (t+1)-th smallest of ``rank[:i]``; ``len(rank)`` while there are fewer.
    The next smallest of a prefix is the running minimum of max(value, previous level)."""
    none = len(rank)
    out, value = np.full((k, len(rank)), none), rank
    for t in range(k):
        out[t, 1:] = np.minimum.accumulate(value)[:-1]
        value = np.maximum(value, out[t])
    return out


def best_k_processor(keys: Sequence[str], k: int):
    """The rule of M1 and M2 over one key's micro-batch: the retained list comes first, as
    events already seen; an event is saved iff it ranks before the k-th best so far by
    (loss, order of arrival), and then takes that one's place."""

    def fn(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held_loss, held_step = (np.array(x, t) for x, t in zip(state.get if state.exists else ([], []), (float, np.int64)))
        parts = [(f["step"].to_numpy(np.int64), f["eval_loss"].to_numpy(float)) for f in frames]
        step, loss = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        known = ~np.isnan(loss)
        order = np.argsort(step[known], kind="stable")
        n_held = len(held_loss)
        loss = np.concatenate([held_loss, loss[known][order]])
        step = np.concatenate([held_step, step[known][order]])
        by_loss = np.argsort(loss, kind="stable")  # ties: the earlier one first
        rank = np.empty(len(loss), np.int64)
        rank[by_loss] = np.arange(len(loss))
        kth = _best_so_far(rank, k)[k - 1][n_held:] if len(loss) else np.zeros(0, np.int64)
        saved = rank[n_held:] < kth
        out = saved & (kth < len(loss))
        pruned = [[int(step[by_loss[r]])] if o else [] for r, o in zip(kth.tolist(), out.tolist())]
        best = by_loss[:k]
        state.update((loss[best].tolist(), step[best].tolist()))
        data = {c: [v] * len(saved) for c, v in zip(keys, key)}
        yield pd.DataFrame(data | {"step": step[n_held:], "eval_loss": loss[n_held:], "saved": saved, "pruned_steps": pruned})

    return fn


def best_k_stream(events: DataFrame, k: int = 2, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Streaming events ``(keys..., step, eval_loss)`` -> decisions with pruned steps.

    A batch DataFrame gets the same output from the relational operators (M1+M2),
    which split large runs into blocks instead of holding a run in one group.
    """
    if not events.isStreaming:
        return _batch_equivalent(events, k, list(keys))
    key_fields = [events.schema[c] for c in keys]
    out = T.StructType(
        [T.StructField(f.name, f.dataType) for f in key_fields]
        + [
            T.StructField("step", T.LongType()),
            T.StructField("eval_loss", T.DoubleType()),
            T.StructField("saved", T.BooleanType()),
            T.StructField("pruned_steps", T.ArrayType(T.LongType())),
        ]
    )
    ship_by_value(__name__)
    return events.groupBy(*keys).applyInPandasWithState(
        best_k_processor(list(keys), k), out, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


def _batch_equivalent(events: DataFrame, k: int, keys: list[str]) -> DataFrame:
    from ..operators.checkpoints import best_k_decisions, best_k_prunes

    ev = events
    if keys != ["run_id"]:
        ev = events.withColumn("run_id", F.struct(*keys))
    dec = best_k_decisions(ev, k).select("run_id", "step", "eval_loss", "saved")
    pr = (
        best_k_prunes(ev, k)
        .where(F.col("pruned_at_step").isNotNull())
        .groupBy("run_id", F.col("pruned_at_step").alias("step"))
        .agg(F.array_sort(F.collect_list(F.col("step").cast("long"))).alias("pruned_steps"))
    )
    out = null_safe_join(dec, pr, ["run_id", "step"], "left").withColumn(
        "pruned_steps", F.coalesce("pruned_steps", F.array().cast("array<bigint>"))
    )
    if keys != ["run_id"]:
        out = out.select(*[F.col("run_id")[c].alias(c) for c in keys], "step", "eval_loss", "saved", "pruned_steps")
    return out


def replay_best_k(spark: SparkSession, events: DataFrame, k: int = 2, batches: int = 4) -> DataFrame:
    """Feed a finished event table through the stream as ``batches`` step-ordered file
    drops (one micro-batch each, ``availableNow``) and return the decisions.

    Inputs, outputs and the stream checkpoint live under the shared
    ``spark.checkpoint.dir``, so a restarted query resumes from its commit log.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/best-k-stream-{uuid.uuid4().hex}"
    src, sink, chk = f"{base}/in", f"{base}/out", f"{base}/chk"
    ev = events.select(F.col("run_id"), F.col("step").cast("long"), F.col("eval_loss").cast("double"))
    qs = ev.approxQuantile("step", [i / batches for i in range(1, batches)], 0.001)
    bounds = [-math.inf, *qs, math.inf]
    for lo, hi in zip(bounds, bounds[1:]):
        part = ev.where((F.col("step") > F.lit(lo)) & (F.col("step") <= F.lit(hi))) if lo != hi else None
        if part is not None:
            # a run's rows of one drop sit in one file, so file order keeps step order per run
            part.repartition("run_id").write.mode("append").parquet(src)
    per_trigger = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", per_trigger).parquet(src)
    q = (
        best_k_stream(stream, k)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", chk)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.parquet(sink).select("run_id", "step", "eval_loss", "saved", "pruned_steps")
