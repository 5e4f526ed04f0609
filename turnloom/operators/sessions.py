"""M1-M3 over restarted trainings.

A training that is started again from a checkpoint begins with an empty list of retained
checkpoints, and its steps go back. In order of arrival, an event whose step is not above
the step before it opens the next session of its run; the retention rule then holds in
each ``(run, session)``.

Sessions are numbered without a window over a whole run: in blocks of arrivals, with the
first and last step and the restarts of each block carried over one row per block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import null_safe_join
from .checkpoints import BLOCK_SIZE, best_k_decisions, best_k_final, best_k_prunes


def with_sessions(events: DataFrame, arrival: str = "arrival", block_size: int = BLOCK_SIZE) -> DataFrame:
    """``events (run_id, <arrival>, step, ...)`` plus ``session`` (from 1). ``arrival`` numbers
    a run's events in the order in which they came; events without a loss count, too. A
    NULL step opens no session; a NULL run id is a run."""
    t = events.withColumn("_blk", F.floor(F.col(arrival) / F.lit(block_size))).repartition("run_id", "_blk")
    w = Window.partitionBy("run_id", "_blk").orderBy(arrival)
    t = t.withColumn("_restart", F.coalesce((F.col("step") <= F.lag("step").over(w)).cast("long"), F.lit(0)))
    t = t.withColumn("_upto", F.sum("_restart").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = t.groupBy("run_id", "_blk").agg(F.min_by("step", arrival).alias("_first"), F.max_by("step", arrival).alias("_last"), F.sum("_restart").alias("_n"))
    over = Window.partitionBy("run_id").orderBy("_blk")
    blocks = blocks.withColumn("_edge", F.coalesce((F.col("_first") <= F.lag("_last").over(over)).cast("long"), F.lit(0)))
    before = F.coalesce(F.sum(F.col("_edge") + F.col("_n")).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("run_id", "_blk", (before + F.col("_edge") + 1).alias("_from"))
    j = null_safe_join(t, blocks, ["run_id", "_blk"])
    return j.withColumn("session", F.col("_from") + F.col("_upto")).select(*events.columns, "session")


def _by_session(events: DataFrame) -> DataFrame:
    return events.select(F.struct("run_id", "session").alias("run_id"), "step", "eval_loss")


def _open_key(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "run_id"]
    return df.select(F.col("run_id.run_id").alias("run_id"), F.col("run_id.session").alias("session"), *rest)


def best_k_sessions(events: DataFrame, k: int = 2, block_size: int = BLOCK_SIZE) -> DataFrame:
    """M1+M2 for ``events (run_id, session, step, eval_loss)``: every event with a loss, whether
    it is saved, and the step of its session at which it is pruned (NULL: not)."""
    keyed = _by_session(events)
    decided = best_k_decisions(keyed, k, block_size).select("run_id", "step", "eval_loss", "saved")
    pruned = best_k_prunes(keyed, k, block_size).select("run_id", "step", "pruned_at_step")
    return _open_key(null_safe_join(decided, pruned, ["run_id", "step"], "left"))


def best_k_final_sessions(events: DataFrame, k: int = 2, block_size: int = BLOCK_SIZE) -> DataFrame:
    """M3: what each session leaves on disk."""
    return _open_key(best_k_final(_by_session(events), k, block_size))
