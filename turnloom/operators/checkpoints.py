"""M1-M8: checkpoint retention and run analytics over evaluation events.

Events are ``(run_id, step, eval_loss)``. Events without a loss (NULL/NaN) are
ignored (a retained NaN could never be displaced in the reference; Spark would
order it last, so it is filtered first).

Best-k in relational form. In step order, event i is saved iff fewer than k
earlier events have ``loss <= loss_i``; equivalently iff ``(loss_i, step_i)`` is
below the k-th smallest ``(loss, step)`` of the events before it.

The running "t-th smallest so far" is computed with plain running ``min``
windows: the (t+1)-th smallest of a prefix is the minimum over its elements c of
``greatest(v_c, t-th smallest before c)``; k rounds give the k smallest. To keep
one huge run from landing in one task, runs are cut into blocks of
``block_size`` steps: the rounds run per (run, block); the k smallest of each
block (at most k rows per block) are carried across blocks with the same rounds
over the block summaries, and joined back on (run, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import null_safe_join, shared_table

BLOCK_SIZE = 1 << 16
_VS = "struct<loss:double,step:bigint>"


def clean_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("eval_loss").isNotNull() & ~F.isnan("eval_loss"))


def _prefix_smallest(df: DataFrame, part: list[str], order: list[str], k: int, v: str, prefix: str) -> tuple[DataFrame, list[str]]:
    """Columns ``{prefix}1..k``: the t-th smallest ``v`` among rows strictly before each row."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cols = [f"{prefix}1"]
    df = df.withColumn(cols[0], F.min(v).over(w))
    for t in range(1, k):
        prev = F.col(cols[-1])
        cand = F.when(prev.isNotNull(), F.greatest(F.col(v), prev))
        df = df.withColumn(f"_{prefix}w", cand).withColumn(f"{prefix}{t + 1}", F.min(f"_{prefix}w").over(w)).drop(f"_{prefix}w")
        cols.append(f"{prefix}{t + 1}")
    return df, cols


def _nonnull_sorted(arr: Column) -> Column:
    return F.array_sort(F.filter(arr, lambda x: x.isNotNull()))


def best_k_decisions(events: DataFrame, k: int = 2, block_size: int = BLOCK_SIZE) -> DataFrame:
    """M1: ``(run_id, step, eval_loss, saved, kth_after)`` for every event with a loss.

    ``kth_after`` is the k-th smallest ``(loss, step)`` including this event (NULL
    while fewer than k events were seen); it drives the prune log.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    ev = clean_events(events).select(
        "run_id",
        "step",
        "eval_loss",
        F.struct(F.col("eval_loss").alias("loss"), F.col("step").cast("long").alias("step")).alias("v"),
        F.floor(F.col("step") / F.lit(block_size)).alias("block"),
    )
    # hash on (run, block) explicitly: input clustered by run alone would satisfy the
    # window and put a huge run back into one task
    ev = ev.repartition("run_id", "block")
    ev, e_cols = _prefix_smallest(ev, ["run_id", "block"], ["step"], k, "v", "_e")
    ev = ev.withColumn("_inblock", F.array(*e_cols)).drop(*e_cols)
    incl = F.slice(_nonnull_sorted(F.concat("_inblock", F.array("v"))), 1, k)
    summary = ev.groupBy("run_id", "block").agg(F.max_by(incl, F.col("step")).alias("_topk"))
    s = summary.select("run_id", "block", F.explode("_topk").alias("v"))
    s, c_cols = _prefix_smallest(s, ["run_id"], ["block", "v"], k, "v", "_c")
    carried = s.groupBy("run_id", "block").agg(F.min_by(F.array(*c_cols), F.col("v")).alias("_carried"))
    j = null_safe_join(ev, carried, ["run_id", "block"], "left")
    before = _nonnull_sorted(F.concat("_inblock", F.coalesce("_carried", F.array().cast(f"array<{_VS}>"))))
    kth_before = F.get(before, k - 1)
    kth_after = F.get(F.array_sort(F.concat(F.slice(before, 1, k), F.array("v"))), k - 1)
    return j.select(
        "run_id",
        "step",
        "eval_loss",
        (kth_before.isNull() | (F.col("v") < kth_before)).alias("saved"),
        kth_after.alias("kth_after"),
    )


def best_k_prunes(events: DataFrame, k: int = 2, block_size: int = BLOCK_SIZE) -> DataFrame:
    """M2: saved checkpoints with ``pruned_at_step``: the first later event after which
    k retained rows rank before it by (loss, step) (ties keep the earlier step).
    NULL = still retained at the end.

    ``kth_after`` (k-th smallest (loss, step) so far) never increases, so the prune
    step of c is the first step whose ``kth_after`` is below c. Search per block:
    (1) inside c's own block, a running ``min`` over the union of (kth_after, step)
    points and (loss, step) probes; (2) only checkpoints still retained at the end
    of their block (at most k per block) search later blocks, first over block
    minima (one row per block), then inside the one block found.
    """
    # four branches read the decisions: worked out once
    dec = best_k_decisions(events, k, block_size).withColumn("block", F.floor(F.col("step") / F.lit(block_size)))
    dec = shared_table(dec, "best-k-decisions")
    v = F.struct(F.col("eval_loss").alias("loss"), F.col("step").cast("long").alias("step"))
    points = dec.where(F.col("kth_after").isNotNull()).select(
        "run_id", "block", F.col("kth_after").alias("val"), F.lit(1).alias("kind"), F.col("step").alias("pstep"),
        F.lit(None).cast("long").alias("qstep"), F.lit(None).cast("double").alias("eval_loss"),
    )
    probes = dec.where("saved").select(
        "run_id", "block", v.alias("val"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("pstep"),
        F.col("step").cast("long").alias("qstep"), "eval_loss",
    )
    w = Window.partitionBy("run_id", "block").orderBy("val", "kind").rowsBetween(Window.unboundedPreceding, -1)
    local = (
        points.unionByName(probes)
        .withColumn("in_block", F.min("pstep").over(w))
        .where(F.col("kind") == 0)
        .select("run_id", "block", "val", F.col("qstep").alias("step"), "eval_loss", "in_block")
    )
    open_ = local.where(F.col("in_block").isNull())
    minima = dec.where(F.col("kth_after").isNotNull()).groupBy("run_id", "block").agg(F.min("kth_after").alias("val"))
    ws = Window.partitionBy("run_id").orderBy("val", "kind").rowsBetween(Window.unboundedPreceding, -1)
    target = (
        minima.select("run_id", "val", F.lit(1).alias("kind"), F.col("block").alias("tblock"), F.lit(None).cast("long").alias("step"))
        .unionByName(open_.select("run_id", "val", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("tblock"), "step"))
        .withColumn("target", F.min("tblock").over(ws))
        .where((F.col("kind") == 0) & F.col("target").isNotNull())
        .select("run_id", "step", "val", F.col("target").alias("block"))
    )
    later = (
        null_safe_join(target, dec.select("run_id", "block", F.col("step").alias("s"), "kth_after"), ["run_id", "block"])
        .where(F.col("kth_after") < F.col("val"))
        .groupBy("run_id", "step")
        .agg(F.min("s").alias("later"))
    )
    return null_safe_join(local, later, ["run_id", "step"], "left").select(
        "run_id", "step", "eval_loss", F.coalesce("in_block", "later").alias("pruned_at_step")
    )


def _top_n(df: DataFrame, n: int, order: list[Column], block_size: int, block_col: str = "step") -> DataFrame:
    """Per-run top-n in two levels: per (run, block) then over the <= n-per-block survivors."""
    blk = F.floor(F.col(block_col) / F.lit(block_size))
    # dealt by (run, block): input clustered by run alone would keep a huge run in one task
    cand = df.withColumn("_b", blk).repartition("run_id", "_b").withColumn("_r", F.row_number().over(Window.partitionBy("run_id", "_b").orderBy(*order))).where(F.col("_r") <= n)
    w2 = Window.partitionBy("run_id").orderBy(*order)
    return cand.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= n).drop("_b", "_r")


def best_k_final(events: DataFrame, k: int = 2, block_size: int = BLOCK_SIZE) -> DataFrame:
    """M3: the k retained checkpoints at the end: k smallest by (loss, step) per run."""
    return _top_n(clean_events(events).select("run_id", "step", "eval_loss"), k, [F.col("eval_loss"), F.col("step")], block_size)


def last_n(events: DataFrame, every: int, n: int = 2, block_size: int = BLOCK_SIZE) -> DataFrame:
    """M4: without evaluation: a checkpoint every ``every`` steps, the newest ``n`` kept."""
    saves = eval_schedule(events.select("run_id", "step"), every)
    return _top_n(saves, n, [F.col("step").desc()], block_size)


def eval_schedule(events: DataFrame, every: int) -> DataFrame:
    """M8: the steps at which an evaluation (or a save) happens: ``step % every == 0``."""
    if every <= 0:
        raise ValueError("every must be > 0")
    return events.where(F.col("step") % F.lit(every) == 0)


def eval_log(metrics: DataFrame) -> DataFrame:
    """M7: log records that carry ``eval_loss``."""
    return metrics.where(F.col("metric") == "eval_loss")


def runs(events: DataFrame) -> DataFrame:
    """M6: one row per run (partial aggregation; a huge run is pre-aggregated map-side)."""
    ev = clean_events(events)
    return ev.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_evals"),
        F.min("step").alias("first_step"),
        F.max("step").alias("last_step"),
        F.max_by("eval_loss", "step").alias("last_loss"),
        F.min("eval_loss").alias("best_loss"),
    )


def select_run(run_table: DataFrame, run_id=None, index: int | None = None) -> DataFrame:
    """M6: one run, chosen by id or by its 1-based position in the listing (runs in
    name order; 0 = all); no choice or an invalid one gives all runs."""
    if index is not None:
        if index <= 0:
            return run_table
        pick = run_table.select("run_id").orderBy("run_id").limit(index).agg(
            F.count(F.lit(1)).alias("n"), F.max("run_id").alias("run_id")
        ).first()
        if pick is None or pick["n"] < index:
            return run_table
        run_id = pick["run_id"]
    if run_id is None:
        return run_table
    one = run_table.where(F.col("run_id") == F.lit(run_id))
    return run_table if one.isEmpty() else one


def artifact_step(path: Column) -> Column:
    """Number after the last ``checkpoint-`` in the path; -1 when it does not parse."""
    return F.coalesce(_try_long(F.trim(F.substring_index(path, "checkpoint-", -1))), F.lit(-1).cast("long"))


def _try_long(c: Column) -> Column:
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("long"))


def require_artifact(artifacts: DataFrame, roots: DataFrame) -> DataFrame:
    """M5: ``artifacts``, or an error if one of ``roots (root)`` has no candidate."""
    missing = [r.root for r in null_safe_join(roots.select("root").distinct(), artifacts.select("root").distinct(), ["root"], "left_anti").limit(10).collect()]
    if missing:
        raise FileNotFoundError(f"no artifact found under: {', '.join(map(str, missing))}")
    return artifacts


def resolve_artifact(artifacts: DataFrame) -> DataFrame:
    """M5: per root: the root itself if it has the marker, else ``final_model``, else the
    highest ``checkpoint-N`` (unparsable -> -1; ties -> smallest path).

    A partial aggregation (``min_by`` over a priority struct) per root.
    """
    prio = (
        F.when(F.col("path") == F.col("root"), F.lit(0))
        .when(F.col("path") == F.concat(F.col("root"), F.lit("/final_model")), F.lit(1))
        .otherwise(F.lit(2))
    )
    step = artifact_step(F.col("path"))
    keyed = artifacts.select("root", "path", prio.alias("prio"), step.alias("step"))
    best = F.struct(F.col("prio"), (-F.col("step")).alias("neg_step"), F.col("path"))
    return keyed.groupBy("root").agg(F.min_by(F.struct("path", "step"), best).alias("a")).select(
        "root", F.col("a.path").alias("path"), F.col("a.step").alias("step")
    )
