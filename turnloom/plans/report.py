"""Run report: trainer logs and artifact folders of many runs in one table
(S9 -> M7 -> M6, M3; S10 -> M5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import checkpoints as ck
from ..session import null_safe_join
from ..sources.runlogs import artifacts_of, list_markers, read_run_logs, run_of


def run_report(metrics: DataFrame, artifacts: DataFrame, k: int = 2) -> DataFrame:
    """One row per run that logged an evaluation: its listing, the steps best-k keeps (best
    first) and the artifact to use (NULL if it has none). The artifact's root is the run id."""
    evals = ck.eval_log(metrics).select("run_id", "step", F.col("value").alias("eval_loss"))
    kept = ck.best_k_final(evals, k).groupBy("run_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "step"))), lambda x: x["step"]), ",").alias("best_steps"))
    chosen = ck.resolve_artifact(artifacts).select(F.col("root").alias("run_id"), F.col("path").alias("artifact"))
    return null_safe_join(null_safe_join(ck.runs(evals), kept, ["run_id"], "left"), chosen, ["run_id"], "left")


def report_folder(spark: SparkSession, root: str, k: int = 2) -> DataFrame:
    """The report of the runs under a folder, with the number of trainer state files that
    could not be read (``n_unreadable``; a run of which none could has only that); a run
    without any artifact is an error."""
    metrics, quarantine = read_run_logs(spark, root)
    roots = metrics.select(F.col("run_id").alias("root")).distinct()
    artifacts = ck.require_artifact(artifacts_of(list_markers(spark, root), roots), roots)
    unreadable = quarantine.groupBy(run_of(F.col("path")).alias("run_id")).agg(F.count(F.lit(1)).alias("n_unreadable"))
    report = run_report(metrics, artifacts, k).join(unreadable, "run_id", "full")
    return report.withColumn("n_unreadable", F.coalesce("n_unreadable", F.lit(0)))
