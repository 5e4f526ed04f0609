"""Training-run metrics and artifact folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.checkpoints import artifact_step
from .documents import require_paths

# The file that marks an adapter folder, and the trainer state file.
ADAPTER_MARKER = "adapter_config.json"
TRAINER_STATE = "trainer_state.json"
# Larger trainer states are reported, not parsed (a value of Spark's holds 2 GiB).
STATE_LIMIT_BYTES = 1 << 30


def parse_trainer_states(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S9 over ``(path, content)`` rows: ``(metrics, quarantine)``.

    metrics: ``(run_id, checkpoint, step, metric, value)``, numbers of the ``log_history``
    records, NaN and infinities included. Every checkpoint repeats the history before
    it, so a (run, step, metric) is taken from the latest checkpoint, last record.
    ``run_id`` is the folder that holds the checkpoint folder. quarantine:
    ``(path, reason)`` of files that are not JSON or hold no history.
    """
    parsed = files.select(
        "path",
        F.from_json(F.col("content").cast("string"), "log_history array<map<string,string>>", {"allowNonNumericNumbers": "true"})["log_history"].alias("h"),
    )
    quarantine = parsed.where("h IS NULL").select("path", F.lit("no_log_history").alias("reason"))
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    recs = parsed.select(
        F.regexp_extract(folder, r"^(.*)/[^/]+$", 1).alias("run_id"),
        F.regexp_extract(folder, r"([^/]+)$", 1).alias("checkpoint"),
        F.posexplode("h").alias("place", "rec"),
    )
    kv = recs.select(
        "run_id", "checkpoint", "place", F.col("rec")["step"].try_cast("double").cast("long").alias("step"), F.explode("rec").alias("metric", "raw")
    ).where("metric <> 'step'")
    # bare NaN and Infinity come back in quotes
    kv = kv.withColumn("value", F.regexp_replace("raw", r'^"(NaN|-?Infinity)"$', "$1").try_cast("double")).where("value IS NOT NULL")
    latest = F.max_by(F.struct("checkpoint", "value"), F.struct(artifact_step(F.col("checkpoint")), F.col("checkpoint"), F.col("place")))
    one = kv.groupBy("run_id", "step", "metric").agg(latest.alias("x"))
    return one.select("run_id", "x.checkpoint", "step", "metric", "x.value"), quarantine


def run_of(path: Column) -> Column:
    """The folder that holds the checkpoint folder of a file."""
    return F.regexp_extract(path, r"^(.*)/[^/]+/[^/]+$", 1)


def read_run_logs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """``(metrics, quarantine)`` of every ``trainer_state.json`` under ``root`` (see
    ``parse_trainer_states``). A file above ``STATE_LIMIT_BYTES`` is not read but reported
    (``too_large``): as one value it would stop the job."""
    require_paths(spark, root)
    files = _listed(spark, root, TRAINER_STATE)
    fits = F.col("length") <= STATE_LIMIT_BYTES
    metrics, quarantine = parse_trainer_states(files.where(fits).select("path", "content"))
    return metrics, quarantine.unionByName(files.where(~fits).select("path", F.lit("too_large").alias("reason")))


def _listed(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(root)


def list_markers(spark: SparkSession, root: str) -> DataFrame:
    """``(path)`` of every artifact marker under ``root``, by one listing of Spark's (in
    parallel over folders); no file is read."""
    return _listed(spark, root, ADAPTER_MARKER).select("path")


def read_run_metrics(spark: SparkSession, root: str) -> DataFrame:
    """The metrics alone; ``read_run_logs`` has the unreadable files as well."""
    return read_run_logs(spark, root)[0]


def artifacts_of(markers: DataFrame, roots: DataFrame) -> DataFrame:
    """S10 over a table of marker files ``(path)``: ``(root, path)`` of the folders that
    are one of ``roots (root)`` or directly under one."""
    tail = f"/{ADAPTER_MARKER}"
    dirs = markers.where(F.col("path").endswith(tail)).select(F.expr(f"left(path, length(path) - {len(tail)})").alias("path")).distinct()
    dirs = dirs.select("path", F.explode(F.array_distinct(F.array("path", F.regexp_extract("path", r"^(.*)/[^/]+$", 1)))).alias("root"))
    return dirs.join(roots.select("root").distinct(), "root").select("root", "path")


def list_artifacts(spark: SparkSession, *roots: str) -> DataFrame:
    """Each root itself and its direct sub-folders that hold ``adapter_config.json``
    -> ``(root, path)``. Only these two levels are listed, by the file system's own
    listing, so ``file:/x``, ``file:///x`` and ``/x`` mean the same; no file is read."""
    require_paths(spark, *roots)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for root in (r.rstrip("/") for r in roots):
        base = jvm.org.apache.hadoop.fs.Path(root)
        fs = base.getFileSystem(conf)
        if fs.exists(jvm.org.apache.hadoop.fs.Path(base, ADAPTER_MARKER)):
            rows.append((root, root))
        for found in fs.listStatus(base):
            if found.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(found.getPath(), ADAPTER_MARKER)):
                rows.append((root, f"{root}/{found.getPath().getName()}"))
    return spark.createDataFrame(rows, "root string, path string")
