"""Session helpers: defaults for tests/benchmarks and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import sys
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "turnloom", extra_conf: dict | None = None) -> SparkSession:
    """A local session with AQE on and the UI off (tests, bench, smoke runs).

    On a cluster, use the session the platform gives you instead: every
    operator only reads settings from the active session.
    """
    builder = (
        SparkSession.builder.master(master or os.environ.get("TURNLOOM_MASTER", "local[8]"))
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.driver.memory", os.environ.get("TURNLOOM_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only when unset (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a folder shared by all executors; a machine-local scratch "
                "folder is only used in local mode"
            )
        conf_dir = tempfile.mkdtemp(prefix="turnloom-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ship_by_value(module_name: str) -> None:
    """Pickle functions of ``module_name`` by value so Python workers need no install
    of this package (the usual alternative is ``addPyFile`` of a wheel/zip)."""
    from pyspark import cloudpickle

    mod = sys.modules.get(module_name)
    if mod is not None:
        try:
            cloudpickle.register_pickle_by_value(mod)
        except ValueError:
            pass


def shared_table(df: DataFrame, name: str = "shared") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back: used by
    several branches of a lazy plan, computed once, survives lost executors. The folder
    is the cluster's to clean, like any checkpoint."""
    path = ensure_checkpoint_dir(df.sparkSession).rstrip("/") + f"/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` in which NULL equals NULL; the columns of ``on`` come from ``left``."""
    keys = {c: f"__{c}_r" for c in on}
    right = right.withColumnsRenamed(keys)
    cond = None
    for c, r in keys.items():
        one = F.col(c).eqNullSafe(F.col(r))
        cond = one if cond is None else cond & one
    return left.join(right, cond, how).drop(*keys.values())


@contextmanager
def scratch_table(df: DataFrame, name: str = "scratch"):
    """Write ``df`` as parquet under the shared checkpoint folder, yield it read back
    (lineage cut, survives executor loss), delete it on exit."""
    spark = df.sparkSession
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        jvm = spark.sparkContext._jvm
        hp = jvm.org.apache.hadoop.fs.Path(path)
        hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)
