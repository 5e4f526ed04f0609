"""JSON Lines datasets (read back and train/eval write)."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession, functions as F

from .documents import check_format

SCHEMAS = {
    "instruct": "instruction string, response string, context string, _corrupt_record string",
    "conversational": "messages array<struct<role:string,content:string>>, _corrupt_record string",
}
COLUMNS = {"instruct": ["instruction", "response", "context"], "conversational": ["messages"]}


def read_samples(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Read a produced dataset with a fixed schema (no inference); malformed lines
    land in ``_corrupt_record``."""
    check_format(fmt)
    return (
        spark.read.schema(SCHEMAS[fmt])
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hp):
        fs.delete(hp, True)


def write_splits(train: DataFrame, evl: DataFrame, out_dir: str, base: str, fmt: str) -> dict[str, str | None]:
    """``<out_dir>/train_<base>`` always (even empty), ``eval_<base>`` only when
    non-empty; a stale eval output from an earlier run is removed. Non-ASCII text
    is written raw and ``context`` is written as an explicit null. Rows that carry a
    shuffle key are written in its order: part files in name order, and lines in a
    part, follow ``(shuffle_key, sample_id)`` (a range shuffle, no single task)."""
    check_format(fmt)
    cols = COLUMNS[fmt]
    spark = train.sparkSession
    train_path = posixpath.join(out_dir, f"train_{base}")
    eval_path = posixpath.join(out_dir, f"eval_{base}")
    order = [c for c in ("shuffle_key", "sample_id") if c in train.columns]

    def write(df: DataFrame, path: str) -> None:
        if order:
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        df.select(*cols).write.mode("overwrite").option("ignoreNullFields", "false").json(path)

    write(train, train_path)
    write(evl, eval_path)
    if spark.read.text(eval_path).isEmpty():
        _delete(spark, eval_path)
        return {"train": train_path, "eval": None}
    return {"train": train_path, "eval": eval_path}


def to_json_lines(df: DataFrame, fmt: str) -> DataFrame:
    """The JSONL text of samples (``value`` column) without writing it."""
    check_format(fmt)
    return df.select(F.to_json(F.struct(*COLUMNS[fmt]), {"ignoreNullFields": "false"}).alias("value"))
