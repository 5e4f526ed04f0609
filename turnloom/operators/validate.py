"""V1-V2: output checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.json import strict_parse_json
from ..sources.documents import check_format

# Keys every output line must have, per format.
REQUIRED_KEYS = {"instruct": ("instruction", "response"), "conversational": ("messages",)}


def validate(lines: DataFrame, fmt: str, col: str = "value") -> DataFrame:
    """V1: one pass over JSONL lines -> ``(n_rows, n_unparsable, n_missing_keys, is_valid)``.

    Every line must parse (after ``str.strip``-like trimming) as a JSON object with
    the format's keys; zero rows is valid.
    """
    check_format(fmt)
    present = F.lit(True)
    for k in REQUIRED_KEYS[fmt]:
        present = present & F.try_variant_get("v", f"$.{k}", "variant").isNotNull()
    parsed = strict_parse_json(lines.select(F.col(col).alias("line")), "line", "v").select("v", present.alias("ok"))
    return parsed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("v").isNull()).alias("n_unparsable"),
        F.count_if(F.col("v").isNotNull() & ~F.col("ok")).alias("n_missing_keys"),
    ).withColumn("is_valid", (F.col("n_unparsable") + F.col("n_missing_keys")) == 0)


def is_valid(report: DataFrame) -> bool:
    return bool(report.first()["is_valid"])


def require_nonempty(n_train: int, n_eval: int) -> None:
    """V2: zero train and zero eval rows is a failed preparation."""
    if n_train == 0 and n_eval == 0:
        raise RuntimeError("no training data was produced")
