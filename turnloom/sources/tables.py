"""Already-exploded turn tables (one row per message)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import py_strip

# How table roles map onto the two training roles. Anything not
# listed (e.g. ``system``) behaves like an unknown sender and is dropped.
TABLE_ROLE_MAP: Mapping[str, str] = {"user": "user", "assistant": "model", "model": "model"}


def role_expr(col: Column, role_map: Mapping[str, str]) -> Column:
    """``CASE col WHEN k THEN v ... END`` (NULL for unknown values)."""
    expr = None
    for k, v in role_map.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr if expr is not None else F.lit(None).cast("string")


def turns_from_table(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    role_map: Mapping[str, str] = TABLE_ROLE_MAP,
) -> DataFrame:
    """Canonical turns ``(conv_id, turn, role, content)``: roles mapped, unknown roles
    dropped *before* any window, content stripped like ``str.strip()`` (NULL -> '')."""
    return (
        df.select(
            F.col(conv).alias("conv_id"),
            F.col(turn).alias("turn"),
            role_expr(F.col(role), role_map).alias("role"),
            F.coalesce(py_strip(F.col(text)), F.lit("")).alias("content"),
        ).where(F.col("role").isNotNull())
    )
