"""Blank handling on canonical turns (P1-P3 live in the sources)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Placeholders the conversational mode puts in place of blank turns.
USER_PLACEHOLDER = "continue"
MODEL_PLACEHOLDER = "huh?..."


def drop_blank(turns: DataFrame) -> DataFrame:
    """Instruct mode (P4): blank turns are invisible to the pairing."""
    return turns.where(F.col("content") != F.lit(""))


def fill_blank(turns: DataFrame, user: str = USER_PLACEHOLDER, model: str = MODEL_PLACEHOLDER) -> DataFrame:
    """Conversational mode (P5): blank user -> ``continue``, blank model -> ``huh?...``; kept."""
    placeholder = F.when(F.col("role") == "user", F.lit(user)).otherwise(F.lit(model))
    return turns.withColumn(
        "content", F.when(F.col("content") == F.lit(""), placeholder).otherwise(F.col("content"))
    )
