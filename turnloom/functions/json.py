"""Strict JSON parsing on Spark's VARIANT parser."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F


def strict_parse_json(df: DataFrame, col: str, out: str) -> DataFrame:
    """``df`` plus ``out``: the parsed value of ``col``, NULL if it is not exactly one JSON
    value (as Python's ``json.loads`` has it).

    Spark's parser stops after the first complete value and ignores the rest
    (``8294 text`` parses as 8294). ``[doc,"<token>"]`` is parsed instead, and must be
    an array of two whose last element is the token: trailing text breaks the array, a
    stray ``]`` or ``,`` changes its size. The token is new in each plan, so no text
    can hold it. The parse stands in a one-row generator, which keeps the optimiser
    from copying it into every expression that reads the value: one parse per document.
    """
    token = uuid.uuid4().hex
    whole = F.try_parse_json(F.concat(F.lit("["), F.col(col), F.lit(f',"{token}"]')))
    got = df.withColumn("__w", F.explode(F.array(whole)))
    ok = (F.size(F.try_variant_get("__w", "$", "array<variant>")) == 2) & (F.try_variant_get("__w", "$[1]", "string") == F.lit(token))
    value = F.when(ok, F.try_variant_get("__w", "$[0]", "variant"))
    return got.withColumn(out, F.explode(F.array(value))).drop("__w")
