"""String helpers that reproduce Python ``str`` semantics with native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's ``str.strip()`` removes: every code point for which
# ``str.isspace()`` is true (29 of them, all at or below U+3000). Derived by rule
# so that the set tracks the Python definition rather than a hand-typed list.
PY_WHITESPACE: str = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def py_strip(col: Column | str) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace (``trim`` only removes U+0020)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(c, F.lit(PY_WHITESPACE))


def is_blank(col: Column | str) -> Column:
    """True when NULL or empty after ``py_strip``."""
    return F.coalesce(py_strip(col) == F.lit(""), F.lit(True))


def duckdb_ws_literal() -> str:
    """The same character set as a DuckDB expression (for oracle SQL)."""
    return "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"
