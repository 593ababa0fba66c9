"""Numeric functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mysem.functions.conditional import col, lit


def rand_fn(seed: int | None = None) -> Column:
    """Uniform in [0, 1)."""
    return F.rand(seed)


def truncate_num(c, d: int) -> Column:
    """``TRUNCATE(c, d)``: cut toward zero after ``d`` digits; decimal result."""
    x = col(c).cast(f"decimal(38,{max(10, d)})")
    return F.when(x >= 0, F.floor(x, F.lit(d))).otherwise(F.ceil(x, F.lit(d)))


def log_natural(c) -> Column:
    """``LOG(c)``; NULL for values that have no logarithm."""
    return F.ln(col(c))


def log_base(base, c) -> Column:
    """``LOG(base, c)``."""
    return F.call_function("log", lit(base), col(c))


def log2(c) -> Column:
    return F.log2(col(c))


def log10(c) -> Column:
    return F.log10(col(c))
