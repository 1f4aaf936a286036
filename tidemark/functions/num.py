"""Arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._util import as_col


def safe_div(num, den) -> Column:
    """num / nullif(den, 0) in double arithmetic (T8: the written intent)."""
    num, den = as_col(num), as_col(den)
    return num.cast("double") / F.when(den != 0, den.cast("double"))


def pct(num, den, digits: int = 2) -> Column:
    """round(100 * num / nullif(den, 0), digits) as double; evaluated as
    (100 * num) / den."""
    num, den = as_col(num), as_col(den)
    return F.round(F.lit(100.0) * num.cast("double") / F.when(den != 0, den.cast("double")), digits)


def ratio(num, den, digits: int = 3) -> Column:
    return F.round(safe_div(num, den), digits)
