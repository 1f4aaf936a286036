"""Latest row per key.

``row_number() over (partition by keys order by ...) = 1`` is planned by
Catalyst as a partial ``WindowGroupLimit`` before the shuffle and a final
one after it: each map task forwards at most one row per key, so a key
holding a large share of the rows is reduced map-side before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions._util import as_col


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str],
                   rank_col: str = "rank") -> DataFrame:
    """Keep the first row of each key group under ``order_by``.

    ``order_by`` must end in columns that make the order total (T10, T11),
    otherwise the kept row is arbitrary among ties.
    """
    order = [as_col(c) for c in order_by]
    if not order:   # any copy will do, but always the same one
        order = [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in keys]
    if not order:   # nothing but the key: copies are the same row
        return df.dropDuplicates(list(keys))
    w = Window.partitionBy(*[as_col(k) for k in keys]).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """A (possibly dotted) column of ``df``, or a typed NULL when the
    table's schema does not have it (schema evolution)."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(None).cast(dtype)
