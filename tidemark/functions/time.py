"""Time column functions.

Every function that needs "now" takes it as an argument (``as_of``) so a
run is reproducible (T19).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._util import as_col


def ts_literal(value) -> Column:
    """An instant literal from a datetime or text (interpreted in the session zone, UTC)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp")


def try_instant(c) -> Column:
    """try_cast(text as timestamp with zone); bad text -> NULL, row kept."""
    return as_col(c).try_cast("timestamp")


def try_local(c) -> Column:
    """try_cast(text as timestamp without zone)."""
    return as_col(c).try_cast("timestamp_ntz")


def try_double(c) -> Column:
    return as_col(c).try_cast("double")


def from_epoch_seconds(c) -> Column:
    """from_unixtime(cast(x as bigint)) as an instant (F16); bad text -> NULL."""
    return F.timestamp_seconds(as_col(c).try_cast("bigint"))


def from_iso8601(c) -> Column:
    """ISO-8601 text (with or without offset) to an instant."""
    return as_col(c).try_cast("timestamp")


def hours_between(start, end) -> Column:
    """Whole hours elapsed from ``start`` to ``end``."""
    return F.timestamp_diff("HOUR", as_col(start), as_col(end))


def months_between_whole(start, end) -> Column:
    """Whole calendar months elapsed from ``start`` to ``end``.

    Counts a month only when ``start`` advanced by it does not pass
    ``end`` (time of day included), month-end clamped. Negative when
    ``end`` precedes ``start``.
    """
    s, e = as_col(start), as_col(end)
    n = (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))
    moved = s + F.make_ym_interval(F.lit(0), n)
    return (F.when((n > 0) & (moved > e), n - 1)
             .when((n < 0) & (moved < e), n + 1)
             .otherwise(n))


def clamp_non_negative(c) -> Column:
    """greatest(x, 0) that keeps NULL as NULL (T5)."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0)))


def iso_utc_text(c) -> Column:
    """An instant as ISO-8601 UTC text, the lineage format of ``_ingested_at``."""
    return F.date_format(as_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
