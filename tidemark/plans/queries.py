"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through the fixture adapter, so its
work grows with them. Times leave as zone-less timestamps (UTC wall clock).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.model import Lakehouse, to_ntz
from tidemark.session import pin_time_zone, session_key

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_time_zone(spark)
            return to_ntz(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


_LAKES: dict[tuple[tuple[str, str], str], Lakehouse] = {}


def lake(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """The fixture lakehouse of a session and data folder. Only the plan
    objects are shared between queries (built once on the driver); every
    action still computes from the driver's tables."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    if key not in _LAKES:
        _LAKES[key] = Lakehouse.from_fixture(spark, sf_dir)
    return _LAKES[key]


def fresh_lake(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """A private lakehouse, for queries that materialize tables."""
    return Lakehouse.from_fixture(spark, sf_dir)


# the query modules register themselves on import
from tidemark.plans import q_core, q_dq, q_io, q_more, q_state  # noqa: E402,F401
