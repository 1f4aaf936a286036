"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path
from tidemark.sources.landing import drop_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: rows of whole texts that go to a Python worker at once
ROWS_AT_ONCE = 1000
_OWNER: list = [None, None]


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, after making sure that its session hands rows over to Python
    in batches of at most ``ROWS_AT_ONCE``: texts are long, and a batch is
    held several times over on its way."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(conf.get(key, "10000"))
    if now <= 0 or now > ROWS_AT_ONCE:
        conf.set(key, str(ROWS_AT_ONCE))
    return df


def worker_cache(name, make):
    """What ``make()`` gave for ``name`` in this Python worker. One thing at a
    time is kept: a worker that goes on to another operator lets go of it."""
    if _OWNER[0] != name:
        _OWNER[:] = None, None
        _OWNER[:] = name, make()
    return _OWNER[1]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


_MADE: list[list[str]] = []


@contextmanager
def intermediates(spark: SparkSession):
    """What ``store`` writes inside the block is removed at its end, unless it
    was to be kept: for callers that have written their result by then."""
    _MADE.append([])
    try:
        yield
    finally:
        for path in _MADE.pop():
            drop_table(spark, path)


def store(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Cuts the lineage: later reads survive a lost executor and never compute
    ``df`` again, and every use sees the same rows. ``keep``: outlives a
    surrounding ``intermediates`` block.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    if _MADE and not keep:
        _MADE[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces_of(text: str, size: int = 1 << 20) -> Iterator[str]:
    """``text`` cut before single spaces into pieces of about ``size``
    characters, so that word lists of a very long text stay small. Words,
    marker strings and combining sequences never hold a space, and the
    pieces join to ``text``."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)],
        schema=schema)
