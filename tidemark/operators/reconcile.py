"""Reconciliation of a source with what was landed from it.

A watermark load never sees rows that came late, changed without moving the
watermark, or were deleted. Comparing row by row would move both sides whole.
Here each side computes, next to its data, one digest per range of keys: the
count of its rows and an order-free sum of their hashes. Only ranges whose
digests differ are looked into, cut finer round by round, and only the last
ranges' rows are compared one by one. A few plain filters on the key cover the
open ranges, so a database gets them in its WHERE clause and a Parquet scan
skips row groups by them; however many ranges differ, a join with their
numbers leaves only their rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: plain range conditions of one filter
SPANS = 32


@dataclass
class Rounds:
    """What each round looked at: (ranges compared, ranges that differ, keys they span)."""

    log: list[tuple[int, int, int]] = field(default_factory=list)


def _hash(cols: list[str]) -> Column:
    """Of every value in its place, NULL told apart from text."""
    return F.xxhash64(*[x for c in cols for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`").cast("string"))])


def _range_of(key: str, first: int, width: int) -> Column:
    return F.call_function("div", F.col(key) - F.lit(first), F.lit(width).cast("long"))


def _digests(df: DataFrame, key: str, cols: list[str], first: int, width: int) -> DataFrame:
    return df.groupBy(_range_of(key, first, width).alias("range")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(_hash(cols).cast("decimal(38,0)")).alias("digest"))


def _spans(numbers: list[int], most: int) -> list[tuple[int, int]]:
    """At most ``most`` spans [a, b) that cover the numbers: parted where the gaps are widest."""
    numbers = sorted(numbers)
    gaps = sorted((n for n in range(1, len(numbers)) if numbers[n] - numbers[n - 1] > 1), key=lambda n: numbers[n - 1] - numbers[n])
    starts = [0, *sorted(gaps[:most - 1]), len(numbers)]
    return [(numbers[a], numbers[b - 1] + 1) for a, b in zip(starts, starts[1:])]


def _within(df: DataFrame, key: str, first: int, width: int, numbers: list[int]) -> DataFrame:
    """Rows of the numbered ranges of ``width`` keys."""
    spans = _spans(numbers, SPANS)
    df = df.filter(reduce(Column.__or__, [(F.col(key) >= F.lit(first + a * width)) & (F.col(key) < F.lit(first + b * width)) for a, b in spans]))
    if sum(b - a for a, b in spans) == len(numbers):
        return df
    open_ = df.sparkSession.createDataFrame([(n,) for n in numbers], "_open long")
    return df.join(F.broadcast(open_), _range_of(key, first, width) == F.col("_open"), "left_semi")


def reconcile(source: DataFrame, landed: DataFrame, key: str, cols: list[str], ranges: int = 256, leaf: int = 4096,
              most: int = 1024, rounds: Rounds | None = None) -> DataFrame:
    """Keys that differ: ``key``, status ``missing`` (only in the source),
    ``deleted`` (only in what was landed) or ``changed`` (other ``cols``).

    ``key`` is a whole number, unique on either side; rows without one are
    left out. Each round compares ``ranges`` digests per range still open, and
    stops when a range is at most ``leaf`` keys wide or more than ``most`` of
    them differ (the rows of all differing ranges are compared then: nothing
    is left out). At most ``ranges`` + ``most`` * ``ranges`` digests of one
    round reach the driver.
    """
    rounds = rounds or Rounds()
    source, landed = (d.filter(F.col(key).isNotNull()).withColumn(key, F.col(key).cast("long")) for d in (source, landed))
    ends = [d.agg(F.min(key).alias("a"), F.max(key).alias("b")).first() for d in (source, landed)]
    ends = [e for e in ends if e["a"] is not None]
    compared = lambda s, t: _compared(s, t, key, cols)
    if not ends:
        return compared(source, landed)
    first, last = min(e["a"] for e in ends), max(e["b"] for e in ends) + 1
    open_, held, width = [0], last - first, last - first    # numbers of the ranges of ``held`` keys
    while True:
        width = max(1, -(-width // ranges))
        mine, theirs = (_digests(_within(d, key, first, held, open_), key, cols, first, width) for d in (source, landed))
        theirs = theirs.select("range", F.col("n").alias("n2"), F.col("digest").alias("digest2"))
        differ = [r["range"] for r in mine.join(theirs, "range", "full_outer").filter(
            ~(F.col("n").eqNullSafe(F.col("n2")) & F.col("digest").eqNullSafe(F.col("digest2")))).select("range").limit(most * ranges + 1).collect()]
        rounds.log.append((len(open_) * -(-held // width), len(differ), len(differ) * width))
        if not differ:
            return compared(source.limit(0), landed.limit(0))
        if len(differ) > most * ranges:      # nearly everything differs: no use in looking closer
            break
        open_, held = differ, width
        if width <= leaf or len(differ) > most:
            break
    return compared(_within(source, key, first, held, open_), _within(landed, key, first, held, open_))


def _compared(source: DataFrame, landed: DataFrame, key: str, cols: list[str]) -> DataFrame:
    a = source.select(F.col(key).alias("k"), _hash(cols).alias("h"), F.lit(True).alias("here"))
    b = landed.select(F.col(key).alias("k"), _hash(cols).alias("h2"), F.lit(True).alias("there"))
    status = F.when(F.col("there").isNull(), "missing").when(F.col("here").isNull(), "deleted").when(F.col("h") != F.col("h2"), "changed")
    return a.join(b, "k", "full_outer").select(F.col("k").alias(key), status.alias("status")).filter("status IS NOT NULL")
