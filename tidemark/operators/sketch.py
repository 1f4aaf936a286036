"""Mergeable sketches of people per source.

A theta sketch of a run's person keys is a few kilobytes that can be united
or intersected with any other, so counts over runs, sources and their
overlaps never go back to the rows: a run adds its sketches, a report reads
sketches. Spark's own sketch functions; their relative error at two standard
deviations is about 2 / sqrt(2**lg) of the united set.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG = 14  # 2**14 kept hashes: exact up to that many people, then within 1.6 percent


def error_bound(lg: int = LG, deviations: float = 3.0) -> float:
    """Relative to the united set, at so many standard deviations."""
    return deviations / math.sqrt(2 ** lg - 1)


def person_sketches(identity: DataFrame, run: Column, lg: int = LG) -> DataFrame:
    """One row per run and source: run, source_system, sketch. Partial
    aggregation: what a task sends is one sketch per run and source."""
    return identity.groupBy(run.alias("run"), "source_system").agg(F.theta_sketch_agg("customer_key", lg).alias("sketch"))


def merged(sketches: DataFrame, lg: int = LG) -> DataFrame:
    """The runs of each source united."""
    return sketches.groupBy("source_system").agg(F.theta_union_agg("sketch", lg).alias("sketch"))


def overlaps(sources: DataFrame) -> DataFrame:
    """Estimated people in both of every two sources (and in each one alone,
    as its pair with itself): source_a, source_b, people, united. A few rows:
    one per source goes in."""
    listed = sources.agg(F.array_sort(F.collect_list(F.struct("source_system", "sketch"))).alias("all"))
    pairs = listed.select("all", F.explode("all").alias("a")).select("a", F.explode("all").alias("b"))
    return pairs.filter(F.col("a.source_system") <= F.col("b.source_system")).select(
        F.col("a.source_system").alias("source_a"), F.col("b.source_system").alias("source_b"),
        F.theta_sketch_estimate(F.theta_intersection("a.sketch", "b.sketch")).alias("people"),
        F.theta_sketch_estimate(F.theta_union("a.sketch", "b.sketch")).alias("united"))
