"""Who was it? Event by event along an anonymous id (E2, in time order).

A device is used by one person after another. An event without a user belongs
to the next known login on its anonymous id (the visit that led to it), and
to the last known one when none follows. ``min(user_id)`` per anonymous id,
as in ``silver.event_identity_stitch``, would give all to one of them.

A segmented scan: events are dealt by ranges of (anonymous id, time, event), so
that a device with any share of all events covers as many partitions as it
needs. A partition fills what it can see; what lies before and after comes
from one row per (anonymous id, partition). Both directions are running
frames, the next login along the reversed order: a frame that ends at the
group's end would be gone through anew for every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

FIRST = Window.unboundedPreceding


def event_timeline(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """event_id, anonymous_id, user_id, event_at, resolved_user_id and how:
    ``user``, ``next_login``, ``last_login`` or ``unresolved``.

    Events of equal time go by event id (repeated ones by user, unknown first);
    those without a time come first.
    Events without an anonymous id resolve by their own user only.
    ``partitions``: of the range exchange (default: the session's).
    """
    spark = events.sparkSession
    key = ["anonymous_id", "event_at", "event_id"]
    rows = events.select("event_id", "anonymous_id", "user_id", "event_at")
    dealt = rows.repartitionByRange(partitions, *key) if partitions else rows.repartitionByRange(*key)
    path = scratch_path(spark, "timeline")
    dealt.withColumn("part", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    # at most one partition's rows in a group, whatever the device
    order = ["event_at", "event_id", "user_id"]
    group = Window.partitionBy("part", "anonymous_id")
    onward = group.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    back = group.orderBy(*[F.col(c).desc_nulls_last() for c in order])
    filled = (dealt.withColumn("last_in", F.last("user_id", True).over(onward.rowsBetween(FIRST, 0)))
              .withColumn("next_in", F.last("user_id", True).over(back.rowsBetween(FIRST, 0))))
    when = F.struct(*order)
    known = F.col("user_id").isNotNull()
    parts = dealt.filter("anonymous_id IS NOT NULL").groupBy(F.col("anonymous_id").alias("p_id"), F.col("part").alias("p_part")).agg(
        F.min_by(F.when(known, F.col("user_id")), F.when(known, when)).alias("first_known"),
        F.max_by(F.when(known, F.col("user_id")), F.when(known, when)).alias("last_known"))
    across = Window.partitionBy("p_id")                     # at most one row per partition and device
    parts = (parts.withColumn("last_out", F.last("last_known", True).over(across.orderBy("p_part").rowsBetween(FIRST, -1)))
             .withColumn("next_out", F.last("first_known", True).over(across.orderBy(F.desc("p_part")).rowsBetween(FIRST, -1))))
    joined = filled.join(parts, (F.col("anonymous_id") == F.col("p_id")) & (F.col("part") == F.col("p_part")), "left")
    has_id = F.col("anonymous_id").isNotNull()
    next_ = F.when(has_id, F.coalesce("next_in", "next_out"))
    last = F.when(has_id, F.coalesce("last_in", "last_out"))
    how = (F.when(known, "user").when(next_.isNotNull(), "next_login").when(last.isNotNull(), "last_login").otherwise("unresolved"))
    return joined.select("event_id", "anonymous_id", "user_id", "event_at",
                         F.coalesce(F.col("user_id"), next_, last).alias("resolved_user_id"), how.alias("resolution"))
