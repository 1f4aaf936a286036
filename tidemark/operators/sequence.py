"""The next value within a key, for keys of any size (W4 without a bound).

``lead`` over the whole key would put a key that holds a third of the rows
into one task. The key's rows are therefore cut into buckets of consecutive
values (a day for times); ``lead`` runs within (key, bucket), and the last
row of a bucket takes the least value of the key's next bucket: one row per
(key, bucket), reduced map-side. Built-ins only, exact for every type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_MICROS = 86_400_000_000


def order_bucket(dtype: T.DataType, column: Column, width: int | None = None) -> Column:
    """A coarse value that never falls while ``column`` rises: time and whole
    numbers by ``width`` (a day, 65,536), text by its first characters."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(F.unix_micros(column.cast("timestamp")).cast("decimal(20,0)") / F.lit(width or DAY_MICROS))
    if isinstance(dtype, T.DateType):
        return F.floor(F.unix_date(column) / F.lit(width or 31))
    if isinstance(dtype, T.StringType):
        return F.substring(column, 1, width or 8)
    return F.floor(column.cast("decimal(38,6)") / F.lit(width or 65_536))


def next_within_key(df: DataFrame, key: str, order: str, out: str | None = None,
                    partitions: int | None = None, width: int | None = None) -> DataFrame:
    """``df`` with ``out`` (``next_<order>``): the next ``order`` value of the
    same key, NULL at its end; rows of equal value follow one another. NULL
    values come first; NULL keys are one key. ``partitions`` fixes the width
    of the shuffle by (key, bucket)."""
    out = out or f"next_{order}"
    value = F.col(f"`{order}`")
    rows = df.withColumn("_bucket", order_bucket(df.schema[order].dataType, value, width))
    if partitions:
        rows = rows.repartition(partitions, F.col(f"`{key}`"), F.col("_bucket"))
    k = F.col(f"`{key}`")
    inside = rows.withColumn(out, F.lead(value).over(Window.partitionBy(k, "_bucket").orderBy(value.asc_nulls_first())))
    borders = (rows.groupBy(k.alias("_b_key"), F.col("_bucket").alias("_b_bucket")).agg(F.min(value).alias("_first"))
               .withColumn("_after", F.lead("_first").over(Window.partitionBy("_b_key").orderBy(F.col("_b_bucket").asc_nulls_first()))))
    joined = inside.join(borders, k.eqNullSafe(F.col("_b_key")) & F.col("_bucket").eqNullSafe(F.col("_b_bucket")))
    return joined.withColumn(out, F.coalesce(F.col(f"`{out}`"), F.col("_after"))).select(*[F.col(f"`{c}`") for c in df.columns], F.col(f"`{out}`"))
