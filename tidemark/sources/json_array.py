"""One JSON array read by many tasks.

A JSON array has no line to split at: whether a brace ends a record depends
on all that came before it. The file is read as text cut at ``}``, which Spark
does by byte ranges, and the state at each piece is found by prefix sums:

* quotes (escaped ones removed) before a piece are odd: it begins in a string;
* with that known, the braces and brackets of the piece outside strings give
  its change of depth, and their sum the depth at its end;
* a piece ends a record where its ``}`` is outside a string and leads back to
  depth one; the number of such ends before a piece is its record.

Sums run inside each byte range, and over one row per byte range beyond it,
so a file of any size is spread over its ranges. Pieces of a record that
crosses a border meet in one grouping. Built-ins only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

FIRST = Window.unboundedPreceding


def _depth(text: Column) -> Column:
    """Opening less closing braces and brackets of text outside strings."""
    bare = F.regexp_replace(F.regexp_replace(text, '"[^"]*"', ""), '"[^"]*$', "")
    count = lambda chars: F.length(F.regexp_replace(bare, f"[^{chars}]", ""))
    return (count("\\[\\{") - count("\\]\\}")).cast("long")


def _open_at_end(quotes: Column) -> Column:
    return quotes % 2 == 1


def read_split_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The records of the JSON arrays (of objects) in the files of ``path``,
    each file cut into ranges of ``spark.sql.files.maxPartitionBytes``."""
    pieces = (spark.read.option("lineSep", "}").text(path)
              .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw")))
    # backslash pairs cannot cross a piece: no escape is written with a brace
    plain = F.regexp_replace("raw", r"(?s)\\.", "")
    quotes = F.length(F.regexp_replace(plain, '[^"]', "")).cast("long")
    after_string = F.regexp_replace(plain, '^[^"]*("|$)', "")
    measured = pieces.select("file", "block", "at", "raw", quotes.alias("quotes"), _depth(plain).alias("outside"),
                             _depth(after_string).alias("inside"))
    path_ = scratch_path(spark, "json-pieces")
    measured.write.parquet(path_)
    measured = spark.read.parquet(path_)
    here, files = Window.partitionBy("file", "block").orderBy("at"), Window.partitionBy("file").orderBy("block")

    def before(df: DataFrame, value: str, out: str) -> DataFrame:
        """``out``: the sum of ``value`` over all pieces of the file before this one."""
        ranges = df.groupBy("file", "block").agg(F.sum(value).alias("s"))    # a row per byte range
        ranges = ranges.select(F.col("file").alias("r_file"), F.col("block").alias("r_block"),
                               F.coalesce(F.sum("s").over(files.rowsBetween(FIRST, -1)), F.lit(0)).alias("r"))
        own = df.withColumn(out, F.coalesce(F.sum(value).over(here.rowsBetween(FIRST, -1)), F.lit(0)))
        return own.join(ranges, (F.col("file") == F.col("r_file")) & (F.col("block") == F.col("r_block"))).withColumn(
            out, F.col(out) + F.col("r")).drop("r_file", "r_block", "r")

    held = before(measured, "quotes", "quotes_before").withColumn("in_string", _open_at_end(F.col("quotes_before")))
    ends_open = _open_at_end(F.col("quotes_before") + F.col("quotes"))
    held = held.withColumn("step", F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside")) - F.when(ends_open, 0).otherwise(1))
    held = before(held.withColumn("ends_open", ends_open), "step", "depth")
    held = held.withColumn("ends", (~F.col("ends_open") & (F.col("depth") + F.col("step") == 1)).cast("long"))
    held = before(held, "ends", "record")
    whole = held.groupBy("file", "record").agg(F.max("ends").alias("ends"), F.array_sort(F.collect_list(
        F.struct("block", "at", "raw"))).alias("pieces")).filter("ends = 1")
    text = F.concat(F.array_join(F.transform("pieces", lambda p: p["raw"]), "}"), F.lit("}"))
    return whole.select(F.from_json(F.regexp_replace(text, r"^[\s,\[]+", ""), schema).alias("r")).select("r.*")
