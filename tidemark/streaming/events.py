"""Structured Streaming forms of the incremental loads.

``land_stream`` is the exactly-once replacement of the batch watermark
load: the file source remembers which files it has read in the
checkpoint, the file sink commits each micro-batch through its own log, so
a restarted (or re-triggered) query lands every new file once and nothing
twice. ``trigger(availableNow=True)`` processes what is there and stops:
the daily-batch schedule of the original pipeline, with streaming
bookkeeping.

``dedupe_stream`` keeps every event id once and loses none, however late:
the target table is the state, and a micro-batch adds the ids it lacks. It
keeps the **first** copy seen (the batch model keeps the latest landing);
equal when copies are identical in the kept columns. ``dedupe_events`` is the
form with bounded state, for feeds that accept its policy: an id is kept
until the event-time watermark passes it, and rows later than that go.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import try_instant
from tidemark.operators.dedupe import latest_per_key
from tidemark.sources.landing import to_bronze
from tidemark.streaming.id_index import IdIndex

NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_document_stream(spark: SparkSession, path: str, schema: T.StructType,
                         fmt: str = "json", max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "json":
        reader = reader.option("timestampNTZFormat", NTZ_FORMAT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def land_stream(spark: SparkSession, source_path: str, schema: T.StructType, target_path: str,
                checkpoint: str, source_name: str, run_ts, fmt: str = "json") -> StreamingQuery:
    """Land new source files as bronze rows (flattened, text, lineage)."""
    stream = read_document_stream(spark, source_path, schema, fmt)
    bronze = to_bronze(stream, source_name, run_ts)
    return (bronze.writeStream.format("parquet")
            .option("path", target_path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def dedupe_events(stream: DataFrame, key: str = "event_id", time_text: str = "timestamp",
                  delay: str = "1 day") -> DataFrame:
    """Typed event time + first-copy de-duplication within the watermark."""
    typed = stream.withColumn("event_at", try_instant(F.col(f"`{time_text}`")))
    return (typed.withWatermark("event_at", delay)
            .dropDuplicatesWithinWatermark([key]))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a checkpoint: epoch numbers mean something only within one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def dedupe_stream(spark: SparkSession, source_path: str, schema: T.StructType, target_path: str,
                  checkpoint: str, columns: list[str], key: str = "event_id", time_text: str = "timestamp",
                  buckets: int = 16) -> StreamingQuery:
    """Each event id once, however late it or its copies come.

    A micro-batch keeps one copy per id (the least by all columns) and of
    those the ids the target does not hold; they go to a folder of the
    checkpoint's epoch, in ``buckets`` by id, which a replayed epoch writes
    again without looking at itself. Ids are read only of the folders that may
    hold one of the batch (``streaming.id_index``). A new checkpoint starts new
    folders, and what the target holds still counts.
    """
    def each(batch: DataFrame, epoch: int) -> None:
        run = f"{stream_id(spark, checkpoint)}-{epoch:012d}"
        typed = batch.withColumn("event_at", try_instant(F.col(f"`{time_text}`")))
        work = f"{checkpoint}/tidemark-batch"    # the batch is read twice: its ids, then its rows
        latest_per_key(typed, [key], []).select(*dict.fromkeys([key, *columns])).write.mode("overwrite").parquet(work)
        index = IdIndex(spark, target_path, key, buckets)
        index.add(index.missing(spark.read.parquet(work), run).select(*columns), run)

    return (spark.readStream.schema(schema).parquet(source_path).writeStream.foreachBatch(each)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_to_end(query: StreamingQuery) -> None:
    """Block until an availableNow query has processed everything and stopped."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
