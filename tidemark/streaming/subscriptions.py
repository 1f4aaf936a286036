"""SCD-2 history maintained by a stream of subscription changes.

Each micro-batch is applied in ``foreachBatch`` exactly like one scheduled
run: the batch's latest change per subscription is met with the open versions
of the buckets it touches, and one commit makes what it opened and closed
visible. A replayed epoch (the stream restarted after the commit but before
its checkpoint) brings nothing newer and so changes nothing; a batch reads and
writes in proportion to the buckets it touches, never the whole state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import silver
from tidemark.operators.dedupe import latest_per_key
from tidemark.plans import runner
from tidemark.streaming.events import stream_id

PAYLOAD = ["subscription_id", "account_id", "plan", "status", "sub_started_at", "sub_updated_at"]


def apply_changes(spark: SparkSession, changes: DataFrame, root: str, run_id: str, stream: str = "") -> None:
    """One batch of typed subscription changes (the columns of
    ``silver.subscription_log``) applied to the state under ``root``.
    ``stream`` and ``run_id`` (checkpoint and epoch) label the commit."""
    order = silver.subscription_order(updated="sub_updated_at", ingested="_ingested_at")
    runner.snapshot_run(spark, latest_per_key(changes, ["subscription_id"], order), f"{root}/snapshot", f"{stream}:{run_id}", {})


def scd2_stream(spark: SparkSession, source_path: str, schema, root: str,
                checkpoint: str) -> StreamingQuery:
    """Changes landing as files under ``source_path`` -> history under ``root``."""
    changes = spark.readStream.schema(schema).parquet(source_path)

    def each(batch_df: DataFrame, epoch_id: int) -> None:
        apply_changes(spark, batch_df, root, f"{epoch_id:012d}", stream_id(spark, checkpoint))

    return (changes.writeStream.foreachBatch(each)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def read_history(spark: SparkSession, root: str) -> DataFrame:
    return runner.read_snapshot(spark, f"{root}/snapshot")
