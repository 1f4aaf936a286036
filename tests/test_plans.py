"""Physical-plan properties the design relies on at scale."""

import datetime as dt
import re

from pyspark.sql import functions as F

from tidemark.operators import dq, gold, silver
from tidemark.operators.dedupe import latest_per_key
from tidemark.plans.queries import lake
from tidemark.session import scratch_path
from tidemark.sources import readers

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_reduces_before_the_shuffle(spark):
    # one hot key holding a third of the rows
    df = spark.range(30000).select((F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))).alias("k"),
                                   F.col("id").alias("ts"))
    p = plan(latest_per_key(df, ["k"], [F.col("ts").desc()]))
    # plan text lists the consumer first: Final limit, then the exchange, then the Partial limit
    first, second = [m.start() for m in re.finditer("WindowGroupLimit", p)]
    assert "Final" in p[first:p.index("\n", first)]
    assert "Exchange" in p[first:second]
    assert "Partial" in p[second:p.index("\n", second)]
    out = latest_per_key(df, ["k"], [F.col("ts").desc()]).filter("k = 0").first()
    assert out["ts"] == 29997


def test_watermark_filter_reaches_the_parquet_scan(spark):
    path = scratch_path(spark, "wm")
    spark.createDataFrame([(1, dt.datetime(2025, 1, 1))], "id long, created_at timestamp_ntz").write.parquet(path)
    df = readers.read_parquet(spark, {"path": path, "watermark": "created_at"}, since="2025-01-01 00:00:00")
    s = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(created_at), GreaterThan(created_at" in s


def test_silver_events_reads_only_needed_columns(spark):
    lh = lake(spark, SF)
    p = plan(silver.anonymous_event_share(lh.events))
    scan = [line for line in p.splitlines() if "events.parquet" in line][0]
    read = {x.split(":")[0] for x in re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1).split(",")}
    assert read == {"event_id", "ts", "user_id", "event_type"}     # no props, no value


def test_mart_mrr_broadcasts_only_the_seed_and_aggregates_first(spark):
    p = plan(lake(spark, SF).mart_mrr)
    assert "LocalTableScan" in p                    # the four-row seed
    assert "partial_count" in p                     # per-plan count reduced map-side


def test_dim_customer_has_no_self_join(spark):
    p = plan(gold.dim_customer(None, lake(spark, SF).customers))
    assert "SortMergeJoin" not in p
    assert "partial_max" in p and "partial_count" in p


def test_checks_scan_each_table_once_for_fused_metrics(spark):
    t = spark.range(1000).select(F.col("id").cast("string").alias("a"), (F.col("id") % 7).alias("b"))
    path = scratch_path(spark, "dq")
    t.write.parquet(path)
    tbl = spark.read.parquet(path)
    checks = [dq.Check("x", "t", f"m{i}", k, "a", fail=("gt", 0)) for i, k in
              enumerate(["row_count", "missing_count", "missing_percent", "not_null"])]
    res = dq.run_checks(spark, {"t": tbl}, checks, "2025-01-01 00:00:00")
    p = res._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan parquet") == 1
    assert res.count() == 4
