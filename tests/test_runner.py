"""End-to-end runs of the pipeline over files written from the fixture."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import runner
from tidemark.plans.runner import gold_table, run_pipeline
from tidemark.plans.q_io import write_source_files
from tidemark.plans.runner import read_snapshot
from tidemark.sources.landing import path_exists
from tidemark.session import scratch_path
from tidemark.streaming.id_index import IdIndex

SF = "/root/testdata/sf0.001"


def write_sources(spark):
    return write_source_files(spark, SF)


def test_two_runs_track_one_plan_change(spark):
    reg, paths = write_sources(spark)
    wh = scratch_path(spark, "warehouse")
    r1 = run_pipeline(spark, reg, wh, "2001-09-01 00:00:00", scale=0.15,
                      reference_now="2024-01-10 00:00:00", prefix="two_runs_", publish_failed=True)
    assert r1.landed["app_subscriptions"] == 1500 and r1.landed["crm_contacts"] == 135
    n_subs = r1.rows["subscriptions"]
    assert r1.rows["scd_subscriptions"] == n_subs                  # first run: one open version each
    assert set(r1.gates) == {"bronze", "silver", "gold"}
    assert 0 < r1.pass_rate <= 1 and r1.published == 1
    assert set(r1.freshness) == set(reg) and all(h >= 0 for h in r1.freshness.values())

    # one subscription changes plan after the first run
    subs = spark.read.parquet(paths["subs"])
    one = subs.orderBy("subscription_id", F.col("updated_at").desc()).limit(1)
    one.withColumn("plan", F.lit("enterprise")).withColumn(
        "updated_at", F.lit(dt.datetime(2001, 9, 2)).cast("timestamp_ntz")
    ).write.mode("append").parquet(paths["subs"])
    r2 = run_pipeline(spark, reg, wh, "2001-09-03 00:00:00", scale=0.15,
                      reference_now="2024-01-10 00:00:00", prefix="two_runs_", publish_failed=True)
    assert r2.landed["app_subscriptions"] == 1 and r2.landed["app_users"] == 0
    assert r2.rows["scd_subscriptions"] == n_subs + 1               # +1 version
    assert r2.rows["scd_opened_by_run"] == r2.rows["scd_closed_by_run"] == 1
    assert spark.sql("SELECT sum(active_subscriptions) FROM two_runs_gold.mart_mrr").first()[0] == gold_table(
        spark, wh, "mart_mrr").agg(F.sum("active_subscriptions")).first()[0]
    assert spark.table("two_runs_silver.events").count() == spark.read.parquet(f"{wh}/silver/events").count()
    assert spark.table("two_runs_bronze.app_subscriptions").count() == 1501
    fact = gold_table(spark, wh, "fact_subscriptions")
    assert fact.filter("is_current").count() == n_subs              # +1 history row only
    assert fact.filter("NOT is_current").count() == 1

    # what a run left that died before its commit is seen by nobody
    root = f"{wh}/snapshots/scd_subscriptions"
    read_snapshot(spark, root).write.parquet(f"{root}/commits/died/rows/state=open/bucket=0")
    assert read_snapshot(spark, root).count() == n_subs + 1

    # a third run with nothing new changes nothing
    r3 = run_pipeline(spark, reg, wh, "2001-09-04 00:00:00", scale=0.15,
                      reference_now="2024-01-10 00:00:00")
    assert sum(r3.landed[n] for n in ["app_users", "app_subscriptions", "app_events"]) == 0
    assert r3.rows["scd_subscriptions"] == n_subs + 1
    # run metrics and verdicts are kept per run (E5)
    runs = spark.read.parquet(f"{wh}/quality/run_metrics")
    assert runs.select("run_id").distinct().count() == 3
    verdicts = spark.read.parquet(f"{wh}/quality/check_results")
    assert verdicts.filter("run_id = '20010904T000000'").count() == len(r3.checks)


def test_incremental_events_equal_full_rebuild(spark):
    from tidemark.operators import silver
    from tidemark.sources import landing
    reg, paths = write_sources(spark)
    wh = scratch_path(spark, "warehouse")
    run_pipeline(spark, reg, wh, "2001-09-01 00:00:00", scale=0.15, gate_layers=())
    # new events ten days later arrive; a one-day lookback also re-lands the last day
    docs = spark.read.schema(reg["app_events"]["schema"]).option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(paths["events"])
    later = (docs.filter(F.col("event_id").cast("long") % 7 == 0)
             .withColumn("event_id", (F.col("event_id").cast("long") + 1000000).cast("string"))
             .withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 10 DAYS")))
    later.write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(paths["events"])
    r2 = run_pipeline(spark, reg, wh, "2001-09-02 00:00:00", scale=0.15, gate_layers=(),
                      lookback=dt.timedelta(days=11))
    assert r2.landed["app_events"] > later.count()          # new rows + re-landed copies
    bronze = landing.read_table(spark, f"{wh}/bronze/app_events")
    assert bronze.count() > bronze.select("event_id").distinct().count()
    full = {tuple(r) for r in silver.events_latest(bronze).collect()}
    inc = spark.read.parquet(f"{wh}/silver/events").drop("event_date")
    got = {tuple(r) for r in inc.select(*silver.EVENT_COLUMNS).collect()}
    assert got == full
    from tidemark.operators import conform
    cust_full = {tuple(r) for r in conform.customers_from_bronze(
        *(landing.read_table(spark, f"{wh}/bronze/{t}")
          for t in ["crm_contacts", "stripe_customers", "app_users"])).collect()}
    cust_inc = {tuple(r) for r in spark.read.parquet(f"{wh}/silver/customers")
                .select(*conform.CUSTOMER_COLUMNS).collect()}
    assert cust_inc == cust_full and r2.landed["app_users"] > 0
    subs_full = {tuple(r) for r in silver.subscriptions_latest(
        landing.read_table(spark, f"{wh}/bronze/app_subscriptions")).collect()}
    subs_inc = {tuple(r) for r in spark.read.parquet(f"{wh}/silver/subscriptions").collect()}
    assert subs_inc == subs_full


def test_reruns_backfills_and_refresh_keep_everything(spark):
    reg, paths = write_sources(spark)
    wh = scratch_path(spark, "warehouse")
    run = lambda as_of, **kw: run_pipeline(spark, reg, wh, as_of, gate_layers=(), **kw)
    versions = lambda: read_snapshot(spark, f"{wh}/snapshots/scd_subscriptions").count()
    n = run("2001-09-01 00:00:00").rows["subscriptions"]
    change = (spark.read.parquet(paths["subs"]).orderBy("subscription_id", F.col("updated_at").desc()).limit(1)
              .withColumn("plan", F.lit("enterprise"))
              .withColumn("updated_at", F.lit(dt.datetime(2001, 9, 2)).cast("timestamp_ntz"))).collect()
    schema = spark.read.parquet(paths["subs"]).schema
    spark.createDataFrame(change, schema).write.mode("append").parquet(paths["subs"])
    from tidemark.sources import landing
    landing.ingest(spark, reg, wh, names=["app_subscriptions"], run_ts="2001-09-02T12:00:00+00:00")   # no run follows
    r = run("2001-09-03 00:00:00")
    assert r.landed["app_subscriptions"] == 0 and versions() == n + 1      # landed earlier, merged now
    run("2001-09-03 00:00:00")
    assert versions() == n + 1                                             # the same run again
    run("2001-08-01 00:00:00")
    run("2001-09-04 00:00:00")
    assert versions() == n + 1                                             # an older clock, and on
    run("2001-09-05 00:00:00", full_refresh=True)
    assert versions() == n + 1                                             # history outlives a refresh
    subs = spark.read.parquet(f"{wh}/silver/subscriptions")
    assert subs.count() == n and subs.filter("plan = 'enterprise' AND sub_updated_at = '2001-09-02'").count() == 1
    gone = spark.read.parquet(paths["subs"]).filter(F.col("subscription_id").cast("long") % 2 == 0)
    half = scratch_path(spark, "src-half")
    gone.write.parquet(half)
    reg["app_subscriptions"]["path"] = half
    run("2001-09-06 00:00:00", full_refresh=True, reset_history=True)
    assert spark.read.parquet(f"{wh}/silver/subscriptions").count() == versions() < n   # no stale state


def test_same_clock_with_new_data_loses_nothing(spark):
    from tidemark.plans import runner
    root = scratch_path(spark, "scd")
    bronze = [("s1", "a1", "free", "active", "2001-01-01 00:00:00", "2001-09-01 00:00:00", "app_subscriptions", "r1")]
    cols = "subscription_id string, account_id string, plan string, status string, started_at string, updated_at string, _source string, _ingested_at string"
    for day, plan in ((1, "free"), (2, "basic"), (2, "basic"), (3, "pro")):      # one clock for all
        if day > 1 and plan not in {b[2] for b in bronze}:
            bronze.append((*bronze[0][:2], plan, *bronze[0][3:5], f"2001-09-0{day} 00:00:00", "app_subscriptions", "r1"))
        got = runner._history_run(spark, spark.createDataFrame(bronze, cols), root, "20010903", {})
    assert [(r["plan"], r["valid_to"] is None) for r in got.orderBy("valid_from").collect()] == [("free", False), ("basic", False), ("pro", True)]


def test_a_failed_gate_keeps_the_earlier_gold(spark):
    import tidemark.operators.dq as dq
    import tidemark.operators.rules as rules
    reg, paths = write_sources(spark)
    wh = scratch_path(spark, "warehouse")
    assert run_pipeline(spark, reg, wh, "2001-09-01 00:00:00", gate_layers=()).published == 1
    before = sorted(map(tuple, gold_table(spark, wh, "mart_mrr").collect()))
    subs = spark.read.parquet(paths["subs"])
    subs.orderBy("subscription_id").limit(50).withColumn("plan", F.lit("enterprise")).withColumn(
        "updated_at", F.lit(dt.datetime(2001, 9, 2)).cast("timestamp_ntz")).dropDuplicates(["subscription_id"]).write.mode("append").parquet(paths["subs"])
    refuse = [dq.Check("gold", "mart_mrr", "never", "row_count", fail=("ge", 0))]
    old = rules.checks_for
    rules.checks_for = lambda layer: refuse
    try:
        r = run_pipeline(spark, reg, wh, "2001-09-03 00:00:00", gate_layers=("gold",))
        assert r.gates == {"gold": "fail"} and r.published is None
    finally:
        rules.checks_for = old
    assert sorted(map(tuple, gold_table(spark, wh, "mart_mrr").collect())) == before
    assert run_pipeline(spark, reg, wh, "2001-09-05 00:00:00", gate_layers=()).published == 2
    assert sorted(map(tuple, gold_table(spark, wh, "mart_mrr").collect())) != before


def test_names_of_others_are_left_alone(spark):
    from tidemark.plans.runner import NameTaken, register_tables
    spark.sql("CREATE DATABASE IF NOT EXISTS others_silver")
    spark.sql("DROP TABLE IF EXISTS others_silver.customers")
    spark.range(3).write.saveAsTable("others_silver.customers")          # a managed table of someone else
    reg, _ = write_sources(spark)
    wh, second = scratch_path(spark, "warehouse"), scratch_path(spark, "warehouse")
    with pytest.raises(NameTaken):
        run_pipeline(spark, reg, wh, "2001-09-01 00:00:00", gate_layers=(), prefix="others_")
    assert not path_exists(spark, wh)                                    # refused before anything was done
    assert spark.table("others_silver.customers").count() == 3
    for w in (wh, second):
        spark.range(4).write.parquet(f"{w}/silver/customers")
    register_tables(spark, reg, wh, "mine_")
    with pytest.raises(NameTaken):
        register_tables(spark, reg, second, "mine_")
    spark.range(5).write.mode("append").parquet(f"{wh}/silver/customers")
    register_tables(spark, reg, wh, "mine_")
    assert spark.table("mine_silver.customers").count() == 9
    spark.sql("DROP TABLE others_silver.customers")


def test_missing_table_is_an_error_verdict(spark):
    reg, _ = write_sources(spark)
    import tidemark.operators.rules as rules
    wh = scratch_path(spark, "warehouse")
    lost = rules.checks_for("gold")[0]
    fake = [type(lost)(**{**lost.__dict__, "table": "no_such_table"})]
    old = rules.checks_for
    rules.checks_for = lambda layer: fake
    try:
        r = run_pipeline(spark, reg, wh, "2001-09-01 00:00:00", gate_layers=("gold",))
    finally:
        rules.checks_for = old
    assert r.gates == {"gold": "error"} and [c["outcome"] for c in r.checks] == ["error"]


def test_hot_day_of_events_is_split(spark):
    from tidemark.plans.runner import _events_run
    from tidemark.sources import adapter
    bronze = adapter.bronze_app_events(spark, SF).withColumn("timestamp", F.when(
        F.col("event_id").cast("long") % 3 == 0, F.lit("2001-01-01 10:00:00")).otherwise(F.col("timestamp")))
    path, rows = scratch_path(spark, "silver-events"), {}
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        got = _events_run(spark, bronze, path, rows)
        hot = got.filter("event_date = '2001-01-01'")
        assert len(hot.inputFiles()) > 1 and got.count() == got.select("event_id").distinct().count()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_state_lies_still_when_nothing_landed(spark):
    path, rows = scratch_path(spark, "state"), {}
    bronze = spark.createDataFrame([("a", "1", "r1"), ("a", "2", "r2"), ("b", "1", "r1")], "id string, v string, _ingested_at string")

    def run(landed):
        df = runner._state_run(spark, landed, path, "state", lambda b: b, ["id"], [F.col("_ingested_at").desc()], rows)
        return sorted(tuple(r) for r in df.collect()), {r[0] for r in df.select("_metadata.file_path").distinct().collect()}
    kept, files = run(bronze)
    assert kept == [("a", "2", "r2"), ("b", "1", "r1")] and rows["state"] == 2
    assert run(bronze) == (kept, files) and rows["state"] == 2
    changed, _ = run(bronze.union(spark.createDataFrame([("b", "9", "r3")], bronze.schema)))
    assert changed == [("a", "2", "r2"), ("b", "9", "r3")]


def test_events_reads_only_dates_that_may_hold_an_id(spark):
    path, rows = scratch_path(spark, "events"), {}
    schema = "event_id string, event_type string, anonymous_id string, user_id string, timestamp string, _ingested_at string"

    def land(ids, day, batch):
        at = None if day is None else f"2025-01-{day:02d} 10:00:00"
        return spark.createDataFrame([(i, "view", "a", "u", at, f"2025-02-{batch:02d}T00:00:00+00:00") for i in ids], schema)

    def run(bronze):
        df = runner._events_run(spark, bronze, path, rows)
        files = {r["event_date"]: r["f"] for r in df.select("event_date", F.col("_metadata.file_path").alias("f")).collect()}
        return {r["event_id"]: r["event_date"] and r["event_date"].day for r in df.collect()}, files
    bronze = land("abc", 1, 1).union(land("def", 2, 1)).union(land("g", 3, 1)).union(land("hi", None, 1))
    _, before = run(bronze)
    index = IdIndex(spark, path, "event_id", by="event_date")
    assert index.unknown() == [] and index.named(land("xyz", 9, 2)) == []
    assert [d for d, _ in index.named(land("eh", 9, 2))] == ["2025-01-02", "__HIVE_DEFAULT_PARTITION__"]
    # e and g move (the third is left empty), h gets a time, the first is not looked at
    bronze = bronze.union(land("egh", 4, 2))
    days, after = run(bronze)
    assert days == dict(a=1, b=1, c=1, d=2, e=4, f=2, g=4, h=4, i=None)
    first = dt.date(2025, 1, 1)
    assert after[first] == before[first] and dt.date(2025, 1, 3) not in after
    # a run that died before its bit fields: those dates are read
    IdIndex(spark, path, "event_id", by="event_date").forget(["2025-01-01", "2025-01-03"])
    bronze = bronze.union(land("ah", 2, 3))
    assert run(bronze)[0] == dict(a=2, b=1, c=1, d=2, e=4, f=2, g=4, h=2, i=None)
    # a table from before there were any
    runner.landing.drop_table(spark, f"{path}/_ids")
    assert run(bronze.union(land("bi", 7, 4)))[0] == dict(a=2, b=7, c=1, d=2, e=4, f=2, g=4, h=2, i=7)
    assert set(IdIndex(spark, path, "event_id", by="event_date").unknown()) <= {"2025-01-02", "2025-01-04"}
