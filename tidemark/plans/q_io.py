"""Scans, landing and streaming queries. Each writes its intermediate
files under a fresh folder in the shared checkpoint directory, then
returns the landed table read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import adapter
from tidemark.sources.landing import (ingest, land, read_table, read_watermark, table_path,
                                      to_bronze)
from tidemark.sources.readers import flatten, read_csv_strings, read_json_array
from tidemark.sources.registry import registry_with
from tidemark.streaming import events as streams
from tidemark.plans.oracle import build
from tidemark.plans.queries import register

RUN_1 = adapter.FULL_LOAD_RUN
RUN_2 = adapter.RELAND_RUN
EARLIER_RUN = "2001-08-30T18:00:00+00:00"
# Spark's own export tells an empty text from NULL, breaks no lines and has no null tokens
AS_EXPORTED = {"null_values": [], "multi_line": False}
CRM_COLUMNS = ["contact_email", "first_name", "last_name", "company", "lead_source", "campaign",
               "created_date", "industry"]


def write_crm_csv(spark, sf_dir) -> str:
    """The CRM export as a CSV file set (whitespace kept as exported)."""
    path = scratch_path(spark, "src-crm-csv")
    src = adapter.crm_contacts_source(adapter.people(spark, sf_dir))
    (src.write.option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path))
    return path


@register("scan_csv_as_string", build(f"SELECT {', '.join(CRM_COLUMNS)} FROM bronze_crm_contacts"))
def q_scan_csv(spark, sf_dir):
    """CSV scan, header, every column text, only empty fields null."""
    return read_csv_strings(spark, write_crm_csv(spark, sf_dir))


@register("scan_csv_quoted", """
SELECT CAST(c_custkey AS VARCHAR) AS "_c0",
       CASE CAST(c_custkey AS BIGINT) % 5 WHEN 0 THEN 'Al "The" ' || c_name WHEN 1 THEN c_name || chr(10) || 'second line'
            WHEN 2 THEN c_name || '\\' WHEN 3 THEN 'a,b ' || c_name ELSE NULL END AS "_c1",
       c_mktsegment AS "_c2"
FROM customer
""".replace("\\\\", "\\"))
def q_scan_csv_quoted(spark, sf_dir):
    """CSV as other tools export it: doubled quotes, a line break inside
    a field, a backslash before the closing quote, null tokens."""
    path = scratch_path(spark, "src-quoted-csv")
    key, name = F.col("c_custkey"), F.col("c_name")
    field = (F.when(key % 5 == 0, F.concat(F.lit('"Al ""The"" '), name, F.lit('"')))
             .when(key % 5 == 1, F.concat(F.lit('"'), name, F.lit('\nsecond line"')))
             .when(key % 5 == 2, F.concat(F.lit('"'), name, F.lit('\\"')))
             .when(key % 5 == 3, F.concat(F.lit('"a,b '), name, F.lit('"'))).otherwise(F.lit("NA")))
    customers = adapter.read_driver_table(spark, sf_dir, "customer")
    customers.select(F.concat_ws(",", key.cast("string"), field, "c_mktsegment")).write.text(path)
    return read_csv_strings(spark, path, ["NA"], header=False, multiLine=True)


@register("land_full", build("SELECT * FROM bronze_crm_contacts"))
def q_land_full(spark, sf_dir):
    """Registry-driven full load of the CSV source."""
    warehouse = scratch_path(spark, "warehouse")
    reg = registry_with({"crm_contacts": AS_EXPORTED | {"path": write_crm_csv(spark, sf_dir)}})
    ingest(spark, reg, warehouse, names=["crm_contacts"], run_ts=RUN_1)
    return read_table(spark, table_path(warehouse, reg["crm_contacts"]["target_bronze"]))


@register("land_csv_defaults", """
SELECT CASE k % 4 WHEN 1 THEN 'Al "The" ' || k || chr(10) || 'second line' WHEN 2 THEN 'a,b' ELSE NULL END AS contact_email,
       CASE k % 3 WHEN 0 THEN first_name END AS first_name, last_name, 'crm_contacts' AS _source,
       '2001-08-31T18:00:00+00:00' AS _ingested_at
FROM (SELECT c_custkey AS k, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name FROM customer) c
""")
def q_land_csv_defaults(spark, sf_dir):
    """S1, T21 by the registry's defaults: null tokens, a quoted empty field,
    doubled quotes and a line break inside a field, landed."""
    path, warehouse = scratch_path(spark, "src-crm-default"), scratch_path(spark, "warehouse")
    key, name = F.col("c_custkey"), F.col("c_name")
    field = (F.when(key % 4 == 0, F.lit('""')).when(key % 4 == 1, F.concat(F.lit('"Al ""The"" '), key.cast("string"), F.lit('\nsecond line"')))
             .when(key % 4 == 2, F.lit('"a,b"')).otherwise(F.lit("NULL")))
    first = F.when(key % 3 == 0, F.split_part(name, F.lit("#"), F.lit(1))).when(key % 3 == 1, "NaN").otherwise("n/a")
    rows = adapter.read_driver_table(spark, sf_dir, "customer").select(
        F.concat_ws(",", field, first, F.split_part(name, F.lit("#"), F.lit(2))).alias("value"))
    parts = rows.withColumn("n", F.spark_partition_id())
    head = parts.select("n").distinct().select(F.lit("contact_email,first_name,last_name").alias("value"), "n", F.lit(0).alias("o"))
    # one file per part, its header first
    (parts.withColumn("o", F.lit(1)).select("value", "n", "o").union(head).repartition("n").sortWithinPartitions("n", "o")
     .select("value", "n").write.partitionBy("n").text(path))
    reg = registry_with({"crm_contacts": {"path": f"{path}/n=*"}})
    ingest(spark, reg, warehouse, names=["crm_contacts"], run_ts=RUN_1)
    return read_table(spark, table_path(warehouse, reg["crm_contacts"]["target_bronze"]))


@register("land_full_evolved", build("""
SELECT contact_email, first_name, last_name, company, lead_source, campaign, created_date,
       CAST(NULL AS VARCHAR) AS industry, length(last_name)::VARCHAR AS lead_rank, _source, _ingested_at
FROM bronze_crm_contacts
"""))
def q_land_full_evolved(spark, sf_dir):
    """A second full load whose source lost a column and won one:
    the lost one stays, as NULL."""
    warehouse, again = scratch_path(spark, "warehouse"), scratch_path(spark, "src-crm-evolved")
    first = registry_with({"crm_contacts": AS_EXPORTED | {"path": write_crm_csv(spark, sf_dir)}})
    ingest(spark, first, warehouse, names=["crm_contacts"], run_ts=EARLIER_RUN)
    src = adapter.crm_contacts_source(adapter.people(spark, sf_dir))
    src.drop("industry").withColumn("lead_rank", F.length("last_name")).write.parquet(again)
    reg = registry_with({"crm_contacts": {"type": "parquet", "path": again}})
    ingest(spark, reg, warehouse, names=["crm_contacts"], run_ts=RUN_1)
    return read_table(spark, table_path(warehouse, reg["crm_contacts"]["target_bronze"]))


@register("scan_json_flatten", build("""
SELECT id, object, email, name, CAST(created AS BIGINT) AS created, "metadata.country"
FROM bronze_stripe_customers
"""))
def q_scan_json(spark, sf_dir):
    """JSON records with a nested ``metadata`` object, flattened
    to dotted columns (JSON lines, the splittable form)."""
    path = scratch_path(spark, "src-billing-json")
    adapter.stripe_customers_source(adapter.people(spark, sf_dir)).write.json(path)
    return flatten(read_json_array(spark, path, multi_line=False))


@register("land_incremental_watermark", build(f"""
SELECT user_id, account_id, email, first_name, last_name, country, created_at, _source,
       CASE WHEN created_at IS NULL OR created_at < '1998-01-01' THEN '{RUN_1}' ELSE '{RUN_2}' END
         AS _ingested_at
FROM bronze_app_users WHERE _ingested_at = '{RUN_1}'
"""))
def q_land_incremental(spark, sf_dir):
    """Two incremental runs over a growing relational
    extract; the second lands only rows past the stored watermark."""
    src_path = scratch_path(spark, "src-app-users")
    warehouse = scratch_path(spark, "warehouse")
    users = adapter.app_users_source(adapter.people(spark, sf_dir))
    early = F.col("created_at").isNull() | (F.col("created_at") < F.lit("1998-01-01").cast("timestamp_ntz"))
    reg = registry_with({"app_users": {"type": "parquet", "path": src_path}})
    users.filter(early).write.mode("append").parquet(src_path)
    ingest(spark, reg, warehouse, names=["app_users"], run_ts=RUN_1)
    users.filter(~early).write.mode("append").parquet(src_path)
    ingest(spark, reg, warehouse, names=["app_users"], run_ts=RUN_2)
    path = table_path(warehouse, reg["app_users"]["target_bronze"])
    assert read_watermark(spark, path) is not None
    return read_table(spark, path)


@register("schema_evolution_union", build("SELECT * FROM crm_evolved"))
def q_schema_evolution(spark, sf_dir):
    """A first batch without ``campaign``/``industry``, a second with
    them; the table reads as the union by name, old rows NULL."""
    path = scratch_path(spark, "bronze-crm-evolving")
    src = adapter.crm_contacts_source(adapter.people(spark, sf_dir))
    old = F.col("campaign").isin("cmp_0", "cmp_1", "cmp_2")
    land(spark, to_bronze(src.filter(old).drop("campaign", "industry"), "crm_contacts",
                          EARLIER_RUN), path, "append")
    land(spark, to_bronze(src.filter(~old), "crm_contacts", RUN_1), path, "append")
    return read_table(spark, path).select(*CRM_COLUMNS, "_source", "_ingested_at")


@register("stream_land_events", build(f"""
SELECT event_id, event_type, anonymous_id, user_id, "timestamp", "properties.page",
       "properties.referrer", "properties.feature", "properties.duration_s", "context.device",
       "context.app_version", 'app_events' AS _source, '{RUN_1}' AS _ingested_at
FROM ev_src
"""))
def q_stream_land(spark, sf_dir):
    """Event documents landed by a file-source stream, availableNow,
    exactly-once through the checkpoint and the sink log."""
    src_path = scratch_path(spark, "src-events-json")
    target = scratch_path(spark, "bronze-events-stream")
    ckpt = scratch_path(spark, "ckpt-events-land")
    docs = adapter.app_events_source(spark, sf_dir)
    docs.write.option("timestampNTZFormat", streams.NTZ_FORMAT).json(src_path)
    q = streams.land_stream(spark, src_path, docs.schema, target, ckpt, "app_events", RUN_1)
    streams.run_to_end(q)
    # a second trigger with no new files lands nothing (exactly-once)
    streams.run_to_end(streams.land_stream(spark, src_path, docs.schema, target, ckpt,
                                           "app_events", RUN_1))
    return spark.read.parquet(target)


@register("stream_events_dedupe", build("""
SELECT DISTINCT event_id, event_type, anonymous_id, user_id, TRY_CAST("timestamp" AS TIMESTAMP) AS event_at
FROM bronze_app_events
"""))
def q_stream_dedupe(spark, sf_dir):
    """Event copies de-duplicated by a stream. The second trigger brings
    re-landed copies, old and recent, and ids never seen that are older than
    anything of the first; the third starts from a new checkpoint over all
    files. Every id comes out once."""
    bronze = adapter.bronze_app_events(spark, sf_dir)
    first_run = F.col("_ingested_at") == F.min("_ingested_at").over(Window.partitionBy("event_id"))
    late_id = F.col("event_id").cast("long") % 10 == 3
    marked = bronze.withColumn("_first", first_run & ~late_id)
    src_path = scratch_path(spark, "src-events-bronze")
    target = scratch_path(spark, "silver-events-stream")
    cols = ["event_id", "event_type", "anonymous_id", "user_id", "event_at"]
    first = marked.filter("_first").drop("_first")
    first.union(first.filter(F.col("event_id").cast("long") % 7 == 0)).write.parquet(src_path)   # copies in one trigger
    schema = spark.read.parquet(src_path).schema
    ckpt = scratch_path(spark, "ckpt-events-dedupe")
    streams.run_to_end(streams.dedupe_stream(spark, src_path, schema, target, ckpt, cols))
    marked.filter("NOT _first").drop("_first").write.mode("append").parquet(src_path)
    streams.run_to_end(streams.dedupe_stream(spark, src_path, schema, target, ckpt, cols))
    streams.run_to_end(streams.dedupe_stream(spark, src_path, schema, target, scratch_path(spark, "ckpt-events-again"), cols))
    return spark.read.parquet(target).select(*cols)


def write_source_files(spark, sf_dir) -> tuple[dict, dict]:
    """The five sources of the fixture as files in their native shapes (CSV
    export, billing JSON, relational extracts as Parquet, event documents as
    JSON lines) and a registry pointing at them."""
    p = adapter.people(spark, sf_dir)
    paths = {n: scratch_path(spark, f"src-{n}") for n in ["crm", "stripe", "users", "subs", "events"]}
    (adapter.crm_contacts_source(p).write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(paths["crm"]))
    adapter.stripe_customers_source(p).write.json(paths["stripe"])
    adapter.app_users_source(p).write.parquet(paths["users"])
    adapter.app_subscriptions_source(spark, sf_dir).write.parquet(paths["subs"])
    docs = adapter.app_events_source(spark, sf_dir)
    docs.write.option("timestampNTZFormat", streams.NTZ_FORMAT).json(paths["events"])
    reg = registry_with({
        "crm_contacts": AS_EXPORTED | {"path": paths["crm"]},
        "stripe_customers": {"path": paths["stripe"], "multi_line": False},
        "app_users": {"type": "parquet", "path": paths["users"]},
        "app_subscriptions": {"type": "parquet", "path": paths["subs"]},
        "app_events": {"path": paths["events"], "schema": docs.schema},
    })
    return reg, paths


@register("scheduled_run_mrr", build("SELECT * FROM mart_mrr"))
def q_scheduled_run(spark, sf_dir):
    """One scheduled run (ingest by registry -> silver -> SCD-2 snapshot
    -> gold -> checks and gates); returns the MRR mart. The fixture's noise
    fails some checks, so its gold is published all the same."""
    from tidemark.plans.q_dq import fixture_scale
    from tidemark.plans.runner import gold_table, run_pipeline
    reg, _ = write_source_files(spark, sf_dir)
    warehouse = scratch_path(spark, "warehouse")
    run_pipeline(spark, reg, warehouse, adapter.AS_OF, reference_now="2024-02-01 00:00:00",
                 scale=fixture_scale(spark, sf_dir), publish_failed=True)
    return gold_table(spark, warehouse, "mart_mrr")


@register("stream_scd2_snapshot", build("SELECT * FROM snap_two_runs"))
def q_stream_scd2(spark, sf_dir):
    """M8 as a stream: the landed subscription changes arrive in two
    triggers (landed up to 1998-01-01, then the rest); each micro-batch is
    one SCD-2 run applied in foreachBatch, once per epoch."""
    from tidemark.operators import silver
    from tidemark.streaming import subscriptions as scd_stream
    log = silver.subscription_log(adapter.bronze_app_subscriptions(spark, sf_dir))
    early = F.col("_ingested_at") <= F.lit("1998-01-01 00:00:00").cast("timestamp")
    src, root, ckpt = (scratch_path(spark, "src-sub-changes"), scratch_path(spark, "scd-stream"),
                       scratch_path(spark, "ckpt-scd-stream"))
    log.filter(early).write.parquet(src)
    schema = spark.read.parquet(src).schema
    streams.run_to_end(scd_stream.scd2_stream(spark, src, schema, root, ckpt))
    log.filter(~early).write.mode("append").parquet(src)
    streams.run_to_end(scd_stream.scd2_stream(spark, src, schema, root, ckpt))
    return scd_stream.read_history(spark, root)


@register("pipeline_reruns", build("SELECT * FROM snap_two_runs"))
def q_pipeline_reruns(spark, sf_dir):
    """S25, S28, N9, the subscription part of the scheduled run: a run, the
    same run again, a landing without a run, once more the same clock (with
    new data now, none of which may be lost), the next run, and a full refresh
    with an older clock. The history is that of two runs, and silver holds
    what bronze holds. (``tests/test_runner.py`` reruns the whole pipeline.)"""
    from tidemark.operators import silver
    from tidemark.plans import runner
    from tidemark.sources.landing import drop_table, reset
    warehouse, source = scratch_path(spark, "warehouse"), scratch_path(spark, "src-subs")
    subs = adapter.app_subscriptions_source(spark, sf_dir)
    early = F.col("updated_at") < F.lit("1997-12-01").cast("timestamp_ntz")   # landed by 1998-01-01
    reg = {"app_subscriptions": registry_with({"app_subscriptions": {"type": "parquet", "path": source}})["app_subscriptions"]}
    bronze = table_path(warehouse, reg["app_subscriptions"]["target_bronze"])
    state, root = f"{warehouse}/silver/subscriptions", f"{warehouse}/snapshots/scd_subscriptions"

    def run(as_of, full_refresh=False):
        if full_refresh:
            reset(spark, reg, warehouse)
            drop_table(spark, state)
        ingest(spark, reg, warehouse, run_ts=as_of)
        runner._subscriptions_run(spark, read_table(spark, bronze), state, {})
        return runner._history_run(spark, read_table(spark, bronze), root, as_of[:10].replace("-", ""), {})

    subs.filter(early).write.parquet(source)
    run("1998-01-01T00:00:00+00:00")
    run("1998-01-01T00:00:00+00:00")
    subs.filter(~early).write.mode("append").parquet(source)
    ingest(spark, reg, warehouse, run_ts="1998-06-01T00:00:00+00:00")
    run("1998-01-01T00:00:00+00:00")
    run("2001-09-01T00:00:00+00:00")
    snapshot = run("1999-01-01T00:00:00+00:00", full_refresh=True)
    key = ["subscription_id", "sub_updated_at"]
    assert spark.read.parquet(state).select(key).exceptAll(
        silver.subscriptions_latest(read_table(spark, bronze)).select(key)).isEmpty()
    return snapshot


@register("events_incremental_merge", build("""
SELECT event_id, event_type, anonymous_id, user_id,
       event_at + CASE WHEN CAST(event_id AS BIGINT) % 5 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END AS event_at
FROM silver_events
"""))
def q_events_merge(spark, sf_dir):
    """A fifth of the events land again with a corrected time; the
    merged table holds each id once, at its corrected date."""
    from tidemark.plans.runner import _events_run
    bronze = adapter.bronze_app_events(spark, sf_dir)
    path, rows = scratch_path(spark, "silver-events"), {}
    _events_run(spark, bronze, path, rows)
    again = (bronze.filter(F.col("event_id").cast("long") % 5 == 0)
             .withColumn("timestamp", F.date_format(F.col("timestamp").cast("timestamp") + F.expr("INTERVAL 3 DAYS"),
                                                    "yyyy-MM-dd HH:mm:ss.SSSSSS"))
             .withColumn("_ingested_at", F.lit("2030-01-01T00:00:00+00:00")))
    return _events_run(spark, bronze.unionByName(again), path, rows).select(
        "event_id", "event_type", "anonymous_id", "user_id", "event_at")
