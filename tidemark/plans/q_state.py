"""Queries over stored, incrementally kept state, and the analyses built on
several keys, many instants or two sides of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import components, gold, reconcile, scd2, sketch, timeline
from tidemark.plans.gold_store import CODEC, GoldStore
from tidemark.plans.oracle import build
from tidemark.plans.queries import fresh_lake, lake, register
from tidemark.plans.scd_store import BucketedHistory
from tidemark.session import scratch_path
from tidemark.sources import adapter
from tidemark.sources.json_array import read_split_array
from tidemark.sources.landing import ingest, read_table, table_path
from tidemark.sources.registry import registry_with

TIES = ("plan", "status", "account_id")


@register("scd2_bucketed_runs", build("SELECT * FROM scd_four_runs"))
def q_scd2_bucketed(spark, sf_dir):
    """Four runs over bucketed state, each bringing the changes landed
    since the one before; the third comes twice, the fourth under its label."""
    log = lake(spark, sf_dir).subscription_log
    root = scratch_path(spark, "scd-buckets")
    history = BucketedHistory(spark, root, "subscription_id", "sub_updated_at", buckets=16, ties=TIES)
    ends = ["1994-06-01", "1996-06-01", "1998-06-01", "9999-01-01"]
    at = F.col("_ingested_at")
    bounds = [F.lit(e).cast("timestamp") for e in ["0001-01-01", *ends]]
    for n in (0, 1, 2, 2, 3):
        batch = log.filter((at > bounds[n]) & (at <= bounds[n + 1])).drop("_ingested_at")
        history.apply(batch, ends[min(n, 2)])
    return history.read()


@register("subscription_states_at", build("""
SELECT a.as_of, s.subscription_id, s.account_id, s.plan, s.status, s.valid_from
FROM (SELECT DISTINCT date_trunc('month', valid_from) + INTERVAL 1 MONTH AS as_of FROM scd_subscriptions) a
JOIN scd_subscriptions s ON s.valid_from <= a.as_of AND (s.valid_to IS NULL OR a.as_of < s.valid_to)
"""))
def q_states_at(spark, sf_dir):
    """The state of every subscription at every month's end."""
    path = scratch_path(spark, "states-history")
    lake(spark, sf_dir).scd_subscriptions.select("subscription_id", "account_id", "plan", "status", "valid_from", "valid_to").write.parquet(path)
    history = spark.read.parquet(path)
    ends = history.select((F.date_trunc("month", "valid_from") + F.expr("INTERVAL 1 MONTH")).alias("as_of")).distinct()
    return scd2.states_at(history, ends, "as_of").drop("valid_to")


def report_all(read) -> DataFrame:
    """Every gold model in one long table: model, key, who, n1, n2, n3."""
    long = lambda c: F.col(c).cast("bigint") if isinstance(c, str) else c.cast("bigint")
    def rows(df, model, key, who, *ns):
        nums = [*ns, *[F.lit(None)] * (3 - len(ns))]
        return df.select(F.lit(model).alias("model"), F.col(key).alias("key") if key else F.lit("all").alias("key"),
                         (F.col(who) if who else F.lit(None).cast("string")).alias("who"),
                         *[(long(n)).alias(f"n{k}") for k, n in enumerate(nums, 1)])
    parts = [
        rows(read("dim_customer"), "dim_customer", "customer_key", "account_id", "n_source_records",
             F.col("in_crm") * 4 + F.col("in_stripe") * 2 + F.col("in_app"), F.unix_seconds("first_seen_at")),
        rows(read("fact_subscriptions"), "fact_subscriptions", "subscription_version_key", "customer_key", F.col("is_current").cast("int"),
             F.unix_micros("valid_from"), F.unix_micros("valid_to")),
        rows(read("mart_ltv"), "mart_ltv", "customer_key", None, "current_mrr", "tenure_months", "ltv_to_date"),
        rows(read("mart_mrr"), "mart_mrr", "plan", None, "active_subscriptions", "mrr"),
        rows(read("mart_funnel"), "mart_funnel", None, None, "leads", "signups", "paid"),
        rows(read("recon_billing_vs_app"), "recon_billing_vs_app", "recon_status", None, "n_customers"),
    ]
    return reduce(DataFrame.unionByName, parts)


@register("gold_incremental", build("""
SELECT 'dim_customer' AS model, customer_key AS key, account_id AS who, n_source_records::BIGINT AS n1,
       (in_crm * 4 + in_stripe * 2 + in_app)::BIGINT AS n2, epoch(first_seen_at)::BIGINT AS n3 FROM dim_customer
UNION ALL
SELECT 'fact_subscriptions', subscription_version_key, customer_key, is_current::INT::BIGINT, epoch_us(valid_from), epoch_us(valid_to)
FROM fact_subscriptions
UNION ALL
SELECT 'mart_ltv', customer_key, NULL, current_mrr, tenure_months, ltv_to_date FROM mart_ltv
UNION ALL
SELECT 'mart_mrr', plan, NULL, active_subscriptions, mrr, NULL FROM mart_mrr
UNION ALL
SELECT 'mart_funnel', 'all', NULL, leads, signups, paid FROM mart_funnel
UNION ALL
SELECT 'recon_billing_vs_app', recon_status, NULL, n_customers, NULL, NULL FROM recon_billing_vs_app
"""))
def q_gold_incremental(spark, sf_dir):
    """Gold of an earlier state, then one run of changes: mistyped
    e-mails put right (two people become one), contacts that come late,
    billing records withdrawn, and all subscription changes since 1998,
    cancellations among them. Equal to a build from the final state."""
    lh = fresh_lake(spark, sf_dir)
    lh.materialize(["customers"])
    final = lh.customers
    number = F.col("source_id").cast("long")
    typo = (F.col("source_system") == "app") & (number % 13 == 0)
    late = (F.col("source_system") == "crm") & (F.col("campaign") == "cmp_2")
    ghosts = final.filter("source_system = 'stripe'").filter(F.xxhash64("source_id") % 17 == 0).withColumn(
        "source_id", F.concat(F.lit("ghost_"), "source_id"))
    earlier = final.filter(~F.coalesce(late, F.lit(False))).withColumn("email_hash", F.when(
        typo, F.upper(F.sha2(F.concat(F.lit("typo"), F.col("source_id")).cast("binary"), 256))).otherwise(F.col("email_hash"))).unionByName(ghosts)
    path = scratch_path(spark, "gold-history")
    lh.subscription_log.write.options(**CODEC).parquet(f"{path}/log")
    log = spark.read.parquet(f"{path}/log")
    rebuilt = lambda rows: scd2.history_from_log(rows, "subscription_id", "sub_updated_at", batch="_ingested_at",
                                                 tie_break=list(TIES))
    rebuilt(log.filter(F.col("_ingested_at") <= F.lit("1998-01-01 00:00:00").cast("timestamp"))).write.options(**CODEC).parquet(f"{path}/before")
    before, after = spark.read.parquet(f"{path}/before"), rebuilt(log)
    store = GoldStore(spark, scratch_path(spark, "gold-store"), lh.pricing, lh.as_of, buckets=16)
    store.apply(earlier, before, "before")
    put_right = final.filter(F.coalesce(typo | late, F.lit(False))).withColumn("_deleted", F.lit(False)).unionByName(
        ghosts.withColumn("_deleted", F.lit(True)))
    # versions of later runs start after those before; of these only the open ones can end
    was = before.filter("valid_to IS NULL").select("subscription_id", F.col("valid_from").alias("was_from"))
    moved = after.join(was, "subscription_id", "left").filter(
        F.col("was_from").isNull() | (F.col("valid_from") > F.col("was_from")) |
        ((F.col("valid_from") == F.col("was_from")) & F.col("valid_to").isNotNull())).drop("was_from")
    store.apply(put_right, moved, "after")
    return report_all(store.read)


@register("identity_components", build("""
SELECT node, component, count(*) OVER g AS n_nodes, count(*) FILTER (WHERE node LIKE 'record:%') OVER g AS n_records, n_links,
       n_links > 1000 AND node NOT LIKE 'record:%' AS is_hub, max(n_links > 1000 AND node NOT LIKE 'record:%') OVER g AS via_hub
FROM (
  WITH RECURSIVE both_ways AS (SELECT a AS u, b AS v FROM identity_links UNION SELECT b, a FROM identity_links),
  reached AS (SELECT u AS node, u AS other FROM both_ways UNION SELECT r.node, w.v FROM reached r JOIN both_ways w ON w.u = r.other)
  SELECT node, min(other) AS component, any_value(n_links) AS n_links
  FROM reached JOIN (SELECT u, count(*) AS n_links FROM both_ways GROUP BY u) d ON d.u = node GROUP BY node) found
WINDOW g AS (PARTITION BY component)
"""))
def q_identity_components(spark, sf_dir):
    """M5 over e-mail, account, user and anonymous id at once."""
    lh = lake(spark, sf_dir)
    path = scratch_path(spark, "identity-links")
    components.identity_links(lh.customers, lh.events).write.parquet(path)
    return components.identity_components(spark.read.parquet(path))


@register("event_identity_timeline", build("""
SELECT event_id, anonymous_id, user_id, event_at, coalesce(user_id, upcoming, former) AS resolved_user_id,
       CASE WHEN user_id IS NOT NULL THEN 'user' WHEN upcoming IS NOT NULL THEN 'next_login'
            WHEN former IS NOT NULL THEN 'last_login' ELSE 'unresolved' END AS resolution
FROM (SELECT *, first_value(user_id IGNORE NULLS) OVER (device ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS upcoming,
             last_value(user_id IGNORE NULLS) OVER (device ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS former
      FROM device_events WINDOW device AS (PARTITION BY anonymous_id ORDER BY event_at NULLS FIRST, event_id)) w
"""))
def q_event_timeline(spark, sf_dir):
    """E2 in time order, on devices that many people share."""
    number = F.substring("anonymous_id", 6, 20).cast("long")
    shared = lake(spark, sf_dir).events.withColumn("anonymous_id", F.when(number % 3 == 0, "kiosk").otherwise(
        F.concat(F.lit("dev_"), (number % 97).cast("string"))))
    return timeline.event_timeline(shared)


@register("reconcile_source", build("""
SELECT k + 10000 AS user_id, CASE k % 1000 WHEN 7 THEN 'missing' WHEN 14 THEN 'deleted' ELSE 'changed' END AS status
FROM people WHERE k % 10 <> 3 AND k % 1000 IN (7, 11, 14)
"""))
def q_reconcile(spark, sf_dir):
    """What a watermark load cannot see. After the first
    landing some users come late with an old time, some are edited, some
    deleted; the next landing takes none of it, reconciliation finds it all."""
    users = adapter.app_users_source(adapter.people(spark, sf_dir))
    k = F.col("user_id") - 10000
    warehouse = scratch_path(spark, "warehouse")
    def land(rows, n):
        path = scratch_path(spark, f"src-users-{n}")
        rows.write.parquet(path)
        reg = registry_with({"app_users": {"type": "parquet", "path": path}})
        ingest(spark, reg, warehouse, names=["app_users"], run_ts=f"2001-09-0{n}T00:00:00+00:00")
        return spark.read.parquet(path), reg
    land(users.filter(k % 1000 != 7), 1)
    now, reg = land(users.filter(k % 1000 != 14).withColumn("created_at", F.when(
        k % 1000 == 7, F.lit("1992-01-01").cast("timestamp_ntz")).otherwise(F.col("created_at"))).withColumn(
        "first_name", F.when(k % 1000 == 11, "Edited").otherwise(F.col("first_name"))), 2)
    landed = read_table(spark, table_path(warehouse, reg["app_users"]["target_bronze"]))
    return reconcile.reconcile(now, landed, "user_id", ["account_id", "email", "first_name", "last_name", "country"], ranges=32, leaf=64)


@register("source_overlap_sketched", build("""
SELECT a.source_system AS source_a, b.source_system AS source_b, count(*) AS n_people, true AS within_bound
FROM (SELECT DISTINCT customer_key, source_system FROM identity_map) a
JOIN (SELECT DISTINCT customer_key, source_system FROM identity_map) b ON a.customer_key = b.customer_key AND a.source_system <= b.source_system GROUP BY ALL
"""))
def q_overlap_sketched(spark, sf_dir):
    """Overlaps from sketches stored per run and source, next to
    the exact counts; the error stays within the stated bound."""
    records = gold.keyed_records(lake(spark, sf_dir).customers)
    path = scratch_path(spark, "person-sketches")
    sketch.person_sketches(records, F.col("_ingested_at")).write.parquet(path)
    estimated = sketch.overlaps(sketch.merged(spark.read.parquet(path)))
    seen = records.groupBy("customer_key").agg(F.array_sort(F.collect_set("source_system")).alias("sources"))
    exact = seen.select(F.explode("sources").alias("source_a"), "sources").select("source_a", F.explode("sources").alias("source_b")).filter(
        "source_a <= source_b").groupBy("source_a", "source_b").agg(F.count(F.lit(1)).alias("n_people"))
    return estimated.join(exact, ["source_a", "source_b"]).select(
        "source_a", "source_b", "n_people",
        (F.abs(F.col("people") - F.col("n_people")) <= sketch.error_bound() * F.col("united")).alias("within_bound"))


ODD_TEXT = ' "q" }],{[ \\'


def write_json_array(spark, rows: DataFrame, path: str) -> None:
    """``rows`` (column ``ord``, unique, and others) as one file with one array."""
    first = rows.agg(F.min("ord")).first()[0]
    line = F.to_json(F.struct(*[c for c in rows.columns if c != "ord"]))
    lines = rows.select("ord", F.when(F.col("ord") == first, F.concat(F.lit("[ "), line)).otherwise(F.concat(F.lit(", "), line)).alias("value"))
    end = rows.agg((F.max("ord") + 1).alias("ord")).select("ord", F.lit("]").alias("value"))
    lines.union(end).repartition(1).sortWithinPartitions("ord").select("value").write.text(path)


@register("scan_json_array", build(f"""
SELECT id, object, email, name || '{ODD_TEXT}' || "metadata.country" AS name, CAST(created AS BIGINT) AS created,
       "metadata.country" AS country FROM bronze_stripe_customers
"""))
def q_scan_json_array(spark, sf_dir):
    """One JSON array in one file, read by several tasks; quotes, escapes,
    braces and brackets inside its texts."""
    source = adapter.stripe_customers_source(adapter.people(spark, sf_dir))
    odd = source.withColumn("name", F.concat("name", F.lit(ODD_TEXT), "metadata.country"))
    path, key = scratch_path(spark, "src-json-array"), "spark.sql.files.maxPartitionBytes"
    write_json_array(spark, odd.withColumn("ord", F.substring("id", 5, 20).cast("long")), path)
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        records = read_split_array(spark, path, odd.schema)
    finally:
        spark.conf.set(key, before)
    return records.select("id", "object", "email", "name", "created", F.col("metadata.country").alias("country"))
