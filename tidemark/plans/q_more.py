"""Identity analyses, business measures, two-run SCD-2 and keyed upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import from_iso8601
from tidemark.operators import gold, scd2, silver
from tidemark.sources import adapter
from tidemark.sources.landing import upsert_frames
from tidemark.plans.oracle import build
from tidemark.plans.queries import fresh_lake, lake, register

SUB_PAYLOAD = ["subscription_id", "account_id", "plan", "status", "sub_started_at", "sub_updated_at"]
RUN1_CUT = "1998-01-01 00:00:00"


@register("source_overlap", build("""
SELECT in_crm, in_stripe, in_app, in_events, count(*) AS n_people,
       in_crm + in_stripe + in_app + in_events AS n_sources
FROM overlap_flags GROUP BY in_crm, in_stripe, in_app, in_events
"""))
def q_source_overlap(spark, sf_dir):
    """People per combination of sources (incl. the event log)."""
    lh = lake(spark, sf_dir)
    return silver.source_overlap(lh.identity_map, lh.events, lh.customers)


@register("anonymous_event_share", build("""
SELECT event_type, count(*) AS n_events, count(*) FILTER (WHERE user_id IS NULL) AS n_anonymous,
       round(100.0 * CAST(count(*) FILTER (WHERE user_id IS NULL) AS DOUBLE)
             / CAST(nullif(count(*), 0) AS DOUBLE), 2) AS pct_anonymous
FROM silver_events GROUP BY event_type
"""))
def q_anon_share(spark, sf_dir):
    """Share of events without a user id, per event type."""
    return silver.anonymous_event_share(lake(spark, sf_dir).events)


@register("orphan_known_events", build("""
SELECT count(*) AS n_known_events, count(*) FILTER (WHERE c.source_id IS NULL) AS n_orphan_events,
       round(100.0 * CAST(count(*) FILTER (WHERE c.source_id IS NULL) AS DOUBLE)
             / CAST(nullif(count(*), 0) AS DOUBLE), 2) AS pct_orphan
FROM silver_events e LEFT JOIN customers c ON c.source_system = 'app' AND c.source_id = e.user_id
WHERE e.user_id IS NOT NULL
"""))
def q_orphans(spark, sf_dir):
    """Events whose user id has no app customer record."""
    lh = lake(spark, sf_dir)
    return silver.orphan_known_events(lh.events, lh.customers)


@register("event_identity_stitch", build("""
SELECT e.event_id, e.anonymous_id, e.user_id,
       coalesce(e.user_id, l.linked_user_id) AS resolved_user_id, m.customer_key,
       CASE WHEN e.user_id IS NOT NULL THEN 'user'
            WHEN coalesce(e.user_id, l.linked_user_id) IS NOT NULL THEN 'anonymous_link'
            ELSE 'unresolved' END AS resolution
FROM silver_events e
LEFT JOIN anon_links l ON e.anonymous_id = l.anonymous_id
LEFT JOIN identity_map m ON m.source_system = 'app' AND m.source_id = coalesce(e.user_id, l.linked_user_id)
"""))
def q_stitch(spark, sf_dir):
    """Every event resolved to a person through anonymous id links; the
    log is de-duplicated once and written, then linked and joined."""
    lh = fresh_lake(spark, sf_dir)
    lh.materialize(["events", "identity_map"])
    return silver.event_identity_stitch(lh.events, lh.customers, lh.identity_map)


@register("churn_by_plan", build("""
SELECT plan, count(*) AS current_subscriptions,
       count(*) FILTER (WHERE status = 'canceled') AS canceled_subscriptions,
       round(CAST(count(*) FILTER (WHERE status = 'canceled') AS DOUBLE)
             / CAST(nullif(count(*), 0) AS DOUBLE), 3) AS churn_rate
FROM fact_subscriptions WHERE is_current GROUP BY plan
"""))
def q_churn(spark, sf_dir):
    """Share of current subscriptions that are canceled, per plan."""
    return gold.churn_by_plan(lake(spark, sf_dir).fact_subscriptions)


@register("conversion_durations", build("""
SELECT f.customer_key, f.lead_at, f.signup_at, p.first_paid_at,
       date_diff('day', CAST(f.lead_at AS DATE), CAST(f.signup_at AS DATE)) AS days_lead_to_signup,
       date_diff('day', CAST(f.signup_at AS DATE), CAST(p.first_paid_at AS DATE)) AS days_signup_to_paid
FROM (SELECT m.customer_key,
             min(CASE WHEN c.source_system = 'crm' THEN c.source_created_at END) AS lead_at,
             min(CASE WHEN c.source_system = 'app' THEN c.source_created_at END) AS signup_at
      FROM identity_map m JOIN customers c
        ON m.source_system = c.source_system AND m.source_id = c.source_id
      GROUP BY m.customer_key) f
LEFT JOIN (SELECT customer_key, min(valid_from) AS first_paid_at FROM fact_subscriptions
           WHERE customer_key IS NOT NULL AND status = 'active' AND plan <> 'free'
           GROUP BY customer_key) p
  ON f.customer_key = p.customer_key
"""))
def q_conversion(spark, sf_dir):
    """Lead -> signup -> first paid durations in days per person."""
    lh = lake(spark, sf_dir)
    return gold.conversion_durations(lh.customers, None, lh.fact_subscriptions)


@register("scd2_snapshot_two_runs", build("SELECT * FROM snap_two_runs"))
def q_snapshot_two_runs(spark, sf_dir):
    """The snapshot after two runs, the first seeing only the
    changes landed up to 1998-01-01, the second everything."""
    lh = lake(spark, sf_dir)
    log = lh.bronze["app_subscriptions"]
    run1 = silver.subscriptions_latest(
        log.filter(from_iso8601(F.col("_ingested_at")) <= F.lit(RUN1_CUT).cast("timestamp")))
    snap = scd2.snapshot_timestamp(None, run1.select(SUB_PAYLOAD), "subscription_id",
                                   "sub_updated_at")
    return scd2.snapshot_timestamp(snap, lh.subscriptions.select(SUB_PAYLOAD), "subscription_id",
                                   "sub_updated_at")


@register("upsert_latest", build("""
SELECT * FROM bronze_app_users
WHERE _ingested_at = '2001-08-31T18:00:00+00:00'
  AND user_id NOT IN (SELECT user_id FROM bronze_app_users WHERE _ingested_at = '2001-08-31T20:00:00+00:00')
UNION ALL
SELECT * FROM bronze_app_users WHERE _ingested_at = '2001-08-31T20:00:00+00:00'
"""))
def q_upsert(spark, sf_dir):
    """Keyed upsert landing on the primary key (user_id)."""
    first, again = adapter.app_users_runs(spark, sf_dir)
    return upsert_frames(first, again, ["user_id"])


@register("upsert_repeated_keys", build("""
SELECT * REPLACE (CASE WHEN _ingested_at = '2001-08-31T20:00:00+00:00' AND CAST(user_id AS BIGINT) % 3 = 0 THEN 'ZZ' ELSE country END AS country,
                  CASE WHEN _ingested_at = '2001-08-31T20:00:00+00:00' AND CAST(user_id AS BIGINT) % 3 = 0 THEN '2001-08-31T21:00:00+00:00' ELSE _ingested_at END AS _ingested_at)
FROM bronze_app_users
WHERE _ingested_at = '2001-08-31T20:00:00+00:00'
   OR user_id NOT IN (SELECT user_id FROM bronze_app_users WHERE _ingested_at = '2001-08-31T20:00:00+00:00')
"""))
def q_upsert_repeated(spark, sf_dir):
    """A batch that brings keys twice, and rows the table has twice: one
    row per key, the latest landed."""
    first, again = adapter.app_users_runs(spark, sf_dir)
    later = (again.filter(F.col("user_id").cast("long") % 3 == 0)
             .withColumn("country", F.lit("ZZ")).withColumn("_ingested_at", F.lit("2001-08-31T21:00:00+00:00")))
    return upsert_frames(first.union(first), later.union(again).union(again), ["user_id"])


@register("dim_customer_joined", build("SELECT * FROM dim_customer"))
def q_dim_joined(spark, sf_dir):
    """The golden record through the stored identity map, an inner join
    on (source_system, source_id)."""
    lh = lake(spark, sf_dir)
    return gold.dim_customer(lh.identity_map, lh.customers)
