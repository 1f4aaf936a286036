"""Core model queries: silver and gold tables and the marts."""

from __future__ import annotations

from tidemark.operators import gold, scd2
from tidemark.plans.oracle import build
from tidemark.plans.queries import lake, register
from tidemark.sources import adapter

AS_OF = adapter.AS_OF


@register("stg_crm_contacts", build("SELECT * FROM stg_crm_contacts"))
def q_stg_crm(spark, sf_dir):
    """M1: CRM contacts conformed."""
    return lake(spark, sf_dir).stg_crm_contacts


@register("stg_stripe_customers", build("SELECT * FROM stg_stripe_customers"))
def q_stg_stripe(spark, sf_dir):
    """M2: billing customers conformed (nested metadata flattened)."""
    return lake(spark, sf_dir).stg_stripe_customers


@register("stg_app_users", build("SELECT * FROM stg_app_users"))
def q_stg_app(spark, sf_dir):
    """M3: app users conformed (re-landed copies still present)."""
    return lake(spark, sf_dir).stg_app_users


@register("customers", build("SELECT * FROM customers"))
def q_customers(spark, sf_dir):
    """M4: union of the three sources, latest landing per source record."""
    return lake(spark, sf_dir).customers


@register("identity_map", build("SELECT * FROM identity_map"))
def q_identity(spark, sf_dir):
    """M5: deterministic identity resolution."""
    return lake(spark, sf_dir).identity_map


@register("subscriptions_latest", build("SELECT * FROM subscriptions"))
def q_subscriptions(spark, sf_dir):
    """M6: current state per subscription from the change log."""
    return lake(spark, sf_dir).subscriptions


@register("events_latest", build("SELECT * FROM silver_events"))
def q_events(spark, sf_dir):
    """M7: latest landed copy per event, flattened and typed."""
    return lake(spark, sf_dir).events


@register("scd2_from_log", build("SELECT * FROM scd_subscriptions"))
def q_scd_log(spark, sf_dir):
    """Subscription history rebuilt from the landed log, one snapshot
    run per landing batch."""
    return lake(spark, sf_dir).scd_subscriptions


@register("subscription_state_as_of", build(f"""
SELECT subscription_id, account_id, plan, status, sub_started_at, sub_updated_at, scd_id,
       valid_from, valid_to
FROM scd_subscriptions
WHERE valid_from <= TIMESTAMP '1998-06-30 12:00:00'
  AND (valid_to IS NULL OR valid_to > TIMESTAMP '1998-06-30 12:00:00')
"""))
def q_state_as_of(spark, sf_dir):
    """Each subscription's version valid at a point in time."""
    return scd2.state_as_of(lake(spark, sf_dir).scd_subscriptions, "1998-06-30 12:00:00")


@register("dim_customer", build("SELECT * FROM dim_customer"))
def q_dim(spark, sf_dir):
    """M9: golden record per person."""
    return lake(spark, sf_dir).dim_customer


@register("fact_subscriptions", build("SELECT * FROM fact_subscriptions"))
def q_fact(spark, sf_dir):
    """Subscription versions bridged to the person."""
    return lake(spark, sf_dir).fact_subscriptions


@register("mart_mrr", build("SELECT * FROM mart_mrr"))
def q_mrr(spark, sf_dir):
    """Monthly recurring revenue per plan."""
    return lake(spark, sf_dir).mart_mrr


@register("mart_ltv", build("SELECT * FROM mart_ltv"))
def q_ltv(spark, sf_dir):
    """Lifetime value to date per person (as of the fixture clock)."""
    return lake(spark, sf_dir).mart_ltv


@register("mart_funnel", build("SELECT * FROM mart_funnel"))
def q_funnel(spark, sf_dir):
    """Lead -> signup -> paid funnel."""
    return lake(spark, sf_dir).mart_funnel


@register("recon_billing_vs_app", build("SELECT * FROM recon_billing_vs_app"))
def q_recon(spark, sf_dir):
    """Billing vs app reconciliation."""
    return lake(spark, sf_dir).recon_billing_vs_app


@register("ltv_top_customers", build("""
SELECT * FROM mart_ltv
ORDER BY ltv_to_date DESC NULLS LAST, customer_key ASC NULLS LAST, active_subscriptions ASC NULLS LAST,
         current_mrr ASC NULLS LAST, tenure_months ASC NULLS LAST
LIMIT 20
"""))
def q_ltv_top(spark, sf_dir):
    """O1 / O3: the twenty people with the highest lifetime value (a top-n
    report: the limit is the feature; ties broken by every other column)."""
    return gold.report(lake(spark, sf_dir).mart_ltv, "mart_ltv", limit=20)


@register("scd2_all_changes", build("""
SELECT subscription_id, account_id, plan, status, sub_started_at, sub_updated_at, _ingested_at,
       md5(subscription_id || '|' || CAST(epoch_us(sub_updated_at) AS VARCHAR)) AS scd_id,
       sub_updated_at AS valid_from,
       lead(sub_updated_at) OVER (PARTITION BY subscription_id ORDER BY sub_updated_at) AS valid_to
FROM sub_log WHERE subscription_id IS NOT NULL AND sub_updated_at IS NOT NULL
"""))
def q_scd_all_changes(spark, sf_dir):
    """M8b / W4 without run grouping: every landed change is a version. The
    successor comes from the range-partitioned scan (no window over a whole
    key), so a subscription with a huge share of the changes is split."""
    return scd2.history_from_log(lake(spark, sf_dir).subscription_log, "subscription_id",
                                 "sub_updated_at")
