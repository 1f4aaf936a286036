"""The model's data-quality rule sets, as data.

Thresholds are the business's fixed values. Row-count bands and the
total-MRR band describe a business of a given size, so they are marked
``"scaled"`` and multiplied by the ``scale`` given to ``run_checks``
(1.0 = the original size) instead of being hard-coded for one volume.

Each custom metric carries its Spark form (a function of the tables, or an
aggregate expression) and, for the SQL oracle, the same metric as SQL text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import from_iso8601, hours_between, pct
from tidemark.operators import silver
from tidemark.operators.dq import Check, count_of, relationship_violations, scalars

BRONZE = "bronze"
SILVER = "silver"
GOLD = "gold"


def _band(a, b):
    """Outside [a, b] at the run's scale."""
    return ("not_between", a, b, "scaled")


def _at_least(a):
    return ("lt", a, "scaled")


# ---------------------------------------------------------------- bronze
def _hours_since_ingest(now):
    return hours_between(F.max(from_iso8601(F.col("_ingested_at"))), now)


def _pct_duplicate(col):
    def expr(_now):
        n = F.count(F.lit(1))
        return F.round(F.lit(100.0) * (n - F.count_distinct(F.col(col))).cast("double")
                       / F.when(n != 0, n.cast("double")), 2)
    return expr


def _hours_since_last_event(now):
    return hours_between(F.max(F.col("timestamp").try_cast("timestamp")), now)


SQL_HOURS_SINCE_INGEST = ("datesub('hour', max(TRY_CAST(_ingested_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC'), "
                          "{now})")


def _sql_pct_dup(col):
    return (f"round(100.0 * CAST(count(*) - count(DISTINCT {col}) AS DOUBLE) "
            f"/ CAST(nullif(count(*), 0) AS DOUBLE), 2)")


def bronze_checks() -> list[Check]:
    crm, stripe, users, subs, ev = ("crm_contacts", "stripe_customers", "app_users",
                                    "app_subscriptions", "app_events")
    hours = dict(expr=_hours_since_ingest, sql=SQL_HOURS_SINCE_INGEST)
    return [
        Check(BRONZE, crm, "row_count", "row_count", fail=_band(400, 1000)),
        Check(BRONZE, crm, "missing_count(contact_email)", "missing_count", "contact_email",
              fail=("ne", 0)),
        Check(BRONZE, crm, "duplicate_count(contact_email)", "duplicate_count", "contact_email",
              fail=("ne", 0)),
        Check(BRONZE, crm, "schema", "schema", fail=("gt", 0),
              params={"required": ["contact_email", "first_name", "company", "created_date"]}),
        Check(BRONZE, crm, "hours_since_ingest", "aggregate", warn=("gt", 30), fail=("gt", 48),
              params=hours),
        Check(BRONZE, crm, "column_count", "column_count", fail=("ne", 10)),

        Check(BRONZE, stripe, "row_count", "row_count", fail=_band(250, 700)),
        Check(BRONZE, stripe, "missing_count(email)", "missing_count", "email", fail=("ne", 0)),
        Check(BRONZE, stripe, "missing_count(id)", "missing_count", "id", fail=("ne", 0)),
        Check(BRONZE, stripe, "duplicate_count(id)", "duplicate_count", "id", fail=("ne", 0)),
        Check(BRONZE, stripe, "duplicate_count(email)", "duplicate_count", "email", fail=("ne", 0)),
        Check(BRONZE, stripe, "schema", "schema", fail=("gt", 0),
              params={"required": ["id", "email", "name", "created", "metadata.country"]}),
        Check(BRONZE, stripe, "hours_since_ingest", "aggregate", warn=("gt", 30), fail=("gt", 48),
              params=hours),

        Check(BRONZE, users, "row_count", "row_count", fail=_at_least(400)),
        Check(BRONZE, users, "missing_count(user_id)", "missing_count", "user_id", fail=("ne", 0)),
        Check(BRONZE, users, "missing_count(account_id)", "missing_count", "account_id",
              fail=("ne", 0)),
        Check(BRONZE, users, "missing_count(email)", "missing_count", "email", fail=("ne", 0)),
        Check(BRONZE, users, "pct_duplicate_user_id", "aggregate", warn=("gt", 2), fail=("gt", 20),
              params=dict(expr=_pct_duplicate("user_id"), sql=_sql_pct_dup("user_id"))),
        Check(BRONZE, users, "schema", "schema", fail=("gt", 0),
              params={"required": ["user_id", "account_id", "email", "first_name", "last_name",
                                   "country", "created_at"]}),

        Check(BRONZE, subs, "row_count", "row_count", fail=_at_least(400)),
        Check(BRONZE, subs, "dup_subscription_id_within_batch", "duplicate_count", fail=("ne", 0),
              params={"columns": ["_ingested_at", "subscription_id"], "ignore_nulls": False}),
        Check(BRONZE, subs, "missing_count(account_id)", "missing_count", "account_id",
              fail=("ne", 0)),
        Check(BRONZE, subs, "schema", "schema", fail=("gt", 0),
              params={"required": ["subscription_id", "account_id", "plan", "status", "started_at",
                                   "updated_at"]}),

        Check(BRONZE, ev, "row_count", "row_count", fail=_at_least(9000)),
        Check(BRONZE, ev, "missing_count(event_id)", "missing_count", "event_id", fail=("ne", 0)),
        Check(BRONZE, ev, "missing_count(anonymous_id)", "missing_count", "anonymous_id",
              fail=("ne", 0)),
        Check(BRONZE, ev, "missing_count(event_type)", "missing_count", "event_type",
              fail=("ne", 0)),
        Check(BRONZE, ev, "pct_duplicate_event_id", "aggregate", warn=("gt", 2), fail=("gt", 20),
              params=dict(expr=_pct_duplicate("event_id"), sql=_sql_pct_dup("event_id"))),
        Check(BRONZE, ev, "missing_percent(user_id)", "missing_percent", "user_id",
              fail=("not_between", 15, 35)),
        Check(BRONZE, ev, "schema", "schema", fail=("gt", 0),
              params={"required": ["event_id", "event_type", "anonymous_id", "user_id", "timestamp"]}),
        Check(BRONZE, ev, "hours_since_last_event", "aggregate",
              warn=("not_between", 0, 26), fail=("not_between", 0, 50),
              params=dict(expr=_hours_since_last_event, clock="reference",
                          sql="datesub('hour', max(TRY_CAST(\"timestamp\" AS TIMESTAMP)), {now})")),
    ]


# ---------------------------------------------------------------- silver
def _pct_rows_lost(t, _now):
    b = scalars(crm=count_of(t["crm_contacts"]), stripe=count_of(t["stripe_customers"]),
                app=count_of(t["app_users"]), silver=count_of(t["customers"]))
    bronze_n = F.col("crm") + F.col("stripe") + F.col("app")
    return b.select(pct(bronze_n - F.col("silver"), bronze_n).alias("value"))


def _gap(a, b):
    def metric(t, _now):
        return scalars(a=count_of(t[a]), b=count_of(t[b])).select(
            (F.col("a") - F.col("b")).alias("value"))
    return metric


def _pct_orphan(t, _now):
    return silver.orphan_known_events(t["events"], t["customers"]).select(
        F.col("pct_orphan").alias("value"))


def _resolution_rate(_now):
    return F.round(F.count_distinct("customer_key").cast("double")
                   / F.count(F.lit(1)).cast("double"), 3)


PII_OK = "email_masked not like '_***@%'"


def silver_checks() -> list[Check]:
    return [
        Check(SILVER, "customers", "row_count", "row_count", fail=_at_least(1000)),
        Check(SILVER, "customers", "freshness(_ingested_at)", "freshness", "_ingested_at",
              warn=("gt", 36), fail=("gt", 48)),
        Check(SILVER, "customers", "pct_rows_lost_from_bronze", "metric", warn=("gt", 0),
              fail=("gt", 5), params=dict(metric=_pct_rows_lost, sql=(
                  "SELECT round(-100.0 * sum(side) / nullif(count(*) FILTER (WHERE side < 0), 0)::DOUBLE, 2) "
                  "FROM (SELECT 1 AS side FROM customers "
                  "UNION ALL SELECT -1 FROM bronze_crm_contacts UNION ALL SELECT -1 FROM bronze_stripe_customers "
                  "UNION ALL SELECT -1 FROM bronze_app_users) landed_and_kept"))),
        Check(SILVER, "customers", "pii_guard_masked_email", "failed_rows", fail=("gt", 0),
              params=dict(condition=lambda: ~F.col("email_masked").like("_***@%"), sql=PII_OK)),

        Check(SILVER, "identity_map", "row_count", "row_count", fail=_at_least(1000)),
        Check(SILVER, "identity_map", "resolution_rate", "aggregate",
              warn=("not_between", 0.30, 0.60),
              params=dict(expr=_resolution_rate,
                          sql="round(CAST(count(DISTINCT customer_key) AS DOUBLE) / "
                              "CAST(count(*) AS DOUBLE), 3)")),
        Check(SILVER, "identity_map", "identity_map_gap_vs_customers", "metric", fail=("ne", 0),
              params=dict(metric=_gap("identity_map", "customers"),
                          sql="SELECT coalesce(sum(side), 0) FROM (SELECT 1 AS side FROM identity_map "
                              "UNION ALL SELECT -1 FROM customers) both_sides")),

        Check(SILVER, "subscriptions", "row_count", "row_count", fail=_at_least(400)),
        Check(SILVER, "subscriptions", "missing_count(sub_started_at)", "missing_count",
              "sub_started_at", fail=("ne", 0)),
        Check(SILVER, "subscriptions", "missing_count(sub_updated_at)", "missing_count",
              "sub_updated_at", fail=("ne", 0)),
        Check(SILVER, "subscriptions", "updated_not_before_started", "failed_rows", fail=("gt", 0),
              params=dict(condition=lambda: F.col("sub_updated_at") < F.col("sub_started_at"),
                          sql="sub_updated_at < sub_started_at")),

        Check(SILVER, "events", "row_count", "row_count", fail=_at_least(9000)),
        Check(SILVER, "events", "missing_count(event_at)", "missing_count", "event_at",
              fail=("ne", 0)),
        Check(SILVER, "events", "invalid_count(duration_s)", "invalid_count", "duration_s",
              fail=("ne", 0), params={"valid_min": 0}),
        Check(SILVER, "events", "missing_percent(user_id)", "missing_percent", "user_id",
              fail=("not_between", 15, 35)),
        Check(SILVER, "events", "pct_orphan_known_events", "metric", warn=("gt", 12),
              fail=("gt", 15), params=dict(metric=_pct_orphan, sql=(
                  "SELECT round(100.0 * sum(n) FILTER (WHERE user_id NOT IN "
                  "(SELECT source_id FROM customers WHERE source_system = 'app' AND source_id IS NOT NULL)) "
                  "/ sum(n)::DOUBLE, 2) FROM (SELECT user_id, count(*) AS n FROM silver_events "
                  "WHERE user_id IS NOT NULL GROUP BY user_id) per_user"))),
    ]


# ---------------------------------------------------------------- gold
def _customers_lost(t, _now):
    ids = t["identity_map"].agg(F.count_distinct("customer_key").alias("n"))
    return scalars(a=ids, b=count_of(t["dim_customer"])).select(
        (F.col("a") - F.col("b")).alias("value"))


def _subs_lost(t, _now):
    cur = t["fact_subscriptions"].agg(F.count_if(F.col("is_current")).alias("n"))
    return scalars(a=count_of(t["subscriptions"]), b=cur).select(
        (F.col("a") - F.col("b")).alias("value"))


def _arpu(t, _now):
    mrr = t["mart_mrr"].agg(F.sum("mrr").alias("n"))
    return scalars(a=mrr, b=count_of(t["dim_customer"])).select(
        F.round(F.col("a") / F.when(F.col("b") != 0, F.col("b")), 2).alias("value"))


def gold_checks() -> list[Check]:
    return [
        Check(GOLD, "dim_customer", "customers_lost_from_silver", "metric", fail=("ne", 0),
              params=dict(metric=_customers_lost, sql=(
                  "SELECT coalesce(sum(side), 0) FROM (SELECT 1 AS side FROM (SELECT DISTINCT customer_key "
                  "FROM identity_map WHERE customer_key IS NOT NULL) known "
                  "UNION ALL SELECT -1 FROM dim_customer) both_sides"))),
        Check(GOLD, "dim_customer", "n_source_records_equals_flags", "failed_rows", fail=("gt", 0),
              params=dict(condition=lambda: F.col("n_source_records")
                          != F.col("in_crm") + F.col("in_stripe") + F.col("in_app"),
                          sql="n_source_records <> (in_crm + in_stripe + in_app)")),
        Check(GOLD, "dim_customer", "pii_guard_masked_email", "failed_rows", fail=("gt", 0),
              params=dict(condition=lambda: ~F.col("email_masked").like("_***@%"), sql=PII_OK)),

        Check(GOLD, "fact_subscriptions", "scd2_history_versions", "aggregate", warn=("lt", 1),
              params=dict(expr=lambda _n: F.count(F.lit(1)) - F.count_if(F.col("is_current")),
                          sql="count(*) - count(*) FILTER (WHERE is_current)")),
        Check(GOLD, "fact_subscriptions", "subscriptions_lost_in_scd2", "metric", fail=("ne", 0),
              params=dict(metric=_subs_lost, sql=(
                  "SELECT coalesce(sum(side), 0) FROM (SELECT 1 AS side FROM subscriptions "
                  "UNION ALL SELECT -1 FROM fact_subscriptions WHERE is_current) both_sides"))),

        Check(GOLD, "mart_mrr", "row_count", "row_count", fail=("ne", 4)),
        Check(GOLD, "mart_mrr", "total_mrr", "aggregate", warn=_band(30000, 50000),
              fail=_band(20000, 80000),
              params=dict(expr=lambda _n: F.sum("mrr"), sql="sum(mrr)")),
        Check(GOLD, "mart_mrr", "arpu_per_customer", "metric", warn=("not_between", 55, 90),
              params=dict(metric=_arpu, sql=(
                  "SELECT round(sum(revenue) / nullif(sum(people), 0)::DOUBLE, 2) "
                  "FROM (SELECT mrr AS revenue, 0 AS people FROM mart_mrr "
                  "UNION ALL SELECT 0, 1 FROM dim_customer) per_head"))),
        Check(GOLD, "mart_mrr", "top_plan_revenue_share", "aggregate", warn=("gt", 85),
              params=dict(expr=lambda _n: pct(F.max("mrr"), F.sum("mrr")),
                          sql="round(100.0 * CAST(max(mrr) AS DOUBLE) / "
                              "CAST(nullif(sum(mrr), 0) AS DOUBLE), 2)")),

        Check(GOLD, "mart_funnel", "row_count", "row_count", fail=("ne", 1)),
        Check(GOLD, "mart_funnel", "conversion_rates_in_band", "failed_rows", fail=("gt", 0),
              params=dict(condition=lambda: (~F.col("lead_to_signup_rate").between(0.6, 0.95))
                          | (~F.col("signup_to_paid_rate").between(0.4, 0.85)),
                          sql="lead_to_signup_rate NOT BETWEEN 0.6 AND 0.95 OR "
                              "signup_to_paid_rate NOT BETWEEN 0.4 AND 0.85")),

        Check(GOLD, "recon_billing_vs_app", "row_count", "row_count", fail=("ne", 4)),
        Check(GOLD, "recon_billing_vs_app", "pct_revenue_leakage", "aggregate", warn=("gt", 20),
              fail=("gt", 30),
              params=dict(expr=lambda _n: pct(
                  F.sum(F.when(F.col("recon_status").like("3_app_only%"), F.col("n_customers"))
                        .otherwise(0)), F.sum("n_customers")),
                  sql="round(100.0 * CAST(sum(CASE WHEN recon_status LIKE '3_app_only%' "
                      "THEN n_customers ELSE 0 END) AS DOUBLE) / "
                      "CAST(nullif(sum(n_customers), 0) AS DOUBLE), 2)")),
    ]


# ---------------------------------------------------------------- model tests
def _rel(child, col, parent, field):
    def metric(t, _now):
        return count_of(relationship_violations(t[child], col, t[parent], field))
    sql = (f"SELECT count(*) FROM {{{child}}} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
           f"(SELECT 1 FROM {{{parent}}} p WHERE p.{field} = c.{col})")
    return dict(metric=metric, sql=sql)


def _t(layer, table, col, kind, **params):
    name = f"{kind}({col})"
    return Check(layer, table, name, kind, col, fail=("gt", 0), params=params)


# The accepted value lists of the model tests.
PLAN_VALUES = ["free", "basic", "pro", "enterprise"]
STATUS_VALUES = ["active", "canceled"]
SOURCE_VALUES = ["crm", "stripe", "app"]
EVENT_TYPE_VALUES = ["page_view", "feature_click", "session"]


def model_tests() -> list[Check]:
    S, G = SILVER, GOLD
    return [
        _t(S, "customers", "source_system", "not_null"),
        _t(S, "customers", "source_system", "accepted_values", values=SOURCE_VALUES),
        _t(S, "customers", "source_id", "not_null"),
        _t(S, "customers", "email_hash", "not_null"),
        _t(S, "subscriptions", "subscription_id", "unique"),
        _t(S, "subscriptions", "subscription_id", "not_null"),
        _t(S, "subscriptions", "account_id", "not_null"),
        _t(S, "subscriptions", "plan", "accepted_values", values=PLAN_VALUES),
        _t(S, "subscriptions", "status", "accepted_values", values=STATUS_VALUES),
        _t(S, "events", "event_id", "unique"),
        _t(S, "events", "event_id", "not_null"),
        _t(S, "events", "event_type", "accepted_values", values=EVENT_TYPE_VALUES),
        _t(S, "identity_map", "customer_key", "not_null"),
        _t(S, "identity_map", "source_id", "not_null"),
        _t(S, "identity_map", "email_hash", "not_null"),

        _t(G, "dim_customer", "customer_key", "unique"),
        _t(G, "dim_customer", "customer_key", "not_null"),
        Check(G, "dim_customer", "relationships(customer_key)", "relationships", "customer_key",
              fail=("gt", 0), params=_rel("dim_customer", "customer_key", "identity_map",
                                          "customer_key")),
        _t(G, "dim_customer", "email_masked", "not_null"),
        _t(G, "dim_customer", "n_source_records", "not_null"),
        _t(G, "dim_customer", "n_source_records", "accepted_values", values=[1, 2, 3]),
        _t(G, "dim_customer", "in_crm", "accepted_values", values=[0, 1]),
        _t(G, "dim_customer", "in_app", "accepted_values", values=[0, 1]),
        _t(G, "dim_customer", "in_stripe", "accepted_values", values=[0, 1]),
        _t(G, "fact_subscriptions", "subscription_version_key", "not_null"),
        _t(G, "fact_subscriptions", "subscription_version_key", "unique"),
        _t(G, "fact_subscriptions", "subscription_id", "not_null"),
        _t(G, "fact_subscriptions", "customer_key", "not_null"),
        Check(G, "fact_subscriptions", "relationships(customer_key)", "relationships",
              "customer_key", fail=("gt", 0),
              params=_rel("fact_subscriptions", "customer_key", "dim_customer", "customer_key")),
        _t(G, "fact_subscriptions", "plan", "accepted_values", values=PLAN_VALUES),
        _t(G, "fact_subscriptions", "status", "accepted_values", values=STATUS_VALUES),
        _t(G, "fact_subscriptions", "is_current", "not_null"),
        _t(G, "mart_mrr", "plan", "unique"),
        _t(G, "mart_mrr", "plan", "not_null"),
        _t(G, "mart_mrr", "active_subscriptions", "not_null"),
        _t(G, "mart_mrr", "mrr", "not_null"),
        _t(G, "mart_ltv", "customer_key", "not_null"),
        _t(G, "mart_ltv", "customer_key", "unique"),
        Check(G, "mart_ltv", "relationships(customer_key)", "relationships", "customer_key",
              fail=("gt", 0), params=_rel("mart_ltv", "customer_key", "dim_customer",
                                          "customer_key")),
        _t(G, "mart_ltv", "ltv_to_date", "not_null"),
        _t(G, "recon_billing_vs_app", "recon_status", "unique"),
        _t(G, "recon_billing_vs_app", "recon_status", "not_null"),
        _t(G, "recon_billing_vs_app", "n_customers", "not_null"),
    ]


def checks_for(layer: str) -> list[Check]:
    return {BRONZE: bronze_checks, SILVER: silver_checks, GOLD: gold_checks}[layer]()


# ---------------------------------------------------------------- singular tests
def _violations(build, sql):
    return dict(metric=lambda t, _now: count_of(build(t)), sql=sql)


def _grain(table):
    return _violations(
        lambda t: (t[table].groupBy("source_system", "source_id").agg(F.count(F.lit(1)).alias("n"))
                   .filter(F.col("n") > 1)),
        f"SELECT count(*) FILTER (WHERE copy = 2) FROM (SELECT row_number() OVER "
        f"(PARTITION BY source_system, source_id) AS copy FROM {table}) numbered")


def _distinct_per(key, other):
    return _violations(
        lambda t: (t["identity_map"].groupBy(key).agg(F.count_distinct(other).alias("n"))
                   .filter(F.col("n") > 1)),
        f"SELECT count(DISTINCT struct_pack(k := a.{key})) FROM identity_map a "
        f"JOIN (SELECT {key}, min({other}) AS least FROM identity_map GROUP BY {key}) b "
        f"ON a.{key} IS NOT DISTINCT FROM b.{key} AND a.{other} > b.least")


def _recon_covers(t):
    recon = t["recon_billing_vs_app"].agg(F.sum("n_customers").alias("n"))
    both = scalars(recon_total=recon, dim_total=count_of(t["dim_customer"]))
    return both.filter(F.col("recon_total") != F.col("dim_total"))


def singular_tests() -> list[Check]:
    T = "tests"
    return [
        Check(T, "customers", "assert_customers_grain_unique", "singular", fail=("gt", 0),
              params=_grain("customers")),
        Check(T, "identity_map", "assert_identity_map_grain_unique", "singular", fail=("gt", 0),
              params=_grain("identity_map")),
        Check(T, "identity_map", "assert_one_customer_key_per_email", "singular", fail=("gt", 0),
              params=_distinct_per("email_hash", "customer_key")),
        Check(T, "identity_map", "assert_no_customer_key_over_merge", "singular", fail=("gt", 0),
              params=_distinct_per("customer_key", "email_hash")),
        Check(T, "fact_subscriptions", "assert_one_current_version_per_subscription", "singular",
              fail=("gt", 0), params=_violations(
                  lambda t: (t["fact_subscriptions"].filter(F.col("is_current"))
                             .groupBy("subscription_id").agg(F.count(F.lit(1)).alias("n"))
                             .filter(F.col("n") != 1)),
                  "SELECT count(*) FILTER (WHERE version = 2) FROM (SELECT row_number() OVER "
                  "(PARTITION BY subscription_id) AS version FROM fact_subscriptions WHERE is_current) numbered")),
        Check(T, "recon_billing_vs_app", "assert_recon_covers_all_customers", "singular",
              fail=("gt", 0), params=_violations(
                  _recon_covers,
                  "SELECT coalesce(sum(n) <> 0, false)::INT FROM (SELECT sum(n_customers) AS n FROM recon_billing_vs_app "
                  "UNION ALL SELECT -count(*) FROM dim_customer) both_sides")),
        Check(T, "mart_mrr", "assert_mrr_arithmetic", "singular", fail=("gt", 0),
              params=_violations(
                  lambda t: t["mart_mrr"].filter(
                      F.col("mrr") != F.col("active_subscriptions") * F.col("monthly_price")),
                  "SELECT count_if(mrr - active_subscriptions * monthly_price <> 0) FROM mart_mrr")),
        Check(T, "mart_funnel", "assert_funnel_is_nested", "singular", fail=("gt", 0),
              params=_violations(
                  lambda t: t["mart_funnel"].filter((F.col("signups") > F.col("leads"))
                                                    | (F.col("paid") > F.col("signups"))),
                  "SELECT count_if(greatest(signups - leads, paid - signups) > 0) FROM mart_funnel")),
    ]
