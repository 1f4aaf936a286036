"""Gold models (M9-M14) and the business measures the README promises.

Scale notes
-----------
* No join is hinted: AQE turns one into a broadcast from measured sizes
  only (the price list, a literal seed, always is one).
* Marts that only need "does this person have a paid subscription" reduce
  the fact table to one row per person first (partial aggregation), and
  drop the rows without a person before that: NULL keys never match a
  join, so the orphan group never moves through a shuffle.
* ``mart_mrr`` aggregates per plan before it touches the price list: the
  join sees one row per plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (clamp_non_negative, customer_key_of, months_between_whole, ratio,
                                ts_literal)
from tidemark.operators.conform import SOURCE_PRIORITY

DIM_COLUMNS = ["customer_key", "email_domain", "email_masked", "first_name", "last_name_initial",
               "company", "country", "account_id", "lead_source", "campaign", "first_seen_at",
               "in_crm", "in_stripe", "in_app", "n_source_records"]


def _priority(c: Column) -> Column:
    out = None
    for name, p in SOURCE_PRIORITY.items():
        out = (F.when(c == name, p) if out is None else out.when(c == name, p))
    return out


def _flag(system: str) -> Column:
    return F.max(F.when(F.col("source_system") == system, 1).otherwise(0))


def keyed_records(customers: DataFrame, identity: DataFrame | None = None) -> DataFrame:
    """Customer records with their person key.

    With a stored identity map, an inner join on (source_system,
    source_id). Without one the key is derived in place from the e-mail
    hash, exactly as the map derives it: same rows, no self-join shuffle.
    """
    if identity is None:
        return customers.withColumn("customer_key", customer_key_of(F.col("email_hash")))
    m = identity.select("customer_key", "source_system", "source_id")
    return m.join(customers, ["source_system", "source_id"], "inner")


def dim_customer(identity: DataFrame | None, customers: DataFrame) -> DataFrame:
    """Golden record per person (M9).

    Names come from the highest-priority source (app > billing > CRM;
    source id breaks ties, T10; a NULL there stays NULL, T9); attributes
    only one source has use ``max``; first seen is the earliest creation.
    One aggregation per person, partial before the shuffle, so a person
    with a huge number of records costs one row per map task.
    """
    attrs = keyed_records(customers, identity)
    prio = F.struct(_priority(F.col("source_system")).alias("p"), F.col("source_id").alias("id"))
    return attrs.groupBy("customer_key").agg(
        F.max("email_domain").alias("email_domain"),
        F.max("email_masked").alias("email_masked"),
        F.max_by("first_name", prio).alias("first_name"),
        F.max_by("last_name_initial", prio).alias("last_name_initial"),
        F.max("company").alias("company"),
        F.max("country").alias("country"),
        F.max("account_id").alias("account_id"),
        F.max("lead_source").alias("lead_source"),
        F.max("campaign").alias("campaign"),
        F.min("source_created_at").alias("first_seen_at"),
        _flag("crm").alias("in_crm"),
        _flag("stripe").alias("in_stripe"),
        _flag("app").alias("in_app"),
        F.count(F.lit(1)).alias("n_source_records"))


FACT_COLUMNS = ["subscription_version_key", "subscription_id", "customer_key", "account_id",
                "plan", "status", "sub_started_at", "valid_from", "valid_to", "is_current"]


def account_bridge(customers: DataFrame, identity: DataFrame | None = None) -> DataFrame:
    """account_id -> customer_key through every app record (not only the
    dimension's one ``max(account_id)`` per person, T14)."""
    recs = keyed_records(customers.filter(F.col("source_system") == "app"), identity)
    return (recs.filter(F.col("account_id").isNotNull())
            .select("account_id", "customer_key").dropDuplicates(["account_id", "customer_key"]))


def fact_subscriptions(history: DataFrame, dim: DataFrame,
                       bridge: DataFrame | None = None) -> DataFrame:
    """Subscription versions bridged to the person through the app account
    (M10). Left join: versions whose account has no person keep a NULL key.

    By default the bridge is the dimension's ``account_id`` (one per
    person, as modelled: a second account of the same person finds no
    person). Pass ``bridge=account_bridge(customers)`` to reach every
    account of every person."""
    src = bridge if bridge is not None else dim
    accounts = (src.filter(F.col("account_id").isNotNull())
                .select(F.col("account_id").alias("_acct"), "customer_key"))
    return (history.join(accounts, history.account_id == accounts._acct, "left")
            .select(F.col("scd_id").alias("subscription_version_key"),
                    "subscription_id", "customer_key", "account_id", "plan", "status",
                    "sub_started_at", "valid_from", "valid_to",
                    F.col("valid_to").isNull().alias("is_current")))


def current_active(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("is_current") & (F.col("status") == "active"))


def mart_mrr(fact: DataFrame, pricing: DataFrame) -> DataFrame:
    """Monthly recurring revenue per plan over current active versions."""
    per_plan = current_active(fact).groupBy("plan").agg(
        F.count(F.lit(1)).alias("active_subscriptions"))
    return (per_plan.join(pricing, "plan", "inner")
            .select("plan", "active_subscriptions", "monthly_price",
                    (F.col("active_subscriptions") * F.col("monthly_price")).cast("bigint")
                    .alias("mrr")))


def mart_ltv(fact: DataFrame, pricing: DataFrame, as_of) -> DataFrame:
    """Per person: active subscriptions, current MRR, tenure in whole months
    since the subscription started (clamped at 0) and LTV to date at
    today's price (M12). ``as_of`` replaces ``current_timestamp`` (T19).
    Versions without a person form one NULL group, as in SQL."""
    t = ts_literal(as_of)
    priced = current_active(fact).join(pricing, "plan", "inner")
    tenure = clamp_non_negative(months_between_whole(F.col("sub_started_at"), t))
    priced = priced.withColumn("tenure_months", tenure)
    return priced.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("active_subscriptions"),
        F.sum("monthly_price").cast("bigint").alias("current_mrr"),
        F.max("tenure_months").cast("bigint").alias("tenure_months"),
        F.sum(F.col("monthly_price") * F.col("tenure_months")).cast("bigint").alias("ltv_to_date"))


def paid_people(fact: DataFrame) -> DataFrame:
    """One row per person with a current, active, non-free version."""
    paid = (F.col("is_current") & (F.col("status") == "active") & (F.col("plan") != "free"))
    return (fact.filter(F.col("customer_key").isNotNull())
            .groupBy("customer_key")
            .agg(F.max(F.when(paid, 1).otherwise(0)).alias("is_paid")))


def _stage(dim: DataFrame, fact: DataFrame, cols: list[str]) -> DataFrame:
    return (dim.select("customer_key", *cols)
            .join(paid_people(fact), "customer_key", "left")
            .withColumn("is_paid", F.coalesce(F.col("is_paid"), F.lit(0))))


def mart_funnel(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Lead -> signup -> paid counts and rates (M13). Rates are double
    division rounded to 3 digits (T8)."""
    s = _stage(dim, fact, ["in_crm", "in_app"])
    lead = F.col("in_crm") == 1
    signup = lead & (F.col("in_app") == 1)
    paid = signup & (F.col("is_paid") == 1)
    return s.agg(
        F.count_if(lead).alias("leads"),
        F.count_if(signup).alias("signups"),
        F.count_if(paid).alias("paid"),
    ).select("leads", "signups", "paid",
             ratio(F.col("signups"), F.col("leads")).alias("lead_to_signup_rate"),
             ratio(F.col("paid"), F.col("signups")).alias("signup_to_paid_rate"))


# Reconciliation labels.
RECON_LABELS = [
    "1_matched (billed + active)",
    "2_stripe_only (billed, no active sub)",
    "3_app_only (active sub, not billed)",
    "4_neither",
]


def recon_billing_vs_app(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Billing presence vs an active paid subscription, four states."""
    s = _stage(dim, fact, ["in_stripe"])
    billed, paid = F.col("in_stripe") == 1, F.col("is_paid") == 1
    status = (F.when(billed & paid, RECON_LABELS[0])
               .when(billed & ~paid, RECON_LABELS[1])
               .when(~billed & paid, RECON_LABELS[2])
               .otherwise(RECON_LABELS[3]))
    return (s.groupBy(status.alias("recon_status"))
            .agg(F.count(F.lit(1)).alias("n_customers")))


def churn_by_plan(fact: DataFrame) -> DataFrame:
    """Churn measure (E3): share of current versions that are canceled, per plan."""
    cur = fact.filter(F.col("is_current"))
    return cur.groupBy("plan").agg(
        F.count(F.lit(1)).alias("current_subscriptions"),
        F.count_if(F.col("status") == "canceled").alias("canceled_subscriptions"),
    ).withColumn("churn_rate", ratio(F.col("canceled_subscriptions"),
                                     F.col("current_subscriptions")))


def conversion_durations(customers: DataFrame, identity: DataFrame | None,
                         fact: DataFrame) -> DataFrame:
    """Lead -> signup -> first paid durations per person, in days.

    lead = earliest CRM record creation, signup = earliest app record
    creation, paid = earliest start of a non-free active version.
    """
    keyed = keyed_records(
        customers.select("source_system", "source_id", "email_hash", "source_created_at"), identity)
    firsts = keyed.groupBy("customer_key").agg(
        F.min(F.when(F.col("source_system") == "crm", F.col("source_created_at"))).alias("lead_at"),
        F.min(F.when(F.col("source_system") == "app", F.col("source_created_at"))).alias("signup_at"))
    paid = (fact.filter(F.col("customer_key").isNotNull() & (F.col("status") == "active")
                        & (F.col("plan") != "free"))
            .groupBy("customer_key").agg(F.min("valid_from").alias("first_paid_at")))
    j = firsts.join(paid, "customer_key", "left")
    return j.select(
        "customer_key", "lead_at", "signup_at", "first_paid_at",
        F.datediff(F.to_date("signup_at"), F.to_date("lead_at")).cast("bigint")
         .alias("days_lead_to_signup"),
        F.datediff(F.to_date("first_paid_at"), F.to_date("signup_at")).cast("bigint")
         .alias("days_signup_to_paid"))


# How each mart is presented (the models' ORDER BY clauses).
REPORT_ORDER = {
    "mart_mrr": [("mrr", False)],
    "mart_ltv": [("ltv_to_date", False)],
    "recon_billing_vs_app": [("recon_status", True)],
}


def report(df: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """A mart in its presentation order (O1, O2), with a stable tie-break on
    every other column; ``limit`` gives a top-n report (O3). Tables carry no
    order (T20): sort when reading, not when writing."""
    keys = REPORT_ORDER.get(name, [])
    cols = [F.col(c).desc_nulls_last() if not asc else F.col(c).asc_nulls_last() for c, asc in keys]
    cols += [F.col(c).asc_nulls_last() for c in df.columns if c not in dict(keys)]
    out = df.orderBy(*cols)
    return out.limit(limit) if limit is not None else out
