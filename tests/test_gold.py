"""Gold models on hand-made people and subscriptions."""

import datetime as dt


from tidemark.operators import gold, silver
from tidemark.sources.registry import plan_pricing

CUST = ("source_system string, source_id string, email_hash string, email_domain string, "
        "email_masked string, first_name string, last_name_initial string, company string, "
        "country string, account_id string, lead_source string, campaign string, "
        "source_created_at timestamp, _ingested_at timestamp")
D = dt.datetime(2025, 1, 1)


def cust(spark, data):
    return spark.createDataFrame(data, CUST)


def people(spark):
    return cust(spark, [
        # p1 in all three sources; app first name NULL (stays NULL, T9)
        ("crm", "H1", "H1", "x.com", "a***@x.com", "CrmAnn", "L", "Acme", None, None, "ads", "c1", D, D),
        ("stripe", "cus_1", "H1", "x.com", "a***@x.com", "BillAnn", "L", None, "VN", None, None, None,
         D - dt.timedelta(days=3), D),
        ("app", "u1", "H1", "x.com", "a***@x.com", None, "M", None, "VN", "acct1", None, None, D, D),
        # p2 twice in app (two accounts): source id breaks the tie
        ("app", "u2", "H2", "y.com", "b***@y.com", "Bo", "K", None, "US", "acct2", None, None, D, D),
        ("app", "u3", "H2", "y.com", "b***@y.com", "Bob", "K", None, "US", "acct3", None, None, D, D),
        # p3 only a lead
        ("crm", "H3", "H3", "z.com", "c***@z.com", "Cy", "Q", "Zed", None, None, "ref", "c2", D, D),
    ])


def test_dim_customer_survivorship(spark):
    c = people(spark)
    dim = {r["first_seen_at"] and r["email_domain"]: r
           for r in gold.dim_customer(silver.identity_map(c), c).collect()}
    p1, p2, p3 = dim["x.com"], dim["y.com"], dim["z.com"]
    assert p1["first_name"] is None and p1["last_name_initial"] == "M"
    assert (p1["in_crm"], p1["in_stripe"], p1["in_app"], p1["n_source_records"]) == (1, 1, 1, 3)
    assert (p1["company"], p1["country"], p1["account_id"]) == ("Acme", "VN", "acct1")
    assert p1["first_seen_at"] == D - dt.timedelta(days=3)
    assert p2["first_name"] == "Bob" and p2["account_id"] == "acct3"   # max source id / max text
    assert p2["n_source_records"] == 2
    assert (p3["in_crm"], p3["in_app"], p3["n_source_records"]) == (1, 0, 1)


FACT = ("subscription_version_key string, subscription_id string, customer_key string, "
        "account_id string, plan string, status string, sub_started_at timestamp, "
        "valid_from timestamp, valid_to timestamp, is_current boolean")


def fact(spark, data):
    return spark.createDataFrame(data, FACT)


def test_marts(spark):
    f = fact(spark, [
        ("v1", "s1", "K1", "a1", "pro", "active", D, D, None, True),
        ("v0", "s1", "K1", "a1", "free", "active", D, D, D, False),       # history
        ("v2", "s2", "K1", "a1", "basic", "active", dt.datetime(2025, 3, 31), D, None, True),
        ("v3", "s3", None, "a9", "pro", "active", D, D, None, True),      # no person
        ("v4", "s4", "K2", "a2", "pro", "canceled", D, D, None, True),
        ("v5", "s5", "K3", "a3", "free", "active", dt.datetime(2026, 1, 1), D, None, True),  # future
    ])
    price = plan_pricing(spark)
    mrr = {r["plan"]: r for r in gold.mart_mrr(f, price).collect()}
    assert (mrr["pro"]["active_subscriptions"], mrr["pro"]["mrr"]) == (2, 198)
    assert mrr["free"]["mrr"] == 0 and "enterprise" not in mrr
    ltv = {r["customer_key"]: r for r in gold.mart_ltv(f, price, "2025-04-30 12:00:00").collect()}
    assert (ltv["K1"]["active_subscriptions"], ltv["K1"]["current_mrr"]) == (2, 128)
    # pro since Jan 1: 3 whole months; basic since Mar 31: 1 (Mar 31 + 1 month = Apr 30 00:00)
    assert ltv["K1"]["tenure_months"] == 3 and ltv["K1"]["ltv_to_date"] == 99 * 3 + 29 * 1
    assert ltv[None]["ltv_to_date"] == 99 * 3          # orphan versions form one NULL group
    assert ltv["K3"]["tenure_months"] == 0             # future start clamps to 0
    churn = {r["plan"]: r for r in gold.churn_by_plan(f).collect()}
    assert (churn["pro"]["current_subscriptions"], churn["pro"]["canceled_subscriptions"]) == (3, 1)


def test_funnel_and_recon(spark):
    dim = spark.createDataFrame([
        ("K1", 1, 1, 1), ("K2", 1, 0, 1), ("K3", 0, 0, 1), ("K4", 1, 1, 0),
    ], "customer_key string, in_crm int, in_stripe int, in_app int")
    f = fact(spark, [
        ("v1", "s1", "K1", "a1", "pro", "active", D, D, None, True),
        ("v2", "s2", "K3", "a3", "basic", "active", D, D, None, True),
        ("v3", "s4", "K4", "a4", "free", "active", D, D, None, True),
        ("v4", "s9", None, "a9", "pro", "active", D, D, None, True),
    ])
    fun = gold.mart_funnel(dim, f).first()
    assert (fun["leads"], fun["signups"], fun["paid"]) == (3, 2, 1)
    assert (fun["lead_to_signup_rate"], fun["signup_to_paid_rate"]) == (0.667, 0.5)
    rec = {r["recon_status"]: r["n_customers"] for r in gold.recon_billing_vs_app(dim, f).collect()}
    assert rec == {gold.RECON_LABELS[0]: 1, gold.RECON_LABELS[1]: 1, gold.RECON_LABELS[2]: 1,
                   gold.RECON_LABELS[3]: 1}


def test_funnel_without_leads_has_null_rates(spark):
    dim = spark.createDataFrame([("K3", 0, 1, 1)], "customer_key string, in_crm int, in_stripe int, in_app int")
    fun = gold.mart_funnel(dim, fact(spark, [])).first()
    assert (fun["leads"], fun["lead_to_signup_rate"], fun["signup_to_paid_rate"]) == (0, None, None)


def test_fact_bridges_through_account(spark):
    dim = spark.createDataFrame([("K1", "a1"), ("K2", None)], "customer_key string, account_id string")
    hist = spark.createDataFrame([
        ("s1", "a1", "pro", "active", D, D, "id1", D, None),
        ("s2", "a2", "pro", "active", D, D, "id2", D, D),
    ], "subscription_id string, account_id string, plan string, status string, "
       "sub_started_at timestamp, sub_updated_at timestamp, scd_id string, valid_from timestamp, "
       "valid_to timestamp")
    got = {r["subscription_id"]: r for r in gold.fact_subscriptions(hist, dim).collect()}
    assert got["s1"]["customer_key"] == "K1" and got["s1"]["is_current"] is True
    assert got["s2"]["customer_key"] is None and got["s2"]["is_current"] is False


def test_second_account_needs_the_record_bridge(spark):
    c = people(spark)                       # p2 has two app accounts: acct2 and acct3
    dim = gold.dim_customer(None, c)
    hist = spark.createDataFrame([
        ("s2", "acct2", "pro", "active", D, D, "id2", D, None),
        ("s3", "acct3", "pro", "active", D, D, "id3", D, None),
    ], "subscription_id string, account_id string, plan string, status string, "
       "sub_started_at timestamp, sub_updated_at timestamp, scd_id string, valid_from timestamp, "
       "valid_to timestamp")
    by_dim = {r["subscription_id"]: r["customer_key"] for r in gold.fact_subscriptions(hist, dim).collect()}
    assert by_dim["s2"] is None and by_dim["s3"] is not None          # T14 as modelled
    by_rec = {r["subscription_id"]: r["customer_key"] for r in
              gold.fact_subscriptions(hist, dim, gold.account_bridge(c)).collect()}
    assert by_rec["s2"] == by_rec["s3"] == by_dim["s3"]


def test_report_order(spark):
    df = spark.createDataFrame([("pro", 3, 99, 297), ("basic", 2, 29, 58), ("enterprise", 1, 299, 299)],
                               "plan string, active_subscriptions long, monthly_price int, mrr long")
    assert [r["plan"] for r in gold.report(df, "mart_mrr").collect()] == ["enterprise", "pro", "basic"]
    assert [r["plan"] for r in gold.report(df, "mart_mrr", limit=1).collect()] == ["enterprise"]
