"""Silver conforming and the customer union on hand-made rows."""

import datetime as dt
import hashlib


from tests.conftest import rows
from tidemark.operators import conform, silver

RUN_A = "2026-08-04T01:00:00+00:00"
RUN_B = "2026-08-05T01:00:00+00:00"

CRM_SCHEMA = ("contact_email string, first_name string, last_name string, company string, "
              "lead_source string, campaign string, created_date string, industry string, "
              "_source string, _ingested_at string")


def h(s):
    return hashlib.sha256(s.encode()).hexdigest().upper()


def crm(spark, data):
    return spark.createDataFrame(data, CRM_SCHEMA)


def test_crm_noise_and_filter(spark):
    df = crm(spark, [
        ("Ann@X.com", " Ann ", "Lee", " Acme ", "ads", "c1", "2026-01-02", "tech", "crm", RUN_A),
        ("  bob@x.com\t", "Bob", None, "B", "ads", "c1", "not a date", "tech", "crm", RUN_A),
        (None, "Nul", "L", "C", "ads", "c1", "2026-01-02", "tech", "crm", RUN_A),
        ("   ", "Blank", "L", "C", "ads", "c1", "2026-01-02", "tech", "crm", RUN_A),
        ("noat", "No", "At", "C", "ads", "c1", "2026-01-02", "tech", "crm", RUN_A),
    ])
    out = {r["first_name"]: r for r in conform.conform_crm(df).collect()}
    assert set(out) == {"Ann", "Bob", "No"}              # NULL and blank e-mails dropped
    ann = out["Ann"]
    assert ann["source_id"] == ann["email_hash"] == h("ann@x.com")
    assert (ann["email_domain"], ann["email_masked"]) == ("x.com", "a***@x.com")
    assert (ann["company"], ann["last_name_initial"]) == ("Acme", "L")
    assert ann["source_created_at"] == dt.datetime(2026, 1, 2)
    assert out["Bob"]["email_hash"] == h("bob@x.com")
    assert out["Bob"]["source_created_at"] is None       # bad text -> NULL, row kept
    assert out["Bob"]["last_name_initial"] is None
    assert (out["No"]["email_domain"], out["No"]["email_masked"]) == (None, None)


def test_billing_name_and_epoch(spark):
    df = spark.createDataFrame([
        ("cus_1", "customer", "A@x.com", "Plato", "86400", "VN", "stripe", RUN_A),
        ("cus_2", "customer", "b@x.com", "Ada Lovelace", "bad", "US", "stripe", RUN_A),
    ], "id string, object string, email string, name string, created string, "
       "`metadata.country` string, _source string, _ingested_at string")
    out = {r["source_id"]: r for r in conform.conform_billing(df).collect()}
    assert (out["cus_1"]["first_name"], out["cus_1"]["last_name_initial"]) == ("Plato", None)
    assert out["cus_1"]["source_created_at"] == dt.datetime(1970, 1, 2)
    assert out["cus_1"]["country"] == "VN"
    assert (out["cus_2"]["first_name"], out["cus_2"]["last_name_initial"]) == ("Ada", "L")
    assert out["cus_2"]["source_created_at"] is None


def _app(spark, data):
    return spark.createDataFrame(data, "user_id string, account_id string, email string, "
                                       "first_name string, last_name string, country string, "
                                       "created_at string, _source string, _ingested_at string")


def test_customers_latest_landing_wins_and_ties_are_deterministic(spark):
    app = _app(spark, [
        ("1", "11", "u1@x.com", "Old", "L", "VN", "2026-01-01 00:00:00", "app", RUN_A),
        ("1", "11", "u1@x.com", "New", "L", "VN", "2026-01-01 00:00:00", "app", RUN_B),
        ("2", "12", "u2@x.com", "Zed", "L", "VN", "2026-01-01 00:00:00", "app", RUN_A),
        ("2", "12", "u2@x.com", "Amy", "L", "VN", "2026-01-01 00:00:00", "app", RUN_A),  # full tie
    ])
    c = conform.customers(conform.conform_app(app))
    got = dict(rows(c, "source_id", "first_name"))
    assert got == {"1": "New", "2": "Amy"}               # later run; tie broken by name


def test_identity_map_matches_across_sources(spark):
    a = _app(spark, [("1", "11", "Same@x.com", "A", "B", "VN", None, "app", RUN_A)])
    b = crm(spark, [(" same@X.com", "A", "B", "C", "ads", "c", None, None, "crm", RUN_A)])
    im = silver.identity_map(conform.customers(conform.conform_app(a), conform.conform_crm(b)))
    keys = {r["customer_key"] for r in im.collect()}
    assert len(keys) == 1 and im.count() == 2


def test_events_latest_copy_and_missing_columns(spark):
    df = spark.createDataFrame([
        ("e1", "session", "an", None, "2024-01-01 00:00:00", "5", "1.0", "app_events", RUN_A),
        ("e1", "session", "an", None, "2024-01-01 00:00:00", "5", "2.0", "app_events", RUN_B),
        ("e2", "page_view", "an", "7", "bad", None, "1.0", "app_events", RUN_A),
    ], "event_id string, event_type string, anonymous_id string, user_id string, timestamp string, "
       "`properties.duration_s` string, `context.app_version` string, _source string, _ingested_at string")
    ev = {r["event_id"]: r for r in silver.events_latest(df).collect()}
    assert ev["e1"]["app_version"] == "2.0" and ev["e1"]["duration_s"] == 5.0
    assert ev["e2"]["event_at"] is None                  # bad time -> NULL, row kept
    assert ev["e2"]["page"] is None                      # column absent from this landing


def test_event_identity_stitch_cases(spark):
    ev = spark.createDataFrame([
        ("e1", "a1", "u1"), ("e2", "a1", None),      # anonymous before login, same anon id
        ("e3", "a2", None),                           # never logged in
        ("e4", "a3", "u9"), ("e5", "a3", None),      # user without an app record
    ], "event_id string, anonymous_id string, user_id string")
    ident = spark.createDataFrame([("K1", "app", "u1", "h"), ("K2", "crm", "u9", "h")],
                                  "customer_key string, source_system string, source_id string, email_hash string")
    got = {r["event_id"]: (r["resolved_user_id"], r["customer_key"], r["resolution"])
           for r in silver.event_identity_stitch(ev, None, ident).collect()}
    assert got == {"e1": ("u1", "K1", "user"), "e2": ("u1", "K1", "anonymous_link"),
                   "e3": (None, None, "unresolved"), "e4": ("u9", None, "user"),
                   "e5": ("u9", None, "anonymous_link")}
