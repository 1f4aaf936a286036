"""Operators on inputs where one key holds a third of all rows: results
must be whole and exact (checked against brute force in Python)."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import gold, scd2, silver
from tidemark.operators.dedupe import latest_per_key

N = 30000
T0 = dt.datetime(2025, 1, 1)


def test_hot_key_latest_per_key(spark):
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("ts"))
    got = {r["k"]: r["ts"] for r in latest_per_key(df, ["k"], [F.col("ts").desc()]).collect()}
    assert got["HOT"] == N - 3 and len(got) == 1 + N - N // 3


def test_hot_person_dimension(spark):
    # a third of all records share one e-mail (one person), spread over sources
    rows = []
    for i in range(3000):
        email_hash = "H0" if i % 3 == 0 else f"H{i}"
        system = ["crm", "stripe", "app"][i % 3 if email_hash != "H0" else (i // 3) % 3]
        rows.append((system, f"id{i}", email_hash, f"n{i}", T0 + dt.timedelta(days=i)))
    c = spark.createDataFrame(rows, "source_system string, source_id string, email_hash string, "
                                    "first_name string, source_created_at timestamp")
    for col in ["email_domain", "email_masked", "last_name_initial", "company", "country",
                "account_id", "lead_source", "campaign"]:
        c = c.withColumn(col, F.lit(None).cast("string"))
    dim = gold.dim_customer(None, c)
    key = silver.identity_map(c.filter("email_hash = 'H0'").limit(1)).first()["customer_key"]
    hot = dim.filter(F.col("customer_key") == key).first()
    assert hot["n_source_records"] == 1000
    assert (hot["in_crm"], hot["in_stripe"], hot["in_app"]) == (1, 1, 1)
    # app wins, and among app records the greatest source id
    app_ids = [r for r in rows if r[2] == "H0" and r[0] == "app"]
    assert hot["first_name"] == max(app_ids, key=lambda r: r[1])[3]
    assert hot["first_seen_at"] == T0
    assert dim.count() == 1 + 2000


def test_hot_subscription_history(spark):
    # one subscription owns a third of the change log, over many runs
    rows = []
    for i in range(3000):
        key = "HOT" if i % 3 == 0 else f"s{i % 50}"
        rows.append((key, "pro", "active", T0 + dt.timedelta(minutes=i), i // 10))
    log = spark.createDataFrame(rows, "subscription_id string, plan string, status string, "
                                      "sub_updated_at timestamp, batch int")
    hist = scd2.history_from_log(log, "subscription_id", "sub_updated_at", batch="batch")
    hot = sorted((r["valid_from"], r["valid_to"]) for r in hist.filter("subscription_id = 'HOT'").collect())
    # brute force: latest change per run, kept when newer than all earlier runs
    per_run = {}
    for k, _, _, ts, b in rows:
        if k == "HOT":
            per_run[b] = max(per_run.get(b, ts), ts)
    versions = [per_run[b] for b in sorted(per_run)]
    assert hot == list(zip(versions, versions[1:] + [None]))
    un = scd2.history_from_log(log.drop("batch"), "subscription_id", "sub_updated_at", partitions=8)
    hot_all = sorted((r["valid_from"], r["valid_to"]) for r in un.filter("subscription_id = 'HOT'").collect())
    times = sorted(ts for k, _, _, ts, _ in rows if k == "HOT")
    assert hot_all == list(zip(times, times[1:] + [None]))


def test_hot_user_orphan_events(spark):
    ev = spark.range(N).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit("u0")).otherwise((F.col("id") % 100).cast("string")).alias("user_id"))
    cust = spark.createDataFrame([("app", "u0"), ("app", "1")], "source_system string, source_id string")
    r = silver.orphan_known_events(ev, cust).first()
    known = N // 3 + sum(1 for i in range(N) if i % 3 and i % 100 == 1)
    assert r["n_known_events"] == N and r["n_orphan_events"] == N - known


def test_next_within_key_across_batches_and_partitions(spark):
    from tidemark.operators.sequence import next_within_key
    import random
    rnd = random.Random(5)
    rows = sorted({(rnd.choice(["HOT"] * 5 + ["a", "b", "c"]), rnd.randint(0, 10**6)) for _ in range(3000)})
    df = spark.createDataFrame(rows, "k string, ts long")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r["k"], r["ts"]): r["next_ts"] for r in next_within_key(df, "k", "ts", partitions=13).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = {}
    for (k, ts), nxt in zip(rows, rows[1:] + [(None, None)]):
        want[(k, ts)] = nxt[1] if nxt[0] == k else None
    assert got == want
