"""SCD-2: per-run snapshots, the one-pass rebuild from the log, as-of state."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import scd2

SCHEMA = "subscription_id string, plan string, status string, sub_updated_at timestamp"


def t(s):
    return dt.datetime.fromisoformat(s)


def versions(df):
    return sorted((r["subscription_id"], r["plan"], r["valid_from"], r["valid_to"])
                  for r in df.collect())


@pytest.mark.parametrize("as_of,plan,status", [
    ("2025-02-01", "free", "active"),
    ("2025-03-01", "pro", "active"),      # the change day itself is included
    ("2025-05-31", "pro", "active"),
    ("2026-01-01", "pro", "canceled"),
])
def test_state_as_of_timeline(spark, as_of, plan, status):
    log = spark.createDataFrame([
        ("s1", "free", "active", t("2025-01-01")),
        ("s1", "pro", "active", t("2025-03-01")),
        ("s1", "pro", "canceled", t("2025-06-01")),
    ], SCHEMA)
    hist = scd2.history_from_log(log, "subscription_id", "sub_updated_at")
    got = scd2.state_as_of(hist, f"{as_of} 00:00:00").collect()
    assert [(r["plan"], r["status"]) for r in got] == [(plan, status)]


def test_snapshot_runs(spark):
    run1 = spark.createDataFrame([("A", "free", "active", t("2025-01-01")),
                                  ("B", "pro", "active", t("2025-01-01"))], SCHEMA)
    run2 = spark.createDataFrame([("A", "pro", "active", t("2025-02-01")),     # newer
                                  ("B", "pro", "active", t("2025-01-01")),     # unchanged
                                  ("C", "basic", "active", t("2025-02-01"))], SCHEMA)  # new
    run3 = spark.createDataFrame([("A", "enterprise", "active", t("2025-01-15"))],  # older
                                 SCHEMA)                                     # B, C vanish
    s1 = scd2.snapshot_timestamp(None, run1, "subscription_id", "sub_updated_at")
    s2 = scd2.snapshot_timestamp(s1, run2, "subscription_id", "sub_updated_at")
    s3 = scd2.snapshot_timestamp(s2, run3, "subscription_id", "sub_updated_at")
    want = [
        ("A", "free", t("2025-01-01"), t("2025-02-01")),
        ("A", "pro", t("2025-02-01"), None),
        ("B", "pro", t("2025-01-01"), None),
        ("C", "basic", t("2025-02-01"), None),
    ]
    assert versions(s2) == want
    assert versions(s3) == want                  # older change ignored, vanished keys stay open
    assert s3.select("scd_id").distinct().count() == 4


def test_runs_equal_one_pass_rebuild(spark):
    """One snapshot run per batch == history_from_log(batch=...), including
    several changes of one key inside one batch and out-of-order times."""
    rnd = random.Random(7)
    base = t("2025-01-01")
    log, runs = [], []
    for run in range(6):
        batch = []
        for k in range(25):
            for _ in range(rnd.choice([0, 0, 1, 2])):
                when = base + dt.timedelta(days=run * 30 + rnd.randint(-40, 29), seconds=k)
                batch.append((f"s{k}", rnd.choice(["free", "pro", "basic"]), "active", when, run))
        # the source of a run is the latest change per key among everything landed so far
        log.extend(batch)
        runs.append(list(log))
    schema = SCHEMA + ", batch int"
    snap = None
    for landed in runs:
        df = spark.createDataFrame(landed, schema)
        w = F.row_number().over(
            Window.partitionBy("subscription_id")
            .orderBy(F.col("sub_updated_at").desc(), F.col("batch").desc(), F.col("plan")))
        src = (df.withColumn("rn", w).filter("rn = 1")
               .select("subscription_id", "plan", "status", "sub_updated_at"))
        snap = scd2.snapshot_timestamp(snap, src, "subscription_id", "sub_updated_at")
        snap = snap.checkpoint()   # cut lineage between runs (shared checkpoint dir)
    rebuilt = scd2.history_from_log(spark.createDataFrame(log, schema), "subscription_id",
                                    "sub_updated_at", batch="batch", tie_break=["plan"])
    assert versions(snap) == versions(rebuilt)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_history_invariants(spark, partitions):
    rnd = random.Random(3)
    data = [(f"s{rnd.randint(0, 9)}", "pro", "active",
             t("2025-01-01") + dt.timedelta(hours=rnd.randint(0, 5000))) for _ in range(200)]
    hist = scd2.history_from_log(spark.createDataFrame(data, SCHEMA), "subscription_id",
                                 "sub_updated_at", partitions=partitions).collect()
    want = {}
    for k, _, _, ts in data:
        want.setdefault(k, set()).add(ts)
    for k, times in want.items():        # brute force: each distinct time, next distinct time
        times = sorted(times)
        expect = list(zip(times, times[1:] + [None]))
        got = sorted((r["valid_from"], r["valid_to"]) for r in hist if r["subscription_id"] == k)
        assert got == expect
    by_key = {}
    for r in hist:
        by_key.setdefault(r["subscription_id"], []).append(r)
    for vs in by_key.values():
        vs.sort(key=lambda r: r["valid_from"])
        assert sum(r["valid_to"] is None for r in vs) == 1          # exactly one open version
        for a, b in zip(vs, vs[1:]):
            assert a["valid_to"] == b["valid_from"]                 # no gaps, no overlaps


def test_next_value_far_dates_big_integers_and_nulls(spark):
    from tidemark.operators.sequence import next_within_key
    far = dt.datetime(9999, 12, 31)
    df = spark.createDataFrame([("a", dt.datetime(2001, 1, 1), 9007199254740993), ("a", far, None), (None, far, 5),
                                ("a", dt.datetime(2001, 1, 1, 1), 1)], "k string, t timestamp, n long")
    got = {(r["k"], r["t"], r["n"]): r["next_t"] for r in next_within_key(df, "k", "t").collect()}
    assert got == {("a", dt.datetime(2001, 1, 1), 9007199254740993): dt.datetime(2001, 1, 1, 1),
                   ("a", dt.datetime(2001, 1, 1, 1), 1): far, ("a", far, None): None, (None, far, 5): None}
    by_n = {r["n"]: r["next_n"] for r in next_within_key(df.filter("k = 'a'"), "k", "n").collect()}
    assert by_n == {None: 1, 1: 9007199254740993, 9007199254740993: None}
    plan = next_within_key(df, "k", "t")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_history_of_a_log_with_key_and_time_only(spark):
    t = [dt.datetime(2001, 1, d) for d in (1, 1, 2)]
    log = spark.createDataFrame([("s", x) for x in t], "k string, t timestamp")
    got = sorted((r["valid_from"], r["valid_to"]) for r in scd2.history_from_log(log, "k", "t").collect())
    assert got == [(t[0], t[2]), (t[2], None)]
