"""Streaming SCD-2: epochs applied once, equal to sequential snapshot runs."""

import datetime as dt

import numpy as np

from tidemark.operators import scd2
from tidemark.session import scratch_path
from tidemark.streaming import id_index as ix
from tidemark.streaming import subscriptions as ss

SCHEMA = ("subscription_id string, account_id string, plan string, status string, "
          "sub_started_at timestamp, sub_updated_at timestamp, _ingested_at timestamp")
D = dt.datetime(2025, 1, 1)


def t(days):
    return D + dt.timedelta(days=days)


def versions(df):
    return sorted((r["subscription_id"], r["plan"], r["valid_from"], r["valid_to"]) for r in df.collect())


def test_epochs_apply_once_and_match_snapshot_runs(spark):
    e1 = spark.createDataFrame([("A", "a", "free", "active", D, t(1), t(2)),
                                ("A", "a", "pro", "active", D, t(2), t(2)),
                                ("B", "b", "pro", "active", D, t(1), t(2))], SCHEMA)
    e2 = spark.createDataFrame([("A", "a", "enterprise", "active", D, t(5), t(6)),
                                ("C", "c", "basic", "active", D, t(5), t(6))], SCHEMA)
    root = scratch_path(spark, "scd")
    ss.apply_changes(spark, e1, root, "000000000000")
    ss.apply_changes(spark, e1, root, "000000000000")          # replay: no effect
    ss.apply_changes(spark, e2, root, "000000000001")
    ss.apply_changes(spark, e1, root, "000000000000")          # late replay of an old epoch
    got = versions(ss.read_history(spark, root))
    payload = ["subscription_id", "account_id", "plan", "status", "sub_started_at", "sub_updated_at"]
    s1 = scd2.snapshot_timestamp(None, spark.createDataFrame(
        [("A", "a", "pro", "active", D, t(2)), ("B", "b", "pro", "active", D, t(1))],
        ", ".join(SCHEMA.split(", ")[:6])), "subscription_id", "sub_updated_at")
    s2 = scd2.snapshot_timestamp(s1, spark.createDataFrame(
        [("A", "a", "enterprise", "active", D, t(5)), ("B", "b", "pro", "active", D, t(1)),
         ("C", "c", "basic", "active", D, t(5))], ", ".join(SCHEMA.split(", ")[:6])),
        "subscription_id", "sub_updated_at")
    assert got == versions(s2.select(*payload, "scd_id", "valid_from", "valid_to"))
    assert len(got) == 4


def arrive(spark, index, ids, run):
    """One trigger: the rows of ``ids`` that the target lacks are added."""
    batch = spark.createDataFrame([(i,) for i in ids], "event_id string")
    return index.add(index.missing(batch, run), run)


def held(spark, target):
    return sorted((r["event_id"] for r in spark.read.parquet(target).collect()), key=str)


def test_bit_field_misses_no_id_and_names_few_in_vain():
    rng = np.random.default_rng(7)
    h = rng.integers(0, 1 << 64, 120_000, dtype=np.uint64)
    n_bits, bits = ix.bit_field(h[:20_000])
    assert n_bits >= ix.BITS * 20_000 and len(bits) == n_bits // 8
    assert all(ix.may_hold(h[k:k + 1], n_bits, bits) for k in range(0, 20_000, 40))
    assert sum(ix.may_hold(h[k:k + 1], n_bits, bits) for k in range(20_000, 120_000)) <= 5
    assert not ix.may_hold(h[:0], n_bits, bits)


def test_id_index_reads_only_folders_that_may_hold_an_id(spark):
    target = scratch_path(spark, "indexed")
    for run in range(6):
        index = ix.IdIndex(spark, target, "event_id", buckets=4)
        assert arrive(spark, index, [f"{run}-{k}" for k in range(50)] + ([None] if run in (0, 3) else []), f"r{run}") == 50 + (run == 0)
    index = ix.IdIndex(spark, target, "event_id")
    assert index.buckets == 4                                       # fixed by the first run
    new = spark.createDataFrame([(f"9-{k}",) for k in range(50)], "event_id string")
    assert index.folders(new, "r6") == []                           # nothing of the target is read for new ids
    copy = index.folders(spark.createDataFrame([("3-7",)], "event_id string"), "r6")
    assert len(copy) == 1 and "/run=r3/_bucket=" in copy[0]         # one of 24 folders
    assert arrive(spark, index, ["3-7", "9-1"], "r6") == 1
    assert held(spark, target) == sorted([f"{r}-{k}" for r in range(6) for k in range(50)] + [None, "9-1"], key=str)


def test_id_index_after_crash_replay_and_gathering(spark, monkeypatch):
    target = scratch_path(spark, "indexed")
    monkeypatch.setattr(ix, "FILTER_FOLDERS", 2)
    for run in range(4):
        arrive(spark, ix.IdIndex(spark, target, "event_id", 4), [f"{run}-{k}" for k in range(9)], f"r{run}")
    index = ix.IdIndex(spark, target, "event_id")
    assert len(set(index.version.places.values())) <= 2 and index.fields().select("run").distinct().count() == 4
    # rows without bit fields, as a crash between the two leaves them: read in full
    spark.createDataFrame([("lost", 0)], "event_id string, _bucket int").write.partitionBy("_bucket").parquet(f"{target}/run=dead")
    assert index.folders(spark.createDataFrame([("x",)], "event_id string"), "r9") == [f"{target}/run=dead"]
    assert arrive(spark, index, ["lost", "2-3", "new"], "r9") == 1
    # a replayed run does not look at itself and replaces its rows and bit fields
    assert arrive(spark, ix.IdIndex(spark, target, "event_id"), ["new", "newer"], "r9") == 2
    assert arrive(spark, ix.IdIndex(spark, target, "event_id"), ["new", "newer", "0-0", "lost"], "r10") == 0
    assert held(spark, target) == sorted([f"{r}-{k}" for r in range(4) for k in range(9)] + ["lost", "new", "newer"])
