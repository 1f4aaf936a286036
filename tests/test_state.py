"""Stored state: bucketed SCD-2, gold by affected keys, the pointer; and the
analyses over many instants, several keys, time order, two sides of a table."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import components, conform, gold, reconcile, scd2, sketch, timeline
from tidemark.plans.gold_store import GateFailed, GoldStore
from tidemark.plans.scd_store import BucketedHistory
from tidemark.session import scratch_path
from tidemark.sources import published
from tidemark.sources.json_array import read_split_array
from tidemark.sources.landing import path_exists
from tidemark.sources.registry import plan_pricing

D = dt.datetime(2025, 1, 1)
SUB = "subscription_id string, account_id string, plan string, status string, sub_started_at timestamp, sub_updated_at timestamp"


def day(n):
    return D + dt.timedelta(days=n)


def all_rows(df, *cols):
    return sorted(map(repr, map(tuple, df.select(*(cols or sorted(df.columns))).collect())))


# ---------------------------------------------------------------- pointer
def test_a_version_is_seen_whole_or_not_at_all(spark):
    root = scratch_path(spark, "published")
    assert published.current(spark, root) is None
    spark.range(3).write.parquet(f"{root}/runs/a/t")
    one = published.publish(spark, root, None, {"t": "runs/a/t"}, {"who": "a"})
    spark.range(5).write.parquet(f"{root}/runs/b/t")
    assert published.read(spark, root, "t").count() == 3          # written, not published
    two = published.publish(spark, root, one, {"t": "runs/b/t"}, {"who": "b"})
    assert published.read(spark, root, "t").count() == 5 and published.read(spark, root, "t", one).count() == 3
    with pytest.raises(published.ConcurrentCommit):
        published.publish(spark, root, one, {"t": "runs/a/t"}, {})
    assert published.current(spark, root) == two
    for n in range(3):
        spark.range(n).write.parquet(f"{root}/runs/c{n}/t")
        two = published.publish(spark, root, two, {"t": f"runs/c{n}/t"}, {})
        published.clean(spark, root, "runs")
    assert not path_exists(spark, f"{root}/runs/a") and not path_exists(spark, f"{root}/runs/b")
    assert path_exists(spark, f"{root}/runs/c1") and published.read(spark, root, "t").count() == 2


# ---------------------------------------------------------------- bucketed history
def test_bucketed_runs_equal_the_rebuild_and_touch_only_their_buckets(spark):
    rnd = random.Random(5)
    log, runs = [], []
    for run in range(6):
        batch = [(f"s{rnd.randrange(60)}", f"a{rnd.randrange(9)}", rnd.choice(["free", "pro"]), "active", D, day(rnd.randrange(40)))
                 for _ in range(rnd.choice([0, 1, 40]))] + [(None, "a", "pro", "active", D, D), ("s1", "a", "pro", "active", D, None)]
        runs.append(batch)
        log += [(*r, run) for r in batch]
    history = BucketedHistory(spark, scratch_path(spark, "scd"), "subscription_id", "sub_updated_at", 8, ("plan", "status", "account_id"))
    for batch in runs:
        before = history.version()
        done = history.apply(spark.createDataFrame(batch, SUB), "same label")
        after = history.version()
        if done.number is not None:
            moved = {t for t, p in after.places.items() if t.startswith("open/") and (before is None or before.places.get(t) != p)}
            keys = spark.createDataFrame([(r[0],) for r in batch if r[0] and r[5]], "subscription_id string").select(history._bucket().alias("b"))
            assert moved == {f"open/{r['b']}" for r in keys.distinct().collect()}
            assert done.opened - done.closed == after.facts["n_open"] - (before.facts["n_open"] if before else 0)
        assert history.apply(spark.createDataFrame(batch, SUB), "again").number is None      # the same rows change nothing
        assert history.version() == after
    exp = scd2.history_from_log(spark.createDataFrame(log, SUB + ", run int"), "subscription_id", "sub_updated_at", batch="run",
                                tie_break=["plan", "status", "account_id"])
    assert all_rows(history.read()) == all_rows(exp)
    assert history.version().facts["n_all"] == exp.count()
    assert all_rows(history.read_open()) == all_rows(exp.filter("valid_to IS NULL"))


def test_a_run_that_dies_changes_nothing(spark, monkeypatch):
    root = scratch_path(spark, "scd")
    history = BucketedHistory(spark, root, "subscription_id", "sub_updated_at", 4)
    one = spark.createDataFrame([("A", "a", "free", "active", D, D), ("B", "b", "pro", "active", D, D)], SUB)
    two = spark.createDataFrame([("A", "a", "pro", "active", D, day(3))], SUB)
    history.apply(one, "1")
    before = all_rows(history.read())
    monkeypatch.setattr("tidemark.plans.scd_store.published.publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        history.apply(two, "2")
    monkeypatch.undo()
    assert all_rows(history.read()) == before
    assert history.apply(two, "2").opened == 1 and history.read().count() == 3
    assert all_rows(history.changed(), "plan", "valid_to") == all_rows(spark.createDataFrame(
        [("free", day(3)), ("pro", None)], "plan string, valid_to timestamp"), "plan", "valid_to")


# ---------------------------------------------------------------- gold by affected keys
def person(system, sid, mail, account=None, **more):
    base = dict.fromkeys(conform.CUSTOMER_COLUMNS)
    return base | {"source_system": system, "source_id": sid, "email_hash": mail, "account_id": account, "first_name": f"{system}-{sid}",
                   "source_created_at": D, "_ingested_at": D} | more


def customer_frame(spark, rows, deleted=None):
    schema = ", ".join(f"{c} {'timestamp' if c in ('source_created_at', '_ingested_at') else 'string'}" for c in conform.CUSTOMER_COLUMNS)
    df = spark.createDataFrame([tuple(r[c] for c in conform.CUSTOMER_COLUMNS) for r in rows], schema)
    return df if deleted is None else df.withColumn("_deleted", F.lit(deleted))


def history_frame(spark, rows):
    """rows (subscription, account, plan, status, from, to)"""
    return spark.createDataFrame([(s, a, p, st, D, day(f), f"{s}|{f}", day(f), None if t is None else day(t)) for s, a, p, st, f, t in rows],
                                 SUB + ", scd_id string, valid_from timestamp, valid_to timestamp")


MODELS = ["dim_customer", "fact_subscriptions", "mart_mrr", "mart_ltv", "mart_funnel", "recon_billing_vs_app"]


def full_build(spark, customers, versions, as_of):
    c, h, price = customer_frame(spark, customers), history_frame(spark, versions), plan_pricing(spark)
    dim = gold.dim_customer(None, c)
    fact = gold.fact_subscriptions(h, dim)
    return {"dim_customer": dim, "fact_subscriptions": fact, "mart_mrr": gold.mart_mrr(fact, price), "mart_ltv": gold.mart_ltv(fact, price, as_of),
            "mart_funnel": gold.mart_funnel(dim, fact), "recon_billing_vs_app": gold.recon_billing_vs_app(dim, fact)}


def test_gold_of_many_runs_equals_a_build_from_the_end_state(spark):
    rnd, as_of = random.Random(1), "2026-03-01 00:00:00"
    customers, versions = {}, {}
    store = GoldStore(spark, scratch_path(spark, "gold"), plan_pricing(spark), as_of, buckets=4)
    for run in range(4):
        changed, deleted, moved = {}, [], {}
        for _ in range(12):
            system = rnd.choice(["crm", "stripe", "app"])
            key = (system, str(rnd.randrange(8)))
            if key in customers and rnd.random() < 0.3:
                deleted.append(customers.pop(key))
                changed.pop(key, None)
                continue
            deleted = [d for d in deleted if (d["source_system"], d["source_id"]) != key]
            account = rnd.choice([None, f"a{rnd.randrange(5)}"]) if system == "app" else None
            changed[key] = customers[key] = person(*key, f"m{rnd.randrange(7)}", account)    # moves between people, shares accounts
        for _ in range(6):
            s, a = f"s{rnd.randrange(6)}", rnd.choice([None, *(f"a{k}" for k in range(6))])
            open_ = [v for v in versions.values() if v[0] == s and v[5] is None]
            start = 10 * run + rnd.randrange(9)
            if open_ and open_[0][4] < start:
                old = open_[0]
                versions[(s, old[4])] = moved[(s, old[4])] = (*old[:5], start)
                a = old[1]
            elif open_:
                continue
            versions[(s, start)] = moved[(s, start)] = (s, a, rnd.choice(["free", "basic", "pro"]), rnd.choice(["active", "canceled"]), start, None)
        records = customer_frame(spark, changed.values(), False)
        if deleted:
            records = records.unionByName(customer_frame(spark, deleted, True))
        store.apply(records, history_frame(spark, moved.values()) if moved else None, f"run {run}")
        if run < 3:
            continue
        exp = full_build(spark, customers.values(), versions.values(), as_of)
        for name in MODELS:
            assert all_rows(store.read(name), *sorted(exp[name].columns)) == all_rows(exp[name], *sorted(exp[name].columns)), (run, name)


def test_gold_is_published_after_its_gate(spark, monkeypatch):
    as_of = "2026-03-01 00:00:00"
    store = GoldStore(spark, scratch_path(spark, "gold"), plan_pricing(spark), as_of, buckets=4)
    c0 = [person("app", "1", "m1", "a1"), person("crm", "x", "m1"), person("stripe", "c", "m2")]
    h0 = [("s1", "a1", "pro", "active", 1, None)]
    store.apply(customer_frame(spark, c0), history_frame(spark, h0), "one")
    before = {n: all_rows(store.read(n)) for n in MODELS}
    seen = []
    change = customer_frame(spark, [person("stripe", "c", "m1")])       # two people become one
    def refuse(s, version):
        seen.append(s.read("dim_customer", version).count())            # the gate sees what would be published
        return False
    with pytest.raises(GateFailed):
        store.apply(change, None, "two", gate=refuse)
    assert seen == [1] and {n: all_rows(store.read(n)) for n in MODELS} == before
    monkeypatch.setattr("tidemark.plans.gold_store.published.publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        store.apply(change, None, "two")
    monkeypatch.undo()
    assert {n: all_rows(store.read(n)) for n in MODELS} == before
    store.apply(change, None, "two", gate=lambda s, v: True)
    assert store.read("dim_customer").count() == 1
    assert store.apply(None, None, "nothing") is None
    with pytest.raises(ValueError):
        GoldStore(spark, store.root, plan_pricing(spark), "2027-01-01 00:00:00")
    store.rebuild(customer_frame(spark, c0), history_frame(spark, h0), "again")
    assert {n: all_rows(store.read(n)) for n in MODELS} == before


def test_gold_keeps_apart_only_what_its_sums_need(spark, monkeypatch):
    store = GoldStore(spark, scratch_path(spark, "gold"), plan_pricing(spark), "2026-03-01 00:00:00", buckets=2)
    stored, store_ = {}, GoldStore._store
    def note(self, df, folder, name):
        kept = store_(self, df, folder, name)
        stored[name] = kept.count()
        return kept
    monkeypatch.setattr(GoldStore, "_store", note)
    people = [person("app", "1", "m1", "a1"), person("app", "2", "m2", "a2"), person("crm", "x", "m1"), person("crm", "y", None)]
    old = [("s1", "a1", "free", "active", 1, 5), ("s1", "a1", "pro", "active", 5, None), ("s2", "a2", "pro", "canceled", 2, None),
           ("s3", None, "basic", "active", 3, None)]
    store.apply(customer_frame(spark, people), history_frame(spark, old), "one")
    assert not {"in_versions", "dim_new"} & set(stored) and stored["fact_old"] == 0 and stored["fact_new"] == 2
    more = [("s1", "a1", "pro", "active", 5, 9), ("s1", "a1", "basic", "active", 9, None)]
    store.apply(None, history_frame(spark, more), "two")
    assert stored["in_versions"] == 2 and stored["alone"] <= 2 and stored["fact_old"] == 1 and stored["fact_new"] == 1
    exp = full_build(spark, people[:3], [old[0], more[0], more[1], *old[2:]], store.as_of)
    for name in MODELS:
        assert all_rows(store.read(name), *sorted(exp[name].columns)) == all_rows(exp[name], *sorted(exp[name].columns)), name


# ---------------------------------------------------------------- many instants
def test_states_at_many_instants(spark):
    rnd = random.Random(3)
    rows = []
    for s in range(40):
        at = 0
        for _ in range(rnd.randrange(1, 6) if s else 900):                # one key holds most of the versions
            to = at + rnd.choice([1, 3, 40, 900])
            rows.append((f"k{s}", at, to))
            at = to
        rows.append((f"k{s}", at, None))
    rows.append(("never", None, None))
    history = spark.createDataFrame([(k, None if a is None else day(a), None if b is None else day(b)) for k, a, b in rows],
                                    "key string, valid_from timestamp, valid_to timestamp")
    times = [rnd.randrange(-50, 4000) for _ in range(60)] + [0, 0, 1]
    instants = spark.createDataFrame([(n, day(t)) for n, t in enumerate(times)] + [(99, None)], "n int, at timestamp")
    holds = lambda a, b, t: a is not None and a <= t and (b is None or t < b)
    got = scd2.states_at(history, instants, "at")
    exp = sorted((n, k, a) for n, t in enumerate(times) for k, a, b in rows if holds(a, b, t))
    assert sorted((r["n"], r["key"], (r["valid_from"] - D).days) for r in got.collect()) == exp
    probes = instants.withColumn("key", F.concat(F.lit("k"), (F.col("n") % 7).cast("string")))
    by = scd2.states_at(history, probes, "at", by=["key"], days=7, spread=4)
    exp = sorted((n, k, a) for n, t in enumerate(times) for k, a, b in rows if k == f"k{n % 7}" and holds(a, b, t))
    assert sorted((r["n"], r["key"], (r["valid_from"] - D).days) for r in by.collect()) == exp
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert scd2.states_at(history, instants.filter("n = 99"), "at").count() == 0


def test_versions_stay_where_few_instants_look_them_up(spark, monkeypatch):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    history = spark.range(3000).select(F.col("id").alias("key"), *[(F.lit(D) + F.make_dt_interval(days=(F.col("id") % 300 + n).cast("int"))).alias(c)
                                                                   for c, n in (("valid_from", 0), ("valid_to", 40))])
    instants = spark.createDataFrame([(day(t),) for t in range(0, 400, 10)], "at timestamp")
    spark.conf.set(key, "-1")
    try:
        few = scd2.states_at(history, instants, "at")
        shuffled = lambda df: "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
        assert not shuffled(few) and few.count() == sum(10 * sum(f <= t < f + 40 for f in range(300)) for t in range(0, 400, 10))
        monkeypatch.setattr(scd2, "FEW", 39)
        many = scd2.states_at(history, instants, "at")
        assert shuffled(many) and many.exceptAll(few).isEmpty() and many.count() == few.count()
    finally:
        spark.conf.set(key, before)


# ---------------------------------------------------------------- identity
def brute_components(links):
    at = {}
    def find(x):
        at.setdefault(x, x)
        while at[x] != x:
            x = at[x]
        return x
    for a, b in links:
        if a is not None:
            find(a)
        if b is not None:
            find(b)
        if a is not None and b is not None:
            ra, rb = find(a), find(b)
            at[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in at}


def test_components_of_chains_hubs_and_singles(spark):
    rnd = random.Random(1)
    links = [(f"c{k:04}", f"c{k + 1:04}") for k in range(300)]                      # a long chain
    links += [("anon:kiosk", f"record:app:{k}") for k in range(500)]                # one device, a third of the people
    links += [(f"record:app:{k}", f"email:{k}") for k in range(1500)]
    links += [(f"r{rnd.randrange(200)}", f"e{rnd.randrange(300)}") for _ in range(200)]
    links += [("self", "self"), ("alone", None), (None, None), links[0], links[0][::-1]]
    rnd.shuffle(links)
    df = spark.createDataFrame(links, "a string, b string")
    assert {r["node"]: r["component"] for r in components.components(df).collect()} == brute_components(links)
    found = components.identity_components(df.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b"), hub=100).cache()
    kiosk = found.filter("node = 'anon:kiosk'").first()
    assert kiosk["is_hub"] and kiosk["n_links"] == 500 and kiosk["n_records"] == 500 and kiosk["n_nodes"] == 1001
    assert found.filter("via_hub").count() == 1001 and [r["node"] for r in components.hubs(found).collect()] == ["anon:kiosk"]
    assert components.components(df.limit(0)).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_timeline_with_a_hot_device(spark, partitions):
    rnd = random.Random(2)
    rows = []
    for k in range(900):
        device = "kiosk" if k % 3 == 0 else rnd.choice([None, *(f"d{x}" for x in range(40))])
        rows.append((f"e{k:04}", device, rnd.choice([None, None, None, f"u{rnd.randrange(30)}"]), None if k % 97 == 0 else day(rnd.randrange(60))))
    events = spark.createDataFrame(rows, "event_id string, anonymous_id string, user_id string, event_at timestamp")
    got = {r["event_id"]: (r["resolved_user_id"], r["resolution"]) for r in timeline.event_timeline(events, partitions).collect()}
    exp = {}
    for device in {r[1] for r in rows}:
        line = sorted((r for r in rows if r[1] == device), key=lambda r: (r[3] is not None, r[3] or D, r[0]))
        for n, (e, _, user, _) in enumerate(line):
            after = next((r[2] for r in line[n:] if r[2]), None) if device else None
            before = next((r[2] for r in reversed(line[:n]) if r[2]), None) if device else None
            exp[e] = (user, "user") if user else (after, "next_login") if after else (before, "last_login") if before else (None, "unresolved")
    assert got == exp


def test_timeline_frames_only_run_on(spark):
    """A frame up to a group's end costs the square of the group."""
    events = spark.range(20_000).select(F.col("id").alias("event_id"), F.lit("kiosk").alias("anonymous_id"),
                                        F.when(F.col("id") % 9_000 == 8_999, F.col("id")).alias("user_id"),
                                        (F.lit(D) + F.make_dt_interval(secs=F.col("id"))).alias("event_at"))
    got = timeline.event_timeline(events, 1)
    assert "unboundedfollowing" not in got._jdf.queryExecution().executedPlan().toString().lower()
    assert {(r["resolved_user_id"], r["resolution"]): r["count"] for r in got.groupBy("resolved_user_id", "resolution").count().collect()} == {
        (8_999, "next_login"): 8_999, (8_999, "user"): 1, (17_999, "next_login"): 8_999, (17_999, "user"): 1, (17_999, "last_login"): 2_000}
    twice = spark.createDataFrame([("e", "d", "u2", D), ("e", "d", None, D), ("e", "d", "u1", D)], "event_id string, anonymous_id string, user_id string, event_at timestamp")
    assert sorted(r["resolved_user_id"] for r in timeline.event_timeline(twice).collect()) == ["u1", "u1", "u2"]


# ---------------------------------------------------------------- reconciliation
def test_reconcile_looks_only_where_sides_differ(spark):
    source = spark.range(100_000).select("id", (F.col("id") % 7).cast("string").alias("v"), F.lit(None).cast("string").alias("w"))
    landed = source.filter("id NOT IN (17, 55555)").withColumn("v", F.when(F.col("id") == 20, "x").otherwise(F.col("v"))).withColumn(
        "w", F.when(F.col("id") == 55600, "").otherwise(F.col("w"))).unionByName(
        spark.createDataFrame([(100_300, "1", None), (-5, "1", None), (None, "1", None)], "id long, v string, w string"))
    rounds = reconcile.Rounds()
    got = reconcile.reconcile(source, landed, "id", ["v", "w"], ranges=16, leaf=64, rounds=rounds)
    assert sorted(map(tuple, got.collect())) == [(-5, "deleted"), (17, "missing"), (20, "changed"), (55555, "missing"), (55600, "changed"), (100300, "deleted")]
    assert rounds.log[-1][2] <= 6 * 64 and all(differ <= 6 for _, differ, _ in rounds.log)
    assert reconcile.reconcile(source, source.repartition(3), "id", ["v", "w"]).count() == 0
    assert reconcile.reconcile(source, source.limit(0), "id", ["v"], ranges=4, leaf=1000, most=2).count() == 100_000
    assert reconcile.reconcile(source.limit(0), source.limit(0), "id", ["v"]).count() == 0


def test_reconcile_with_differences_all_over(spark):
    source = spark.range(3_000_000).select((F.col("id") - 1_000_000).alias("id"), F.lit("x").alias("v"))
    rest = F.pmod(F.col("id"), F.lit(1000))
    landed = source.filter(rest != 7).withColumn("v", F.when(rest == 500, "y").otherwise(F.col("v")))
    rounds = reconcile.Rounds()
    got = reconcile.reconcile(source, landed, "id", ["v"], ranges=32, leaf=100, most=8000, rounds=rounds)
    assert {(r["status"], r["rest"]): r["count"] for r in got.groupBy("status", rest.alias("rest")).count().collect()} == {
        ("missing", 7): 3000, ("changed", 500): 3000}
    assert rounds.log[-1][1] == 6000 and rounds.log[-1][2] < 600_000
    assert reconcile._spans([9, 1, 2, 5, 30], 2) == [(1, 10), (30, 31)] and reconcile._spans([9, 1, 2, 5, 30], 9) == [(1, 3), (5, 6), (9, 10), (30, 31)]


def test_sketches_of_runs_merge(spark):
    people = spark.range(60_000).select(F.concat(F.lit("p"), F.col("id")).alias("customer_key"), F.explode(F.array(
        F.lit("crm"), F.when(F.col("id") % 2 == 0, "app"), F.when(F.col("id") % 5 == 0, "stripe"))).alias("source_system"),
        (F.col("id") % 3).alias("run")).filter("source_system IS NOT NULL")
    stored = sketch.person_sketches(people, F.col("run"))
    assert stored.count() == 9
    got = {(r["source_a"], r["source_b"]): (r["people"], r["united"]) for r in sketch.overlaps(sketch.merged(stored)).collect()}
    exact = {("app", "app"): 30_000, ("app", "crm"): 30_000, ("app", "stripe"): 6_000, ("crm", "crm"): 60_000, ("crm", "stripe"): 12_000, ("stripe", "stripe"): 12_000}
    assert set(got) == set(exact)
    for pair, n in exact.items():
        assert abs(got[pair][0] - n) <= sketch.error_bound() * got[pair][1]


# ---------------------------------------------------------------- split arrays
@pytest.mark.parametrize("split", [900, 1 << 20])
def test_json_array_split_anywhere(spark, split):
    rnd = random.Random(split)
    texts = ['"', "\\", '\\"', "}", "{", "]", "[", "},{", "é日本", "\n", "", '{"a": "}"}', '\\\\"}', "}" * 30, "plain"]
    rows = [{"id": k, "t": "".join(rnd.choices(texts, k=rnd.randrange(5))), "n": {"x": [rnd.choice(texts)] * rnd.randrange(3), "y": None}} for k in range(150)]
    root = scratch_path(spark, "array")
    local = root[5:] if root.startswith("file:") else root
    import os
    os.makedirs(local)
    with open(f"{local}/a.json", "w") as f:
        json.dump(rows, f, ensure_ascii=False, indent=rnd.choice([None, 2]))
    with open(f"{local}/b.json", "w") as f:
        f.write("[]")
    with open(f"{local}/c.json", "w") as f:
        f.write(' [ {"id": 1000, "t": "one"} ] \n')
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(split))
    try:
        got = read_split_array(spark, root, "id long, t string, n struct<x: array<string>, y: string>").collect()
    finally:
        spark.conf.set(key, before)
    assert sorted((r["id"], r["t"], r["n"]["x"] if r["n"] else None) for r in got) == [(r["id"], r["t"], r["n"]["x"]) for r in rows] + [(1000, "one", None)]
