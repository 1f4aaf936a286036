"""The ordered pipeline (N9): ingest -> silver -> snapshot -> gold -> checks.

One call is one scheduled run with a logical clock ``as_of``. Tables are
Parquet folders under ``warehouse`` (``bronze/``, ``silver/``,
``snapshots/``, ``gold/``): every written table cuts the lineage, so a lost
executor recomputes from the last written table, never from the sources.

The subscription snapshot is the incremental SCD-2 path: each run applies
the changes that the history does not hold yet to the hash buckets they touch
(``plans.scd_store``). Gold is written to a folder of the run, audited there,
and becomes visible by one pointer (``sources.published``) when no gate
failed: readers see the gold of the last good run, whole, at any moment.

Row counts of every written table are measured while writing
(``DataFrame.observe``), without a second pass (E5).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import from_iso8601, ts_literal
from tidemark.operators import conform, dedupe, dq, rules, silver
from tidemark.operators.dedupe import latest_per_key
from tidemark.plans.model import Lakehouse
from tidemark.plans.scd_store import BucketedHistory, RunResult
from tidemark.session import scratch_path
from tidemark.sources import landing, published
from tidemark.sources.registry import plan_pricing
from tidemark.streaming.id_index import NULL_FOLDER, IdIndex

SILVER = ["customers", "identity_map", "subscriptions", "events"]
STATEFUL_SILVER = ["events", "subscriptions", "app_user_state"]
GOLD = ["dim_customer", "fact_subscriptions", "mart_mrr", "mart_ltv", "mart_funnel",
        "recon_billing_vs_app"]
SNAPSHOT_COLUMNS = ["subscription_id", "account_id", "plan", "status", "sub_started_at",
                    "sub_updated_at"]


@dataclass
class PipelineRun:
    as_of: str
    landed: dict[str, int]
    rows: dict[str, int]
    checks: list[dict] = field(default_factory=list)
    gates: dict[str, str] = field(default_factory=dict)
    published: int | None = None        # number of the gold version this run made visible
    freshness: dict[str, float] = field(default_factory=dict)   # hours since the last landing, per bronze table

    @property
    def pass_rate(self) -> float | None:
        if not self.checks:
            return None
        return sum(c["outcome"] == "pass" for c in self.checks) / len(self.checks)


def _write(df: DataFrame, path: str, name: str, rows: dict[str, int],
           partition_by: str | None = None) -> None:
    obs = Observation(f"rows_{name}")
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    rows[name] = int(obs.get.get("n", 0))


def _swap_in(spark: SparkSession, df: DataFrame, path: str, name: str, rows: dict[str, int]) -> None:
    stage = path.rstrip("/") + "__stage"
    landing.recover_table(spark, path)
    landing.drop_table(spark, stage)
    _write(df, stage, name, rows)
    landing._swap(spark, stage, path)


def _run_id(as_of) -> str:
    """Sortable, path-safe id of a run: 20010901T000000."""
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    return as_of.strftime("%Y%m%dT%H%M%S")


def history_of(spark: SparkSession, root: str, buckets: int = 16) -> BucketedHistory:
    """``buckets`` counts for a new history only: a stored one keeps its own."""
    return BucketedHistory(spark, root, "subscription_id", "sub_updated_at", buckets, ("plan", "status", "account_id"))


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Open versions + history, as one table."""
    return history_of(spark, root).read()


def snapshot_run(spark: SparkSession, changes: DataFrame, root: str, run_id: str, rows: dict[str, int],
                 buckets: int = 16) -> DataFrame | None:
    """One SCD-2 run over the bucketed state (``plans.scd_store``): ``changes``
    are the rows new since the last run, or any superset of them (the whole
    source gives the same, and touches every bucket). Every run compares,
    whatever its clock: the same rows again change nothing, new rows under a
    repeated or older clock are taken in. Counts come from the commit, not
    from the table."""
    history = history_of(spark, root, buckets)
    done = history.apply(changes.select(SNAPSHOT_COLUMNS), run_id)
    version = history.version()
    _count_versions(version, done, rows)
    return history.read(version)


def _count_versions(version: published.Version | None, done: RunResult, rows: dict[str, int]) -> None:
    rows["scd_opened_by_run"], rows["scd_closed_by_run"] = done.opened, done.closed
    rows["scd_open"] = version.facts["n_open"] if version else 0
    rows["scd_subscriptions"] = version.facts["n_all"] if version else 0


# Which landing runs a silver table holds: a note in its folder, the number of
# bronze rows merged per run. It is written after the table, so a crash between
# the two merges those rows once more, which changes nothing (the latest copy
# per key stays the latest); so does a note that is lost or half written.
MERGED_NOTE = "_tidemark_merged.json"


def _landed_runs(bronze: DataFrame) -> dict[str, int]:
    """Bronze rows per landing run (one row per run reaches the driver)."""
    return {r["run"]: r["n"] for r in bronze.groupBy(F.col("_ingested_at").alias("run"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}


def _to_merge(spark: SparkSession, bronze: DataFrame, path: str,
              landed: dict[str, int] | None = None) -> tuple[DataFrame | None, dict[str, int]]:
    """The bronze rows of every landing run that ``path`` does not hold in
    full yet, whichever run landed them (None when it holds all), and the
    counts to record (``landed``: those counts, where they are known already)."""
    landed = _landed_runs(bronze) if landed is None else landed
    try:
        held = dict(published.read_note(spark, f"{path}/{MERGED_NOTE}") or [])
    except ValueError:
        held = {}
    missing = [r for r, n in landed.items() if held.get(r) != n]
    if not missing:
        return None, landed
    known = [r for r in missing if r is not None]
    wanted = F.col("_ingested_at").isin(known) if known else F.lit(False)
    if len(known) < len(missing):
        wanted = wanted | F.col("_ingested_at").isNull()
    return bronze.filter(wanted), landed


def _set_merged(spark: SparkSession, path: str, landed: dict[str, int]) -> None:
    published.write_note(spark, f"{path}/{MERGED_NOTE}", list(landed.items()))


def _event_order():
    return [F.col("_ingested_at").desc_nulls_last(), F.col("app_version").asc_nulls_last(),
            F.col("event_at").asc_nulls_last()]


def _folder_name():
    return F.coalesce(F.col("event_date").cast("string"), F.lit(NULL_FOLDER))


def _dates(df: DataFrame) -> dict[str, int]:
    """Rows per event date (one row per date reaches the driver)."""
    return {r["d"]: r["n"] for r in df.groupBy(_folder_name().alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}


def _index_dates(index: IdIndex, rows: DataFrame) -> None:
    if dates := _dates(rows):
        index.record(rows, list(dates), max(dates.values()))


def _events_run(spark: SparkSession, bronze: DataFrame | None, path: str,
                rows: dict[str, int]) -> DataFrame:
    """Silver events, partitioned by event date and merged incrementally.

    First run: the whole bronze table, latest copy per event id. Later runs:
    the bronze rows not merged yet, one copy per id. The dates to rewrite are
    those of the batch and those where an older copy of a batch id may lie, so a
    copy with a corrected time leaves its old date; dates left without a row
    are dropped. Which dates these are is said by bit fields per date
    (``streaming.id_index``), so that only dates to rewrite are read; the ids of
    a date without bit fields (a run died between its rows and them) are read. Rows go to the writers by date through a rebalance, which
    splits a day that holds a large share (and the rows without a date).
    """
    if bronze is None:
        return spark.read.parquet(path) if landing.table_exists(spark, path) else None
    dated = lambda df: df.withColumn("event_date", F.to_date("event_at"))
    if not landing.table_exists(spark, path):
        landed = _landed_runs(bronze)
        _write(dated(silver.events_latest(bronze)).hint("rebalance", "event_date"),
               path, "events_merged", rows, partition_by="event_date")
        stored = spark.read.parquet(path)
        _index_dates(IdIndex(spark, path, "event_id", by="event_date"), stored)
        _set_merged(spark, path, landed)
        return stored
    new, landed = _to_merge(spark, bronze, path)
    if new is None:
        rows["events_batch"] = rows["events_merged"] = 0
        return spark.read.parquet(path)
    work = scratch_path(spark, "silver-events")
    _write(dated(silver.events_latest(new)), f"{work}/batch", "events_batch", rows)
    if not rows["events_batch"]:
        rows["events_merged"] = 0
        _set_merged(spark, path, landed)
        return spark.read.parquet(path)
    batch, current = spark.read.parquet(f"{work}/batch"), spark.read.parquet(path)
    index = IdIndex(spark, path, "event_id", by="event_date")
    day = lambda c: F.when(F.col(c) != NULL_FOLDER, F.col(c)).cast("date").alias("event_date")
    moved = spark.createDataFrame([(d,) for d in sorted({d for d, _ in index.named(batch)})], "d string").select(day("d"))
    if unknown := index.unknown():
        moved = moved.union(current.filter(_folder_name().isin(unknown)).join(batch.select("event_id"), "event_id", "left_semi")
                            .select("event_date"))
    _write(moved.union(batch.select("event_date")).distinct(), f"{work}/dates", "events_dates", rows)
    dates = spark.read.parquet(f"{work}/dates")
    touched = current.join(dates.withColumnRenamed("event_date", "d"),
                           F.col("event_date").eqNullSafe(F.col("d")), "left_semi")
    merged = dedupe.latest_per_key(touched.unionByName(batch.select(touched.columns)),
                                   ["event_id"], _event_order())
    _write(merged.hint("rebalance", "event_date"), f"{work}/merged", "events_merged", rows)
    merged = spark.read.parquet(f"{work}/merged")
    index.forget([*_dates(dates)])
    (merged.hint("rebalance", "event_date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path))
    left = merged.select(F.col("event_date").alias("d")).distinct()
    for r in (dates.join(left, F.col("event_date").eqNullSafe(F.col("d")), "left_anti")
              .select(_folder_name().alias("p"))
              .toLocalIterator()):      # dates without a row any more: a folder each
        landing.drop_table(spark, f"{path}/event_date={r['p']}")
    _index_dates(index, merged)
    _set_merged(spark, path, landed)
    landing.drop_table(spark, work)
    return spark.read.parquet(path)


def _state_run(spark: SparkSession, bronze: DataFrame, path: str, name: str, conformed, keys: list[str],
               order, rows: dict[str, int], landed: dict[str, int] | None = None) -> DataFrame:
    """A "latest per key" state without rescanning its log: the latest over
    (stored state + bronze rows not merged yet) equals the latest over all of
    bronze (the order is total), so a run reads O(keys + new changes)."""
    landing.recover_table(spark, path)
    if not landing.table_exists(spark, path):
        landed = _landed_runs(bronze) if landed is None else landed
        _write(latest_per_key(conformed(bronze), keys, order), path, name, rows)
    else:
        new, landed = _to_merge(spark, bronze, path, landed)
        prev = spark.read.parquet(path)
        if new is None:                 # nothing landed since: the state stays as it lies
            rows[name] = prev.count()   # from the files' footers
            return prev
        merged = latest_per_key(prev.unionByName(conformed(new).select(prev.columns)), keys, order)
        _swap_in(spark, merged, path, name, rows)
    _set_merged(spark, path, landed)
    return spark.read.parquet(path)


def _subscriptions_run(spark: SparkSession, bronze: DataFrame, path: str, rows: dict[str, int],
                       landed: dict[str, int] | None = None) -> DataFrame:
    return _state_run(spark, bronze, path, "subscriptions", silver.subscriptions_latest, ["subscription_id"],
                      silver.subscription_order(updated="sub_updated_at", ingested="_ingested_at"), rows, landed)


def _history_run(spark: SparkSession, bronze: DataFrame, root: str, run_id: str, rows: dict[str, int],
                 landed: dict[str, int] | None = None, buckets: int = 16) -> DataFrame:
    """The landed changes that the history does not hold yet, as one run. Its
    own record of landing runs is written after the commit: a run that dies
    in between brings its changes once more, which changes nothing."""
    new, landed = _to_merge(spark, bronze, root, landed)
    history = history_of(spark, root, buckets)
    if new is None and history.version() is not None:
        _count_versions(history.version(), RunResult(None, 0, 0, 0), rows)
        return history.read()
    changes = silver.subscriptions_latest(bronze if new is None else new)
    snapshot = snapshot_run(spark, changes, root, run_id, rows, buckets)
    _set_merged(spark, root, landed)
    return snapshot if snapshot is not None else changes.limit(0)


def _customers_run(spark: SparkSession, bronze: dict, warehouse: str, rows: dict[str, int]) -> DataFrame:
    """Silver customers without rescanning the app-user log.

    Records of different source systems never share a key, so "latest per
    (source_system, source_id)" over the union equals the union of the
    per-source results. The CRM and billing extracts are full loads (their
    bronze is replaced every run) and are conformed whole; the append-only
    app users are kept as a state, like subscriptions.
    """
    state = _state_run(spark, bronze["app_users"], f"{warehouse}/silver/app_user_state", "app_user_state",
                       conform.conform_app, ["source_system", "source_id"], conform.customer_order(), rows)
    full_loads = conform.customers(conform.conform_crm(bronze["crm_contacts"]),
                                   conform.conform_billing(bronze["stripe_customers"]))
    path = f"{warehouse}/silver/customers"
    _swap_in(spark, full_loads.unionByName(state.select(conform.CUSTOMER_COLUMNS)), path, "customers", rows)
    return spark.read.parquet(path)


OWNER = "tidemark.warehouse"       # table property: whose folders a registered name shows


class NameTaken(RuntimeError):
    """A table of that name is not this warehouse's; it was left as it is."""


def _owner(spark: SparkSession, name: str) -> str | None:
    """The warehouse that registered an external table, None for any other."""
    held = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if held.get("Type") != "EXTERNAL":
        return None
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return props.get(OWNER)


def table_places(spark: SparkSession, registry: dict, warehouse: str, prefix: str = "") -> dict[str, str]:
    """`schema`.`table` -> folder of every stored table there is."""
    places = {cfg["target_bronze"]: landing.table_path(warehouse, cfg["target_bronze"]) for cfg in registry.values()}
    places |= {f"silver.{n}": f"{warehouse}/silver/{n}" for n in SILVER}
    gold = published.current(spark, f"{warehouse}/gold")
    places |= {f"gold.{n}": published.path_of(f"{warehouse}/gold", gold, n) for n in (gold.places if gold else {})}
    return {"`{}`.`{}`".format(*f"{prefix}{n}".split(".", 1)): p for n, p in places.items() if landing.table_exists(spark, p)}


def check_names(spark: SparkSession, registry: dict, warehouse: str, prefix: str = "") -> None:
    """Refuse, before anything is done, names that others hold."""
    names = [cfg["target_bronze"] for cfg in registry.values()] + [f"silver.{n}" for n in SILVER] + [f"gold.{n}" for n in GOLD]
    for n in names:
        name = "`{}`.`{}`".format(*f"{prefix}{n}".split(".", 1))
        if spark.catalog.tableExists(name.replace("`", "")) and _owner(spark, name) != warehouse:
            raise NameTaken(f"{name} is not a table of {warehouse}; register under another prefix")


def register_tables(spark: SparkSession, registry: dict, warehouse: str, prefix: str = "") -> list[str]:
    """Make the stored tables reachable by name (S12, S23, S24): external
    tables ``bronze.*``, ``silver.*`` and ``gold.*`` of the session's catalog
    over the warehouse's folders, gold over the published version. ``prefix``
    sets apart the schemas of several warehouses. A name that another
    warehouse registered, or that is a table of anyone else, is refused
    before any name is touched; own names are only made anew, never their
    files."""
    check_names(spark, registry, warehouse, prefix)
    made = []
    for name, path in table_places(spark, registry, warehouse, prefix).items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        if spark.catalog.tableExists(name.replace("`", "")):
            spark.sql(f"DROP TABLE {name}")             # own and external (checked above): files stay
        columns = ""
        if name.startswith(f"`{prefix}bronze"):
            fields = landing.read_table(spark, path).schema.fields
            columns = " (" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ")"
        spark.sql(f"CREATE TABLE {name}{columns} USING parquet LOCATION '{path}' TBLPROPERTIES ('{OWNER}' = '{warehouse}')")
        if name == f"`{prefix}silver`.`events`":
            spark.catalog.recoverPartitions(name.replace("`", ""))
        made.append(name.replace("`", ""))
    return made


def gold_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """A gold table of the last published run."""
    return published.read(spark, f"{warehouse}/gold", name)


def _iso(as_of) -> str:
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=_dt.timezone.utc)
    return as_of.isoformat()


def run_pipeline(spark: SparkSession, registry: dict, warehouse: str, as_of,
                 full_refresh: bool = False, names=None, scale: float = 1.0,
                 reference_now=None, gate_layers=("bronze", "silver", "gold"),
                 raise_on_fail: bool = False, lookback=None, reset_history: bool = False,
                 prefix: str | None = None, publish_failed: bool = False, history_buckets: int = 16) -> PipelineRun:
    """Run the whole pipeline once at logical time ``as_of``. Gold is published
    when every gate of ``gate_layers`` lets it (a failed or unanswered one
    keeps the earlier gold in view, unless ``publish_failed``).
    ``history_buckets``: of a new SCD-2 history, so many that an open bucket
    fits a task. ``prefix`` (the empty one too) registers
    the tables by name, see ``register_tables``; None registers none. ``lookback``
    (a timedelta) re-reads that much before each watermark (E6).
    ``full_refresh`` rebuilds incremental bronze and the silver tables kept
    from it (S28); the SCD-2 history stays unless ``reset_history`` drops it
    (S27). A check whose table is missing counts as one that could not run."""
    as_of_text = str(as_of)
    if prefix is not None:
        check_names(spark, registry, warehouse, prefix)
    if full_refresh:                                   # S28: reset incremental tables
        landing.reset(spark, registry, warehouse)
        for name in STATEFUL_SILVER:
            landing.drop_table(spark, f"{warehouse}/silver/{name}")
    if reset_history:                                  # S27
        landing.drop_table(spark, f"{warehouse}/snapshots/scd_subscriptions")
    landed = landing.ingest(spark, registry, warehouse, names, run_ts=_iso(as_of),
                            lookback=lookback)

    bronze = {}
    for name, cfg in registry.items():
        path = landing.table_path(warehouse, cfg["target_bronze"])
        if landing.table_exists(spark, path):
            bronze[name] = landing.read_table(spark, path)
    lh = Lakehouse(spark, bronze, as_of_text, plan_pricing(spark))
    rows: dict[str, int] = {}
    sub_runs = _landed_runs(bronze["app_subscriptions"]) if "app_subscriptions" in bronze else None

    for n in SILVER:        # identity_map comes after customers: it reads the written table
        if n == "events":
            lh.__dict__[n] = _events_run(spark, bronze.get("app_events"),
                                         f"{warehouse}/silver/events", rows)
            continue
        if n == "customers" and {"crm_contacts", "stripe_customers", "app_users"} <= set(bronze):
            lh.__dict__[n] = _customers_run(spark, bronze, warehouse, rows)
            continue
        if n == "subscriptions" and "app_subscriptions" in bronze:
            lh.__dict__[n] = _subscriptions_run(spark, bronze["app_subscriptions"],
                                                f"{warehouse}/silver/subscriptions", rows, sub_runs)
            continue
        _swap_in(spark, getattr(lh, n), f"{warehouse}/silver/{n}", n, rows)
        lh.__dict__[n] = spark.read.parquet(f"{warehouse}/silver/{n}")

    snapshots = f"{warehouse}/snapshots/scd_subscriptions"
    if "app_subscriptions" in bronze:
        lh.__dict__["scd_subscriptions"] = _history_run(spark, bronze["app_subscriptions"], snapshots, _run_id(as_of), rows, sub_runs,
                                                         history_buckets)
    else:
        lh.__dict__["scd_subscriptions"] = snapshot_run(spark, lh.subscriptions, snapshots, _run_id(as_of), rows, history_buckets)

    gold_root, folder = f"{warehouse}/gold", f"runs/{_run_id(as_of)}-{uuid.uuid4().hex[:8]}"
    before = published.current(spark, gold_root)
    def build(n: str) -> None:      # seen by nobody until it is published
        _write(getattr(lh, n), f"{gold_root}/{folder}/{n}", n, rows)
        lh.__dict__[n] = spark.read.parquet(f"{gold_root}/{folder}/{n}")
    build("dim_customer")
    build("fact_subscriptions")
    with ThreadPoolExecutor(len(GOLD)) as pool:     # the marts do not read each other
        list(pool.map(inheritable_thread_target(spark)(build), GOLD[2:]))

    run = PipelineRun(as_of_text, landed, rows, freshness=_freshness(spark, bronze, as_of))
    tables = dict(lh.bronze)
    tables.update({n: getattr(lh, n) for n in SILVER + GOLD})
    layer_checks = {layer: rules.checks_for(layer) for layer in gate_layers}
    all_checks = [c for cs in layer_checks.values() for c in cs if c.table in tables]
    collected = [{"layer": layer, "table_name": c.table, "check_name": c.name, "value": None, "outcome": "error"}
                 for layer, cs in layer_checks.items() for c in cs if c.table not in tables]
    if all_checks:      # every layer's checks in one job; one verdict row per check
        res = dq.run_checks(spark, tables, all_checks, as_of_text, reference_now, scale=scale)
        collected += [r.asDict() for r in res.collect()]
    run.checks.extend(collected)
    for layer, cs in layer_checks.items():
        if not cs:
            continue
        counts: dict[str, int] = {}
        for r in collected:
            if r["layer"] == layer:
                counts[r["outcome"]] = counts.get(r["outcome"], 0) + 1
        try:
            run.gates[layer] = dq.gate_counts(counts)
        except dq.GateError as e:
            run.gates[layer] = "fail" if e.code == 2 else "error"
            if raise_on_fail:
                raise
    if publish_failed or not {"fail", "error"} & set(run.gates.values()):
        run.published = published.publish(spark, gold_root, before, {n: f"{folder}/{n}" for n in GOLD},
                                          {"as_of": as_of_text, "gates": run.gates}).number
        published.clean(spark, gold_root, "runs")
    if prefix is not None:
        register_tables(spark, registry, warehouse, prefix)
    _record_run(spark, warehouse, _run_id(as_of), run)
    return run


def _freshness(spark: SparkSession, bronze: dict[str, DataFrame], as_of) -> dict[str, float]:
    """Hours from the last landing of each bronze table to ``as_of`` (E5), in
    one job that reads one column; tables never landed are left out."""
    if not bronze:
        return {}
    last = [df.agg(F.max(from_iso8601(F.col("_ingested_at"))).alias("at")).select(F.lit(n).alias("name"), "at") for n, df in bronze.items()]
    rows = reduce(DataFrame.union, last).select("name", (F.unix_seconds(ts_literal(as_of)) - F.unix_seconds("at")).alias("s")).collect()
    return {r["name"]: r["s"] / 3600 for r in rows if r["s"] is not None}


def _record_run(spark: SparkSession, warehouse: str, run_id: str, run: PipelineRun) -> None:
    """Keep the run's metrics and check verdicts (E5) in run-partitioned
    tables under ``warehouse/quality`` (a retried run overwrites its own
    partition). A handful of rows per run, written from the driver."""
    metrics = ([("landed", k, float(v)) for k, v in run.landed.items()]
               + [("rows", k, float(v)) for k, v in run.rows.items()]
               + [("gate", k, {"pass": 0.0, "warn": 1.0}.get(v, 2.0)) for k, v in run.gates.items()]
               + [("freshness_hours", k, v) for k, v in run.freshness.items()])
    if run.published is not None:
        metrics.append(("published", "gold", float(run.published)))
    if run.pass_rate is not None:
        metrics.append(("checks", "pass_rate", float(run.pass_rate)))
    m = spark.createDataFrame(metrics, "kind string, name string, value double")
    (m.withColumn("run_id", F.lit(run_id)).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
     .parquet(f"{warehouse}/quality/run_metrics"))
    if run.checks:
        c = spark.createDataFrame(
            [(r["layer"], r["table_name"], r["check_name"], r["value"], r["outcome"])
             for r in run.checks],
            "layer string, table_name string, check_name string, value double, outcome string")
        (c.withColumn("run_id", F.lit(run_id)).coalesce(1).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
         .parquet(f"{warehouse}/quality/check_results"))
