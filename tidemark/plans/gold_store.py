"""Gold kept by affected keys (M9-M14, S23): changes flow through the models.

A run brings changed customer records and changed subscription versions.
From them follow, key by key, what can have changed at all:

    records -> persons (of the record's old and new e-mail) -> dimension rows
    -> accounts (of the old and new rows, and of the changed versions)
    -> fact rows -> persons again -> marts

Dimension and fact rows of touched keys are computed anew from the stored
records and versions by the same functions as a full build. Marts are sums
over persons or versions: what the touched keys gave before is retracted,
what they give now is added. Per-person LTV rows are replaced.

Every model is stored in hash buckets of its key; a run reads the buckets of
the touched keys and writes those anew. All models become visible by one
pointer (``sources.published``), and only after ``gate`` has passed what the
run wrote; a failed gate or a run that dies leaves the earlier gold readable.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import customer_key_of, months_between_whole, ratio, clamp_non_negative, ts_literal
from tidemark.operators import gold
from tidemark.operators.conform import CUSTOMER_COLUMNS
from tidemark.sources import published
from tidemark.sources.landing import drop_table, path_exists

RECORD = ["source_system", "source_id"]
#: stored model -> the columns that its bucket is a hash of
BUCKETED = {
    "record_keys": RECORD,                 # record -> the person it counts for
    "records": ["customer_key"],
    "dim_customer": ["customer_key"],
    "bridge": ["account_id"],              # account -> person, as the dimension has it
    "versions": ["_place"],                # account, or subscription where there is none
    "fact_subscriptions": ["_place"],
    "ltv": ["customer_key"],
}
#: keys and ids are hex digests: half their size in a codec that counts symbols
CODEC = {"compression": "zstd"}
#: parts of a bucket that ``_upsert`` gives to tasks of their own
SLICES = 8
#: small tables, written whole by each run
TOTALS = ["mrr_counts", "funnel_counts", "recon_counts", "orphan_months"]


class GateFailed(RuntimeError):
    """The gate refused a run's gold; what was published before stays."""


def _placed(versions: DataFrame) -> DataFrame:
    """Versions without an account spread by subscription, not in one bucket."""
    return versions.withColumn("_place", F.coalesce(F.concat(F.lit("a"), F.col("account_id")), F.concat(F.lit("s"), F.col("subscription_id"))))


class GoldStore:
    """The stored gold under ``root``. ``pricing`` is the price list, ``as_of``
    the logical clock of tenure; another ``as_of`` or price list needs a store
    (or a ``rebuild``) of its own, since it changes every person's value."""

    def __init__(self, spark: SparkSession, root: str, pricing: DataFrame, as_of, buckets: int = 64):
        self.spark, self.root, self.pricing, self.as_of = spark, root.rstrip("/"), pricing, str(as_of)
        held = published.current(spark, self.root)
        self.buckets = held.facts["buckets"] if held else buckets
        if held and held.facts["as_of"] != self.as_of:
            raise ValueError(f"the store is of {held.facts['as_of']}; give it a root of its own per as_of")

    # ---------------------------------------------------------------- storage
    def _bucket(self, model: str) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in BUCKETED[model]]), F.lit(self.buckets)).cast("int")

    def _numbers(self, model: str, keys: DataFrame) -> list[int]:
        """Buckets of the keys: at most ``buckets`` numbers."""
        return [r["b"] for r in keys.select(self._bucket(model).alias("b")).distinct().collect()]

    def _held(self, version, model: str, numbers: list[int], like: DataFrame) -> DataFrame:
        places = [version.places[f"{model}/{b}"] for b in numbers if f"{model}/{b}" in version.places] if version else []
        if not places:
            return like.limit(0)
        return self.spark.read.schema(like.schema).parquet(*[f"{self.root}/{p}" for p in places])

    def _keep(self, df: DataFrame, folder: str, model: str, numbers: list[int], joined: bool = False) -> tuple[DataFrame, dict[str, str]]:
        """Write the touched buckets of a model; places of all of them (a
        bucket left without rows has no folder). A bucket goes to as many
        tasks as its size asks for; ``joined`` rows are written by the tasks
        that joined them (a file each per bucket), not shuffled once more."""
        path = f"{self.root}/{folder}/{model}"
        placed = df.withColumn("_b", self._bucket(model))
        (placed if joined else placed.hint("rebalance", "_b")).write.options(**CODEC).partitionBy("_b").parquet(path)
        return self._written(path, df), {f"{model}/{b}": f"{folder}/{model}/_b={b}" for b in numbers}

    def _upsert(self, held: DataFrame, moved: DataFrame, key: str, folder: str, model: str, numbers: list[int]) -> tuple[DataFrame, dict[str, str]]:
        """As ``_keep``, of the ``held`` rows and, in place of those with the
        key of a ``moved`` one (which has the same bucket columns), the
        ``moved``: each row is shuffled once, to a slice of its bucket, and
        rows of one account stay together, which packs better."""
        path, place = f"{self.root}/{folder}/{model}", BUCKETED[model]
        same = Window.partitionBy("_b", "_slice", *place, key)
        both = held.withColumn("_moved", F.lit(0)).unionByName(moved.withColumn("_moved", F.lit(1)))
        (both.withColumn("_b", self._bucket(model)).withColumn("_slice", F.pmod(F.hash(*place), F.lit(SLICES))).repartition("_b", "_slice")
         .withColumn("_last", F.max("_moved").over(same)).filter(F.col(key).isNull() | (F.col("_moved") == F.col("_last")))
         .select(*held.columns, "_b").write.options(**CODEC).partitionBy("_b").parquet(path))
        return self._written(path, held), {f"{model}/{b}": f"{folder}/{model}/_b={b}" for b in numbers}

    def _written(self, path: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).option("basePath", path).option("recursiveFileLookup", True).parquet(path)

    def _store(self, df: DataFrame, folder: str, name: str) -> DataFrame:
        path = f"{self.root}/{folder}/{name}"
        df.write.options(**CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # ---------------------------------------------------------------- reading
    def read(self, model: str, version: published.Version | None = None) -> DataFrame:
        """A gold model as the visible commit has it."""
        version = version or published.current(self.spark, self.root)
        if version is None:
            raise LookupError(f"no gold published under {self.root}")
        total = lambda name: self.spark.read.parquet(f"{self.root}/{version.places[name]}")
        if model == "mart_mrr":
            return total("mrr_counts").join(self.pricing, "plan").select(
                "plan", F.col("n").alias("active_subscriptions"), "monthly_price", (F.col("n") * F.col("monthly_price")).cast("bigint").alias("mrr"))
        if model == "mart_funnel":
            return total("funnel_counts").select(
                "leads", "signups", "paid", ratio(F.col("signups"), F.col("leads")).alias("lead_to_signup_rate"),
                ratio(F.col("paid"), F.col("signups")).alias("signup_to_paid_rate"))
        if model == "recon_billing_vs_app":
            return total("recon_counts").select("recon_status", F.col("n").alias("n_customers"))
        if model == "mart_ltv":
            people = self._model(version, "ltv")
            orphans = total("orphan_months").agg(
                F.sum("n").alias("active_subscriptions"), F.sum(F.col("n") * F.col("monthly_price")).cast("bigint").alias("current_mrr"),
                F.max("months").cast("bigint").alias("tenure_months"),
                F.sum(F.col("n") * F.col("monthly_price") * F.col("months")).cast("bigint").alias("ltv_to_date")).filter("active_subscriptions IS NOT NULL")
            return people.unionByName(orphans.withColumn("customer_key", F.lit(None).cast("string")))
        return self._model(version, model)

    def _model(self, version: published.Version, model: str) -> DataFrame:
        schema = version.facts["schemas"][model]
        places = [p for t, p in version.places.items() if t.startswith(model + "/")]
        df = self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in places]) if places else self.spark.createDataFrame([], schema)
        return df.drop("_place")

    # ---------------------------------------------------------------- a run
    def apply(self, records: DataFrame | None, versions: DataFrame | None, label: str,
              gate: Callable[[GoldStore, published.Version], bool] | None = None) -> published.Version | None:
        """Take over one run's changes and publish, if ``gate`` agrees.

        ``records``: customer records in the form of silver, each the new
        state of its (source_system, source_id), or with ``_deleted`` true its
        removal. ``versions``: SCD-2 versions new or changed, by ``scd_id``.
        One row per record and per version. The same changes again change
        nothing. Returns the new version, None when there was nothing to do.
        """
        spark, before = self.spark, published.current(self.spark, self.root)
        folder = f"commits/{uuid.uuid4().hex[:12]}"
        places = dict(before.places) if before else {}
        try:
            written = self._propagate(before, records, versions, folder, places)
        except Exception:
            drop_table(spark, f"{self.root}/{folder}")
            raise
        if written is None:
            drop_table(spark, f"{self.root}/{folder}")
            return None
        return self._commit(before, written, folder, places, label, gate)

    def rebuild(self, customers: DataFrame, history: DataFrame, label: str, gate=None) -> published.Version | None:
        """All of gold anew from whole silver tables, published like a run: the
        earlier gold is readable until then."""
        folder, places = f"commits/{uuid.uuid4().hex[:12]}", {}
        written = self._propagate(None, customers, history, folder, places)
        return None if written is None else self._commit(published.current(self.spark, self.root), written, folder, places, label, gate)

    def _commit(self, before, written, folder, places, label, gate) -> published.Version:
        existing = self._existing(places)
        schemas = {m: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in s.fields) for m, s in written.items()}
        facts = {"label": label, "buckets": self.buckets, "as_of": self.as_of, "schemas": schemas}
        if gate is not None and not gate(self, published.Version(0, existing, facts)):
            drop_table(self.spark, f"{self.root}/{folder}")
            raise GateFailed(f"run {label} was not published")
        made = published.publish(self.spark, self.root, before, existing, facts)
        published.clean(self.spark, self.root, "commits")
        return made

    def _existing(self, places: dict[str, str]) -> dict[str, str]:
        """A bucket that lost all its rows has no folder."""
        fresh: dict[str, bool] = {}
        return {t: p for t, p in places.items() if fresh.setdefault(p, path_exists(self.spark, f"{self.root}/{p}"))}

    def _propagate(self, before, records, versions, folder, places) -> dict | None:
        """Write what a run changes. Tables that do not read each other are
        written side by side; leaving the block waits for all of them, so that
        nothing is still writing when a failed run's folder goes."""
        in_thread = inheritable_thread_target(self.spark)
        with ThreadPoolExecutor(8) as pool:
            return self._flow(lambda fn, *args: pool.submit(in_thread(fn), *args), before, records, versions, folder, places)

    def _flow(self, beside, before, records, versions, folder, places) -> dict | None:
        spark = self.spark
        empty_records = spark.createDataFrame([], ", ".join(f"{c} {'timestamp' if c in ('source_created_at', '_ingested_at') else 'string'}"
                                                            for c in CUSTOMER_COLUMNS))
        if records is None:
            records = empty_records
        if "_deleted" not in records.columns:
            records = records.withColumn("_deleted", F.lit(False))
        changed = beside(self._store, records.select(*CUSTOMER_COLUMNS, "_deleted", customer_key_of(F.col("email_hash")).alias("customer_key")),
                              folder, "in_records")
        empty_versions = spark.createDataFrame([], "subscription_id string, account_id string, plan string, status string, sub_started_at timestamp, "
                                                   "sub_updated_at timestamp, scd_id string, valid_from timestamp, valid_to timestamp")
        moved = _placed((versions if versions is not None else empty_versions).select(empty_versions.columns))
        if before is None:      # all versions there are: stored as the model at once
            moved, moved_places = self._keep(moved, folder, "versions", list(range(self.buckets)))
        else:
            moved = self._store(moved, folder, "in_versions")
        changed = changed.result()
        if changed.isEmpty() and moved.isEmpty():
            return None

        # persons: those the changed records counted for, and count for now
        like_keys = changed.select(*RECORD, "customer_key")
        r_numbers = self._numbers("record_keys", changed)
        held_keys = self._held(before, "record_keys", r_numbers, like_keys)
        alive = changed.filter("NOT _deleted")
        old_keys = held_keys.join(changed.select(RECORD), RECORD, "left_semi")
        persons = self._store(old_keys.select("customer_key").union(alive.select("customer_key")).distinct(), folder, "persons")
        kept = [beside(self._keep, held_keys.join(changed.select(RECORD), RECORD, "left_anti").unionByName(alive.select(*RECORD, "customer_key")),
                       folder, "record_keys", r_numbers)]
        p_numbers = self._numbers("records", persons)
        like_records = changed.drop("_deleted")
        held_records = self._held(before, "records", p_numbers, like_records)
        new_records, p = self._keep(held_records.join(changed.select(RECORD), RECORD, "left_anti").unionByName(alive.drop("_deleted")),
                                    folder, "records", p_numbers)
        places |= p
        # dimension
        # what a first run stores is touched, all of it
        touched = lambda df, keys, on: (df.filter(F.col(on).isNotNull()) if before is None else df.join(keys, on, "left_semi"))
        dim_plan = gold.dim_customer(None, touched(new_records, persons, "customer_key").select(*CUSTOMER_COLUMNS))
        if before is None:
            dim_new, p = self._keep(dim_plan, folder, "dim_customer", p_numbers)
            places |= p
        else:
            dim_new = self._store(dim_plan, folder, "dim_new")
        held_dim = self._held(before, "dim_customer", p_numbers, dim_new)
        dim_old = held_dim.join(persons, "customer_key", "left_semi")
        if before is not None:
            kept.append(beside(self._keep, held_dim.join(persons, "customer_key", "left_anti").unionByName(dim_new), folder, "dim_customer", p_numbers))
        # accounts
        of_dim = lambda d: d.filter("account_id IS NOT NULL").select("account_id")
        accounts = self._store(of_dim(dim_old).union(of_dim(dim_new)).union(of_dim(moved)).distinct(), folder, "accounts")
        a_numbers = self._numbers("bridge", accounts)
        like_bridge = dim_new.select("account_id", "customer_key")
        held_bridge = self._held(before, "bridge", a_numbers, like_bridge)
        bridged = beside(self._keep, held_bridge.join(persons, "customer_key", "left_anti").unionByName(
            like_bridge.filter("account_id IS NOT NULL")), folder, "bridge", a_numbers)
        spots = self._store(accounts.select(F.concat(F.lit("a"), F.col("account_id")).alias("_place")).union(moved.select("_place")).distinct(),
                            folder, "spots")
        v_numbers = self._numbers("versions", spots)
        held_versions = self._held(before, "versions", v_numbers, moved)
        # a version keeps its account, so its earlier form lies in a touched bucket
        new_versions, p = (moved, moved_places) if before is None else self._upsert(
            held_versions, moved, "scd_id", folder, "versions", v_numbers)
        places |= p
        bridge, p = bridged.result()
        places |= p
        fact_of = lambda v: _placed(gold.fact_subscriptions(v, bridge))
        held_fact = self._held(before, "fact_subscriptions", v_numbers, fact_of(new_versions))
        # sums are over current, active versions: of the others nothing is kept apart
        counted = lambda fact: gold.current_active(fact).select(
            "_place", "customer_key", "plan", "status", "sub_started_at", "is_current")
        fact_old = beside(self._store, counted(held_fact).join(spots, "_place", "left_semi"), folder, "fact_old")
        if before is None:
            fact = fact_of(touched(new_versions, spots, "_place"))
        else:                   # by account where there is one: that is also the key of the bridge
            has = F.col("account_id").isNotNull()
            again = new_versions.filter(has).join(accounts, "account_id", "left_semi").select(new_versions.columns).unionByName(
                new_versions.filter(~has).join(spots, "_place", "left_semi").select(new_versions.columns))
            # where few places are left alone, they are looked for without a shuffle of the rows
            alone = self._store(held_fact.select("_place").distinct().join(spots, "_place", "left_anti"), folder, "alone")
            fact = held_fact.join(alone, "_place", "left_semi").select(held_fact.columns).unionByName(fact_of(again))
        fact, p = self._keep(fact, folder, "fact_subscriptions", v_numbers, joined=True)
        places |= p
        fact_new = self._store(touched(counted(fact), spots, "_place"), folder, "fact_new")
        # persons whose sums can differ: the touched ones, and all whose fact rows were written anew
        affected = self._store(reduce(DataFrame.union, [persons, bridge.join(accounts, "account_id", "left_semi").select("customer_key"),
                                                        held_bridge.join(accounts, "account_id", "left_semi").select("customer_key")])
                               .filter("customer_key IS NOT NULL").distinct(), folder, "affected")
        f_numbers = self._numbers("dim_customer", affected)
        others = self._held(before, "dim_customer", f_numbers, dim_new).join(affected, "customer_key", "left_semi")
        dims_old = others
        dims_new = others.join(persons, "customer_key", "left_anti").unionByName(dim_new)
        totals = self._totals(beside, before, folder, (dims_old, fact_old.result()), (dims_new, fact_new))
        # LTV rows are replaced
        priced = self._paying(fact_new).filter("customer_key IS NOT NULL").groupBy("customer_key").agg(
            F.count(F.lit(1)).alias("active_subscriptions"), F.sum("monthly_price").cast("bigint").alias("current_mrr"),
            F.max("months").cast("bigint").alias("tenure_months"), F.sum(F.col("monthly_price") * F.col("months")).cast("bigint").alias("ltv_to_date"))
        ltv_new = self._store(priced, folder, "ltv_new")
        held_ltv = self._held(before, "ltv", f_numbers, ltv_new)
        kept.append(beside(self._keep, held_ltv.join(affected, "customer_key", "left_anti").unionByName(ltv_new), folder, "ltv", f_numbers))
        for job in kept:
            places |= job.result()[1]
        for name, job in totals.items():
            job.result()
            places[name] = f"{folder}/{name}"
        return {"record_keys": like_keys.schema, "records": like_records.schema, "dim_customer": dim_new.schema, "bridge": like_bridge.schema,
                "versions": moved.schema, "fact_subscriptions": fact.schema, "ltv": ltv_new.schema}

    def _paying(self, fact: DataFrame) -> DataFrame:
        return gold.current_active(fact).join(self.pricing, "plan").withColumn(
            "months", clamp_non_negative(months_between_whole(F.col("sub_started_at"), ts_literal(self.as_of))))

    def _totals(self, beside, before, folder, old, new) -> dict:
        """Each total: what it was, less what the touched keys gave, plus what they give."""
        def signed(part: Callable[[DataFrame, DataFrame], DataFrame], measures: list[str]) -> DataFrame:
            less = part(*old)
            return part(*new).unionByName(less.withColumns({m: -F.col(m) for m in measures}))

        def keep(name: str, change: DataFrame, keys: list[str], measures: list[str]) -> None:
            all_ = change if before is None else self.spark.read.parquet(f"{self.root}/{before.places[name]}").unionByName(change)
            summed = all_.groupBy(*keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in measures])
            if keys:
                summed = summed.filter(F.col(measures[0]) != 0)
            jobs[name] = beside(self._store, summed, folder, name)

        jobs: dict = {}
        keep("mrr_counts", signed(lambda d, f: gold.current_active(f).groupBy("plan").agg(F.count(F.lit(1)).alias("n")), ["n"]), ["plan"], ["n"])
        funnel = lambda d, f: gold.mart_funnel(d, f).select("leads", "signups", "paid")
        keep("funnel_counts", signed(funnel, ["leads", "signups", "paid"]), [], ["leads", "signups", "paid"])
        recon = lambda d, f: gold.recon_billing_vs_app(d, f).withColumnRenamed("n_customers", "n")
        keep("recon_counts", signed(recon, ["n"]), ["recon_status"], ["n"])
        orphans = lambda d, f: self._paying(f).filter("customer_key IS NULL").groupBy("monthly_price", "months").agg(
            F.count(F.lit(1)).alias("n"))
        keep("orphan_months", signed(orphans, ["n"]), ["monthly_price", "months"], ["n"])
        return jobs
