"""The lakehouse model as one lazily built graph of DataFrames.

``Lakehouse`` wires bronze -> silver -> gold. Each table is built on first
use and shared by everything downstream, so one action over a mart plans
only what it needs. ``materialize`` writes chosen tables under the shared
folder and re-reads them, which cuts lineage for long pipelines and lets a
lost executor recompute from the written table instead of from bronze.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators import conform, gold, scd2, silver
from tidemark.sources import adapter
from tidemark.sources.registry import plan_pricing
from tidemark.session import scratch_path


class Lakehouse:
    def __init__(self, spark: SparkSession, bronze: dict[str, DataFrame], as_of,
                 pricing: DataFrame | None = None):
        self.spark = spark
        self.bronze = bronze
        self.as_of = as_of
        self._pricing = pricing

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str) -> "Lakehouse":
        return cls(spark, adapter.bronze_tables(spark, sf_dir), adapter.AS_OF)

    # ------------------------------------------------------------ silver
    @cached_property
    def stg_crm_contacts(self) -> DataFrame:
        return conform.conform_crm(self.bronze["crm_contacts"])

    @cached_property
    def stg_stripe_customers(self) -> DataFrame:
        return conform.conform_billing(self.bronze["stripe_customers"])

    @cached_property
    def stg_app_users(self) -> DataFrame:
        return conform.conform_app(self.bronze["app_users"])

    @cached_property
    def customers(self) -> DataFrame:
        return conform.customers(self.stg_crm_contacts, self.stg_stripe_customers,
                                 self.stg_app_users)

    @cached_property
    def identity_map(self) -> DataFrame:
        return silver.identity_map(self.customers)

    @cached_property
    def subscriptions(self) -> DataFrame:
        return silver.subscriptions_latest(self.bronze["app_subscriptions"])

    @cached_property
    def subscription_log(self) -> DataFrame:
        return silver.subscription_log(self.bronze["app_subscriptions"])

    @cached_property
    def events(self) -> DataFrame:
        return silver.events_latest(self.bronze["app_events"])

    # ------------------------------------------------------------ gold
    @cached_property
    def pricing(self) -> DataFrame:
        return self._pricing if self._pricing is not None else plan_pricing(self.spark)

    @cached_property
    def scd_subscriptions(self) -> DataFrame:
        """History equal to one snapshot run per landing batch."""
        return scd2.history_from_log(self.subscription_log, "subscription_id", "sub_updated_at",
                                     batch="_ingested_at",
                                     tie_break=["plan", "status", "account_id"])

    @cached_property
    def dim_customer(self) -> DataFrame:
        # the identity map is derived from these very records: key them in place
        return gold.dim_customer(None, self.customers)

    @cached_property
    def fact_subscriptions(self) -> DataFrame:
        return gold.fact_subscriptions(self.scd_subscriptions, self.dim_customer)

    @cached_property
    def mart_mrr(self) -> DataFrame:
        return gold.mart_mrr(self.fact_subscriptions, self.pricing)

    @cached_property
    def mart_ltv(self) -> DataFrame:
        return gold.mart_ltv(self.fact_subscriptions, self.pricing, self.as_of)

    @cached_property
    def mart_funnel(self) -> DataFrame:
        return gold.mart_funnel(self.dim_customer, self.fact_subscriptions)

    @cached_property
    def recon_billing_vs_app(self) -> DataFrame:
        return gold.recon_billing_vs_app(self.dim_customer, self.fact_subscriptions)

    # ------------------------------------------------------------ helpers
    def tables(self, layer: str) -> dict[str, DataFrame]:
        names = {
            "bronze": list(self.bronze),
            "silver": ["customers", "identity_map", "subscriptions", "events"],
            "gold": ["dim_customer", "fact_subscriptions", "mart_mrr", "mart_ltv", "mart_funnel",
                     "recon_billing_vs_app"],
        }[layer]
        if layer == "bronze":
            return {n: self.bronze[n] for n in names}
        return {n: getattr(self, n) for n in names}

    #: tables of one step do not read each other and are written side by side
    STEPS = [["customers", "subscriptions", "events", "scd_subscriptions"], ["identity_map", "dim_customer"], ["fact_subscriptions"]]

    def materialize(self, names: list[str], root: str | None = None) -> dict[str, str]:
        """Write the named tables as Parquet under the shared folder, then
        read them back in place of their plans."""
        root = root or scratch_path(self.spark, "lakehouse")
        out = {n: f"{root}/{n}" for n in names}
        first = [n for n in names if n in self.bronze.keys()]
        later = [n for n in names if n not in first]
        steps = [first, *[[n for n in later if n in step] for step in self.STEPS],
                 [n for n in later if not any(n in step for step in self.STEPS)]]
        for step in filter(None, steps):
            plans = [self.bronze[n] if n in first else getattr(self, n) for n in step]
            with ThreadPoolExecutor(len(step)) as pool:
                list(pool.map(inheritable_thread_target(self.spark)(lambda x: x[0].write.mode("overwrite").parquet(x[1])),
                              zip(plans, [out[n] for n in step])))
            for n in step:
                held = self.spark.read.parquet(out[n])
                if n in first:
                    self.bronze[n] = held
                else:
                    self.__dict__[n] = held
        return out


def to_ntz(df: DataFrame) -> DataFrame:
    """Instants -> zone-less timestamps (UTC wall clock) for exchange with
    engines that have no zone-aware type."""
    cols = []
    for f in df.schema.fields:
        c = df[f"`{f.name}`"] if "." in f.name else df[f.name]
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(cols)
