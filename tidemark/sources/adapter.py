"""Fixture adapter: the driver's tables -> the five business sources.

The test data is a TPC-H-like star schema plus an event stream. This module
derives, deterministically and lazily, the sources the customer-360 pipeline
lands: a CRM contact export, a billing customer feed with a nested
``metadata`` record, app users, the app subscription change log and the
app event documents with nested ``properties``/``context``. Each is also
produced in its landed (bronze, all-text, lineage) form, simulating the
history of many runs through per-row ``_ingested_at`` values.

Everything scales with the input: one row per customer / order / event,
with one aggregate of orders per customer (the first order date).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import session_key
from tidemark.sources.landing import to_strings

# Fixed values of the fixture.
AS_OF = "2001-09-01 00:00:00"               # logical clock of the fixture
FULL_LOAD_RUN = "2001-08-31T18:00:00+00:00"  # run that lands the full-load sources
RELAND_RUN = "2001-08-31T20:00:00+00:00"     # later run re-landing some app users
DEVICES = ["ios", "android", "web"]

TABLES = ["customer", "nation", "orders", "events"]


_TABLES: dict[tuple[tuple[str, str], str], DataFrame] = {}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's (read-only) table. One relation per session and path:
    the footer/schema discovery job runs once, and every query over the
    same table shares one scan node (so Spark can reuse its exchanges)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (session_key(spark), path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with the identity attributes every source shares."""
    c = read_driver_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # TPC-H nation has 25 rows at every scale: a fixed size, safe to broadcast.
    n = read_driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    first = (read_driver_table(spark, sf_dir, "orders")
             .groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order_at")))
    k = F.col("c_custkey")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
             .join(first, c.c_custkey == first.o_custkey, "left")
             .select(
                 k.alias("k"),
                 F.concat(F.lit("user"), k, F.lit("@"), F.lower("c_mktsegment"), F.lit(".com"))
                  .alias("email"),
                 F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first"),
                 F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last"),
                 F.col("n_name").alias("country"),
                 F.col("c_mktsegment").alias("segment"),
                 F.col("first_order_at")))


def crm_contacts_source(p: DataFrame) -> DataFrame:
    """CSV export: all text; noisy e-mail spelling; 90 % of people."""
    k, email = F.col("k"), F.col("email")
    noisy = (F.when(k % 97 == 0, F.lit(None).cast("string"))
              .when(k % 89 == 0, F.lit(""))
              .when(k % 5 == 0, F.upper(email))
              .when(k % 5 == 1, F.concat(F.lit("  "), email, F.lit(" ")))
              .when(k % 5 == 2, F.concat(F.lit("\t"), email))
              .otherwise(email))
    return p.filter(k % 10 != 0).select(
        noisy.alias("contact_email"),
        F.col("first").alias("first_name"),
        F.col("last").alias("last_name"),
        F.col("country").alias("company"),
        F.lower("segment").alias("lead_source"),
        F.concat(F.lit("cmp_"), k % 7).alias("campaign"),
        F.date_format("first_order_at", "yyyy-MM-dd").alias("created_date"),
        F.col("segment").alias("industry"))


def stripe_customers_source(p: DataFrame) -> DataFrame:
    """Billing customers, nested ``metadata{country}``; 70 % of people."""
    k = F.col("k")
    created = F.datediff(F.to_date("first_order_at"), F.lit("1970-01-01").cast("date")) * 86400 + k
    name = F.when(k % 11 == 0, F.col("first")).otherwise(F.concat_ws(" ", "first", "last"))
    return p.filter(k % 10 < 7).select(
        F.concat(F.lit("cus_"), k).alias("id"),
        F.lit("customer").alias("object"),
        F.when(k % 3 == 0, F.upper("email")).otherwise(F.col("email")).alias("email"),
        name.alias("name"),
        created.cast("bigint").alias("created"),
        F.struct(F.col("country").alias("country")).alias("metadata"))


def app_users_source(p: DataFrame) -> DataFrame:
    """App users (relational): 90 % of people."""
    k = F.col("k")
    return p.filter(k % 10 != 3).select(
        (k + 10000).alias("user_id"),
        (k + 20000).alias("account_id"),
        F.col("email"),
        F.col("first").alias("first_name"),
        F.col("last").alias("last_name"),
        F.col("country"),
        F.col("first_order_at").alias("created_at"))


def app_subscriptions_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscription change log: one change per order (relational)."""
    o = read_driver_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    # first order per customer: a partial+final aggregate joined back (a
    # customer with a huge share of the orders is reduced map-side)
    first = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("started_at"))
    o = o.join(first, "o_custkey", "inner")
    start = F.col("started_at")
    prio = F.substring("o_orderpriority", 1, 1)
    plan = (F.when(prio == "1", "enterprise").when(prio == "2", "pro")
             .when(prio.isin("3", "4"), "basic").otherwise("free"))
    # o_orderkey microseconds after the order date: unique change times
    micros = (F.col("o_orderkey") / F.lit(1000000)).cast("decimal(18,6)")
    updated = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), micros)
    return o.select(
        (F.col("o_custkey") + 30000).alias("subscription_id"),
        (F.col("o_custkey") + 20000).alias("account_id"),
        plan.alias("plan"),
        F.when(F.col("o_orderstatus") == "F", "canceled").otherwise("active").alias("status"),
        start.alias("started_at"),
        updated.alias("updated_at"))


def app_events_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event documents with nested ``properties`` and ``context``."""
    e = read_driver_table(spark, sf_dir, "events")
    eid, typ = F.col("event_id"), F.col("event_type")
    kind = F.when(typ == "view", "page_view").when(typ == "click", "feature_click").otherwise("session")
    pk = F.get_json_object("props", "$.k")
    device = F.when(eid % 3 == 0, DEVICES[0]).when(eid % 3 == 1, DEVICES[1]).otherwise(DEVICES[2])
    return e.select(
        eid.cast("string").alias("event_id"),
        kind.alias("event_type"),
        F.concat(F.lit("anon_"), F.col("user_id")).alias("anonymous_id"),
        F.when(eid % 4 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id") + 10000)
         .alias("user_id"),
        F.col("ts").alias("timestamp"),
        F.struct(
            F.when(typ == "view", F.concat(F.lit("/page/"), pk)).alias("page"),
            F.when(typ == "view", F.concat(F.lit("ref_"), eid % 3)).alias("referrer"),
            F.when(typ == "click", F.concat(F.lit("feature_"), pk)).alias("feature"),
            F.when(~typ.isin("view", "click"), F.floor("value").cast("bigint")).alias("duration_s"),
        ).alias("properties"),
        F.struct(device.alias("device"), F.concat(F.lit("1."), eid % 5).alias("app_version"))
         .alias("context"))


# ------------------------------------------------------------------ bronze
def _lineage(df: DataFrame, source: str, ingested: Column) -> DataFrame:
    return df.withColumns({"_source": F.lit(source), "_ingested_at": ingested})


def _land_rows(src: DataFrame, source: str, ingested: Column) -> DataFrame:
    """Landed form with a per-row run time computed on the typed source."""
    flat = to_strings(src.withColumn("_run_text", ingested))
    return (flat.withColumns({"_source": F.lit(source), "_ingested_at": F.col("_run_text")})
            .drop("_run_text"))


def bronze_crm_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = crm_contacts_source(people(spark, sf_dir))
    return _lineage(to_strings(src), "crm_contacts", F.lit(FULL_LOAD_RUN))


def bronze_stripe_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = stripe_customers_source(people(spark, sf_dir))
    return _lineage(to_strings(src), "stripe_customers", F.lit(FULL_LOAD_RUN))


def app_users_runs(spark: SparkSession, sf_dir: str,
                   p: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The two landed batches of app users: everyone, then people with
    k % 20 = 1 again, later, with an edited first name."""
    src = app_users_source(p if p is not None else people(spark, sf_dir))
    first = _lineage(to_strings(src), "app_users", F.lit(FULL_LOAD_RUN))
    again = (src.filter((F.col("user_id") - 10000) % 20 == 1)
             .withColumn("first_name", F.lit("Client")))
    second = _lineage(to_strings(again), "app_users", F.lit(RELAND_RUN))
    return first, second


def bronze_app_users(spark: SparkSession, sf_dir: str, p: DataFrame | None = None) -> DataFrame:
    """Both batches appended (two copies of some keys, the later one wins)."""
    first, second = app_users_runs(spark, sf_dir, p)
    return first.unionByName(second)


def bronze_app_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log as landed by monthly incremental runs: a change made
    in month m lands on the 1st of month m+1 at 02:00."""
    src = app_subscriptions_source(spark, sf_dir)
    run = (F.date_trunc("month", F.col("updated_at"))
           + F.make_ym_interval(F.lit(0), F.lit(1)) + F.make_dt_interval(F.lit(0), F.lit(2)))
    return _land_rows(src, "app_subscriptions", _iso(run))


def bronze_app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily landing (next day 02:00); events with id % 50 = 0 are landed a
    second time a day later with a new app version."""
    src = app_events_source(spark, sf_dir)
    run = F.date_trunc("day", F.col("timestamp")) + F.make_dt_interval(F.lit(1), F.lit(2))
    first = _land_rows(src, "app_events", _iso(run))
    again_src = (src.filter(F.col("event_id").cast("bigint") % 50 == 0)
                 .withColumn("context", F.struct(F.col("context.device").alias("device"),
                                                 F.lit("2.0").alias("app_version"))))
    again = _land_rows(again_src, "app_events", _iso(run + F.make_dt_interval(F.lit(1))))
    return first.unionByName(again)


class LazyBronze(dict):
    """name -> bronze DataFrame, each built on first use; the shared
    per-person frame is built once and reused by the three people sources
    (one plan subtree, so Spark reuses its exchange)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir
        self._people = None

    def people(self) -> DataFrame:
        if self._people is None:
            self._people = people(self.spark, self.sf_dir)
        return self._people

    def __missing__(self, name: str) -> DataFrame:
        p = self.people
        builders = {
            "crm_contacts": lambda: _lineage(to_strings(crm_contacts_source(p())), "crm_contacts",
                                             F.lit(FULL_LOAD_RUN)),
            "stripe_customers": lambda: _lineage(to_strings(stripe_customers_source(p())),
                                                 "stripe_customers", F.lit(FULL_LOAD_RUN)),
            "app_users": lambda: bronze_app_users(self.spark, self.sf_dir, p()),
            "app_subscriptions": lambda: bronze_app_subscriptions(self.spark, self.sf_dir),
            "app_events": lambda: bronze_app_events(self.spark, self.sf_dir),
        }
        if name not in builders:
            raise KeyError(name)
        df = builders[name]()
        self[name] = df
        return df

    def __iter__(self):
        return iter(BRONZE_BUILDERS)

    def __len__(self):
        return len(BRONZE_BUILDERS)

    def keys(self):
        return list(BRONZE_BUILDERS)

    def items(self):
        return [(k, self[k]) for k in BRONZE_BUILDERS]

    def values(self):
        return [self[k] for k in BRONZE_BUILDERS]


BRONZE_BUILDERS = {
    "crm_contacts": bronze_crm_contacts,
    "stripe_customers": bronze_stripe_customers,
    "app_users": bronze_app_users,
    "app_subscriptions": bronze_app_subscriptions,
    "app_events": bronze_app_events,
}


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five landed tables of the fixture, built lazily on first use."""
    return LazyBronze(spark, sf_dir)
