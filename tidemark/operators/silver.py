"""Silver models beyond the customer union: identity, subscriptions, events
(M5-M7) and the identity analyses built on them (J9, N7, N8, E2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (customer_key_of, from_iso8601, pct, try_double, try_instant,
                                try_local)
from tidemark.operators.dedupe import col_or_null, latest_per_key


# --------------------------------------------------------------- identity
def identity_map(customers: DataFrame) -> DataFrame:
    """Deterministic identity resolution (M5): same e-mail hash, same person.
    A projection: no shuffle, stable keys when people are added."""
    return customers.select(
        customer_key_of(F.col("email_hash")).alias("customer_key"),
        "source_system", "source_id", "email_hash")


def source_overlap(identity: DataFrame, events: DataFrame | None = None,
                   customers: DataFrame | None = None) -> DataFrame:
    """How many people sit in which combination of sources.

    One partial+final aggregation per person, then a tiny aggregation per
    combination. With ``events`` and ``customers``, a person also counts as
    present in the event log when one of their app records has events.
    """
    flags = identity.groupBy("customer_key").agg(
        F.max(F.when(F.col("source_system") == "crm", 1).otherwise(0)).alias("in_crm"),
        F.max(F.when(F.col("source_system") == "stripe", 1).otherwise(0)).alias("in_stripe"),
        F.max(F.when(F.col("source_system") == "app", 1).otherwise(0)).alias("in_app"))
    if events is not None:
        users = (events.filter(F.col("user_id").isNotNull())
                 .groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))   # one row per user
        linked = (identity.filter(F.col("source_system") == "app")
                  .join(users, identity.source_id == users.user_id, "inner")
                  .select("customer_key").distinct()
                  .withColumn("in_events", F.lit(1)))
        flags = (flags.join(linked, "customer_key", "left")
                 .withColumn("in_events", F.coalesce(F.col("in_events"), F.lit(0))))
    else:
        flags = flags.withColumn("in_events", F.lit(0))
    n_sources = F.col("in_crm") + F.col("in_stripe") + F.col("in_app") + F.col("in_events")
    return (flags.groupBy("in_crm", "in_stripe", "in_app", "in_events")
            .agg(F.count(F.lit(1)).alias("n_people"))
            .withColumn("n_sources", n_sources))


# --------------------------------------------------------------- subscriptions
def subscription_order(updated: str = "_upd", ingested: str = "_ing") -> list:
    """Total order among the changes of one subscription: latest change
    time, then latest landing, then the attributes (T11, T12)."""
    return [F.col(updated).desc_nulls_last(), F.col(ingested).desc_nulls_last(),
            F.col("plan").asc_nulls_last(), F.col("status").asc_nulls_last(),
            F.col("account_id").asc_nulls_last()]


def subscriptions_latest(bronze: DataFrame) -> DataFrame:
    """Current state per subscription (M6): the change with the latest
    ``updated_at`` (as a timestamp, T12), later landing breaking ties."""
    ordered = bronze.withColumns({
        "_upd": try_instant(F.col("updated_at")),
        "_ing": from_iso8601(F.col("_ingested_at")),
    })
    latest = latest_per_key(ordered, ["subscription_id"], subscription_order())
    return latest.select(
        "subscription_id", "account_id", "plan", "status",
        try_instant(F.col("started_at")).alias("sub_started_at"),
        F.col("_upd").alias("sub_updated_at"),
        F.col("_ing").alias("_ingested_at"))


# --------------------------------------------------------------- events
EVENT_COLUMNS = ["event_id", "event_type", "anonymous_id", "user_id", "event_at", "page",
                 "referrer", "device", "app_version", "duration_s", "feature", "_ingested_at"]


def events_latest(bronze: DataFrame) -> DataFrame:
    """Latest landed copy per event id, flattened fields typed (M7)."""
    ordered = bronze.withColumn("_ing", from_iso8601(F.col("_ingested_at")))
    latest = latest_per_key(ordered, ["event_id"],
                            [F.col("_ing").desc_nulls_last(),
                             F.col("_ingested_at").desc_nulls_last(),
                             col_or_null(bronze, "context.app_version").asc_nulls_last(),
                             col_or_null(bronze, "timestamp").asc_nulls_last()])
    return latest.select(
        "event_id", "event_type", "anonymous_id", "user_id",
        try_local(col_or_null(latest, "timestamp")).alias("event_at"),
        col_or_null(latest, "properties.page").alias("page"),
        col_or_null(latest, "properties.referrer").alias("referrer"),
        col_or_null(latest, "context.device").alias("device"),
        col_or_null(latest, "context.app_version").alias("app_version"),
        try_double(col_or_null(latest, "properties.duration_s")).alias("duration_s"),
        col_or_null(latest, "properties.feature").alias("feature"),
        F.col("_ing").alias("_ingested_at"))


def anonymous_event_share(events: DataFrame) -> DataFrame:
    """Share of events without a user id, per event type."""
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("user_id").isNull()).alias("n_anonymous"),
    ).withColumn("pct_anonymous", pct(F.col("n_anonymous"), F.col("n_events")))


def orphan_known_events(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Events that carry a user id unknown to the app customer records.

    Events are first reduced to one row per user id (partial aggregation,
    so a very active user costs one row per map task), then matched
    against the app records: the join sees users, not events.
    """
    per_user = (events.filter(F.col("user_id").isNotNull())
                .groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))
    app_ids = (customers.filter(F.col("source_system") == "app")
               .select(F.col("source_id").alias("user_id")).distinct()
               .withColumn("known", F.lit(1)))
    matched = per_user.join(app_ids, "user_id", "left")
    return matched.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_known_events"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)), F.lit(0))
         .cast("bigint").alias("n_orphan_events"),
    ).withColumn("pct_orphan", pct(F.col("n_orphan_events"), F.col("n_known_events")))


def event_identity_stitch(events: DataFrame, customers: DataFrame,
                          identity: DataFrame) -> DataFrame:
    """Resolve every event to a person (E2): an anonymous id seen together
    with a user id carries that user to its other events (before and after
    login), then user id -> app record -> customer key.

    Each event is joined once, with the union of two maps: user id -> person
    for events that carry a user, anonymous id -> (user, person) for the
    others. Both maps are user-scale (one row per user / per anonymous id,
    built with partial aggregations); the event table is read twice (links,
    join) and shuffled once; AQE's skew join splits a hot anonymous id.
    ``events`` should be a stored table or a cheap plan.
    """
    app_keys = (identity.filter(F.col("source_system") == "app")
                .select(F.col("source_id").alias("linked_user_id"), "customer_key"))
    links = (events.filter(F.col("user_id").isNotNull() & F.col("anonymous_id").isNotNull())
             .groupBy("anonymous_id").agg(F.min("user_id").alias("linked_user_id")))
    by_user = app_keys.select(F.lit(True).alias("known"), F.col("linked_user_id").alias("id"),
                              "linked_user_id", "customer_key")
    by_link = (links.join(app_keys, "linked_user_id", "left")
               .select(F.lit(False).alias("known"), F.col("anonymous_id").alias("id"),
                       "linked_user_id", "customer_key"))
    keyed = events.select("event_id", "anonymous_id", "user_id", F.col("user_id").isNotNull().alias("known"),
                          F.coalesce("user_id", "anonymous_id").alias("id"))
    return keyed.join(by_user.union(by_link), ["known", "id"], "left").select(
        "event_id", "anonymous_id", "user_id",
        F.coalesce("user_id", "linked_user_id").alias("resolved_user_id"), "customer_key",
        F.when(F.col("known"), "user").when(F.col("linked_user_id").isNotNull(), "anonymous_link")
         .otherwise("unresolved").alias("resolution"))


def subscription_log(bronze: DataFrame) -> DataFrame:
    """The landed change log, typed: every landed change, with its run."""
    return bronze.select(
        "subscription_id", "account_id", "plan", "status",
        try_instant(F.col("started_at")).alias("sub_started_at"),
        try_instant(F.col("updated_at")).alias("sub_updated_at"),
        from_iso8601(F.col("_ingested_at")).alias("_ingested_at"))
