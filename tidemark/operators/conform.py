"""Silver conforming of the three people sources and their union (M1-M4).

Each ``conform_*`` maps one all-text bronze table onto the common customer
schema: clean, type, hash and mask the e-mail, pad the attributes the
source does not have with typed NULLs. Pure projections and filters: no
shuffle until ``customers`` keeps the latest landing per source record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (email_domain, email_hash, email_mask, email_norm, first_word,
                                from_epoch_seconds, from_iso8601, initial, second_word_initial,
                                strip_ws, try_instant)
from tidemark.operators.dedupe import col_or_null, latest_per_key

CUSTOMER_COLUMNS = [
    "source_system", "source_id", "email_hash", "email_domain", "email_masked", "first_name",
    "last_name_initial", "company", "country", "account_id", "lead_source", "campaign",
    "source_created_at", "_ingested_at",
]

# Source priorities for survivorship (higher wins).
SOURCE_PRIORITY = {"app": 3, "stripe": 2, "crm": 1}


def _null() -> F.Column:
    return F.lit(None).cast("string")


def _has_email(c: str) -> F.Column:
    """not null and not blank after trimming."""
    return F.col(c).isNotNull() & (strip_ws(F.col(c)) != "")


def _email_columns(c: str) -> list[F.Column]:
    norm = email_norm(F.col(c))
    return [email_hash(F.col(c)).alias("email_hash"),
            email_domain(norm).alias("email_domain"),
            email_mask(norm).alias("email_masked")]


def conform_crm(bronze: DataFrame) -> DataFrame:
    """CRM contacts (M1). The record id is the e-mail hash itself."""
    h = email_hash(F.col("contact_email"))
    return bronze.filter(_has_email("contact_email")).select(
        F.lit("crm").alias("source_system"),
        h.alias("source_id"),
        *_email_columns("contact_email"),
        strip_ws(F.col("first_name")).alias("first_name"),
        initial(strip_ws(F.col("last_name"))).alias("last_name_initial"),
        strip_ws(col_or_null(bronze, "company")).alias("company"),
        _null().alias("country"),
        _null().alias("account_id"),
        col_or_null(bronze, "lead_source").alias("lead_source"),
        col_or_null(bronze, "campaign").alias("campaign"),
        try_instant(col_or_null(bronze, "created_date")).alias("source_created_at"),
        from_iso8601(F.col("_ingested_at")).alias("_ingested_at"))


def conform_billing(bronze: DataFrame) -> DataFrame:
    """Billing customers (M2): name split into first word / initial of the
    second word; creation time from epoch seconds."""
    return bronze.filter(_has_email("email")).select(
        F.lit("stripe").alias("source_system"),
        F.col("id").alias("source_id"),
        *_email_columns("email"),
        first_word(F.col("name")).alias("first_name"),
        second_word_initial(F.col("name")).alias("last_name_initial"),
        _null().alias("company"),
        col_or_null(bronze, "metadata.country").alias("country"),
        _null().alias("account_id"),
        _null().alias("lead_source"),
        _null().alias("campaign"),
        from_epoch_seconds(col_or_null(bronze, "created")).alias("source_created_at"),
        from_iso8601(F.col("_ingested_at")).alias("_ingested_at"))


def conform_app(bronze: DataFrame) -> DataFrame:
    """App users (M3)."""
    return bronze.filter(_has_email("email")).select(
        F.lit("app").alias("source_system"),
        F.col("user_id").alias("source_id"),
        *_email_columns("email"),
        strip_ws(F.col("first_name")).alias("first_name"),
        initial(strip_ws(col_or_null(bronze, "last_name"))).alias("last_name_initial"),
        _null().alias("company"),
        col_or_null(bronze, "country").alias("country"),
        col_or_null(bronze, "account_id").alias("account_id"),
        _null().alias("lead_source"),
        _null().alias("campaign"),
        try_instant(col_or_null(bronze, "created_at")).alias("source_created_at"),
        from_iso8601(F.col("_ingested_at")).alias("_ingested_at"))


# Deterministic order among copies of one record: latest landing first,
# then a fixed order over the remaining attributes.
TIE_BREAK = ["email_hash", "first_name", "last_name_initial", "company", "country", "account_id",
             "lead_source", "campaign", "source_created_at"]


def customer_order() -> list[F.Column]:
    return [F.col("_ingested_at").desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in TIE_BREAK]


def customers(*branches: DataFrame) -> DataFrame:
    """Union of the conformed sources, latest landing per (source_system,
    source_id) (M4, U1, W1)."""
    unioned = branches[0].select(CUSTOMER_COLUMNS)
    for b in branches[1:]:
        unioned = unioned.unionByName(b.select(CUSTOMER_COLUMNS))
    return latest_per_key(unioned, ["source_system", "source_id"], customer_order())


def customers_from_bronze(crm: DataFrame, billing: DataFrame, app: DataFrame) -> DataFrame:
    return customers(conform_crm(crm), conform_billing(billing), conform_app(app))
