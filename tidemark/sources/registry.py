"""Source registry (S9) and the pricing seed.

The registry is plain data: one entry per source, read on the driver.
Paths are parameters; the source names, load modes, watermark columns and
keys below are fixed values of the modelled business.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The five configured sources.
DEFAULT_REGISTRY: dict[str, dict] = {
    "crm_contacts": {
        "type": "csv", "path": None, "load_mode": "full",
        "primary_key": "contact_email", "target_bronze": "bronze.crm_contacts",
    },
    "stripe_customers": {
        "type": "rest", "path": None, "load_mode": "full",
        "primary_key": "id", "target_bronze": "bronze.stripe_customers",
    },
    "app_users": {
        "type": "jdbc", "table": "app.users", "load_mode": "incremental",
        "watermark": "created_at", "primary_key": "user_id", "target_bronze": "bronze.app_users",
    },
    "app_events": {
        "type": "mongodb", "database": "events_db", "collection": "events",
        "load_mode": "incremental", "watermark": "timestamp", "primary_key": "event_id",
        "target_bronze": "bronze.app_events",
    },
    "app_subscriptions": {
        "type": "jdbc", "table": "app.subscriptions", "load_mode": "incremental",
        "watermark": "updated_at", "primary_key": "subscription_id",
        "target_bronze": "bronze.app_subscriptions",
    },
}

# The plan price list seed (plan, monthly_price).
PLAN_PRICING = [
    ("free", 0),
    ("basic", 29),
    ("pro", 99),
    ("enterprise", 299),
]

PLANS = [p for p, _ in PLAN_PRICING]


def registry_with(overrides: dict[str, dict]) -> dict[str, dict]:
    """Copy of the default registry with per-source settings replaced."""
    out = {k: dict(v) for k, v in DEFAULT_REGISTRY.items()}
    for name, cfg in overrides.items():
        out.setdefault(name, {}).update(cfg)
    return out


def load_registry(path: str) -> dict[str, dict]:
    """A registry file (YAML or JSON): either ``{sources: {name: cfg}}`` or
    ``{name: cfg}``. Read on the driver; it is configuration, not data."""
    import json

    with open(path) as fh:
        text = fh.read()
    try:
        import yaml
        doc = yaml.safe_load(text)
    except ImportError:
        doc = json.loads(text)
    return dict(doc.get("sources", doc))


def plan_pricing(spark: SparkSession) -> DataFrame:
    """The seed table: a local relation of four literal rows (exact size
    statistics, a proven bound), so joins broadcast it."""
    rows = ", ".join(f"('{plan}', {price})" for plan, price in PLAN_PRICING)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS seed(plan, monthly_price)")
