"""tidemark: a Spark-native customer-360 lakehouse.

Sources land as all-text bronze tables; silver conforms, de-duplicates and
resolves identity; gold builds the customer dimension, the subscription
history fact and the revenue marts; declarative data-quality rules gate
each layer. Every operator is a lazy ``DataFrame -> DataFrame`` function.

The public functions are importable from the package root, e.g.
``from tidemark import read_source, ingest, customers, dim_customer``.
"""

__version__ = "0.1.0"

_EXPORTS = {
    # sources and landing
    "read_source": "tidemark.sources.readers", "flatten": "tidemark.sources.readers",
    "land": "tidemark.sources.landing", "ingest": "tidemark.sources.landing",
    "read_watermark": "tidemark.sources.landing", "watermark_of": "tidemark.sources.landing",
    "read_table": "tidemark.sources.landing", "reset": "tidemark.sources.landing",
    "load_registry": "tidemark.sources.registry", "plan_pricing": "tidemark.sources.registry",
    # column functions
    "email_norm": "tidemark.functions", "email_hash": "tidemark.functions",
    "email_domain": "tidemark.functions", "email_mask": "tidemark.functions",
    "months_between_whole": "tidemark.functions", "hours_between": "tidemark.functions",
    # silver (M1-M7, W1-W3)
    "latest_per_key": "tidemark.operators.dedupe",
    "conform_crm": "tidemark.operators.conform", "conform_billing": "tidemark.operators.conform",
    "conform_app": "tidemark.operators.conform", "customers": "tidemark.operators.conform",
    "identity_map": "tidemark.operators.silver", "subscriptions_latest": "tidemark.operators.silver",
    "events_latest": "tidemark.operators.silver",
    # history (M8, M8b, J10)
    "snapshot_timestamp": "tidemark.operators.scd2", "history_from_log": "tidemark.operators.scd2",
    "state_as_of": "tidemark.operators.scd2",
    # gold (M9-M14, E3, E4)
    "dim_customer": "tidemark.operators.gold", "fact_subscriptions": "tidemark.operators.gold",
    "mart_mrr": "tidemark.operators.gold", "mart_ltv": "tidemark.operators.gold",
    "mart_funnel": "tidemark.operators.gold", "recon_billing_vs_app": "tidemark.operators.gold",
    # data quality
    "run_checks": "tidemark.operators.dq", "gate": "tidemark.operators.dq",
    "failed_rows": "tidemark.operators.dq", "inject_nulls": "tidemark.operators.dq",
    "inject_duplicates": "tidemark.operators.dq",
    # orchestration
    "run_pipeline": "tidemark.plans.runner",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name):
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
