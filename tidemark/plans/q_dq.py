"""Data-quality queries: the three layer suites, model tests, singular
tests, failed rows and the negative (mutation) tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import dq, rules
from tidemark.plans.model import Lakehouse
from tidemark.plans.oracle import build
from tidemark.plans.oracle_dq import FIXED_SCALE_SQL, SQL_COLUMNS, checks_sql
from tidemark.plans.queries import fresh_lake, lake, register
from tidemark.sources import adapter

# Fixed values of the fixture: the clocks of the checks.
NOW = adapter.AS_OF
EVENTS_NOW = "2024-02-01 00:00:00"
NOW_SQL = f"TIMESTAMP '{NOW}'"
EVENTS_NOW_SQL = f"TIMESTAMP '{EVENTS_NOW}'"


def fixture_scale(spark: SparkSession, sf_dir: str) -> float:
    """Size of the fixture business relative to the original (1,000 people):
    row-count bands scale with it. Read, as in the SQL statements
    (``oracle_dq.SCALE_SQL``), from the source table ``customer``, whatever
    the folder's name."""
    return adapter.read_driver_table(spark, sf_dir, "customer").count() / 1000.0


def fixed_scale(spark: SparkSession, sf_dir: str) -> float:
    """The declared size of the data set, from a table that no check judges
    (``oracle_dq.FIXED_SCALE_SQL``): losing people does not move the bands."""
    return adapter.read_driver_table(spark, sf_dir, "part").count() * 0.75 / 1000.0


def all_tables(lh: Lakehouse) -> dict[str, DataFrame]:
    t = dict(lh.bronze)
    t.update(lh.tables("silver"))
    t.update(lh.tables("gold"))
    return t


# Tables a suite reads more than once are written first (under the shared
# folder) so every check scans the stored table instead of re-deriving it,
# as a scheduled pipeline checks the tables it has just written.
REUSED = {
    "bronze": [],
    # customers: checks, rows-lost, orphans, identity map; events: checks, orphans
    "silver": ["customers", "events"],
    # dimension and fact feed every mart and several checks each
    "gold": ["customers", "dim_customer", "fact_subscriptions", "mart_mrr", "mart_ltv", "mart_funnel", "recon_billing_vs_app"],
    # plus the silver tables that have both fused and uniqueness tests
    "model_tests": ["customers", "subscriptions", "events", "dim_customer", "fact_subscriptions", "mart_mrr", "mart_ltv"],
    "singular": ["customers", "dim_customer", "fact_subscriptions", "mart_mrr", "mart_funnel", "recon_billing_vs_app"],
}


def _run(spark, sf_dir, checks, layer, scale=fixture_scale):
    lh = fresh_lake(spark, sf_dir) if REUSED[layer] else lake(spark, sf_dir)
    lh.materialize(REUSED[layer])
    return dq.run_checks(spark, all_tables(lh), checks, NOW, EVENTS_NOW,
                         scale=scale(spark, sf_dir))


def _sql(checks, **kw):
    return checks_sql(checks, NOW_SQL, EVENTS_NOW_SQL, **kw)


@register("dq_bronze", _sql(rules.bronze_checks()))
def q_dq_bronze(spark, sf_dir):
    """Q1-Q13 on the five bronze tables (31 checks)."""
    return _run(spark, sf_dir, rules.bronze_checks(), "bronze")


@register("dq_silver", _sql(rules.silver_checks()))
def q_dq_silver(spark, sf_dir):
    """Checks on the silver tables (16 checks)."""
    return _run(spark, sf_dir, rules.silver_checks(), "silver")


@register("dq_gold", _sql(rules.gold_checks()))
def q_dq_gold(spark, sf_dir):
    """Checks on the gold tables (13 checks)."""
    return _run(spark, sf_dir, rules.gold_checks(), "gold")


@register("dq_model_tests", _sql(rules.model_tests()))
def q_dq_model_tests(spark, sf_dir):
    """Unique / not_null / accepted_values / relationships (43 tests)."""
    return _run(spark, sf_dir, rules.model_tests(), "model_tests")


@register("dq_singular_tests", _sql(rules.singular_tests()))
def q_dq_singular(spark, sf_dir):
    """The eight singular tests (a test passes when it finds no rows)."""
    return _run(spark, sf_dir, rules.singular_tests(), "singular")


@register("dq_failed_rows_pii", build(
    "SELECT * FROM customers WHERE coalesce(email_masked NOT LIKE '_***@%', false)"))
def q_failed_rows(spark, sf_dir):
    """Q8: the failing rows of the PII guard on silver customers."""
    return dq.failed_rows(lake(spark, sf_dir).customers, ~F.col("email_masked").like("_***@%"))


@register("dq_failed_rows_injected", build("""
SELECT * REPLACE ('user@' || email_domain AS email_masked) FROM customers
WHERE source_system = 'crm' AND campaign = 'cmp_3' AND email_domain IS NOT NULL
"""))
def q_failed_rows_injected(spark, sf_dir):
    """Q8 with something to find: one campaign's contacts come unmasked."""
    unmasked = (F.col("source_system") == "crm") & (F.col("campaign") == "cmp_3")
    customers = lake(spark, sf_dir).customers.withColumn("email_masked", F.when(
        unmasked, F.concat(F.lit("user@"), "email_domain")).otherwise(F.col("email_masked")))
    return dq.failed_rows(customers, ~F.col("email_masked").like("_***@%"))


@register("dq_unaccepted_values", build("""
SELECT 'test' AS layer, 'subscriptions' AS table_name, name AS check_name, n::DOUBLE AS value,
       CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END AS outcome
FROM (SELECT unnest(['accepted_values(plan)', 'accepted_values(status)']) AS name,
             unnest([count(DISTINCT plan) FILTER (WHERE NOT plan IN ('free', 'pro')),
                     count(DISTINCT status) FILTER (WHERE NOT status IN ('active', 'canceled'))]) AS n
      FROM subscriptions) counted
"""))
def q_unaccepted(spark, sf_dir):
    """D3 with something to find: two plans that the list does not hold."""
    lists = {"plan": ["free", "pro"], "status": ["active", "canceled"]}
    checks = [dq.Check("test", "subscriptions", f"accepted_values({c})", "accepted_values", c, fail=("gt", 0),
                       params={"values": v}) for c, v in lists.items()]
    return dq.run_checks(spark, {"subscriptions": lake(spark, sf_dir).subscriptions}, checks, NOW)


def _crm_checks():
    return [c for c in rules.bronze_checks() if c.table == "crm_contacts"]


def _negative(spark, sf_dir, step: int):
    lh = lake(spark, sf_dir)
    crm = lh.bronze["crm_contacts"]
    # the defects go to the rows with the greatest e-mail text, which are clean
    latest_first = [F.col("contact_email").desc_nulls_last()]
    crm = dq.inject_nulls(crm, "contact_email", 3, order_by=latest_first)
    if step >= 2:
        crm = dq.inject_duplicates(crm, 5, not_null="contact_email", order_by=latest_first)
    if step >= 3:
        crm = dq.drop_column(crm, "company")
    return dq.run_checks(spark, {"crm_contacts": crm}, _crm_checks(), NOW, EVENTS_NOW,
                         scale=fixture_scale(spark, sf_dir))


def _neg_sql(block: str, drop: bool = False):
    cols = [c for c in SQL_COLUMNS["bronze_crm_contacts"] if not (drop and c == "company")]
    return _sql(_crm_checks(), table_blocks={"crm_contacts": block},
                columns={"crm_contacts": cols})


@register("dq_negative_nulls", _neg_sql("crm_neg_nulls"))
def q_neg_nulls(spark, sf_dir):
    """3 NULL e-mails injected -> missing_count fails with value 3."""
    return _negative(spark, sf_dir, 1)


@register("dq_negative_dups", _neg_sql("crm_neg_dups"))
def q_neg_dups(spark, sf_dir):
    """+ 5 duplicated rows -> duplicate_count fails with value 5."""
    return _negative(spark, sf_dir, 2)


@register("dq_negative_drop", _neg_sql("crm_neg_drop", drop=True))
def q_neg_drop(spark, sf_dir):
    """+ column dropped -> schema and column_count (9) fail: 4 failures."""
    return _negative(spark, sf_dir, 3)


# ------------------------------------------------------------------ fixed bands
@register("dq_bronze_fixed", _sql(rules.bronze_checks(), scale_sql=FIXED_SCALE_SQL))
def q_dq_bronze_fixed(spark, sf_dir):
    """Q1 with bands that the judged tables cannot move (31 checks)."""
    return _run(spark, sf_dir, rules.bronze_checks(), "bronze", fixed_scale)


@register("dq_silver_fixed", _sql(rules.silver_checks(), scale_sql=FIXED_SCALE_SQL))
def q_dq_silver_fixed(spark, sf_dir):
    """The silver suite with fixed bands (16 checks)."""
    return _run(spark, sf_dir, rules.silver_checks(), "silver", fixed_scale)


@register("dq_gold_fixed", _sql(rules.gold_checks(), scale_sql=FIXED_SCALE_SQL))
def q_dq_gold_fixed(spark, sf_dir):
    """The gold suite with fixed bands (13 checks)."""
    return _run(spark, sf_dir, rules.gold_checks(), "gold", fixed_scale)


@register("dq_lost_half_fixed", _sql(_crm_checks(), table_blocks={"crm_contacts": "crm_half"}, scale_sql=FIXED_SCALE_SQL,
                                     columns={"crm_contacts": SQL_COLUMNS["bronze_crm_contacts"]}))
def q_dq_lost_half(spark, sf_dir):
    """Q1, Q12: half of the contacts are gone; the row count fails."""
    crm = lake(spark, sf_dir).bronze["crm_contacts"].filter(F.col("last_name").cast("long") % 2 == 0)
    return dq.run_checks(spark, {"crm_contacts": crm}, _crm_checks(), NOW, EVENTS_NOW, scale=fixed_scale(spark, sf_dir))


def _missing_checks():
    """The checks of two tables, those of the second without its table."""
    return ([c for c in rules.bronze_checks() if c.table == "stripe_customers"]
            + [c for c in rules.bronze_checks() if c.table == "app_users"])


@register("dq_missing_table", _sql(_missing_checks(), scale_sql=FIXED_SCALE_SQL,
                                   errors=[k for k, c in enumerate(_missing_checks()) if c.table == "app_users"]))
def q_dq_missing_table(spark, sf_dir):
    """Q12: checks whose table is not there could not run: error, no value."""
    tables = {"stripe_customers": lake(spark, sf_dir).bronze["stripe_customers"]}
    return dq.run_or_report(spark, tables, _missing_checks(), NOW, EVENTS_NOW, scale=fixed_scale(spark, sf_dir))
