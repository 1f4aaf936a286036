"""SQL statements for the data-quality queries (DuckDB dialect).

Each check becomes one scalar SELECT written from the check's kind and
thresholds; the statement is the UNION ALL of one row per check with the
outcome as a CASE expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.operators.dq import Check
from tidemark.plans.oracle import build

# table name of a check -> block name in the SQL statement
SQL_TABLES = {
    "crm_contacts": "bronze_crm_contacts",
    "stripe_customers": "bronze_stripe_customers",
    "app_users": "bronze_app_users",
    "app_subscriptions": "bronze_app_subscriptions",
    "app_events": "bronze_app_events",
    "events": "silver_events",
}

# columns of the blocks, for schema checks (the SQL side knows its own tables)
SQL_COLUMNS = {
    "bronze_crm_contacts": ["contact_email", "first_name", "last_name", "company", "lead_source",
                            "campaign", "created_date", "industry", "_source", "_ingested_at"],
    "bronze_stripe_customers": ["id", "object", "email", "name", "created", "metadata.country",
                                "_source", "_ingested_at"],
    "bronze_app_users": ["user_id", "account_id", "email", "first_name", "last_name", "country",
                         "created_at", "_source", "_ingested_at"],
    "bronze_app_subscriptions": ["subscription_id", "account_id", "plan", "status", "started_at",
                                 "updated_at", "_source", "_ingested_at"],
    "bronze_app_events": ["event_id", "event_type", "anonymous_id", "user_id", "timestamp",
                          "properties.page", "properties.referrer", "properties.feature",
                          "properties.duration_s", "context.device", "context.app_version",
                          "_source", "_ingested_at"],
}

SCALE_SQL = "(CAST((SELECT count(*) FROM customer) AS DOUBLE) / 1000.0)"
# the size a data set is declared to have: three people to four parts, in a table no check judges
FIXED_SCALE_SQL = "(CAST((SELECT count(*) FROM part) AS DOUBLE) * 0.75 / 1000.0)"


def _q(col: str) -> str:
    return f'"{col}"'


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def value_sql(c: Check, tbl: str, now_sql: str, ref_sql: str, columns=None) -> str:
    now = ref_sql if c.params.get("clock") == "reference" else now_sql
    col = _q(c.column) if c.column else None
    k = c.kind
    if k == "row_count":
        return f"SELECT count(*) FROM {tbl}"
    if k in ("missing_count", "not_null"):
        return f"SELECT count(*) FILTER (WHERE {col} IS NULL) FROM {tbl}"
    if k == "missing_percent":
        return (f"SELECT round(100.0 * CAST(count(*) FILTER (WHERE {col} IS NULL) AS DOUBLE) "
                f"/ CAST(nullif(count(*), 0) AS DOUBLE), 2) FROM {tbl}")
    if k == "invalid_count":
        bad = []
        if "valid_min" in c.params:
            bad.append(f"{col} < {c.params['valid_min']}")
        if "valid_max" in c.params:
            bad.append(f"{col} > {c.params['valid_max']}")
        return f"SELECT count(*) FILTER (WHERE {col} IS NOT NULL AND ({' OR '.join(bad)})) FROM {tbl}"
    if k == "freshness":
        return f"SELECT datesub('hour', max({col}), {now}) FROM {tbl}"
    if k == "failed_rows":
        return f"SELECT count(*) FILTER (WHERE coalesce(({c.params['sql']}), false)) FROM {tbl}"
    if k == "accepted_values":
        vals = ", ".join(_lit(v) for v in c.params["values"])
        return f"SELECT count(DISTINCT CASE WHEN {col} NOT IN ({vals}) THEN {col} END) FROM {tbl}"
    if k == "aggregate":
        return f"SELECT {c.params['sql'].format(now=now)} FROM {tbl}"
    if k in ("duplicate_count", "unique"):
        cols = [_q(x) for x in c.params.get("columns", [c.column])]
        where = ""
        if c.params.get("ignore_nulls", True):
            where = " WHERE " + " AND ".join(f"{x} IS NOT NULL" for x in cols)
        g = ", ".join(cols)
        return f"SELECT count(*) FROM (SELECT {g} FROM {tbl}{where} GROUP BY {g} HAVING count(*) > 1) d"
    if k == "schema":
        have = set(columns if columns is not None else SQL_COLUMNS.get(tbl, []))
        return f"SELECT {len([r for r in c.params['required'] if r not in have])}"
    if k == "column_count":
        have = columns if columns is not None else SQL_COLUMNS.get(tbl, [])
        return f"SELECT {len(have)}"
    if k in ("metric", "relationships", "singular"):
        return c.params["sql"].format(now=now, **{t: SQL_TABLES.get(t, t) for t in _TABLE_NAMES})
    raise ValueError(k)


_TABLE_NAMES = ["customers", "identity_map", "subscriptions", "events", "dim_customer",
                "fact_subscriptions", "mart_mrr", "mart_ltv", "mart_funnel", "recon_billing_vs_app"]


def cond_sql(cond: tuple | None, scale_sql: str = SCALE_SQL) -> str:
    if cond is None:
        return "false"
    op, *a = cond
    scaled = bool(a) and a[-1] == "scaled"
    a = [x for x in a if x != "scaled"]
    a = [f"({x} * {scale_sql})" if scaled else repr(float(x)) for x in a]
    return {
        "gt": f"value > {a[0]}" if a else "", "ge": f"value >= {a[0]}" if a else "",
        "lt": f"value < {a[0]}" if a else "", "le": f"value <= {a[0]}" if a else "",
        "eq": f"value = {a[0]}" if a else "", "ne": f"value <> {a[0]}" if a else "",
        "between": f"value BETWEEN {a[0]} AND {a[-1]}",
        "not_between": f"NOT (value BETWEEN {a[0]} AND {a[-1]})",
    }[op]


def checks_sql(checks: Sequence[Check], now_sql: str, ref_sql: str,
               table_blocks: dict[str, str] | None = None,
               columns: dict[str, list[str]] | None = None,
               errors: Sequence[int] = (), scale_sql: str = SCALE_SQL) -> str:
    """One statement: a row per check (layer, table_name, check_name, value, outcome)."""
    blocks = dict(SQL_TABLES)
    blocks.update(table_blocks or {})
    parts = []
    for i, c in enumerate(checks):
        tbl = blocks.get(c.table, c.table)
        cols = (columns or {}).get(c.table)
        if i in errors:
            v, outcome = "CAST(NULL AS DOUBLE)", "'error'"
        else:
            v = f"CAST(({value_sql(c, tbl, now_sql, ref_sql, cols)}) AS DOUBLE)"
            outcome = (f"CASE WHEN coalesce({cond_sql(c.fail, scale_sql)}, false) THEN 'fail' "
                       f"WHEN coalesce({cond_sql(c.warn, scale_sql)}, false) THEN 'warn' ELSE 'pass' END")
        parts.append(f"SELECT '{c.layer}' AS layer, '{c.table}' AS table_name, "
                     f"'{c.name}' AS check_name, value, {outcome} AS outcome "
                     f"FROM (SELECT {v} AS value) v{i}")
    return build("\nUNION ALL\n".join(parts))
