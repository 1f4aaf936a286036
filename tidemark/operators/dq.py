"""Declarative data-quality checks (Q1-Q13), model tests (D1-D5) and the gate.

A check is data: layer, table, name, kind, parameters, and ``fail`` /
``warn`` conditions. ``run_checks`` evaluates a list of checks against a
dict of tables and returns one row per check:
``(layer, table_name, check_name, value, outcome)``.

Execution plan per table:

* every aggregate-shaped metric of the table (row counts, missing counts
  and percentages, invalid counts, freshness, failed-row counts, custom
  aggregate expressions, not-null tests) is fused into a **single** ``agg`` -> one
  scan, partial + final aggregation;
* all accepted-values tests of a table share one more scan that keeps only
  rows with a value outside a list;
* all duplicate / uniqueness metrics of a table share one scan and one
  ``groupBy`` of (metric, value), pre-aggregated map-side;
* schema and column-count checks read only the schema (no job);
* cross-table metrics are small plans of their own that end in one row.

Only the verdict rows (one per check) ever reach the driver, in ``gate``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import hours_between, ts_literal

# kinds evaluated inside the fused per-table aggregation
AGG_KINDS = {"row_count", "missing_count", "missing_percent", "invalid_count", "freshness",
             "failed_rows", "aggregate", "not_null"}
GROUP_KINDS = {"duplicate_count", "unique"}
SCHEMA_KINDS = {"schema", "column_count"}
CROSS_KINDS = {"metric", "relationships", "singular"}


@dataclass(frozen=True)
class Check:
    layer: str
    table: str
    name: str
    kind: str
    column: str | None = None
    fail: tuple | None = None
    warn: tuple | None = None
    params: dict = field(default_factory=dict, hash=False, compare=False)


# ------------------------------------------------------------------ conditions
def when_(op: str, *args) -> tuple:
    """A threshold condition: ``("gt", 48)``, ``("not_between", 0, 26)``..."""
    return (op, *args)


def _cond(value: Column, cond: tuple | None, scale: float = 1.0) -> Column:
    if cond is None:
        return F.lit(False)
    op, *a = cond
    factor = scale if a and a[-1] == "scaled" else 1.0
    a = [F.lit(float(x) * factor) for x in a if x != "scaled"]
    return {
        "gt": lambda: value > a[0], "ge": lambda: value >= a[0],
        "lt": lambda: value < a[0], "le": lambda: value <= a[0],
        "eq": lambda: value == a[0], "ne": lambda: value != a[0],
        "between": lambda: value.between(a[0], a[1]),
        "not_between": lambda: ~value.between(a[0], a[1]),
    }[op]()


def outcome_of(value: Column, fail: tuple | None, warn: tuple | None,
               scale: float = 1.0) -> Column:
    """fail when the fail condition holds, else warn, else pass (Q10). A
    NULL metric triggers nothing. Thresholds marked "scaled" are multiplied
    by ``scale``."""
    return (F.when(F.coalesce(_cond(value, fail, scale), F.lit(False)), "fail")
             .when(F.coalesce(_cond(value, warn, scale), F.lit(False)), "warn")
             .otherwise("pass"))


# ------------------------------------------------------------------ metrics
def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _agg_expr(chk: Check, df: DataFrame, as_of: Column) -> Column:
    k, col = chk.kind, chk.column
    if k == "row_count":
        return F.count(F.lit(1))
    if k in ("missing_count", "not_null"):
        return F.count_if(_c(col).isNull())
    if k == "missing_percent":
        return F.round(F.lit(100.0) * F.count_if(_c(col).isNull()).cast("double")
                       / F.when(F.count(F.lit(1)) != 0, F.count(F.lit(1)).cast("double")), 2)
    if k == "invalid_count":
        v = _c(col)
        bad = F.lit(False)
        if "valid_min" in chk.params:
            bad = bad | (v < F.lit(chk.params["valid_min"]))
        if "valid_max" in chk.params:
            bad = bad | (v > F.lit(chk.params["valid_max"]))
        return F.count_if(v.isNotNull() & bad)
    if k == "freshness":
        return hours_between(F.max(_c(col)), as_of)
    if k == "failed_rows":
        return F.count_if(F.coalesce(chk.params["condition"](), F.lit(False)))
    if k == "aggregate":
        return chk.params["expr"](as_of)
    raise ValueError(k)


def duplicate_count(df: DataFrame, columns: Sequence[str], ignore_nulls: bool = True) -> DataFrame:
    """Number of distinct values (or value tuples) that occur more than once."""
    d = df.select([_c(c).alias(f"_k{i}") for i, c in enumerate(columns)])
    if ignore_nulls:
        d = d.dropna()
    return (d.groupBy(d.columns).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.count_if(F.col("n") > 1).alias("value")))


def duplicate_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``duplicate_count`` of several checks of one table as one row ``m0,
    m1, ...``: one scan and one shuffle of (check, value) pairs instead of one
    of each per check."""
    pairs = []
    for k, c in enumerate(checks):
        cols = [_c(x) for x in c.params.get("columns", [c.column])]
        pair = F.struct(F.lit(k).alias("k"), F.array(*[x.cast("string") for x in cols]).alias("v"))
        known = reduce(Column.__and__, [x.isNotNull() for x in cols])
        pairs.append(F.when(known, pair) if c.params.get("ignore_nulls", True) else pair)
    twice = (df.select(F.explode(F.array_compact(F.array(*pairs))).alias("p")).groupBy("p.k", "p.v")
             .agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    return twice.agg(*[F.count_if(F.col("k") == k).alias(f"m{k}") for k in range(len(checks))])


def unaccepted_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Per accepted-values check the number of distinct values outside its
    list (D3), as one row ``m0, m1, ...``; NULL passes. Clean rows go before
    anything else, the others give one (check, value) pair per bad value."""
    bad = [~_c(c.column).isin(*c.params["values"]) for c in checks]
    pairs = [F.when(b, F.struct(F.lit(k).alias("k"), _c(c.column).cast("string").alias("v")))
             for k, (b, c) in enumerate(zip(bad, checks))]
    found = (df.filter(reduce(Column.__or__, bad))
             .select(F.explode(F.array_compact(F.array(*pairs))).alias("p")).select("p.k", "p.v").distinct())
    return found.agg(*[F.count_if(F.col("k") == k).alias(f"m{k}") for k in range(len(checks))])


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns absent from the table (Q7)."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def failed_rows(df: DataFrame, condition: Column) -> DataFrame:
    """The rows for which the condition is true; NULL is not a failure (Q8)."""
    return df.filter(F.coalesce(condition, F.lit(False)))


def relationship_violations(child: DataFrame, column: str, parent: DataFrame,
                            parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key is absent from the parent."""
    keys = parent.select(_c(parent_column).alias("_pk")).distinct()
    return (child.filter(_c(column).isNotNull())
            .join(keys, _c(column) == F.col("_pk"), "left_anti"))


def scalars(**one_row: DataFrame) -> DataFrame:
    """Combine one-row, one-column frames into one row with one column per
    name, by union + aggregate (no cross join)."""
    parts = []
    names = list(one_row)
    for n, d in one_row.items():
        v = d.select(F.col(d.columns[0]).cast("double").alias(n))
        parts.append(v.select([F.col(n) if m == n else F.lit(None).cast("double").alias(m)
                               for m in names]))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.max(n).alias(n) for n in names])


def count_of(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ engine
def _sql_text(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _cond_sql(v: str, cond: tuple | None, scale: float) -> str:
    if cond is None:
        return "false"
    op, *a = cond
    factor = scale if a and a[-1] == "scaled" else 1.0
    a = [f"{float(x) * factor!r}D" for x in a if x != "scaled"]
    return {
        "gt": f"{v} > {a[0]}" if a else "", "ge": f"{v} >= {a[0]}" if a else "",
        "lt": f"{v} < {a[0]}" if a else "", "le": f"{v} <= {a[0]}" if a else "",
        "eq": f"{v} = {a[0]}" if a else "", "ne": f"{v} <> {a[0]}" if a else "",
        "between": f"{v} BETWEEN {a[0]} AND {a[-1]}",
        "not_between": f"NOT ({v} BETWEEN {a[0]} AND {a[-1]})",
    }[op]


def _verdict(c: Check, value_sql: str, scale: float, error: bool = False) -> Column:
    """One result row as a struct (labels, value, outcome), built as one SQL
    expression: a single call to the JVM per check."""
    v = f"CAST({value_sql} AS DOUBLE)"
    outcome = ("'error'" if error else
               f"CASE WHEN coalesce({_cond_sql(v, c.fail, scale)}, false) THEN 'fail' "
               f"WHEN coalesce({_cond_sql(v, c.warn, scale)}, false) THEN 'warn' ELSE 'pass' END")
    return F.expr(f"named_struct('layer', {_sql_text(c.layer)}, 'table_name', {_sql_text(c.table)}, "
                  f"'check_name', {_sql_text(c.name)}, 'value', {v}, 'outcome', {outcome})")


def run_checks(spark: SparkSession, tables: dict[str, DataFrame], checks: Sequence[Check],
               as_of, reference_now=None, scale: float = 1.0) -> DataFrame:
    """Evaluate ``checks``; one row per check (layer, table_name, check_name,
    value, outcome). ``as_of`` is "now" (Q6, Q11); ``reference_now`` the
    logical clock of event-time checks (defaults to ``as_of``). Every
    partial result already carries its labels and outcome, so the final
    result is a plain union of one-row (or few-row) frames."""
    now = ts_literal(as_of)
    ref = ts_literal(reference_now if reference_now is not None else as_of)
    parts: list[DataFrame] = []
    one = spark.range(1)

    def literal(c: Check, value, error: bool = False) -> DataFrame:
        return one.select(_verdict(c, "NULL" if value is None else f"{float(value)!r}D", scale,
                                   error).alias("r"))

    by_table: dict[str, list[Check]] = {}
    for chk in checks:
        by_table.setdefault(chk.table, []).append(chk)

    for tname, items in by_table.items():
        df = tables.get(tname)
        aggs = [c for c in items if c.kind in AGG_KINDS]
        accepted = [c for c in items if c.kind == "accepted_values"]
        if df is not None:
            # a check on a column the table no longer has cannot run: NULL value, "error"
            broken = [c for c in aggs + accepted if c.column is not None and c.column not in df.columns]
            parts.extend(literal(c, None, error=True) for c in broken)
            aggs = [c for c in aggs if c not in broken]
            listed = [c for c in accepted if c not in broken]
            if listed:
                parts.append(unaccepted_counts(df, listed).select(F.explode(F.array(*[
                    _verdict(c, f"m{k}", scale) for k, c in enumerate(listed)])).alias("r")))
            if aggs:
                # all aggregate-shaped metrics of the table: one scan, one aggregation
                exprs = [_agg_expr(c, df, ref if c.params.get("clock") == "reference" else now)
                         .cast("double").alias(f"m{k}") for k, c in enumerate(aggs)]
                row = df.agg(*exprs)
                parts.append(row.select(F.explode(F.array(*[
                    _verdict(c, f"m{k}", scale) for k, c in enumerate(aggs)])).alias("r")))
            keyed = [c for c in items if c.kind in GROUP_KINDS]
            if len(keyed) > 1:
                parts.append(duplicate_counts(df, keyed).select(F.explode(F.array(*[
                    _verdict(c, f"m{k}", scale) for k, c in enumerate(keyed)])).alias("r")))
                items = [c for c in items if c not in keyed]
        for c in items:
            if c.kind in GROUP_KINDS and df is not None:
                v = duplicate_count(df, c.params.get("columns", [c.column]),
                                    c.params.get("ignore_nulls", True))
                parts.append(v.select(_verdict(c, "value", scale).alias("r")))
            elif c.kind in SCHEMA_KINDS:
                if df is None:
                    n = float(len(c.params.get("required", []))) if c.kind == "schema" else 0.0
                elif c.kind == "schema":
                    n = float(len(missing_columns(df, c.params["required"])))
                else:
                    n = float(len(df.columns))
                parts.append(literal(c, n))
            elif c.kind in CROSS_KINDS:
                fn: Callable = c.params["metric"]
                v = fn(tables, ref if c.params.get("clock") == "reference" else now)
                parts.append(v.select(_verdict(c, f"`{v.columns[0]}`", scale).alias("r")))

    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)          # every part is the same single struct column
    return out.select("r.*")


def run_or_report(spark: SparkSession, tables: dict[str, DataFrame], checks: Sequence[Check],
                  as_of, reference_now=None, scale: float = 1.0) -> DataFrame:
    """``run_checks`` over the tables there are; a check whose table is
    missing is a row without a value and with the outcome ``error`` (Q12)."""
    there = [c for c in checks if c.table in tables]
    lost = [c for c in checks if c.table not in tables]
    parts = [run_checks(spark, tables, there, as_of, reference_now, scale)] if there else []
    if lost:
        parts.append(spark.createDataFrame([(c.layer, c.table, c.name, None, "error") for c in lost],
                                           "layer string, table_name string, check_name string, value double, outcome string"))
    return reduce(DataFrame.union, parts)


class GateError(RuntimeError):
    def __init__(self, code: int, message: str):
        super().__init__(message)
        self.code = code


def gate_counts(counts: dict[str, int]) -> str:
    """Layer gate (Q12) over outcome counts: no results -> code 3; a check
    that could not run ("error") -> code 3; any fail -> blocked (code 2);
    warnings alone pass. Returns "pass" or "warn"."""
    if not counts or sum(counts.values()) == 0:
        raise GateError(3, "no check results")
    if counts.get("fail", 0) > 0:
        raise GateError(2, f"{counts['fail']} check(s) failed")
    if counts.get("error", 0) > 0:
        raise GateError(3, f"{counts['error']} check(s) could not run")
    return "warn" if counts.get("warn", 0) > 0 else "pass"


def gate(results: DataFrame) -> str:
    """Gate a result table: only the outcome counts reach the driver."""
    rows = results.groupBy("outcome").count().collect()
    return gate_counts({r["outcome"]: r["count"] for r in rows})


# ------------------------------------------------------------------ negative tests
def _total_order(df: DataFrame, order_by) -> list[Column]:
    """``order_by`` (names or Columns) completed by every column, ascending."""
    lead = [(_c(c).asc_nulls_last() if isinstance(c, str) else c) for c in (order_by or [])]
    return lead + [_c(c).asc_nulls_last() for c in df.columns]


def inject_nulls(df: DataFrame, column: str, n: int, order_by=None) -> DataFrame:
    """Append ``n`` copies of existing rows with ``column`` set to NULL.
    Which rows: the first ``n`` under ``order_by`` completed to a total order.
    ``limit`` is the feature here (inject exactly n rows): planned as a
    per-partition top-n then a merge, never a full sort."""
    picked = df.orderBy(*_total_order(df, order_by)).limit(n)
    return df.unionByName(picked.withColumn(column, F.lit(None).cast(df.schema[column].dataType)))


def inject_duplicates(df: DataFrame, n: int, not_null: str | None = None,
                      order_by=None) -> DataFrame:
    """Append ``n`` exact copies of existing rows (N2), optionally only rows
    where ``not_null`` is set."""
    src = df if not_null is None else df.filter(_c(not_null).isNotNull())
    picked = src.orderBy(*_total_order(src, order_by)).limit(n)
    return df.unionByName(picked)


def drop_column(df: DataFrame, column: str) -> DataFrame:
    """Schema defect."""
    return df.drop(column)
