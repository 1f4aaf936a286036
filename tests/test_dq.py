"""Data-quality engine: predicted values, negative tests, gate."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import from_iso8601, hours_between
from tidemark.operators import dq
from tidemark.operators.dq import Check

NOW = "2026-08-04 12:00:00"
COLS = "contact_email string, first_name string, company string, created_date string, _ingested_at string"


def crm(spark, n=10):
    return spark.createDataFrame(
        [(f"u{i}@x.com", f"F{i}", "C", "2026-01-01", "2026-08-04T06:00:00+00:00") for i in range(n)], COLS)


def crm_checks():
    return [
        Check("bronze", "crm", "row_count", "row_count", fail=("not_between", 5, 100, "scaled")),
        Check("bronze", "crm", "missing_count(contact_email)", "missing_count", "contact_email",
              fail=("ne", 0)),
        Check("bronze", "crm", "duplicate_count(contact_email)", "duplicate_count",
              "contact_email", fail=("ne", 0)),
        Check("bronze", "crm", "schema", "schema", fail=("gt", 0),
              params={"required": ["contact_email", "first_name", "company", "created_date"]}),
        Check("bronze", "crm", "column_count", "column_count", fail=("ne", 5)),
        Check("bronze", "crm", "hours_since_ingest", "aggregate", warn=("gt", 3), fail=("gt", 48),
              params={"expr": lambda now: hours_between(F.max(from_iso8601(F.col("_ingested_at"))), now)}),
    ]


def results(spark, table, checks=None, scale=1.0):
    out = dq.run_checks(spark, {"crm": table}, checks or crm_checks(), NOW, scale=scale)
    return {r["check_name"]: (r["value"], r["outcome"]) for r in out.collect()}


def test_duplicate_count_ignores_nulls(spark):
    df = spark.createDataFrame([(None,)] * 3 + [(f"v{i}",) for i in range(5)] * 2 + [("solo",)], "c string")
    assert dq.duplicate_count(df, ["c"]).first()["value"] == 5


def test_negative_sequence_hits_predicted_checks(spark):
    base = crm(spark)
    r0 = results(spark, base)
    assert sum(o == "fail" for _, o in r0.values()) == 0
    assert r0["hours_since_ingest"] == (6.0, "warn")
    nulls = dq.inject_nulls(base, "contact_email", 3)
    r1 = results(spark, nulls)
    assert r1["missing_count(contact_email)"] == (3.0, "fail")
    dups = dq.inject_duplicates(nulls, 5, not_null="contact_email")
    r2 = results(spark, dups)
    assert r2["duplicate_count(contact_email)"] == (5.0, "fail")
    r3 = results(spark, dq.drop_column(dups, "company"))
    assert r3["schema"] == (1.0, "fail") and r3["column_count"] == (4.0, "fail")
    assert [sum(o == "fail" for _, o in r.values()) for r in (r1, r2, r3)] == [1, 2, 4]
    assert base.count() == 10                     # the original is untouched


def test_scaled_threshold(spark):
    assert results(spark, crm(spark))["row_count"][1] == "pass"
    assert results(spark, crm(spark), scale=10.0)["row_count"] == (10.0, "fail")   # band 50..1000


def test_missing_column_is_error_not_crash(spark):
    chk = [Check("bronze", "crm", "missing_count(gone)", "missing_count", "gone", fail=("ne", 0))]
    assert results(spark, crm(spark), chk)["missing_count(gone)"] == (None, "error")


def test_failed_rows_null_is_not_failure(spark):
    df = spark.createDataFrame([(1, 2), (3, None), (5, 4)], "a int, b int")
    assert dq.failed_rows(df, F.col("a") > F.col("b")).count() == 1


def test_relationships_and_accepted_values(spark):
    child = spark.createDataFrame([("k1",), ("k9",), (None,)], "k string")
    parent = spark.createDataFrame([("k1",)], "k string")
    assert dq.relationship_violations(child, "k", parent, "k").count() == 1
    chk = [Check("gold", "t", "accepted_values(k)", "accepted_values", "k", fail=("gt", 0),
                 params={"values": ["k1"]})]
    out = dq.run_checks(spark, {"t": spark.createDataFrame([("k1",), ("x",), ("x",), ("y",), (None,)], "k string")},
                        chk, NOW).first()
    assert (out["value"], out["outcome"]) == (2.0, "fail")   # distinct bad values; NULL passes


def test_gate(spark):
    mk = lambda outs: spark.createDataFrame([("l", "t", f"c{i}", 1.0, o) for i, o in enumerate(outs)],
                                            "layer string, table_name string, check_name string, value double, outcome string")
    assert dq.gate(mk(["pass", "pass"])) == "pass"
    assert dq.gate(mk(["pass", "warn"])) == "warn"
    with pytest.raises(dq.GateError) as e:
        dq.gate(mk(["warn", "fail"]))
    assert e.value.code == 2
    with pytest.raises(dq.GateError) as e:
        dq.gate(mk([]).limit(0))
    assert e.value.code == 3
    with pytest.raises(dq.GateError) as e:
        dq.gate(mk(["pass", "error"]))
    assert e.value.code == 3
