"""Every registered query against its SQL statement on DuckDB (sf0.001),
the way the driver compares them: rows, column names, order-insensitive values."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from tidemark.plans.queries import ORACLE, QUERIES


def queries():
    return QUERIES


def oracle_sql():
    return ORACLE

SF = os.environ.get("TIDEMARK_TEST_SF", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def canon(cols, tuples):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        return v
    out = [tuple(norm(t[i]) for i in order) for t in tuples]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_an_oracle_or_is_documented():
    missing = set(queries()) - set(oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, srows) == canon(dcols, drows)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["plan", "active_subscriptions", "monthly_price", "mrr"]
    assert df.count() >= 0
