"""Row-count bands follow the data set, not the name of its folder."""

import shutil

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tidemark.plans.q_dq import fixture_scale

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def unlisted(tmp_path_factory):
    folder = tmp_path_factory.mktemp("data") / "some_customers"
    shutil.copytree(SF, folder)
    return str(folder)


@pytest.mark.parametrize("name", ["dq_bronze", "dq_gold", "dq_negative_nulls", "dq_negative_dups", "dq_negative_drop"])
def test_unlisted_folder_matches_oracle(spark, unlisted, name):
    con = duckdb.connect()
    for t in ("customer", "nation", "orders", "lineitem", "events", "part", "region", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{unlisted}/{t}.parquet')")
    got = {tuple(r) for r in queries()[name](spark, unlisted).collect()}
    assert got == set(con.execute(oracle_sql()[name]).fetchall())
    assert got == {tuple(r) for r in queries()[name](spark, SF).collect()}


def test_scale_is_the_same_in_every_folder(spark, unlisted):
    assert fixture_scale(spark, unlisted) == fixture_scale(spark, SF) == 0.15
