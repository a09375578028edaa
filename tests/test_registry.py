"""Registered queries against their SQL on the smallest tables."""
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
TABLES = ["customer", "orders", "events"]
SAMPLE = ["engineered_features", "drift_numeric", "master_table", "stratified_split", "did_regression", "iv_readout", "ipw_ate"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables absent")


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    out = entry(spark)
    assert out.count() > 10 and "churn_rate" in out.columns


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df = queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    result = con.execute(oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in result.fetchall())
    assert got == want
