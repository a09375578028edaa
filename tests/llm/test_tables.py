"""Registered queries against their SQL on the smallest tables."""
import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.llm.fixtures import FOLDER

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables absent")
NAMES = [n for n in oracle_sql() if n.startswith("op")]


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in queries() if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in queries()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df = queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = con.execute(oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in result.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == want
