"""The operators that SQL can express, against their counterparts on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from tallyloom.llm.oracles import oracle_sql  # noqa: E402
from tallyloom.llm.queries import queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = queries()[name](spark, FOLDER)
    result = con.execute(oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    wanted = sorted(repr([row[names.index(c)] for c in df.columns]) for row in result.fetchall())
    assert sorted(repr(list(row)) for row in df.collect()) == wanted
