"""Training-data queries against their SQL."""

import duckdb
import pytest

from arkspark.llm import queries as llm

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("conversations", "documents", "labels", "pages"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    theirs, ours = con.sql(llm.ORACLE_SQL[name]), llm.queries()[name](spark, SF)
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert sorted((tuple(r[c] for c in theirs.columns) for r in ours.collect()), key=repr) == sorted(theirs.fetchall(), key=repr)
