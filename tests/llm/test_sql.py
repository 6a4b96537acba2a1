"""Queries on the small tables against their SQL."""

from pathlib import Path

import duckdb
import pytest

from deltaloom.llm.queries import QUERIES, SQL

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.is_dir(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {t.stem} AS SELECT * FROM '{t}'")
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    df = QUERIES[name](spark, str(SF))
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want.fetchall())
