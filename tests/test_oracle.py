"""Every change-apply query against its SQL, on the small tables."""

from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from deltaloom.plans.queries import QUERIES, SQL

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.is_dir(), reason="no test tables")


def _plain(v):
    if isinstance(v, Decimal):
        return format(v.normalize(), "f")
    return repr(v) if isinstance(v, float) else str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {t.stem} AS SELECT * FROM '{t}'")
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    df = QUERIES[name](spark, str(SF))
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, df.collect()) == _rows(names, want.fetchall())
