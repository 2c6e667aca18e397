"""Every registered query against its DuckDB SQL on the smallest driver tables."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "boolean": "BOOLEAN",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE"}


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "sum_amount" in df.columns


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert isinstance(rows, list)
        return
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    otypes = dict(zip(*[con.sql(sql).columns, [str(t) for t in con.sql(sql).types]]))
    assert {c: DUCK.get(t, t.upper()) for c, t in df.dtypes} == otypes
    assert _rows(df.columns, rows) == _rows(ocols, res.fetchall())
