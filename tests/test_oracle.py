"""Registered queries vs their DuckDB oracles on the smallest testdata."""
import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FAST = [k for k in E.oracle_sql() if not k.startswith(("op", "pipeline"))]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("testdata missing")
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["order_date", "total_orders", "revenue", "avg_order_value"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sdf.columns
    s_rows = Counter(tuple(_norm(x) for x in r) for r in sdf.collect())
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    d_rows = Counter(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert s_rows == d_rows
