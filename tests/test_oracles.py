"""Every registered query against its DuckDB oracle on the smallest tables
(row count, columns, exact values); queries without an oracle must run."""

import datetime as dt
import math
import os

import duckdb
import pytest

from ferrule.plans.registry import all_queries

TABLES = "region nation customer supplier part orders lineitem events".split()
NAMES = sorted(all_queries())


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else "f" + repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, con, name):
    q = all_queries()[name]
    df = q.build(spark, sf)
    srows = [tuple(norm(x) for x in r) for r in df.collect()]
    if not q.oracle:
        assert isinstance(srows, list)
        return
    res = con.execute(q.oracle)
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in df.columns]
    drows = [tuple(norm(r[i]) for i in order) for r in res.fetchall()]
    assert sorted(srows, key=key) == sorted(drows, key=key)
