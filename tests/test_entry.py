import duckdb
import pytest

import __spark_entry__ as entry
from basalt.plans.views import TABLES


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 5 and sum(r["total"] for r in rows) > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    import datetime as dt
    import decimal
    import math
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    sdf = entry.queries()[name](spark, sf_dir)
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order_s = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted((tuple(_norm(r[i]) for i in order_s) for r in sdf.collect()), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in order_d) for r in cur.fetchall()), key=repr)
    assert a == b
