"""Every query runs on the smallest tables and equals its SQL statement there."""

import math
import os

import duckdb
import pytest

import __spark_entry__
from locuslake.plans.queries import ORACLES, QUERIES

D = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 8)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(D):
        con.execute(f"create view {f.split('.')[0]} as select * from '{D}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, D)
    cols = sorted(df.columns)
    got = [tuple(map(plain, r)) for r in df.select(*cols).collect()]
    if name not in ORACLES:
        assert got
        return
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = [tuple(plain(r[i]) for i in at) for r in rel.fetchall()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
