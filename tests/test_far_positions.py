"""The alignment queries on tables whose keys put positions beyond what a record of a file can hold, as those of 6 GB do."""

import duckdb
import pytest
from pyspark.sql import functions as F

from locuslake.plans.queries import ORACLES, QUERIES

D = "/root/testdata/sf0.001"
TABLES = {"lineitem": {"l_partkey": 7_000_000, "l_suppkey": 350_000}, "part": {"p_partkey": 7_000_000}, "supplier": {"s_suppkey": 350_000}}


@pytest.fixture(scope="module")
def far(spark, tmp_path_factory):
    """sf0.001 beside itself with its keys shifted to those of 6 GB."""
    path = str(tmp_path_factory.mktemp("far"))
    for table, shifts in TABLES.items():
        d = spark.read.parquet(f"{D}/{table}.parquet")
        d.unionByName(d.withColumns({c: F.col(c) + n for c, n in shifts.items()})).write.parquet(f"{path}/{table}.parquet")
    return path


@pytest.mark.parametrize("name", ["read_alignments", "alignments_in_range", "rebarcoded_alignments"])
def test_query(spark, far, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{far}/{table}.parquet/*.parquet'")
    df = QUERIES[name](spark, far)
    assert "pos0" in df.columns
    rel = con.sql(ORACLES[name])
    got, want = df.select(*rel.columns).collect(), rel.fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and want
