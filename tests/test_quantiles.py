"""Exact quantiles against Spark's own percentile and numpy, with ties, nulls, infinities and brackets narrower than the groups."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from locuslake.operators.quantiles import median, quantiles


@pytest.mark.parametrize("kind", ["normal", "ties", "tail", "one_value"])
def test_equal_to_percentile_bit_for_bit(spark, kind):
    rng = random.Random(kind)
    draw = {"normal": lambda: rng.gauss(0, 1), "ties": lambda: float(rng.randint(0, 3)), "tail": lambda: math.exp(rng.gauss(0, 8)), "one_value": lambda: 0.1}[kind]
    rows = [(rng.choice(["a", "b", None]), draw() if rng.random() < 0.95 else None, rng.random()) for _ in range(6000)] + [("c", None, None), ("d", 7.0, None)]
    d = spark.createDataFrame(rows, "g string, x double, y double").repartition(5)
    shares = {"q0": 0.0, "q1": 0.001, "q25": 0.25, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    want = {r["g"]: r.asDict() for r in d.groupBy("g").agg(*[F.percentile("x", s).alias(n) for n, s in shares.items()], F.percentile("y", 0.3).alias("y")).collect()}
    for accuracy, rows in ((5000, None), (100, None), (100, 6000)):  # at 100 the brackets hold a share of the group
        got = {r["g"]: r.asDict() for r in quantiles(d, ["g"], {**{n: ("x", s) for n, s in shares.items()}, "y": ("y", 0.3)}, accuracy, rows).collect()}
        assert got == want


@pytest.mark.parametrize("n", [1, 2, 50, 201])
def test_small_groups_at_every_share(spark, n):
    rng = random.Random(n)
    x = [rng.gauss(0, 1) for _ in range(n)]
    d = spark.createDataFrame([(v,) for v in x], "x double")
    shares = {f"q{k}": k / 7 for k in range(8)} | {"a": 0.99}
    want = d.agg(*[F.percentile("x", s).alias(k) for k, s in shares.items()]).first()
    for accuracy in (5000, 40):
        assert quantiles(d, [], {k: ("x", s) for k, s in shares.items()}, accuracy).first() == want


def test_over_all_rows_without_values_and_beyond_floats(spark):
    d = spark.createDataFrame([(float("inf"),), (1.0,), (float("nan"),), (2.0,), (None,), (float("-inf"),)], "x double")
    assert quantiles(d, [], {"a": ("x", 0.0), "b": ("x", 1 / 3), "c": ("x", 0.5), "d": ("x", 1.0)}).first() == (-math.inf, 1.0, 1.5, math.inf)
    assert quantiles(d.where("x is null"), [], {"a": ("x", 0.5)}).first() in (None, (None,))
    assert median(d.where("false").withColumn("g", F.lit(1)), ["g"], "x", "m").count() == 0
    x = np.random.default_rng(0).normal(size=4001)
    many = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert quantiles(many, [], {"m": (F.abs("x"), 0.5)}, 50).first()[0] == np.median(np.abs(x))


def test_no_task_holds_a_group(spark):
    """What is kept of a group is a small share of it."""
    d = spark.range(200_000).select((F.col("id") % 2).alias("g"), F.xxhash64("id").cast("double").alias("x"))
    want = {r["g"]: r["m"] for r in d.groupBy("g").agg(F.median("x").alias("m")).collect()}
    out = quantiles(d, ["g"], {"m": ("x", 0.5)}, 1000)
    assert {r["g"]: r["m"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan and "collect_list" not in plan
