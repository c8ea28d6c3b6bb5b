"""Frequencies of alternatives by expectation and maximisation, against a plain loop."""

import random

import numpy as np
from pyspark.sql import functions as F

from locuslake.operators import alignments, masks


def plain(samples, rounds, least):
    f = 0.5
    for _ in range(rounds):
        total = 0.0
        for a, b, c in samples:
            p1, p2 = 2 * f * (1 - f) * b, f * f * c
            total += (p1 + 2 * p2) / (2 * ((1 - f) * (1 - f) * a + p1 + p2))
        f = min(max(total / len(samples), least), 1 - least)
    return f


def test_frequencies_equal_a_plain_loop():
    draw = random.Random(3)
    sites = [[[draw.random() ** 9 for _ in range(3)] for _ in range(n)] for n in (3, 1, 40, 2, 1, 7)]
    flat = np.array([x for s in sites for x in s])
    got = alignments.frequencies(np.array([len(s) for s in sites]), *flat.T, 20, 1e-4)
    assert got.tolist() == [plain(s, 20, 1e-4) for s in sites]
    assert alignments.frequencies(np.array([], int), *np.empty((3, 0)), 20, 1e-4).tolist() == []


def test_no_round_is_interpreted_row_by_row(spark):
    scored = spark.createDataFrame([("c", 1, "A", "C", "s", 2, 1, 0, -10, -20, -30)], "chrom string, pos0 long, ref string, alt string, sample_id string, dp long, ad long, oth long, l0 long, l1 long, l2 long")
    plan = alignments.genotyped(scored)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan and "ArrowEvalPython" in plan


def test_balance_is_tested_once_for_each_pair(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(masks, "stored", lambda d, name: kept.append(d) or d.localCheckpoint())
    d = spark.range(9).select(F.lit("c").alias("chrom"), F.col("id").alias("pos0"), F.lit(20).cast("long").alias("dp"), (F.col("id") % 2 * 10).alias("ad"))
    assert {r["pos0"] for r in masks.balanced(d).collect()} == {1, 3, 5, 7}
    assert [x.count() for x in kept] == [2]
