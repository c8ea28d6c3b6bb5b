"""Bins over parts of bounded size against the plain fold: groups over many parts, bins over whole parts, several samples, spans."""

import random

import numpy as np
import pytest

from locuslake.operators import binning


def plain(rows, samples, least_reads, least_snps, most_span):
    out, groups = {}, {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    for key, mine in groups.items():
        mine.sort(key=lambda r: r[1])
        got = binning.fold(np.array([r[4 : 4 + samples] for r in mine], float), np.array([r[3] for r in mine]), np.array([r[1] for r in mine]), np.array([r[2] for r in mine]), least_reads, least_snps, most_span)
        out |= {(key, r[1]): int(b) for r, b in zip(mine, got)}
    return out


@pytest.mark.parametrize("least_reads, least_snps, most_span", [(50, 3, 0), (200, 1, 900), (10**9, 1, 0), (3000, 40, 0)])
def test_bins_equal_the_fold(spark, least_reads, least_snps, most_span):
    rng, rows = random.Random(least_reads + most_span), []
    for key, n in (("a", 700), ("b", 1), ("c", 2), (None, 60), ("d", 333)):
        at = 0
        for _ in range(n):
            at += rng.randint(1, 60)
            rows.append((key, at, at + rng.randint(1, 90), rng.choice([0, 0, 1, 2, 5]), rng.choice([0, 0, rng.randint(0, 40)]), rng.randint(0, 30)))
    d = spark.createDataFrame([(*r, "own") for r in rows], "grp string, start long, stop long, n_snps long, s1 long, s2 long, local_ string").repartition(4)
    want = plain(rows, 2, least_reads, least_snps, most_span)
    for small, halo in ((10**6, 0), (0, 20)):  # groups as they are, and in parts
        got = binning.by_reads(d, ["grp"], ["start"], ["s1", "s2"], least_reads, least_snps, most_span, 200, halo, small)
        assert got.columns == [*d.columns, "local_bin"]
        assert {(r["grp"], r["start"]): r["local_bin"] for r in got.collect()} == want
    assert binning.by_reads(d.where("false"), ["grp"], ["start"], ["s1", "s2"], least_reads, least_snps).count() == 0


def test_a_group_is_spread_over_parts(spark, monkeypatch):
    seen = []
    d = spark.range(0, 2000).selectExpr("'g' as grp", "id * 10 as start", "id * 10 + 10 as stop", "1L as n_snps", "id % 7 as s1")
    monkeypatch.setattr(binning, "stored", lambda x, name, f=binning.stored: seen.append((name, f(x, name))) or seen[-1][1])
    out = binning.by_reads(d, ["grp"], ["start"], ["s1"], 30, 5, 0, 300, 30, 0)
    assert out.count() == 2000
    sizes = [r["count"] for r in dict(seen)["jumps"].groupBy("_q").count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 600
