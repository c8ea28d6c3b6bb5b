"""Hand-worked cases of counts, masks, genotypes, bins, depth and maps."""

import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from locuslake.config import validate_samples
from locuslake.functions import columns as C
from locuslake.operators import binning, counts, depth, features, genetics, genotype, intervals, masks
from locuslake.schema import standard


def test_duplicates_align_first_and_drop_all(spark):
    child = spark.createDataFrame([("chr1", 1, 5), ("chr1", 1, 6), ("chr1", 2, 7)], "chrom string, pos0 long, dp long")
    parent = spark.createDataFrame([("chr1", 1), ("chr1", 2), ("chr1", 3)], "chrom string, pos0 long")
    assert {r["pos0"]: r["dp"] for r in counts.aligned(parent, child, ["dp"]).collect()} == {1: 0, 2: 7, 3: 0}
    assert {(r["pos0"], r["dp"]) for r in counts.first_of(child, ["chrom", "pos0"], ["dp"]).collect()} == {(1, 5), (2, 7)}
    assert [r["pos0"] for r in counts.singles(child, ["chrom", "pos0"]).collect()] == [2]


def test_genotypes_and_phase(spark):
    d = spark.createDataFrame([(2, 4), (10, 10), (0, 10), (0, 9), (1, 4), (0, 0)], "ad long, dp long")
    assert [r["gt"] for r in genotype.called(d).collect()] == ["0/1", "1/1", "0/0", "./.", "./.", "./."]
    p = spark.createDataFrame([(1, 5, 8), (0, 5, 8)], "phase int, ad long, dp long")
    assert [(r["b"], r["a"]) for r in counts.phased(p).collect()] == [(3, 5), (5, 3)]


@pytest.mark.parametrize("a,b,x", [(1, 1, 0.5), (3, 5, 0.45), (40, 2, 0.55), (900, 1100, 0.45), (2500, 2400, 0.5)])
def test_beta_cdf(spark, a, b, x):
    got = spark.range(1).select(C.beta_cdf(x, F.lit(a), F.lit(b)).alias("v")).first()["v"]
    n = a + b - 1
    want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(x) + (n - k) * math.log(1 - x)) for k in range(a, n + 1))
    assert abs(got - want) < 1e-9


def test_boundaries(spark):
    snps = spark.createDataFrame([("chr1", 10), ("chr1", 13), ("chr2", 7)], "chrom string, pos0 long")
    regions = spark.createDataFrame([("chr1", 0, 100, "p1"), ("chr2", 5, 50, "p2")], "chrom string, start long, stop long, region_id string")
    got = {r["pos0"]: (r["start"], r["stop"]) for r in masks.boundaries(snps, regions).collect()}
    assert got == {10: (0, 12), 13: (12, 100), 7: (5, 50)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=40), st.integers(1, 9))
def test_fold_without_reads_has_the_closed_form(reads, size):
    n = len(reads)
    got = binning.fold(np.array(reads, float)[:, None], np.ones(n, int), np.arange(n), np.arange(n) + 1, 0, size)
    assert got.tolist() == [min(i // size, max(n // size - 1, 0)) for i in range(n)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=40), st.integers(1, 60), st.integers(1, 5), st.integers(0, 12))
def test_fold_makes_runs_that_meet_their_limits(reads, least, snps, span):
    n = len(reads)
    got = binning.fold(np.array(reads, float)[:, None], np.ones(n, int), np.arange(n), np.arange(n) + 1, least, snps, span)
    assert got[0] == 0 and set(np.diff(got)) <= {0, 1}
    for b in range(got.max() + 1):
        at = np.flatnonzero(got == b)
        assert got.max() == 0 or sum(reads[i] for i in at) >= least and len(at) >= snps or span and len(at) >= span


def test_fill_forward_crosses_parts(spark):
    d = spark.createDataFrame([(1, 1, None), (1, 2, 5), (2, 1, None), (3, 1, None), (3, 2, 7), (4, 1, None)], "part int, i int, v int")
    got = {(r["part"], r["i"]): r["v"] for r in binning.filled_forward(d, ["v"], "part", ["i"]).collect()}
    assert got == {(1, 1): None, (1, 2): 5, (2, 1): 5, (3, 1): 5, (3, 2): 7, (4, 1): 7}


def test_mode_takes_the_smallest_on_ties(spark):
    d = spark.createDataFrame([("w", v) for v in (3, 1, 3, 1)], "w string, v int")
    assert binning.mode_by_window(d, ["w"], "v").first()["v"] == 1


def test_haldane_and_interpolation(spark):
    k = spark.createDataFrame([("chr1", 100, 1.0), ("chr1", 200, 3.0)], "chrom string, pos long, cm double")
    p = spark.createDataFrame([("chr1", x) for x in (5, 100, 150, 200, 900)] + [("chr9", 1)], "chrom string, pos0 long")
    got = {(r["chrom"], r["pos0"]): r["cm"] for r in genetics.interpolated(p, k).collect()}
    assert got == {("chr1", 5): 1.0, ("chr1", 100): 1.0, ("chr1", 150): 2.0, ("chr1", 200): 3.0, ("chr1", 900): 3.0, ("chr9", 1): None}
    r = spark.createDataFrame([(0.0,), (1e9,)], "d double").select(C.haldane(F.col("d")).alias("p")).collect()
    assert r[0]["p"] == 1e-6 and r[1]["p"] == 0.5


def test_median_regression_finds_the_curve(spark):
    rng = np.random.default_rng(0)
    gc = rng.uniform(0.3, 0.7, 3000)
    y = 5 + 40 * gc - 30 * gc**2 + rng.laplace(0, 0.3, 3000)
    y[:200] += 500  # outliers do not move a median
    d = spark.createDataFrame([("s", float(a), float(a * a), float(b)) for a, b in zip(gc, y)], "sample_id string, gc double, gc2 double, y double")
    b = depth.median_regression(d, "y", ["gc", "gc2"])["s"]
    assert np.abs(b[0] + b[1] * gc + b[2] * gc**2 - (5 + 40 * gc - 30 * gc**2)).max() < 0.3


def check_loss(x, y, b):
    return np.abs(y - x @ b).sum()


def exact_median_fit(x, y):
    """The best of all fits through as many rows as there are terms: one of them has the least loss."""
    k = x.shape[1]
    fits = (np.linalg.solve(x[list(i)], y[list(i)]) for i in itertools.combinations(range(len(y)), k) if abs(np.linalg.det(x[list(i)])) > 1e-12)
    return min(check_loss(x, y, b) for b in fits)


@pytest.mark.parametrize("terms", [1, 2])
def test_median_regression_has_the_least_loss(spark, terms):
    rng = np.random.default_rng(terms)
    rows, cases = [], {}
    for s in ("a", "b", "c"):
        gc = rng.uniform(0.2, 0.8, 26)
        y = 3 + 20 * gc - 9 * gc**2 + rng.standard_t(1, 26)
        if s == "c":
            y = np.round(y)  # ties
        rows += [(s, float(v), *(float(g) ** (k + 1) for k in range(terms))) for v, g in zip(y, gc)]
        cases[s] = (np.stack([np.ones(26), *(gc ** (k + 1) for k in range(terms))], 1), y)
    d = spark.createDataFrame(rows, "sample_id string, y double, " + ", ".join(f"t{k} double" for k in range(terms)))
    got = depth.median_regression(d, "y", [f"t{k}" for k in range(terms)])
    for s, (x, y) in cases.items():
        assert check_loss(x, y, got[s]) <= exact_median_fit(x, y) * (1 + 1e-5)


def test_median_regression_of_more_rows_than_a_task_takes(spark):
    rng = np.random.default_rng(3)
    gc = rng.uniform(0.3, 0.7, 8000)
    y = 5 + 40 * gc - 30 * gc**2 + rng.laplace(0, 2, 8000)
    d = spark.createDataFrame([(s, float(a), float(a * a), float(b)) for s in ("big", "small") for a, b in zip(gc, y) if s == "big" or a < 0.31], "sample_id string, gc double, gc2 double, y double")
    whole, parts = depth.median_regression(d, "y", ["gc", "gc2"]), depth.median_regression(d, "y", ["gc", "gc2"], rows=1000)
    x = np.stack([np.ones(8000), gc, gc**2], 1)
    assert check_loss(x, y, parts["big"]) <= check_loss(x, y, whole["big"]) * (1 + 1e-6) and set(parts) == {"big", "small"}
    with pytest.raises(RuntimeError, match="settle"):
        depth.median_regression(d, "y", ["gc", "gc2"], rows=10, passes=1)


def plain_lowess(x, y, frac, again):
    n = len(x)
    k, robust = min(n, max(2, int(frac * n + 1e-10))), np.ones(n)
    for turn in range(again + 1):
        out = np.empty(n)
        for i in range(n):
            near = np.argsort(np.abs(x - x[i]), kind="stable")[:k]
            far = np.abs(x[near] - x[i]) / np.abs(x[near] - x[i]).max()
            w = np.where(far <= 0.001, 1, np.where(far >= 0.999, 0, (1 - far**3) ** 3)) * robust[near]
            a = np.stack([np.ones(k), x[near] - x[i]], 1) * np.sqrt(w)[:, None]
            out[i] = np.linalg.lstsq(a, y[near] * np.sqrt(w), rcond=None)[0][0]
        far = np.abs(y - out) / (6 * np.median(np.abs(y - out)))
        robust = np.where(far <= 0.001, 1, np.where(far >= 0.999, 0, (1 - far**2) ** 2))
    return out


@pytest.mark.parametrize("n, frac", [(40, 0.3), (300, 0.1), (1500, 0.03)])
def test_lowess_equals_plain_fits(n, frac):
    rng = np.random.default_rng(n)
    x = np.sort(rng.uniform(0, 1, n))
    y = np.sin(6 * x) + rng.standard_t(2, n) * 0.2
    assert np.allclose(depth.lowess(x, y, frac, cells=5000), plain_lowess(x, y, frac, 3), atol=1e-8)


def test_lowess_reproduces_lines_and_constants():
    x = np.linspace(0, 1, 300)
    assert np.allclose(depth.lowess(x, 3 * x + 1, 0.3), 3 * x + 1, atol=1e-6)
    assert np.allclose(depth.lowess(x, np.full(300, 2.0), 0.1), 2.0)
    assert np.allclose(depth.along(np.array([-1, 0.5, 4]), np.array([0.0, 1, 2]), np.array([0.0, 2, 3])), [-2, 1, 5])


def test_draws_are_bounded_and_repeat(spark):
    d = spark.range(5000).select(F.when(F.col("id") < 30, "few").otherwise("many").alias("sample_id"), "id")
    one, two = ({r["id"] for r in depth.drawn(d.repartition(n), "sample_id", ["id"], 200, 7).collect()} for n in (2, 5))
    assert one == two and sum(i < 30 for i in one) == 30 and sum(i >= 30 for i in one) == 200
    assert depth.drawn(d, "sample_id", ["id"], None, 7).count() == 5000


def test_mid_ranks_and_numbers_of_complete_rows(spark):
    rng = np.random.default_rng(1)
    v = np.round(rng.normal(0, 3, 800)).tolist()
    d = spark.createDataFrame([("s" if i % 3 else "t", float(x)) for i, x in enumerate(v)], "s string, v double")
    for r in depth.mid_ranks(d, "s", "v", "rank", 9).distinct().collect():
        own = [x for i, x in enumerate(v) if ("s" if i % 3 else "t") == r["s"]]
        assert r["rank"] == sum(x < r["v"] for x in own) + (sum(x == r["v"] for x in own) + 1) / 2
    rows = spark.createDataFrame([(f"chr{c}", i, s, None if (c, i, s) == (1, 2, "a") else 1.0) for c in (1, 2) for i in range(4) for s in "ab"], "chrom string, start int, sample_id string, depth double")
    got = {(r["chrom"], r["start"]): r["new_id"] for r in depth.complete_rows(rows, ["chrom", "start"], ["depth"], ["chrom", "start"]).collect()}
    assert got == {("chr1", 0): 0, ("chr1", 1): 1, ("chr1", 3): 2, ("chr2", 0): 3, ("chr2", 1): 4, ("chr2", 2): 5, ("chr2", 3): 6}


def test_no_cache_is_left(spark):
    rows = [("chr1", i * 10, i * 10 + 10, "s", 0.2 + 0.6 * (i % 97) / 97, float(100 + i % 7)) for i in range(300)]
    d = spark.createDataFrame(rows, "chrom string, start long, stop long, sample_id string, gc double, depth double")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    depth.corrected_by_regression(d).count(), depth.corrected_by_lowess(d).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    d.persist().count()
    depth.corrected_by_lowess(d)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before + 1
    d.unpersist()


def test_corrections_keep_the_median_and_flatten_the_bias(spark):
    rows = [("chr1", i * 10, i * 10 + 10, "s", 0.2 + 0.6 * (i % 97) / 97, (1 + (i % 97) / 97) * (100 + i % 5)) for i in range(900)] + [("chr1", 99990, 100000, "s", 0.5, 0.0)]
    d = spark.createDataFrame([tuple(map(lambda v: v, r)) for r in rows], "chrom string, start long, stop long, sample_id string, gc double, depth double")
    for fix in (depth.corrected_by_regression, depth.corrected_by_lowess):
        out = fix(d).toPandas()
        good = out[out.depth > 0]
        assert abs(good.corrected.median() / good.depth.median() - 1) < 1e-6
        assert good.corrected.std() < 0.25 * good.depth.std()
        assert out[out.depth == 0].corrected.isna().all()


def test_half_even_rounding_of_barcode_share(spark):
    x = spark.createDataFrame([("f", f"b{i}", 1) for i in range(2)] + [("g", "b0", 1)], "feature_id string, barcode string, value long")
    assert {r["feature_id"] for r in features.widely_expressed(x, 10, 0.25).collect()} == {"f"}  # 2.5 rounds to 2


def test_samples_are_checked(spark):
    cols = "SAMPLE string, REP_ID string, assay_type string, sample_type string, PATH_to_bam string"
    good = spark.createDataFrame([("s", "r", "scRNA", "tumor", "x"), ("s", "r", "scATAC", "tumor", "y")], cols)
    assert validate_samples(good, "single_cell_genotyping").count() == 2
    for bad, mode in ((good.drop("REP_ID"), "single_cell_genotyping"), (good, "bulk_genotyping"), (spark.createDataFrame([("s", "r", "what", "t", "x")], cols), "bulk_genotyping"), (good.unionAll(good), "single_cell_genotyping")):
        with pytest.raises(ValueError):
            validate_samples(bad, mode)


def test_lists_orders_and_closed_sets(spark):
    x = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "barcode string, v long")
    order = spark.createDataFrame([("c", 0), ("a", 1)], "barcode string, row_id long")
    assert [tuple(r) for r in features.listed(x, order).collect()] == [("c", 3), ("a", 1)]
    with pytest.raises(Exception, match="no row for barcode z"):
        features.listed(x, order.unionByName(spark.createDataFrame([("z", 2)], order.schema))).collect()
    cells = spark.createDataFrame([("a", "r1"), ("b", "r2")], "barcode string, rep_id string")
    reps = spark.createDataFrame([("r2", 0), ("r1", 1)], "rep_id string, rep_index int")
    assert {(r["barcode"], r["rep_index"]) for r in features.replicate_index(cells, reps).collect()} == {("a", 1), ("b", 0)}
    with pytest.raises(Exception, match="unknown replicate r1"):
        features.replicate_index(cells, reps.where("rep_id = 'r2'")).collect()
    w = spark.createDataFrame([("chr10", 5), ("chr2", 9), ("chr2", 1)], "chrom string, start long")
    assert [tuple(r) for r in intervals.in_order(w).collect()] == [("chr2", 1), ("chr2", 9), ("chr10", 5)]
    assert [tuple(r) for r in intervals.in_order(w, True).collect()] == [("chr10", 5), ("chr2", 1), ("chr2", 9)]
    sizes = spark.createDataFrame([("chr2", 100), ("chrUn", 5)], "chrom string, size long")
    assert standard(w, sizes).select("chrom").distinct().collect() == [("chr2",)]


def test_pileup_filters(spark):
    rows = [("chr1", 5, "c1", k, "A" if k < 3 else "C", "A", "C") for k in range(4)] + [("chr1", 9, "c1", k, "A", "A", "C") for k in range(4)] + [("chr1", 11, "c1", 1, "C", "A", "C")]
    d = spark.createDataFrame(rows, "chrom string, pos0 long, barcode string, umi long, base string, ref string, alt string")
    assert {r["pos0"] for r in counts.pileup(d).collect()} == {5, 9, 11}
    assert {r["pos0"] for r in counts.pileup(d, min_count=2).collect()} == {5, 9}
    assert {r["pos0"] for r in counts.pileup(d, min_count=2, min_maf=0.2).collect()} == {5}
