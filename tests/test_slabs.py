"""Runs of SNPs over slabs of positions."""

import random

from locuslake.operators import binning

def test_runs_go_on_over_slabs(spark, monkeypatch):
    monkeypatch.setattr(binning, "SLAB", 100)
    draw = random.Random(5)
    rows = [(g, p) for g, n in ((None, 37), ("a", 5), ("b", 61), ("c", 2)) for p in draw.sample(range(1000), n)]
    d = binning.by_number(spark.createDataFrame(rows, "region_id string, pos0 long"), ["region_id"], ["pos0"], 7)
    got = {(r["region_id"], r["pos0"]): r["local_bin"] for r in d.collect()}
    want = {}
    for g in {g for g, _ in rows}:
        at = sorted(p for x, p in rows if x == g)
        want |= {(g, p): min(i // 7, max(len(at) // 7 - 1, 0)) for i, p in enumerate(at)}
    assert got == want


def test_no_window_holds_a_whole_group(spark):
    d = binning.by_number(spark.createDataFrame([("a", 5)], "region_id string, pos0 long"), ["region_id"], ["pos0"], 7)
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    rows = [line for line in plan.splitlines() if "Window [row_number" in line]
    assert rows and all("_slab" in line.split("], [")[1] for line in rows), plan
    assert "Window [count" not in plan


def test_numbers_without_a_sort_of_all_rows(spark):
    d = spark.createDataFrame([("x", 2, 5, 0), ("x", 2, 9, 1), ("y", 1, 7, 0)], "g string, chrom_ord int, pos0 long, local_bin long")
    out = binning.numbered(d, ["g"], ["chrom_ord", "pos0"])
    assert {(r["g"], r["pos0"], r["bin_id"]) for r in out.collect()} == {("y", 7, 0), ("x", 5, 1), ("x", 9, 2)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the struct of `order` is least among groups only, after the rows' own least
    assert plan.index("min(struct") < plan.index("min(pos0")
