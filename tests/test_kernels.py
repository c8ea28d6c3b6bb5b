"""Densities against a plain kernel, matrices of every kind, bulk ratios worked out again, and swept folders."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from locuslake.operators import depth
from locuslake.plans import queries, stages, tables
from locuslake.plans.fixtures import role
from locuslake.sources import readers

D = "/root/testdata/sf0.001"


def test_density_equals_a_plain_kernel(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(0, 2, 150), rng.gamma(2, 1, 150)
    d = spark.createDataFrame([("s", float(a), float(b)) for a, b in zip(x, y, strict=True)] + [("s", None, 1.0), ("few", 1.0, 2.0), ("flat", 1.0, 1.0), ("flat", 1.0, 2.0), ("flat", 1.0, 3.0)], "sample_id string, gc double, depth double")
    got = depth.density(d, "gc", "depth", None, 20).collect()
    assert {r["sample_id"] for r in got} == {"s"} and len(got) == 400
    n, sx, sy = 150, x.std(ddof=1) * 150 ** (-1 / 6), y.std(ddof=1) * 150 ** (-1 / 6)
    for r in got[::7]:
        want = sum(np.exp(-0.5 * (((r["x"] - a) / sx) ** 2 + ((r["y"] - b) / sy) ** 2)) for a, b in zip(x, y, strict=True)) / (2 * np.pi * sx * sy * n)
        assert abs(r["density"] - want) < 1e-12
    assert {(r["i"], r["j"]) for r in got} == {(i, j) for i in range(20) for j in range(20)}
    assert min(r["x"] for r in got) == x.min() and max(r["y"] for r in got) == y.max()


@pytest.mark.parametrize("head, rows, want", [
    ("%%MatrixMarket matrix coordinate integer general", "1 1 5\n3 2 -7", [(0, 0, 5), (2, 1, -7)]),
    ("%%MatrixMarket matrix coordinate real general", "1 1 5\n3 2 2.5e-1", [(0, 0, 5.0), (2, 1, 0.25)]),
    ("%%MatrixMarket matrix coordinate pattern general", "1 1\n3 2", [(0, 0, 1), (2, 1, 1)]),
    ("%%MatrixMarket matrix coordinate real symmetric", "1 1 5\n3 2 2.5", [(0, 0, 5.0), (1, 2, 2.5), (2, 1, 2.5)]),
    ("%%MatrixMarket matrix coordinate integer skew-symmetric", "3 2 4", [(1, 2, -4), (2, 1, 4)]),
])
def test_matrices_of_every_kind(spark, tmp_path, head, rows, want):
    (tmp_path / "m.mtx").write_text(f"{head}\n% a note\n3 3 2\n{rows}\n")
    assert sorted(map(tuple, readers.matrix_market(spark, str(tmp_path / "m.mtx")).collect())) == want
    with pytest.raises(ValueError, match="kind"):
        (tmp_path / "d.mtx").write_text("%%MatrixMarket matrix array real general\n1 1\n1\n")
        readers.matrix_market(spark, str(tmp_path / "d.mtx"))


def test_bulk_ratios_worked_out_again(spark):
    """Corrected depths of the stage, summed by hand into ratios: bases of the normal over those of the sample."""
    x = queries._phased(role(spark, D, "snp_sample"))
    depths = role(spark, D, "depth").select("chrom", "start", "stop", "sample_id", "depth")
    out = stages.bulk(x, role(spark, D, "region"), role(spark, D, "blacklist"), role(spark, D, "win"), depths, role(spark, D, "knot"), "N", queries.BULK, 1 << 20)
    got = {(r["bin_id"], r["sample_id"]): r["rdr"] for r in out["ratios"].collect()}
    placed = {(r["chrom"], r["start"]): r["bin_id"] for r in out["windows"].collect()}
    by: dict = {}
    for r in out["depth"].collect():
        if r["corrected"] is not None:
            by.setdefault((r["chrom"], r["start"]), {})[r["sample_id"]] = (r["corrected"], r["stop"] - r["start"])
    whole = {w: m for w, m in by.items() if len(m) == 3 and w in placed}
    total = {s: sum(m[s][0] * m[s][1] for m in whole.values()) for s in "ANR"}
    assert got and {k[1] for k in got} == {"A", "R"}
    for (bin_id, s), rdr in got.items():
        mine = [m for w, m in whole.items() if placed[w] == bin_id]
        mean = {k: sum(m[k][0] * m[k][1] for m in mine) / sum(m[k][1] for m in mine) for k in (s, "N")}
        assert abs(rdr - mean[s] / mean["N"] * total["N"] / total[s]) < 1e-9
    assert sorted({k[0] for k in got}) == list(range(len({k[0] for k in got}))) == sorted(r["bin_id"] for r in out["bins"].collect())
    assert len({r["stop"] - r["start"] for r in out["depth"].collect()}) > 1  # windows of several lengths


def test_what_stages_store_is_swept(spark):
    d = tables.stored(spark.range(5), "numbers")
    folder = d.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert d.count() == 5 and os.path.isdir(folder)
    assert tables.swept() >= 1 and not os.path.exists(folder) and tables.swept() == 0
