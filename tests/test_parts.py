"""Steps whose tasks hold as much whatever the number of rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from locuslake.operators import binning, counts
from locuslake.operators.quantiles import quantiles
from locuslake.plans import fixtures, tables

D = "/root/testdata/sf0.001"


def _reads(n, seed):
    draw = random.Random(seed)
    return [(f"chr{draw.randint(1, 2)}", p, f"c{draw.randint(0, 3)}", draw.randint(0, 2), draw.choice(["A", "C", "G", None]), "A" if p % 7 else None, "C") for p in (draw.randint(0, 60) for _ in range(n))]


def test_pileup_is_dealt_before_it_is_summed(spark):
    d = spark.createDataFrame(_reads(3000, 1), "chrom string, pos0 long, barcode string, umi long, base string, ref string, alt string")
    out = counts.pileup(d, 5, 0.3, part_rows=200)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and all(", 15)" in line or ", 15," in line for line in exchanges), plan
    assert plan.rindex("HashAggregate") < plan.rindex("Exchange hashpartitioning"), plan  # no task sums a piece of the input


def test_pileup_in_parts_equals_a_plain_loop(spark):
    rows = _reads(3000, 2)
    per = {}
    for chrom, pos0, barcode, _, base, ref, alt in {(c, p, b, u, x, r, a) for c, p, b, u, x, r, a in rows}:
        n = per.setdefault((chrom, pos0, barcode), Counter())
        n["dp"] += base is not None and base in (ref, alt)
        n["ad"] += base is not None and base == alt
        n["oth"] += None not in (base, ref, alt) and base not in (ref, alt)
    site = {}
    for (chrom, pos0, _), n in per.items():
        site[chrom, pos0] = site.get((chrom, pos0), Counter()) + n
    kept = {k for k, n in site.items() if n["dp"] + n["oth"] >= 5 and n["dp"] and min(n["ad"], n["dp"] - n["ad"]) / n["dp"] >= 0.3}
    assert 0 < len(kept) < len(site)
    d = spark.createDataFrame(rows, "chrom string, pos0 long, barcode string, umi long, base string, ref string, alt string")
    for part_rows in (200, 10**6):
        got = {tuple(r)[:3]: tuple(r)[3:] for r in counts.pileup(d, 5, 0.3, part_rows).collect()}
        assert got == {k: (n["dp"], n["ad"], n["oth"]) for k, n in per.items() if k[:2] in kept}
        assert counts.pileup(d, part_rows=part_rows).count() == len(per)
    assert counts.pileup(d.where("false"), 1, 0.1).count() == 0


def test_snps_are_dealt_before_they_are_summed(spark):
    plain, said = fixtures.role(spark, D, "snp"), fixtures.stated(spark, D, "snp")
    assert plain.dtypes == said.dtypes
    assert plain.exceptAll(said).isEmpty() and said.exceptAll(plain).isEmpty() and plain.count() == said.count()
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("HashAggregate") < plan.rindex("Exchange "), plan


@pytest.mark.parametrize("most", [100, 1000])
def test_stored_files_have_bounded_rows(spark, most):
    d = tables.stored(spark.range(0, 2500, 1, 2), "numbers", most)
    sizes = [r["count"] for r in d.selectExpr("_metadata.file_path as f").groupBy("f").count().collect()]
    assert sum(sizes) == 2500 and max(sizes) <= most


def test_bins_are_marked_without_a_join_of_all_rows(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(binning, "PART", 300)
    monkeypatch.setattr(binning, "stored", lambda x, name, f=binning.stored: kept.setdefault(name, f(x, name)))
    d = spark.range(0, 2000).selectExpr("concat('g', id % 2) as grp", "id * 10 as start", "id * 10 + 10 as stop", "1L as n_snps", "id % 7 as s1")
    out = binning.by_reads(d, ["grp"], ["start"], ["s1"], 30, 5, 0, 300, 30, 0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith("FlatMapCoGroupsInPandas"), plan
    jumps = kept["jumps"]
    assert max(r["count"] for r in jumps.groupBy(F.col("_metadata.file_path")).count().collect()) <= 300
    assert 0 < jumps.where("_door").count() < jumps.count() / 2  # where a walk may enter a part
    assert out.count() == 2000


def test_quantiles_do_not_deal_rows_by_group(spark):
    d = spark.range(0, 20_000, 1, 6).selectExpr("id % 2 as g", "cast(xxhash64(id) as double) as x")
    out = quantiles(d, ["g"], {"m": ("x", 0.5)}, 1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan, plan
    assert {r["g"]: r["m"] for r in out.collect()} == {r["g"]: r["m"] for r in d.groupBy("g").agg(F.median("x").alias("m")).collect()}
