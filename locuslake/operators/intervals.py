"""Joins and set operations on half-open intervals.

A range join is an equi-join on (chromosome, bucket of positions) with the range as a residual condition: intervals
are exploded over the buckets that they touch. Neither side is broadcast by hand and no chromosome lands in one task;
Spark broadcasts a side it knows to be small. `bucket` should be near the length of the longer intervals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake.schema import sort_chroms

BUCKET = 1 << 16
LISTED = 1 << 14  # positions whose intervals may stand in one list


def _over_buckets(intervals: DataFrame, bucket: int, start: str = "start", stop: str = "stop") -> DataFrame:
    """Each interval once for every bucket it touches; empty intervals touch none."""
    first, last = F.floor(F.col(start) / bucket), F.floor((F.col(stop) - 1) / bucket)
    return intervals.where(F.col(stop) > F.col(start)).withColumn("_b", F.explode(F.sequence(first, last)))


def _renamed(df: DataFrame, prefix: str = "_r_") -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def points_in_intervals(points: DataFrame, intervals: DataFrame, keep: list[str], pos: str = "pos0", how: str = "inner", bucket: int = BUCKET) -> DataFrame:
    """Every (point, interval) with start <= pos < stop; `keep` of the interval's columns.

    how: inner, left, left_semi or left_anti.
    """
    r = _renamed(_over_buckets(intervals.select("chrom", "start", "stop", *[c for c in keep if c not in ("chrom", "start", "stop")]), bucket))
    p = points.withColumn("_b", F.floor(F.col(pos) / bucket))
    on = (p["chrom"] == r["_r_chrom"]) & (p["_b"] == r["_r__b"]) & (p[pos] >= r["_r_start"]) & (p[pos] < r["_r_stop"])
    out = p.join(r, on, how)
    if how in ("left_semi", "left_anti"):
        return out.drop("_b")
    return out.select(*points.columns, *[F.col("_r_" + c).alias(c) for c in keep])


def first_interval(points: DataFrame, intervals: DataFrame, ref_id: str, key: list[str], pos: str = "pos0", bucket: int = BUCKET) -> DataFrame:
    """Each point with the id of the interval that holds it, null if none does; of several the one of smallest (start, stop, id).

    `key` names a point; intervals may overlap. A point meets one list, that of its bucket, and takes the first of it that holds the point. An
    interval within one before it is never first; without these a list has at most two intervals for each position of the bucket, however many overlap.
    """
    bucket = min(bucket, LISTED)
    spread = _over_buckets(intervals.select("chrom", "start", "stop", ref_id), bucket)
    before = W.partitionBy("chrom", "_b").orderBy("start", "stop", ref_id).rowsBetween(W.unboundedPreceding, -1)
    steps = spread.withColumn("_reach", F.max("stop").over(before)).where(F.col("_reach").isNull() | (F.col("stop") > F.col("_reach")))
    lists = steps.groupBy("chrom", "_b").agg(F.array_sort(F.collect_list(F.struct("start", "stop", ref_id))).alias("_list"))
    d = points.drop(ref_id).withColumn("_b", F.floor(F.col(pos) / bucket)).join(lists, ["chrom", "_b"], "left")
    first = F.get(F.filter("_list", lambda x: (x["start"] <= F.col(pos)) & (F.col(pos) < x["stop"])), F.lit(0))[ref_id]
    return d.select(*key, *[c for c in points.columns if c not in (*key, ref_id)], first.alias(ref_id))


def snp_to_region(points: DataFrame, regions: DataFrame, region_id: str = "region_id", bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(points inside a region with its id, regions with n_snps, 0 where none) for disjoint regions."""
    inside = points_in_intervals(points, regions, [region_id], bucket=bucket)
    counts = inside.groupBy(region_id).agg(F.count("*").alias("n_snps"))
    return inside, regions.join(counts, region_id, "left").withColumn("n_snps", F.coalesce("n_snps", F.lit(0)).cast("long"))


def overlaps(a: DataFrame, b: DataFrame, keep: list[str], how: str = "inner", bucket: int = BUCKET) -> DataFrame:
    """Every pair of intervals that share a position, once; columns of a, those of b in `keep` as b_<name>, and `overlap`.

    A pair meets in every bucket that both touch and is kept in that of the larger start.
    """
    x = _over_buckets(a, bucket)
    y = _renamed(_over_buckets(b.select("chrom", "start", "stop", *[c for c in keep if c not in ("chrom", "start", "stop")]), bucket))
    on = (x["chrom"] == y["_r_chrom"]) & (x["_b"] == y["_r__b"]) & (x["start"] < y["_r_stop"]) & (y["_r_start"] < x["stop"]) & (F.floor(F.greatest(x["start"], y["_r_start"]) / bucket) == x["_b"])
    if how in ("left_semi", "left_anti"):
        hit = x.join(y, on, "left_semi").select("chrom", "start", "stop").distinct()
        return a.join(hit, ["chrom", "start", "stop"], how)
    out = x.join(y, on, "inner")
    size = F.least("stop", "_r_stop") - F.greatest("start", "_r_start")
    return out.select(*a.columns, *[F.col("_r_" + c).alias("b_" + c) for c in keep], size.alias("overlap"))


def without_overlap(a: DataFrame, blacklist: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The intervals of a that share no position with the blacklist."""
    return overlaps(a, blacklist, [], "left_anti", bucket)


def largest_overlap(a: DataFrame, b: DataFrame, ref_id: str, key: list[str], bucket: int = BUCKET) -> DataFrame:
    """a with the id of the interval of b that it shares most with; ties go to the smaller start, null without any."""
    best = overlaps(a.select("chrom", "start", "stop", *[k for k in key if k not in ("chrom", "start", "stop")]), b, ["start", ref_id], bucket=bucket)
    best = best.groupBy(*key).agg(F.max(F.struct("overlap", (-F.col("b_start")).alias("s"), F.col("b_" + ref_id).alias("id")))["id"].alias(ref_id))
    return a.drop(ref_id).join(best, key, "left")


def merged(intervals: DataFrame, names: str | None = None) -> DataFrame:
    """Unions of intervals that overlap or touch; `names` gives the sorted distinct names joined by commas, '.' where none."""
    before = W.partitionBy("chrom").orderBy("start", "stop").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("chrom").orderBy("start", "stop").rowsBetween(W.unboundedPreceding, 0)
    d = intervals.where("stop > start").withColumn("_new", F.when(F.col("start") <= F.max("stop").over(before), 0).otherwise(1))
    d = d.withColumn("_island", F.sum("_new").over(upto))
    aggs: list[Column] = [F.min("start").alias("start"), F.max("stop").alias("stop")]
    if names:
        real = F.when(F.col(names).isNotNull() & ~F.col(names).isin("", "."), F.col(names))
        aggs.append(F.array_join(F.array_sort(F.collect_set(real)), ",").alias(names))
    out = d.groupBy("chrom", "_island").agg(*aggs).drop("_island")
    return out.withColumn(names, F.when(F.col(names) == "", ".").otherwise(F.col(names))) if names else out


def subtracted(regions: DataFrame, blacklist: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """What remains of each region without the blacklist: its pieces, with the region's columns."""
    others = [c for c in regions.columns if c not in ("chrom", "start", "stop")]
    holes = overlaps(regions, merged(blacklist), ["start", "stop"], bucket=bucket)
    w = W.partitionBy("chrom", "start", "stop", *others).orderBy("b_start")
    after = holes.withColumn("_next", F.coalesce(F.lead("b_start").over(w), F.col("stop")))
    pieces = after.select("chrom", F.col("b_stop").alias("_a"), F.col("_next").alias("_z"), *others, F.col("start").alias("_s"), F.col("stop").alias("_e"))
    first = holes.groupBy("chrom", "start", "stop", *others).agg(F.min("b_start").alias("_z")).select("chrom", F.col("start").alias("_a"), "_z", *others, F.col("start").alias("_s"), F.col("stop").alias("_e"))
    whole = without_overlap(regions, blacklist, bucket).select("chrom", F.col("start").alias("_a"), F.col("stop").alias("_z"), *others, F.col("start").alias("_s"), F.col("stop").alias("_e"))
    cut = pieces.unionByName(first).withColumn("_a", F.greatest("_a", "_s")).withColumn("_z", F.least("_z", "_e")).where("_z > _a")
    return cut.unionByName(whole).select("chrom", F.col("_a").alias("start"), F.col("_z").alias("stop"), *others)


def mean_over(windows: DataFrame, scores: DataFrame, value: str, out: str, bucket: int = BUCKET) -> DataFrame:
    """windows with the mean value of the intervals that overlap each, 0 without any, held within [0, 1]."""
    hit = overlaps(windows.select("chrom", "start", "stop"), scores, [value], bucket=bucket)
    means = hit.groupBy("chrom", "start", "stop").agg(F.avg("b_" + value).alias(out))
    return windows.drop(out).join(means, ["chrom", "start", "stop"], "left").withColumn(out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(out, F.lit(0.0)))))


def tiled(regions: DataFrame, width: int) -> DataFrame:
    """Windows of `width` over each region; a last one shorter than half is joined to the one before."""
    length = F.col("stop") - F.col("start")
    n = F.ceil(length / width)
    last = length - (n - 1) * width
    n = F.when((n > 1) & (last < width // 2), n - 1).otherwise(n)
    d = regions.where("stop > start").withColumn("_n", n.cast("long")).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    a = F.col("start") + F.col("_i") * width
    z = F.when(F.col("_i") == F.col("_n") - 1, F.col("stop")).otherwise(a + width)
    rest = [c for c in regions.columns if c not in ("chrom", "start", "stop")]
    return d.select("chrom", a.alias("start"), z.alias("stop"), *rest)


def numbered_on(rows: DataFrame, part: str, order: list[str], out: str) -> DataFrame:
    """With `out`: the place of each row from 0 by (part, order), counted within each part and on over the parts."""
    sizes = rows.groupBy(part).agg(F.count("*").alias("_c"))
    ahead = sizes.select(part, F.coalesce(F.sum("_c").over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))  # a row for each part
    return rows.join(ahead, part).withColumn(out, (F.col("_ahead") + F.row_number().over(W.partitionBy(part).orderBy(*order)) - 1).cast("long")).drop("_ahead")


def region_by_midpoint(windows: DataFrame, regions: DataFrame, region_id: str = "region_id", bucket: int = BUCKET) -> DataFrame:
    """windows with the id of the disjoint region that holds their midpoint, null if none does."""
    mid = windows.drop(region_id).withColumn("_mid", F.floor((F.col("start") + F.col("stop")) / 2))
    return points_in_intervals(mid, regions, [region_id], "_mid", "left", bucket).drop("_mid")


def asof_start(points: DataFrame, windows: DataFrame, keep: list[str], pos: str = "pos0", bucket: int = BUCKET) -> DataFrame:
    """Each point with the window of greatest start <= pos, however far its end; points before all windows are left out."""
    nxt = F.lead("start").over(W.partitionBy("chrom").orderBy("start"))
    reach = windows.withColumn("_stop", F.coalesce(nxt, F.lit(None)))
    ends = points.groupBy("chrom").agg((F.max(pos) + 1).alias("_end"))
    reach = reach.join(ends, "chrom").withColumn("_stop", F.coalesce("_stop", F.greatest("_end", F.col("start") + 1))).withColumn("stop", F.col("_stop"))
    if "stop" in keep:
        raise ValueError("stop is the next window's start here")
    return points_in_intervals(points, reach.select("chrom", "start", "stop", *[k for k in keep if k not in ("chrom", "start")]), keep, pos, "inner", bucket)


def signal_by_window(signal: DataFrame, windows: DataFrame, value: str, out: str, bucket: int = BUCKET) -> DataFrame:
    """windows with the mean of the signals whose midpoint falls at or after their start and before the next window's; null without any, rounded to 6 digits."""
    mids = signal.select("chrom", F.floor((F.col("start") + F.col("stop")) / 2).alias("mid"), value)
    hit = asof_start(mids, windows.select("chrom", "start", "stop"), ["start"], "mid", bucket)
    means = hit.groupBy("chrom", "start").agg(F.round(F.avg(value), 6).alias(out))
    return windows.drop(out).join(means, ["chrom", "start"], "left")


def window_depth(reads: DataFrame, windows: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Mean depth of each window and sample from read intervals (chrom, start, stop, sample_id); windows without reads are absent."""
    hit = overlaps(reads, windows, ["start", "stop"], bucket=bucket)
    sums = hit.groupBy("chrom", "b_start", "b_stop", "sample_id").agg(F.sum("overlap").alias("_o"))
    return sums.select("chrom", F.col("b_start").alias("start"), F.col("b_stop").alias("stop"), "sample_id", (F.col("_o") / (F.col("b_stop") - F.col("b_start"))).alias("depth"))


def window_summary(windows: DataFrame) -> DataFrame:
    """(chrom, n, regions, covered, median_size) by chromosome, and over all as TOTAL."""
    size = F.col("stop") - F.col("start")
    return windows.rollup("chrom").agg(F.count("*").alias("n"), F.countDistinct("region_id").alias("regions"), F.sum(size).alias("covered"), F.median(size).alias("median_size")).withColumn("chrom", F.coalesce("chrom", F.lit("TOTAL")))


def gc_fraction(windows: DataFrame, chunks: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """windows with the share of G and C among the bases of sequence chunks (chrom, start, stop, seq) that fall in them.

    Each bucket takes its own piece of a sequence, so that no base is moved twice. Spark takes sequences to be short; the merge hint keeps it from broadcasting them.
    """
    first, last = F.greatest("start", F.col("_b") * bucket), F.least("stop", (F.col("_b") + 1) * bucket)
    own = F.substr("seq", (first - F.col("start") + 1).cast("int"), (last - first).cast("int"))
    pieces = _over_buckets(chunks.select("chrom", "start", "stop", "seq"), bucket).select("chrom", "_b", first.alias("_a"), last.alias("_z"), own.alias("_seq"))
    hit = _over_buckets(windows.select("chrom", "start", "stop").distinct(), bucket).join(pieces.hint("merge"), ["chrom", "_b"]).where((F.col("_a") < F.col("stop")) & (F.col("start") < F.col("_z")))
    a = F.greatest("start", "_a")
    size = F.least("stop", "_z") - a
    part = F.upper(F.substr("_seq", (a - F.col("_a") + 1).cast("int"), size.cast("int")))
    sums = hit.withColumn("_gc", F.length(F.regexp_replace(part, "[^GC]", ""))).groupBy("chrom", "start", "stop").agg(F.sum("_gc").alias("_gc"), F.sum(size).alias("_n"))
    return windows.join(sums, ["chrom", "start", "stop"], "left").withColumn("gc", F.col("_gc") / F.col("_n")).drop("_gc", "_n")


def wgs_windows(regions: DataFrame, blacklist: DataFrame, width: int, bucket: int = BUCKET) -> DataFrame:
    """Windows of whole-genome data: regions less the blacklist, tiled, with the region of their midpoint."""
    return region_by_midpoint(tiled(subtracted(regions, blacklist, bucket).select("chrom", "start", "stop"), width), regions, bucket=bucket)


def wes_windows(targets: DataFrame, regions: DataFrame, blacklist: DataFrame, width: int, bucket: int = BUCKET) -> DataFrame:
    """Windows of exome data: merged targets, tiled, without any that touches the blacklist or lies outside the regions."""
    tiles = tiled(merged(targets, "gene"), width)
    return region_by_midpoint(without_overlap(tiles, blacklist, bucket), regions, bucket=bucket).where("region_id is not null")


def in_order(df: DataFrame, by_name: bool = False) -> DataFrame:
    """Intervals by chromosome and start; by the chromosome's name as text where `by_name`."""
    return df.orderBy("chrom", "start") if by_name else sort_chroms(df, "start")


def unassigned(windows: DataFrame, region_id: str = "region_id", n: int = 30) -> DataFrame:
    """The first `n` windows without a region, for a report."""
    return windows.where(F.col(region_id).isNull()).orderBy("chrom", "start").limit(n)
