"""Read depth: statistics, weighted means, ratios, outliers, and correction for GC, mappability and replication timing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake.operators.intervals import numbered_on
from locuslake.operators.quantiles import median, quantiles
from locuslake.plans.tables import stored


def statistics(depth: DataFrame) -> DataFrame:
    """(sample_id, chrom, mean_depth, median_depth) by chromosome and over all as TOTAL."""
    d = stored(depth.select("sample_id", "chrom", "depth"), "depths")  # read several times below
    each, whole, n = d, d.withColumn("chrom", F.lit("TOTAL")), d.count()
    mean = lambda x: x.groupBy("sample_id", "chrom").agg(F.avg("depth").alias("mean_depth"))
    return mean(each).unionByName(mean(whole)).join(median(each, ["sample_id", "chrom"], "depth", "median_depth", n).unionByName(median(whole, ["sample_id", "chrom"], "depth", "median_depth", n)), ["sample_id", "chrom"])


def weighted(depth: DataFrame, by: list[str]) -> DataFrame:
    """Length-weighted mean depth, missing depths left out."""
    size = F.when(F.col("depth").isNotNull(), F.col("stop") - F.col("start"))
    return depth.groupBy(*by).agg((F.sum(F.col("depth") * size) / F.sum(size)).alias("depth"))


def ratio_to_normal(bins: DataFrame, windows: DataFrame, normal: str, bin_id: str = "bin_id") -> DataFrame:
    """bins (bin_id, sample_id, depth) of tumour samples with rdr = depth / normal depth x normal total / sample total.

    Totals are the bases of the windows (sample_id, start, stop, depth): depth times length, missing depths left out. Over a
    normal depth of 0 a positive depth is infinite and one of 0 null.
    """
    totals = windows.groupBy("sample_id").agg(F.sum(F.col("depth") * (F.col("stop") - F.col("start"))).alias("_total"))
    base = bins.where(F.col("sample_id") == normal).select(bin_id, F.col("depth").alias("_normal"))
    whole = totals.where(F.col("sample_id") == normal).select(F.col("_total").alias("_all"))
    d = bins.where(F.col("sample_id") != normal).join(base, bin_id, "left").join(totals, "sample_id").join(F.broadcast(whole), how="cross")  # one row
    ratio = F.when(F.col("_normal") > 0, F.col("depth") / F.col("_normal") * (F.col("_all") / F.col("_total"))).when((F.col("_normal") == 0) & (F.col("depth") > 0), F.lit(float("inf")))
    return d.withColumn("rdr", ratio).drop("_normal", "_total", "_all")


def ratio_to_median(bins: DataFrame) -> DataFrame:
    """With rdr = depth over the sample's median of positive finite depths; null where the depth is none of these."""
    positive = (F.col("depth") > 0) & (F.col("depth") < F.lit(float("inf")))
    mid = median(bins.where(positive), ["sample_id"], "depth", "_m")
    return bins.join(mid, "sample_id", "left").withColumn("rdr", F.when(positive, F.col("depth") / F.col("_m"))).drop("_m")


def without_outliers(bins: DataFrame, share: float, value: str = "rdr") -> DataFrame:
    """Values above the 1 - share quantile over all samples become null; infinite ones are null before."""
    fine = bins.withColumn(value, F.when(F.abs(value) < F.lit(float("inf")), F.col(value)))
    cut = quantiles(fine, [], {"_q": (value, 1 - share)})
    return fine.join(F.broadcast(cut), how="cross").withColumn(value, F.when(F.col(value) <= F.col("_q"), F.col(value))).drop("_q")  # one row


def with_windows(depth: DataFrame, windows: DataFrame) -> DataFrame:
    """Depths (chrom, start, stop, ...) with the columns of the equal window, null where there is none."""
    more = [c for c in windows.columns if c not in depth.columns]
    return depth.join(windows.select("chrom", "start", "stop", *more), ["chrom", "start", "stop"], "left")


def complete_rows(values: DataFrame, row: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """Rows (all samples of a row) none of whose columns is null, with their new dense number new_id.

    Rows are numbered within each value of the first of `order` (the chromosome), and these counted on, so that no task
    numbers them all.
    """
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    per = values.groupBy(*row).agg(F.bool_or(bad).alias("_bad")).where("not _bad").drop("_bad")
    return values.join(numbered_on(per, order[0], order[1:] or order[:1], "new_id"), row)


def mid_ranks(d: DataFrame, part: str, value: str, out: str, cuts: int = 64) -> DataFrame:
    """With `out`, the rank of `value` within `part`, the mean one where values are equal: ranks within ranges between
    quantiles, counted on over the ranges, so that no task ranks a whole part."""
    points = d.groupBy(part).agg(F.array_distinct(F.percentile_approx(value, [(k + 1) / cuts for k in range(cuts - 1)], 100 * cuts)).alias("_cuts"))
    x = d.join(points, part).withColumn("_range", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")
    sizes = x.groupBy(part, "_range").agg(F.count("*").alias("_c"))
    ahead = sizes.select(part, "_range", F.coalesce(F.sum("_c").over(W.partitionBy(part).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    w = W.partitionBy(part, "_range")
    same = F.count("*").over(W.partitionBy(part, "_range", value))
    return x.join(ahead, [part, "_range"]).withColumn(out, F.col("_ahead") + F.rank().over(w.orderBy(value)) + (same - 1) / 2).drop("_range", "_ahead")


def gc_statistics(d: DataFrame, bins: int = 100) -> DataFrame:
    """(sample_id, pearson, spearman, bin_std) of depth against gc: correlations, and the spread of medians of depth by GC bin."""
    both = stored(d.where("depth is not null and gc is not null").select("sample_id", "gc", "depth"), "panel")
    ranked = mid_ranks(mid_ranks(both, "sample_id", "depth", "_rd"), "sample_id", "gc", "_rg")
    cors = ranked.groupBy("sample_id").agg(F.corr("gc", "depth").alias("pearson"), F.corr("_rg", "_rd").alias("spearman"))
    at = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(F.col("gc") * bins)))
    mids = median(both.withColumn("_g", at), ["sample_id", "_g"], "depth", "_m", both.count()).groupBy("sample_id").agg(F.stddev_pop("_m").alias("bin_std"))
    return cors.join(mids, "sample_id")


def domain(d: DataFrame, column: str, outer: float = 0.001, rows: int | None = None) -> DataFrame:
    """(sample_id, low, high): the quantiles `outer` and 1 - outer of a covariate, the ends of what a fit looks at."""
    return quantiles(d, ["sample_id"], {"low": (column, outer), "high": (column, 1 - outer)}, rows=rows)


def panel_statistics(d: DataFrame, x: str, y: str) -> DataFrame:
    """(sample_id, mad, pearson, spearman) of a scatter panel: median distance of y to its median, and the correlations of x and y."""
    both = stored(d.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select("sample_id", F.col(x).alias("_x"), F.col(y).alias("_y")), "panel")
    ranked = mid_ranks(mid_ranks(both, "sample_id", "_x", "_rx"), "sample_id", "_y", "_ry")
    cors = ranked.groupBy("sample_id").agg(F.corr("_x", "_y").alias("pearson"), F.corr("_rx", "_ry").alias("spearman"))
    far = spread(both.select("sample_id", F.col("_y").alias("depth"))).select("sample_id", "mad")
    return far.join(cors, "sample_id")


def histogram(d: DataFrame, value: str, bins: int, low: float, high: float) -> DataFrame:
    """(sample_id, bin, n) of values in [low, high]; the upper end falls in the last bin."""
    at = F.least(F.floor((F.col(value) - low) / ((high - low) / bins)), F.lit(bins - 1))
    return d.where(F.col(value).between(low, high)).groupBy("sample_id", at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def depth_histogram(d: DataFrame, bins: int = 50, share: float = 0.99) -> DataFrame:
    """Histogram of each sample's depths up to its `share` quantile, in bins of equal width from 0."""
    d = stored(d.select("sample_id", "depth"), "depths")
    top = quantiles(d, ["sample_id"], {"_top": ("depth", share)}, rows=d.count()).where("_top > 0")
    at = F.least(F.floor(F.col("depth") / (F.col("_top") / bins)), F.lit(bins - 1))
    return d.join(top, "sample_id").where(F.col("depth") <= F.col("_top")).groupBy("sample_id", at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def spread(d: DataFrame) -> DataFrame:
    """(sample_id, middle, mad): median depth and median distance to it."""
    d = stored(d.select("sample_id", "depth"), "depths")
    n = d.count()
    mid = stored(median(d, ["sample_id"], "depth", "middle", n), "middles")
    return median(d.join(mid, "sample_id"), ["sample_id", "middle"], F.abs(F.col("depth") - F.col("middle")), "mad", n)


def limits(d: DataFrame, value: str, share: float = 0.99) -> DataFrame:
    return quantiles(d, ["sample_id"], {"limit": (value, share)})


# ---- correction ----------------------------------------------------------------------------------


def _fixed(small: DataFrame) -> DataFrame:
    """A row for each sample, worked out now: plans that use it again don't run it again."""
    return F.broadcast(small.sparkSession.createDataFrame(small.collect(), small.schema))


def _rescaled(d: DataFrame, before: str, after: str, rows: int | None = None) -> DataFrame:
    """`after` scaled so that its median is that of `before` over the rows where it is known."""
    mids = quantiles(d.where(F.col(after).isNotNull() & (F.col(before) > 0)), ["sample_id"], {"_b": (before, 0.5), "_a": (after, 0.5)}, rows=rows)
    return d.join(_fixed(mids.select("sample_id", (F.col("_b") / F.col("_a")).alias("_k"))), "sample_id", "left").withColumn(after, F.col(after) * F.col("_k")).drop("_k")


def _least_absolute(x: np.ndarray, y: np.ndarray, pull: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """b that minimises sum |y - x b| + pull . b, by reweighted least squares whose smoothing shrinks as it settles."""
    centre, scale = np.zeros(x.shape[1]), np.maximum(np.sqrt((x**2).mean(axis=0)), 1e-300)
    z, pull = x / scale, pull / scale
    unit = max(float(np.median(np.abs(y))), 1e-300)
    b, eps = centre, unit
    loss = np.inf
    for _ in range(rounds):
        weight = 1 / np.maximum(np.abs(y - z @ b), eps)
        b = np.linalg.lstsq((z * weight[:, None]).T @ z, z.T @ (weight * y) - pull, rcond=None)[0]
        now = float(np.abs(y - z @ b).sum() + pull @ b)
        if loss - now < 1e-7 * max(abs(now), 1e-300):
            if eps <= 1e-7 * unit:
                return b / scale
            eps /= 4
        loss = min(loss, now)
    raise RuntimeError(f"the median regression did not settle in {rounds} rounds")


def median_regression(d: DataFrame, value: str, terms: list[str], rows: int = 200_000, passes: int = 20, seed: int = 42, least: int = 1) -> dict[str, np.ndarray]:
    """Coefficients by sample of value ~ 1 + terms at the median, over all rows.

    A sample of up to `rows` rows is fitted in one task. Of a larger one, a fit on `rows` rows of smallest hash says which
    residuals are near 0; only those rows meet in a task, while each row beyond the band adds its sign times its terms to a
    sum (a linear pull on the coefficients). If a pass over the table finds that no row beyond the band changed its
    side, the fit is that of all rows; else the band grows. It is an error if that does not settle in `passes`. Samples of
    fewer than `least` rows are left out.
    """
    names = ["_one", *terms]
    k = len(names)
    base = d.withColumn("_one", F.lit(1.0)).select("sample_id", F.col(value).cast("double").alias("_y"), *[F.col(n).cast("double").alias(n) for n in names])
    base = base.withColumn("_u", F.pmod(F.xxhash64(F.lit(seed), "_y", *terms, F.monotonically_increasing_id()), F.lit(1 << 40)) / F.lit(float(1 << 40))).cache()
    schema = "sample_id string, b array<double>, width double"

    def solved(part: DataFrame, shares: dict[str, float], pulls: dict[str, list[float]]) -> dict[str, tuple[np.ndarray, float]]:
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            name = pdf["sample_id"].iloc[0]
            x, y = pdf[names].to_numpy(float), pdf["_y"].to_numpy(float)
            b = _least_absolute(x, y, np.asarray(pulls.get(name, [0.0] * k)))
            return pd.DataFrame({"sample_id": [name], "b": [b.tolist()], "width": [float(np.quantile(np.abs(y - x @ b), min(1.0, shares.get(name, 1.0))))]})

        return {r["sample_id"]: (np.array(r["b"]), r["width"]) for r in part.groupBy("sample_id").applyInPandas(run, schema).collect()}  # a row for each sample

    try:
        counts = {r[0]: r[1] for r in base.groupBy("sample_id").count().collect() if r[1] >= least}
        share = {s: rows / n for s, n in counts.items()}
        known = d.sparkSession.createDataFrame(list(share.items()), "sample_id string, _share double") if share else None
        if known is None:
            return {}
        fits = solved(base.join(F.broadcast(known), "sample_id").where(F.col("_u") < F.col("_share")), share, {})
        done = {s: fits[s][0] for s in counts if counts[s] <= rows}
        open_ = {s: fits[s] for s in counts if s not in done and s in fits}
        for _ in range(passes):
            if not open_:
                return done
            at = d.sparkSession.createDataFrame([(s, b.tolist(), w) for s, (b, w) in open_.items()], "sample_id string, _b array<double>, _w double")
            far = base.join(F.broadcast(at), "sample_id").withColumn("_r", F.col("_y") - sum((F.col(n) * F.get("_b", F.lit(i)) for i, n in enumerate(names)), F.lit(0.0)))
            beyond = F.abs("_r") > F.col("_w")
            sums = far.where(beyond).groupBy("sample_id").agg(*[F.sum(-F.signum("_r") * F.col(n)).alias(n) for n in names]).collect()
            pulls = {r["sample_id"]: [float(r[n]) for n in names] for r in sums}
            new = solved(far.where(~beyond), {}, pulls)
            after = d.sparkSession.createDataFrame([(s, b.tolist()) for s, (b, _) in new.items()], "sample_id string, _n array<double>")
            side = F.signum(F.col("_y") - sum((F.col(n) * F.get("_n", F.lit(i)) for i, n in enumerate(names)), F.lit(0.0)))
            crossed = {r[0] for r in far.where(beyond).join(F.broadcast(after), "sample_id").where(side != F.signum("_r")).select("sample_id").distinct().collect()}
            done |= {s: new[s][0] for s in open_ if s not in crossed}
            open_ = {s: (new[s][0], 2 * w) for s, (_, w) in open_.items() if s in crossed}
        raise RuntimeError(f"the median regression did not settle in {passes} passes")
    finally:
        base.unpersist()


def corrected_by_regression(d: DataFrame, doutlier: float = 0.001, min_mappability: float = 0.9, eps_quantile: float = 0.01, value: str = "depth") -> DataFrame:
    """d (sample_id, gc, depth; optional map, repli) with `corrected`: depth over its median regression on GC and GC squared.

    With repli, its first and second power join; map filters windows. Predictions stop at the eps quantile of the positive
    ones; the sample's median is kept. Windows without depth or under the mappability are null.
    """
    d = stored(d, "depths")  # its samples' few numbers take several passes
    rows = d.count()
    names = ["gc", "gc2"] + (["repli", "repli2"] if "repli" in d.columns else [])
    x = d.withColumn("gc2", F.col("gc") * F.col("gc"))
    if "repli" in d.columns:
        x = x.withColumn("repli2", F.col("repli") * F.col("repli"))
    ends = _fixed(domain(x, "gc", doutlier, rows).withColumnsRenamed({"low": "_lo", "high": "_hi"}))
    fit = x.join(ends, "sample_id").where((F.col(value) > 0) & F.col("gc").between(F.col("_lo"), F.col("_hi")))
    if "map" in d.columns:
        fit = fit.where(F.col("map") >= min_mappability)
    if "repli" in d.columns:
        fit = fit.where("repli is not null")
    beta = median_regression(fit, value, names, least=10)
    known = d.sparkSession.createDataFrame([(s, list(map(float, b))) for s, b in beta.items()], "sample_id string, _b array<double>")
    x = x.join(F.broadcast(known), "sample_id", "left")  # a row for each sample
    x = x.withColumn("_p", F.get("_b", F.lit(0)) + sum((F.coalesce(F.col(n), F.lit(0.0) if n.startswith("repli") else F.col(n)) * F.get("_b", F.lit(i + 1)) for i, n in enumerate(names)), F.lit(0.0)))
    eps = _fixed(quantiles(x.where("_p > 0"), ["sample_id"], {"_eps": ("_p", eps_quantile)}, rows=rows))
    x = x.join(eps, "sample_id", "left").withColumn("_eps", F.coalesce("_eps", F.lit(1.0)))
    good = F.col(value) > 0
    if "map" in d.columns:
        good = good & ~F.coalesce(F.col("map") < min_mappability, F.lit(False))
    x = x.withColumn("corrected", F.when(good, F.col(value) / F.greatest(F.coalesce("_p", "_eps"), F.col("_eps"))))
    out = _rescaled(x, value, "corrected", rows).withColumn("corrected", F.when(F.col("_b").isNotNull(), F.col("corrected")).otherwise(F.col(value).cast("double")))
    return out.select(*d.columns, "corrected")


#: Fixed values of the smoother: reweightings, the ends of the tricube and bisquare weights, and the spread of x under which a window is level.
REWEIGHTINGS, NEAR, FAR, LEVEL = 3, 0.001, 0.999, 0.001


def lowess(x: np.ndarray, y: np.ndarray, frac: float, reweightings: int = REWEIGHTINGS, cells: int = 200_000) -> np.ndarray:
    """The fitted value at each of the rising x: lines through the frac n nearest points with tricube weights, and
    bisquare weights of the residuals `reweightings` times (Cleveland 1979). Points are worked on `cells` numbers at a time."""
    n = len(x)
    k = min(n, max(2, int(frac * n + 1e-10)))
    left = np.searchsorted((x[: n - k] + x[k:]) / 2, x, side="left")  # a window moves on while the point beyond is nearer than its first
    radius = np.maximum(x - x[left], x[left + k - 1] - x)
    robust, out = np.ones(n), np.empty(n)
    step = max(1, cells // k)
    for turn in range(reweightings + 1):
        for a in range(0, n, step):
            at = left[a : a + step, None] + np.arange(k)
            xs, here, r = x[at], x[a : a + step, None], np.maximum(radius[a : a + step, None], 1e-300)
            far = np.abs(xs - here) / r
            w = np.where(far <= NEAR, 1.0, np.where(far >= FAR, 0.0, (1 - np.minimum(far, 1) ** 3) ** 3)) * robust[at]
            total = w.sum(axis=1, keepdims=True)
            w = w / np.where(total > 0, total, 1)
            middle = (w * xs).sum(axis=1, keepdims=True)
            spread = (w * (xs - middle) ** 2).sum(axis=1, keepdims=True)
            slope = np.where(np.sqrt(spread) > LEVEL * (x[-1] - x[0]), (here - middle) / np.where(spread > 0, spread, 1), 0.0)
            fit = (w * (1 + slope * (xs - middle)) * y[at]).sum(axis=1)
            out[a : a + step] = np.where(total[:, 0] > 0, fit, y[a : a + step])
        if turn < reweightings:
            rest = np.abs(y - out)
            middle = np.median(rest)
            far = rest / (6 * middle) if middle > 0 else (rest > 0).astype(float)
            robust = np.where(far <= NEAR, 1.0, np.where(far >= FAR, 0.0, (1 - np.minimum(far, 1) ** 2) ** 2))
    return out


def along(at: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Linear interpolation between rising x, carried on beyond their ends."""
    k = np.clip(np.searchsorted(x, at, side="right") - 1, 0, len(x) - 2)
    return y[k] + (y[k + 1] - y[k]) * (at - x[k]) / (x[k + 1] - x[k])


def _curve(x: np.ndarray, y: np.ndarray, grid: np.ndarray, tight: float, smooth: float) -> np.ndarray:
    """A tight fit on mean y by distinct x, smoothed over the grid."""
    ux, inverse = np.unique(x, return_inverse=True)
    uy = np.bincount(inverse, y) / np.bincount(inverse)
    return lowess(grid, along(grid, ux, lowess(ux, uy, tight)), smooth)


def drawn(rows: DataFrame, part: str, keys: list[str], most: int | None, seed: int) -> DataFrame:
    """At most `most` rows of each part, those of smallest hash of the keys; all of them where `most` is None.

    A cut on the hash leaves few more than that, so that no task orders a whole part.
    """
    if most is None:
        return rows
    h = rows.withColumn("_h", F.xxhash64(F.lit(seed), *keys))
    sizes = h.groupBy(part).agg(F.count("*").alias("_c"))
    unit = F.pmod("_h", F.lit(1 << 40)) / F.lit(float(1 << 40))
    h = h.join(F.broadcast(sizes), part).where(unit * F.col("_c") <= most + 10 * F.sqrt(F.lit(float(most))) + 50)  # a row for each sample
    order = W.partitionBy(part).orderBy(F.pmod("_h", F.lit(1 << 40)), *keys)
    return h.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).drop("_n", "_h", "_c")


def lowess_stage(d: DataFrame, value: str, covariate: str, out: str, low_high: tuple[float, float] | None = None, sample: int | None = 50_000, routlier: float = 0.01, doutlier: float = 0.001, tight: float = 0.03, smooth: float = 0.3, grid: int = 1001, seed: int = 42, ideal=None, rows: int | None = None) -> DataFrame:
    """`out` = value over its LOWESS curve on the covariate, by sample, with the sample's median kept.

    The curve is fitted on at most `sample` ideal windows of each sample, those of smallest hash (None: on all), and
    comes back as `grid` points, a row for each sample; prediction joins each value with the two grid points around it, in
    Spark.
    """
    valid = (F.col(value) > 0) & F.col(covariate).isNotNull()
    ends = _fixed(quantiles(d, ["sample_id"], {"_lo": (covariate, doutlier), "_hi": (covariate, 1 - doutlier), "_top": (F.when(valid, F.col(value)), 1 - routlier)}, rows=rows))
    fit = d.join(ends, "sample_id").where(valid & F.col(covariate).between(F.col("_lo"), F.col("_hi")) & (F.col(value) <= F.col("_top")))
    if ideal is not None:
        fit = fit.where(ideal)
    picked = drawn(fit.select("sample_id", "chrom", "start", F.col(covariate).cast("double").alias("x"), F.col(value).cast("double").alias("y"), "_lo", "_hi"), "sample_id", ["chrom", "start"], sample, seed)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = low_high or (pdf["_lo"].iloc[0], pdf["_hi"].iloc[0])
        points = np.linspace(lo, hi, grid)
        if len(pdf) < 10 or pdf["x"].nunique() < 2 or hi <= lo:
            return pd.DataFrame({c: [] for c in ("sample_id", "lo", "step", "curve")}, dtype=object)
        pdf = pdf.sort_values(["x", "y"])  # sums in one order
        return pd.DataFrame({"sample_id": [pdf["sample_id"].iloc[0]], "lo": [lo], "step": [(hi - lo) / (grid - 1)], "curve": [_curve(pdf["x"].to_numpy(), pdf["y"].to_numpy(), points, tight, smooth).tolist()]})

    curves = picked.groupBy("sample_id").applyInPandas(run, "sample_id string, lo double, step double, curve array<double>")
    x = d.join(_fixed(curves), "sample_id", "left")
    at = (F.col(covariate) - F.col("lo")) / F.col("step")
    k = F.greatest(F.lit(0), F.least(F.lit(grid - 2), F.floor(at))).cast("int")
    a, b = F.get("curve", k), F.get("curve", k + 1)
    x = x.withColumn("_p", a + (b - a) * (at - k))
    x = x.withColumn(out, F.when(F.col("curve").isNull(), F.col(value).cast("double")).when((F.col("_p") > 0) & (F.col(value) > 0), F.col(value) / F.col("_p")))
    return _rescaled(x, value, out, rows).select(*d.columns, *([] if out in d.columns else [out]))


def corrected_by_lowess(d: DataFrame, min_mappability: float = 0.9, sample: int | None = 50_000, seed: int = 42, **fit) -> DataFrame:
    """d with `corrected`: LOWESS stages on gc, then map and repli where there are such columns. `fit` goes to each stage."""
    ideal = (F.col("map") >= min_mappability) if "map" in d.columns else None
    d = stored(d, "depths")
    rows = d.count()
    x = lowess_stage(d, "depth", "gc", "corrected", (0.0, 1.0), sample, seed=seed, ideal=ideal, rows=rows, **fit)
    for k, (c, ends) in enumerate((("map", (0.0, 1.0)), ("repli", None)), 1):
        if c in d.columns:
            x = stored(x.withColumnRenamed("corrected", "_before"), "before")
            x = lowess_stage(x, "_before", c, "corrected", ends, sample, seed=seed + k, rows=rows, **fit).drop("_before")
    return x


def rmse(d: DataFrame, value: str, predicted: str) -> DataFrame:
    return d.where((F.col(value) > 0) & F.col(predicted).isNotNull()).groupBy("sample_id").agg(F.sqrt(F.avg(F.pow(F.col(value) - F.col(predicted), 2))).alias("rmse"))


def density(d: DataFrame, x: str, y: str, points: int | None = 20_000, size: int = 200, seed: int = 42) -> DataFrame:
    """(sample_id, i, j, x, y, density): a Gaussian kernel estimate on a size x size grid from at most `points` rows a sample, those of smallest hash (None: from all)."""
    picked = drawn(d.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select("sample_id", F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")), "sample_id", ["x", "y"], points, seed)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n = len(pdf)
        gx, gy = (np.linspace(pdf[c].min(), pdf[c].max(), size) for c in ("x", "y"))
        if n < 3 or gx[0] == gx[-1] or gy[0] == gy[-1]:
            return pd.DataFrame({c: [] for c in ("sample_id", "i", "j", "x", "y", "density")}, dtype=object)
        width = n ** (-1 / 6)  # Scott's rule in two dimensions
        sx, sy = pdf["x"].std() * width, pdf["y"].std() * width
        kx = np.exp(-0.5 * ((gx[:, None] - pdf["x"].to_numpy()) / sx) ** 2)
        ky = np.exp(-0.5 * ((gy[:, None] - pdf["y"].to_numpy()) / sy) ** 2)
        z = kx @ ky.T / (2 * np.pi * sx * sy * n)
        i, j = np.meshgrid(np.arange(size), np.arange(size), indexing="ij")
        return pd.DataFrame({"sample_id": pdf["sample_id"].iloc[0], "i": i.ravel(), "j": j.ravel(), "x": gx[i.ravel()], "y": gy[j.ravel()], "density": z.ravel()})

    return picked.groupBy("sample_id").applyInPandas(run, "sample_id string, i int, j int, x double, y double, density double")


