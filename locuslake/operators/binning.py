"""Bins of consecutive SNPs or windows, and phase flips.

Bins that close on a count of SNPs alone have a closed form over row numbers. Bins that close on reads or span are a
fold over each group's rows in order (`fold` states it). `by_reads` works it out for parts of bounded size, whatever the groups' sizes: wherever a
bin might start, the start of the next bin is found by search in running sums; following these pointers leads out of the part;
a walk over the few starts at which parts are entered gives the real ones; and each part then marks its bins from there. Local bin numbers become global by the prefix sum of bins over groups, in the order in which
groups first appear.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from locuslake.functions.columns import outside_interval
from locuslake.plans import tables
from locuslake.plans.tables import dropped


SLAB = 1 << 20  # positions whose rows a task may order
PART = 50_000  # rows of a part, and of a file between the steps


def stored(df: DataFrame, name: str) -> DataFrame:
    return tables.stored(df, name, PART)


def by_number(snps: DataFrame, group: list[str], order: list[str], size: int) -> DataFrame:
    """With local_bin: runs of `size` rows of each group; what remains joins the last run.

    Rows are counted within slabs of the first of `order` (a position), and on over the slabs of a group, so that no task orders a whole group. `snps` is read twice.
    """
    slab = F.floor(F.col(order[0]) / SLAB)
    d = snps.withColumn("_slab", slab)
    keys = [*group, "_slab"]
    sizes = d.groupBy(*keys).agg(F.count("*").alias("_c"))
    before = W.partitionBy(*group).orderBy("_slab").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_ahead"), F.sum("_c").over(W.partitionBy(*group)).alias("_n"))  # a row for each slab
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_g{i}"))
    row = F.col("_ahead") + F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
    last = F.greatest(F.floor(F.col("_n") / size) - 1, F.lit(0))
    return d.join(sizes, same).withColumn("local_bin", F.least(F.floor(row / size), last).cast("long")).select(*snps.columns, "local_bin")


def fold(reads: np.ndarray, n_snps: np.ndarray, start: np.ndarray, stop: np.ndarray, least_reads: float, least_snps: int, most_span: int = 0) -> np.ndarray:
    """Bin of each row: a bin closes before a row once all samples have `least_reads` and `least_snps` SNPs are in, or its span is `most_span`.

    A last bin that meets neither joins the one before.
    """
    n = len(n_snps)
    out = np.zeros(n, dtype=np.int64)
    if not n:
        return out
    total, snps = np.cumsum(reads, axis=0), np.cumsum(n_snps)
    first, bin_id = 0, 0

    def full(first: int, end: int) -> bool:
        got = total[end - 1] - (total[first - 1] if first else 0)
        many = snps[end - 1] - (snps[first - 1] if first else 0)
        enough = (least_reads <= 0 or bool((got >= least_reads).all())) and many >= least_snps
        return enough or most_span > 0 and stop[end - 1] - start[first] >= most_span

    for i in range(1, n):
        if full(first, i):
            out[first:i] = bin_id
            first, bin_id = i, bin_id + 1
    out[first:] = bin_id if first and full(first, n) else max(bin_id - 1, 0)
    return out


#: What a pointer says that leads to no bin: the group ends while the bin is open, or with the bin complete; or the rows at hand do.
OPEN, COMPLETE, UNKNOWN = -1, -2, -3


def next_starts(reads: np.ndarray, n_snps: np.ndarray, start: np.ndarray, stop: np.ndarray, ends: bool, least_reads: float, least_snps: int, most_span: int) -> np.ndarray:
    """For each row of a run of one group, if a bin started there: the row that starts the next bin, OPEN or COMPLETE; UNKNOWN where
    the run does not reach that far, unless it `ends` with the group."""
    n = len(n_snps)
    snps = np.cumsum(n_snps)
    # the first row with which a bin from each row has enough: the number of SNPs, and of reads in every sample
    enough = np.maximum(np.searchsorted(snps, snps - n_snps + least_snps), np.arange(n))
    if least_reads > 0:
        for j in range(reads.shape[1]):
            total = np.cumsum(reads[:, j])
            enough = np.maximum(enough, np.searchsorted(total, total - reads[:, j] + least_reads))
    if most_span > 0:
        far = np.searchsorted(np.maximum.accumulate(stop), start + most_span)
        enough = np.minimum(enough, np.maximum(far, np.arange(n)))
    return np.where(enough < n - 1, enough + 1, (np.where(enough == n - 1, COMPLETE, OPEN)) if ends else UNKNOWN)


def by_reads(rows: DataFrame, group: list[str], order: list[str], samples: list[str], least_reads: float, least_snps: int, most_span: int = 0, part_rows: int = PART, halo: int = 5_000, small: int = 1_000_000) -> DataFrame:
    """rows (with n_snps, start, stop and a column of whole-numbered reads for each sample) with local_bin, as `fold` has it.

    A part is `part_rows` rows in the order of groups, and sees `halo` rows more; where a bin would reach beyond these, more are
    taken until none does. Rows that tie in `order` stand in any order. Up to `small` rows in all, which any task can hold, each group is folded as it is.
    Tables between the steps are stored in files of PART rows, so that a task that deals them out takes few parts at once.
    """
    spark = rows.sparkSession
    base = stored(rows.withColumn("_key", F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(group)]))), "rows")
    n = base.count()
    if n <= small:
        out = T.StructType([*rows.schema.fields, T.StructField("local_bin", T.LongType())])

        def folded(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
            pdf["local_bin"] = fold(pdf[samples].to_numpy(float), pdf["n_snps"].to_numpy(np.int64), pdf["start"].to_numpy(np.int64), pdf["stop"].to_numpy(np.int64), least_reads, least_snps, most_span)
            return pdf

        return base.drop("_key").groupBy(*group).applyInPandas(folded, out)
    parts = max(1, -(-n // part_rows))
    ranged = stored(base.repartitionByRange(parts, "_key", *order).sortWithinPartitions("_key", *order).withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33).cast("int")), "ranged")
    dropped(base)
    bounds, at = [], 0
    for r in ranged.groupBy("_part").count().orderBy("_part").collect():  # a row for each part
        bounds.append((r["_part"], at, at + r["count"]))
        at += r["count"]
    if not bounds:
        return rows.withColumn("local_bin", F.lit(0).cast("long"))
    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string("_key string, _q int, _g long, _next long, _exit long, _steps long, _head boolean, _door boolean").fields])

    def hops(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_g", kind="stable").reset_index(drop=True)
        g, lo, hi, last = pdf["_g"].to_numpy(), pdf["_lo"].iloc[0], pdf["_hi"].iloc[0], bounds[-1][2]
        key = pdf["_key"].to_numpy()
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        follows = np.full(len(pdf), UNKNOWN, np.int64)
        for a, z in zip(cut, [*cut[1:], len(pdf)], strict=True):
            run = pdf.iloc[a:z]
            got = next_starts(run[samples].to_numpy(float), run["n_snps"].to_numpy(np.int64), run["start"].to_numpy(np.int64), run["stop"].to_numpy(np.int64), z < len(pdf) or g[-1] == last - 1, least_reads, least_snps, most_span)
            follows[a:z] = np.where(got >= 0, g[a] + got, got)
        head = np.zeros(len(pdf), bool)
        head[cut] = True
        head[0] = g[0] == 0
        own = np.flatnonzero((g >= lo) & (g < hi))
        follows = follows[own]
        out, steps = follows.tolist(), (follows >= 0).astype(int).tolist()
        for i in range(len(own) - 1, -1, -1):  # a pointer leads to a later row
            if lo <= (t := out[i]) < hi:
                out[i], steps[i] = out[t - lo], 1 + steps[t - lo]
        # a pointer out of a part before leads at most `halo` rows into this one
        pdf = pdf.iloc[own].assign(_next=follows, _exit=out, _steps=steps, _head=head[own], _door=head[own] | (g[own] < lo + halo))
        return pdf[schema.names]

    while True:
        # a part sees its rows, the row before them and the halo behind
        seen_by = [(p, lo, [(q, a, z) for q, a, z in bounds if z + halo > lo and a <= hi]) for p, lo, hi in bounds]
        small = F.broadcast(spark.createDataFrame(seen_by, "_part int, _first long, _by array<struct<q:int,lo:long,hi:long>>"))  # a row for each part
        placed = ranged.join(small, "_part").withColumn("_g", F.col("_first") + F.col("_id").bitwiseAND((1 << 33) - 1))
        near = placed.withColumn("_s", F.explode(F.filter("_by", lambda s: (F.col("_g") >= s["lo"] - 1) & (F.col("_g") < s["hi"] + halo))))
        near = near.select(*rows.columns, "_key", "_g", F.col("_s.q").alias("_q"), F.col("_s.lo").alias("_lo"), F.col("_s.hi").alias("_hi"))
        jumps = stored(near.repartition(2 * len(bounds), "_q").groupBy("_q").applyInPandas(hops, schema), "jumps")
        if jumps.where(F.col("_next") == UNKNOWN).limit(1).count() == 0:
            break
        dropped(jumps)
        halo *= 4
    entered = jumps.where("_head").select("_g").unionByName(jumps.where("_exit >= 0").select(F.col("_exit").alias("_g"))).distinct()
    nodes = jumps.where("_door").select("_key", "_q", "_g", "_exit", "_steps", "_head").join(entered, "_g")
    segments = jumps.select("_key", "_q").distinct().select("_key", "_q", F.lit(-1).cast("long").alias("_g"), F.lit(OPEN).cast("long").alias("_exit"), F.lit(0).cast("long").alias("_steps"), F.lit(False).alias("_head"))

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        real = pdf[pdf["_g"] >= 0]
        known = {g: (q, out, steps) for g, q, out, steps in zip(*(real[c].tolist() for c in ("_g", "_q", "_exit", "_steps")), strict=True)}
        at, begun, entry = int(real.loc[real["_head"], "_g"].iloc[0]), 0, {}
        while at >= 0:
            q, out, steps = known[at]
            entry[q] = (at, begun)
            at, begun = out, begun + steps
        fin = begun if at == COMPLETE and begun > 0 else max(begun - 1, 0)
        found, upto = [], begun + 1  # bins begun before a part without an entry: as many as before the next entry
        for q in sorted(pdf["_q"].unique().tolist(), reverse=True):
            g, before = entry.get(q, (-1, upto))
            upto = before
            found.append((pdf["_key"].iloc[0], q, g, before, fin))
        return pd.DataFrame(found, columns=["_key", "_q", "_entry", "_before", "_fin"])

    entries = nodes.unionByName(segments, True).groupBy("_key").applyInPandas(walk, "_key string, _q int, _entry long, _before long, _fin long")
    final = T.StructType([*rows.schema.fields, T.StructField("local_bin", T.LongType())])

    def mark(pdf: pd.DataFrame, begun: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.merge(begun.drop(columns="_q"), on="_key").sort_values("_g", kind="stable").reset_index(drop=True)
        g, entry, before = (pdf[c].to_numpy() for c in ("_g", "_entry", "_before"))
        follows, low, high = pdf["_next"].tolist(), int(g[0]), int(g[-1])
        key = pdf["_key"].to_numpy()
        bins = before - 1
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        for a, end in zip(cut, [*cut[1:], len(pdf)], strict=True):
            at, number = int(entry[a]), int(before[a])
            while 0 <= at <= high:
                i, t = at - low, follows[at - low]
                bins[i : min(t, high + 1) - low if t >= 0 else end] = number
                at, number = t, number + 1
        return pdf.assign(local_bin=np.minimum(np.maximum(bins, 0), pdf["_fin"].to_numpy()))[final.names]

    by_part = [d.repartition(2 * len(bounds), "_q").groupBy("_q") for d in (jumps.select(*rows.columns, "_key", "_q", "_g", "_next"), entries)]
    return by_part[0].cogroup(by_part[1]).applyInPandas(mark, final)


def numbered(binned: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """With bin_id: local bins counted on over groups in the order of their first rows.

    The count runs within each value of the first of `order` (the chromosome), then over these values.
    """
    # the last of `order` by itself first: the least of a struct would sort every row
    ends = binned.groupBy(*group, *[c for c in order[:-1] if c not in group]).agg(F.max("local_bin").alias("_most"), F.min(order[-1]).alias(order[-1]))
    per = ends.groupBy(*group).agg((F.max("_most") + 1).alias("_bins"), F.min(F.struct(*order)).alias("_first")).withColumn("_part", F.col("_first")[order[0]])
    before = W.unboundedPreceding, -1
    parts = per.groupBy("_part").agg(F.sum("_bins").alias("_all")).select("_part", F.coalesce(F.sum("_all").over(W.orderBy("_part").rowsBetween(*before)), F.lit(0)).alias("_base"))
    inside = F.coalesce(F.sum("_bins").over(W.partitionBy("_part").orderBy("_first").rowsBetween(*before)), F.lit(0))
    ahead = per.join(parts, "_part").withColumn("_ahead", F.col("_base") + inside).select(*group, "_ahead")
    return binned.join(ahead, group).withColumn("bin_id", (F.col("_ahead") + F.col("local_bin")).cast("long")).drop("_ahead")


def bin_bounds(binned: DataFrame, order: str, first: list[str] = (), names: str | None = None) -> DataFrame:
    """(bin_id, chrom, start, stop, n_rows, blocksize) with the first values by `order`, and names as first-seen distinct list joined by ;."""
    aggs = [F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n_rows"), *[F.min_by(c, order).alias(c) for c in ("chrom", *first)]]
    if names:
        seen = F.array_sort(F.collect_list(F.when(F.col(names).isNotNull(), F.struct(order, names))))
        aggs.append(F.array_join(F.array_distinct(F.transform(seen, lambda x: x[names])), ";").alias(names))
    return binned.groupBy("bin_id").agg(*aggs).withColumn("blocksize", F.col("stop") - F.col("start"))


def flips(snps: DataFrame, group: list[str], order: list[str], samples: dict[str, tuple[str, str]], epsilon: float = 0.05, alpha: float = 0.05) -> DataFrame:
    """With flip: some sample's interval lies on one side of the middle and the previous SNP's of the group on the other.

    samples: name to the columns of B and A reads.
    """
    w = W.partitionBy(*group).orderBy(*order)
    d, tests = snps, []
    for name, (b, a) in samples.items():
        d = d.join(interval_sides(d, b, a, epsilon, alpha).withColumnsRenamed({"_lo": f"_lo_{name}", "_hi": f"_hi_{name}"}), [b, a])
        tests.append((F.lag(f"_lo_{name}").over(w) & F.col(f"_hi_{name}")) | (F.lag(f"_hi_{name}").over(w) & F.col(f"_lo_{name}")))
    flip = tests[0]
    for t in tests[1:]:
        flip = flip | t
    return d.withColumn("flip", F.coalesce(flip, F.lit(False))).select(*snps.columns, "flip")


def interval_sides(counts: DataFrame, b: str, a: str, epsilon: float, alpha: float) -> DataFrame:
    """(b, a, _lo, _hi): the sides of each pair of counts that occurs, worked out once for all rows that have it."""
    below, above = outside_interval(F.col(b), F.col(a), epsilon, alpha)
    return counts.where(F.col(b).isNotNull() & F.col(a).isNotNull()).select(b, a).distinct().withColumn("_lo", below).withColumn("_hi", above)


def phase_groups(flipped: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """With phase_group: counted on at each flip within a group, and over groups in the order of their first rows."""
    local = F.sum(F.col("flip").cast("long")).over(W.partitionBy(*group).orderBy(*order))
    return numbered(flipped.withColumn("local_bin", local), group, order).withColumnRenamed("bin_id", "phase_group").drop("local_bin")


def mode_by_window(snps: DataFrame, window: list[str], value: str) -> DataFrame:
    """The most frequent value of each window, the smallest on ties."""
    return snps.groupBy(*window).agg(F.mode(value, True).alias(value))


def filled_forward(rows: DataFrame, columns: list[str], part: str, order: list[str]) -> DataFrame:
    """Nulls take the last value before them in (part, order), over parts too; those before any value stay null.

    Each part fills alone; its start takes the last value of the parts before, from one row a part.
    """
    inner = W.partitionBy(part).orderBy(*order)
    ends = rows.groupBy(part).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in columns])
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    carry = ends.select(part, *[F.last(c, True).over(before).alias("_c_" + c) for c in columns])
    d = rows.withColumns({c: F.last(c, True).over(inner) for c in columns}).join(carry, part, "left")
    return d.withColumns({c: F.coalesce(c, "_c_" + c) for c in columns}).drop(*["_c_" + c for c in columns])
