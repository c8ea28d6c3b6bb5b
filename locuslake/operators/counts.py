"""Count tables: key alignment, de-duplication, merging, phase, pseudobulk, allele frequencies, binning of counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake.functions.columns import b_allele, ratio
from locuslake.plans.tables import parts, stored

KEY = ["chrom", "pos0"]


def first_of(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the first by `order`, all of its columns."""
    names = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min(F.struct(*order, *[F.col(c).alias("_v_" + c) for c in names])).alias("_s"))
    return best.select(*key, *[F.col("_s._v_" + c).alias(c) for c in names])


def singles(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key occurs once; all copies of a repeated key go."""
    return df.withColumn("_n", F.count("*").over(W.partitionBy(*key))).where("_n = 1").drop("_n")


def duplicate_counts(df: DataFrame, group: list[str], key: list[str]) -> DataFrame:
    """(rows, distinct keys, keys that repeat, rows of those keys) by group."""
    per = df.groupBy(*group, *[k for k in key if k not in group]).agg(F.count("*").alias("_n"))
    many = F.when(F.col("_n") > 1, F.col("_n"))
    return per.groupBy(*group).agg(F.sum("_n").alias("n_rows"), F.count("*").alias("n_keys"), F.count(many).alias("n_repeated"), F.coalesce(F.sum(many), F.lit(0)).alias("n_repeated_rows"))


def aligned(parent: DataFrame, child: DataFrame, values: list[str], key: list[str] = KEY) -> DataFrame:
    """parent's keys with the child's values; keys that repeat in the child count as absent, absent values are 0."""
    once = singles(child.select(*key, *values), key)
    return parent.join(once, key, "left").withColumns({v: F.coalesce(v, F.lit(0)) for v in values})


def merged_modalities(parts: dict[str, DataFrame], values: list[str], key: list[str] = KEY, order: list[str] = ()) -> DataFrame:
    """Sums of the values over modalities by key, with has_<name> of each modality; a key's first row stands for it in a modality."""
    rows = []
    for name, df in parts.items():
        one = first_of(df, key, [*order]) if order else df
        rows.append(one.select(*key, *values, *[F.lit(n == name).alias("has_" + n) for n in parts]))
    both = reduce(DataFrame.unionByName, rows)
    return both.groupBy(*key).agg(*[F.sum(v).alias(v) for v in values], *[F.bool_or("has_" + n).alias("has_" + n) for n in parts])


def stacked(parts: dict[str, DataFrame], barcode: str = "barcode") -> DataFrame:
    """Replicates under one another, cells named {barcode}_{replicate}."""
    named = [df.withColumn("rep_id", F.lit(rep)).withColumn(barcode, F.concat_ws("_", barcode, F.lit(rep))) for rep, df in parts.items()]
    return reduce(DataFrame.unionByName, named)


def phased(df: DataFrame, phase: str = "phase", ad: str = "ad", dp: str = "dp") -> DataFrame:
    """With b, the reads of the B haplotype, and a, the others."""
    b = b_allele(F.col(phase), F.col(dp) - F.col(ad), F.col(ad))
    return df.withColumn("b", b).withColumn("a", F.col(dp) - F.col("b"))


def frequencies(df: DataFrame, by: list[str], num: str = "b", den: str = "dp") -> DataFrame:
    """Sums of counts and the allele frequency by group, null at depth 0."""
    return df.groupBy(*by).agg(F.sum(num).alias(num), F.sum(den).alias(den)).withColumn("af", ratio(F.col(num), F.col(den)))


def binned(counts: DataFrame, bin_id: str, columns: list[str], values: list[str]) -> DataFrame:
    """Sums of values by bin and column where anything falls: a sparse matrix."""
    return counts.groupBy(bin_id, *columns).agg(*[F.sum(v).alias(v) for v in values])


def binned_grid(counts: DataFrame, bins: DataFrame, bin_id: str, columns: list[str], values: list[str]) -> DataFrame:
    """The same over all bins and columns there are, 0 where nothing falls: a dense matrix, for few columns (samples)."""
    sums = binned(counts, bin_id, columns, values)
    grid = bins.select(bin_id).distinct().join(counts.select(*columns).distinct(), how="cross")
    return grid.join(sums, [bin_id, *columns], "left").withColumns({v: F.coalesce(v, F.lit(0)) for v in values})


def sparsity(counts: DataFrame, rows: str, columns: str, value: str) -> DataFrame:
    """1 - nonzero cells over all cells of the matrix of a long table."""
    return counts.agg((1 - F.count_if(F.col(value) != 0) / (F.countDistinct(rows) * F.countDistinct(columns))).alias("sparsity"), F.count_if(F.col(value) != 0).alias("nonzero"))


def reference_bias(df: DataFrame, ref: str = "ref", total: str = "dp") -> DataFrame:
    """Smallest, largest, median and mean share of the reference among positions with reads."""
    x = ratio(F.col(ref), F.col(total))
    return df.agg(F.min(x).alias("least"), F.max(x).alias("most"), F.median(x).alias("middle"), F.avg(x).alias("mean"))


def pileup(reads: DataFrame, min_count: int = 0, min_maf: float = 0.0, part_rows: int = 250_000) -> DataFrame:
    """(chrom, pos0, barcode, dp, ad, oth) from reads at sites (chrom, pos0, barcode, umi, base, ref, alt); a molecule counts once for each base.

    Sites stay whose reads over all barcodes are `min_count` or more and whose rarer allele has a share of `min_maf` or more.
    Rows are dealt out before they are summed, in parts of about `part_rows`, so that a task holds as much whatever the number of reads; `reads` is read twice.
    """
    n = parts(reads, part_rows)
    base, ref, alt = F.col("base"), F.col("ref"), F.col("alt")
    # of the reference 0, of the alternative 1, of neither 2: a number, so that sums need no sort
    kind = F.when((base == ref) | (base == alt), F.when(base == alt, 1).otherwise(0)).when((base != ref) & (base != alt), 2)
    dealt = reads.select("chrom", "pos0", "barcode", "umi", "base", kind.alias("_kind")).repartition(n, "chrom", "pos0", "barcode")
    one = dealt.groupBy("chrom", "pos0", "barcode", "umi", "base").agg(F.min("_kind").alias("_kind"))
    k = F.col("_kind")
    per = one.groupBy("chrom", "pos0", "barcode").agg(F.count_if(k < 2).alias("dp"), F.count_if(k == 1).alias("ad"), F.count_if(k == 2).alias("oth"))
    if min_count <= 0 and min_maf <= 0:
        return per
    site = W.partitionBy("chrom", "pos0")
    sums = per.repartition(n, "chrom", "pos0").withColumns({f"_{c}": F.sum(c).over(site) for c in ("dp", "ad", "oth")})  # a row for each barcode of a site
    rare = F.coalesce(ratio(F.least(F.col("_ad"), F.col("_dp") - F.col("_ad")), F.col("_dp")), F.lit(0.0))
    return sums.where(F.col("chrom").isNotNull() & F.col("pos0").isNotNull() & (F.col("_dp") + F.col("_oth") >= min_count) & (rare >= min_maf)).select(*per.columns)


def barcodes_of(lists: dict[str, DataFrame]) -> DataFrame:
    """(barcode, rep_id): the barcodes of all replicates, named {barcode}_{replicate}."""
    return stacked({r: d.select("barcode") for r, d in lists.items()})


def dense_ids(names: DataFrame, column: str, out: str, parts: int | None = None) -> DataFrame:
    """(column, out): the distinct values of a column, numbered from 0 in their order, nulls left out: within ranges of values, and on over them."""
    d = names.where(F.col(column).isNotNull()).select(column).distinct()
    n = parts or names.sparkSession.sparkContext.defaultParallelism
    held = stored(d.repartitionByRange(n, column).sortWithinPartitions(column).withColumn("_id", F.monotonically_increasing_id()), "names")
    part = F.shiftright("_id", 33)
    sizes = held.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    ahead = sizes.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))  # a row for each range
    return held.withColumn("_part", part).join(F.broadcast(ahead), "_part").select(column, (F.col("_ahead") + F.col("_id").bitwiseAND((1 << 33) - 1)).alias(out))
