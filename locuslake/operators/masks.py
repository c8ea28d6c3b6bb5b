"""Masks over SNPs, each as the set of SNPs that pass; masks combine by semi joins on the SNP's key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake.functions.columns import het_balanced
from locuslake.operators.intervals import BUCKET, first_interval, points_in_intervals
from locuslake.plans.tables import stored

KEY = ["chrom", "pos0"]


def in_regions(snps: DataFrame, regions: DataFrame, bucket: int = BUCKET) -> DataFrame:
    return points_in_intervals(snps, regions, [], how="left_semi", bucket=bucket)


def outside(snps: DataFrame, blacklist: DataFrame, bucket: int = BUCKET) -> DataFrame:
    return points_in_intervals(snps, blacklist, [], how="left_anti", bucket=bucket)


def deep_enough(counts: DataFrame, n_samples: int, least: int = 1) -> DataFrame:
    """SNPs with at least max(least, 1) reads in every one of n_samples samples; absent rows are 0."""
    per = counts.groupBy(*KEY, "sample_id").agg(F.sum("dp").alias("dp"))
    return per.groupBy(*KEY).agg(F.count_if(F.col("dp") >= max(least, 1)).alias("_n")).where(F.col("_n") == n_samples).drop("_n")


def balanced(normal: DataFrame, gamma: float = 0.05) -> DataFrame:
    """SNPs of the normal sample whose reference share may be a half; each pair of counts that occurs is tested once."""
    pairs = stored(normal.select("dp", "ad").distinct(), "pairs")  # else the test moves below the distinct rows, to every SNP
    fair = pairs.where(het_balanced(F.col("dp") - F.col("ad"), F.col("ad"), gamma))
    return normal.join(fair, ["dp", "ad"], "left_semi").select(*KEY)


def in_features(snps: DataFrame, features: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """SNPs inside any feature (chrom, start, stop)."""
    return points_in_intervals(snps, features, [], how="left_semi", bucket=bucket)


def exonic(annotated_: DataFrame) -> DataFrame:
    """Annotated SNPs of feature type exon."""
    return annotated_.where("feature_type = 'exon'")


def with_feature(snps: DataFrame, features: DataFrame, feature_id: str = "feature_id", bucket: int = BUCKET) -> DataFrame:
    """SNPs with the id of the first feature that holds them, null where none does."""
    return first_interval(snps, features, feature_id, KEY, bucket=bucket)


def all_of(snps: DataFrame, *masks: DataFrame) -> DataFrame:
    return reduce(lambda d, m: d.join(m.select(*KEY).distinct(), KEY, "left_semi"), masks, snps)


def annotated(snps: DataFrame, genes: DataFrame, exons: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """With gene_id ('intergenic' where none) and feature_type: exon, else intron within a gene, else intergenic."""
    d = first_interval(snps, genes, "gene_id", KEY, bucket=bucket)
    hit = points_in_intervals(snps.select(*KEY), exons, [], how="left_semi", bucket=bucket).distinct().withColumn("_exon", F.lit(True))
    d = d.join(hit, KEY, "left")
    kind = F.when(F.col("_exon"), "exon").when(F.col("gene_id").isNotNull(), "intron").otherwise("intergenic")
    return d.withColumn("feature_type", kind).withColumn("gene_id", F.coalesce("gene_id", F.lit("intergenic"))).drop("_exon")


def boundaries(snps: DataFrame, regions: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """SNPs inside a region with start and stop halfway to their neighbours (rounded up), the region's ends at the ends."""
    d = points_in_intervals(snps, regions.withColumnsRenamed({"start": "r_start", "stop": "r_stop"}).withColumns({"start": F.col("r_start"), "stop": F.col("r_stop")}), ["region_id", "r_start", "r_stop"], bucket=bucket)
    w = W.partitionBy("region_id").orderBy("pos0")
    before, after = F.lag("pos0").over(w), F.lead("pos0").over(w)
    return d.withColumn("start", F.coalesce(F.ceil((before + F.col("pos0")) / 2), F.col("r_start"))).withColumn("stop", F.coalesce(F.ceil((F.col("pos0") + after) / 2), F.col("r_stop"))).drop("r_start", "r_stop")


def slice_of(df: DataFrame, chrom: str, start: int, stop: int, last: bool = False) -> DataFrame:
    """Rows of a chromosome in [start, stop), or [start, stop] for its last block."""
    end = F.col("pos0") <= stop if last else F.col("pos0") < stop
    return df.where((F.col("chrom") == chrom) & (F.col("pos0") >= start) & end)
