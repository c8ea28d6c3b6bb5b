"""Genotype calls and statistics of variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslake.functions import columns as C


def called(snps: DataFrame, min_het_reads: int = 2, min_vaf: float = 0.1, min_hom_dp: int = 10) -> DataFrame:
    return snps.withColumn("gt", C.genotype(F.col("ad"), F.col("dp"), min_het_reads, min_vaf, min_hom_dp))


def kept(calls: DataFrame, hom_alt: bool = False, no_other: bool = False) -> DataFrame:
    d = calls.where(F.col("gt").isin("0/1", "1/1") if hom_alt else F.col("gt") == "0/1")
    return d.where("oth = 0") if no_other else d


def vcf_lines(calls: DataFrame) -> DataFrame:
    """With snp_id, and the info and sample text of a variant line."""
    return calls.withColumn("snp_id", F.concat_ws("_", "chrom", (F.col("pos0") + 1).cast("string"))).withColumn("info", F.format_string("AD=%d;DP=%d;OTH=%d", "ad", "dp", "oth"))


def statistics(calls: DataFrame, first: str = "has_dna", second: str = "has_rna") -> DataFrame:
    """Counts by chromosome and over all (TOTAL): by modality, in both, in either, by call, dropped and kept."""
    n = lambda c: F.count_if(F.col("gt") == c)
    out = calls.rollup("chrom").agg(
        F.count_if(first).alias("n_first"), F.count_if(second).alias("n_second"), F.count_if(F.col(first) & F.col(second)).alias("n_shared"), F.count("*").alias("n_union"),
        n("0/1").alias("n_het"), n("1/1").alias("n_hom_alt"), n("0/0").alias("n_hom_ref"), n("./.").alias("n_dropped"), F.count_if(F.col("gt").isin("0/1", "1/1")).alias("n_kept"))
    return out.withColumn("chrom", F.coalesce("chrom", F.lit("TOTAL")))


def germline_statistics(variants: DataFrame) -> DataFrame:
    """(total, het_phased, het_unphased, hom_alt, hom_ref) by chromosome of phased or unphased genotypes gt."""
    n = lambda *c: F.count_if(F.col("gt").isin(*c))
    return variants.groupBy("chrom").agg(F.count("*").alias("total"), n("0|1", "1|0").alias("het_phased"), n("0/1", "1/0").alias("het_unphased"), n("1|1", "1/1").alias("hom_alt"), n("0|0", "0/0").alias("hom_ref"))


def phased_het(variants: DataFrame) -> DataFrame:
    """Phased heterozygous variants with one alternative, and their phase."""
    return variants.where(F.col("gt").isin("0|1", "1|0") & (F.length("ref") == 1) & (F.length("alt") == 1)).withColumn("phase", C.phase_of(F.col("gt")))


def quality(variants: DataFrame, qual: float, depth: int) -> DataFrame:
    """Single-base variants with one alternative, at least `qual` and `depth`, that carry an alternative allele."""
    return variants.where((F.length("ref") == 1) & (F.length("alt") == 1) & (F.col("qual").cast("double") >= qual) & (F.col("dp") >= depth) & F.col("gt").contains("1"))
