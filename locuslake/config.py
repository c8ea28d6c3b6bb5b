"""Settings of the stages, and checks of the sample sheet."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslake.schema import BULK, NON_BULK

MODES = ("bulk_genotyping", "single_cell_genotyping", "copytyping_preprocess")


@dataclass(frozen=True)
class Genotype:
    min_het_reads: int = 2
    min_hom_dp: int = 10
    min_vaf: float = 0.1
    keep_hom_alt: bool = False
    no_other: bool = False


@dataclass(frozen=True)
class Phase:
    min_depth: int = 1
    gamma: float = 0.05
    exon_only: bool = False
    flip_test: bool = True
    epsilon: float = 0.05
    alpha: float = 0.05


@dataclass(frozen=True)
class Depth:
    method: str = "median"  # or lowess, or none
    routlier: float = 0.01
    doutlier: float = 0.001
    min_mappability: float = 0.9
    fit_sample: int = 50_000
    frac_tight: float = 0.03
    frac_smooth: float = 0.3
    grid: int = 1001
    eps_quantile: float = 0.01


@dataclass(frozen=True)
class Bins:
    nsnp_multi: int = 2
    min_snp_reads: int = 1000
    min_snp_per_block: int = 10
    max_blocksize: int = 500_000
    rdr_outlier: float = 0.0
    median_normalization: bool = False
    nu: float = 1.0
    min_switchprob: float = 1e-6
    switchprob_ps: float = 0.05
    tile: int = 200_000


@dataclass(frozen=True)
class Config:
    mode: str = "bulk_genotyping"
    genotype: Genotype = field(default_factory=Genotype)
    phase: Phase = field(default_factory=Phase)
    depth: Depth = field(default_factory=Depth)
    bins: Bins = field(default_factory=Bins)


def validate_samples(samples: DataFrame, mode: str) -> DataFrame:
    """The sheet's rows for a mode, or ValueError: required columns, known assays, at most one RNA and one ATAC assay a replicate."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    lacking = {"SAMPLE", "REP_ID", "assay_type", "sample_type", "PATH_to_bam"} - {*samples.columns}
    if lacking:
        raise ValueError(f"the sample sheet lacks {sorted(lacking)}")
    for c in ("PATH_to_barcodes", "PATH_to_10x_ranger"):
        if c not in samples.columns:
            samples = samples.withColumn(c, F.lit(None).cast("string"))
    allowed = BULK if mode == "bulk_genotyping" else NON_BULK
    odd = samples.where(F.col("assay_type").isNull() | ~F.col("assay_type").isin(*BULK, *NON_BULK)).select("assay_type").distinct().limit(10).collect()
    if odd:
        raise ValueError(f"unknown assay types {sorted(str(r[0]) for r in odd)}")
    kept = samples.where(F.col("assay_type").isin(*allowed))
    sets = kept.groupBy("SAMPLE", "REP_ID").agg(F.array_sort(F.collect_set("assay_type")).alias("s"), F.count("*").alias("n"))
    bad = sets.where((F.size("s") > 2) | (F.col("n") > F.size("s")) | ((F.size("s") == 2) & (F.col("s") != F.array(F.lit("scATAC"), F.lit("scRNA"))))).limit(10).collect()
    if bad:
        raise ValueError(f"replicates with assays that do not go together: {[(r['REP_ID'], r['s']) for r in bad]}")
    if kept.limit(1).count() == 0:
        raise ValueError(f"no sample for mode {mode}")
    return kept
