"""Column conventions, chromosome order and assay constants.

Intervals are 0-based half-open (chrom, start, stop). Counts are long tables (row key, column key, value) in
which an absent row stands for zero; a missing measurement is null. No operator relies on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Chromosome order, assays and the modality and feature type of each.
CHROMS = [f"chr{c}" for c in [*range(1, 23), "X", "Y", "M"]]
NON_BULK = ("scRNA", "scATAC", "VISIUM", "VISIUM3prime")
BULK = ("bulkWGS", "bulkWES", "bulkWGS-lr")
SPATIAL = ("VISIUM", "VISIUM3prime")
REFERENCES = ("hg19", "hg38", "chm13v2")

SAMPLES = T.StructType([T.StructField(c, T.StringType()) for c in ("SAMPLE", "REP_ID", "assay_type", "sample_type", "PATH_to_bam", "PATH_to_barcodes", "PATH_to_10x_ranger")])
VCF = T.StructType([T.StructField("chrom", T.StringType()), T.StructField("pos", T.LongType())] + [T.StructField(c, T.StringType()) for c in ("id", "ref", "alt", "qual", "filter", "info", "format", "sample")])
BED3 = T.StructType([T.StructField("chrom", T.StringType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
BED4 = T.StructType([*BED3.fields, T.StructField("value", T.DoubleType())])
GTF = T.StructType([T.StructField(c, T.LongType() if c in ("start", "stop") else T.StringType()) for c in ("chrom", "source", "feature", "start", "stop", "score", "strand", "frame", "attributes")])
LONG_MATRIX = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("col_id", T.LongType()), T.StructField("value", T.LongType())])


def with_chr(c: Column) -> Column:
    """The name with a chr prefix; chrMT is chrM."""
    c = F.when(c.startswith("chr"), c).otherwise(F.concat(F.lit("chr"), c))
    return F.when(c == "chrMT", "chrM").otherwise(c)


def chrom_ord(c: Column) -> Column:
    """1 for chr1 to 25 for chrM; null outside the known chromosomes."""
    pairs = [x for k, name in enumerate(CHROMS, 1) for x in (F.lit(name), F.lit(k))]
    return F.create_map(*pairs)[c]


def sort_chroms(df: DataFrame, *then: str, chrom: str = "chrom") -> DataFrame:
    """Rows in chromosome order and by the columns `then`; an unknown chromosome is an error when the rows are read."""
    known = F.when(chrom_ord(F.col(chrom)).isNull(), F.raise_error(F.concat(F.lit("unknown chromosome "), F.coalesce(F.col(chrom), F.lit("null"))))).otherwise(chrom_ord(F.col(chrom)))
    return df.orderBy(known, *then)


def standard(df: DataFrame, sizes: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Rows on the known chromosomes that the genome's table of sizes has too."""
    there = sizes.select(F.col("chrom").alias(chrom)).where(chrom_ord(F.col(chrom)).isNotNull()).distinct()
    return df.join(there, chrom, "left_semi")
