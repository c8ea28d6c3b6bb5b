"""Sinks: tab-separated tables, headerless BED, variant text by chromosome, and long matrices as Parquet."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake.schema import LONG_MATRIX
from locuslake.sources import bgzf
from locuslake.sources.files import put

# The lines above the variants.
HEADER = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=AD,Number=1,Type=Integer,Description="alternative reads">',
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="reads">',
    '##INFO=<ID=OTH,Number=1,Type=Integer,Description="reads of other bases">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="genotype">',
]
NAMES = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tSAMPLE"


def tsv(df: DataFrame, path: str, header: bool = True) -> None:
    # a comment mark that no table holds: else a header that starts with # would be quoted
    df.write.option("sep", "\t").option("header", header).option("compression", "gzip").option("quote", "").option("comment", "\x01").csv(path)


def bed3(df: DataFrame, path: str) -> None:
    tsv(df.select("chrom", "start", "stop"), path, header=False)


def variants(calls: DataFrame, path: str, header: list[str] | None = None) -> None:
    """Variant lines by chromosome and position, one folder a chromosome, each file with the header's lines (without the
    line of column names, which is added); info and gt must be columns."""
    line = variant_line()
    d = calls.select(F.col("chrom").alias("by_chrom"), "pos0", line.alias("value"))
    top = [*(HEADER if header is None else header), NAMES]
    lead = calls.select(F.col("chrom").alias("by_chrom")).distinct().select("by_chrom", F.posexplode(F.array(*map(F.lit, top))).alias("pos0", "value"))
    d = lead.withColumn("pos0", F.col("pos0").cast("long") - len(top)).unionByName(d)
    d.repartition("by_chrom").sortWithinPartitions("by_chrom", "pos0").drop("pos0").write.partitionBy("by_chrom").option("compression", "gzip").text(path)


def variant_line():
    return F.concat_ws("\t", "chrom", (F.col("pos0") + 1).cast("string"), "snp_id", "ref", "alt", F.lit("."), F.lit("PASS"), "info", F.lit("GT"), "gt")


def indexed_variants(calls: DataFrame, sizes: DataFrame, path: str, header: list[str] | None = None, files: int | None = None) -> DataFrame:
    """Variant lines in block gzip with position indices, a file for each range of a chromosome; the header names every
    chromosome of `sizes` (chrom, size) with its length. calls need chrom_ord besides what a line has."""
    contigs = [f"##contig=<ID={r['chrom']},length={r['size']}>" for r in sizes.orderBy(*[c for c in ("chrom_ord", "chrom") if c in sizes.columns]).collect()]  # a row for each chromosome
    first, *rest = HEADER if header is None else header
    return bgzf.write(calls.select("chrom", "chrom_ord", "pos0", variant_line().alias("value")), [first, *contigs, *rest, NAMES], path, files)


def eagle_map(maps: DataFrame, path: str) -> None:
    """A genetic map (chrom, pos, cm) as space-separated text with a header, X as 23; the rate is that to the next position of the chromosome."""
    w = W.partitionBy("chrom").orderBy("pos")
    rate = F.coalesce((F.lead("cm").over(w) - F.col("cm")) / (F.lead("pos").over(w) - F.col("pos")) * 1e6, F.lit(0.0))
    number = F.when(F.col("chrom") == "chrX", "23").otherwise(F.substring("chrom", 4, 9))
    d = maps.select(number.alias("chr"), F.col("pos").alias("position"), rate.alias("COMBINED_rate(cM/Mb)"), F.col("cm").alias("Genetic_Map(cM)"), F.col("chrom").alias("_c"))
    d.repartition("_c").sortWithinPartitions("_c", "position").drop("_c").write.option("sep", " ").option("header", True).option("compression", "gzip").csv(path)


def matrix(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def csr(x: DataFrame, n_rows: int, n_cols: int, path: str, rows: int = 4096) -> DataFrame:
    """A long matrix (row_id, col_id, value) as numpy archives stored by rows, one for each range of `rows` rows, empty ranges too; what was written, as
    (shard, name, first, rows, cols, cells), is kept beside them and returned.

    Numbers run from 0; cells that repeat are added up, nulls and zeros left out. A range's cells are held by its task, at most rows x n_cols of them.
    """
    import io

    import numpy as np

    path = path.rstrip("/")
    if min(n_rows, n_cols) < 0 or x.where((F.col("row_id") < 0) | (F.col("row_id") >= n_rows) | (F.col("col_id") < 0) | (F.col("col_id") >= n_cols)).limit(1).count():
        raise ValueError("a cell lies outside the matrix")
    cells = x.where("row_id is not null and col_id is not null and value is not null").groupBy("row_id", "col_id").agg(F.sum("value").cast("double").alias("value")).where("value != 0")
    cells = cells.select(F.expr(f"cast(row_id div {rows} as long)").alias("shard"), F.col("row_id").cast("long").alias("row_id"), F.col("col_id").cast("long").alias("col_id"), "value")
    # a mark for each range, so that empty ranges are written too
    marks = x.sparkSession.range(-(-n_rows // rows)).select(F.col("id").alias("shard"), F.lit(-1).cast("long").alias("row_id"), F.lit(-1).cast("long").alias("col_id"), F.lit(0.0).alias("value"))

    def run(pdf):
        shard = int(pdf["shard"].iloc[0])
        pdf = pdf[pdf["row_id"] >= 0].sort_values(["row_id", "col_id"])
        first, many = shard * rows, min(rows, n_rows - shard * rows)
        ends = np.concatenate([[0], np.cumsum(np.bincount(pdf["row_id"].to_numpy(np.int64) - first, minlength=many))])
        data, held = pdf["value"].to_numpy(float), io.BytesIO()
        np.savez_compressed(held, format=np.array(b"csr"), shape=np.array([many, n_cols]), indptr=ends, indices=pdf["col_id"].to_numpy(np.int64), data=data)
        name = f"rows-{shard:06d}.npz"
        put(f"{path}/{name}", [held.getvalue()])
        return pd.DataFrame({"shard": [shard], "name": [name], "first": [first], "rows": [many], "cols": [n_cols], "cells": [len(data)]})

    made = marks.unionByName(cells).groupBy("shard").applyInPandas(run, "shard long, name string, first long, rows long, cols long, cells long")
    made.write.parquet(f"{path}/shards")
    return x.sparkSession.read.schema(made.schema).parquet(f"{path}/shards")


def annotated_matrix(obs: DataFrame, var: DataFrame, x: DataFrame, folder: str) -> None:
    """Barcodes, features and their long matrix beside one another."""
    for name, df in (("obs", obs), ("var", var), ("x", x)):
        df.write.parquet(f"{folder}/{name}")


def empty_matrix(spark: SparkSession) -> DataFrame:
    """The matrix that stands for one that a mode does not make."""
    return spark.createDataFrame([], LONG_MATRIX)


def stamped(path: str, run_id: str | None) -> str:
    """path with the run's id before its extensions."""
    folder, slash, name = path.rpartition("/")
    stem, dot, rest = name.partition(".")
    return f"{folder}{slash}{stem}.{run_id}{dot}{rest}" if run_id else path
