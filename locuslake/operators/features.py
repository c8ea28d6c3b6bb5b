"""Feature matrices as long tables: filters, tiles, concatenation, blocks, barcodes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake.operators.intervals import BUCKET, largest_overlap


def expressed(x: DataFrame) -> DataFrame:
    """Features whose counts do not sum to 0, with pseudobulk."""
    return x.groupBy("feature_id").agg(F.sum("value").alias("pseudobulk")).where("pseudobulk > 0")


def widely_expressed(x: DataFrame, n_barcodes: int, share: float) -> DataFrame:
    """Features with a count in at least round-half-even(share x n_barcodes) barcodes."""
    per = x.groupBy("feature_id").agg(F.count_if(F.col("value") != 0).alias("n_barcodes"))
    return per.where(F.col("n_barcodes") >= F.bround(F.lit(share * n_barcodes), 0))


def without_genes(features: DataFrame, blacklist: DataFrame, name: str = "gene") -> DataFrame:
    return features.join(blacklist.select(name).distinct(), name, "left_anti")


def with_coordinates(var: DataFrame, genes: DataFrame) -> DataFrame:
    """Features that have a gene, with chrom, start and stop."""
    return var.join(genes.select("gene_id", "chrom", "start", "stop"), var["feature_id"] == genes["gene_id"]).drop("gene_id")


def tiles(fragments: DataFrame, width: int) -> DataFrame:
    """(barcode, chrom, tile, value): fragments by their start in tiles of `width`."""
    return fragments.groupBy("barcode", "chrom", F.floor(F.col("start") / width).cast("long").alias("tile")).agg(F.count("*").alias("value"))


def outer(parts: dict[str, DataFrame]) -> DataFrame:
    """Matrices of replicates under one another, features of any; an absent count is 0."""
    return reduce(DataFrame.unionByName, [d.withColumn("rep_id", F.lit(r)) for r, d in parts.items()])


def inner(parts: dict[str, DataFrame]) -> DataFrame:
    """The same for features that every replicate has."""
    both = outer(parts)
    common = both.groupBy("feature_id").agg(F.countDistinct("rep_id").alias("_n")).where(F.col("_n") == len(parts)).select("feature_id")
    return both.join(common, "feature_id", "left_semi")


def blocks(features: DataFrame, blocks_: DataFrame, block_id: str = "bin_id", bucket: int = BUCKET) -> DataFrame:
    """Features that overlap a block, with the one they share most with."""
    return largest_overlap(features, blocks_, block_id, ["feature_id"], bucket).where(F.col(block_id).isNotNull())


def remapped(reads: DataFrame, mapping: DataFrame, order: str = "row_id") -> DataFrame:
    """reads with the target barcode of their source; of several the last by `order`, reads without one go."""
    last = mapping.groupBy("src").agg(F.max_by("tgt", order).alias("tgt"))
    return reads.join(last, reads["barcode"] == last["src"]).drop("src").drop("barcode").withColumnRenamed("tgt", "barcode")


def restricted(x: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Counts of listed barcodes; see missing_barcodes for those without counts."""
    return x.join(barcodes.select("barcode").distinct(), "barcode", "left_semi")


def missing_barcodes(x: DataFrame, barcodes: DataFrame) -> DataFrame:
    return barcodes.select("barcode").distinct().join(x.select("barcode").distinct(), "barcode", "left_anti")


def listed(x: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Rows of x (one for each barcode) in the order of a list (barcode, row_id); a listed barcode without a row is an error when rows are read."""
    d = barcodes.select("barcode", "row_id").join(x.withColumn("_there", F.lit(True)), "barcode", "left")
    lost = F.when(F.col("_there").isNull(), F.raise_error(F.concat(F.lit("no row for barcode "), F.col("barcode"))).cast("string")).otherwise(F.col("barcode"))
    return d.withColumn("barcode", lost).orderBy("row_id").select(*x.columns)


def replicate_index(cells: DataFrame, replicates: DataFrame) -> DataFrame:
    """cells with rep_index, the place of their rep_id in the list (rep_id, rep_index); one that is not listed is an error when rows are read."""
    d = cells.join(F.broadcast(replicates.select("rep_id", F.col("rep_index").alias("_i"))), "rep_id", "left")  # a row for each replicate of the sheet
    lost = F.raise_error(F.concat(F.lit("unknown replicate "), F.coalesce(F.col("rep_id"), F.lit("null")))).cast("int")
    return d.withColumn("rep_index", F.coalesce("_i", lost).cast("int")).drop("_i")


def counted_by_block(placed: DataFrame, blocks_: DataFrame, block_id: str = "bin_id") -> DataFrame:
    """blocks with n_features, the number of features placed in each, 0 where none."""
    per = placed.groupBy(block_id).agg(F.count("*").alias("n_features"))
    return blocks_.join(per, block_id, "left").fillna(0, ["n_features"])


def coordinates(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """rows (chrom, pos0) with x, the position along the genome: chromosomes of `sizes` one after the other."""
    before = W.orderBy("chrom_ord").rowsBetween(W.unboundedPreceding, -1)
    ahead = sizes.withColumn("_a", F.coalesce(F.sum("size").over(before), F.lit(0))).select("chrom", "_a")
    return rows.join(ahead, "chrom").withColumn("x", F.col("_a") + F.col("pos0")).drop("_a")


def shades(intervals: DataFrame) -> DataFrame:
    """(chrom, spans): a chromosome's intervals in order, for drawing."""
    return intervals.groupBy("chrom").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
