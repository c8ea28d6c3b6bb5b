"""Genetic maps and switch probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake.functions.columns import haldane
from locuslake.operators.intervals import BUCKET, points_in_intervals


def interpolated(points: DataFrame, knots: DataFrame, pos: str = "pos0", out: str = "cm", bucket: int = BUCKET) -> DataFrame:
    """points with the map position between the knots (chrom, pos, cm) around it; clamped at the map's ends, null off the map."""
    w = W.partitionBy("chrom").orderBy("pos")
    spans = knots.select("chrom", F.col("pos").alias("start"), F.lead("pos").over(w).alias("stop"), F.col("cm").alias("_c0"), F.lead("cm").over(w).alias("_c1")).where("stop is not null")
    ends = knots.groupBy("chrom").agg(F.min("pos").alias("_p0"), F.max("pos").alias("_p1"), F.min_by("cm", "pos").alias("_e0"), F.max_by("cm", "pos").alias("_e1"))
    d = points_in_intervals(points, spans.withColumn("_s", F.col("start")).withColumn("_t", F.col("stop")), ["_s", "_t", "_c0", "_c1"], pos, "left", bucket)
    d = d.join(F.broadcast(ends), "chrom", "left")  # a row for each chromosome
    inside = F.col("_c0") + (F.col("_c1") - F.col("_c0")) * (F.col(pos) - F.col("_s")) / (F.col("_t") - F.col("_s"))
    value = F.when(F.col(pos) <= F.col("_p0"), F.col("_e0")).when(F.col(pos) >= F.col("_p1"), F.col("_e1")).otherwise(inside)
    return d.withColumn(out, value).select(*points.columns, out)


def block_distances(blocks: DataFrame, knots: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """blocks (chrom, bin_id, first_pos, last_pos) with the map distance from the block before on the chromosome, 0 for the first, never negative."""
    d = interpolated(blocks, knots, "first_pos", "start_cm", bucket)
    d = interpolated(d, knots, "last_pos", "end_cm", bucket)
    before = F.lag("end_cm").over(W.partitionBy("chrom").orderBy("bin_id"))
    return d.withColumn("distance", F.greatest(F.lit(0.0), F.coalesce(F.col("start_cm") - before, F.lit(0.0))))


def switchprobs_from_map(blocks: DataFrame, knots: DataFrame, nu: float = 1.0, least: float = 1e-6, bucket: int = BUCKET) -> DataFrame:
    return block_distances(blocks, knots, bucket).withColumn("switchprob", haldane(F.col("distance"), nu, least))


def switchprobs_from_phase_sets(blocks: DataFrame, order: list[str], part: str = "chrom", ps: str = "ps", least: float = 1e-6) -> DataFrame:
    """`least` within a phase set, just under a half where one begins (the first block of all included)."""
    before = F.lag(ps).over(W.partitionBy(part).orderBy(*order))
    return blocks.withColumn("switchprob", F.when(F.coalesce(before == F.col(ps), F.lit(False)), F.lit(least)).otherwise(0.5 - 1e-4))


def switchprobs_along(blocks: DataFrame, part: str, order: list[str], ps: str = "ps", least: float = 0.05) -> DataFrame:
    """As switchprobs_from_phase_sets, for one run of blocks over all parts: a part's first block is compared with the last one of the part before."""
    inner = W.partitionBy(part).orderBy(*order)
    ends = blocks.groupBy(part).agg(F.max_by(ps, F.struct(*order)).alias("_end"))
    ends = ends.select(part, F.lag("_end").over(W.orderBy(part)).alias("_end"))  # a row for each part
    before = F.when(F.row_number().over(inner) == 1, F.col("_end")).otherwise(F.lag(ps).over(inner))
    return blocks.join(ends, part).withColumn("_before", before).withColumn("switchprob", F.when(F.coalesce(F.col("_before") == F.col(ps), F.lit(False)), F.lit(least)).otherwise(0.5 - 1e-4)).drop("_before", "_end")
