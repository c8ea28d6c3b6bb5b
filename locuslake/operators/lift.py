"""Intervals carried from one assembly to another over the aligned blocks of chains.

An interval meets the blocks it overlaps in the bucketed range join; each part of it that lies in a block is mapped by the block's
offset, from its end where the block lies on the other strand. Parts of a chain that touch on both sides are joined again. An interval
is lifted where one chain alone maps at least a share of its bases: to the span of the mapped parts.

Defined cases: an empty interval or one off all blocks is deleted; where several chains map enough it is duplicated; where several
chains only together touch it, it is split; where the one chain maps too little, partial. Repeated intervals are lifted each. `key` names an interval.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake.operators.intervals import BUCKET, overlaps

BLOCK = ["start", "stop", "chain_id", "to_chrom", "to_start", "to_stop", "strand"]


def pieces(intervals: DataFrame, blocks: DataFrame, key: list[str], bucket: int = BUCKET) -> DataFrame:
    """(*key, chain_id, start, stop, to_chrom, to_start, to_stop, strand): the mapped parts of each interval, joined where they touch on both sides."""
    one = intervals.select("chrom", "start", "stop", *[k for k in key if k not in ("chrom", "start", "stop")]).distinct()
    hit = overlaps(one, blocks, BLOCK, bucket=bucket)
    a, z = F.greatest("start", "b_start"), F.least("stop", "b_stop")
    ahead, behind = a - F.col("b_start"), F.col("b_stop") - z
    forward = F.col("b_strand") == "+"
    hit = hit.select(*key, F.col("b_chain_id").alias("chain_id"), a.alias("_a"), z.alias("_z"), F.col("b_to_chrom").alias("to_chrom"), F.when(forward, F.col("b_to_start") + ahead).otherwise(F.col("b_to_start") + behind).alias("to_start"),
        F.when(forward, F.col("b_to_stop") - behind).otherwise(F.col("b_to_stop") - ahead).alias("to_stop"), F.col("b_strand").alias("strand"))
    w = W.partitionBy(*key, "chain_id").orderBy("_a")  # the blocks under one interval
    touch = (F.lag("_z").over(w) == F.col("_a")) & F.when(F.col("strand") == "+", F.lag("to_stop").over(w) == F.col("to_start")).otherwise(F.lag("to_start").over(w) == F.col("to_stop"))
    island = hit.withColumn("_new", F.when(touch, 0).otherwise(1)).withColumn("_island", F.sum("_new").over(w))
    names = [k for k in key if k not in ("start", "stop")]
    held = {"start": "_from", "stop": "_upto"}
    island = island.withColumnsRenamed({k: v for k, v in held.items() if k in key})
    by = [*names, *[held[k] for k in ("start", "stop") if k in key]]
    out = island.groupBy(*by, "chain_id", "_island").agg(F.min("_a").alias("start"), F.max("_z").alias("stop"), F.first("to_chrom").alias("to_chrom"), F.min("to_start").alias("to_start"), F.max("to_stop").alias("to_stop"), F.first("strand").alias("strand"))
    return out.drop("_island")


def lifted(intervals: DataFrame, blocks: DataFrame, least: float = 0.95, bucket: int = BUCKET) -> DataFrame:
    """intervals with to_chrom, to_start, to_stop and strand (null unless lifted), mapped (bases by the chain that maps most) and status."""
    key = ["chrom", "start", "stop"]
    hit = overlaps(intervals.select(*key).distinct(), blocks, BLOCK, bucket=bucket)
    behind, ahead = F.greatest(F.lit(0), F.col("b_stop") - F.col("stop")), F.greatest(F.lit(0), F.col("start") - F.col("b_start"))
    forward = F.col("b_strand") == "+"
    at = F.col("b_to_start") + F.when(forward, ahead).otherwise(behind)
    per = hit.groupBy(*key, "b_chain_id").agg(F.sum("overlap").alias("n"), F.min(at).alias("a"), F.max(at + F.col("overlap")).alias("z"), F.first("b_to_chrom").alias("c"), F.first("b_strand").alias("s"))
    enough = F.col("n") >= F.lit(least) * (F.col("stop") - F.col("start"))
    best = per.groupBy(*key).agg(F.count_if(enough).alias("_full"), F.count("*").alias("_chains"), F.max("n").alias("mapped"), *[F.max_by(x, F.when(enough, F.col("n"))).alias(f"_{x}") for x in ("a", "z", "c", "s")])
    status = F.when(F.col("_full") == 1, "lifted").when(F.col("_full") > 1, "duplicated").when(F.col("_chains") > 1, "split").when(F.col("_chains") == 1, "partial").otherwise("deleted")
    d = intervals.join(best, key, "left").withColumn("status", status).withColumn("mapped", F.coalesce("mapped", F.lit(0)).cast("long"))
    only = lambda c: F.when(F.col("status") == "lifted", F.col(c))
    return d.select(*intervals.columns, only("_c").alias("to_chrom"), only("_a").alias("to_start"), only("_z").alias("to_stop"), only("_s").alias("strand"), "mapped", "status")
