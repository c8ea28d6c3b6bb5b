"""Read-backed phasing: heterozygous SNPs joined by the reads that cover them.

SNPs that follow each other on a read are linked, and all reads' votes on a link add up: for equal alleles on one side, for different ones on the other.
Over the links, heaviest first, grows a spanning forest: in each round every component joins along its heaviest link out, its side kept as a
parity to the component's root; pointers to roots are halved by joins until they rest. Components are phase sets. Rounds and jumps grow with the
logarithm of a component's size, a round is a stored table, and no task holds a component.

Defined cases: alleles other than 0 and 1 and rows with nulls take no part; a read that covers a SNP twice with different alleles says nothing about it; a link whose
votes are even is no link; a SNP without links is in no phase set; links that contradict the forest are outvoted by its heavier ones; ties go to the earlier SNPs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake.plans.tables import dropped, stored


def links(reads: DataFrame, read: str = "read_id") -> DataFrame:
    """(chrom, u, v, weight, side): SNPs at u < v that follow each other on some read; side 0 for equal alleles, 1 for different ones."""
    d = reads.where(F.col("allele").isin(0, 1)).where(F.col(read).isNotNull() & F.col("chrom").isNotNull() & F.col("pos0").isNotNull())
    one = d.groupBy(read, "chrom", "pos0").agg(F.min("allele").alias("a"), F.max("allele").alias("z")).where("a = z")
    w = W.partitionBy(read, "chrom").orderBy("pos0")  # the SNPs of a read
    pair = one.select("chrom", F.lag("pos0").over(w).alias("u"), F.col("pos0").alias("v"), F.when(F.lag("a").over(w) == F.col("a"), 1).otherwise(-1).alias("vote")).where("u is not null")
    votes = pair.groupBy("chrom", "u", "v").agg(F.sum("vote").alias("votes")).where("votes != 0")
    return votes.select("chrom", "u", "v", F.abs("votes").alias("weight"), F.when(F.col("votes") > 0, 0).otherwise(1).alias("side"))


def _rooted(hooks: DataFrame, most: int = 60) -> DataFrame:
    """(chrom, c, root, q) from (chrom, c, parent, q): pointers halved until all rest on roots, which point to themselves."""
    at = stored(hooks, "hooks")
    for _ in range(most):
        up = at.select("chrom", F.col("c").alias("parent"), F.col("parent").alias("_p"), F.col("q").alias("_q"))
        after = stored(at.join(up, ["chrom", "parent"]).select("chrom", "c", F.col("_p").alias("parent"), F.col("q").bitwiseXOR(F.col("_q")).alias("q"), (F.col("_p") != F.col("parent")).alias("moved")), "hooks")
        still = after.where("moved").limit(1).count() == 0
        dropped(at)
        at = after.drop("moved")
        if still:
            return at.withColumnRenamed("parent", "root")
    raise RuntimeError(f"pointers did not come to rest in {most} rounds")


def phased(reads: DataFrame, read: str = "read_id", most: int = 60) -> DataFrame:
    """(chrom, pos0, ps, phase): ps the 1-based position of the phase set's first SNP, phase 0 where a SNP is as that first one and 1 where it is not."""
    e = stored(links(reads, read), "links")
    ends = e.select("chrom", F.col("u").alias("pos0")).unionByName(e.select("chrom", F.col("v").alias("pos0"))).distinct()
    nodes = stored(ends.select("chrom", "pos0", F.col("pos0").alias("c"), F.lit(0).alias("p")), "nodes")
    for _ in range(most):
        of = lambda x: nodes.select("chrom", F.col("pos0").alias(x), F.col("c").alias("c" + x), F.col("p").alias("p" + x))
        out = e.join(of("u"), ["chrom", "u"]).join(of("v"), ["chrom", "v"]).where("cu != cv")
        out = out.select("chrom", "cu", "cv", F.struct("weight", (-F.col("u")).alias("u"), (-F.col("v")).alias("v")).alias("rank"), F.col("pu").bitwiseXOR(F.col("pv")).bitwiseXOR(F.col("side")).alias("q"))
        both = out.select("chrom", F.col("cu").alias("c"), F.col("cv").alias("parent"), "rank", "q").unionByName(out.select("chrom", F.col("cv").alias("c"), F.col("cu").alias("parent"), "rank", "q"))
        best = stored(both.groupBy("chrom", "c").agg(F.max_by(F.struct("parent", "q"), "rank").alias("b")).select("chrom", "c", "b.*"), "best")
        if best.limit(1).count() == 0:
            dropped(best)
            break
        # two components that chose each other: the earlier one stays as their root
        back = best.select("chrom", F.col("c").alias("parent"), F.col("parent").alias("_back"))
        hooks = best.join(back, ["chrom", "parent"], "left")
        stays = (F.col("_back") == F.col("c")) & (F.col("c") < F.col("parent"))
        hooks = hooks.select("chrom", "c", F.when(F.coalesce(stays, F.lit(False)), F.col("c")).otherwise(F.col("parent")).alias("parent"), F.when(F.coalesce(stays, F.lit(False)), 0).otherwise(F.col("q")).alias("q"))
        roots = _rooted(hooks)
        after = stored(nodes.join(roots, ["chrom", "c"], "left").select("chrom", "pos0", F.coalesce("root", "c").alias("c"), F.coalesce(F.col("p").bitwiseXOR(F.col("q")), F.col("p")).alias("p")), "nodes")
        dropped(nodes, best, roots)
        nodes = after
    else:
        raise RuntimeError(f"the forest did not grow together in {most} rounds")
    first = nodes.groupBy("chrom", "c").agg(F.min("pos0").alias("_first"), F.min_by("p", "pos0").alias("_p"))
    return nodes.join(first, ["chrom", "c"]).select("chrom", "pos0", (F.col("_first") + 1).alias("ps"), F.col("p").bitwiseXOR(F.col("_p")).alias("phase"))
