"""Aligned reads: barcodes rewritten, bases seen at sites, genotypes from their qualities.

Log likelihoods are kept in whole millionths, one rounded number for each quality, so that sums do not depend on the order in which partitions are added.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuslake.operators.features import remapped
from locuslake.operators.intervals import points_in_intervals

BUCKET = 1 << 10  # for blocks of short reads
MILLION = 1_000_000
STEP = re.compile("([0-9]+)([MIDNSHP=X])")
# fixed values of the format: reads without a place, secondary ones, failed ones, duplicates
LEFT_OUT = 0x4 | 0x100 | 0x200 | 0x400


def tag(name: str, tags: str = "tags") -> Column:
    """The text of a read's first tag of that name, null without one."""
    return F.regexp_extract(F.get(F.filter(tags, lambda t: t.startswith(f"{name}:")), F.lit(0)), "(?s)^..:.:(.*)$", 1)


def rebarcoded(reads: DataFrame, mapping: DataFrame, order: str = "row_id", name: str = "CB") -> DataFrame:
    """reads with the barcode in their tag replaced by its target in mapping (src, tgt, order); of several targets the last by `order`.

    Reads without the tag, without a target or with a null one go. The other tags and the places of all stay.
    """
    held = reads.select(F.struct(*reads.columns).alias("_read"), tag(name).alias("barcode"))
    new = remapped(held, mapping.select("src", "tgt", order), order).where("barcode is not null")
    put = F.transform("_read.tags", lambda t: F.when(t.startswith(f"{name}:"), F.concat(F.lit(f"{name}:Z:"), "barcode")).otherwise(t))
    return new.withColumn("_tags", put).select(*[F.col("_tags").alias(c) if c == "tags" else F.col("_read")[c].alias(c) for c in reads.columns])


def barcode_accounting(reads: DataFrame, mapping: DataFrame, name: str = "CB") -> DataFrame:
    """One row: reads in all, without the tag, with one that has no target, and kept."""
    known = mapping.groupBy("src").agg(F.max(F.col("tgt").isNotNull()).alias("_known"))
    per = reads.groupBy(tag(name).alias("src")).agg(F.count("*").alias("_n")).join(known, "src", "left")
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0))
    there, hit = F.col("src").isNotNull(), F.coalesce("_known", F.lit(False))
    return per.agg(total(F.lit(True)).alias("processed"), total(~there).alias("missing"), total(there & ~hit).alias("unlisted"), total(hit).alias("kept"))


def blocks(reads: DataFrame, keep: list[str]) -> DataFrame:
    """(chrom, start, stop, seq, qual, *keep): a row for each run of bases that lie on the reference without a gap, with the bases and qualities of this run.

    Reads without a place, cigar or bases have none.
    """
    d = reads.where("chrom is not null and pos0 is not null and cigar is not null and seq is not null").select("chrom", "pos0", "cigar", "seq", "qual", F.struct(*keep).alias("kept"))
    fields = "chrom string, start long, stop long, seq string, qual string"
    kept = d.schema["kept"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols, from_, starts, stops, seqs, quals = batch.select(["pos0", "cigar", "seq", "qual"]).to_pydict(), [], [], [], [], []
            for k, (at, cigar, seq, qual) in enumerate(zip(*cols.values(), strict=True)):
                u = 0
                for n, step in STEP.findall(cigar):
                    n = int(n)
                    if step in "M=X":
                        from_.append(k)
                        starts.append(at)
                        stops.append(at + n)
                        seqs.append(seq[u : u + n])
                        quals.append(None if qual is None else qual[u : u + n])
                    at += n * (step in "MDN=X")
                    u += n * (step in "MIS=X")
            take = pa.array(from_, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["chrom"].take(take), pa.array(starts, pa.int64()), pa.array(stops, pa.int64()), pa.array(seqs, pa.string()), pa.array(quals, pa.string()), batch["kept"].take(take)], ["chrom", "start", "stop", "seq", "qual", "kept"])

    return d.mapInArrow(run, f"{fields}, kept {kept}").select("chrom", "start", "stop", "seq", "qual", "kept.*")


def bases_at(reads: DataFrame, sites: DataFrame, keep: list[str], min_mapq: int = 0, min_quality: int = 0, left_out: int = LEFT_OUT, once: bool = True, bucket: int = BUCKET) -> DataFrame:
    """(chrom, pos0, ref, alt, name, base, quality, *keep): the bases that reads show at sites (chrom, pos0, ref, alt).

    Reads with any flag of `left_out` or a mapping quality below `min_mapq` show none, nor do deleted bases. A base without quality has a null one, and stays
    only where `min_quality` is 0. once: of the two ends of a pair (one name) that lie over one site, the better base counts, and of equals the
    earlier letter; columns in `keep` are then part of the key, and reads without a name (null or ``*``) all count.
    """
    good = reads.where((F.coalesce("flag", F.lit(0)).bitwiseAND(left_out) == 0) & (F.coalesce("mapq", F.lit(0)) >= min_mapq))
    named = ["name", *[k for k in keep if k != "name"]]
    over = points_in_intervals(sites.select("chrom", "pos0", "ref", "alt"), blocks(good, named), ["start", "seq", "qual", *named], bucket=bucket)
    place = (F.col("pos0") - F.col("start") + 1).cast("int")
    seen = over.select("chrom", "pos0", "ref", "alt", *named, F.substr("seq", place, F.lit(1)).alias("base"), (F.ascii(F.substr("qual", place, F.lit(1))) - 33).alias("quality"))
    if min_quality > 0:
        seen = seen.where(F.col("quality") >= min_quality)
    if not once:
        return seen
    best = F.min(F.struct((-F.coalesce("quality", F.lit(-1))).alias("q"), F.col("base").alias("b"), F.col("quality").alias("quality")))
    has_name = F.coalesce(F.col("name") != "*", F.lit(False))
    pairs = seen.where(has_name).groupBy("chrom", "pos0", "ref", "alt", *named).agg(best.alias("_best"))
    pairs = pairs.select("chrom", "pos0", "ref", "alt", *named, F.col("_best.b").alias("base"), F.col("_best.quality").alias("quality"))
    return pairs.unionByName(seen.where(~has_name))


def likelihoods(bases: DataFrame, by: list[str], most: int = 60) -> DataFrame:
    """(chrom, pos0, ref, alt, *by, dp, ad, oth, l0, l1, l2): reads of both alleles, of the alternative, of others, and the log10 likelihoods of no, one and
    two alternative alleles in millionths.

    A base of quality q (at most `most`, at least 1) is wrong by 10^(-q/10), and then shows the other allele. Bases that show neither, or that have no quality, say nothing.
    """
    wrong = F.pow(F.lit(10.0), -F.least(F.greatest("quality", F.lit(1)), F.lit(most)) / 10.0)
    right_, wrong_ = (F.round(F.log10(x) * MILLION).cast("long") for x in (1 - wrong, wrong))
    half = F.round(F.log10(F.lit(0.5)) * MILLION).cast("long")
    is_ref, is_alt = F.col("base") == F.col("ref"), F.col("base") == F.col("alt")
    counts = F.col("quality").isNotNull()
    total = lambda of_ref, of_alt: F.coalesce(F.sum(F.when(counts & is_ref, of_ref).when(counts & is_alt, of_alt)), F.lit(0))
    # qualities first, so that a deep site meets as few partial sums
    return bases.groupBy("chrom", "pos0", "ref", "alt", *by).agg(
        F.count_if(is_ref | is_alt).alias("dp"), F.count_if(is_alt).alias("ad"), F.count_if(~(is_ref | is_alt)).alias("oth"),
        total(right_, wrong_).alias("l0"), total(half, half).alias("l1"), total(wrong_, right_).alias("l2"))


def frequencies(sizes: np.ndarray, l0: np.ndarray, l1: np.ndarray, l2: np.ndarray, rounds: int, least: float) -> np.ndarray:
    """The alternative's frequency of each site by expectation and maximisation; a site has the next `sizes` of the likelihoods. A round adds a site's samples in their order."""
    first = np.cumsum(sizes) - sizes
    f = np.full(len(sizes), 0.5)
    for _ in range(rounds):
        total = np.zeros(len(sizes))
        for j in range(int(sizes.max(initial=0))):
            has = np.flatnonzero(sizes > j)
            at, g = first[has] + j, f[has]
            p1, p2 = 2 * g * (1 - g) * l1[at], g * g * l2[at]
            total[has] += (p1 + 2 * p2) / (2 * ((1 - g) * (1 - g) * l0[at] + p1 + p2))
        f = np.minimum(np.maximum(total / sizes, least), 1 - least)
    return f


def genotyped(scored: DataFrame, rounds: int = 20, least: float = 1e-4) -> DataFrame:
    """likelihoods() of samples with af, qual, gt, gq and pl: the alternative's frequency by expectation and maximisation over the site's samples, starting at a half.

    Genotypes follow Hardy and Weinberg at that frequency, kept within `least` of 0 and 1. gt is the likeliest, of equals the one with fewer
    alternatives, and ./. without a read of either allele; gq and qual are Phred scores, to two digits and at most 999, of gt being wrong and of no sample
    carrying the alternative; pl are Phred likelihoods less their smallest. A site's samples (rows of a sample sheet, not cells) meet in one row.
    """
    keys = ["chrom", "pos0", "ref", "alt"]
    scale = lambda x, top: F.pow(F.lit(10.0), (x - top) / MILLION)
    top = F.greatest("l0", "l1", "l2")
    rest = [c for c in scored.columns if c not in keys]
    weighed = scored.select(*keys, F.struct(*[scale(F.col(c), top).alias(c) for c in ("l0", "l1", "l2")], F.struct(*rest).alias("row")).alias("_w"))
    site = weighed.groupBy(*keys).agg(F.sort_array(F.collect_list("_w")).alias("_ws"))

    @F.arrow_udf("double")
    def settled(l0: pa.Array, l1: pa.Array, l2: pa.Array) -> pa.Array:
        return pa.array(frequencies(np.diff(l0.offsets.to_numpy()), *(x.flatten().to_numpy(zero_copy_only=False) for x in (l0, l1, l2)), rounds, least))

    site = site.withColumn("af", settled("_ws.l0", "_ws.l1", "_ws.l2"))
    f = F.col("af")
    none = lambda x: (1 - f) * (1 - f) * x["l0"] / ((1 - f) * (1 - f) * x["l0"] + 2 * f * (1 - f) * x["l1"] + f * f * x["l2"])
    phred = lambda p: F.round(F.least(F.greatest(-10 * p, F.lit(0.0)), F.lit(999.0)), 2)
    site = site.withColumn("qual", phred(F.aggregate("_ws", F.lit(0.0), lambda a, x: a + F.log10(F.greatest(none(x), F.lit(1e-300))))))
    d = site.select(*keys, "af", "qual", F.explode("_ws").alias("_w")).select(*keys, "af", "qual", "_w", "_w.row.*")
    d = d.withColumns({"_p0": (1 - f) * (1 - f) * F.col("_w.l0"), "_p1": 2 * f * (1 - f) * F.col("_w.l1"), "_p2": f * f * F.col("_w.l2")})
    all_, most = F.col("_p0") + F.col("_p1") + F.col("_p2"), F.greatest("_p0", "_p1", "_p2")
    others = F.when(F.col("_p0") == most, F.col("_p1") + F.col("_p2")).when(F.col("_p1") == most, F.col("_p0") + F.col("_p2")).otherwise(F.col("_p0") + F.col("_p1"))
    call = F.when(F.col("dp") == 0, "./.").when(F.col("_p0") == most, "0/0").when(F.col("_p1") == most, "0/1").otherwise("1/1")
    pl = F.array(*[F.round((F.greatest("l0", "l1", "l2") - F.col(c)) * 10 / MILLION).cast("int") for c in ("l0", "l1", "l2")])
    out = d.withColumns({"gt": call, "gq": phred(F.log10(F.greatest(others / all_, F.lit(1e-300)))), "pl": pl})
    return out.select(*keys, *rest, "af", "qual", "gt", "gq", "pl")
