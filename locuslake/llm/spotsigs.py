"""Document fingerprints (7): SpotSigs, in DataFrame operations only.

A spot is a chain of two content words that follows an anchor: one of the common words of the languages at
hand, or the start of the text. A text's fingerprint is the set of its spots' 64-bit hashes, in order. Fingerprints are partitioned by
their number of spots, so that likely pairs lie in one partition or the next, and compared by Jaccard
similarity. `similar` finds the pairs at a threshold in all documents: there it is only worked out where the partitions and the
numbers of spots allow the threshold. The query compares stated pairs and gives their exact likeness, however small: it leaves out
only what cannot share a spot (a set is empty).

Defined cases: a null text is empty and an empty text has no spots (fingerprint ""); two fingerprints without
spots are alike (1.0), one without and one with are not (0.0); rows with one doc_id
follow each other by the hash of their text; a null doc_id comes last; repeated rows follow each other; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Common words that anchor a chain, by language.
ANCHORS = (
    "the of and to in a is that it was for on with as are be this by an at or from not have but",
    "le la les de des du et un une en est que qui dans pour par sur au aux ne pas ce il elle",
    "der die das und von ist nicht den dem ein eine mit zu im für auf sich des auch es als",
    "el los las y una por con del se su para como no más lo al que",
)
MARK = "\x01"


@dataclass(frozen=True)
class Params:
    anchors: tuple[str, ...] = ANCHORS
    rows_per_bucket: int = 2000
    tau: float = 0.8  # between the lengths of two partitions
    broadcast_ranges: int = 100_000  # ranges whose bounds may be broadcast (a few MB); more are joined by shuffle


def spots(text: Column, p: Params = Params()) -> Column:
    """The words of a text, those after an anchor marked."""
    words = sorted({w for line in p.anchors for w in line.split()}, key=lambda w: (-len(w), w))
    anchor = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(words)})(?:[^\p{{L}}\p{{N}}]++|$)"
    marked = F.regexp_replace(F.lower(text), anchor, MARK)
    return F.filter(F.split(marked, rf"[^\p{{L}}\p{{N}}{MARK}]+"), lambda x: F.ltrim(x, F.lit(MARK)) != "")


def chains(words: Column) -> Column:
    """The spots (sorted distinct array<long>) of marked words; words must be a column of its own, since each chain looks one word ahead."""
    bare = lambda x: F.ltrim(x, F.lit(MARK))
    made = F.transform(words, lambda x, i: F.when((i == 0) | x.startswith(MARK), F.xxhash64(bare(x), bare(F.coalesce(F.get(words, i + 1), F.lit(""))))))
    return F.array_sort(F.array_distinct(F.filter(made, lambda h: h.isNotNull())))


def with_spots(df: DataFrame, text: str, out: str, p: Params = Params()) -> DataFrame:
    return df.withColumn("_words", spots(F.col(text), p)).withColumn(out, chains(F.col("_words"))).drop("_words")


def fingerprint(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda x: F.lower(F.hex(x))), " ")


def partition_of(s: Column, tau: float = 0.8) -> Column:
    """The partition of a number of spots; of two sets at likeness tau or more, equal or next to each other."""
    return F.floor(F.log(F.greatest(F.size(s), F.lit(1)).cast("double")) / F.lit(-math.log(tau))).cast("int")


def likeness(a: Column, b: Column, floor: float = 0.0, tau: float = 0.8) -> Column:
    """Jaccard similarity of two spot sets, pruned: 0 without working it out where their partitions or their sizes
    put it below `floor`, and 0 where it is below."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    exact = both / (F.size(a) + F.size(b) - both)
    out = F.when(large == 0, F.lit(1.0)).when(small == 0, F.lit(0.0))
    if floor > 0:
        steps = math.floor(math.log(floor) / math.log(tau)) + 1
        out = out.when(F.abs(partition_of(a, tau) - partition_of(b, tau)) > steps, F.lit(0.0)).when(small < large * F.lit(floor), F.lit(0.0))
        exact = F.when(exact >= F.lit(floor - 1e-9), exact).otherwise(F.lit(0.0))
    return out.otherwise(exact)


def similar(docs: DataFrame, tau: float = 0.8, p: Params = Params()) -> DataFrame:
    """(a, b, likeness) of documents whose fingerprints are tau alike or more, between one document of each
    fingerprint; with copies of a fingerprint as (a, its smallest doc_id, 1.0).

    Candidates share one of the first spots in hash order: of n spots, tau-alike sets share one of the first
    n - ceil(tau n) + 1. A set meets the partitions of its own and of the next larger length.
    """
    d = with_spots(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "spots", p).where(F.size("spots") > 0)
    one = d.groupBy("spots").agg(F.min("doc_id").alias("doc_id"))
    first = F.expr(f"slice(spots, 1, cast(size(spots) - ceil({tau} * size(spots) - 1e-9) + 1 as int))")
    part = one.withColumn("part", partition_of(F.col("spots"), tau))
    index = part.select("doc_id", "part", F.size("spots").alias("n"), F.explode(first).alias("spot"))
    probe = index.withColumn("part", F.explode(F.array("part", F.col("part") + 1)))
    x, y = probe.alias("x"), index.alias("y")
    ordered = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.doc_id") < F.col("y.doc_id")))
    pairs = x.join(y, (F.col("x.spot") == F.col("y.spot")) & (F.col("x.part") == F.col("y.part")) & ordered & (F.col("x.n") >= F.col("y.n") * tau - 1e-9)).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()
    left, right = one.select(F.col("doc_id").alias("a"), F.col("spots").alias("sa")), one.select(F.col("doc_id").alias("b"), F.col("spots").alias("sb"))
    near = pairs.join(left, "a").join(right, "b").withColumn("likeness", likeness(F.col("sa"), F.col("sb"), tau, tau)).where(F.col("likeness") >= tau - 1e-9)
    copies = d.join(one.withColumnRenamed("doc_id", "b"), "spots").where("doc_id != b").select(F.col("doc_id").alias("a"), "b", F.lit(1.0).alias("likeness"))
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness").unionByName(copies)


def followed(docs: DataFrame, columns: list[str], p: Params = Params()) -> DataFrame:
    """Each row of docs with `next_<column>` of the document after it by descending doc_id; the first follows the last.

    Rows are dealt into ranges of doc_id, by at most 64 quantiles and evenly between two of them; a doc_id that fills
    more than one quantile is dealt further by the hash of its texts. Each range gets a copy of the first row of the
    next one; so no task orders the whole table.
    """
    docs = docs.withColumn("_h", F.xxhash64("text"))
    n = docs.count()
    ranges = max(1, -(-n // p.rows_per_bucket))
    coarse = min(64, ranges)
    fine = -(-ranges // coarse)
    ends = docs.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), F.percentile_approx("doc_id", [(k + 1) / coarse for k in range(coarse)], 100 * coarse).alias("c")).first()
    none = F.expr("cast(array() as array<bigint>)")
    bucket, hot = F.lit(0).cast("long"), F.lit(False)
    if ends["a"] is not None and ranges > 1:
        quantiles = [int(c) for c in ends["c"]]
        cuts = sorted({c for c in quantiles if c < ends["z"]})
        lows, highs = F.array(*map(F.lit, [int(ends["a"]), *cuts])), F.array(*map(F.lit, [*cuts, int(ends["z"])]))
        at = F.array_size(F.filter(F.array(*map(F.lit, cuts)) if cuts else none, lambda c: c < F.col("doc_id")))
        low, high = F.get(lows, at).cast("double"), F.get(highs, at).cast("double")
        share = (F.col("doc_id") - low) / (high - low + 1)
        bucket = F.coalesce(at.cast("long") * fine + F.least(F.lit(fine - 1), F.floor(share * fine)).cast("long") + 1, F.lit(0).cast("long"))
        often = sorted({c for c, d in zip(quantiles, quantiles[1:], strict=False) if c == d})  # each is the last of its quantile
        hot = F.coalesce(F.col("doc_id").isin(often), F.lit(False)) if often else hot
    # ranges rise with doc_id and, of one doc_id, fall with the hash: a hot doc_id stands above the others of its bucket
    unit = F.pmod("_h", F.lit(1 << 40)) / F.lit(float(1 << 40))
    docs = docs.withColumn("_u", unit)
    d = docs.withColumn("_range", bucket * (ranges + 1) + F.when(hot, ranges - F.floor(F.col("_u") * ranges)).otherwise(0))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("less"), "_u", "_h")).alias("f")
    heads = d.groupBy("_range").agg(first).select("_range", (-F.col("f.less")).alias("_head"), F.col("f._h").alias("_head_h"), F.floor(F.col("_range") / 1024).alias("_group"))
    # the range above each: within groups of ranges, then from group to group
    groups = heads.groupBy("_group").agg(F.min("_range").alias("_low"))
    groups = groups.select("_group", F.coalesce(F.lead("_low").over(W.orderBy("_group")), F.min("_low").over(W.partitionBy())).alias("_above"))
    heads = heads.join(groups, "_group").select("_head", "_head_h", F.coalesce(F.lead("_range").over(W.partitionBy("_group").orderBy("_range")), F.col("_above")).alias("_to"))
    if ranges <= p.broadcast_ranges:
        heads = F.broadcast(heads)
    extra = docs.join(heads, F.col("doc_id").eqNullSafe(F.col("_head")) & (F.col("_h") == F.col("_head_h"))).withColumn("_range", F.col("_to")).drop("_head", "_head_h", "_to").dropDuplicates(["_range"])
    both = d.withColumn("_copy", F.lit(False)).unionByName(extra.withColumn("_copy", F.lit(True)))
    w = W.partitionBy("_range").orderBy("_copy", F.col("doc_id").desc_nulls_last(), "_u", "_h", "text")
    for c in columns:
        both = both.withColumn(f"next_{c}", F.lead(c).over(w))
    return both.where(~F.col("_copy")).drop("_copy", "_range", "_h", "_u")


def op7_spotsigs(docs: DataFrame, p: Params = Params()) -> DataFrame:
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = followed(with_spots(d, "text", "spots", p), ["text", "spots"], p)
    d = d.withColumn("n_chars", F.length("text").cast("long")).withColumn("_k", F.floor(F.col("n_chars") / 3).cast("int"))
    kept = F.substr("text", F.lit(1), (F.col("n_chars") - F.col("_k")).cast("int"))
    d = d.withColumn("edited", F.concat(kept, F.substr("next_text", F.lit(1), F.col("_k")))).drop("text", "next_text")
    d = with_spots(d, "edited", "edited_spots", p)
    return d.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("spots")).alias("fingerprint"), fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"), likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
        partition_of(F.col("spots"), p.tau).alias("length_partition"))
