"""Mixing sources to target weights (8): Efraimidis-Spirakis sampling, in DataFrame operations only.

A source's target comes from its weight and is filled with complete epochs first; the rest of it is a
fractional epoch. In it each document draws the exponential key -ln(u) / w, with u from a hash of doc_id and text and
w its quality weight; documents are taken by ascending key until the words are used up, the last one
in part. The running sums are two-level, over buckets of keys and within a bucket, so that no task sorts a
source whole, however large.

Defined cases: a null or text without words has size 0 and takes 0; a null source is a source of its own, the
last by order; rows that share a doc_id or have none draw by their texts, and only rows equal in both draw the same key; an empty table
returns no rows; without labels all quality weights are 1.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake.llm.shared import written

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Params:
    cycle: int = 3  # sources weigh 1 .. cycle, repeating
    most: int = 3  # times a source's size that its target stops at
    good: float = 2.0  # quality weights of labels.quality 1, 0 and none
    bad: float = 0.5
    unknown: float = 1.0
    rows_per_bucket: int = 2_000
    seed: str = "mix"


def targets(sources: DataFrame, p: Params = Params()) -> DataFrame:
    """(source, source_size, target): weights by the order of source, and the level at which the uncapped share the rest.

    `sources` has a row for each source. Sources stop at their cap in the order of cap over weight; the
    level is what remains for the others, over their weight, at the first source that it does not cap.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    s = sources.withColumn("weight", (1 + F.pmod(F.row_number().over(order) - 1, F.lit(p.cycle))).cast("double"))
    s = s.withColumn("cap", F.col("source_size") * float(p.most))
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(0, W.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    s = s.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(W.partitionBy())["level"])
    return s.select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def unit(p: Params, *columns: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5 of the columns' text."""
    text = F.concat_ws("|", F.lit(p.seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def sizes(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def mix(docs: DataFrame, labels: DataFrame | None = None, p: Params = Params()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, _text) of each row of docs, _text the digest of its text."""
    d = sizes(docs.select("doc_id", "source", "text")).withColumn("_text", digest(F.col("text"))).drop("text")
    weight = F.lit(p.unknown)
    if labels is not None:
        known = labels.where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("_q"))
        d = d.join(known, "doc_id", "left")
        weight = F.when(F.col("_q") == 1, F.lit(p.good)).when(F.col("_q") == 0, F.lit(p.bad)).otherwise(weight)
    d = d.select("doc_id", "source", "size", "_text", (-F.log(unit(p, F.col("doc_id"), F.col("_text"))) / weight).alias("key"))
    d = written(d, "keys")  # texts are read once; what follows works on four small columns
    # buckets of about equal share, in the order of the keys; their number follows the rows of the largest source
    per = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    goal = per.select(F.col("source").alias("_s"), F.greatest(F.lit(1), F.ceil(F.col("rows") / p.rows_per_bucket)).alias("buckets")).join(
        targets(per.select("source", "source_size"), p), F.col("_s").eqNullSafe(F.col("source"))).drop("source")
    d = d.join(goal, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    d = d.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    d = d.withColumn("budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    share = 1 - F.exp(-F.col("key"))
    d = d.withColumn("bucket", F.least(F.col("buckets") - 1, F.floor(F.col("buckets") * share)).cast("long"))
    inner = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    steps = d.groupBy("source", "bucket").agg(F.sum("size").alias("step"))
    outer = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    steps = steps.select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), F.coalesce(F.sum("step").over(outer), F.lit(0)).alias("ahead"))
    d = d.join(steps, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("ahead") - F.col("inside")))
    return d.select("doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"), "_text")


def op8_mixing(docs: DataFrame, labels: DataFrame | None = None, p: Params = Params()) -> DataFrame:
    return mix(docs, labels, p).drop("source", "_text")


def mixed(docs: DataFrame, labels: DataFrame | None = None, p: Params = Params()) -> DataFrame:
    """The mix itself: each row of docs as often as its complete epochs, and once more where the fractional
    epoch takes it; a document taken in part keeps its first words. Columns as they came, n_chars (where there
    is one) the new length.

    Rows meet their share by doc_id, source and text. Rows equal in all three share what they take together: they are
    numbered and filled one after the other, as `mix` does.
    """
    names = docs.columns
    key = lambda text: F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("source"), F.lit("")), text)
    share = mix(docs, labels, p).groupBy("doc_id", "source", "_text").agg(F.sum("taken").alias("_all"), F.count("*").alias("_rows")).where("_all > 0")
    share = share.select(key(F.col("_text")).alias("_key"), F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("_text").alias("_t"), "_all", "_rows")
    d = sizes(docs.drop("size")).withColumnRenamed("size", "_n") if "size" not in names else sizes(docs.withColumnRenamed("size", "_own")).withColumnRenamed("size", "_n").withColumnRenamed("_own", "size")
    d = d.withColumn("_digest", digest(F.col("text")))
    d = d.withColumn("_key", key(F.col("_digest")))
    same = d["doc_id"].eqNullSafe(share["_d"]) & d["source"].eqNullSafe(share["_s"]) & (d["_digest"] == share["_t"])
    d = d.join(share, (d["_key"] == share["_key"]) & F.when(same, F.lit(True)).otherwise(F.lit(False))).drop(share["_key"])  # dealt by _key alone
    # the join leaves equal rows together: numbering them moves nothing
    place = F.row_number().over(W.partitionBy("_key", "_d", "_s", "_t").orderBy(F.lit(0))) - 1
    base = F.expr("_all div (_rows * _n) * _n")
    d = d.withColumn("_place", place).withColumn("_taken", base + F.greatest(F.lit(0), F.least(F.col("_n"), F.col("_all") - F.col("_rows") * base - F.col("_place") * F.col("_n"))))
    d = d.where("_taken > 0").withColumn("_part", F.col("_taken") % F.col("_n"))
    copies = F.expr("sequence(1, cast(_taken div _n + if(_part > 0, 1, 0) as int))")
    d = d.withColumn("_copy", F.explode(copies))
    cut = (F.col("_copy") > F.expr("_taken div _n")) & (F.col("_part") > 0)
    edges = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # a piece: white space, then a word
    head = F.array_join(F.slice(edges, F.lit(1), F.col("_part").cast("int")), "")
    d = d.withColumn("text", F.when(cut, head).otherwise(F.col("text")))
    if "n_chars" in names:
        d = d.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return d.select(*names)


ORACLE = r"""
with labelled as (select doc_id, max(quality) q from labels where quality is not null group by doc_id),
d as (select doc_id, source, md5(coalesce(text, '')) as digest, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
k as (select d.*, -ln((('0x' || substr(md5('mix|' || coalesce(d.doc_id::varchar, '') || '|' || digest), 1, 13))::bigint + 0.5::double) / 4503599627370496::double)
        / case when q = 1 then 2.0::double when q = 0 then 0.5::double else 1.0::double end as key from d left join labelled using (doc_id)),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, (1 + (row_number() over (order by source nulls last) - 1) % 3)::double as weight, source_size * 3.0::double as cap from s),
l as (select *, ((sum(source_size) over ())::double - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
        / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level from w),
level as (select level from l where level * weight <= cap order by cap / weight, level limit 1),
t as (select source, source_size, least(cap, (select level from level) * weight) as target from l),
e as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from t),
r as (select k.*, source_size, target, epochs, round(target - epochs * source_size)::bigint as budget,
        coalesce(sum(size) over (partition by k.source order by key, k.doc_id, size rows between unbounded preceding and 1 preceding), 0) as ahead
      from k join e on k.source is not distinct from e.source)
select doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - ahead)))::bigint as taken from r
"""
