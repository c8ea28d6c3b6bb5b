"""Exact quantiles without a group in memory.

Spark's own `percentile` keeps every distinct value of a group in one task. Here a sketch of fixed size brackets each
quantile between two values whose ranks are sure to lie below and above it. A second pass counts what lies below the bracket and the
distinct values inside it, a share of about six over `accuracy` of the group. The value of the wanted rank is read off
their running counts, with linear interpolation between two neighbours. Both passes combine before the shuffle; the brackets are
stored between them, worked out at once.

Defined cases: nulls and NaN take no part; a group without values gives null; infinite values take part; ties, however many, are
one distinct value; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake.plans.tables import stored

ACCURACY = 1_000
SMALL = 1_000_000


def quantiles(d: DataFrame, by: list[str], wanted: dict[str, tuple[str | Column, float]], accuracy: int = ACCURACY, rows: int | None = None) -> DataFrame:
    """(*by, one column for each of `wanted`): the exact quantile of a value by group, as name: (value, share).

    `rows` says how many rows there are, where that is known; up to SMALL in all, a task can hold any group and one pass does.
    """
    names = [*wanted]
    values = [F.col(v) if isinstance(v, str) else v for v, _ in wanted.values()]
    fine = lambda x: F.when(~F.isnan(x.cast("double")), x.cast("double"))
    if rows is not None and rows <= SMALL:
        return d.groupBy(*by).agg(*[F.percentile(fine(v), s).alias(n) for n, v, (_, s) in zip(names, values, wanted.values(), strict=True)])
    # names of its own for the groups, so that they meet by null-safe equality
    keys = [f"_k{i}" for i in range(len(by))]
    narrow = d.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], *[fine(v).alias(f"_v{i}") for i, v in enumerate(values)])
    edge = 3 / accuracy  # the sketch may be off by one of these, and by a rank: that is another one where n > accuracy
    sketches = []
    for i, (_, share) in enumerate(wanted.values()):
        low, high = share - edge, share + edge
        at = F.percentile_approx(f"_v{i}", [max(low, 0.0), min(high, 1.0)], accuracy)
        many = F.count(f"_v{i}") > accuracy  # all values of a smaller group are in its bracket
        lo = F.when(many, at[0]).otherwise(float("-inf")) if low > 0 else F.lit(float("-inf"))
        hi = F.when(many, at[1]).otherwise(float("inf")) if high < 1 else F.lit(float("inf"))
        sketches.append(F.struct(F.count(f"_v{i}").alias("n"), lo.alias("lo"), hi.alias("hi")).alias(f"_s{i}"))
    brackets = narrow.groupBy(*keys).agg(*sketches).select(*[F.col(k).alias(f"_b{k}") for k in keys], *[f"_s{i}" for i in range(len(names))])
    if keys:
        brackets = stored(brackets, "brackets")  # Spark then knows how small they are: rows of few groups need not meet in a task for each group
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_b{k}"))
    met = narrow.join(brackets, same) if keys else narrow.crossJoin(F.broadcast(brackets))  # one row
    # a value inside its bracket counts by itself, one below it as null; rows that are alike in that are counted first, most of them lie in no bracket
    side = [F.when(F.col(f"_v{i}") < F.col(f"_s{i}.lo"), 0).when(F.col(f"_v{i}") <= F.col(f"_s{i}.hi"), 1).otherwise(2) for i in range(len(names))]
    alike = met.groupBy(*keys, *[x.alias(f"_t{i}") for i, x in enumerate(side)], *[F.when(x == 1, F.col(f"_v{i}")).alias(f"_w{i}") for i, x in enumerate(side)])
    alike = alike.agg(F.count("*").alias("_c"), *[F.max(f"_s{i}.n").alias(f"_n{i}") for i in range(len(names))])
    part = [F.when(F.col(f"_t{i}") < 2, F.struct(F.lit(i).alias("i"), F.col(f"_n{i}").alias("n"), F.col(f"_w{i}").alias("v"))) for i in range(len(names))]
    part.append(F.struct(F.lit(-1).alias("i"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("v")))  # every group is there, with values or without
    counted = alike.select(*keys, "_c", F.explode(F.filter(F.array(*part), lambda x: x.isNotNull())).alias("p")).groupBy(*keys, "p.i", "p.n", "p.v").agg(F.sum("_c").alias("c"))
    running = counted.withColumn("upto", F.sum("c").over(W.partitionBy(*keys, "i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)))
    share = F.get(F.array(*[F.lit(float(s)) for _, s in wanted.values()]), F.col("i"))
    place = (F.col("n") - 1) * share
    first = F.min(F.when(F.col("upto") > F.floor(place), F.struct("upto", F.col("v").isNull().alias("below"), "v")))
    second = F.min(F.when(F.col("upto") > F.ceil(place), F.struct("upto", F.col("v").isNull().alias("below"), "v")))
    at = F.max(place)
    found = running.groupBy(*keys, "i").agg(at.alias("at"), first.alias("a"), second.alias("b"))
    lost = F.col("a").isNull() | F.col("b").isNull() | F.col("a.below")
    a, b = F.col("a.v"), F.col("b.v")
    value = F.when(F.col("i") < 0, F.lit(None).cast("double")).when(lost, F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")).when(a == b, a).otherwise((F.ceil("at") - F.col("at")) * a + (F.col("at") - F.floor("at")) * b)
    one = found.withColumn("q", value).groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"_q{i}") for i in range(len(names))])
    return one.select(*[F.col(k).alias(c) for k, c in zip(keys, by, strict=True)], *[F.col(f"_q{i}").alias(n) for i, n in enumerate(names)])


def median(d: DataFrame, by: list[str], value: str | Column, out: str, rows: int | None = None) -> DataFrame:
    return quantiles(d, by, {out: (value, 0.5)}, rows=rows)
