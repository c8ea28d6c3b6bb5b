"""Column functions: genotype calls, allele frequencies, credible intervals, labels and text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b as double, null where b is not positive."""
    return F.when(b > 0, a.cast("double") / b.cast("double"))


def is_het(ad: Column, dp: Column, min_reads: int = 2, min_vaf: float = 0.1) -> Column:
    return (F.least(ad, dp - ad) >= min_reads) & F.coalesce(ratio(ad, dp).between(min_vaf, 1 - min_vaf), F.lit(False))


def genotype(ad: Column, dp: Column, min_het_reads: int = 2, min_vaf: float = 0.1, min_hom_dp: int = 10) -> Column:
    """0/1, then 1/1, then 0/0, else ./."""
    deep = dp >= min_hom_dp
    return F.when(is_het(ad, dp, min_het_reads, min_vaf), "0/1").when((ad == dp) & deep, "1/1").when((ad == 0) & deep, "0/0").otherwise("./.")


def phase_of(gt: Column) -> Column:
    """The second allele of a phased genotype: 0|1 gives 1."""
    return F.substring(gt, 3, 1).cast("tinyint")


def b_allele(phase: Column, ref: Column, alt: Column) -> Column:
    """Reads of the B haplotype: the reference where phase is 1, the alternative where it is 0."""
    return F.when(phase == 1, ref).otherwise(alt)


def beta_cdf(x: float, a: Column, b: Column) -> Column:
    """CDF at x of Beta(a, b) for positive whole a and b: the chance of a or more successes in a + b - 1 trials.

    Terms run in logarithms, so that depths of thousands do not underflow; the shorter tail is summed.
    """
    n = (a + b - 1).cast("long")
    step, start = F.log(F.lit(x / (1 - x))), F.log(F.lit(1 - x))

    def tail(count: Column, log_step: Column, log_start: Column) -> Column:
        """The chance of fewer than `count` successes."""
        zero = F.struct(F.lit(0.0).alias("s"), (n * log_start).alias("t"))
        add = lambda acc, j: F.struct((acc["s"] + F.exp(acc["t"])).alias("s"), (acc["t"] + F.log((n - j).cast("double")) - F.log((j + 1).cast("double")) + log_step).alias("t"))
        ks = F.when(count > 0, F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.aggregate(ks, zero, add, lambda acc: acc["s"])

    few = tail(a, step, start)  # fewer than a successes
    many = tail(b, -step, F.log(F.lit(x)))  # fewer than b failures
    return F.when(a <= b, 1 - few).otherwise(many)


def outside_interval(b: Column, a: Column, epsilon: float = 0.05, alpha: float = 0.05) -> tuple[Column, Column]:
    """Whether the central 1 - alpha interval of Beta(b + 1, a + 1) lies below or above [0.5 - epsilon, 0.5 + epsilon]."""
    below = beta_cdf(0.5 - epsilon, b + 1, a + 1) > 1 - alpha / 2
    above = beta_cdf(0.5 + epsilon, b + 1, a + 1) < alpha / 2
    return below, above


def het_balanced(ref: Column, alt: Column, gamma: float = 0.05) -> Column:
    """Whether 0.5 lies in the central interval of mass 1 - gamma of Beta(ref + 1, alt + 1)."""
    return beta_cdf(0.5, ref + 1, alt + 1).between(gamma / 2, 1 - gamma / 2)


def haldane(distance: Column, nu: float = 1.0, least: float = 1e-6) -> Column:
    """Switch probability of a map distance, as (1 - exp(-2 nu d)) / 2 and at least `least`."""
    return F.greatest(F.lit(least), (1 - F.exp(-2 * nu * distance)) / 2)


def simplify_label(label: Column) -> Column:
    """T labels without an underscore are tumor, with one what follows its first; null is normal; others stay."""
    at = F.instr(label, "_")
    rest = F.substr(label, at + 1)
    return F.when(label.isNull(), "normal").when(label.startswith("T") & (at == 0), "tumor").when(label.startswith("T"), rest).otherwise(label)


def info_map(info: Column) -> Column:
    """k=v;flag as a map; a flag is 'true'."""
    return F.transform_values(F.str_to_map(info, F.lit(";"), F.lit("=")), lambda k, v: F.coalesce(v, F.lit("true")))


def format_map(fmt: Column, sample: Column) -> Column:
    """FORMAT keys with the sample's values."""
    return F.map_from_arrays(F.split(fmt, ":"), F.split(sample, ":"))


def range_id(chrom: Column, start: Column, stop: Column) -> Column:
    return F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), stop.cast("string"))


def dot_size(n: Column, base: float = 4.0, low: float = 0.5, high: float = 10.0, points: float = 5000.0) -> Column:
    """A marker size that falls with the number of points: `base` at `points` of them, within [low, high]."""
    return F.when(n <= 0, F.lit(base)).otherwise(F.greatest(F.lit(low), F.least(F.lit(high), F.lit(base * points) / F.greatest(n, F.lit(1)))))
