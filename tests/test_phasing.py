"""Phase sets against a plain forest on small graphs, planted haplotypes, contradictions and odd rows."""

import random

import pytest

from locuslake.operators import phasing

SCHEMA = "read_id string, chrom string, pos0 long, allele int"


def plain(rows):
    """{(chrom, pos0): (ps, phase)}: links heaviest first into a forest with sides."""
    alleles: dict = {}
    for read, chrom, pos, a in rows:
        if None not in (read, chrom, pos) and a in (0, 1):
            alleles.setdefault((read, chrom), {}).setdefault(pos, set()).add(a)
    votes: dict = {}
    for (_, chrom), by in alleles.items():
        at = sorted((p, next(iter(a))) for p, a in by.items() if len(a) == 1)
        for (u, a), (v, b) in zip(at, at[1:]):
            votes[chrom, u, v] = votes.get((chrom, u, v), 0) + (1 if a == b else -1)
    links = sorted(((-abs(w), u, v, c, w < 0) for (c, u, v), w in votes.items() if w), key=lambda x: x[:3])
    comp: dict = {}
    for _, u, v, c, side in links:
        for x in (u, v):
            comp.setdefault((c, x), {(c, x): 0})
        a, b = comp[c, u], comp[c, v]
        if a is not b:
            turn = a[c, u] ^ b[c, v] ^ side
            a.update({k: p ^ turn for k, p in b.items()})
            for k in b:
                comp[k] = a
    return {k: (min(p for _, p in m) + 1, int(m[k] ^ m[k[0], min(p for _, p in m)])) for k, m in comp.items()}


def found(spark, rows):
    d = spark.createDataFrame([(*r, "own") for r in rows], SCHEMA + ", ps string").repartition(3)
    return {(r["chrom"], r["pos0"]): (r["ps"], r["phase"]) for r in phasing.phased(d).collect()}


@pytest.mark.parametrize("noise", [0.0, 0.25])
def test_phase_sets_equal_a_plain_forest(spark, noise):
    rng, rows = random.Random(noise), []
    hap = {(c, p): rng.randint(0, 1) for c in ("chr1", "chr2") for p in rng.sample(range(2000), 60)}
    for k in range(160):
        c, a = rng.choice(["chr1", "chr2"]), rng.randint(0, 1900)
        side = rng.randint(0, 1)
        rows += [(f"r{k}", c, p, h ^ side ^ (rng.random() < noise)) for (cc, p), h in hap.items() if cc == c and a <= p < a + 90]
    rows += [("r0", None, 5, 1), (None, "chr1", 5, 1), ("r1", "chr1", None, 1), ("r2", "chr1", 7, None), ("r3", "chr1", 9, 2), ("alone", "chr3", 4, 1)]
    rows += [("twice", "chr3", 4, 0), ("twice", "chr3", 4, 1), ("twice", "chr3", 8, 1), ("e1", "chr3", 20, 0), ("e1", "chr3", 30, 0), ("e2", "chr3", 20, 0), ("e2", "chr3", 30, 1)]
    got = found(spark, rows)
    assert got == plain(rows) and len(got) > 60
    if not noise:
        for (c, p), (ps, phase) in got.items():
            assert phase == hap[c, p] ^ hap[c, ps - 1]


def test_long_chains_and_empty_tables(spark):
    rows = [(f"r{k}", "chr1", p, (p % 3 == 0) ^ (k % 2)) for k in range(120) for p in (k, k + 1)]
    got = found(spark, rows)
    assert len(got) == 121 and {ps for ps, _ in got.values()} == {1} and all(phase == ((p % 3 == 0) ^ True) for (_, p), (_, phase) in got.items())
    assert phasing.phased(spark.createDataFrame([], SCHEMA)).count() == 0
