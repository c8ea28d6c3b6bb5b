"""Barcodes of reads, bases at sites and genotypes from them, against plain loops."""

import math
import random
import re

import pytest

from locuslake.operators import alignments, counts, genotype
from locuslake.sources import bam

READS = bam.SCHEMA + ", sample_id string"


def read(name, pos, cigar, seq, qual="", flag=0, mapq=30, sample="a", chrom="c", tags=()):
    return (name, flag, chrom, pos, mapq, cigar, None, None, 0, seq, (qual or "I" * len(seq)) if seq and qual is not None else None, list(tags), sample)


def drawn(n, seed):
    rng, out = random.Random(seed), []
    for k in range(n):
        steps, length = [], 0
        for _ in range(rng.randint(1, 6)):
            steps.append(f"{rng.randint(1, 9)}{rng.choice('MMMIDNSHP=X')}")
        cigar = "".join(steps)
        length = sum(int(a) for a, s in re.findall("([0-9]+)(.)", cigar) if s in "MIS=X")
        seq = "".join(rng.choice("ACGT") for _ in range(length)) or None
        out.append(read(f"r{k // 2}" if k % 9 else rng.choice([None, "*"]), rng.randrange(60), cigar, seq, None if k % 11 == 0 else "".join(chr(33 + rng.randint(0, 40)) for _ in range(length)), rng.choice([0, 0, 0, 16, 4, 256, 1024]), rng.randint(0, 40), rng.choice("ab"), rng.choice("cd")))
    return out


def shown(row):
    """{position: (base, quality)} of one read, step by step."""
    at, u, out = row[3], 0, {}
    for n, step in re.findall("([0-9]+)(.)", row[5]):
        for _ in range(int(n)):
            if step in "M=X" and row[9]:
                out[at] = (row[9][u], None if row[10] is None else ord(row[10][u]) - 33)
            at += step in "MDN=X"
            u += step in "MIS=X"
    return out


SITES = [(c, p, *random.Random(p).sample("ACGT", 2)) for c in "cd" for p in range(0, 90, 2)]


@pytest.mark.parametrize("least, once", [(0, True), (12, True), (0, False)])
def test_bases_at_sites(spark, least, once):
    rows = drawn(600, 3)
    got = alignments.bases_at(spark.createDataFrame(rows, READS), spark.createDataFrame(SITES, "chrom string, pos0 long, ref string, alt string"), ["sample_id"], 5, least, once=once, bucket=8)
    want = []
    for r in rows:
        if r[1] & alignments.LEFT_OUT or r[4] < 5:
            continue
        there = shown(r)
        want += [(c, p, ref, alt, r[0], r[12], *there[p]) for c, p, ref, alt in SITES if c == r[2] and p in there and (not least or (there[p][1] or 0) >= least)]
    if once:
        best, rest = {}, [w for w in want if w[4] in (None, "*")]
        for w in want:
            if w[4] not in (None, "*"):
                key = (-(-1 if w[7] is None else w[7]), w[6])
                if w[:6] not in best or key < best[w[:6]][0]:
                    best[w[:6]] = (key, w)
        want = rest + [w for _, w in best.values()]
    assert len(want) > 500
    cols = ["chrom", "pos0", "ref", "alt", "name", "sample_id", "base", "quality"]
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(want, key=str)


def test_genotypes_follow_a_plain_loop(spark):
    rng, bases, planted = random.Random(5), [], {}
    for site in range(60):
        f = rng.choice([0.0, 0.1, 0.5, 1.0])
        for sample in range(6):
            g = (rng.random() < f) + (rng.random() < f)
            planted[site, str(sample)] = g
            for _ in range(rng.choice([0, 1, 30, 80])):
                q = rng.choice([0, 10, 30, 41, 93])
                true = rng.random() < g / 2
                seen = true != (rng.random() < 10 ** (-max(q, 1) / 10))
                bases.append(("c", site, "A", "C", str(sample), rng.choice("GT") if rng.random() < 0.02 else "AC"[seen], None if rng.random() < 0.02 else q))
    d = spark.createDataFrame(bases, "chrom string, pos0 long, ref string, alt string, sample_id string, base string, quality int")
    scored = alignments.likelihoods(d.repartition(7), ["sample_id"])
    assert scored.exceptAll(alignments.likelihoods(d.repartition(3), ["sample_id"])).count() == 0  # the same digits however rows are dealt
    got = {(r["pos0"], r["sample_id"]): r for r in alignments.genotyped(scored).collect()}

    like, depth = {}, {}
    for _, site, _, _, sample, base, q in bases:
        x = like.setdefault((site, sample), [0.0] * 3)
        depth[site, sample] = depth.get((site, sample), 0) + (base in "AC")
        if q is not None and base in "AC":
            e = 10 ** (-min(max(q, 1), 60) / 10)
            for k, p in enumerate([e, 0.5, 1 - e] if base == "C" else [1 - e, 0.5, e]):
                x[k] += math.log10(p)
    assert set(got) == set(like)
    for site in {s for s, _ in like}:
        mine = {k: [10 ** (v - max(x)) for v in x] for k, x in like.items() if k[0] == site}
        f, prior = 0.5, lambda f: [(1 - f) ** 2, 2 * f * (1 - f), f * f]
        for _ in range(20):
            post = [[a * b for a, b in zip(prior(f), x, strict=True)] for x in mine.values()]
            f = min(max(sum((p[1] + 2 * p[2]) / (2 * sum(p)) for p in post) / len(post), 1e-4), 1 - 1e-4)
        none = 0.0
        for key, x in mine.items():
            p = [a * b for a, b in zip(prior(f), x, strict=True)]
            k, r = p.index(max(p)), got[key]
            none += math.log10(max(p[0] / sum(p), 1e-300))
            assert r["af"] == pytest.approx(f, abs=1e-4)
            assert r["gt"] == ("./." if not depth[key] else ["0/0", "0/1", "1/1"][k])
            assert r["gq"] == pytest.approx(min(-10 * math.log10(max((sum(p) - p[k]) / sum(p), 1e-300)), 999), abs=0.1) or r["gq"] > 140
            assert min(r["pl"]) == 0 and r["pl"][k] <= 80
        assert all(r["qual"] == pytest.approx(min(-10 * none, 999), abs=0.1) for key, r in got.items() if key[0] == site)
    deep = [k for k in got if depth[k] >= 25]
    assert sum(got[k]["gt"] == ["0/0", "0/1", "1/1"][planted[k]] for k in deep) >= 0.97 * len(deep) > 50


def test_calls_meet_the_quality_filter(spark):
    rows = [("c", 1, "A", "C", "s", b, 30) for b in "CCCAAA"] + [("c", 2, "A", "C", "s", "A", 30)] * 6
    d = spark.createDataFrame(rows, "chrom string, pos0 long, ref string, alt string, sample_id string, base string, quality int")
    kept = genotype.quality(alignments.genotyped(alignments.likelihoods(d, ["sample_id"])), 20, 5).collect()
    assert [(r["pos0"], r["gt"], r["dp"], r["ad"]) for r in kept] == [(1, "0/1", 6, 3)]
    assert alignments.genotyped(alignments.likelihoods(d.where("false"), ["sample_id"])).count() == 0


def test_barcodes_are_rewritten(spark):
    reads = spark.createDataFrame([
        read("k", 1, "1M", "A", tags=["NM:i:1", "CB:Z:one", "UB:Z:x:y"]), read("l", 1, "1M", "A", tags=["CB:Z:two"]), read("m", 1, "1M", "A", tags=["UB:Z:q"]),
        read("n", 1, "1M", "A", tags=["CB:Z:three"]), read("o", 1, "1M", "A", tags=["CB:Z:four"]), (None,) * 13], READS)
    reads = reads.withColumnsRenamed({"sample_id": "barcode", "length": "src"})  # clashing names
    mapping = spark.createDataFrame([("one", "X", 1), ("one", "Y", 2), ("two", "Z", 3), ("four", None, 4), (None, "W", 5)], "src string, tgt string, row_id int")
    got = alignments.rebarcoded(reads, mapping)
    assert got.columns == reads.columns
    assert {r["name"]: r["tags"] for r in got.collect()} == {"k": ["NM:i:1", "CB:Z:Y", "UB:Z:x:y"], "l": ["CB:Z:Z"]}
    assert tuple(alignments.barcode_accounting(reads, mapping).first()) == (6, 2, 2, 2)
    assert tuple(alignments.barcode_accounting(reads.where("false"), mapping).first()) == (0, 0, 0, 0)


def test_a_file_of_reads_feeds_the_pileup(spark, tmp_path):
    rows = [read(f"r{k}", 10 + k % 3, "4M", "ACGT", tags=[f"CB:Z:b{k % 2}", f"UB:Z:u{k // 2}"]) for k in range(8)]
    sizes = spark.createDataFrame([("c", 1, 100)], "chrom string, chrom_ord int, size long")
    bam.write(spark.createDataFrame(rows, READS), sizes, str(tmp_path / "x"))
    back = bam.read(spark, str(tmp_path / "x")).withColumns({"barcode": alignments.tag("CB"), "umi": alignments.tag("UB")})
    sites = spark.createDataFrame([("c", 12, "G", "C")], "chrom string, pos0 long, ref string, alt string")
    got = counts.pileup(alignments.bases_at(back, sites, ["barcode", "umi"])).collect()
    want = {}
    for k in range(8):
        base = "ACGT"[12 - 10 - k % 3]
        x = want.setdefault(f"b{k % 2}", [0, 0, 0])
        x[0], x[1], x[2] = x[0] + (base in "GC"), x[1] + (base == "C"), x[2] + (base not in "GC")
    assert {r["barcode"]: [r["dp"], r["ad"], r["oth"]] for r in got} == want
