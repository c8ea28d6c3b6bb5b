"""Block gzip and position indices: members, bins, ranges against a scan, what a reader touches."""

import gzip
import os
import random

import pytest

from locuslake.sources import bgzf, readers, writers


def test_members_are_gzip_and_know_their_length():
    rng = random.Random(0)
    text = [f"c\t{k}\t{'x' * rng.randint(0, 3000)}\n".encode() for k in range(400)] + [b"long" * 50_000 + b"\n", rng.randbytes(200_000).replace(b"\n", b"") + b"\n"]
    file = bgzf.File()
    data = b"".join(file.lines([(None, 0, b"#head\n"), *[(k, k + 1, line) for k, line in enumerate(text)]]))
    assert gzip.decompress(data) == b"#head\n" + b"".join(text) and data.endswith(bgzf.END)
    found = [*bgzf.members(data)]
    assert all(len(t) <= bgzf.MOST for _, t in found)
    assert sum(t.endswith(b"\n") for _, t in found) >= len(found) - 12  # cut at line borders, but for the long lines
    for at, _ in found[::5]:
        assert next(bgzf.members(data, at))[0] == at
    with pytest.raises(ValueError, match="member"):
        next(bgzf.members(data, 3))
    broken = bytearray(data)
    broken[found[1][0] - 6] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        [*bgzf.members(bytes(broken))]


def test_every_bin_of_a_row_is_asked_for():
    rng = random.Random(1)
    assert bgzf.bin_of(0, 1) == 4681 and bgzf.bin_of(0, 1 << 29) == 0 and bgzf.bin_of(1 << 14, (1 << 14) + 1) == 4682 and bgzf.bin_of((1 << 14) - 1, (1 << 14) + 1) == 585
    for _ in range(3000):
        a = rng.randrange(0, 1 << rng.randint(1, 29))
        z = a + rng.randint(1, 1 << rng.randint(0, 20))
        p = rng.randint(max(0, a - 5), z + 5)
        if p < z and p + 3 > a:
            assert bgzf.bin_of(p, p + 3) in bgzf.bins_over(a, z)


def test_ranges_equal_a_scan(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"chr{c}", c, p) for c in (1, 2, 10) for p in sorted(rng.choices(range(0, 3_000_000), k=1500)) + [5, 5, 5]]
    calls = spark.createDataFrame([(*r, f"id{k}", "A", "C", "DP=1;" + "y" * rng.randint(0, 400), "0/1") for k, r in enumerate(rows)] + [(None, 1, 1, "n", "A", "C", "", ""), ("chr1", 1, None, "n", "A", "C", "", "")], "chrom string, chrom_ord int, pos0 long, snp_id string, ref string, alt string, info string, gt string")
    sizes = spark.createDataFrame([("chr1", 1, 9_000_000), ("chr2", 2, 8_000_000), ("chr10", 10, 7_000_000)], "chrom string, chrom_ord int, size long")
    path = str(tmp_path / "v")
    made = writers.indexed_variants(calls, sizes, path, files=5).collect()
    assert sum(r["rows"] for r in made) == len(rows) and max(sum(r["chrom"] == c for r in made) for c in ("chr1", "chr2", "chr10")) > 1  # a chromosome is several files
    names = bgzf.files_of(path)
    assert sorted(os.path.relpath(n, path) for n in names) == sorted(r["name"] for r in made)
    for n in names:
        head = [line for line in gzip.open(n, "rt") if line.startswith("#")]
        assert head[0] == "##fileformat=VCFv4.2\n" and head[1:4] == [f"##contig=<ID=chr{c},length={s}>\n" for c, s in ((1, 9_000_000), (2, 8_000_000), (10, 7_000_000))] and head[-1].startswith("#CHROM")
    d = readers.vcf(spark, names)
    assert sorted((r["chrom"], r["pos0"]) for r in d.collect()) == sorted((c, p) for c, _, p in rows)
    for ranges in ([("chr2", 100_000, 130_000)], [("chr1", 0, 6), ("chr10", 2_999_000, 4_000_000), ("chr1", 4, 50_000)], [("chr1", 7_000_000, 8_000_000), ("chrX", 0, 9), ("chr1", 9, 9)], [("chr1", 0, 1 << 29)]):
        got = sorted((x[0], int(x[1]) - 1) for x in (r["value"].split("\t") for r in bgzf.lines_in(spark, path, ranges).collect()))
        assert got == sorted((c, p) for c, _, p in rows if any(c == k and a <= p < z for k, a, z in ranges))
    one = next(r for r in made if r["chrom"] == "chr2" and r["rows"] > 300)
    with open(f"{path}/{one['name']}.tbi", "rb") as f:
        parts = bgzf.places(f.read(), "chr2", one["first"], one["first"] + 10)
    assert parts and sum((z >> 16) - (a >> 16) for a, z in parts) < os.path.getsize(f"{path}/{one['name']}") / 2  # not the whole file
    empty = writers.indexed_variants(calls.where("false"), sizes, str(tmp_path / "none"))
    assert empty.count() == 0 and bgzf.lines_in(spark, str(tmp_path / "none"), [("chr1", 0, 9)]).count() == 0
