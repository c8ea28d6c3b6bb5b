"""Alignments in binary form: a plain parser of the whole file, cuts of every size, the index, odd records, damage."""

import gzip
import random
import struct

import numpy as np
import pytest
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

from locuslake.sources import bam, bgzf

SIZES = [("chr2", 1, 400_000), ("chr10", 2, 90_000), ("chrX", 3, 5_000)]


def made(n, seed=1):
    rng, rows = random.Random(seed), []
    for k in range(n):
        chrom, _, size = SIZES[rng.choice([0, 0, 0, 1, 2])]
        length = rng.choice([1, 2, 7, 50, 151])
        tags = [f"CB:Z:cell-{rng.randint(0, 40)}", f"NM:i:{rng.choice([0, -1, 200, -200, 40000, -40000, 3 * 10**9])}"]
        if k % 5 == 0:
            tags += ["XF:f:0.25", "XA:A:q", "XH:H:1AE3", "XB:B:s,-3,500", "XE:B:f,0.5,1.25", "XZ:Z:", "XC:B:C"]
        seq = "".join(rng.choice("ACGTN") for _ in range(length))
        cigar = f"{length}M" if length < 7 else f"2S{length - 5}M3D3I"
        qual = None if k % 7 == 0 else "".join(chr(33 + rng.randint(0, 60)) for _ in range(length))
        if k % 31 == 0:
            rows.append((f"u{k}", 4, None, None, 0, None, None, None, 0, seq, qual, tags[:1]))
        else:
            rows.append((f"r{k}", rng.choice([0, 16, 99]), chrom, rng.randrange(size), rng.randint(0, 60), cigar, chrom if k % 3 else None, k if k % 3 else None, k % 500 - 250, seq, qual, tags))
    return rows


def plain(row):
    return tuple(tuple(v) if isinstance(v, list) else v for v in row)


def sorted_(rows):
    return sorted(map(plain, rows), key=str)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path, rows = str(tmp_path_factory.mktemp("bam")), made(3000)
    sizes = spark.createDataFrame(SIZES, "chrom string, chrom_ord int, size long")
    bam.write(spark.createDataFrame(rows, bam.SCHEMA).repartition(3), sizes, path, 3, ["made here"])
    return path, rows


def by_hand(path):
    """(header text, [(chrom number, start, name, flag)]) by the plain words of the format, from the whole file as gzip."""
    data = gzip.decompress(open(path, "rb").read())
    assert data[:4] == b"BAM\1"
    (n,) = struct.unpack_from("<i", data, 4)
    text, at = data[8 : 8 + n].decode(), 8 + n
    (refs,), at = struct.unpack_from("<i", data, at), at + 4
    for _ in range(refs):
        at += 8 + struct.unpack_from("<i", data, at)[0]
    out = []
    while at < len(data):
        size, ref, pos = struct.unpack_from("<iii", data, at)
        length, flag = data[at + 12], struct.unpack_from("<H", data, at + 18)[0]
        out.append((ref, pos, data[at + 36 : at + 35 + length].decode(), flag))
        at += 4 + size
    assert at == len(data)
    return text, out


def test_what_is_written_is_read(spark, folder):
    path, rows = folder
    assert sorted_(bam.read(spark, path).collect()) == sorted_(rows)
    found = []
    for f in sorted(bam.listed(path, ".bam")):
        text, some = by_hand(f)
        assert text.startswith("@HD\tVN:1.6\tSO:coordinate\n@SQ\tSN:chr2\tLN:400000\n") and "@CO\tmade here\n" in text
        assert some == sorted(some, key=lambda r: (r[0] < 0, r[0], r[1]))
        found += some
    number = {c: k for k, (c, _, _) in enumerate(SIZES)} | {None: -1}
    assert sorted(found) == sorted((number[r[2]], -1 if r[3] is None else r[3], r[0], r[1]) for r in rows)


@pytest.mark.parametrize("size", [700, 5_000, 33_333])
def test_any_cut_gives_the_same_rows(spark, folder, size):
    path, rows = folder
    reader = bam.Reader({"path": path, "bytes": size})
    runs = reader.partitions()
    assert len(runs) > 3 * (size < 33_333)
    got = [r for run in runs for batch in reader.read(run) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
    assert sorted_(got) == sorted_(rows)


def test_cuts_where_records_run_over_members(spark, tmp_path):
    """Members that end anywhere, also within a record's length, and records longer than many members."""
    sizes, rows = [(c, s) for c, _, s in SIZES], made(400, 2)
    rows[7] = (*rows[7][:9], "ACGTA" * 30_000, None, rows[7][11])
    rows[9] = (*rows[9][:5], "1M1I" * 40_000, *rows[9][6:9], "AC" * 40_000, "II" * 40_000, rows[9][11])
    number = {c: k for k, (c, _) in enumerate(sizes)}
    data = bam.headed(sizes, []) + b"".join(bam.record_of(r, number)[3] for r in rows)
    for seed in range(3):
        rng, at, pieces = random.Random(seed), 0, []
        while at < len(data):
            n = rng.choice([1, 3, 40, 500, 4000, 60000])
            pieces.append(bgzf.member(data[at : at + n]))
            at += n
            if rng.random() < 0.1:
                pieces.append(bgzf.member(b""))
        (tmp_path / f"{seed}.bam").write_bytes(b"".join(pieces) + bgzf.END)
        for size in (900, 20_000):
            reader = bam.Reader({"path": str(tmp_path / f"{seed}.bam"), "bytes": size})
            got = [r for run in reader.partitions() for batch in reader.read(run) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            assert sorted_(got) == sorted_(rows)


def test_filters_read_the_index(spark, folder):
    path, rows = folder
    d = bam.read(spark, path).where("chrom = 'chr2' and pos0 >= 100000 and pos0 < 130000")
    want = [r for r in rows if r[2] == "chr2" and 100_000 <= r[3] < 130_000]
    assert want and sorted_(d.collect()) == sorted_(want)
    assert sorted_(bam.read(spark, path).where("chrom in ('chrX', 'none') and pos0 <= 2500").collect()) == sorted_(r for r in rows if r[2] == "chrX" and r[3] <= 2500)
    assert bam.read(spark, path).where("pos0 is null").count() == sum(r[3] is None for r in rows)

    def seen(*filters):
        reader = bam.Reader({"path": path})
        assert [*reader.pushFilters([*filters])] == [*filters]
        return sum(b.num_rows for run in reader.partitions() for b in reader.read(run))

    assert len(want) <= seen(EqualTo(("chrom",), "chr2"), GreaterThanOrEqual(("pos0",), 100_000), LessThan(("pos0",), 130_000)) < len(rows) / 4
    assert seen(EqualTo(("chrom",), "none")) == 0


def test_odd_rows(spark, tmp_path):
    number = {"c": 0}
    back = lambda row: bam.row_of(bam.record_of(row, number)[3][4:], ["c"])
    assert back((None, None, None, None, None, None, None, None, None, None, None, None)) == ("*", 0, None, None, 0, None, None, None, 0, None, None, [])
    assert back(("a", 0, "c", 5, 1, "3M", None, None, 0, "aQc", "!~I", ["XX:Z:a:b", "NM:i:07"]))[9:] == ("ANC", "!~I", ["XX:Z:a:b", "NM:i:7"])
    long = ("a", 0, "c", 5, 1, "1M1D" * 40_000, None, None, 0, "A" * 40_000, None, ["NM:i:1"])
    assert back(long) == long
    for bad in [("a", 0, "c", 1, 0, "2M", None, None, 0, "AC", "I", []), ("a", 0, "c", 1, 0, "2Q", None, None, 0, "AC", None, []), ("a", 0, "c", 1 << 29, 0, None, None, None, 0, None, None, []), ("a", 0, "c", 1, 0, None, None, None, 0, None, None, ["NM:i:99999999999"])]:
        with pytest.raises(ValueError):
            bam.record_of(bad, number)
    assert bam.tags_of(b"XXc\xff") == ["XX:i:-1"] and np.isclose(float(bam.tags_of(bam.packed_tag("XX:f:0.1"))[0][5:]), 0.1)


def test_empty_and_broken_files(spark, tmp_path):
    sizes = spark.createDataFrame(SIZES, "chrom string, chrom_ord int, size long")
    bam.write(spark.createDataFrame([], bam.SCHEMA), sizes, str(tmp_path / "none"))
    (tmp_path / "empty.bam").write_bytes(bgzf.member(bam.headed([("c", 9)], [])) + bgzf.END)
    assert bam.read(spark, str(tmp_path / "empty.bam")).count() == 0
    whole = bgzf.member(bam.headed([("c", 9)], []) + bam.record_of(made(2)[1], {c: 0 for c, _, _ in SIZES})[3][:-5])
    (tmp_path / "cut.bam").write_bytes(whole)
    (tmp_path / "short.bam").write_bytes(whole[:-9])
    (tmp_path / "odd.bam").write_bytes(bgzf.member(b"no such thing here"))
    for name, words in (("cut", "within a record"), ("short", "ends before"), ("odd", "no BAM file")):
        with pytest.raises(Exception, match=words):
            bam.read(spark, str(tmp_path / f"{name}.bam")).count()


def test_positions_beyond_2_to_29(spark, tmp_path):
    """such records are written, whole reads and filters find them, and the index spares parts."""
    path, far = str(tmp_path), 1 << 29
    places = [5, far - 30, far - 10, far, far + 1, far + 16_384, 600_000_000, (1 << 30) + 7, (1 << 31) - 2]
    rows = [(f"r{k}-{p}", 0, chrom, p, 9, "20M" if p < 1 << 30 else None, None, None, 0, "ACGT" * 5, None, []) for p in places for k in range(700) for chrom in ("chr2", "chrX")]
    bam.write(spark.createDataFrame(rows, bam.SCHEMA), spark.createDataFrame(SIZES, "chrom string, chrom_ord int, size long"), path, 2)
    assert {p.name[-8:] for p in tmp_path.glob("*.bam.*")} == {".bam.csi"}
    assert sorted_(bam.read(spark, path).collect()) == sorted_(rows)
    for a, z in [(0, 6), (far - 20, far + 1), (far + 2, far + 20_000), (far + 1, 1 << 30), (1 << 30, 1 << 31), (700_000_000, 800_000_000), ((1 << 31) - 2, 1 << 31)]:
        got = bam.read(spark, path).where(f"chrom = 'chr2' and pos0 >= {a} and pos0 < {z}")
        assert sorted_(got.collect()) == sorted_(r for r in rows if r[2] == "chr2" and a <= r[3] < z)
    assert bam.read(spark, path).where(f"chrom = 'chrX' and pos0 >= {far + 2}").count() == sum(r[2] == "chrX" and r[3] >= far + 2 for r in rows)
    reader = bam.Reader({"path": path})
    [*reader.pushFilters([EqualTo(("chrom",), "chr2"), GreaterThanOrEqual(("pos0",), 600_000_000), LessThan(("pos0",), 600_000_001)])]
    assert 700 <= sum(b.num_rows for run in reader.partitions() for b in reader.read(run)) < 3_000
    with pytest.raises(ValueError, match="beyond"):
        bam.record_of(("a", 0, "c", (1 << 31) - 1, 0, None, None, None, 0, None, None, []), {"c": 0}, bam.FARTHEST)


def test_positions_beyond_a_record(spark, tmp_path):
    """a chromosome beyond 2^31 - 2 is several references of a file, and is read and filtered as one."""
    path, most = str(tmp_path), bam.FARTHEST
    places = [5, 1 << 30, most - 40, most - 1, most, most + 3, most + (1 << 30), 2 * most - 1, 2 * most, 5 * most + 70_000]
    rows = [(f"r{k}-{p}", 0, chrom, p, 9, "20M", chrom if k % 2 else "chr10", p + 30 if k % 2 else 7, 0, "ACGT" * 5, None, [f"CB:Z:{k}"]) for p in places for k in range(300) for chrom in ("chr2", "chrX")]
    rows += [(f"s{k}", 0, "chr10", k, 9, "20M", "chrX", 9 * most + k, 0, None, None, []) for k in range(50)] + [("u", 4, None, None, 0, None, None, None, 0, "AC", None, []), ("v", 4, "chr2", None, 0, None, None, None, 0, "AC", None, [])]
    sizes = [("chr2", 1, 400_000), ("chr2_part2", 2, 900), ("chr10", 3, 3 * most + 11), ("chrX", 4, 5_000)]
    held = bam.write(spark.createDataFrame(rows, bam.SCHEMA), spark.createDataFrame(sizes, "chrom string, chrom_ord int, size long"), path, 3)
    assert held.rows == len(rows)
    assert sorted_(bam.read(spark, path).collect()) == sorted_(rows)
    for f in bam.listed(path, ".bam"):
        text, some = by_hand(f)
        assert some == sorted(some, key=lambda r: (r[0] < 0, *r[:2])) and all(p < most for _, p, _, _ in some)
        assert f"@SQ\tSN:chr2_part2_\tLN:{most}\tof:chr2\tat:{most}\n" in text and f"@SQ\tSN:chr10_part4\tLN:11\tof:chr10\tat:{3 * most}\n" in text and "@SQ\tSN:chr2_part2\tLN:900\n" in text
        assert "chrX_part5" not in text and f"of:chrX\tat:{9 * most}\n" in text  # where something is
    for a, z in [(0, 6), (most - 1, most), (most, most + 1), (most - 50, most + 4), (6, 2 * most), (2 * most, 1 << 62), (3 * most, 5 * most), (5 * most + 70_000, 5 * most + 70_001)]:
        got = bam.read(spark, path).where(f"chrom = 'chr2' and pos0 >= {a} and pos0 < {z}")
        assert sorted_(got.collect()) == sorted_(r for r in rows if r[2] == "chr2" and r[3] is not None and a <= r[3] < z)
    assert bam.read(spark, path).where("chrom = 'chr2_part2'").count() == 0
    assert bam.read(spark, path).where("chrom in ('chr10', 'chrX')").count() == sum(r[2] in ("chr10", "chrX") for r in rows)
    reader = bam.Reader({"path": path})
    [*reader.pushFilters([EqualTo(("chrom",), "chrX"), GreaterThanOrEqual(("pos0",), 2 * most - 1), LessThan(("pos0",), 2 * most)])]
    assert 300 <= sum(b.num_rows for run in reader.partitions() for b in reader.read(run)) < 1_500
    pushed = bam.Reader({"path": path, "bytes": 3_000})
    assert sorted_(r for run in pushed.partitions() for b in pushed.read(run) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)) == sorted_(rows)
    with pytest.raises(Exception, match="not known to go on"):
        bam.write(spark.createDataFrame(rows, bam.SCHEMA), spark.createDataFrame(sizes, "chrom string, chrom_ord int, size long"), str(tmp_path / "no"), 1, held=bam.Layout([(c, 9) for c, _, _ in sizes], {}, 1))


def test_marks_of_other_programs_are_left_alone():
    text = "@SQ\tSN:a\tLN:9\n@SQ\tSN:b\tLN:9\tof:a\tat:5\n@SQ\tSN:c\tLN:9\tof:z\tat:0\n@SQ\tSN:d\tLN:9\tof:a\n"
    assert bam.origins(text, ["a", "b", "c", "d", "e"]) == (["a", "b", "c", "d", "e"], [0] * 5)


def test_files_follow_the_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bam, "FILE_ROWS", 100)
    rows = made(2000, 4)
    bam.write(spark.createDataFrame(rows, bam.SCHEMA), spark.createDataFrame(SIZES, "chrom string, chrom_ord int, size long"), str(tmp_path))
    assert len(bam.listed(str(tmp_path), ".bam")) > 15 and sorted_(bam.read(spark, str(tmp_path)).collect()) == sorted_(rows)
