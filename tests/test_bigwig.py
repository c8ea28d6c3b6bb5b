"""bigWig files: written and read back, filters that reach the index, the three kinds of blocks, damage."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThan

from locuslake.sources import bigwig


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, rows = random.Random(1), []
    for chrom, n in (("chr1", 3000), ("chr10", 50), ("chrX", 800)):
        at = 0
        for _ in range(n):
            at += rng.randint(0, 30)
            size = rng.randint(1, 40)
            rows.append((chrom, at, at + size, float(np.float32(rng.gauss(0, 3)))))
            at += size
    path = str(tmp_path_factory.mktemp("bw"))
    d = spark.createDataFrame(rows + [(None, 1, 2, 1.0), ("chr1", 5, 5, 1.0), ("chr1", 7, 9, None)], "chrom string, start long, stop long, value double")
    bigwig.write(d, spark.createDataFrame([("chr1", 10**6), ("chr10", 10**6), ("chr2", 10**6), ("chrX", 10**6)], "chrom string, size long"), path, 3, 64)
    return path, rows


def test_what_is_written_is_read(spark, folder):
    path, rows = folder
    assert sorted(map(tuple, bigwig.read(spark, path).collect())) == sorted(rows)
    assert sorted(map(tuple, bigwig.read(spark, path, bytes=1000).collect())) == sorted(rows)


def test_filters_reach_the_index(spark, folder):
    path, rows = folder
    d = bigwig.read(spark, path).where("chrom = 'chr1' and start < 20000 and stop > 15000")
    assert sorted(map(tuple, d.collect())) == sorted(r for r in rows if r[0] == "chr1" and r[1] < 20000 and r[2] > 15000)
    assert sorted(map(tuple, bigwig.read(spark, path).where("chrom in ('chrX', 'chr2') and start >= 400").collect())) == sorted(r for r in rows if r[0] == "chrX" and r[1] >= 400)

    def asked(*filters):
        reader = bigwig.Reader({"path": path})
        assert [*reader.pushFilters([*filters])] == [*filters]
        return sum(len(run.blocks) for run in reader.partitions())

    whole = asked()
    assert whole == -(-3000 // 64) + 1 + -(-800 // 64) or whole > 50  # a block may be cut at a file's end
    assert asked(EqualTo(("chrom",), "chr10")) in (1, 2) and asked(EqualTo(("chrom",), "chr2")) == 0
    some = asked(EqualTo(("chrom",), "chr1"), LessThan(("start",), 20000), GreaterThan(("stop",), 15000))
    need = len({k // 64 for k, r in enumerate(r for r in rows if r[0] == "chr1") if r[1] < 20000 and r[2] > 15000})
    assert need <= some <= need + 2 and some < whole / 4
    assert asked(In(("chrom",), ("chr2", "chrX"))) < whole / 2


def test_blocks_of_every_kind_and_deep_indices(spark, tmp_path):
    head = lambda first, step, span, kind, n: bigwig.SECTION.pack(0, first, 0, step, span, kind, 0, n)
    names = {0: ("c", 9)}
    rows = lambda block: [(r["start"], r["stop"], r["value"]) for r in bigwig.decoded(block, names).to_pylist()]
    assert rows(head(5, 10, 4, bigwig.FIXED, 3) + struct.pack("<fff", 1, 2, 3)) == [(5, 9, 1.0), (15, 19, 2.0), (25, 29, 3.0)]
    assert rows(head(0, 0, 6, bigwig.VARIABLE, 2) + struct.pack("<IfIf", 3, 0.5, 40, 1.5)) == [(3, 9, 0.5), (40, 46, 1.5)]
    with pytest.raises(ValueError, match="kind"):
        rows(head(0, 0, 6, 9, 0))
    blocks = [(k % 2 and 1 or 0, np.array([10 * k]), np.array([10 * k + 5]), np.array([float(k)])) for k in sorted(range(200), key=lambda k: (k % 2, k))]
    for fan in (2, 3, 7, 256):
        (tmp_path / f"{fan}.bw").write_bytes(b"".join(bigwig.laid_out([("a", 10**6), ("b", 10**6)], blocks, fan)))
        file = bigwig.File(str(tmp_path / f"{fan}.bw"))
        found = file.names()
        assert found == {0: ("a", 10**6), 1: ("b", 10**6)} and len(file.blocks(bigwig.Bounds(), found)) == 200
        before = file.touched
        assert len(file.blocks(bigwig.Bounds(frozenset("b"), 1000, 900), found)) == 5
        assert fan > 7 or file.touched - before < 3000  # a few nodes of the tree
    got = bigwig.read(spark, str(tmp_path / "2.bw")).collect()
    assert sorted(r["value"] for r in got) == [float(k) for k in range(200)]


def test_empty_and_broken_files(spark, tmp_path):
    (tmp_path / "none.bw").write_bytes(b"".join(bigwig.laid_out([("a", 5)], [])))
    assert bigwig.read(spark, str(tmp_path / "none.bw")).count() == 0
    (tmp_path / "odd.bw").write_bytes(zlib.compress(b"x" * 500) + b"0" * 100)
    with pytest.raises(Exception, match="bigWig"):
        bigwig.read(spark, str(tmp_path / "odd.bw")).count()
    (tmp_path / "short.bw").write_bytes(b"\x26\xfc\x8f\x88")
    with pytest.raises(Exception, match="ends"):
        bigwig.read(spark, str(tmp_path / "short.bw")).count()
