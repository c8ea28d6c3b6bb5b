"""Text sources read back and sinks."""

import gzip

import numpy as np
import pytest

from locuslake.sources import readers, writers


def put(path, text, zipped=False):
    if zipped:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        path.write_text(text)
    return str(path)


def test_vcf(spark, tmp_path):
    p = put(tmp_path / "a.vcf.gz", "##x\n#CHROM\tPOS\n1\t10\t.\tA\tC\t50\tPASS\tAD=3;SOMATIC;DP=9\tGT:PS\t0|1:7\nchrMT\t5\t.\tA\tC\t.\t.\tDP=1\n", True)
    rows = {r["chrom"]: r for r in readers.vcf(spark, p).collect()}
    assert rows["chr1"]["pos0"] == 9 and rows["chr1"]["info"] == {"AD": "3", "SOMATIC": "true", "DP": "9"} and rows["chr1"]["phase"] == 1
    assert rows["chrM"]["chrom_ord"] == 25 and rows["chrM"]["gt"] is None


def test_intervals_genes_and_maps(spark, tmp_path):
    assert [tuple(r) for r in readers.bed(spark, put(tmp_path / "a.bed", "1\t0\t5\tx\n")).collect()] == [("chr1", 0, 5)]
    g = put(tmp_path / "a.gtf", '#c\n1\ts\tgene\t11\t20\t.\t+\t.\tgene_id "G1"; x "y"\n1\ts\tgene\t31\t40\t.\t+\t.\tgene_id "G1"\n1\ts\texon\t11\t12\t.\t+\t.\tgene_id "G1"\n')
    assert [(r["gene_id"], r["start"], r["stop"]) for r in readers.genes(spark, g).collect()] == [("G1", 10, 20)]
    assert readers.exons(spark, g).count() == 1
    m = put(tmp_path / "m.txt", "chr position COMBINED_rate(cM/Mb) Genetic_Map(cM)\n1 100 0.5 1.5\n23 7 0.1 0.2\n")
    assert {tuple(r) for r in readers.eagle_map(spark, m).collect()} == {("chr1", 100, 1.5), ("chrX", 7, 0.2)}
    s = put(tmp_path / "s.txt", "pos\trate\tcM\n5\t0.1\t0.2\n")
    assert [tuple(r) for r in readers.shapeit_map(spark, {"chr2": s}).collect()] == [("chr2", 5, 0.2)]


def test_matrix_sizes_and_labels(spark, tmp_path):
    m = put(tmp_path / "a.mtx", "%%MatrixMarket\n%c\n3 2 2\n1 1 5\n3 2 7\n")
    assert {tuple(r) for r in readers.matrix_market(spark, m).collect()} == {(0, 0, 5), (2, 1, 7)}
    assert [tuple(r) for r in readers.chrom_sizes(spark, put(tmp_path / "s", "chr1  100\n")).collect()] == [("chr1", 100)]
    with pytest.raises(Exception, match="not two fields"):
        readers.chrom_sizes(spark, put(tmp_path / "bad", "chr1 100 x\n")).collect()
    a = put(tmp_path / "l.tsv", "Barcode\tMicroregion_annotation\nA\tT1\nB\tT1_edge_x\nC\tNA\nD\tstroma\n")
    assert {tuple(r) for r in readers.annotations(spark, a).collect()} == {("A", "tumor"), ("B", "edge_x"), ("C", "normal"), ("D", "stroma")}
    with pytest.raises(ValueError):
        readers.windows(spark, put(tmp_path / "w", "#CHR\tSTART\tEND\nchr1\t0\t1\n"))


def test_order_and_prefix_of_variants(spark, tmp_path):
    a = put(tmp_path / "a.vcf", "#h\n2\t7\t.\tA\tC\t.\t.\tX\n10\t5\t.\tA\tC\t.\t.\tX\n2\t3\t.\tAT\tC\t.\t.\tX\n")
    assert [(r["chrom"], r["pos"]) for r in readers.vcf(spark, a, presorted=False).collect()] == [("chr2", 3), ("chr2", 7), ("chr10", 5)]
    b = put(tmp_path / "b.vcf", "chr1\t7\t.\tA\tC\t.\t.\tX\n2\t5\t.\tA\tC\t.\t.\tX\n")  # the first row decides
    assert [r["chrom"] for r in readers.vcf(spark, b).collect()] == ["chr1", "2"]
    assert readers.vcf(spark, put(tmp_path / "c.vcf", "#h\n")).count() == 0
    assert readers.vcfs(spark, [a, b]).count() == 5
    assert {tuple(r) for r in readers.panel_sites(readers.vcf(spark, a)).collect()} == {("chr2", 7), ("chr10", 5)}


def test_matrices(spark, tmp_path):
    dense = np.array([[0, 1, 0], [2, 0, 3.5]])
    np.savez(tmp_path / "d.npz", mat=dense)
    np.savez(tmp_path / "s.npz", data=np.array([1, 2, 3.5]), indices=np.array([1, 0, 2]), indptr=np.array([0, 1, 3]), format=np.array(b"csr"), shape=np.array([2, 3]))
    np.savez(tmp_path / "v.npz", mat=np.array([0, 4]))
    np.savez(tmp_path / "x.npz", data=np.array([1]), indices=np.array([0]), indptr=np.array([0, 1]), format=np.array(b"csc"), shape=np.array([1, 1]))
    for name in ("d", "s"):
        assert {tuple(r) for r in readers.npz(spark, str(tmp_path / f"{name}.npz"), rows=1).collect()} == {(0, 1, 1.0), (1, 0, 2.0), (1, 2, 3.5)}
    assert [tuple(r) for r in readers.npz(spark, str(tmp_path / "v.npz")).collect()] == [(1, 0, 4.0)]
    with pytest.raises(Exception, match="by rows"):
        readers.npz(spark, str(tmp_path / "x.npz")).collect()
    folder = tmp_path / "m"
    folder.mkdir()
    put(folder / "matrix.mtx.gz", "%%MatrixMarket\n2 3 3\n1 1 5\n2 3 7\n2 2 1\n", True)
    put(folder / "features.tsv.gz", "G1\tname\nG2\tname\n", True)
    put(folder / "barcodes.tsv.gz", "AA\nCC\nGG\n", True)
    listed = spark.createDataFrame([("AA",), ("GG",)], "barcode string")
    assert {tuple(r) for r in readers.feature_matrix(spark, str(folder), "r1", listed).collect()} == {("AA_r1", "G1", 5), ("GG_r1", "G2", 7)}
    assert [tuple(r) for r in readers.lines(spark, put(tmp_path / "l.txt", "a\nb\nc\n")).orderBy("row_id").collect()] == [(0, "a"), (1, "b"), (2, "c")]
    x = readers.feature_matrix(spark, str(folder))
    writers.annotated_matrix(x.select("barcode").distinct(), x.select("feature_id").distinct(), x, str(tmp_path / "ann"))
    got = readers.annotated_matrix(spark, str(tmp_path / "ann"))
    assert got["x"].count() == 3 and got["obs"].count() == 3 and got["var"].count() == 2
    writers.matrix(x, str(tmp_path / "long"))
    assert readers.matrix(spark, str(tmp_path / "long")).count() == 3 and writers.empty_matrix(spark).count() == 0


def test_fragments_barcodes_and_depths(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    with pytest.raises(FileNotFoundError):
        readers.fragments_of(spark, str(folder))
    put(folder / "fragments.tsv.gz", "#c\nchr1\t0\t5\tAA\t1\nchr1\t9\t12\tCC\t2\n", True)
    white = spark.createDataFrame([("CC",)], "barcode string")
    assert [r["start"] for r in readers.fragments_of(spark, str(folder), white).collect()] == [9]
    put(folder / "atac_fragments.tsv.gz", "chr2\t1\t2\tCC\t2\n", True)
    assert readers.fragments_of(spark, str(folder)).first()["chrom"] == "chr2"
    assert [r["barcode"] for r in readers.barcodes(spark, put(tmp_path / "b", "AA\n\n"), "r").collect()] == ["AA_r"]
    assert [tuple(r) for r in readers.barcode_map(spark, put(tmp_path / "bm", "REP_ID\tBARCODE\nr\tAA\n")).collect()] == [("r", "AA")]
    d = put(tmp_path / "d.bed", "chr1\t0\t5\t1.5\nchr9\t0\t5\t2\n")
    assert [r["depth"] for r in readers.depth(spark, d, "s", ["chr1"]).collect()] == [1.5]
    assert readers.bedgraph(spark, d).count() == 2
    w = readers.windows(spark, put(tmp_path / "w", "#CHR\tSTART\tEND\tGC\tMAP\tX\nchr1\t0\t5\t0.5\tNaN\tq\nchr2\t0\t5\t\t1\tq\n"))
    assert {(r["chrom"], r["gc"], r["map"]) for r in w.collect()} == {("chr1", 0.5, None), ("chr2", None, 1.0)}


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([("chr1", 0, 5, 1.5)], "chrom string, start long, stop long, v double")
    writers.tsv(d, str(tmp_path / "t"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "t")).columns == d.columns
    writers.bed3(d, str(tmp_path / "b"))
    assert readers.bed(spark, str(tmp_path / "b")).first()["stop"] == 5
    calls = spark.createDataFrame([("chr1", 4, "chr1_5", "A", "C", "AD=1", "0/1")], "chrom string, pos0 long, snp_id string, ref string, alt string, info string, gt string")
    writers.variants(calls, str(tmp_path / "v"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "v")).collect()]
    assert lines[0] == "##fileformat=VCFv4.2" and lines[-2].startswith("#CHROM\tPOS") and lines[-1].split("\t")[:2] == ["chr1", "5"]
    assert readers.vcf(spark, str(tmp_path / "v") + "/*").first()["key"] == "chr1_5"
    maps = spark.createDataFrame([("chr1", 100, 1.0), ("chr1", 300, 2.0), ("chrX", 5, 0.5)], "chrom string, pos long, cm double")
    writers.eagle_map(maps, str(tmp_path / "e"))
    assert {tuple(r) for r in readers.eagle_map(spark, str(tmp_path / "e")).collect()} == {tuple(r) for r in maps.collect()}
    names = spark.createDataFrame([("chr1", 1)], "`#CHR` string, START long")
    writers.tsv(names, str(tmp_path / "n"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "n")).columns == ["#CHR", "START"]
    assert writers.stamped("a/b.pdf", "r1") == "a/b.r1.pdf" and writers.stamped("a/b.pdf", None) == "a/b.pdf"
