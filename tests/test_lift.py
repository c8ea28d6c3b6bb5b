"""Lifted intervals: strands, gaps, splits, joins of touching parts, and chains read from text."""

import pytest

from locuslake.operators import lift
from locuslake.sources import readers

TEXT = """# a comment

chain 1000 chrA 5000 + 100 460 chrX 9000 + 1000 1350 1
100 10 0
50 0 0
50 50 50
100

chain 900 chrA 5000 + 1000 1200 chrY 3000 - 500 700 2
200

chain 10.5 chrB 5000 + 0 100 chrX 9000 + 0 100 3
100
chain 10 chrB 5000 + 50 150 chrZ 9000 + 0 100 4
100
"""


@pytest.fixture(scope="module")
def blocks(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("chain") / "a.chain"
    path.write_text(TEXT)
    return readers.chains(spark, str(path)).cache()


def test_blocks_of_a_file(blocks):
    got = sorted((r["chain_id"], r["chrom"], r["start"], r["stop"], r["to_chrom"], r["to_start"], r["to_stop"], r["strand"]) for r in blocks.collect())
    assert got == [
        (1, "chrA", 100, 200, "chrX", 1000, 1100, "+"), (1, "chrA", 210, 260, "chrX", 1100, 1150, "+"), (1, "chrA", 260, 310, "chrX", 1150, 1200, "+"), (1, "chrA", 360, 460, "chrX", 1250, 1350, "+"),
        (2, "chrA", 1000, 1200, "chrY", 2300, 2500, "-"), (3, "chrB", 0, 100, "chrX", 0, 100, "+"), (4, "chrB", 50, 150, "chrZ", 0, 100, "+")]


def test_a_chain_that_its_blocks_do_not_fill_is_an_error(spark, tmp_path):
    (tmp_path / "b.chain").write_text("chain 1 chrA 50 + 0 20 chrX 90 + 0 20 1\n10 5 5\n4\n")
    with pytest.raises(Exception, match="do not fill chain 1"):
        readers.chains(spark, str(tmp_path / "b.chain")).collect()
    (tmp_path / "c.chain").write_text("")
    assert readers.chains(spark, str(tmp_path / "c.chain")).count() == 0


def plain(blocks, chrom, start, stop):
    """Each base of an interval on its own: {chain: {base: (chromosome, base there)}}."""
    out = {}
    for b in blocks:
        for x in range(max(start, b["start"]), min(stop, b["stop"])) if b["chrom"] == chrom else ():
            out.setdefault(b["chain_id"], {})[x] = (b["to_chrom"], b["to_start"] + x - b["start"] if b["strand"] == "+" else b["to_stop"] - 1 - (x - b["start"]))
    return out


def test_intervals_equal_single_bases(spark, blocks):
    known = blocks.collect()
    rows = [("chrA", a, a + n) for a in range(90, 480, 13) for n in (1, 5, 40, 120, 300)] + [("chrA", 990, 1010), ("chrA", 1000, 1200), ("chrA", 1100, 1101), ("chrB", 10, 40), ("chrB", 60, 90), ("chrB", 20, 130), ("chrB", 110, 140), ("chrC", 0, 10), ("chrA", 150, 150), ("chrA", 100, 200), ("chrA", 100, 200)]
    d = spark.createDataFrame([(*r, "own") for r in rows], "chrom string, start long, stop long, strand_ string")
    for bucket in (64, 1 << 16):
        got = lift.lifted(d, blocks, 0.9, bucket).collect()
        assert len(got) == len(rows)
        for r in got:
            by = plain(known, r["chrom"], r["start"], r["stop"])
            full = [c for c, m in by.items() if len(m) >= 0.9 * (r["stop"] - r["start"])]
            want = "lifted" if len(full) == 1 else "duplicated" if full else "split" if len(by) > 1 else "partial" if by else "deleted"
            assert r["status"] == want and r["mapped"] == max(map(len, by.values()), default=0), r
            if want == "lifted":
                at = [x for _, x in by[full[0]].values()]
                assert (r["to_start"], r["to_stop"]) == (min(at), max(at) + 1)
            else:
                assert r["to_chrom"] is None and r["to_start"] is None
        parts = lift.pieces(d, blocks, ["chrom", "start", "stop"], bucket).collect()
        seen = {}
        for p in parts:
            assert p["stop"] - p["start"] == p["to_stop"] - p["to_start"]
            for k in range(p["stop"] - p["start"]):
                seen.setdefault((p["chrom"], p["_from"], p["_upto"], p["chain_id"]), {})[p["start"] + k] = (p["to_chrom"], p["to_start"] + k if p["strand"] == "+" else p["to_stop"] - 1 - k)
        assert seen == {(*r, c): m for r in {*rows} for c, m in plain(known, *r).items()}
    touching = [p for p in parts if (p["_from"], p["_upto"]) == (207, 247) or (p["start"], p["stop"]) == (210, 310)]
    assert touching and any((p["start"], p["stop"]) == (210, 310) for p in parts)  # two blocks that touch are one part
