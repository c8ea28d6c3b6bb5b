"""Hand-worked cases and properties of the interval operators."""

import random

from locuslake.operators import intervals as I


def frame(spark, rows, schema="chrom string, start long, stop long, id string"):
    return spark.createDataFrame(rows, schema)


def points(spark, *pos):
    return spark.createDataFrame([("chr1", p) for p in pos], "chrom string, pos0 long")


def test_half_open_edges_and_smallest_start(spark):
    ref = frame(spark, [("chr1", 0, 100, "a"), ("chr1", 50, 60, "b")])
    got = {r["pos0"]: r["id"] for r in I.first_interval(points(spark, 0, 55, 99, 100), ref, "id", ["chrom", "pos0"], bucket=16).collect()}
    assert got == {0: "a", 55: "a", 99: "a", 100: None}


def test_pairs_meet_once_over_many_buckets(spark):
    a, b = frame(spark, [("chr1", 0, 1000, "a")]), frame(spark, [("chr1", 10, 900, "b"), ("chr2", 0, 5, "c"), ("chr1", 1000, 1001, "d")])
    assert [tuple(r)[3:] for r in I.overlaps(a, b, ["id"], bucket=7).collect()] == [("a", "b", 890)]


def test_largest_overlap_ties_go_to_the_lower_start(spark):
    q, ref = frame(spark, [("chr1", 10, 30, "q"), ("chr1", 90, 95, "none")]), frame(spark, [("chr1", 20, 40, "late"), ("chr1", 0, 20, "early")]).withColumnRenamed("id", "ref")
    got = {r["id"]: r["ref"] for r in I.largest_overlap(q, ref, "ref", ["id"], 8).collect()}
    assert got == {"q": "early", "none": None}


def test_merge_joins_touching_and_names_are_sorted(spark):
    d = spark.createDataFrame([("chr1", 0, 10, "b"), ("chr1", 10, 20, "a"), ("chr1", 15, 18, "."), ("chr1", 21, 22, None)], "chrom string, start long, stop long, gene string")
    assert sorted(map(tuple, I.merged(d, "gene").collect())) == [("chr1", 0, 20, "a,b"), ("chr1", 21, 22, ".")]
    again = I.merged(I.merged(d, "gene"), "gene")
    assert again.count() == 2


def test_tiles(spark):
    def tiles(length, width):
        return sorted((r["start"], r["stop"]) for r in I.tiled(frame(spark, [("chr1", 0, length, "r")]), width).collect())

    assert tiles(1100, 500) == [(0, 500), (500, 1100)]
    assert len(tiles(1300, 500)) == 3
    assert tiles(100, 500) == [(0, 100)]


def test_subtract_keeps_every_uncovered_base(spark):
    rng = random.Random(4)
    region = [("chr1", 0, 200, "r"), ("chr1", 300, 360, "s"), ("chr2", 0, 50, "t")]
    holes = [("chr1", s := rng.randrange(0, 380), s + rng.randrange(1, 30), "") for _ in range(14)]
    left = I.subtracted(frame(spark, region), frame(spark, holes), 64).collect()
    want = {(c, p) for c, s, e, _ in region for p in range(s, e)} - {(c, p) for c, s, e, _ in holes for p in range(s, e)}
    got = [(r["chrom"], p) for r in left for p in range(r["start"], r["stop"])]
    assert set(got) == want and len(got) == len(want)


def test_asof_without_end_and_empty_tables(spark):
    w = frame(spark, [("chr1", 10, 12, "a"), ("chr1", 50, 52, "b")])
    got = {(r["pos0"], r["id"]) for r in I.asof_start(points(spark, 5, 10, 49, 500), w, ["id"], bucket=16).collect()}
    assert got == {(10, "a"), (49, "a"), (500, "b")}
    none = w.where("false")
    assert I.without_overlap(w, none).count() == 2 and I.merged(none).count() == 0
    assert I.points_in_intervals(points(spark, 1), none, ["id"], how="left").collect()[0]["id"] is None


def test_range_join_is_an_equi_join_and_not_nested_loops(spark):
    plan = I.points_in_intervals(points(spark, 1, 2), frame(spark, [("chr1", 0, 5, "a")]), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_gc_of_sequences_over_buckets_without_broadcasting_them(spark):
    """a bucket takes its own piece of a sequence, and no sequence goes to the driver."""
    seq = "".join("ACGTNgc"[(k * k + k // 3) % 7] for k in range(1000))
    chunks = spark.sql(f"select chrom, bigint(start) as start, bigint(stop) as stop, seq from values ('c', 0, 1000, '{seq}'), ('c', 1000, 1500, '{seq[:500]}'), ('d', 37, 137, '{seq[:100]}'), ('d', 90, 140, '{seq[50:100]}') as t(chrom, start, stop, seq)")
    wins = [("c", a, a + n) for a in range(0, 1600, 130) for n in (1, 64, 300)] + [("d", 0, 100), ("d", 95, 400), ("e", 0, 9)]
    got = I.gc_fraction(spark.createDataFrame([*wins, wins[0]], "chrom string, start long, stop long"), chunks, 64)
    for sent in got._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[1:]:
        own = sent.split("\n")
        depth = len(own[1]) - len(own[1].lstrip(" :+-"))
        under = [x for k, x in enumerate(own[1:]) if all(len(y) - len(y.lstrip(" :+-")) >= depth for y in own[1 : k + 2])]
        assert not any("seq" in x for x in under)
    of = {(c, p): b for c, a, s in [("c", 0, seq), ("c", 1000, seq[:500])] for p, b in enumerate(s, a)}
    for c, a, z, gc in [tuple(r) for r in got.select("chrom", "start", "stop", "gc").collect()]:
        bases = [of[c, p] for p in range(a, z) if (c, p) in of] if c == "c" else [s[p - o] for o, s in ((37, seq[:100]), (90, seq[50:100])) for p in range(a, z) if c == "d" and o <= p < o + len(s)]
        assert gc == (sum(b in "GCgc" for b in bases) / len(bases) if bases else None)
    assert got.count() == len(wins) + 1


def test_first_interval_makes_no_row_for_each_hit(spark):
    """many intervals over a point, equal, nested and in steps; the points are not sorted by key with all that hold them."""
    rng = random.Random(3)
    held = [("c", 100, 900, f"i{k:04d}") for k in range(2000, 0, -1)] + [("c", 100 + k, 900 - k, f"n{k}") for k in range(300)] + [("c", a, a + rng.choice([1, 40, 900, 50_000]), f"r{a}-{k}") for k in range(200) for a in [rng.randrange(40_000)]]
    held += [("c", 5, 5, "empty"), ("d", 0, 1 << 20, "long"), ("d", 7, 9, None), ("d", 0, 3, "b"), ("d", 0, 3, "a")]
    at = [("c", p) for p in range(0, 41_000, 37)] + [("d", p) for p in (0, 2, 3, 8, (1 << 20) - 1, 1 << 20)] + [("e", 1)]
    got = I.first_interval(spark.createDataFrame(at, "chrom string, pos0 long"), frame(spark, held), "id", ["chrom", "pos0"], bucket=1 << 22)
    want = {(c, p): min(((a, z, i or "") for d, a, z, i in held if d == c and a <= p < z), default=(0, 0, None))[2] for c, p in at}
    assert got.columns == ["chrom", "pos0", "id"] and {(c, p): i for c, p, i in got.collect()} == want
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
