"""Hard negatives against a plain double loop over Python integers, pruning by cells, and odd rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from locuslake.llm import negatives
from locuslake.llm.shared import table

SCHEMA = "vec_id long, label int, embedding array<double>, rank int, anchor_id string"


def plain(rows, p):
    fine = [(i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(p.scale * Fraction(x)) for x in v]) for i, label, v in rows if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out, fits = [], lambda s: s if -(1 << 63) <= s < 1 << 63 else None
    for i, label, v in fine:
        if i % p.every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in fine if len(w) == len(v)]
        same = sorted(s for s in scored if s[2] == label and s[1] != i)[: p.positives]
        rest = sorted(s for s in scored if s[2] != label)
        for place, (ps, j, _) in enumerate(same, 1):
            hard = [(ns, k) for ns, k, _ in rest if -50 * ps <= -100 * ns <= -95 * ps][: p.negatives]
            out += [(i, j, r, k, fits(-ps), fits(-ns), place) for r, (ns, k) in enumerate(hard, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", ["spread", "lumps", "ties", "lengths", "large", "one_label"])
def test_negatives_equal_a_plain_loop(spark, kind):
    rng = random.Random(kind)
    p = negatives.Params(every=10, rows_per_cell=12, block=16, group=8, blocks_per_lane=4)
    middle = [[rng.uniform(0, 1) for _ in range(5)] for _ in range(6)]
    if kind == "ties":
        rows = [(i, rng.randint(0, 3), [rng.choice([0.25, 0.5, 1.0]) for _ in range(3)]) for i in range(240)]
    elif kind == "lengths":
        rows = [(i, rng.randint(0, 3), [rng.uniform(0, 1) for _ in range(rng.choice([1, 3, 3, 4]))]) for i in range(240)]
    elif kind == "large":
        rows = [(i, rng.randint(0, 3), [rng.uniform(0, 1) * 10.0 ** rng.choice([0, 0, 0, 4, 8, 30, 250]) for _ in range(3)]) for i in range(160)]
    else:
        width = 0.02 if kind == "lumps" else 0.6
        rows = [(i, 4 if kind == "one_label" else rng.randint(0, 9), [x * rng.uniform(0.6, 1) + rng.gauss(0, width) for x in middle[i % 6]]) for i in range(300)]
    odd = [(None, 1, [0.5] * 3), (1000, None, [0.5] * 3), (1010, 1, None), (1020, 1, []), (1030, 1, [0.5, None, 0.5]), (1040, 1, [0.5, float("nan"), 0.5]), (1050, 1, [0.5, float("inf"), 0.5])]
    d = spark.createDataFrame([(*r, 1, "own") for r in rows + odd], SCHEMA).repartition(3)
    assert sorted(map(tuple, negatives.op12_hard_negatives(d, p).collect()), key=str) == plain(rows + odd, p)


def test_repeated_rows_one_hot_vector_and_empty_tables(spark):
    rng = random.Random(2)
    rows = [(20, 1, [0.5, 0.5])] * 3 + [(1000 + i, 2, [0.5, 0.4]) for i in range(300)] + [(3000 + i, 1, [rng.uniform(0, 1), rng.uniform(0, 1)]) for i in range(200)] + [(20, 2, [0.5, 0.45])]
    p = negatives.Params(every=20, rows_per_cell=20, block=32, group=16, blocks_per_lane=3)
    d = spark.createDataFrame([(*r, 1, "own") for r in rows], SCHEMA)
    assert sorted(map(tuple, negatives.op12_hard_negatives(d, p).collect()), key=str) == plain(rows, p)
    few = negatives.Params(every=20, rows_per_cell=20, block=32, group=16, most_counts=3, most_needs=2)  # bounds without counts, cells joined by shuffle
    assert sorted(map(tuple, negatives.op12_hard_negatives(d, few).collect()), key=str) == plain(rows, p)
    assert negatives.op12_hard_negatives(d.where("false")).count() == 0
    blocks = negatives.blocks_of(negatives.labelled(d, p), negatives.pivots_of(negatives.labelled(d, p), p)[0], p, False, 6)
    assert max(r["rows"] for r in blocks.collect()) <= 32


def test_cells_spare_most_pairs(spark):
    """Where the vectors lie in lumps, a group meets the cells it may need and no others."""
    rng = np.random.default_rng(4)
    middle = rng.normal(0, 1, (12, 8))
    middle /= np.linalg.norm(middle, axis=1)[:, None]
    rows = [(i, int(rng.integers(0, 3)), (middle[i % 12] + rng.normal(0, 0.01, 8)).tolist(), 1, "") for i in range(3600)]
    p = negatives.Params(every=20, rows_per_cell=60, block=64, group=15)
    d = negatives.labelled(spark.createDataFrame(rows, SCHEMA), p)
    cells, _, _ = negatives.pivots_of(d, p)
    blocks = negatives.blocks_of(d, cells, p, False, 8)
    anchors = negatives.blocks_of(d.where("vec_id % 20 = 0"), cells, p, True, 1)
    cells = negatives.known_cells(cells, blocks, p)
    need = negatives.needs(anchors, cells, p, 1, True).where("cell >= 0").count()
    assert 0 < need < 0.4 * anchors.count() * len(cells.pivots[8])


def test_the_whole_table_takes_part(spark):
    d = table(spark, "/root/testdata/sf0.001", "embeddings")
    p = negatives.Params()
    blocks = negatives.blocks_of(negatives.labelled(d, p), negatives.pivots_of(negatives.labelled(d, p), p)[0], p, False, 4)
    assert sum(r["rows"] for r in blocks.collect()) == d.count()
