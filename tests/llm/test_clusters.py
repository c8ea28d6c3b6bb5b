"""Centroid clustering against a plain loop over Python integers, and odd rows."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from locuslake.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int"


def plain(rows, p):
    """{vec_id: (cluster, distance, cluster_inertia, inertia, centroid digest)} of rows with distinct ids."""
    fine = [(i, [math.floor(p.scale * Fraction(x)) for x in v]) for i, v in rows if i is not None and v is not None and len(v) == p.dim and all(x is not None and math.isfinite(x) for x in v)]
    fine.sort(key=lambda r: (hashlib.sha256(f"{p.seed}:{r[0]}".encode()).hexdigest(), r[1]))
    at = [list(v) for _, v in fine[: p.k]]
    for k in range(p.rounds + 1):
        own = []
        for _, v in fine:
            far = [sum((x - y) ** 2 for x, y in zip(v, c)) for c in at]
            own.append((far.index(min(far)), min(far)))
        if k < p.rounds:
            for c in range(len(at)):
                mine = [v for (_, v), (o, _) in zip(fine, own) if o == c]
                if mine:
                    at[c] = [sum(x) // len(mine) for x in zip(*mine)]
    fits = lambda x: x if x < 1 << 63 else None
    sums = [[d for o, d in own if o == c] for c in range(len(at))]
    total = lambda ds: None if any(d >= 1 << 63 for d in ds) else fits(sum(ds))
    return sorted(((i, o, fits(d), total(sums[o]), total([d for _, d in own]), hashlib.sha256(",".join(map(str, at[o])).encode()).hexdigest()) for (i, _), (o, d) in zip(fine, own)), key=str)


@pytest.mark.parametrize("kind", ["spread", "lumps", "ties", "large", "few"])
def test_clusters_equal_a_plain_loop(spark, kind):
    rng = random.Random(kind)
    p = clusters.Params(dim=4, k=6, rounds=4)
    if kind == "spread":
        rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(400)]
    elif kind == "lumps":
        rows = [(i, [rng.gauss(i % 5, 0.05) for _ in range(4)]) for i in range(400)]
    elif kind == "ties":
        rows = [(i, [rng.choice([-0.5, 0.0, 0.5]) for _ in range(4)]) for i in range(300)]
    elif kind == "large":
        rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice([0, 0, 3, 7, 9, 20, 200]) for _ in range(4)]) for i in range(80)] + [(500 + i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(100)] + [(900, [1.7e308, -1.7e308, 0.1, 1e-300])]
    else:
        rows = [(i, [float(i), 0.0, -0.25, 1.0]) for i in range(3)]
    odd = [(None, [0.0] * 4), (1000, None), (1001, []), (1002, [1.0, None, 0.0, 0.0]), (1003, [float("nan"), 0.0, 0.0, 0.0]), (1004, [float("-inf"), 0.0, 0.0, 0.0]), (1005, [1.0] * 5)]
    d = spark.createDataFrame([(*r, "own", 1) for r in rows + odd], SCHEMA)
    got = sorted(map(tuple, clusters.op11_kmeans(d.repartition(5), p).collect()), key=str)
    assert got == plain(rows + odd, p)


def test_repeated_rows_and_empty_tables(spark):
    same = [(7, [0.5, 0.25, 0.0, 1.0])] * 50 + [(8, [-0.5, 0.25, 0.0, 1.0])] * 3
    d = spark.createDataFrame([(*r, "own", 1) for r in same], SCHEMA)
    p = clusters.Params(dim=4, k=3)
    assert sorted(map(tuple, clusters.op11_kmeans(d, p).collect()), key=str) == plain(same, p)
    assert clusters.op11_kmeans(d.where("false"), clusters.Params(dim=4)).count() == 0
    assert clusters.op11_kmeans(d).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and clusters.op11_kmeans(d).count() == 0


def test_bounds_hold_and_spare_most_scans():
    """Bounds always enclose the exact distances, and once the centroids hardly move few vectors are scanned."""
    rng = np.random.default_rng(1)
    middle = rng.integers(-900, 900, (8, 16))
    v = middle[rng.integers(0, 8, 3000)] + rng.integers(-40, 40, (3000, 16))
    now, before = [row.tolist() for row in v[:8]], None
    cluster, upper, lower, scanned = np.zeros(3000, np.int32), np.full(3000, np.inf), np.full(3000, -np.inf), []
    for _ in range(8):
        cluster, upper, lower, seen = clusters.assign(v, cluster, upper, lower, clusters.Moves.of(before, now))
        far = np.sqrt(((v[:, None, :] - np.array(now)[None]) ** 2).sum(axis=2))
        assert (cluster == far.argmin(axis=1)).all() and (upper >= far.min(axis=1)).all()
        assert (lower <= np.sort(far, axis=1)[:, 1]).all()
        scanned.append(seen)
        before, now = now, [(v[cluster == c].sum(axis=0) // max(1, (cluster == c).sum())).tolist() if (cluster == c).any() else now[c] for c in range(8)]
    assert scanned[0] == 3000 and scanned[-1] < 300
