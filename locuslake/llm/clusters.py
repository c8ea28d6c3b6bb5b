"""Centroid clustering (11): k-means on quantised vectors with Hamerly bounds, exact in integers.

Each component becomes floor(scale * x). The first centroids are the vectors of smallest hash. A round assigns every
vector to its nearest centroid (ties: the smaller number) and moves each centroid to the exact floor of its vectors' mean;
a last assignment follows. Between rounds a table keeps for every vector its cluster, one upper bound of the distance
to its centroid and one lower bound of that to the second nearest. When centroids move, the bounds are loosened by
their drift; a vector whose upper bound stays strictly under its lower bound, or under half the way from its centroid to the
next one, keeps its cluster unseen. The others are ambiguous: their own distance is worked out first, then, if that does not settle
it, all distances in exact integers. Only the centroids, k rows of sums, come to the driver.

Defined cases: vectors that are null, of another length or that hold null or non-finite components take no part, nor do rows without
vec_id; of fewer than k vectors each is a centroid; repeated vec_ids stand as rows of their own, and tie in the order of centroids
by their components; equal centroids: the smaller number takes all; an empty centroid stays where it is; finite components of any size are
worked out in Python's integers, and a distance (or a sum of them) that no long holds is null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslake.llm.shared import drop_written, quantised, taking_part, written

SMALL = float(1 << 20)  # components under it have squared distances that float64 products hold exactly
SLACK = 1e-9  # relative, by which bounds are widened beyond rounding


@dataclass(frozen=True)
class Params:
    dim: int = 64
    scale: int = 64
    k: int = 16
    rounds: int = 3
    seed: str = "1"


def kept(vectors: DataFrame, p: Params) -> DataFrame:
    """(vec_id, large, v array<double>): v is quantised where the vector is small, and as it came where it is large; native."""
    d = taking_part(vectors).where(F.size("x") == p.dim)
    large = F.exists("x", lambda x: F.abs(x) >= SMALL / p.scale)
    return d.select("vec_id", large.alias("large"), F.when(large, F.col("x")).otherwise(F.transform("x", lambda x: F.floor(x * p.scale).cast("double"))).alias("v"))


def first_centroids(d: DataFrame, p: Params) -> list[list[int]]:
    rows = d.withColumn("h", F.sha2(F.concat(F.lit(f"{p.seed}:"), F.col("vec_id").cast("string")), 256)).orderBy("h", "v").limit(p.k).collect()
    return [integers(np.array([r["v"]]), r["large"], p)[0].tolist() for r in rows]


def integers(v: np.ndarray, large: bool, p: Params) -> np.ndarray:
    return quantised(v, p.scale) if large else v.astype(np.int64)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids: exact, by float64 products of small integers or by Python's integers."""
    if v.dtype != object and c.dtype != object:
        a, b = v.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    out = np.empty((len(v), len(c)), dtype=object)
    near = [j for j in range(len(c)) if v.dtype != object and all(abs(x) < SMALL for x in c[j].tolist())]
    if near:
        out[:, near] = squared(v, c[near].astype(np.int64)).astype(object)
    a = v.astype(object)
    for j in {*range(len(c))} - {*near}:
        out[:, j] = ((a - c[j].astype(object)) ** 2).sum(axis=1)
    return out


def root(x) -> np.ndarray:
    """Square roots as float64, infinite where too large for it."""
    flat = [math.sqrt(t) if t < 10**300 else math.inf for t in np.asarray(x, dtype=object).ravel().tolist()]
    return np.array(flat, dtype=np.float64).reshape(np.shape(x))


@dataclass
class Moves:
    """What a round needs of the centroids: where they are, how far each came and how far its next one is."""

    centroids: np.ndarray
    drift: np.ndarray
    half: np.ndarray

    @staticmethod
    def of(before: list[list[int]] | None, now: list[list[int]]) -> Moves:
        c = np.array(now, dtype=object)
        if all(abs(x) < SMALL for row in now for x in row):
            c = c.astype(np.int64)
        between = root(squared(c, c))
        np.fill_diagonal(between, np.inf)
        drift = np.zeros(len(now)) if before is None else root(np.array([sum((x - y) ** 2 for x, y in zip(a, b, strict=True)) for a, b in zip(before, now, strict=True)], dtype=object))
        return Moves(c, drift * (1 + SLACK), between.min(axis=1) / 2 * (1 - SLACK))

    def others(self) -> np.ndarray:
        """For each centroid, the largest drift among the others."""
        order = np.argsort(-self.drift, kind="stable")
        out = np.full(len(self.drift), self.drift[order[0]])
        out[order[0]] = self.drift[order[1]] if len(order) > 1 else 0.0
        return out


def assign(v: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, m: Moves) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(cluster, upper, lower, rows scanned in full) after the centroids moved."""
    cluster = cluster.copy()
    upper = (upper + m.drift[cluster]) * (1 + SLACK)
    lower = (lower - m.others()[cluster]) * (1 - SLACK)
    lower = np.where(np.isnan(lower), -np.inf, lower)
    unsure = np.flatnonzero(~(upper < np.maximum(lower, m.half[cluster])))
    if len(unsure):  # tighten the upper bound by the distance to the own centroid
        known = unsure[np.isfinite(upper[unsure])]
        own = m.centroids[cluster[known]]
        if v.dtype != object and own.dtype != object:
            gap = v[known] - own
            upper[known] = np.sqrt((gap * gap).sum(axis=1).astype(np.float64)) * (1 + SLACK)
            unsure = np.flatnonzero(~(upper < np.maximum(lower, m.half[cluster])))
    if len(unsure):
        far = squared(v[unsure], m.centroids)
        best = np.argmin(far, axis=1)  # the first of equal ones
        cluster[unsure] = best
        upper[unsure] = root(far[np.arange(len(unsure)), best]) * (1 + SLACK)
        if far.shape[1] > 1:
            far = far.astype(object) if far.dtype == object else far.astype(np.float64)
            far[np.arange(len(unsure)), best] = np.inf
            lower[unsure] = root(far.min(axis=1)) * (1 - SLACK)
        else:
            lower[unsure] = np.inf
    return cluster, upper, lower, len(unsure)


STATE = "vec_id long, large boolean, v array<double>, cluster int, upper double, lower double, distance long"


def assigned(state: DataFrame, m: Moves, p: Params, last: bool) -> DataFrame:
    """The state after one more assignment; with exact distances at the last one."""
    moves = state.sparkSession.sparkContext.broadcast(m)  # k centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = moves.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = batch.column("v")
            v = column.flatten().to_numpy().reshape(n, p.dim)
            cluster, upper, lower = (batch.column(c).to_numpy() for c in ("cluster", "upper", "lower"))
            cluster, upper, lower, distance = cluster.copy(), upper.copy(), lower.copy(), [None] * n
            big = batch.column("large").to_numpy(zero_copy_only=False)
            for large in (False, True):
                rows = np.flatnonzero(big == large)
                if not len(rows):
                    continue
                q = integers(v[rows], large, p)
                cluster[rows], upper[rows], lower[rows], _ = assign(q, cluster[rows], upper[rows], lower[rows], m)
                if last:
                    own = m.centroids[cluster[rows]]
                    exact = ((q - own) ** 2).sum(axis=1) if q.dtype != object and own.dtype != object else [sum(z * z for z in (a - b).tolist()) for a, b in zip(q.astype(object), own.astype(object), strict=True)]
                    for i, x in zip(rows.tolist(), map(int, exact), strict=True):
                        distance[i] = x if x < 1 << 63 else None
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("large"), column, pa.array(cluster, pa.int32()), pa.array(upper), pa.array(lower), pa.array(distance, pa.int64())], ["vec_id", "large", "v", "cluster", "upper", "lower", "distance"])

    return state.mapInArrow(run, STATE)


def means(state: DataFrame, before: list[list[int]], p: Params) -> list[list[int]]:
    """Each centroid's exact floor of its vectors' mean; an empty one stays.

    Sums of small vectors are sums of longs, combined before the shuffle. A large component is a 53-bit number times a power of two:
    its sums are made by power, so that they are exact whatever their size.
    """
    small = F.col("large") == F.lit(False)
    sums = [F.sum(F.when(small, F.get("v", F.lit(i)).cast("long"))).alias(f"s{i}") for i in range(p.dim)]
    found = {r["cluster"]: r for r in state.groupBy("cluster").agg(F.count("*").alias("n"), F.count_if("large").alias("large"), *sums).collect()}  # k rows
    total = {c: [r[f"s{i}"] or 0 for i in range(p.dim)] for c, r in found.items()}
    if any(r["large"] for r in found.values()):

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for c, v in zip(batch.column("cluster").to_pylist(), batch.column("v").to_pylist(), strict=True):
                    for i, x in enumerate(integers(np.array([v]), True, p)[0].tolist()):
                        power = max(0, x.bit_length() - 53)
                        out.append((c, i, power, x >> power))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["cluster", "i", "power", "x"])

        for r in state.where("large").mapInArrow(parts, "cluster int, i int, power int, x long").groupBy("cluster", "i", "power").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("x")).toLocalIterator():
            total[r["cluster"]][r["i"]] += int(r["x"]) << r["power"]
    return [[s // found[c]["n"] for s in total[c]] if c in found else old for c, old in enumerate(before)]


def clustered(vectors: DataFrame, p: Params = Params()) -> tuple[DataFrame, list[list[int]]]:
    """(the state after the last assignment, its centroids)."""
    d = kept(vectors, p)
    now, before = first_centroids(d, p), None
    state = d.select("vec_id", "large", "v", F.lit(0).alias("cluster"), F.lit(float("inf")).alias("upper"), F.lit(float("-inf")).alias("lower"), F.lit(None).cast("long").alias("distance"))
    if not now:
        return state.where("false"), []
    old = None
    for k in range(p.rounds + 1):
        state = written(assigned(state, Moves.of(before, now), p, k == p.rounds), f"round{k}")
        if old is not None:
            drop_written(old)
        old = state
        if k < p.rounds:
            before, now = now, means(state, now, p)
    return state, now


def op11_kmeans(vectors: DataFrame, p: Params = Params()) -> DataFrame:
    state, centroids = clustered(vectors, p)
    spark = vectors.sparkSession
    whole = lambda x: F.when(F.count("*") == F.count(x), F.sum(F.col(x).cast("decimal(20,0)")).cast("decimal(38,0)"))
    per = state.groupBy("cluster").agg(whole("distance").alias("part"))
    sums = {r["cluster"]: r["part"] for r in per.collect()} if centroids else {}  # k rows
    fits = lambda x: None if x is None or x >= 1 << 63 else int(x)
    all_ = None if any(x is None for x in sums.values()) else sum(map(int, sums.values()))
    rows = [(c, fits(sums.get(c)), hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()) for c, centroid in enumerate(centroids)]
    told = F.broadcast(spark.createDataFrame(rows, "cluster int, cluster_inertia long, centroid_sha256 string"))  # k rows
    return state.join(told, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(fits(all_)).cast("long").alias("inertia"), "centroid_sha256")


def _oracle(p: Params = Params()) -> str:
    near = "list_sum(list_transform(list_zip(e.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    steps = [
        f"e as materialized (select vec_id, list_transform(embedding, lambda x: floor(x::double * {p.scale})::bigint) as v from embeddings where len(embedding) = {p.dim} and len(list_filter(embedding, lambda x: isfinite(x::double))) = {p.dim})",
        f"c0 as materialized (select row_number() over (order by h) - 1 as c, v from (select v, sha256('{p.seed}:' || vec_id::varchar) as h from e order by h limit {p.k}))",
    ]
    for k in range(p.rounds + 1):
        steps.append(f"a{k} as materialized (select e.vec_id, any_value(e.v) as v, min({{'d': {near}, 'c': c.c}}) as m from e cross join c{k} c group by e.vec_id)")
        if k < p.rounds:
            steps.append(f"u{k} as (select m.c as c, unnest(v) as x, unnest(range({p.dim})) as i from a{k})")
            steps.append(f"w{k} as (select c, i, sum(x) as s, count(*) as n from u{k} group by c, i)")
            steps.append(f"n{k} as (select c, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as v from w{k} group by c)")
            steps.append(f"c{k + 1} as materialized (select c.c, coalesce(n.v, c.v) as v from c{k} c left join n{k} n using (c))")
    z = p.rounds
    return f"""
with {(',' + chr(10)).join(steps)}
select vec_id, m.c::int as cluster, m.d as distance, (sum(m.d) over (partition by m.c))::bigint as cluster_inertia, (sum(m.d) over ())::bigint as inertia,
  sha256(array_to_string(c.v, ',')) as centroid_sha256
from a{z} join c{z} c on c.c = a{z}.m.c
"""


ORACLE = _oracle()
