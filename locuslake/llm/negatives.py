"""Hard-negative mining (12): a kNN join distributed by Voronoi cells, exact in integers.

Components become floor(scale * x); the score of two rows is their integer inner product. A row x is augmented by
sqrt(M^2 - |x|^2), M the largest norm, an anchor by 0: the highest scores are then the smallest Euclidean distances.
Every row is assigned to its nearest pivot (rows of smallest hash, a bounded sample); a cell keeps the smallest and the largest
distance of its rows to its pivot and how many rows of each label it has. Anchors of one cell, or of cells that follow each other
along a chain of near pivots, form groups. The triangle inequality bounds what each anchor may need: a cell's rows go to those groups
alone that they might serve, where blocks of rows meet blocks of anchors in an exact local join.

There are two joins. The first finds an anchor's positives: the counts of its label in the cells bound the distance of its
last one. The second finds, for each positive, the best rows of other labels whose scores lie in its window: a ring around
the anchor, whose far edge the counts draw in. Blocks are of bounded size, hot cells are many blocks, and the blocks of a group are dealt
over lanes; a lane hands on the best rows of each anchor alone, which are merged at last.

Defined cases: rows with a null label, a null or empty vector, a null or non-finite component or no vec_id take no part; vectors of several lengths only meet
their own; every anchor row asks; an anchor's positives leave out all rows of its vec_id; repeated rows stand beside each other as candidates; ties go to the smaller vec_id;
rows of very large components are in no cell: they meet every group and are scored by Python's integers, and a score that no long
holds is null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locuslake.llm.shared import drop_written, far_scores, quantised, score_order, taking_part, written

FAR = float(1 << 50)  # squared norms under it: products of two such rows are exact in float64
NOWHERE = -1  # the cell of rows that no pivot stands for


@dataclass(frozen=True)
class Params:
    scale: int = 256
    every: int = 50  # anchors: rows whose vec_id is divisible by it
    shift: int = 7  # rows whose vec_id is divisible by it change their label first
    labels: int = 10
    positives: int = 5
    negatives: int = 3
    low: int = 50  # of a hundred of the positive's score
    high: int = 95
    rows_per_cell: int = 2048
    cells: int = 1024  # at most
    block: int = 1024  # rows of a block
    group: int = 1024  # anchors of a group
    blocks_per_lane: int = 64  # some 32 MB of a lane in one task
    most_counts: int = 1_000_000  # label counts that may be broadcast (some 20 MB); beyond, bounds do without them
    most_needs: int = 500_000  # (group, cell) pairs that may be broadcast; beyond, they are joined by shuffle
    seed: int = 3


def labelled(vectors: DataFrame, p: Params) -> DataFrame:
    """(vec_id, x, label) of the rows that take part; native."""
    d = taking_part(vectors.where("label is not null"), "label")
    label = F.col("label").cast("long")
    return d.select("vec_id", "x", F.when(F.pmod("vec_id", F.lit(p.shift)) == 0, (label + 1) % p.labels).otherwise(label).alias("label"))


def rectangle(column: pa.Array, dim: int, rows: np.ndarray) -> np.ndarray:
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return column.flatten().to_numpy()[(ends[rows] - dim)[:, None] + np.arange(dim)]


def near(x: np.ndarray, scale: int) -> np.ndarray:
    """Which rows are small enough for exact float64 products."""
    y = np.floor(np.clip(x, -1e100, 1e100) * scale)
    return (y * y).sum(axis=1) < FAR


@dataclass
class Cells:
    """Pivots by vector length, in the order of a chain of near ones, and what is known of their cells."""

    norm2: float  # M^2
    pivots: dict[int, np.ndarray]  # dim: augmented, cells x (dim + 1)
    low: dict[int, np.ndarray] | None = None  # dim: smallest distance of the cell's rows to its pivot
    high: dict[int, np.ndarray] | None = None
    rows: dict[int, np.ndarray] | None = None
    counts: dict[int, dict[int, np.ndarray]] | None = None  # dim: label: rows by cell

    def augmented(self, q: np.ndarray) -> np.ndarray:
        return np.concatenate([q, np.sqrt(np.maximum(0.0, self.norm2 - (q * q).sum(axis=1)))[:, None]], axis=1)

    def distances(self, a: np.ndarray, dim: int) -> np.ndarray:
        c = self.pivots[dim]
        return np.sqrt(np.maximum(0.0, (a * a).sum(axis=1)[:, None] - 2 * a @ c.T + (c * c).sum(axis=1)))


def chain(pivots: np.ndarray) -> np.ndarray:
    """The pivots in an order in which each is followed by the nearest one left."""
    left, order = np.ones(len(pivots), bool), [0]
    left[0] = False
    for _ in range(len(pivots) - 1):
        far = ((pivots - pivots[order[-1]]) ** 2).sum(axis=1)
        far[~left] = np.inf
        order.append(int(far.argmin()))
        left[order[-1]] = False
    return pivots[order]


def pivots_of(d: DataFrame, p: Params) -> tuple[Cells, int, int]:
    """(pivots, rows, anchors)."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, anchors, most = 0, 0, 0.0
        for batch in batches:
            lengths = batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
            rows += batch.num_rows
            anchors += int((batch.column("vec_id").to_numpy() % p.every == 0).sum())
            for dim in np.unique(lengths).tolist():
                x = rectangle(batch.column("x"), dim, np.flatnonzero(lengths == dim))
                q = np.floor(x[near(x, p.scale)] * p.scale)
                most = max(most, float((q * q).sum(axis=1).max(initial=0.0)))
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([anchors], pa.int64()), pa.array([most])], ["rows", "anchors", "most"])

    rows, anchors, most = d.mapInArrow(profile, "rows long, anchors long, most double").agg(F.sum("rows"), F.sum("anchors"), F.max("most")).first()
    cells = Cells(most or 0.0, {})
    if rows:
        wanted = max(1, min(p.cells, rows // p.rows_per_cell))
        drawn = d.select(F.xxhash64(F.lit(p.seed), "vec_id").alias("h"), "x").orderBy("h", "x").limit(wanted).collect()
        for dim in {len(r["x"]) for r in drawn}:
            x = np.array([r["x"] for r in drawn if len(r["x"]) == dim])
            q = np.floor(x[near(x, p.scale)] * p.scale)
            if len(q):
                cells.pivots[dim] = chain(cells.augmented(np.unique(q, axis=0)))
    return cells, rows or 0, anchors or 0


PLACED = "dim int, cell int, far double, h long, vec_id long, label long, x binary"
BLOCKS = "dim int, cell int, block long, rows int, low double, high double, ids binary, labels binary, x binary, counts array<struct<label:long,n:long>>"


def blocks_of(d: DataFrame, cells: Cells, p: Params, anchors: bool, parts: int) -> DataFrame:
    """Rows in blocks of one length and of one cell (anchors: of cells that follow each other), in the order of cells.

    Rows are ranged by cell and, within a cell, by hash, so that a cell with many rows is spread over tasks."""
    known = d.sparkSession.sparkContext.broadcast(cells)  # at most `cells` pivots

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = known.value
        for batch in batches:
            lengths = batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == dim)
                x = rectangle(batch.column("x"), dim, rows)
                cell, far = np.full(len(rows), NOWHERE, np.int32), np.zeros(len(rows))
                fine = np.flatnonzero(near(x, p.scale))
                if dim in c.pivots and len(fine):
                    q = np.floor(x[fine] * p.scale)
                    gaps = c.distances(np.concatenate([q, np.zeros((len(q), 1))], axis=1) if anchors else c.augmented(q), dim)
                    cell[fine] = gaps.argmin(axis=1)
                    far[fine] = gaps[np.arange(len(fine)), cell[fine]]
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), dim, np.int32)), pa.array(cell), pa.array(far), batch.column("h").take(take), batch.column("vec_id").take(take), batch.column("label").take(take), pa.array([v.astype("<f8").tobytes() for v in x], pa.binary())], ["dim", "cell", "far", "h", "vec_id", "label", "x"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, given, held = TaskContext.get().partitionId(), 0, []
        size = p.group if anchors else p.block

        def flush() -> pa.RecordBatch:
            nonlocal given, held
            dim, cell, _, _, _ = held[0]
            far, ids, labels = (np.array([r[k] for r in held], t) for k, t in ((2, "f8"), (3, "<i8"), (4, "<i8")))
            x = np.stack([values for _, values in rows])
            order = np.lexsort((labels, ids))
            counts = [{"label": int(k), "n": int(n)} for k, n in zip(*np.unique(labels, return_counts=True), strict=True)]
            out = [[dim], [cell], [(part << 32) + given], [len(held)], [float(far.min())], [float(far.max())], [ids[order].tobytes()], [labels[order].tobytes()], [x[order].astype("<f8").tobytes()], [counts]]
            given, held = given + 1, []
            rows.clear()
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.struct([("label", pa.int64()), ("n", pa.int64())]))]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], ["dim", "cell", "block", "rows", "low", "high", "ids", "labels", "x", "counts"])

        rows: list = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("dim", "cell", "far", "vec_id", "label", "x")), strict=True):
                if held and (row[0] != held[0][0] or (row[1] != held[0][1] and (not anchors or NOWHERE in (row[1], held[0][1]))) or len(held) >= size):
                    yield flush()
                held.append(row[:5])
                rows.append((None, np.frombuffer(row[5], "<f8")))
        if held:
            yield flush()

    placed = d.withColumn("h", F.xxhash64(F.lit(p.seed), "vec_id", "label")).mapInArrow(place, PLACED)
    ranged = placed.repartitionByRange(max(1, parts), "dim", "cell", "h").sortWithinPartitions("dim", "cell", "h")
    return written(ranged.mapInArrow(pack, BLOCKS), "anchors" if anchors else "blocks")


def known_cells(cells: Cells, blocks: DataFrame, p: Params) -> Cells:
    """With each cell's distances and counts, from the blocks' own few numbers."""
    dims = {dim: len(c) for dim, c in cells.pivots.items()}
    low, high, rows = ({dim: np.full(n, v) for dim, n in dims.items()} for v in (np.inf, -np.inf, 0.0))
    for r in blocks.where(F.col("cell") != NOWHERE).groupBy("dim", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows")).collect():  # a row for each cell
        low[r["dim"]][r["cell"]], high[r["dim"]][r["cell"]], rows[r["dim"]][r["cell"]] = r["low"], r["high"], r["rows"]
    of = blocks.where(F.col("cell") != NOWHERE).select("dim", "cell", F.explode("counts").alias("c")).groupBy("dim", "cell", "c.label").agg(F.sum("c.n").alias("n"))
    some = of.limit(p.most_counts + 1).collect()
    counts = None
    if len(some) <= p.most_counts:
        counts = {dim: {} for dim in dims}
        for r in some:
            counts[r["dim"]].setdefault(r["label"], np.zeros(dims[r["dim"]]))[r["cell"]] = r["n"]
    return Cells(cells.norm2, cells.pivots, low, high, rows, counts)


def widen(x, norm2: float):
    """A bound loosened beyond what rounding may do to a distance between rows of norms up to M."""
    return x * (1 + 1e-9) + 1e-6 * (1 + norm2**0.5)


def reach(upper: np.ndarray, counts: np.ndarray, wanted: int) -> np.ndarray:
    """For each anchor, the distance within which the cells hold `wanted` rows for certain; infinite where they do not."""
    order = np.argsort(upper, axis=1)
    enough = np.cumsum(np.take_along_axis(counts, order, axis=1), axis=1) >= wanted
    first = enough.argmax(axis=1)
    at = np.take_along_axis(upper, order, axis=1)[np.arange(len(upper)), first]
    return np.where(enough.any(axis=1), at, np.inf)


def needs(anchors: DataFrame, cells: Cells, p: Params, own: int, first: bool) -> DataFrame:
    """(group, dim, cell): the cells that may serve a group of anchors; `own` rows at most share an anchor's vec_id."""
    known = anchors.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = known.value
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                group, dim, cell = (batch.column(k)[i].as_py() for k in ("block", "dim", "cell"))
                out.append((group, dim, NOWHERE))
                if dim not in c.pivots:
                    continue
                some = c.rows[dim] > 0
                if cell != NOWHERE:
                    labels = np.frombuffer(batch.column("labels")[i].as_buffer(), "<i8")
                    q = np.floor(np.frombuffer(batch.column("x")[i].as_buffer(), "<f8").reshape(-1, dim) * p.scale)
                    gaps = c.distances(np.concatenate([q, np.zeros((len(q), 1))], axis=1), dim)
                    lower = np.maximum(0.0, np.maximum(gaps - c.high[dim], c.low[dim] - gaps))
                    upper = np.where(some, gaps + c.high[dim], np.inf)
                    same = np.stack([c.counts[dim].get(k, np.zeros(len(some))) for k in labels.tolist()]) if c.counts is not None else None
                    if first:
                        far = reach(upper, same, p.positives + own) if same is not None else np.full(len(q), np.inf)
                        wanted = lower <= widen(far, c.norm2)[:, None]
                        if same is not None:
                            wanted &= same > 0
                    else:
                        wanted = np.zeros(gaps.shape, bool)
                        base = (q * q).sum(axis=1) + c.norm2
                        for (lo, hi), at in rings(batch.column("found")[i].as_py(), p):
                            begin = np.sqrt(max(0.0, base[at] - 2 * hi))
                            end = np.sqrt(max(0.0, base[at] - 2 * lo))
                            inside = lower[at] >= widen(begin, c.norm2)
                            other = c.rows[dim] - same[at] if same is not None else None
                            if other is not None:
                                end = min(end, float(reach(np.where(inside, upper[at], np.inf)[None], np.where(inside, other, 0.0)[None], p.negatives)[0]))
                            wanted[at] |= (lower[at] <= widen(end, c.norm2)) & (widen(upper[at], c.norm2) >= begin) & (other > 0 if other is not None else True)
                    some = some & wanted.any(axis=0)
                out += [(group, dim, k) for k in np.flatnonzero(some).tolist()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32()), strict=True)], ["group", "dim", "cell"])

    return written(anchors.mapInArrow(run, "group long, dim int, cell int"), "needs")


def window_of(score: int, p: Params) -> tuple[int, int]:
    """The least and the largest score of a hard negative."""
    return -(-p.low * score // 100), p.high * score // 100


def rings(found: list[dict] | None, p: Params) -> list[tuple[tuple[int, int], int]]:
    """((least, largest score), anchor's place) of each positive whose window is not empty."""
    out = []
    for r in found or []:
        lo, hi = window_of(r["score"] if r["exact_score"] is None else int(r["exact_score"]), p)
        if lo <= hi:
            out.append(((lo, hi), r["at"]))
    return out


class Best:
    """The best rows so far of each asker (an anchor, or an anchor's positive): highest score first, then smallest id."""

    def __init__(self, askers: int, k: int):
        self.k, self.score, self.ids = k, np.full((askers, k), -np.inf), np.full((askers, k), np.iinfo(np.int64).max)
        self.large: dict[int, list] = {}  # asker: (score, id) of scores beyond exact floats

    def add(self, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Scores (askers x rows, exact floats) of rows with ascending ids."""
        masked = np.where(allowed, score, -np.inf)
        k = min(self.k, masked.shape[1])
        if masked.shape[1] > self.k:
            cut = -np.partition(-masked, k - 1, axis=1)[:, k - 1]
            # those above the cut, and of those at it the first
            above = masked > cut[:, None]
            room = k - above.sum(axis=1)
            at = (masked == cut[:, None]) & np.isfinite(masked)
            pick = above | (at & (np.cumsum(at, axis=1) <= room[:, None]))
        else:
            pick = np.isfinite(masked)
        who, which = np.nonzero(pick)
        place = np.arange(len(who)) - np.searchsorted(who, who)
        more = np.full((len(masked), k), -np.inf), np.full((len(masked), k), np.iinfo(np.int64).max)
        more[0][who, place], more[1][who, place] = masked[who, which], ids[which]
        score, found = np.concatenate([self.score, more[0]], axis=1), np.concatenate([self.ids, more[1]], axis=1)
        order = np.lexsort((found, -score), axis=1)[:, : self.k]
        self.score, self.ids = np.take_along_axis(score, order, axis=1), np.take_along_axis(found, order, axis=1)

    def add_large(self, asker: int, rows: list[tuple[int, int]]) -> None:
        self.large[asker] = sorted(self.large.get(asker, []) + rows, key=lambda r: (-r[0], r[1]))[: self.k]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        who, place = np.nonzero(np.isfinite(self.score))
        yield from zip(who.tolist(), self.score[who, place].astype(np.int64).tolist(), self.ids[who, place].tolist(), strict=True)
        for asker, rows in self.large.items():
            yield from ((asker, score, i) for score, i in rows)


MET = "group long, at int, place int, anchor_id long, vec_id long, score long, exact_score string"


def met(anchors: DataFrame, blocks: DataFrame, need: DataFrame, p: Params, first: bool) -> DataFrame:
    """The best rows of each anchor (first) or of each of its positives in every lane, from the blocks that may serve it."""
    spark = blocks.sparkSession
    groups, many, pairs = max(1, anchors.count()), max(1, blocks.count()), need.count()
    lanes = max(-(-many // p.blocks_per_lane), min(many, -(-2 * spark.sparkContext.defaultParallelism // groups)))
    served = blocks.select("dim", "cell", "block", F.col("ids").alias("c_ids"), F.col("labels").alias("c_labels"), F.col("x").alias("c_x"))
    served = served.join(F.broadcast(need) if pairs <= p.most_needs else need, ["dim", "cell"]).drop("dim")
    served = served.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int"))
    asking = anchors.select(F.col("block").alias("group"), "dim", F.col("cell").alias("a_cell"), F.col("ids").alias("a_ids"), F.col("labels").alias("a_labels"), F.col("x").alias("a_x"), *([] if first else ["found"]))
    asking = asking.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    # a task works through the lanes it got, group by group
    both = asking.select("group", "lane", F.lit(0).alias("kind"), "dim", F.col("a_cell").alias("cell"), F.col("a_ids").alias("ids"), F.col("a_labels").alias("labels"), F.col("a_x").alias("x"), *([] if first else ["found"]))
    rows = served.select("group", "lane", F.lit(1).alias("kind"), F.lit(0).alias("dim"), "cell", F.col("c_ids").alias("ids"), F.col("c_labels").alias("labels"), F.col("c_x").alias("x"))
    if not first:
        rows = rows.withColumn("found", F.lit(None).cast(anchors.schema["found"].dataType))
    dealt = both.unionByName(rows).repartition(min(20_000, max(lanes * groups, 1)), "group", "lane").sortWithinPartitions("group", "lane", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = None, None

        def told() -> Iterator[pa.RecordBatch]:
            if state is not None:
                out = state.found(here[0])
                if out:
                    group, at, place, anchor, vec, score = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), pa.array(at, pa.int32()), pa.array(place, pa.int32()), pa.array(anchor, pa.int64()), pa.array(vec, pa.int64()), *far_scores(list(score))], ["group", "at", "place", "anchor_id", "vec_id", "score", "exact_score"])

        for batch in batches:
            for i in range(batch.num_rows):
                group, lane, kind, dim, cell = (batch.column(c)[i].as_py() for c in ("group", "lane", "kind", "dim", "cell"))
                ids, labels = (np.frombuffer(batch.column(c)[i].as_buffer(), "<i8") for c in ("ids", "labels"))
                x = np.frombuffer(batch.column("x")[i].as_buffer(), "<f8").reshape(len(ids), -1)
                if kind == 0:
                    yield from told()
                    here, state = (group, lane), Asking(ids, labels, x, cell, None if first else batch.column("found")[i].as_py(), p)
                else:
                    state.meet(ids, labels, x, cell)
        yield from told()

    return written(dealt.mapInArrow(run, MET), "met")


class Asking:
    """A group of anchors in one lane and what they have found so far."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, cell: int, found: list[dict] | None, p: Params):
        self.ids, self.labels, self.p, self.first = ids, labels, p, found is None
        self.large = cell == NOWHERE and not near(x, p.scale).all()
        self.x, self.q = x, None if self.large else np.floor(x * p.scale)
        if self.first:
            self.asker = np.arange(len(ids))
            self.place = np.zeros(len(ids), np.int32)
        else:
            asked = [(r["at"], r["place"], *window_of(r["score"] if r["exact_score"] is None else int(r["exact_score"]), p)) for r in found]
            asked = [a for a in asked if a[2] <= a[3]]
            self.asker = np.array([a[0] for a in asked], np.int64)
            self.place = np.array([a[1] for a in asked], np.int32)
            self.windows = [a[2:] for a in asked]
            clip = lambda v: float(max(-(1 << 52), min(1 << 52, v)))  # noqa: E731  # no float score lies beyond
            self.lo, self.hi = np.array([clip(w[0]) for w in self.windows]), np.array([clip(w[1]) for w in self.windows])
        self.best = Best(len(self.asker), p.positives if self.first else p.negatives)

    def meet(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, cell: int) -> None:
        if not len(self.asker):
            return
        if self.large or (cell == NOWHERE and not near(x, self.p.scale).all()):
            self.meet_large(ids, labels, x)
            return
        score = self.q @ np.floor(x * self.p.scale).T
        if self.first:
            self.best.add(score, (self.labels[:, None] == labels) & (self.ids[:, None] != ids), ids)
            return
        step = max(1, (1 << 21) // max(1, len(ids)))  # askers at a time, so that a block takes bounded memory
        for k in range(0, len(self.asker), step):
            a = self.asker[k : k + step]
            s = score[a]
            part = Best(len(a), self.best.k)
            part.score, part.ids = self.best.score[k : k + step], self.best.ids[k : k + step]
            part.add(s, (s >= self.lo[k : k + step, None]) & (s <= self.hi[k : k + step, None]) & (self.labels[a][:, None] != labels), ids)
            self.best.score[k : k + step], self.best.ids[k : k + step] = part.score, part.ids

    def meet_large(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        a, b = quantised(self.x, self.p.scale).astype(object), quantised(x, self.p.scale).astype(object)
        for k, at in enumerate(self.asker.tolist()):
            score = (b * a[at]).sum(axis=1).tolist()
            if self.first:
                fine = [(s, i) for s, i, label in zip(score, ids.tolist(), labels.tolist(), strict=True) if label == self.labels[at] and i != self.ids[at]]
            else:
                lo, hi = self.windows[k]
                fine = [(s, i) for s, i, label in zip(score, ids.tolist(), labels.tolist(), strict=True) if lo <= s <= hi and label != self.labels[at]]
            self.best.add_large(k, fine)

    def found(self, group: int) -> list[tuple]:
        return [(group, int(self.asker[k]), int(self.place[k]), int(self.ids[self.asker[k]]), vec, score) for k, score, vec in self.best.rows()]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each (group, at, place), with their rank: lanes have handed on k rows each at most."""
    rank = F.row_number().over(W.partitionBy("group", "at", "place").orderBy(*score_order(), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)


def mined(vectors: DataFrame, p: Params = Params()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank)."""
    d = labelled(vectors, p)
    cells, rows, asking = pivots_of(d, p)
    spread = 4 * d.sparkSession.sparkContext.defaultParallelism
    blocks = blocks_of(d, cells, p, False, max(min(spread, -(-rows // p.block)), -(-rows // (64 * p.block))))
    anchors = blocks_of(d.where(F.pmod("vec_id", F.lit(p.every)) == 0), cells, p, True, -(-asking // (8 * p.group)))
    cells = known_cells(cells, blocks, p)
    own = d.where(F.pmod("vec_id", F.lit(p.every)) == 0).groupBy("vec_id").count().agg(F.max("count")).first()[0] or 1
    need = needs(anchors, cells, p, own, True)
    found = met(anchors, blocks, need, p, True)
    positives = written(ranked(found, p.positives).drop("place").withColumnRenamed("rank", "place"), "positives")
    drop_written(need), drop_written(found)
    # at most `positives` rows for each of a group's anchors
    told = positives.groupBy("group").agg(F.collect_list(F.struct("at", "place", "score", "exact_score")).alias("found"))
    asked = written(anchors.join(told.withColumnRenamed("group", "block"), "block"), "asked")
    need = needs(asked, cells, p, own, False)
    found = met(asked, blocks, need, p, False)
    for t in (blocks, anchors, asked, need):
        drop_written(t)
    plain = F.when(F.col("exact_score").isNull(), F.col("score"))
    negatives = ranked(found, p.negatives).select("group", "at", "place", "rank", F.col("vec_id").alias("negative_id"), plain.alias("negative_score"))
    return positives.select("group", "at", "place", "anchor_id", F.col("vec_id").alias("positive_id"), plain.alias("positive_score")).join(negatives, ["group", "at", "place"])


def op12_hard_negatives(vectors: DataFrame, p: Params = Params()) -> DataFrame:
    return mined(vectors, p).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", F.col("place").alias("positive_rank"))


ORACLE = """
with v as materialized (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as q
  from embeddings where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: isfinite(x::double))) = len(embedding)),
s as materialized (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::bigint as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0),
p as (select * from (select *, row_number() over (partition by anchor_id order by score desc, vec_id)::int as positive_rank from s where same) where positive_rank <= 5),
n as (select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score, p.positive_rank,
    row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id)::int as rank
  from p join s on p.anchor_id = s.anchor_id and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank from n where rank <= 3
"""
