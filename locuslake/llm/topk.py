"""Exact top-k search (2): a bit-sliced index over quantised vectors.

Each component is floor(scale * x). The index holds, for a block of rows, one bitmap for each bit of each
component (the components shifted to be non-negative). A query's inner products with all rows of a block are
bit-sliced numbers too: the bitmaps of its components are added by carry-save adders, one multiplier bit at a
time, negative multipliers by the complement. From the most significant slice downward the rows are
narrowed to the k best; rows that tie at the boundary are resolved exactly, by their score and vec_id.

Blocks of rows meet blocks of queries in cells (index block, group of query blocks); each cell is a partition of its
own, so that tasks are of one size. A query's best of each block
are merged by a second selection. Nothing but a fixed number of rows for each query and block leaves a task.

Defined cases: vectors that are null, empty or that hold null or non-finite
components take no part, nor do rows without vec_id; finite components of any size do: rows and queries too large for bitmaps of
long scores are scored with Python's integers, rank by their exact scores, and a score that no long holds is null beside its digits in
`exact_score` (which is null for all others); vectors of several lengths only meet those of their own; a query leaves out every row with its own vec_id;
repeated rows stand beside each other as candidates and each of them asks; ties go to the smaller vec_id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from locuslake.llm.shared import LARGE, drop_written, far_scores, quantised, score_order, taking_part, written


@dataclass(frozen=True)
class Params:
    scale: int = 256
    every: int = 50  # queries: rows whose vec_id is divisible by it
    k: int = 5
    rows: int = 8192  # of an index block
    queries: int = 128  # of a query block
    asked: int = 8192  # queries that one task works on
    partitions: int = 20_000  # at most, of the cells


def slices(values: np.ndarray, bits: int) -> np.ndarray:
    """bits x dim x words: bitmaps over rows of the bits of non-negative values (rows x dim); the rows fill 64-bit words."""
    n, dim = values.shape
    words = -(-n // 64)
    out = np.zeros((bits, dim, words * 8), dtype=np.uint8)
    for b in range(bits):
        packed = np.packbits(((values >> b) & 1).astype(np.uint8), axis=0, bitorder="little")
        out[b, :, : packed.shape[0]] = packed.T
    return out.view(np.uint64)


def carry_save_sum(terms: np.ndarray, width: int) -> np.ndarray:
    """Bit-sliced sum (width x words) of bit-sliced numbers (numbers x bits x words), by a tree of carry-save adders."""
    n, bits, words = terms.shape
    live = np.zeros((n, width, words), dtype=np.uint64)
    live[:, :bits] = terms
    top = bits  # slices that may be set so far
    while len(live) > 2:
        third = len(live) // 3
        a, b, c = live[:third, :top], live[third : 2 * third, :top], live[2 * third : 3 * third, :top]
        half = a ^ b
        top = min(width, top + 1)
        new = np.zeros((2 * third + len(live) - 3 * third, width, words), dtype=np.uint64)
        new[:third, : a.shape[1]] = half ^ c
        carry = (a & b) | (half & c)
        new[third : 2 * third, 1:top] = carry[:, : top - 1]
        new[2 * third :] = live[3 * third :]
        live = new
    if len(live) == 1:
        return live[0]
    a, b = live
    out, carry = np.zeros_like(a), np.zeros(words, dtype=np.uint64)
    for s in range(width):
        half = a[s] ^ b[s]
        out[s] = half ^ carry
        carry = (a[s] & b[s]) | (half & carry)
    return out


def narrow(score: np.ndarray, alive: np.ndarray, k: int) -> np.ndarray:
    """Bitmap of the k rows of largest score and of all that tie with the last of them."""
    sure, tied = np.zeros_like(alive), alive.copy()
    for s in range(len(score) - 1, -1, -1):
        up = tied & score[s]
        if int(np.bitwise_count(sure).sum()) + int(np.bitwise_count(up).sum()) >= k:
            tied = up
        else:
            sure |= up
            tied &= ~score[s]
    return sure | tied


class Block:
    """The index of up to `rows` vectors."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.large = values.dtype == object
        if self.large:
            return  # scored by integers of any size
        self.low = int(values.min())
        self.bits = max(1, (int(values.max()) - self.low).bit_length())
        self.most = max(int(values.max()), -self.low)
        self.slices = slices(self.values - self.low, self.bits)
        self.words = self.slices.shape[2]
        alive = np.zeros(self.words * 8, dtype=np.uint8)
        full = np.packbits(np.ones(len(ids), np.uint8), bitorder="little")
        alive[: len(full)] = full
        self.alive = alive.view(np.uint64)
        self.by_dim = np.ascontiguousarray(self.slices.transpose(1, 0, 2))
        self.flipped = ~self.by_dim

    def best(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(vec_ids, scores) of the k best rows other than the query's own id."""
        if self.large or query.dtype == object or sum(map(int, np.abs(query))) * self.most >= 1 << 62:
            other = np.flatnonzero(self.ids != own)
            exact = (self.values[other].astype(object) * query.astype(object)).sum(axis=1)
            order = sorted(range(len(other)), key=lambda i: (-exact[i], self.ids[other[i]]))[:k]
            return self.ids[other][order], exact[order]
        size = np.abs(query)
        total_size = sum(map(int, size))
        width = (total_size * ((1 << self.bits) - 1)).bit_length() + 1
        parts = []
        for b in range(int(size.max()).bit_length()):
            chosen = np.flatnonzero((size >> b) & 1)
            if len(chosen):
                terms = np.where((query[chosen] > 0)[:, None, None], self.by_dim[chosen], self.flipped[chosen])
                total = carry_save_sum(terms, min(width, self.bits + len(chosen).bit_length()))
                shifted = np.zeros((width, self.words), dtype=np.uint64)
                top = min(width, b + len(total))
                shifted[b:top] = total[: top - b]
                parts.append(shifted)
        score = carry_save_sum(np.stack(parts), width) if parts else np.zeros((1, self.words), dtype=np.uint64)
        alive = self.alive.copy()
        a, z = np.searchsorted(self.ids, [own, own + 1])
        for i in range(a, z):
            alive[i >> 6] &= ~np.uint64(1 << (i & 63))
        kept = np.flatnonzero(np.unpackbits(narrow(score, alive, k).view(np.uint8), bitorder="little"))
        exact = self.values[kept].astype(np.int64) @ query.astype(np.int64)
        order = np.lexsort((self.ids[kept], -exact))[:k]  # the boundary: by score, then vec_id
        return self.ids[kept][order], exact[order]


BLOCKS = "part int, dim int, first long, ids binary, values binary"


def packed(vectors: DataFrame, size: int, most: int = 256) -> DataFrame:
    """(part, dim, first, ids, values): the rows of each partition (its number is `part`) in blocks of one vector length and of
    `size` rows at most, as little-endian int64 and float64 bytes; `first` counts the rows before the block. Rows with large
    components stand in blocks of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, given = TaskContext.get().partitionId(), {}, 0

        def block(key: tuple[int, bool]) -> pa.RecordBatch:
            nonlocal given
            ids, values = (np.concatenate(x) for x in zip(*held.pop(key), strict=True))
            first, given = given, given + len(ids)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([key[0]], pa.int32()), pa.array([first], pa.int64()), pa.array([ids.astype("<i8").tobytes()]), pa.array([values.astype("<f8").tobytes()])], ["part", "dim", "first", "ids", "values"])

        for batch in batches:
            q = batch.column("x")
            ids, lengths = batch.column("vec_id").to_numpy(), q.value_lengths().to_numpy(zero_copy_only=False)
            flat, ends = q.flatten().to_numpy(), np.cumsum(lengths)
            for dim in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == dim)
                values = flat[(ends[rows] - dim)[:, None] + np.arange(dim)]
                outsize = np.abs(values).max(axis=1) * most >= LARGE
                for large in (False, True):
                    mine, v = rows[outsize == large], values[outsize == large]
                    for k in range(0, len(mine), size):
                        held.setdefault((dim, large), []).append((ids[mine[k : k + size]], v[k : k + size]))
                        if sum(len(x) for x, _ in held[dim, large]) >= size:
                            yield block((dim, large))
        for key in [*held]:
            yield block(key)

    return vectors.mapInArrow(run, BLOCKS)


def search(vectors: DataFrame, p: Params = Params()) -> DataFrame:
    """(query_id, rank, vec_id, score, exact_score): the k best candidates of each query row."""
    d = taking_part(vectors)
    asking = d.where(F.pmod("vec_id", F.lit(p.every)) == 0)
    lanes, groups = max(1, -(-d.count() // p.rows)), max(1, -(-asking.count() // p.asked))
    # dealt out in turn, so that every lane and every group has about as many rows
    index = packed(d.repartition(lanes), 2 * p.rows, p.scale)
    asked = written(packed(asking.repartition(groups), p.queries, p.scale), "asked")
    cell = lambda lane, group: (lane * F.lit(groups) + group).cast("int")
    index = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select(cell(F.col("part").cast("long"), F.col("group")).alias("cell"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("ask"), "dim", "ids", "values")
    asked_ = asked.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).select(cell(F.col("lane").cast("long"), F.col("part")).alias("cell"), F.lit(1).alias("kind"), (F.col("part").cast("long") * F.lit(1 << 40) + F.col("first")).alias("ask"), "dim", "ids", "values")
    met = index.unionByName(asked_).repartitionById(min(p.partitions, lanes * groups), "cell").sortWithinPartitions("cell", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, blocks = None, {}
        for batch in batches:
            for at, kind, ask, dim, ids, values in zip(*(batch.column(c).to_pylist() for c in ("cell", "kind", "ask", "dim")), batch.column("ids"), batch.column("values"), strict=True):
                if at != cell:
                    cell, blocks = at, {}
                names, vectors = np.frombuffer(ids.as_buffer(), "<i8"), quantised(np.frombuffer(values.as_buffer(), "<f8").reshape(-1, dim), p.scale)
                if kind == 0:
                    blocks.setdefault(dim, []).append(Block(names, vectors))
                    continue
                out = [(np.full(len(found), ask + i), np.full(len(found), q), found, score) for block in blocks.get(dim, []) for i, (q, v) in enumerate(zip(names.tolist(), vectors, strict=True)) for found, score in [block.best(q, v, p.k)]]
                if out:
                    asks, queries, found, score = (np.concatenate(x) for x in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(asks.astype(np.int64)), pa.array(queries.astype(np.int64)), pa.array(found.astype(np.int64)), *far_scores(score.tolist())], ["ask", "query_id", "vec_id", "score", "exact_score"])

    part = written(met.mapInArrow(run, "ask long, query_id long, vec_id long, score long, exact_score string"), "found")
    drop_written(asked)
    rank = F.row_number().over(W.partitionBy("ask").orderBy(*score_order(), "vec_id"))
    best = part.withColumn("rank", rank.cast("int")).where(F.col("rank") <= p.k)
    return best.select("query_id", "rank", "vec_id", F.when(F.col("exact_score").isNull(), F.col("score")).alias("score"), "exact_score")


ORACLE = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as q from embeddings),
s as (select a.vec_id as query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::bigint as score
      from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score, null::varchar as exact_score from r where rank <= 5
"""
