"""bigWig files as a Spark data source, and a writer.

The driver reads a file's header, the tree of chromosome names and its index of data blocks: of the index only the nodes that
the pushed filters on chrom, start and stop leave open. Runs of neighbouring blocks become partitions; a task reads
its run in one go, inflates block by block and hands on Arrow batches. So a filtered read touches the needed blocks alone.

The writer makes a file of each range of (chrom, start), block by block; a folder of such files is read as one table.

Defined cases: a file without blocks has no rows; chromosomes that are not in a file give none; values are float32 in the file; rows of one file do not overlap by the
format, which the writer leaves to its caller; rows with nulls or without length are not written.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from locuslake.sources.files import listed, opened, put

# fixed values of the format
MAGIC, TREE, INDEX = 0x888FFC26, 0x78CA8C91, 0x2468ACE0
HEADER, TREE_HEAD, INDEX_HEAD, SECTION, NODE = struct.Struct("<IHHQQQHHQQIQ"), struct.Struct("<IIIIQQ"), struct.Struct("<IIQIIIIQII"), struct.Struct("<IIIIIBBH"), struct.Struct("<BBH")
LEAF, INNER = struct.Struct("<IIIIQQ"), struct.Struct("<IIIIQ")
BEDGRAPH, VARIABLE, FIXED = 1, 2, 3
SCHEMA = "chrom string, start long, stop long, value double"


@dataclass
class Bounds:
    """What the filters leave open: names (None: all), start < below, stop > above."""

    chroms: frozenset[str] | None = None
    below: int = 1 << 62
    above: int = -1


class File:
    """The header, names and index of one file; `touched` counts the bytes asked for."""

    def __init__(self, path: str):
        system, inner = opened(path)
        self.stream, self.touched = system.open_input_file(inner), 0
        head = HEADER.unpack(self.at(0, HEADER.size))
        if head[0] != MAGIC:
            raise ValueError(f"{path} is not a little-endian bigWig file")
        self.tree, self.index, self.packed = head[3], head[5], head[10] > 0

    def at(self, offset: int, size: int) -> bytes:
        self.touched += size
        self.stream.seek(offset)
        data = self.stream.read(size)
        if len(data) != size:
            raise ValueError("the file ends before its data do")
        return data

    def names(self) -> dict[int, tuple[str, int]]:
        """chromosome number: (name, size)."""
        magic, _, key, value, _, _ = TREE_HEAD.unpack(self.at(self.tree, TREE_HEAD.size))
        if magic != TREE or value != 8:
            raise ValueError("the chromosome tree is broken")
        out, todo = {}, [self.tree + TREE_HEAD.size]
        while todo:
            offset = todo.pop()
            leaf, _, n = NODE.unpack(self.at(offset, NODE.size))
            data = self.at(offset + NODE.size, n * (key + 8))
            for k in range(n):
                item = data[k * (key + 8) : (k + 1) * (key + 8)]
                if leaf:
                    number, size = struct.unpack("<II", item[key:])
                    out[number] = (item[:key].rstrip(b"\0").decode(), size)
                else:
                    todo.append(struct.unpack("<Q", item[key:])[0])
        return out

    def blocks(self, bounds: Bounds, names: dict[int, tuple[str, int]]) -> list[tuple[int, int]]:
        """(offset, size) of the data blocks that may hold rows within the bounds, in the order of the file."""
        if INDEX_HEAD.unpack(self.at(self.index, INDEX_HEAD.size))[0] != INDEX:
            raise ValueError("the index is broken")
        wanted = sorted(k for k, (name, _) in names.items() if bounds.chroms is None or name in bounds.chroms)

        def open_(c0: int, s: int, c1: int, e: int) -> bool:
            if not any(c0 <= k <= c1 for k in wanted):
                return False
            return c0 != c1 or (s < bounds.below and e > bounds.above)

        out, todo = [], [self.index + INDEX_HEAD.size]
        while todo:
            offset = todo.pop()
            leaf, _, n = NODE.unpack(self.at(offset, NODE.size))
            form = LEAF if leaf else INNER
            for item in form.iter_unpack(self.at(offset + NODE.size, n * form.size)):
                if open_(*item[:4]):
                    out.append(item[4:]) if leaf else todo.append(item[4])
        return sorted(out)


def decoded(block: bytes, names: dict[int, tuple[str, int]]) -> pa.RecordBatch:
    number, first, _, step, span, kind, _, n = SECTION.unpack_from(block)
    body = memoryview(block)[SECTION.size :]
    if kind == BEDGRAPH:
        x = np.frombuffer(body, np.dtype([("a", "<u4"), ("z", "<u4"), ("v", "<f4")]), n)
        start, stop, value = x["a"].astype(np.int64), x["z"].astype(np.int64), x["v"]
    elif kind == VARIABLE:
        x = np.frombuffer(body, np.dtype([("a", "<u4"), ("v", "<f4")]), n)
        start, value = x["a"].astype(np.int64), x["v"]
        stop = start + span
    elif kind == FIXED:
        value = np.frombuffer(body, "<f4", n)
        start = first + np.arange(n, dtype=np.int64) * step
        stop = start + span
    else:
        raise ValueError(f"unknown kind of block {kind}")
    chrom = pa.DictionaryArray.from_arrays(pa.array(np.zeros(n, np.int32)), pa.array([names[number][0]])).cast(pa.string())
    return pa.RecordBatch.from_arrays([chrom, pa.array(start), pa.array(stop), pa.array(value.astype(np.float64))], ["chrom", "start", "stop", "value"])


@dataclass
class Run(InputPartition):
    path: str
    blocks: list[tuple[int, int]]
    names: dict[int, tuple[str, int]]
    packed: bool


class Reader(DataSourceReader):
    def __init__(self, options):
        self.paths = listed(options["path"], options.get("suffix", ".bw"))
        self.most = int(options.get("bytes", 8 << 20))  # of a partition's blocks
        self.bounds = Bounds()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters close parts of the index; Spark applies them all to the rows that are left."""
        b = self.bounds
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name == "chrom" and isinstance(f, (EqualTo, In)):
                some = frozenset([f.value] if isinstance(f, EqualTo) else f.value)
                b.chroms = some if b.chroms is None else b.chroms & some
            elif name == "start" and isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                b.below = min(b.below, f.value + (not isinstance(f, LessThan)))
            elif name == "stop" and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                b.above = max(b.above, f.value - (not isinstance(f, GreaterThan)))
            if name == "start" and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                b.above = max(b.above, f.value)  # a row ends after its start
            elif name == "stop" and isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                b.below = min(b.below, f.value)
            yield f

    def partitions(self) -> list[Run]:
        out = []
        for path in self.paths:
            file = File(path)
            names = file.names()
            run, end, size = [], -1, 0
            for offset, length in file.blocks(self.bounds, names):
                if run and (offset != end or size + length > self.most):
                    out.append(Run(path, run, names, file.packed))
                    run, size = [], 0
                run.append((offset, length))
                end, size = offset + length, size + length
            if run:
                out.append(Run(path, run, names, file.packed))
        return out or [Run("", [], {}, False)]

    def read(self, run: Run) -> Iterator[pa.RecordBatch]:
        if not run.blocks:
            return
        first = run.blocks[0][0]
        data = memoryview(File(run.path).at(first, sum(n for _, n in run.blocks)))
        for offset, n in run.blocks:
            block = bytes(data[offset - first : offset - first + n])
            yield decoded(zlib.decompress(block) if run.packed else block, run.names)


class BigWig(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bigwig"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    """(chrom, start, stop, value) of a bigWig file, or of all below a folder; where() on chrom, start and stop reaches the index."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BigWig)
    return spark.read.format("bigwig").options(path=path, **options).load()


# ---- writing ---------------------------------------------------------------------------------------------


def indexed(leaves: list[tuple[int, int, int, int, int, int]], at: int, fan: int) -> bytes:
    """The index of data blocks (chrom, start, chrom, stop, offset, size) as it stands at offset `at`, root first, `fan` items a node."""
    levels: list[list[list[tuple]]] = [[leaves[k : k + fan] for k in range(0, len(leaves), fan)] or [[]]]
    bounds = lambda node: (*min(x[:2] for x in node), *max(x[2:4] for x in node))
    while len(levels[-1]) > 1:
        over = [bounds(node) for node in levels[-1]]
        levels.append([[(*b, k + i) for i, b in enumerate(over[k : k + fan])] for k in range(0, len(over), fan)])
    levels.reverse()
    sizes = [[NODE.size + len(node) * (LEAF.size if depth == len(levels) - 1 else INNER.size) for node in level] for depth, level in enumerate(levels)]
    begins, place = [], at + INDEX_HEAD.size
    for level in sizes:
        begins.append([])
        for n in level:
            begins[-1].append(place)
            place += n
    all_ = bounds(leaves) if leaves else (0, 0, 0, 0)
    end = leaves[-1][4] + leaves[-1][5] if leaves else at
    out = [INDEX_HEAD.pack(INDEX, fan, len(leaves), *all_, end, 1, 0)]
    for depth, level in enumerate(levels):
        for node in level:
            last = depth == len(levels) - 1
            out.append(NODE.pack(last, 0, len(node)))
            out += [LEAF.pack(*x) if last else INNER.pack(*x[:4], begins[depth + 1][x[4]]) for x in node]
    return b"".join(out)


def laid_out(sizes: list[tuple[str, int]], rows: Iterable[tuple[int, np.ndarray, np.ndarray, np.ndarray]], fan: int = 256) -> Iterator[bytes]:
    """The bytes of a file: sizes are (name, size) by number, rows are blocks (number, starts, stops, values) in order."""
    key = max([len(name.encode()) for name, _ in sizes] or [1])
    tree = [TREE_HEAD.pack(TREE, max(1, len(sizes)), key, 8, len(sizes), 0), NODE.pack(1, 0, len(sizes))]
    tree += [name.encode().ljust(key, b"\0") + struct.pack("<II", k, size) for k, (name, size) in enumerate(sizes)]
    tree, body, leaves, largest = b"".join(tree), [], [], 1
    place = HEADER.size + len(tree) + 8
    for number, start, stop, value in rows:
        x = np.empty(len(start), np.dtype([("a", "<u4"), ("z", "<u4"), ("v", "<f4")]))
        x["a"], x["z"], x["v"] = start, stop, value
        raw = SECTION.pack(number, int(start[0]), int(stop[-1]), 0, 0, BEDGRAPH, 0, len(start)) + x.tobytes()
        block, largest = zlib.compress(raw), max(largest, len(raw))
        leaves.append((number, int(start[0]), number, int(stop.max()), place, len(block)))
        body.append(block)
        place += len(block)
    yield HEADER.pack(MAGIC, 4, 0, HEADER.size, HEADER.size + len(tree), place, 0, 0, 0, 0, largest, 0)
    yield tree
    yield struct.pack("<Q", len(body))
    yield from body
    yield indexed(leaves, place, fan)
    yield struct.pack("<I", MAGIC)


def write(rows: DataFrame, sizes: DataFrame, path: str, files: int | None = None, block: int = 1024) -> None:
    """rows (chrom, start, stop, value) as bigWig files below `path`, one for each of about `files` ranges of (chrom, start). A range's rows, packed, are held
    by its task; sizes has a row (chrom, size) for each chromosome."""
    listed_ = [(r["chrom"], r["size"]) for r in sizes.orderBy("chrom").collect()]  # a row for each chromosome
    number = {name: k for k, (name, _) in enumerate(listed_)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[tuple]:
            chrom, held = None, []
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in ("chrom", "start", "stop", "value")), strict=True):
                    if held and (row[0] != chrom or len(held) == block):
                        yield number[chrom], *(np.array([r[k] for r in held]) for k in (1, 2, 3))
                        held = []
                    chrom = row[0]
                    held.append(row)
            if held:
                yield number[chrom], *(np.array([r[k] for r in held]) for k in (1, 2, 3))

        some = blocks()
        first = next(some, None)
        if first is not None:

            def all_() -> Iterator[tuple]:
                yield first
                yield from some

            name = f"part-{TaskContext.get().partitionId():05d}.bw"
            size = put(f"{path.rstrip('/')}/{name}", laid_out(listed_, all_()))
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64())], ["name", "size"])

    d = rows.where("chrom is not null and stop > start and value is not null").select("chrom", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), F.col("value").cast("double").alias("value"))
    n = files or rows.sparkSession.sparkContext.defaultParallelism
    d.repartitionByRange(n, "chrom", "start").sortWithinPartitions("chrom", "start", "stop").mapInArrow(run, "name string, size long").count()
