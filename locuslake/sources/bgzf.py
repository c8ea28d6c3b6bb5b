"""Block gzip with a position index: variants written by ranges of (chromosome, position) and read back by range.

A range of a chromosome is one file: gzip members of up to 64 KB, cut at line borders, each saying its own length, so that a reader can
start at any of them; and beside it the index of the format, which maps bins of positions and windows of 16 KB to places in the file. The
ranges are Spark's, so a chromosome is as many files as its share of the rows asks for, each written by one task and headed like a whole file.

Defined cases: an empty table writes no file; rows without chromosome or position are left out; positions may repeat; a line longer than a member runs on in
the next; a range that no file covers gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslake.sources.files import listed, opened, put

# fixed values of the formats
MEMBER = struct.Struct("<4BI2BH2B2H")
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
MOST = 65280  # bytes of text in a member
SHIFT, LEVELS = 14, 5


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    if len(body) > 65000:  # text that does not shrink is stored as it is
        z = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = z.compress(data) + z.flush()
    return MEMBER.pack(31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + MEMBER.size + 7) + body + struct.pack("<II", zlib.crc32(data), len(data))


def members(data: bytes, at: int = 0) -> Iterator[tuple[int, bytes]]:
    """(place, text) of each member from `at` on."""
    while at < len(data):
        head = MEMBER.unpack_from(data, at)
        if head[:2] != (31, 139) or head[8:10] != (66, 67):
            raise ValueError("no block gzip member at this place")
        size = head[11] + 1
        text = zlib.decompress(data[at + MEMBER.size : at + size - 8], -15)
        if struct.unpack_from("<II", data, at + size - 8) != (zlib.crc32(text), len(text)):
            raise ValueError("a member does not have its checksum")
        yield at, text
        at += size


def bin_of(start: int, stop: int, levels: int = LEVELS) -> int:
    """The smallest bin that holds the positions start to stop - 1: 8 times finer on each of the levels below the whole."""
    for level in range(levels, 0, -1):
        shift = SHIFT + 3 * (levels - level)
        if start >> shift == (stop - 1) >> shift:
            return ((1 << 3 * level) - 1) // 7 + (start >> shift)
    return 0


def bins_over(start: int, stop: int, levels: int = LEVELS, finest: int = SHIFT) -> set[int]:
    """All bins that may hold rows within start to stop - 1."""
    out = {0}
    for level in range(1, levels + 1):
        shift = finest + 3 * (levels - level)
        first = ((1 << 3 * level) - 1) // 7
        out |= {*range(first + (start >> shift), first + ((stop - 1) >> shift) + 1)}
    return out


class File:
    """A file in the making: members out, and where each row stands."""

    levels = LEVELS

    def __init__(self) -> None:
        self.held, self.size, self.place = [], 0, 0
        self.bins: dict[int, list[list[int]]] = {}
        self.windows: dict[int, int] = {}

    def _flush(self) -> Iterator[bytes]:
        data = b"".join(self.held)
        for k in range(0, len(data), MOST):
            block = member(data[k : k + MOST])
            self.place += len(block)
            yield block
        self.held, self.size = [], 0

    def lines(self, rows: Iterable[tuple[int | None, int, bytes]]) -> Iterator[bytes]:
        """The members of rows (start or None for the header, stop, line with its end), in order."""
        for start, stop, line in rows:
            if self.size and self.size + len(line) > MOST:
                yield from self._flush()
            begin = self.place << 16 | self.size
            self.held.append(line)
            self.size += len(line)
            if self.size > MOST:  # a long line fills members of its own
                yield from self._flush()
            if start is None:
                continue
            end = self.place << 16 | self.size
            chunks = self.bins.setdefault(bin_of(start, stop, self.levels), [])
            if chunks and chunks[-1][1] == begin:
                chunks[-1][1] = end
            else:
                chunks.append([begin, end])
            for w in range(start >> SHIFT, ((stop - 1) >> SHIFT) + 1):
                self.windows.setdefault(w, begin)
        yield from self._flush()
        yield END

    def index(self, chrom: str) -> bytes:
        name = chrom.encode() + b"\0"
        out = [b"TBI\1", struct.pack("<8i", 1, 2, 1, 2, 0, ord("#"), 0, len(name)), name, struct.pack("<i", len(self.bins))]
        for k, chunks in sorted(self.bins.items()):
            out.append(struct.pack("<Ii", k, len(chunks)))
            out += [struct.pack("<QQ", *c) for c in chunks]
        n, before = max(self.windows, default=-1) + 1, 0
        out.append(struct.pack("<i", n))
        for w in range(n):
            before = self.windows.get(w, before)
            out.append(struct.pack("<Q", before))
        data = b"".join(out)
        return b"".join(member(data[k : k + MOST]) for k in range(0, len(data), MOST)) + END


def places(index: bytes, chrom: str, start: int, stop: int) -> list[tuple[int, int]]:
    """The parts of a file, as places of its index, that may hold rows of chrom within start to stop - 1."""
    data = b"".join(text for _, text in members(index))
    if data[:4] != b"TBI\1":
        raise ValueError("this is no position index")
    n_ref, *_, length = struct.unpack_from("<8i", data, 4)
    names, at = data[36 : 36 + length].split(b"\0")[:n_ref], 36 + length
    for name in names:
        (n_bin,), at = struct.unpack_from("<i", data, at), at + 4
        bins = {}
        for _ in range(n_bin):
            k, n = struct.unpack_from("<Ii", data, at)
            bins[k] = [struct.unpack_from("<QQ", data, at + 8 + 16 * i) for i in range(n)]
            at += 8 + 16 * n
        (n_win,), at = struct.unpack_from("<i", data, at), at + 4
        windows = struct.unpack_from(f"<{n_win}Q", data, at)
        at += 8 * n_win
        if name.decode() == chrom:
            least = windows[start >> SHIFT] if start >> SHIFT < n_win else 1 << 63
            return sorted((max(a, least), z) for k in bins_over(start, stop) for a, z in bins.get(k, []) if z > least)
    return []


def text_at(path: str, parts: list[tuple[int, int]]) -> Iterator[bytes]:
    """The text between places of a file; only the members it stands in are read."""
    system, inner = opened(path)
    with system.open_input_file(inner) as stream:
        size = stream.size()
        for a, z in parts:
            stream.seek(a >> 16)
            data = stream.read(min(size, (z >> 16) + (1 << 16)) - (a >> 16))
            for at, text in members(data):
                here = at + (a >> 16)
                if here > z >> 16 or (here == z >> 16 and not z & 0xFFFF):
                    break
                yield text[(a & 0xFFFF) if here == a >> 16 else 0 : (z & 0xFFFF) if here == z >> 16 else len(text)]
                if here == z >> 16:
                    break  # what follows may be part of a member


def write(lines: DataFrame, header: list[str], path: str, files: int | None = None) -> DataFrame:
    """Lines (chrom, chrom_ord, pos0, value) as indexed files below `path`; what was written, as (name, chrom, first, last, rows), is kept beside them and returned."""
    top = [f"{h}\n".encode() for h in header]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state = TaskContext.get().partitionId(), {}

        def rows() -> Iterator[tuple[str, int, bytes]]:
            for batch in batches:
                yield from ((c, p, f"{v}\n".encode()) for c, p, v in zip(*(batch.column(k).to_pylist() for k in ("chrom", "pos0", "value")), strict=True))

        todo = rows()
        row = next(todo, None)
        while row is not None:
            chrom, first, file = row[0], row[1], File()

            def of_one(chrom=chrom) -> Iterator[tuple[int | None, int, bytes]]:
                nonlocal row
                yield from ((None, 0, h) for h in top)
                state.update(n=0)
                while row is not None and row[0] == chrom:
                    state.update(n=state["n"] + 1, last=row[1])
                    yield row[1], row[1] + 1, row[2]
                    row = next(todo, None)

            name = f"{chrom}/{part:05d}.vcf.gz"
            put(f"{path}/{name}", file.lines(of_one()))
            put(f"{path}/{name}.tbi", [file.index(chrom)])
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([chrom]), pa.array([first], pa.int64()), pa.array([state["last"]], pa.int64()), pa.array([state["n"]], pa.int64())], ["name", "chrom", "first", "last", "rows"])

    path = path.rstrip("/")
    n = files or lines.sparkSession.sparkContext.defaultParallelism
    d = lines.where("chrom is not null and pos0 is not null").select("chrom", "chrom_ord", F.col("pos0").cast("long").alias("pos0"), "value")
    made = d.repartitionByRange(n, "chrom_ord", "chrom", "pos0").sortWithinPartitions("chrom_ord", "chrom", "pos0", "value").mapInArrow(run, "name string, chrom string, first long, last long, rows long")
    made.write.parquet(f"{path}/files")
    return lines.sparkSession.read.schema(made.schema).parquet(f"{path}/files")


def lines_in(spark: SparkSession, path: str, ranges: list[tuple[str, int, int]]) -> DataFrame:
    """(value): the lines whose 0-based positions lie in any of the ranges (chrom, start, stop), through the indices: a task for each file that a range meets."""
    path = path.rstrip("/")
    files = spark.read.parquet(f"{path}/files")
    asked = spark.createDataFrame([(i, *r) for i, r in enumerate(ranges)], "i int, chrom string, start long, stop long").where("stop > start")
    hit = files.join(F.broadcast(asked), "chrom").where((F.col("first") < F.col("stop")) & (F.col("last") >= F.col("start"))).groupBy("name", "chrom").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, inner = opened(f"{path}/{row['name']}.tbi")
                with system.open_input_file(inner) as stream:
                    index = stream.read()
                parts: list[list[int]] = []
                for a, z in sorted({x for r in row["ranges"] for x in places(index, row["chrom"], r["start"], r["stop"])}):
                    if parts and a <= parts[-1][1]:
                        parts[-1][1] = max(parts[-1][1], z)
                    else:
                        parts.append([a, z])
                held = []
                for line in b"".join(text_at(f"{path}/{row['name']}", [(a, z) for a, z in parts])).decode().split("\n"):
                    at = line.split("\t", 2)
                    if len(at) > 1 and not line.startswith("#") and any(r["start"] <= int(at[1]) - 1 < r["stop"] for r in row["ranges"]):
                        held.append(line)
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])

    return hit.repartition(max(1, min(2000, files.count())), "name").mapInArrow(run, "value string")


def files_of(path: str) -> list[str]:
    return listed(path, ".vcf.gz")
