"""Alignments in their binary form (BAM) as a Spark data source, and a writer with position indices.

Without filters a file is cut into runs of bytes. A task finds the first member of its run by its checksum and in it the first record by its form, and
reads every record that begins within the run. When it is through, it knows where the next run's first record truly stands, and raises an error if
the next task looks for it elsewhere: a cut never gives other rows than a whole read. Filters on chrom and pos0 read the index beside
the file (.csi or .bai), where there is one, and only the parts that it names.

The writer makes a file of each range of (chromosome, position, name), each headed and indexed like a whole one: by .bai, or by .csi where its records
reach beyond the 2^29 positions that a .bai can hold. A record holds positions up to 2^31 - 2; a chromosome that goes on beyond is several references, as it is usual with
such genomes: itself, and one for each further 2^31 - 1 positions that hold something, whose line in the header says of which chromosome it is and at which position it begins
(``of:chr3``, ``at:2147483647``). The reader gives chromosomes and positions as they were, and takes filters so; other programs see the parts.

A row holds the fields of the text form: positions count from 0, tags are their text (``CB:Z:AC-1``), missing fields are null.

Defined cases: a file without records has no rows; reads without a place are null in chrom and pos0 and written last; whole tags are written in the smallest form that holds
them; a place beyond 2^31 - 2 without a chromosome is an error; bytes of tags that are not UTF-8 are read as the mark of replacement; more than 65,535 steps of a cigar stand in the tag that the format has for them; a base that the format does not know is N; qualities of another length than the bases are an
error; a null or empty name is ``*``; a record or member that is cut short is an error; a chromosome that is not among the sizes is an error when it is written.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from locuslake.sources import bgzf
from locuslake.sources.files import listed, opened, put

# fixed values of the format
MAGIC, INDEX, DEEP_INDEX = b"BAM\1", b"BAI\1", b"CSI\1"
FIXED = struct.Struct("<iiBBHHHiiii")
STEPS = "MIDNSHP=X"
BASES = "=ACMGRSVTWYHKDBN"
MOST = 1 << 29  # of positions in an index of bins and windows
FARTHEST, DEEP = (1 << 31) - 1, 6  # of positions in a record, and the levels of bins that hold them
SHORT, KEPT = 64, 1 << 14  # letters of a tag or cigar that a task keeps once it is packed, and how many of them
FILE_ROWS = 1_000_000  # about as many in a file, where there are more than a file for each core would hold
WHOLE = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I"}
SCHEMA = "name string, flag int, chrom string, pos0 long, mapq int, cigar string, next_chrom string, next_pos0 long, length long, seq string, qual string, tags array<string>"
ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
FIELDS = [tuple(f.split()) for f in SCHEMA.split(", ")]

DIGITS = "0123456789abcdef"
TO_BASE = str.maketrans(DIGITS, BASES)
TO_DIGIT = str.maketrans({**dict.fromkeys(map(chr, range(256)), DIGITS[BASES.index("N")]), **dict(zip(BASES + BASES.lower(), DIGITS * 2, strict=True))})
UP = bytes(min(q + 33, 255) for q in range(256))
DOWN = bytes(max(q - 33, 0) for q in range(256))


# ---- one record ------------------------------------------------------------------------------------------


def tags_of(data: bytes) -> list[str]:
    out, at = [], 0
    while at < len(data):
        name, kind, at = data[at : at + 2].decode("latin-1"), chr(data[at + 2]), at + 3
        if kind in WHOLE:
            (value,) = struct.unpack_from("<" + WHOLE[kind], data, at)
            at, kind = at + struct.calcsize(WHOLE[kind]), "i"
        elif kind == "f":
            value, at = str(np.frombuffer(data, "<f4", 1, at)[0]), at + 4
        elif kind == "A":
            value, at = chr(data[at]), at + 1
        elif kind in "ZH":
            end = data.index(0, at)
            value, at = data[at:end].decode("utf-8", "replace"), end + 1
        elif kind == "B":
            inner, (n,) = chr(data[at]), struct.unpack_from("<i", data, at + 1)
            items = np.frombuffer(data, "<f4" if inner == "f" else np.dtype(WHOLE[inner]).newbyteorder("<"), n, at + 5)
            value, at = ",".join([inner, *map(str, items)]), at + 5 + items.nbytes
        else:
            raise ValueError(f"unknown kind of tag {kind}")
        out.append(f"{name}:{kind}:{value}")
    return out


def packed_tag(text: str) -> bytes:
    name, kind, value = text.split(":", 2)
    lead = name.encode("latin-1")
    if len(lead) != 2:
        raise ValueError(f"{name} is no name of a tag")
    if kind == "i":
        n = int(value)
        form = next((k for k in "cCsSiI" if _fits(k, n)), None)
        if form is None:
            raise ValueError(f"{text} is beyond the format")
        return lead + form.encode() + struct.pack("<" + WHOLE[form], n)
    if kind == "f":
        return lead + b"f" + struct.pack("<f", float(value))
    if kind == "A":
        return lead + b"A" + value.encode("latin-1")[:1].ljust(1)
    if kind in "ZH":
        return lead + kind.encode() + value.encode().replace(b"\0", b"") + b"\0"
    if kind == "B":
        inner, *items = value.split(",")
        x = np.array(items, np.float64 if inner == "f" else np.int64).astype("<f4" if inner == "f" else np.dtype(WHOLE[inner]).newbyteorder("<"))
        return lead + b"B" + inner.encode() + struct.pack("<i", len(items)) + x.tobytes()
    raise ValueError(f"unknown kind of tag {kind}")


def _fits(kind: str, n: int) -> bool:
    bits = 8 * struct.calcsize(WHOLE[kind])
    return -(1 << bits - 1) <= n < 1 << bits - 1 if kind.islower() else 0 <= n < 1 << bits


def steps_of(cigar: str | None) -> list[int]:
    if not cigar:
        return []
    found = re.findall(f"([0-9]+)([{STEPS}])", cigar)
    if "".join(n + s for n, s in found) != cigar:
        raise ValueError(f"{cigar} is no cigar")
    return [int(n) << 4 | STEPS.index(s) for n, s in found]


def span_of(steps: Iterable[int]) -> int:
    """Positions of the reference that steps cover: those of M, D, N, = and X."""
    return sum(x >> 4 for x in steps if x & 15 in (0, 2, 3, 7, 8))


def packed_steps(cigar: str | None) -> tuple[int, int, bytes]:
    """(number of steps, span, bytes) of a cigar."""
    steps = steps_of(cigar)
    return len(steps), span_of(steps), struct.pack(f"<{len(steps)}I", *steps)


_kept_tag, _kept_steps = lru_cache(KEPT)(packed_tag), lru_cache(KEPT)(packed_steps)


def row_of(record: bytes, names: list[str], starts: list[int] | None = None) -> tuple:
    """The row of a record; names and starts are the chromosome and the first position of each reference."""
    ref, pos, l_name, mapq, _, n_steps, flag, n, ref2, pos2, length = FIXED.unpack_from(record)
    at = FIXED.size + l_name
    name = record[FIXED.size : at - 1].decode("latin-1")
    steps = struct.unpack_from(f"<{n_steps}I", record, at)
    at += 4 * n_steps
    seq, at = record[at : at + (n + 1) // 2].hex()[:n].translate(TO_BASE), at + (n + 1) // 2
    qual = record[at : at + n]
    if n and qual[0] != 255 and max(qual) > 93:
        raise ValueError(f"{name} has a quality beyond 93")
    tags = tags_of(record[at + n :])
    if n_steps == 2 and steps[0] == n << 4 | 4 and steps[1] & 15 == 3:
        held = [t for t in tags if t.startswith("CG:B:I,")]
        if held:
            steps, tags = [int(x) for x in held[0][7:].split(",")], [t for t in tags if t is not held[0]]
    cigar = "".join(f"{x >> 4}{STEPS[x & 15]}" for x in steps)
    if starts:
        pos, pos2 = pos + starts[ref] * (ref >= 0 <= pos), pos2 + starts[ref2] * (ref2 >= 0 <= pos2)
    return (
        name, flag, names[ref] if ref >= 0 else None, pos if pos >= 0 else None, mapq, cigar or None, names[ref2] if ref2 >= 0 else None, pos2 if pos2 >= 0 else None,
        length, seq or None, qual.translate(UP).decode("latin-1") if n and qual[0] != 255 else None, tags,
    )


def record_of(row: tuple, numbers: dict[str, int], most: int = MOST) -> tuple[int, int | None, int, bytes]:
    """(number of its chromosome, start or None, stop, bytes) of a row in the order of SCHEMA, which begins before position `most`."""
    name, flag, chrom, pos0, mapq, cigar, chrom2, pos2, length, seq, qual, tags = row
    n_steps, span, steps = (_kept_steps if len(cigar or "") < SHORT else packed_steps)(cigar)
    tags, n = b"".join([_kept_tag(t) if len(t) < SHORT else packed_tag(t) for t in tags or []]), len(seq or "")
    pos = -1 if pos0 is None else pos0
    if not -1 <= pos < most:
        raise ValueError(f"{name} begins beyond position {most}")
    stop = pos + max(1, span)
    if n_steps > 65535:
        tags += b"CGBI" + struct.pack("<i", n_steps) + steps
        n_steps, steps = 2, struct.pack("<2I", n << 4 | 4, span << 4 | 3)
    if seq and qual is not None and len(qual) != n:
        raise ValueError(f"{name} has {n} bases and {len(qual)} qualities")
    lead = (name or "*").encode("latin-1", "replace")[:254] + b"\0"
    body = steps
    if seq:
        body += bytes.fromhex(seq.translate(TO_DIGIT) + "0" * (n & 1)) + (b"\xff" * n if qual is None else qual.encode("latin-1").translate(DOWN))
    ref = -1 if chrom is None else numbers[chrom]
    bin_ = 4680 if pos < 0 else bgzf.bin_of(pos, stop) if stop <= MOST else 0  # a deep index has no use for it
    fixed = FIXED.pack(ref, pos, len(lead), mapq or 0, bin_, n_steps, flag or 0, n, -1 if chrom2 is None else numbers[chrom2], -1 if pos2 is None else pos2, length or 0)
    out = fixed + lead + body + tags
    return ref, pos if ref >= 0 and pos >= 0 else None, stop, struct.pack("<i", len(out)) + out


# ---- reading ---------------------------------------------------------------------------------------------


def texts(stream: pa.NativeFile, at: int, size: int, piece: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(place, text) of the members from place `at` on, read in pieces."""
    held, base = b"", at
    while at < size:
        if at - base + (1 << 16) > len(held) and base + len(held) < size:
            stream.seek(at)
            held, base = stream.read(piece), at
        if len(held) - (at - base) < bgzf.MEMBER.size:
            raise ValueError("the file ends before its data do")
        n = bgzf.MEMBER.unpack_from(held, at - base)[11] + 1
        if at + n > size:
            raise ValueError("the file ends before its data do")
        ((_, text),) = bgzf.members(held[at - base : at - base + n])
        yield at, text
        at += n


def origins(text: str, names: list[str]) -> tuple[list[str], list[int]]:
    """The chromosome and the first position of each reference: what the header says of parts of a chromosome, else itself and 0."""
    held = {}
    for line in text.split("\n"):
        if line.startswith("@SQ\t") and "\tof:" in line and "\tat:" in line:
            f = dict(x.split(":", 1) for x in line.split("\t")[1:] if ":" in x)
            if f["of"] in names and f["of"] != f.get("SN") and f["at"].isdecimal() and int(f["at"]) % FARTHEST == 0:  # others may mean other things by these letters
                held[f.get("SN")] = (f["of"], int(f["at"]))
    return [held.get(n, (n, 0))[0] for n in names], [held.get(n, (n, 0))[1] for n in names]


class File:
    """A file's names, and where its first record stands."""

    def __init__(self, path: str):
        system, inner = opened(path)
        self.stream = system.open_input_file(inner)
        self.size = self.stream.size()

    def header(self) -> tuple[str, list[str], int]:
        """(text, names of chromosomes, place of the first record)."""
        data, ends = bytearray(), []

        def more() -> bool:
            place, text = next(walk, (None, b""))
            data.extend(text)
            ends.append((len(data), place))
            return place is not None

        walk = texts(self.stream, 0, self.size)

        def need(n: int) -> None:
            while len(data) < n:
                if not more():
                    raise ValueError("the file ends before its data do")

        need(8)
        if data[:4] != MAGIC:
            raise ValueError("this is no BAM file")
        at = 8 + struct.unpack_from("<i", data, 4)[0]
        need(at + 4)
        text, (n,) = bytes(data[8:at]).rstrip(b"\0").decode(), struct.unpack_from("<i", data, at)
        names, at = [], at + 4
        for _ in range(n):
            need(at + 4)
            (length,) = struct.unpack_from("<i", data, at)
            need(at + 8 + length)
            names.append(bytes(data[at + 4 : at + 3 + length]).decode())
            at += 8 + length
        before = 0
        for end, place in ends:
            if at < end:
                return text, names, place << 16 | at - before
            before = end
        while (item := next(walk, None)) is not None:  # the records begin with a member
            if item[1]:
                return text, names, item[0] << 16
        return text, names, self.size << 16

    def records(self, begin: int, stop: int) -> Iterator[tuple[int, bytes]]:
        """(place, record) of those that begin at `begin` or later and before `stop`, and last (place, b"") of the first one that does not, if there is one."""
        tail, tail_at, skip = b"", 0, begin & 0xFFFF
        for place, text in texts(self.stream, begin >> 16, self.size):
            data, at, left = tail + text[skip:], 0, len(tail)
            while at < len(data):
                here = tail_at if left and at == 0 else place << 16 | at - left + skip
                if here >= stop:
                    yield here, b""
                    return
                end = at + 4 + struct.unpack_from("<i", data, at)[0] if at + 4 <= len(data) else len(data) + 1
                if end > len(data):
                    tail_at = here
                    break
                yield here, data[at + 4 : end]
                at = end
            tail, skip = data[at:], 0
        if tail:
            raise ValueError("the file ends within a record")

    def first(self, start: int, n_ref: int) -> int | None:
        """The place of the first record that begins in a member at `start` or later, by the forms of members and records; None without one."""
        place = self._member(start)
        while place is not None and place < self.size:
            walk, data, marks = texts(self.stream, place, self.size), b"", []
            for at, text in walk:
                marks.append(at)
                data += text
                if len(marks) == 1:
                    own = len(text)
                if len(data) >= own + (1 << 18):
                    break
            whole = next(walk, None) is None
            for u in range(own):
                if _chained(data, u, n_ref, whole):
                    return place << 16 | u
            place = marks[1] if len(marks) > 1 else None
        return None

    def _member(self, start: int) -> int | None:
        self.stream.seek(start)
        data, k = self.stream.read(1 << 18), -1
        while (k := data.find(b"\x1f\x8b\x08\x04", k + 1)) >= 0:
            try:
                next(bgzf.members(data[k : k + (1 << 16)]))
                return start + k
            except (ValueError, struct.error, bgzf.zlib.error):
                continue  # bytes within a member that look like a head
        return None


def _chained(data: bytes, u: int, n_ref: int, whole: bool) -> bool:
    """Whether records follow one another from u to the end of the data (whole: of the file)."""
    seen = False
    while u + 4 + FIXED.size <= len(data):
        (size,) = struct.unpack_from("<i", data, u)
        ref, pos, l_name, _, _, n_steps, _, n, ref2, pos2, _ = FIXED.unpack_from(data, u + 4)
        if not (-1 <= ref < n_ref and -1 <= ref2 < n_ref and pos >= -1 and pos2 >= -1 and l_name and n >= 0):
            return False
        if size < FIXED.size + l_name + 4 * n_steps + (n + 1) // 2 + n:
            return False
        name = data[u + 4 + FIXED.size : u + 4 + FIXED.size + l_name]
        if len(name) == l_name and (name[-1] or any(c < 33 for c in name[:-1])):
            return False
        u, seen = u + 4 + size, True
    return seen and (not whole or u == len(data))


@dataclass
class Run(InputPartition):
    path: str
    names: list[str]  # of the chromosome of each reference
    starts: list[int]  # its first position
    begin: int  # a place if exact, else a byte to look from
    stop: int
    exact: bool
    checked: bool  # whether the next run looks for its first record


@dataclass
class Bounds:
    chroms: frozenset[str] | None = None
    least: int = 0
    below: int = 1 << 63


def parts_in(index: bytes, names: list[str], starts: list[int], bounds: Bounds) -> list[tuple[int, int]]:
    """The parts of a file, as (begin, stop) places, that may hold records within the bounds, merged; names and starts as in Run."""
    if index[:2] == b"\x1f\x8b":
        index = b"".join(text for _, text in bgzf.members(index))
    deep = index[:4] == DEEP_INDEX
    if not deep and index[:4] != INDEX:
        raise ValueError("this is no position index")
    finest, levels, more = struct.unpack_from("<iii", index, 4) if deep else (bgzf.SHIFT, bgzf.LEVELS, 0)
    at, out = 16 + more if deep else 4, []
    (n_ref,), at = struct.unpack_from("<i", index, at), at + 4
    bins: dict[int, set[int]] = {}  # that are wanted of a reference, by its first position
    for start in {s for name, s in zip(names, starts, strict=True) if name in bounds.chroms}:
        least, below = max(bounds.least - start, 0), min(bounds.below - start, FARTHEST, 1 << finest + 3 * levels)
        bins[start] = bgzf.bins_over(least, below, levels, finest) if least < below else set()
    for k in range(n_ref):
        (n_bin,), at, some, firsts = struct.unpack_from("<i", index, at), at + 4, [], {}
        wanted, first = bins[starts[k]] if names[k] in bounds.chroms else (), max(bounds.least - starts[k], 0)
        for _ in range(n_bin):
            (number,), at = struct.unpack_from("<I", index, at), at + 4
            if deep:
                (firsts[number],), at = struct.unpack_from("<Q", index, at), at + 8
            (n,), at = struct.unpack_from("<i", index, at), at + 4
            if number in wanted:
                some += [struct.unpack_from("<QQ", index, at + 16 * i) for i in range(n)]
            at += 16 * n
        if deep:
            least = _least(firsts, first >> finest, levels)
        else:
            (n_win,) = struct.unpack_from("<i", index, at)
            w = first >> bgzf.SHIFT
            least = struct.unpack_from("<Q", index, at + 4 + 8 * w)[0] if w < n_win else 1 << 63
            at += 4 + 8 * n_win
        out += [(max(a, least), z) for a, z in some if z > least]
    merged: list[list[int]] = []
    for a, z in sorted(out):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], z)
        else:
            merged.append([a, z])
    return [(a, z) for a, z in merged]


def _least(firsts: dict[int, int], window: int, levels: int) -> int:
    """The place before which nothing reaches a window of the finest level, from the first places of bins: that of the nearest bin before it or around it."""
    number = ((1 << 3 * levels) - 1) // 7 + window
    while number and number not in firsts:
        number = number - 1 if number - 1 & 7 else number - 1 >> 3  # the bin before it in the same parent, else the parent
    return firsts.get(number, 0)


class Reader(DataSourceReader):
    def __init__(self, options):
        self.paths = listed(options["path"], options.get("suffix", ".bam"))
        self.bytes = max(1, int(options.get("bytes", 32 << 20)))  # of a run
        self.bounds = Bounds()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters choose parts by the index; Spark applies them all to the rows that are left."""
        b = self.bounds
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name == "chrom" and isinstance(f, (EqualTo, In)):
                some = frozenset([f.value] if isinstance(f, EqualTo) else f.value)
                b.chroms = some if b.chroms is None else b.chroms & some
            if name == "pos0" and isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                b.below = min(b.below, f.value + (not isinstance(f, LessThan)))
            if name == "pos0" and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                b.least = max(b.least, f.value + isinstance(f, GreaterThan))
            yield f

    def partitions(self) -> list[Run]:
        out: list[Run] = []
        for path in self.paths:
            file = File(path)
            text, names, first = file.header()
            names, starts = origins(text, names)
            system, inner = opened(path)
            index = next((inner + x for x in (".csi", ".bai") if self.bounds.chroms is not None and system.get_file_info(inner + x).type == fs.FileType.File), None)
            if index:
                with system.open_input_file(index) as stream:
                    out += [Run(path, names, starts, a, z, True, False) for a, z in parts_in(stream.read(), names, starts, self.bounds)]
                continue
            edges = [*range(first >> 16, file.size, self.bytes)]
            for k, edge in enumerate(edges):
                last = k == len(edges) - 1
                out.append(Run(path, names, starts, edge if k else first, (file.size if last else edges[k + 1]) << 16, k == 0, not last))
        return out or [Run("", [], [], 0, 0, True, False)]

    def read(self, run: Run) -> Iterator[pa.RecordBatch]:
        if not run.path:
            return
        file = File(run.path)
        begin = run.begin if run.exact else file.first(run.begin, len(run.names))
        rows, size, end, starts = [], 0, begin, run.starts if any(run.starts) else None
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, ARROW[t]) for c, (_, t) in zip(zip(*rows, strict=True), FIELDS, strict=True)], [f for f, _ in FIELDS])
        if begin is not None:
            end = None
            for place, record in file.records(begin, run.stop):
                if not record:
                    end = place
                    break
                rows.append(row_of(record, run.names, starts))
                size += len(record)
                if size > 4 << 20 or len(rows) == 8192:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()
        if run.checked and file.first(run.stop >> 16, len(run.names)) != end:
            raise ValueError(f"{run.path} cannot be cut at byte {run.stop >> 16}: read it with larger `bytes`")


class Bam(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options)


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    """The alignments of a file, or of all below a folder; where() on chrom and pos0 reaches the index. Option `bytes`: of a run of the file, for one task."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Bam)
    return spark.read.format("bam").options(path=path, **options).load()


# ---- writing ---------------------------------------------------------------------------------------------


class Indexed(bgzf.File):
    """A file in the making, with bins and windows for each chromosome."""

    levels = DEEP

    def __init__(self) -> None:
        super().__init__()
        self.refs: dict[int, tuple[dict, dict]] = {}
        self.reach = 0

    def of(self, header: bytes, records: Iterable[tuple[int, int | None, int, bytes]]) -> Iterator[bytes]:
        def rows() -> Iterator[tuple[int | None, int, bytes]]:
            yield None, 0, header
            for ref, start, stop, data in records:
                if start is not None:
                    self.bins, self.windows = self.refs.setdefault(ref, ({}, {}))
                    self.reach = max(self.reach, stop)
                yield start, stop, data

        return self.lines(rows())

    def index(self, n_ref: int) -> tuple[str, bytes]:
        """(ending of its name, bytes): an index of bins and windows, or a deep one where records reach beyond that."""
        deep = self.reach > MOST
        out = [DEEP_INDEX + struct.pack("<iii", bgzf.SHIFT, DEEP, 0) if deep else INDEX, struct.pack("<i", n_ref)]
        for k in range(n_ref):
            bins, windows = self.refs.get(k, ({}, {}))
            n, firsts = max(windows, default=-1) + 1, []
            for w in range(n):
                firsts.append(windows.get(w, firsts[-1] if firsts else 0))
            out.append(struct.pack("<i", len(bins)))
            for number, chunks in sorted(bins.items()):
                level = next(x for x in range(DEEP, -1, -1) if number >= ((1 << 3 * x) - 1) // 7)
                place = number - ((1 << 3 * level) - 1) // 7
                if deep:
                    out.append(struct.pack("<IQi", number, firsts[place << 3 * (DEEP - level)], len(chunks)))
                else:  # the same bin, a level higher up
                    out.append(struct.pack("<Ii", ((1 << 3 * (level - 1)) - 1) // 7 + place, len(chunks)))
                out += [struct.pack("<QQ", *c) for c in chunks]
            if not deep:
                out.append(struct.pack(f"<i{n}Q", n, *firsts))
        data = b"".join(out)
        return (".csi", b"".join(bgzf.member(data[k : k + bgzf.MOST]) for k in range(0, len(data), bgzf.MOST)) + bgzf.END) if deep else (".bai", data)


@dataclass
class Layout:
    """The references of files: the chromosomes, each followed by its parts beyond what a record can hold."""

    refs: list[tuple[str, int]]  # names and lengths
    beyond: dict[str, tuple[str, int]]  # of parts: the chromosome and the first position
    rows: int  # of reads

    def __post_init__(self) -> None:
        self.numbers = {name: k for k, (name, _) in enumerate(self.refs)}
        self.parts = {place: name for name, place in self.beyond.items()}

    def placed(self, row: tuple) -> tuple:
        """The row with its places, and its mate's, in references."""
        if max(row[3] or 0, row[7] or 0) < FARTHEST:
            return row
        return (*row[:2], *self._within(*row[2:4]), *row[4:6], *self._within(*row[6:8]), *row[8:])

    def _within(self, chrom: str | None, pos: int | None) -> tuple[str | None, int | None]:
        if chrom is None or pos is None or pos < FARTHEST:
            return chrom, pos
        start = pos // FARTHEST * FARTHEST
        if (chrom, start) not in self.parts:
            raise ValueError(f"{chrom} is not known to go on beyond position {start}")
        return self.parts[chrom, start], pos - start


def layout(reads: DataFrame, sizes: DataFrame) -> Layout:
    """How files hold the reads; a pass over their places."""
    place = lambda chrom, pos, n: F.struct(F.col(chrom).cast("string").alias("chrom"), F.col(pos).cast("long").alias("pos"), F.lit(n).alias("n"))
    places = reads.select(F.explode(F.array(place("chrom", "pos0", 1), place("next_chrom", "next_pos0", 0))).alias("_at")).select("_at.*")
    far = F.col("pos") >= FARTHEST
    found = places.groupBy(F.when(far, F.col("chrom")).alias("chrom"), F.when(far, F.expr(f"pos div {FARTHEST}")).alias("part")).agg(F.sum("n").alias("n"), F.max("pos").alias("last"))
    found = found.collect()  # a row, and one for each part of a chromosome
    lasts = {(r["chrom"], r["part"]): r["last"] for r in found if r["chrom"] is not None}
    refs, beyond = [], {}
    named = [(r["chrom"], r["size"]) for r in sizes.orderBy("chrom_ord").collect()]  # a row for each chromosome
    taken = {chrom for chrom, _ in named}
    for chrom, size in named:
        refs.append((chrom, min(size, FARTHEST)))
        for part in sorted({*range(1, -(-size // FARTHEST)), *(k for c, k in lasts if c == chrom)}):
            start, name = part * FARTHEST, f"{chrom}_part{part + 1}"
            while name in taken:
                name += "_"
            taken.add(name)
            refs.append((name, max(min(size - start, FARTHEST), lasts.get((chrom, part), 0) + 1 - start)))
            beyond[name] = (chrom, start)
    return Layout(refs, beyond, sum(r["n"] for r in found))


def headed(sizes: list[tuple[str, int]], comments: list[str], beyond: dict[str, tuple[str, int]] | None = None) -> bytes:
    # the format's lines, as fixed
    parts = {name: f"\tof:{chrom}\tat:{start}" for name, (chrom, start) in (beyond or {}).items()}
    text = "".join(f"{x}\n" for x in ["@HD\tVN:1.6\tSO:coordinate", *(f"@SQ\tSN:{name}\tLN:{size}{parts.get(name, '')}" for name, size in sizes), *(f"@CO\t{c}" for c in comments)]).encode()
    refs = b"".join(struct.pack("<i", len(name) + 1) + name + b"\0" + struct.pack("<i", size) for name, size in ((n.encode(), s) for n, s in sizes))
    return MAGIC + struct.pack("<i", len(text)) + text + struct.pack("<i", len(sizes)) + refs


def write(reads: DataFrame, sizes: DataFrame, path: str, files: int | None = None, comments: list[str] | None = None, held: Layout | None = None) -> Layout:
    """reads as indexed files below `path`, one for each of about `files` ranges (else a million rows a file, and a file for each core at least).

    sizes (chrom, chrom_ord, size) has a row for each chromosome and gives their order. How positions are laid out is worked out by a pass over the places of
    reads, unless `held` says it, as of reads that lie where these do; it is returned.
    """
    held = held or layout(reads, sizes)
    header = headed(held.refs, comments or [], held.beyond)
    cols = [f for f, _ in FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple[int, int | None, int, bytes]]:
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in cols), strict=True):
                    yield record_of(held.placed(row), held.numbers, FARTHEST)

        some = records()
        first = next(some, None)
        if first is not None:

            def all_() -> Iterator[tuple[int, int | None, int, bytes]]:
                yield first
                yield from some

            name, file = f"part-{TaskContext.get().partitionId():05d}.bam", Indexed()
            size = put(f"{path.rstrip('/')}/{name}", file.of(header, all_()))
            ending, index = file.index(len(held.refs))
            put(f"{path.rstrip('/')}/{name}{ending}", [index])
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64())], ["name", "size"])

    d = reads.select(*(F.col(c).cast(t).alias(c) for c, t in FIELDS))
    known = sizes.select("chrom", F.col("chrom_ord").alias("_ord"))
    n = files or max(reads.sparkSession.sparkContext.defaultParallelism, -(-held.rows // FILE_ROWS))
    order = [F.col("_ord").asc_nulls_last(), F.col("pos0").asc_nulls_first(), "name", "flag"]  # without a position before its chromosome's parts
    d.join(F.broadcast(known), "chrom", "left").repartitionByRange(n, *order).sortWithinPartitions(*order).select(*cols).mapInArrow(run, "name string, size long").count()
    return held
