"""WARC (3): writing pages as gzip members, one for each record, and a sequential reader.

Writing: each page becomes a response record, or a revisit record where an equal payload of at least
`least` bytes belongs to a page of larger page_id. Every record is a gzip member of its own. Tasks join the members of
up to `chunk` bytes into a value, and Spark's text writer puts the values into files with nothing added: its line
separator is an empty gzip member, which is valid between members and ends the file.

Reading: a file's bytes are fed piece by piece to an incremental zlib decompressor, member by member. The
record's header gives its content length, the block is framed by it, and digests of block and payload are
verified; a break in any of these raises ValueError.

Defined cases: a null or empty html is an empty payload and always a response; page_id null sorts below
all others; rows that tie for the largest page_id of a payload are all responses; repeated rows are records of their
own; a url that is null is written empty; an empty table gives no archive and no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslake.llm.shared import new_path, small_batches

SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


@dataclass(frozen=True)
class Params:
    least: int = 1000  # bytes of a payload that a revisit may stand for
    level: int = 6
    chunk: int = 4 << 20  # bytes of members in one value
    values_per_file: int = 8
    salts: int = 16


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _id(page_id: int | None, record: str) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{record}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The WARC/1.1 record of one page; digest is the payload's."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    uri = "".join([c for c in url or "" if c not in "\r\n"])
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(page_id, 'revisit' if revisit else 'response')}", f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_id(refers_to, 'response')}"]
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Block-Digest: {_sha1(block)}", f"WARC-Payload-Digest: {digest}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


EMPTY_MEMBER = member(b"", 6)


def marked(pages: DataFrame, p: Params = Params()) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): which records revisit which, decided by payload digest and length.

    The responses' table has one row for each repeated payload, from an aggregate combined before its
    shuffle; pages meet it under a salt, so that a payload with a third of all pages spreads over tasks.
    """
    d = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    d = d.withColumn("hex", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    again = d.where(F.col("size") >= p.least).groupBy("hex", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    again = again.select(F.col("hex").alias("_h"), F.col("size").alias("_n"), "first", F.explode(F.sequence(F.lit(0), F.lit(p.salts - 1))).alias("_s"))
    d = d.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(p.salts)).cast("int"))
    d = d.join(again, (d["hex"] == F.col("_h")) & (d["size"] == F.col("_n")) & (d["salt"] == F.col("_s")), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return d.select("page_id", "url", "payload", "hex", refers.alias("refers_to"))


def write(pages: DataFrame, path: str, p: Params = Params()) -> None:
    """Write the archives of all pages below `path`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in small_batches(batches, "payload"):
            for page_id, url, payload, digest, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "hex", "refers_to")), strict=True):
                digest = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
                held.append(member(record(page_id, url, payload, digest, refers), p.level))
                size += len(held[-1])
                if size >= p.chunk:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

    members = marked(pages, p).mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    members.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("maxRecordsPerFile", p.values_per_file).text(path)


class Reader:
    """Records of one archive, from its bytes in order; holds one record and a piece of the input."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces = iter(pieces)

    def members(self) -> Iterator[bytes]:
        z, held = None, b""
        out: list[bytes] = []
        for piece in self.pieces:
            held += piece
            while held:
                z = z or zlib.decompressobj(31)
                try:
                    out.append(z.decompress(held))
                except zlib.error as e:
                    raise ValueError(f"broken gzip member: {e}") from e
                held = z.unused_data
                if not z.eof:
                    break
                yield b"".join(out)
                z, out = None, []
        if z is not None:
            raise ValueError("the archive ends within a gzip member")

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """(headers, block) of each record."""
        for data in self.members():
            if not data:
                continue  # between the values of the writer
            end = data.find(b"\r\n\r\n")
            if end < 0 or not data.startswith(b"WARC/"):
                raise ValueError("no WARC header at the start of a member")
            headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in data[:end].decode().split("\r\n")[1:])
            size = int(headers["Content-Length"])
            block = data[end + 4 : end + 4 + size]
            if len(block) != size or data[end + 4 + size :] != b"\r\n\r\n":
                raise ValueError("a record's content length does not frame its block")
            if "WARC-Block-Digest" in headers and headers["WARC-Block-Digest"] != _sha1(block):
                raise ValueError("a block does not have its digest")
            yield headers, block

    def pages(self) -> Iterator[tuple[int | None, int, str, str, int | None]]:
        """(page_id, payload_bytes, payload_digest in hex, record_type, refers_to) of each record."""
        name = lambda x: None if (n := x.split(":")[2]) == "none" else int(n)
        for headers, block in self.records():
            head, _, payload = block.partition(b"\r\n\r\n")
            told = int(next(line[16:] for line in head.split(b"\r\n") if line.lower().startswith(b"content-length: ")))
            revisit = headers["WARC-Type"] == "revisit"
            if revisit and payload or not revisit and (len(payload) != told or _sha1(payload) != headers["WARC-Payload-Digest"]):
                raise ValueError("a payload does not have its length or digest")
            digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
            yield name(headers["WARC-Record-ID"]), told, digest, headers["WARC-Type"], name(headers["WARC-Refers-To"]) if revisit else None


def read(spark: SparkSession, path: str, piece: int = 1 << 16) -> DataFrame:
    """The records of all archives below `path`; a file, of bounded size, is read by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for i in range(batch.num_rows):
                data = memoryview(batch.column("content")[i].as_buffer())
                rows = list(Reader(bytes(data[k : k + piece]) for k in range(0, len(data), piece)).pages())
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds[c]) for c in range(5)], names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, SCHEMA)


def op3_warc(pages: DataFrame, p: Params = Params()) -> DataFrame:
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write(pages, path, p)
    return read(spark, path)


ORACLE = """
with d as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
m as (select *, max(page_id) over (partition by payload_digest, payload_bytes) as first from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id is distinct from first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id is distinct from first then first end as refers_to
from m
"""
