"""Alignments from BAM files, read in parallel by ranges of their compressed bytes.

A BAM file is a chain of small gzip blocks, and records run on over their
borders.  A task takes the blocks that begin in its range of bytes.  It finds
its first block by the block header, which must lead to another one, and its
first record by the fields of a record, which must lead to others; from there
on it reads record by record, and ends with the last one that begins in its
blocks.  So every record is read by one task, however the file is cut, and no
index is needed.

    spark.dataSource.register(BamSource)
    spark.read.format("bam").option("columns", "read,flag,chrom,pos").load("sample.bam")
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Columns of a record; ``pos`` and ``mate_pos`` count from 1 (0: none), ``quality`` sums base qualities of 15 and more.
COLUMNS = {
    "file": "string", "read": "string", "flag": "int", "chrom": "string", "pos": "long", "mapq": "int", "cigar": "string", "mate_chrom": "string", "mate_pos": "long", "tlen": "int", "sequence": "string", "quality": "long", "bases": "long",
}

# Fixed values of the format: block header, end block, operations and bases by code, operations that use the reference.
_MAGIC = b"\x1f\x8b\x08\x04"
_OPERATIONS, _BASES, _ON_REFERENCE = "MIDNSHP=X", "=ACMGRSVTWYHKDBN", frozenset("MDN=X")
_RECORD = struct.Struct("<iiiBBHHHiiii")
_MOST = 1 << 16  # bytes of a block at most


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


def _open(path: str):
    if "://" in path or path.startswith("file:"):
        system, inner = fs.FileSystem.from_uri(path)
    else:
        system, inner = fs.LocalFileSystem(), path
    return system, inner


class _Blocks:
    """The blocks of a file by their place, uncompressed; at most a few MB are held."""

    def __init__(self, path: str):
        system, inner = _open(path)
        self.size = system.get_file_info(inner).size
        self._file = system.open_input_file(inner)
        self._at, self._data = 0, b""

    def _bytes(self, at: int, n: int) -> bytes:
        if not (self._at <= at and at + n <= self._at + len(self._data)):
            self._file.seek(at)
            self._at, self._data = at, self._file.read(max(n, 4 << 20))
        return self._data[at - self._at : at - self._at + n]

    def length(self, at: int) -> int | None:
        """Bytes of the block at this place; None if none begins here."""
        head = self._bytes(at, 12)
        if len(head) < 12 or not head.startswith(_MAGIC):
            return None
        extra = self._bytes(at + 12, struct.unpack_from("<H", head, 10)[0])
        i = 0
        while i + 4 <= len(extra):
            n = struct.unpack_from("<H", extra, i + 2)[0]
            if extra[i : i + 2] == b"BC" and n == 2:
                return struct.unpack_from("<H", extra, i + 4)[0] + 1
            i += 4 + n
        return None

    def content(self, at: int, length: int) -> bytes:
        return zlib.decompressobj(31).decompress(self._bytes(at, length))

    def first(self, at: int) -> int | None:
        """The first place from ``at`` on where a block begins that uncompresses and leads to another or to the end."""
        while at < self.size:
            found = self._bytes(at, min(2 * _MOST, self.size - at)).find(_MAGIC)
            if found < 0:
                at += max(1, min(2 * _MOST, self.size - at) - 3)
                continue
            at += found
            n = self.length(at)
            if n and at + n <= self.size and (at + n == self.size or self.length(at + n)):
                try:
                    self.content(at, n)
                    return at
                except zlib.error:
                    pass
            at += 1
        return None

    def close(self) -> None:
        self._file.close()


class _Stream:
    """Uncompressed bytes from a block on, with the block in which each of them stands."""

    def __init__(self, blocks: _Blocks, at: int):
        self.blocks, self.next, self.data, self.at = blocks, at, bytearray(), 0
        self.marks: list[tuple[int, int]] = []  # (where a block's bytes begin in data, its place)

    def need(self, n: int) -> bool:
        """Whether n bytes stand ready from ``at`` on, after reading on as far as needed."""
        while len(self.data) - self.at < n and self.next < self.blocks.size:
            length = self.blocks.length(self.next)
            if length is None:
                raise ValueError(f"no block at byte {self.next}")
            self.marks.append((len(self.data), self.next))
            self.data += self.blocks.content(self.next, length)
            self.next += length
        return len(self.data) - self.at >= n

    def block(self) -> int:
        """The place of the block that holds the byte at ``at``."""
        while len(self.marks) > 1 and self.marks[1][0] <= self.at:
            self.marks.pop(0)
        return self.marks[0][1]

    def trim(self) -> None:
        if self.at > 1 << 20:
            self.block()
            del self.data[: self.at]
            self.marks = [(max(0, m - self.at), place) for m, place in self.marks]
            self.at = 0


def _references(stream: _Stream) -> list[tuple[str, int]]:
    """Name and length of the references; the stream then stands at the first record."""

    def take(n: int) -> bytes:
        if not stream.need(n):
            raise ValueError("the header is cut off")
        out = bytes(stream.data[stream.at : stream.at + n])
        stream.at += n
        return out

    if take(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    take(*struct.unpack("<i", take(4)))
    out = []
    for _ in range(struct.unpack("<i", take(4))[0]):
        name = take(struct.unpack("<i", take(4))[0])[:-1].decode()
        out.append((name, struct.unpack("<i", take(4))[0]))
    return out


def _is_record(data: bytearray, at: int, references: list[tuple[str, int]]) -> int | None:
    """The bytes of what may be a record at this place; None if its fields cannot be those of one."""
    size, ref, pos, name, _, _, operations, _, bases, mate, mate_pos, _ = _RECORD.unpack_from(data, at)
    if not (32 <= size < 1 << 28 and name > 0 and bases >= 0):
        return None
    for r, p in ((ref, pos), (mate, mate_pos)):
        if not -1 <= r < len(references) or p < -1 or (r >= 0 and p > references[r][1]):
            return None
    if 32 + name + 4 * operations + (bases + 1) // 2 + bases > size:
        return None
    text = data[at + 36 : at + 36 + name]
    if len(text) == name and (text[-1] != 0 or any(not 33 <= c <= 126 for c in text[:-1])):
        return None
    codes = data[at + 36 + name : at + 36 + name + 4 * operations : 4]
    return None if any(c & 15 > 8 for c in codes) else size + 4


def _settle(stream: _Stream, references: list[tuple[str, int]], limit: int, chain: int = 8) -> bool:
    """Move to the first place, in a block that begins before ``limit``, from which records follow one another; False if there is none."""
    while stream.need(36):
        if stream.block() >= limit:
            return False
        at, good = stream.at, 0
        while good < chain:
            stream.need(at - stream.at + 36 + 512)
            if len(stream.data) - at < 36:
                break  # the file ends: what was found so far must end with it
            n = _is_record(stream.data, at, references)
            if n is None:
                good = -1
                break
            good, at = good + 1, at + n
            if at > len(stream.data) and not stream.need(at - stream.at):
                good = -1
                break
        if good >= chain or (good > 0 and at == len(stream.data)):
            return True
        stream.at += 1
        stream.trim()
    return False


def _decoded(data: bytearray, at: int, references: list[tuple[str, int]], file: str, wanted: frozenset) -> dict:
    size, ref, pos, n_name, mapq, _, n_cigar, flag, n_bases, mate, mate_pos, tlen = _RECORD.unpack_from(data, at)
    name = at + 36
    out = {"file": file, "flag": flag, "mapq": mapq, "tlen": tlen, "pos": pos + 1, "mate_pos": mate_pos + 1, "chrom": references[ref][0] if ref >= 0 else "*", "mate_chrom": references[mate][0] if mate >= 0 else "*"}
    if "read" in wanted:
        out["read"] = data[name : name + n_name - 1].decode()
    operations = name + n_name
    if wanted & {"cigar", "bases"}:
        codes = struct.unpack_from(f"<{n_cigar}I", data, operations)
        out["cigar"] = "".join(f"{c >> 4}{_OPERATIONS[c & 15]}" for c in codes) or "*"
        out["bases"] = sum(c >> 4 for c in codes if _OPERATIONS[c & 15] in _ON_REFERENCE)
    sequence = operations + 4 * n_cigar
    if "sequence" in wanted:
        packed = data[sequence : sequence + (n_bases + 1) // 2]
        out["sequence"] = "".join(_BASES[b >> 4] + _BASES[b & 15] for b in packed)[:n_bases] or "*"
    if "quality" in wanted:
        qualities = data[sequence + (n_bases + 1) // 2 :][:n_bases]
        out["quality"] = sum(q for q in qualities if 15 <= q < 255)
    return out


class BamReader(DataSourceReader):
    def __init__(self, paths: list[str], columns: list[str], split: int, schema):
        self.paths, self.columns, self.split, self.arrow = paths, columns, split, schema

    def partitions(self) -> list[Range]:
        out = []
        for path in self.paths:
            system, inner = _open(path)
            size = system.get_file_info(inner).size
            out += [Range(path, at, min(at + self.split, size)) for at in range(0, size, self.split)]
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        blocks, wanted = _Blocks(part.path), frozenset(self.columns)
        kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
        schema = pa.schema([(c, kinds[COLUMNS[c]]) for c in self.columns])
        try:
            stream = _Stream(blocks, 0)
            references = _references(stream)
            if part.start:
                begin = blocks.first(part.start)
                if begin is None or begin >= part.end:
                    return
                stream = _Stream(blocks, begin)
                if not _settle(stream, references, part.end):
                    return
            rows: list[dict] = []
            while stream.need(4) and stream.block() < part.end:
                n = struct.unpack_from("<i", stream.data, stream.at)[0] + 4
                if n < 36 or not stream.need(n):
                    raise ValueError(f"{part.path}: a record is cut off")
                rows.append(_decoded(stream.data, stream.at, references, part.path, wanted))
                stream.at += n
                stream.trim()
                if len(rows) >= 5000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
        finally:
            blocks.close()


class BamSource(DataSource):
    """Options: ``path`` (a BAM file, or several with commas between them), ``columns`` (only these are decoded), ``split`` (bytes of a task's range)."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def _columns(self) -> list[str]:
        columns = [c.strip() for c in self.options.get("columns", ",".join(COLUMNS)).split(",")]
        unknown = [c for c in columns if c not in COLUMNS]
        if unknown:
            raise ValueError(f"no such columns: {', '.join(unknown)}")
        return columns

    def schema(self) -> str:
        return ", ".join(f"{c} {COLUMNS[c]}" for c in self._columns())

    def reader(self, schema) -> BamReader:
        return BamReader(self.options["path"].split(","), self._columns(), int(self.options.get("split", 32 << 20)), schema)


def bam_records(spark: SparkSession, paths: list[str], columns: tuple[str, ...] = tuple(COLUMNS), split: int = 32 << 20) -> DataFrame:
    """Records of BAM files, as raw columns."""
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("columns", ",".join(columns)).option("split", split).option("path", ",".join(paths)).load()


def bam_alignments(spark: SparkSession, paths: list[str], split: int = 32 << 20) -> DataFrame:
    """The columns that ``readers.alignments`` gives for SAM text; the library is the file's name."""
    x = bam_records(spark, paths, ("file", "read", "flag", "chrom", "pos", "mapq", "cigar", "tlen", "bases"), split)
    rows = x.select(F.regexp_extract("file", r"([^/]+?)(?:\.bam)?$", 1).alias("library"), "read", "flag", "chrom", "pos", "mapq", "cigar", "tlen", "bases")
    return rows.withColumn("end", F.col("pos") - 1 + F.col("bases")).withColumn("strand", F.when(F.col("flag").bitwiseAND(16) == 16, "-").otherwise("+"))
