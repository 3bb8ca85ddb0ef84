"""BAM files written here, read back equal to SAM text however they are cut."""

import random
import struct
import zlib

import pytest

from genoframe.sources.bam import BamSource, bam_alignments, bam_records
from genoframe.sources.readers import alignments

REFERENCES = [("chr1", 100_000), ("chr2", 50_000)]
OPERATIONS, BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"


def block(data):
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def record(r):
    read, flag, chrom, pos, mapq, cigar, tlen, sequence, qualities = r
    ref = next((i for i, x in enumerate(REFERENCES) if x[0] == chrom), -1)
    codes = [n << 4 | OPERATIONS.index(o) for n, o in cigar]
    padded = sequence + "=" * (len(sequence) % 2)
    packed = bytes(BASES.index(a) << 4 | BASES.index(b) for a, b in zip(padded[::2], padded[1::2]))
    body = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(read) + 1, mapq, 4680, len(codes), flag, len(sequence), ref, pos - 1, tlen)
    body += read.encode() + b"\0" + struct.pack(f"<{len(codes)}I", *codes) + packed + bytes(qualities) + b"NMi" + struct.pack("<i", 3) + b"XZZ" + b"\x1f\x8b\x08\x04some text\0"
    return struct.pack("<i", len(body)) + body


def write(path, rows, size, level_header=b"@HD\tVN:1.6\n"):
    data = b"BAM\1" + struct.pack("<i", len(level_header)) + level_header + struct.pack("<i", len(REFERENCES))
    for name, length in REFERENCES:
        data += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", length)
    data += b"".join(record(r) for r in rows)
    path.write_bytes(b"".join(block(data[i : i + size]) for i in range(0, len(data), size)) + block(b""))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = []
    for i in range(700):
        n = rng.choice([0, 1, 36, 75, 76, 3000 if i % 100 == 0 else 50])
        cigar = [] if not n else [(n, "M")] if n < 36 else [(3, "S"), (n - 13, "M"), (2, "D"), (10, "M")]
        mapped = bool(n) and rng.random() < 0.9
        out.append((f"read:{i // 2}", rng.choice([0, 16, 99, 147, 1024]) if mapped else 4, rng.choice(["chr1", "chr2"]) if mapped else "*", rng.randint(1, 49_000) if mapped else 0, rng.randint(0, 60), cigar if mapped else [], rng.randint(-300, 300), "".join(rng.choice("ACGTN") for _ in range(n)), [rng.randint(0, 41) for _ in range(n)]))
    return out


@pytest.mark.parametrize(("size", "split"), [(65_000, 1 << 25), (700, 1000), (97, 333), (4096, 5000)])
def test_bam_equals_sam(spark, rows, tmp_path, size, split):
    write(tmp_path / "one.bam", rows, size)
    text = [f"{r[0]}\t{r[1]}\t{r[2]}\t{r[3]}\t{r[4]}\t{''.join(f'{n}{o}' for n, o in r[5]) or '*'}\t=\t{r[3]}\t{r[6]}\t{r[7] or '*'}\t*" for r in rows]
    (tmp_path / "one.sam").write_text("@HD\tVN:1.6\n" + "\n".join(text) + "\n")
    got = bam_alignments(spark, [str(tmp_path / "one.bam")], split)
    want = alignments(spark, str(tmp_path / "one.sam"))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    if split < 1 << 20:
        assert got.rdd.getNumPartitions() > 5


def test_columns_and_files(spark, rows, tmp_path):
    for name in ("a", "b"):
        write(tmp_path / f"{name}.bam", rows, 2000)
    paths = [f"file://{tmp_path}/a.bam", str(tmp_path / "b.bam")]
    got = bam_records(spark, paths, ("quality", "sequence", "mate_pos"), split=3000)
    assert got.columns == ["quality", "sequence", "mate_pos"]
    assert sorted(map(tuple, got.collect())) == sorted([(sum(q for q in r[8] if q >= 15), r[7] or "*", r[3]) for r in rows] * 2)
    with pytest.raises(Exception, match="no such columns"):
        BamSource({"columns": "nothing", "path": paths[0]}).schema()


def test_empty_and_broken_files(spark, rows, tmp_path):
    write(tmp_path / "none.bam", [], 100)
    assert bam_records(spark, [str(tmp_path / "none.bam")]).count() == 0
    write(tmp_path / "cut.bam", rows[:50], 500)
    data = (tmp_path / "cut.bam").read_bytes()
    (tmp_path / "cut.bam").write_bytes(data[: len(data) // 2])
    with pytest.raises(Exception, match="cut off|block|header"):
        bam_records(spark, [str(tmp_path / "cut.bam")]).count()
