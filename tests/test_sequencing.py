import gzip
import random
import struct
import zlib

import pytest

from chromaloom.sources import readers, sequencing


def fastq(n, seed=1):
    r = random.Random(seed)
    out = []
    for k in range(n):
        size = r.randint(0, 60)
        quality = "".join(r.choices("@+IJ#", k=size))  # looks like headers and separators
        out.append((f"r{k}", "".join(r.choices("ACGTN", k=size)), quality))
    return out


def text(records, end="\n"):
    return "".join(f"@{n}/1 lane{end}{s}{end}+{end}{q}{end}" for n, s, q in records).encode()


@pytest.mark.parametrize("split", [1, 7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_read_once_at_any_split(tmp_path, split, end):
    records = fastq(120)
    path = tmp_path / "a.fastq"
    path.write_bytes(text(records, end)[: -len(end)])  # a last line without an end
    reader = sequencing.FastqReader([str(path)], split)
    got = [row for p in reader.partitions() for b in reader.read(p) for row in zip(*[b[c].to_pylist() for c in ("name", "sequence", "quality")])]
    assert got == records


def test_folders_and_compressed_files(spark, tmp_path):
    records = fastq(300)
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.fastq.gz").write_bytes(gzip.compress(text(records[:100])) + gzip.compress(text(records[100:200])))
    (tmp_path / "x" / "b.fastq").write_bytes(text(records[200:]))
    (tmp_path / "x" / "_SUCCESS").write_bytes(b"")
    got = readers.read_fastq(spark, str(tmp_path / "x"), 2, split=500)
    assert sorted((r.name, r.sequence, r.quality) for r in got.collect()) == sorted(records) and {r.read for r in got.collect()} == {2}


def record(name, flag, ref, pos, cigar):
    steps = b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(c)) for n, c in cigar)
    size = sum(n for n, c in cigar if c in "MIS=X")
    body = sequencing._FIXED.pack(ref, pos, len(name) + 1, 40, 0, len(cigar), flag, size, -1, -1, 0) + name.encode() + b"\0" + steps + b"\x11" * ((size + 1) // 2) + b"\x1e" * size
    return struct.pack("<i", len(body)) + body


def blocks(data, sizes):
    out, at = b"", 0
    while at < len(data):
        n = next(sizes)
        part = data[at : at + n]
        c = zlib.compressobj(wbits=-15)
        z = c.compress(part) + c.flush()
        out += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(z) + 25) + z + struct.pack("<II", zlib.crc32(part), len(part))
        at += n
    return out + bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def bam(n, block):
    r = random.Random(4)
    rows = []
    for k in range(n):
        mapped = r.random() < 0.8
        cigar = [(r.randint(1, 30), "S"), (r.randint(1, 90), "M"), (r.randint(1, 9), "D"), (r.randint(1, 90), "M")] if mapped else []
        rows.append((f"read{k}|pe|{k % 3}|{k % 5}", 0 if mapped else 4, r.randrange(2) if mapped else -1, r.randrange(10**6) if mapped else -1, cigar))
    refs = b"".join(struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", 10**7) for c in ("chr1", "chr22"))
    head = b"@HD\tVN:1.6\n"
    data = b"BAM\x01" + struct.pack("<i", len(head)) + head + struct.pack("<i", 2) + refs + b"".join(record(*x) for x in rows)
    sizes = (r.randint(block // 2, block) for _ in iter(int, 1))
    return rows, blocks(data, sizes)


@pytest.mark.parametrize("block", [90, 4000, 60000])
@pytest.mark.parametrize("split", [1000, 20000, 1 << 22])
def test_every_alignment_once_at_any_split(tmp_path, block, split):
    rows, data = bam(900, block)
    path = tmp_path / "a.bam"
    path.write_bytes(data)
    reader = sequencing.BamReader([str(path)], split)
    got = [row for p in reader.partitions() for b in reader.read(p) for row in zip(*[b[c].to_pylist() for c in ("slice_name", "flag", "rname", "pos", "cigar")])]
    assert got == [(n, f, "*" if ref < 0 else ("chr1", "chr22")[ref], pos + 1, "".join(f"{k}{c}" for k, c in cigar) or "*") for n, f, ref, pos, cigar in rows]


def test_alignments_as_slices(spark, tmp_path):
    rows, data = bam(300, 4000)
    (tmp_path / "a.bam").write_bytes(data)
    got = {r.slice_name: r for r in readers.read_bam(spark, str(tmp_path / "a.bam"), split=3000).collect()}
    assert len(got) == 300
    for name, flag, ref, pos, cigar in rows:
        length = sum(n for n, c in cigar if c in "MD")
        one = got[name]
        assert (one.mapped, one.chrom, one.start_pos, one.end_pos) == ((1, ("chr1", "chr22")[ref], pos, pos + length) if ref >= 0 else (0, None, None, None))
        assert one.bam == "a.bam" and one.parent_read == name.split("|")[0]


def test_not_a_bam_file(tmp_path):
    (tmp_path / "a.bam").write_bytes(b"nothing of the kind")
    with pytest.raises(ValueError):
        list(sequencing.BamReader([str(tmp_path / "a.bam")], 1000).read(sequencing.Range(str(tmp_path / "a.bam"), str(tmp_path / "a.bam"), 0, 19)))
