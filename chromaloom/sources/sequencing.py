"""FASTQ and BAM files as data sources that split: a task reads a range of bytes and finds its first record itself.

A record belongs to the range that holds its first byte (of its compressed block, for BAM). Compressed FASTQ
can't be split: a task streams a whole file.
"""

from __future__ import annotations

import gzip
import io
import json
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, and records of an Arrow batch.
SPLIT, BATCH = 64 << 20, 8192


def _filesystem(uri: str):
    from pyarrow import fs

    if uri.startswith("file:/"):
        uri = uri[5:].replace("//", "", 1) if uri.startswith("file://") else uri[5:]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _files(uris: Sequence[str]) -> list[tuple[str, str, int]]:
    """(uri as given, path, size) of files, and of all files in folders that aren't hidden."""
    from pyarrow.fs import FileSelector, FileType

    out = []
    for uri in uris:
        fs, path = _filesystem(uri)
        info = fs.get_file_info(path)
        if info.type == FileType.NotFound:
            raise FileNotFoundError(uri)
        found = [info] if info.type == FileType.File else [x for x in fs.get_file_info(FileSelector(path, recursive=True)) if x.type == FileType.File]
        out += [(uri, x.path, x.size) for x in sorted(found, key=lambda x: x.path) if not x.base_name.startswith((".", "_")) and x.size]
    return out


@dataclass
class Range(InputPartition):
    uri: str
    path: str
    start: int
    stop: int


class _Source(DataSource):
    def _options(self) -> tuple[list[str], int]:
        paths = json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]
        return paths, int(self.options.get("split", SPLIT))


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], split: int) -> None:
        self.paths, self.split = paths, split

    def splits(self, path: str) -> bool:
        return True

    def partitions(self) -> list[Range]:
        out = []
        for uri, path, size in _files(self.paths):
            step = self.split if self.splits(path) else size
            out += [Range(uri, path, start, min(start + step, size)) for start in range(0, size, step)]
        return out


def _open(r: Range) -> io.BufferedReader:
    return io.BufferedReader(_filesystem(r.uri)[0].open_input_file(r.path), 1 << 20)


class FastqSource(_Source):
    """name, sequence, quality, file. Names end at the first blank, and before /1 or /2."""

    SCHEMA = "name string, sequence string, quality string, file string"

    @classmethod
    def name(cls) -> str:
        return "chromaloom_fastq"

    def schema(self) -> str:
        return self.SCHEMA

    def reader(self, schema) -> FastqReader:
        return FastqReader(*self._options())


def read_name(header: bytes) -> str:
    name = header[1:].split(None, 1)[0] if header[1:].strip() else b""
    return (name[:-2] if name.endswith((b"/1", b"/2")) else name).decode("utf-8", "replace")


class FastqReader(_Reader):
    def splits(self, path: str) -> bool:
        return not path.endswith(".gz")

    def _records(self, r: Range) -> Iterator[tuple[bytes, bytes, bytes]]:
        with _open(r) as raw:
            file = raw if self.splits(r.path) else gzip.GzipFile(fileobj=raw)
            at, stop = r.start, r.stop if self.splits(r.path) else None
            ahead: list[bytes] = []
            if at:  # to the first line that begins in this range, then to the first header among it and the next
                raw.seek(at - 1)
                at += len(raw.readline()) - 1
                ahead = [raw.readline() for _ in range(7)]
                skip = next((k for k in range(5) if ahead[k][:1] == b"@" and ahead[k + 2][:1] == b"+"), None)
                if skip is None:  # no record begins here
                    return
                at, ahead = at + sum(map(len, ahead[:skip])), ahead[skip:]
            while stop is None or at < stop:
                lines = [ahead.pop(0) if ahead else file.readline() for _ in range(4)]
                if not lines[0].strip():
                    if not lines[0] or not any(x.strip() for x in lines):
                        return
                    at += len(lines[0])  # a blank line between records
                    ahead = lines[1:] + ahead
                    continue
                at += sum(map(len, lines))
                if lines[0][:1] != b"@" or lines[2][:1] != b"+":
                    raise ValueError(f"{r.path}: a record doesn't begin with @ or its third line with +")
                yield lines[0], lines[1].strip(), lines[3].rstrip(b"\r\n")

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, str, str, str]] = []
        base = partition.path.rsplit("/", 1)[-1]
        for header, sequence, quality in self._records(partition):
            held.append((read_name(header), sequence.decode("ascii", "replace"), quality.decode("latin-1"), base))
            if len(held) == BATCH:
                yield _batch(held, ("name", "sequence", "quality", "file"))
                held = []
        if held:
            yield _batch(held, ("name", "sequence", "quality", "file"))


def _batch(rows: list[tuple], names: Sequence[str], kinds: Sequence[pa.DataType] | None = None) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds or [pa.string()] * len(columns))], names=list(names))


class BamSource(_Source):
    """slice_name, flag, rname, pos (from 1), cigar, file of every alignment, unmapped ones too."""

    SCHEMA = "slice_name string, flag int, rname string, pos long, cigar string, file string"

    @classmethod
    def name(cls) -> str:
        return "chromaloom_bam"

    def schema(self) -> str:
        return self.SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(*self._options())


#: refID, pos, length of the name, mapq, bin, cigar steps, flag, length of the sequence, next refID, next pos, template.
_FIXED = struct.Struct("<iiBBHHHiiii")
_CIGAR = "MIDNSHP=X"


def block_size(head: bytes) -> int:
    """Size of the compressed block that begins with these bytes; 0 if none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return 0
    extra, at = struct.unpack_from("<H", head, 10)[0], 12
    while at + 4 <= min(12 + extra, len(head)):
        if head[at : at + 2] == b"BC" and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + struct.unpack_from("<H", head, at + 2)[0]
    return 0


class _Blocks:
    """The uncompressed bytes of compressed blocks one after another, and where each block lies."""

    def __init__(self, file: io.BufferedReader, start: int) -> None:
        self.file, self.next = file, start
        self.data, self.marks = bytearray(), []  # marks: (place in data, place in the file)

    def more(self) -> bool:
        self.file.seek(self.next)
        head = self.file.read(18)
        if not head:
            return False
        size = block_size(head)
        if not size:
            raise ValueError("not a compressed block")
        block = head + self.file.read(size - 18)
        begin = 12 + struct.unpack_from("<H", block, 10)[0]
        self.marks.append((len(self.data), self.next))
        self.data += zlib.decompress(block[begin:-8], wbits=-15)
        self.next += size
        return True

    def need(self, n: int) -> bool:
        while len(self.data) < n:
            if not self.more():
                return False
        return True

    def block_of(self, at: int) -> int:
        """Where in the file the block of a byte begins."""
        return max((m for m in self.marks if m[0] <= at), key=lambda m: m[0])[1]

    def forget(self, at: int) -> None:
        """What is before a byte isn't needed any more."""
        keep = max((i for i, m in enumerate(self.marks) if m[0] <= at), default=0)
        del self.data[:at]
        self.marks = [(max(0, p - at), f) for p, f in self.marks[keep:]]


def _first_block(file: io.BufferedReader, start: int) -> int | None:
    """The first block that begins at ``start`` or later: one that is followed by another, or by the end."""
    file.seek(start)
    window = file.read(3 << 16)
    at = window.find(b"\x1f\x8b\x08\x04")
    while at >= 0:
        size = block_size(window[at : at + 64])
        if size:
            file.seek(start + at + size)
            after = file.read(64)
            if not after or block_size(after):
                return start + at
        at = window.find(b"\x1f\x8b\x08\x04", at + 1)
    return None


def _plausible(data: bytes | bytearray, at: int, n_refs: int) -> int | None:
    """The size of a record at a place, if one may be there."""
    if at + 36 > len(data):
        return None
    size = struct.unpack_from("<i", data, at)[0]
    ref, pos, l_name, _, _, n_cigar, _, l_seq, next_ref, next_pos, _ = _FIXED.unpack_from(data, at + 4)
    if not (32 <= size < 1 << 26 and -1 <= ref < n_refs and -1 <= next_ref < n_refs and pos >= -1 and next_pos >= -1 and l_name and l_seq >= 0):
        return None
    if 32 + l_name + 4 * n_cigar + (l_seq + 1) // 2 + l_seq > size:
        return None
    end = at + 36 + l_name - 1
    if end >= len(data) or data[end] or any(c < 33 or c > 126 for c in data[at + 36 : end]):
        return None
    return size


class BamReader(_Reader):
    def _header(self, file: io.BufferedReader) -> tuple[list[str], _Blocks, int]:
        """Reference names, the blocks read so far, and where records begin in them."""
        b = _Blocks(file, 0)
        if not b.need(8) or b.data[:4] != b"BAM\x01":
            raise ValueError("not a BAM file")
        at = 8 + struct.unpack_from("<i", b.data, 4)[0]
        b.need(at + 4)
        n = struct.unpack_from("<i", b.data, at)[0]
        at, names = at + 4, []
        for _ in range(n):
            b.need(at + 4)
            size = struct.unpack_from("<i", b.data, at)[0]
            b.need(at + 8 + size)
            names.append(bytes(b.data[at + 4 : at + 3 + size]).decode())
            at += 8 + size
        return names, b, at

    def _begin(self, file: io.BufferedReader, r: Range, n_refs: int) -> tuple[_Blocks, int] | None:
        start = _first_block(file, r.start)
        if start is None or start >= r.stop:
            return None
        b, loaded = _Blocks(file, start), 1 << 18
        while True:
            whole = not b.need(loaded)
            for at in range(len(b.data)):
                place, seen = at, 0
                while seen < 16 and (size := _plausible(b.data, place, n_refs)) is not None:
                    place, seen = place + 4 + size, seen + 1
                if seen == 16 or seen and (place + (1 << 9) > len(b.data) if not whole else place == len(b.data)):
                    return b, at
            if whole or b.next > r.stop + (1 << 26):
                return None
            loaded *= 8


    def _records(self, r: Range) -> Iterator[tuple]:
        base = r.path.rsplit("/", 1)[-1]
        with _open(r) as file:
            names, b, at = self._header(file)
            if r.start:
                found = self._begin(file, r, len(names))
                if found is None:
                    return
                b, at = found
            while b.need(at + 4):
                if b.block_of(at) >= r.stop:
                    return
                size = struct.unpack_from("<i", b.data, at)[0]
                if not b.need(at + 4 + size):
                    raise ValueError(f"{r.path} ends within a record")
                ref, pos, l_name, _, _, n_cigar, flag, *_ = _FIXED.unpack_from(b.data, at + 4)
                name = bytes(b.data[at + 36 : at + 35 + l_name]).decode("ascii", "replace")
                steps = struct.unpack_from(f"<{n_cigar}I", b.data, at + 36 + l_name)
                cigar = "".join(f"{s >> 4}{_CIGAR[s & 15]}" for s in steps) or "*"
                yield name, flag, names[ref] if ref >= 0 else "*", pos + 1, cigar, base
                at += 4 + size
                if at > 1 << 20:
                    b.forget(at)
                    at = 0

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        names = ("slice_name", "flag", "rname", "pos", "cigar", "file")
        kinds = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string())
        held = []
        for record in self._records(partition):
            held.append(record)
            if len(held) == BATCH:
                yield _batch(held, names, kinds)
                held = []
        if held:
            yield _batch(held, names, kinds)
