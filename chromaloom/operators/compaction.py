"""Many tiny files into few well-sized ones, each record exactly once.

1. Bodies are parsed and repeated records dropped: the record of the smallest (file, line) stays.
2. The files' remaining bytes are the jobs of a longest-first schedule: in order of falling size
   each goes to the least loaded of a fixed number of output groups, kept in a heap. Files above
   the piece size are cut, so that one giant file can't outgrow its group. Scheduling runs in
   shards of a bounded number of groups, so no task sees all files.
3. Each group is streamed through pyarrow into one Parquet file, which is read back and verified
   before an atomic rename gives it its name in a folder that no reader knows. A repeated or
   speculative attempt writes the same records under the same name.
4. The manifest's number and digest of records are compared with those of the records that had to
   be written, and its files with the folder's. Only then two renames publish folder and manifest.
"""

from __future__ import annotations

import heapq
import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import trimmed
from ..session import scratch_path, settled

FIELDS = ("parent_id", "slice", "chrom", "start_pos", "end_pos")
#: Bytes that a record takes besides its chrom: four numbers.
RECORD_BYTES = 28


def signed64(c):
    """A decimal number, signed or unsigned, as the signed 64-bit number of the same bits; else NULL."""
    wide = F.when(c.rlike(r"^[+-]?[0-9]{1,20}$"), c).try_cast("decimal(20,0)")
    two63, two64 = F.expr("9223372036854775808BD"), F.expr("18446744073709551616BD")
    signed = F.when(wide >= two63, wide - two64).otherwise(wide)
    return F.when(wide < two64, signed).try_cast("bigint")


def parse_bodies(files: DataFrame) -> DataFrame:
    """A row for each record: file_id, line_no and the five fields.

    A record is a line with all five fields that isn't a header: ``parent_id`` and ``slice`` are
    numbers. Header, blank and incomplete lines, and NULL or empty bodies, give nothing. Both
    kinds of line ends are read, and a last line without one.
    """
    lines = files.select("file_id", F.posexplode(F.split("body", r"\r\n|\n|\r")).alias("line_no", "line"))
    fields = lines.withColumn("f", F.split("line", "\t")).where(F.size("f") == 5)
    at = [trimmed(F.get("f", F.lit(i))) for i in range(5)]
    return fields.select(
        "file_id", "line_no", signed64(at[0]).alias("parent_id"), at[1].try_cast("int").alias("slice"),
        at[2].alias("chrom"), at[3].try_cast("bigint").alias("start_pos"), at[4].try_cast("bigint").alias("end_pos"),
    ).where("parent_id IS NOT NULL AND slice IS NOT NULL AND chrom <> '' AND start_pos IS NOT NULL AND end_pos IS NOT NULL")


def first_records(records: DataFrame) -> DataFrame:
    """One record for each (parent_id, slice): that of the smallest file_id, then line_no."""
    kept = records.groupBy("parent_id", "slice").agg(
        F.min(F.struct("file_id", "line_no", "chrom", "start_pos", "end_pos")).alias("r")
    )
    return kept.select("parent_id", "slice", "r.chrom", "r.start_pos", "r.end_pos", "r.file_id", "r.line_no")


def _schedule(groups_per_shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            out = []
            for shard, size in zip(batch["shard"].to_pylist(), batch["bytes"].to_pylist()):
                if shard not in heaps:  # the rows of a shard follow one another
                    heaps = {shard: [(0, shard * groups_per_shard + g) for g in range(groups_per_shard)]}
                load, group = heaps[shard][0]
                heapq.heapreplace(heaps[shard], (load + size, group))
                out.append(group)
            yield pa.RecordBatch.from_arrays(
                [batch["file_id"], batch["piece"], batch["bytes"], pa.array(out, pa.int64())],
                names=["file_id", "piece", "bytes", "group_id"],
            )

    return run


def schedule_longest_first(units: DataFrame, groups: int, groups_per_shard: int = 64) -> DataFrame:
    """file_id, piece, bytes -> with group_id, by longest-first onto the least loaded group.

    ``groups`` output groups in all. Ties go by file_id, then piece, and to the smallest group id.
    With several shards, each is its own schedule over a hashed share of the units.
    """
    shards = max(1, math.ceil(groups / groups_per_shard))
    per = math.ceil(groups / shards)
    placed = (
        units.select("file_id", "piece", "bytes")
        .withColumn("shard", F.pmod(F.xxhash64("file_id", "piece"), F.lit(shards)).cast("int"))
        .repartition(shards, "shard")
        .sortWithinPartitions("shard", F.desc("bytes"), "file_id", "piece")
    )
    return placed.mapInArrow(_schedule(per), "file_id long, piece long, bytes long, group_id long")


def _filesystem(uri: str):
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if not uri.startswith("file:/") or uri.startswith("file://") else "file://" + uri[5:])
    return fs.LocalFileSystem(), uri


def _mixed(h: np.ndarray, value: np.ndarray) -> np.ndarray:
    h = (h ^ value) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _digest(batch: pa.RecordBatch | pa.Table) -> int:
    """Order-free, over all fields: the sum of the records' hashes modulo 2**63."""
    h = _mixed(np.full(batch.num_rows, 0x9E3779B97F4A7C15, np.uint64), batch["parent_id"].to_numpy().view(np.uint64))
    for c in ("slice", "start_pos", "end_pos"):
        h = _mixed(h, batch[c].to_numpy().astype(np.int64).view(np.uint64))
    chrom = batch["chrom"]
    names = (chrom.combine_chunks() if isinstance(chrom, pa.ChunkedArray) else chrom).dictionary_encode()
    if batch.num_rows:
        h = _mixed(h, np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in names.dictionary.to_pylist()], np.uint64)[names.indices.to_numpy()])
    return int(h.sum(dtype=np.uint64)) % (1 << 63)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = sum(_digest(b) for b in batches) % (1 << 63)
    yield pa.RecordBatch.from_pydict({"digest": pa.array([digest], pa.int64())})


def _total(digests: DataFrame) -> int:
    return int(digests.agg(F.coalesce(F.sum(F.col("digest").cast("decimal(38,0)")), F.lit(0))).first()[0]) % (1 << 63)


def _write_groups(target: str):
    schema = pa.schema([("parent_id", pa.int64()), ("slice", pa.int32()), ("chrom", pa.string()), ("start_pos", pa.int64()), ("end_pos", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        fs, root = _filesystem(target)
        fs.create_dir(root, recursive=True)
        group = writer = None
        rows = digest = 0
        attempt = ""

        def close() -> pa.RecordBatch:
            writer.close()
            with pq.ParquetFile(attempt, filesystem=fs) as back:
                seen = sum(x.num_rows for x in back.iter_batches(columns=["parent_id"]))
                again = sum(_digest(x) for x in back.iter_batches()) % (1 << 63)
            if (seen, again) != (rows, digest):
                fs.delete_file(attempt)
                raise OSError(f"group {group}: {seen} of {rows} records could be read back, or other ones")
            final = f"{root}/group-{group:09d}.parquet"
            fs.move(attempt, final)
            size = fs.get_file_info(final).size
            return pa.RecordBatch.from_pydict({"group_id": [group], "file": [f"group-{group:09d}.parquet"], "n_records": [rows], "n_bytes": [size], "digest": [digest]})

        for batch in batches:
            ids, start = batch["group_id"].to_numpy(), 0
            while start < len(ids):
                stop = start + int((ids[start:] != ids[start]).argmax() or len(ids) - start)
                if ids[start] != group:
                    if writer:
                        yield close()
                    group, rows, digest = int(ids[start]), 0, 0
                    attempt = f"{root}/_attempt-{group:09d}-{uuid.uuid4().hex}"
                    writer = pq.ParquetWriter(attempt, schema, filesystem=fs)
                part = batch.slice(start, stop - start).select(schema.names)
                writer.write_batch(part.cast(schema))
                rows, digest = rows + part.num_rows, (digest + _digest(part)) % (1 << 63)
                start = stop
        if writer:
            yield close()

    return run


@dataclass(frozen=True)
class Compacted:
    data: str
    manifest: str
    n_records: int
    n_groups: int


def compact(
    files: DataFrame, target_bytes: int = 128 << 20, piece_rows: int = 1 << 16, groups_per_shard: int = 64, where: str | None = None,
    least_bytes: int = 1 << 20,
) -> Compacted:
    """Regroups the records of ``files`` (file_id, body) into Parquet files of about ``target_bytes``.

    Where that gives fewer files than there are cores, there are as many as cores, if they hold
    ``least_bytes`` each. Returns the published paths: ``data`` with the files, ``manifest`` with one
    row for each. Repeated rows of a file, NULL and empty bodies and other columns make no
    difference; without any record, one empty file is published.
    """
    spark = files.sparkSession
    where = where or scratch_path(spark, "compacted")
    kept = first_records(parse_bodies(files.select(F.col("file_id").cast("long"), "body")))
    kept = settled(kept.withColumn("piece", F.floor(F.col("line_no") / piece_rows)), "records")
    units = kept.groupBy("file_id", "piece").agg(F.sum(F.length("chrom") + RECORD_BYTES).alias("bytes"), F.count(F.lit(1)).alias("n"))
    size, n_records = units.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    groups = max(1, math.ceil(size / target_bytes), min(spark.sparkContext.defaultParallelism, size // least_bytes))
    placed = schedule_longest_first(units, groups, groups_per_shard)
    data, manifest, staged = f"{where}/data", f"{where}/manifest", f"{where}/_staged-{uuid.uuid4().hex}"
    if n_records == 0:
        kept.select(*FIELDS).write.parquet(staged)
    # a group's number is its partition, so that the schedule's balance is that of the tasks
    streams = (
        kept.join(placed.select("file_id", "piece", "group_id"), ["file_id", "piece"])
        .select(F.col("group_id").cast("int").alias("group_id"), *FIELDS)
        .repartitionById(groups, "group_id")
        .sortWithinPartitions("group_id", "parent_id", "slice")
    )
    attempt = f"{where}/_manifest-{uuid.uuid4().hex}"
    streams.mapInArrow(_write_groups(staged), "group_id long, file string, n_records long, n_bytes long, digest long").write.parquet(attempt)
    told = spark.read.parquet(attempt)
    written, n_files = told.agg(F.coalesce(F.sum("n_records"), F.lit(0)), F.count(F.lit(1))).first()
    wanted = _total(kept.select(*FIELDS).mapInArrow(_digests, "digest long"))
    fs, path = _filesystem(staged)
    there = _group_files(fs, path) if n_records else 0
    if (written, _total(told), there) != (n_records, wanted, n_files):
        fs.delete_dir(path)
        raise OSError(f"{written} of {n_records} records are in {there} regrouped files, or other ones; nothing is published")
    fs.move(path, _filesystem(data)[1])
    fs.move(_filesystem(attempt)[1], _filesystem(manifest)[1])
    return Compacted(data, manifest, n_records, groups)


def _group_files(fs, path: str) -> int:
    from pyarrow.fs import FileSelector

    return sum(x.base_name.startswith("group-") for x in fs.get_file_info(FileSelector(path)))
