import os

import pytest
from pyspark.sql import functions as F

from chromaloom.operators import compaction as c

HEAD = "parent_id\tslice\tchrom\tstart\tend"
FILES = [
    (1, f"{HEAD}\n5\t0\tchr1\t1\t2\n18446744073709551615\t1\tchr2\t3\t4\n"),
    (2, "-1\t1\tchr9\t30\t40\r\n\r\n7\t2\t.\t0\t0"),  # -1 is the unsigned number of file 1
    (3, "7\n7\t3\n7\t3\tchr1\nx\t3\tchr1\t1\t2\n7\t\tchr1\t1\t2\n8\t1\tchr1\t1\t2\textra\n"),
    (4, None),
    (5, ""),
    (6, HEAD),
    (7, "5\t0\tchr1\t1\t2\n5\t0\tchr1\t1\t2\n18446744073709551616\t0\tchr1\t1\t2\n9223372036854775808\t0\tchr1\t1\t2\n"),
]
KEYS = {(5, 0), (-1, 1), (7, 2), (-(2**63), 0)}


def files(spark, rows=FILES):
    return spark.createDataFrame(rows, "file_id long, body string")


def test_records_once(spark):
    done = c.compact(files(spark))
    got = spark.read.parquet(done.data)
    assert sorted((r.parent_id, r.slice) for r in got.collect()) == sorted(KEYS)
    assert got.where("parent_id = -1").first().chrom == "chr2"  # of the smallest file
    manifest = spark.read.parquet(done.manifest)
    assert manifest.agg(F.sum("n_records")).first()[0] == len(KEYS) == done.n_records


def test_repeated_files_and_other_columns(spark):
    twice = files(spark, FILES + FILES).withColumn("line", F.lit("x")).withColumn("bytes", F.lit(1))
    assert c.compact(twice).n_records == len(KEYS)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "")], [(1, HEAD)]])
def test_nothing_to_regroup(spark, rows):
    done = c.compact(files(spark, rows))
    assert done.n_records == 0 and spark.read.parquet(done.data).count() == 0 and spark.read.parquet(done.manifest).count() == 0


def test_groups_are_balanced_and_a_giant_file_is_cut(spark):
    giant = [(0, "".join(f"{i}\t0\tchr1\t1\t2\n" for i in range(3000)))]
    small = [(f, "".join(f"{f * 100_000 + i}\t1\tchr1\t1\t2\n" for i in range(1 + f % 9))) for f in range(1, 700)]
    done = c.compact(files(spark, giant + small), target_bytes=8_000, piece_rows=100, groups_per_shard=64)
    sizes = [r.n_records for r in spark.read.parquet(done.manifest).collect()]
    assert done.n_groups > 10 and sum(sizes) == done.n_records == 3000 + sum(1 + f % 9 for f in range(1, 700))
    assert max(sizes) <= 1.35 * min(sizes)


def test_schedule_is_longest_first(spark):
    units = spark.createDataFrame([(i, 0, b) for i, b in enumerate([7, 6, 5, 4, 3, 2, 2])], "file_id long, piece long, bytes long")
    placed = c.schedule_longest_first(units, 3).groupBy("group_id").agg(F.sum("bytes").alias("b"))
    assert sorted(r.b for r in placed.collect()) == [9, 9, 11]


def test_a_file_that_cannot_be_read_back_is_not_published(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    batch = pa.RecordBatch.from_pydict({"group_id": pa.array([0], pa.int64()), "parent_id": pa.array([1], pa.int64()), "slice": pa.array([0], pa.int32()), "chrom": ["chr1"], "start_pos": pa.array([1], pa.int64()), "end_pos": pa.array([2], pa.int64())})
    ok = list(c._write_groups(str(tmp_path / "a"))(iter([batch])))
    assert ok[0]["n_records"].to_pylist() == [1] and os.listdir(tmp_path / "a") == ["group-000000000.parquet"]
    monkeypatch.setattr(pq.ParquetFile, "iter_batches", lambda self, **k: iter([]))
    with pytest.raises(OSError):
        list(c._write_groups(str(tmp_path / "b"))(iter([batch])))
    assert os.listdir(tmp_path / "b") == []


def test_nothing_is_published_that_differs_from_the_source(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(c, "_total", lambda df, n=iter(range(9)): next(n))  # digests that differ
    with pytest.raises(OSError, match="nothing is published"):
        c.compact(files(spark), where=str(tmp_path / "out"))
    assert not any(x in ("data", "manifest") or x.startswith("_staged") for x in os.listdir(tmp_path / "out"))


def test_digests_see_every_field():
    import pyarrow as pa

    row = {"parent_id": 5, "slice": 1, "chrom": "chr1", "start_pos": 10, "end_pos": 20}
    digest = lambda **x: c._digest(pa.RecordBatch.from_pylist([row | x], pa.schema([("parent_id", pa.int64()), ("slice", pa.int32()), ("chrom", pa.string()), ("start_pos", pa.int64()), ("end_pos", pa.int64())])))
    assert len({digest(), digest(parent_id=6), digest(slice=2), digest(chrom="chr2"), digest(start_pos=11), digest(end_pos=21)}) == 6


def test_each_group_is_a_task_of_its_own(spark):
    rows = spark.range(64).select(F.col("id").cast("int").alias("group_id")).repartition(5)
    parts = rows.repartitionById(64, "group_id").select("group_id", F.spark_partition_id().alias("p")).collect()
    assert all(r.group_id == r.p for r in parts)


def test_small_inputs_use_every_core(spark):
    rows = [(f, "".join(f"{f * 100_000 + i}\t1\tchr1\t1\t2\n" for i in range(50))) for f in range(400)]
    done = c.compact(files(spark, rows), least_bytes=50_000)
    assert done.n_groups == spark.sparkContext.defaultParallelism == spark.read.parquet(done.manifest).count()
