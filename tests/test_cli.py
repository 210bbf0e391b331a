import os

import pytest
from pyspark.sql import functions as F

from chromaloom import cli
from chromaloom.operators import matrix
from chromaloom.operators.slices import clean_slices

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cli")
    slices = clean_slices(spark.read.parquet(f"{DATA}/slices.parquet"))
    slices.write.parquet(str(root / "slices"))
    for name, table in (("viewpoints", "viewpoints"), ("fragments", "restriction_fragments")):
        spark.read.parquet(f"{DATA}/{table}.parquet").select("chrom", "start_pos", "end_pos", "name").coalesce(1).write.csv(str(root / f"{name}.bed"), sep="\t")
    bams = [r[0] for r in slices.select("bam").distinct().orderBy("bam").collect()]
    (root / "design.tsv").write_text("sample condition\n" + "".join(f"{b} {'AB'[i % 2]}\n" for i, b in enumerate(bams)))
    return root


def test_from_slices_to_comparisons(spark, files):
    run = lambda *args: cli.main([str(x) for x in args], spark)
    f = files
    run("pipeline", "run", f / "slices", f / "viewpoints.bed", f / "fragments.bed", "-o", f / "all", "--bins", "20000,50000", "--design", f / "design.tsv")
    store = matrix.read_store(spark, str(f / "all/store"))
    totals = {r.resolution: r.n for r in store.groupBy("resolution").agg(F.sum("n").alias("n")).collect()}
    assert set(map(str, totals)) == {"fragments", "20000", "50000"} and len(set(totals.values())) == 1
    assert spark.read.parquet(str(f / "all/differences")).count() > 0
    run("alignments", "filter", f / "slices", "-o", f / "filtered", "-m", "tri", "--stats", f / "stats")
    run("interactions", "deduplicate", f / "filtered", "-o", f / "unique", "--stats", f / "dup")
    run("interactions", "count", f / "unique", "-o", f / "store")
    run("interactions", "merge", f / "store", f / "store", "-o", f / "merged")
    n = lambda p: spark.read.parquet(str(p)).agg(F.sum("n")).first()[0]
    assert n(f / "merged") == 2 * n(f / "store") > 0
    run("interactions", "fragments-to-bins", f / "store", f / "fragments.bed", f / "viewpoints.bed", "-b", "30000")
    run("interactions", "pileup", f / "store", f / "fragments.bed", f / "viewpoints.bed", "-o", f / "profiles", "--normalisation", "n_cis")
    assert os.listdir(f / "profiles")
    run("utilities", "dump", f"{f}/store", "-o", f / "dumped")
    run("utilities", "interaction-maps", f / "fragments.bed", f / "viewpoints.bed", "-o", f / "maps")
    assert spark.read.csv(f"{f}/maps.baitmap", sep="\t").count() >= 64
    run("utilities", "cis-and-trans-stats", f / "filtered", "-o", f / "cis")
    run("alignments", "annotate", f / "slices", "-o", f / "annotated", "-b", f / "viewpoints.bed", "-n", "seen", "-a", "get", "-f", "0.75")
    assert spark.read.parquet(f"{f}/annotated").count() == spark.read.parquet(f"{f}/slices").count()


def test_reads(spark, tmp_path):
    run = lambda *args: cli.main([str(x) for x in args], spark)
    for k in "12":
        (tmp_path / f"r_{k}.fastq").write_text("".join(f"@r{i}\nAAAAAGATC{'ACGT'[i % 2] * 9}\n+\n{'I' * 18}\n" for i in range(4)))
    run("fastq", "deduplicate", tmp_path / "r_1.fastq", tmp_path / "r_2.fastq", "-o", tmp_path / "u")
    assert cli.readers.read_fastq(spark, str(tmp_path / "u_1")).count() == 2
    run("fastq", "digest", tmp_path / "r_1.fastq", "-o", tmp_path / "d", "-r", "dpnii", "--minimum", "4")
    assert cli.readers.read_fastq(spark, str(tmp_path / "d")).count() == 8
    run("fastq", "split", tmp_path / "r_1.fastq", "-o", tmp_path / "s", "-n", "1")
    (tmp_path / "g.fa").write_text(">chr1\nAAAAAAGATCAAAAAA\n")
    run("genome", "digest", tmp_path / "g.fa", "-o", tmp_path / "g.bed", "-r", "GATC", "--minimum", "3")
    assert cli.readers.read_bed(spark, str(tmp_path / "g.bed")).count() == 2
    with pytest.raises(SystemExit):
        run("fastq", "nothing")
