import pytest
from pyspark.sql import functions as F

from chromaloom.functions import genomic
from chromaloom.operators import preprocess, stats
from chromaloom.sources import readers, writers
from chromaloom.streaming import deliveries


def test_digestion(spark):
    genome = spark.createDataFrame([("chr1", "AAAAAgatcCCCGATCTTTT"), ("chr2", None), ("chr3", "")], "chrom string, sequence string")
    got = sorted((r.chrom, r.start_pos, r.end_pos) for r in preprocess.digest_genome(genome, "dpnii", 3).collect())
    assert got == [("chr1", 0, 5), ("chr1", 9, 12), ("chr1", 16, 20)]
    kept = sorted((r.start_pos, r.end_pos) for r in preprocess.digest_genome(genome, "GATC", 3, keep_site=True).collect())
    assert kept == [(0, 5), (5, 12), (12, 20)]
    names = {(r.chrom, r.start_pos): r.name for r in preprocess.numbered(preprocess.digest_genome(genome, "GATC", 3)).collect()}
    assert names == {("chr1", 0): 0, ("chr1", 9): 1, ("chr1", 16): 2}
    with pytest.raises(ValueError):
        genomic.recognition_site("nonsense-1")


def test_read_digestion(spark):
    reads = spark.createDataFrame([("r", 1, "AAAGATCCC", "123456789"), ("q", 1, "AAAA", "1111"), ("r", 2, "TTTT", "abcd")], "name string, read int, sequence string, quality string")
    flashed = {(r.slice_name, r.sequence, r.quality) for r in preprocess.digest_reads(reads.where("read = 1"), "GATC", minimum=2).collect()}
    assert flashed == {("r|flashed|0|0", "AAA", "123"), ("r|flashed|1|1", "CC", "89")}
    pe = {r.slice_name for r in preprocess.digest_reads(reads, "GATC", "pe", 2).collect()}
    assert pe == {"r|pe|0|0", "r|pe|1|1", "r|pe|2|0", "q|pe|0|0"}


def test_duplicate_reads(spark):
    reads = spark.createDataFrame([("b", "AC", "G"), ("a", "AC", "G"), ("c", "AC", None), ("d", "AC", None)], "name string, s1 string, s2 string")
    assert {r.name for r in preprocess.deduplicate_reads(reads, "name", ["s1", "s2"]).collect()} == {"a", "c"}
    assert tuple(preprocess.deduplication_counts(reads, ["s1", "s2"]).first()) == (4, 2, 2, 50.0)
    assert preprocess.deduplication_counts(reads.limit(0), ["s1"]).first().percentage is None


def test_files(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("@r1/1 x\nACGT\n+\nIIII\n@r2\nGG\n+\nII\n")
    reads = readers.read_fastq(spark, str(tmp_path / "a.fastq"))
    assert [(r.name, r.sequence, r.quality) for r in reads.orderBy("name").collect()] == [("r1", "ACGT", "IIII"), ("r2", "GG", "II")]
    writers.write_fastq(reads, str(tmp_path / "out"), reads_per_file=1, gzip=False)
    assert readers.read_fastq(spark, str(tmp_path / "out")).count() == 2
    (tmp_path / "g.fa").write_text(">chr1 some\nACG\nT\n>chr2\nGG\n")
    assert {(r.chrom, r.sequence) for r in readers.read_fasta(spark, str(tmp_path / "g.fa")).collect()} == {("chr1", "ACGT"), ("chr2", "GG")}
    (tmp_path / "x.bed").write_text("chr1\t1\t5\ta\nnonsense\nchr1\t9\t9\ta\n")
    bed = readers.read_bed(spark, str(tmp_path / "x.bed"))
    assert bed.count() == 2 and tuple(readers.check_bed(bed).first()) == (True, True, True)
    assert readers.read_bed(spark, str(tmp_path / "none.bed")).count() == 0
    (tmp_path / "d.tsv").write_text("sample condition\nA1,x\nA2\ty\n\n")
    assert {tuple(r) for r in readers.read_design(spark, str(tmp_path / "d.tsv")).collect()} == {("A1", "x"), ("A2", "y")}
    (tmp_path / "a.sam").write_text("@HD\nr|PE|0|1\t0\tchr1\t11\t9\t3S4M2I1D\t*\t0\t0\tA\tI\nr|pe|1|0\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\nr|pe|2|0\t256\tchr2\t1\t0\t5M\t*\t0\t0\tA\tI\n")
    got = [(r.slice, r.pe, r.mapped, r.multimapped, r.coordinates) for r in readers.read_sam(spark, str(tmp_path / "a.sam")).orderBy("slice").collect()]
    assert got == [(0, "pe", 1, 0, "chr1:10-15"), (1, "pe", 0, 0, ""), (2, "pe", 1, 1, "chr2:0-5")]
    (tmp_path / "g.gtf").write_text('chr1\tx\texon\t11\t20\t.\t+\t.\tgene_id "1"; gene_name "G";\nchr1\tx\texon\t31\t40\t.\t+\t.\tgene_name "G";\n')
    gene = preprocess.bed12(readers.read_gtf(spark, str(tmp_path / "g.gtf"))).first()
    assert (gene.start_pos, gene.end_pos, gene.block_count, gene.block_sizes, gene.block_starts) == (10, 40, 2, "10,10,", "0,20,")
    assert readers.file_type("a/b.bed.gz") == "csv"
    with pytest.raises(KeyError):
        readers.file_type("a.exe")
    (tmp_path / "e.tsv").write_text("")
    (tmp_path / "f.tsv").write_text("a\tb\n1\t2\n")
    assert readers.read_tables(spark, [str(tmp_path / "e.tsv"), str(tmp_path / "f.tsv")]).count() == 1
    with pytest.raises(ValueError):
        readers.read_tables(spark, [str(tmp_path / "e.tsv")])


def test_scalars(spark):
    rows = [("chr1:5-10", True), ("chr1:10-5", False), ("x", False), (None, False), ("chr1:1,000-2,000", True)]
    df = spark.createDataFrame(rows, "x string, ok boolean")
    assert df.where(genomic.is_coordinate(F.col("x")) != F.col("ok")).count() == 0
    assert genomic.human_bases(1500) == "1.5kb" and genomic.bin_sizes("1000, 5e3") == [1000, 5000] and genomic.bin_sizes("off") == []
    assert genomic.is_on("True") and genomic.is_off("None") and not genomic.is_off("x") and genomic.for_each_file([1], 3) == [1, 1, 1]
    h = spark.sql("SELECT 'abc' AS x").select(genomic.seeded_hash(F.col("x"))).first()[0]
    import xxhash

    assert h % (1 << 64) == xxhash.xxh64_intdigest("abc", seed=42)


def test_stats(spark):
    flash = spark.createDataFrame([("A_part0", 3, 1), ("A_part1", 1, 0), ("B", 0, 0)], "sample string, combined long, uncombined long")
    assert {(r["sample"], r.total, r.percentage) for r in stats.merging(flash).collect()} == {("A", 5, 80.0), ("B", 0, None)}
    trim = spark.createDataFrame([("A", 1, 10, 8, 2), ("A", 1, 10, 9, 1)], "sample string, read_number int, reads_input long, reads_output long, reads_with_adapter long")
    assert stats.trimming(trim).first().percentage_trimmed == 15.0
    hist = spark.createDataFrame([({1: 2, 3: 1},), ({1: 5},)], "hist map<int,long>")
    assert stats.merged_histograms(hist).first().hist == {1: 7, 3: 1}
    slices = spark.createDataFrame([("r", "1"), ("r", "1"), ("r", "2")], "name string, read string")
    got = {r.when: r.asDict() for r in stats.digestion(slices, slices.where("read = '1'")).collect()}
    assert got["unfiltered"]["1_slices"] == 2 and got["filtered"]["2_reads"] == 0


def test_stream(spark, tmp_path):
    data = "/root/testdata/sf0.001/slices.parquet"
    schema = spark.read.parquet(data).schema
    folder = tmp_path / "in"
    spark.read.parquet(data).repartition(3).write.parquet(str(folder))
    first = deliveries.first_deliveries(deliveries.slice_stream(spark, str(folder), schema), "365 days")
    deliveries.run_to_end(first.select("slice_name", "record_id"), str(tmp_path / "out"), str(tmp_path / "check"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == out.select("slice_name").distinct().count()
    from chromaloom.functions.text import plain_slice

    assert out.count() == spark.read.parquet(data).select(plain_slice(F.col("slice_name"))).distinct().count()
    again = deliveries.first_deliveries(deliveries.slice_stream(spark, str(folder), schema), "365 days")
    deliveries.run_to_end(again.select("slice_name", "record_id"), str(tmp_path / "out"), str(tmp_path / "check"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == out.count()
