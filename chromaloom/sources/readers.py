"""Files of sequencing and genomics as DataFrames."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.genomic import flag_set
from ..operators.preprocess import parse_read_name
from .sequencing import SPLIT, BamSource, FastqSource

BED = "chrom string, start_pos long, end_pos long, name string"


def _csv(spark: SparkSession, path: str | Sequence[str], schema: str, **options: object) -> DataFrame:
    return spark.read.options(sep="\t", comment="#", mode="PERMISSIVE", **{k: str(v) for k, v in options.items()}).schema(schema).csv(path)


def read_bed(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """chrom, start_pos, end_pos, name; lines without places are left out, a missing file is an empty set."""
    try:
        return _csv(spark, path, BED).where("chrom IS NOT NULL AND start_pos IS NOT NULL AND end_pos IS NOT NULL")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], BED)


def check_bed(bed: DataFrame) -> DataFrame:
    """One row: whether all places are valid, all are named, and no name comes twice."""
    names = bed.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    twice = F.count_if((F.col("n") > 1) & F.col("name").isNotNull()) > 0
    a = bed.agg(F.coalesce(F.every((F.col("start_pos") >= 0) & (F.col("end_pos") >= F.col("start_pos"))), F.lit(True)).alias("valid"), (F.count_if(F.col("name").isNull()) == 0).alias("named"))
    return a.withColumn("k", F.lit(1)).join(names.agg(twice.alias("duplicated")).withColumn("k", F.lit(1)), "k").drop("k")


def read_bedgraph(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return _csv(spark, path, "chrom string, start_pos long, end_pos long, n double")


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    """chrom, size from a two-column table or an index of a FASTA file."""
    return _csv(spark, path, "chrom string, size long, offset string, a string, b string").select("chrom", "size")


def read_design(spark: SparkSession, path: str) -> DataFrame:
    """sample, condition from a table separated by white space or commas; quoted names may hold either, headers are left out."""
    fields = F.regexp_extract_all("value", F.lit(r'"[^"]*"|[^\s,]+'), F.lit(0))
    lines = spark.read.text(path).where("trim(value) <> ''").select(F.transform(fields, lambda x: F.btrim(x, F.lit('"'))).alias("f"))
    both = lines.select(F.get("f", F.lit(0)).alias("sample"), F.get("f", F.lit(1)).alias("condition"))
    return both.where("sample <> 'sample'")


def read_tables(spark: SparkSession, paths: Sequence[str], sep: str = "\t") -> DataFrame:
    """Tables with headers, one below the other, empty ones passed over; raises if all are empty."""
    parts = []
    for path in paths:
        df = spark.read.options(sep=sep, header="true", inferSchema="true").csv(path)
        if df.columns and df.head(1):
            parts.append(df)
    if not parts:
        raise ValueError("all tables are empty")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _by_source(spark: SparkSession, source: type, path: str | Sequence[str], split: int) -> DataFrame:
    spark.dataSource.register(source)
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format(source.name()).option("paths", json.dumps(paths)).option("split", str(split)).load()


def read_fastq(spark: SparkSession, path: str | Sequence[str], read: int = 1, split: int = SPLIT) -> DataFrame:
    """name, read, sequence, quality, file. Files are read in ranges of ``split`` bytes, compressed ones whole."""
    rows = _by_source(spark, FastqSource, path, split)
    return rows.select("name", F.lit(read).alias("read"), "sequence", "quality", "file")


def read_pairs(spark: SparkSession, first: str | Sequence[str], second: str | Sequence[str]) -> DataFrame:
    """name, sequence1, sequence2, quality1, quality2 of paired files, joined by name."""
    one = read_fastq(spark, first, 1).select("name", F.col("sequence").alias("sequence1"), F.col("quality").alias("quality1"))
    two = read_fastq(spark, second, 2).select("name", F.col("sequence").alias("sequence2"), F.col("quality").alias("quality2"))
    return one.join(two, "name")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """chrom, sequence."""
    records = spark.read.option("lineSep", ">").text(path).where("trim(value) <> ''")
    head, body = F.substring_index("value", "\n", 1), F.expr("substring(value, instr(value, '\n') + 1)")
    return records.select(F.split_part(F.rtrim(head), F.lit(" "), F.lit(1)).alias("chrom"), F.regexp_replace(body, r"\s+", "").alias("sequence"))


def read_sam(spark: SparkSession, path: str | Sequence[str], file_name: str | None = None) -> DataFrame:
    """Alignments in text form, unmapped ones too, as slices: names split, places 0-based and half-open."""
    lines = spark.read.text(path).withColumn("file", F.input_file_name()).where("value NOT LIKE '@%' AND value <> ''")
    f = F.split("value", "\t")
    raw = lines.select(
        F.get(f, F.lit(0)).alias("slice_name"), F.get(f, F.lit(1)).cast("int").alias("flag"), F.get(f, F.lit(2)).alias("rname"),
        F.get(f, F.lit(3)).cast("long").alias("pos"), F.get(f, F.lit(5)).alias("cigar"), F.substring_index("file", "/", -1).alias("file"),
    )
    return alignments_as_slices(raw, file_name)


def read_bam(spark: SparkSession, path: str | Sequence[str], file_name: str | None = None, split: int = SPLIT) -> DataFrame:
    """As read_sam, of compressed binary alignments, in ranges of ``split`` bytes."""
    return alignments_as_slices(_by_source(spark, BamSource, path, split), file_name)


def alignments_as_slices(raw: DataFrame, file_name: str | None = None) -> DataFrame:
    """Alignments (slice_name, flag, rname, pos, cigar, file) as slices.

    Unmapped: no place and no text for it. Secondary alignments are multimapped.
    """
    steps = F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    length = F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    mapped = ~flag_set(F.col("flag"), 0x4)
    chrom, start = F.when(mapped, F.col("rname")), F.when(mapped, F.col("pos") - 1)
    end = F.when(mapped, F.col("pos") - 1 + length)
    name = parse_read_name(F.col("slice_name"))
    return raw.select(
        F.xxhash64("slice_name").alias("slice_id"), "slice_name", F.xxhash64(name["parent_read"]).alias("parent_id"), name["parent_read"].alias("parent_read"),
        name["pe"].alias("pe"), name["slice"].alias("slice"), name["uid"].alias("uid"), mapped.cast("int").alias("mapped"),
        flag_set(F.col("flag"), 0x100).cast("int").alias("multimapped"), chrom.alias("chrom"), start.alias("start_pos"), end.alias("end_pos"),
        F.when(mapped, F.format_string("%s:%d-%d", chrom, start, end)).otherwise("").alias("coordinates"),
        F.lit(file_name).alias("bam") if file_name else F.col("file").alias("bam"),
    )


def sam_to_bed(slices: DataFrame) -> DataFrame:
    return slices.where("mapped = 1").select("chrom", "start_pos", "end_pos", F.col("slice_name").alias("name"))


def read_gtf(spark: SparkSession, path: str, feature: str = "exon", attribute: str = "gene_name") -> DataFrame:
    """chrom, start_pos, end_pos, gene, strand of a feature; the attribute names the gene."""
    schema = "chrom string, source string, feature string, first long, last long, score string, strand string, frame string, attributes string"
    rows = _csv(spark, path, schema, quote="").where(F.col("feature") == feature)
    gene = F.regexp_extract("attributes", attribute + r'[ =]"?([^";]+)', 1)
    return rows.select("chrom", (F.col("first") - 1).alias("start_pos"), F.col("last").alias("end_pos"), gene.alias("gene"), "strand").where("gene <> ''")


def _report(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.options(sep="\t", header="true", inferSchema="true").csv(path)


def read_trimming(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A trimmer's report (Sample, r_processed, r_written, r_with_adapters) of file parts ``sample_part0_1``."""
    rows = _report(spark, path)
    name = F.regexp_extract("Sample", r"^(.+)_part\d+_(\d+)$", 1)
    return rows.select(
        name.alias("sample"), F.regexp_extract("Sample", r"_(\d+)$", 1).try_cast("int").alias("read_number"),
        F.col("r_processed").cast("long").alias("reads_input"), F.col("r_written").cast("long").alias("reads_output"), F.col("r_with_adapters").cast("long").alias("reads_with_adapter"),
    )


def read_merging(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A read merger's report (Sample, combopairs, uncombopairs) of file parts ``sample_part0``."""
    return _report(spark, path).select(F.col("Sample").alias("sample"), F.col("combopairs").cast("long").alias("combined"), F.col("uncombopairs").cast("long").alias("uncombined"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """parent_id from Parquet, JSON lines or text, by the file's ending."""
    kind = file_type(path)
    if kind == "text":
        return spark.read.text(path).where("trim(value) <> ''").select(F.trim("value").alias("parent_id"))
    return spark.read.format(kind).load(path).select("parent_id")


#: Format by a file's ending. Fixed values.
FILE_TYPES = {"parquet": "parquet", "json": "json", "jsonl": "json", "orc": "orc", "csv": "csv", "tsv": "csv", "bed": "csv", "bedgraph": "csv", "txt": "text", "fastq": "text", "fq": "text", "fa": "text", "fasta": "text", "sam": "text"}


def file_type(path: str) -> str:
    """The format of a path, compressed or not; an unknown ending raises KeyError."""
    name = path.rstrip("/").removesuffix(".gz")
    return FILE_TYPES[name.rsplit(".", 1)[-1].lower()]


def rows_by_region(df: DataFrame, chrom: str, start: int, end: int) -> DataFrame:
    """What overlaps a region: predicates that reach Parquet's statistics."""
    return df.where((F.col("chrom") == chrom) & (F.col("start_pos") < end) & (F.col("end_pos") > start))


def best_annotation(slices: DataFrame, annotations: DataFrame) -> DataFrame:
    """Slices with their annotations by (slice_name, chrom, start_pos); of several the smallest in order of its columns."""
    keys = ["slice_name", "chrom", "start_pos"]
    extra = [c for c in annotations.columns if c not in slices.columns]
    order = Window.partitionBy("slice_name").orderBy(*[F.asc_nulls_last(c) for c in ("chrom", "start_pos", *extra)])
    joined = slices.join(annotations.select(*keys, *extra), keys)
    return joined.withColumn("__rank__", F.row_number().over(order)).where("__rank__ = 1").drop("__rank__")
