"""DataFrames as the files that other tools read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a Parquet file at most.
ROWS_PER_FILE = 2_000_000


def write_parquet(df: DataFrame, path: str, mode: str = "error", rows_per_file: int = ROWS_PER_FILE) -> None:
    """An empty DataFrame leaves a file with its schema."""
    df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_tsv(df: DataFrame, path: str, header: bool = True, gzip: bool = False, mode: str = "error") -> None:
    options = {"sep": "\t", "header": str(header).lower(), "compression": "gzip" if gzip else "none"}
    df.write.mode(mode).options(**options).csv(path)


def write_bedgraph(track: DataFrame, path: str, gzip: bool = False, mode: str = "error") -> None:
    """chrom, start_pos, end_pos, n in genomic order, without header: part files in order of their names."""
    write_tsv(track.select("chrom", "start_pos", "end_pos", "n").orderBy("chrom", "start_pos", "end_pos"), path, header=False, gzip=gzip, mode=mode)


def write_bed(df: DataFrame, path: str, mode: str = "error") -> None:
    write_tsv(df.select("chrom", "start_pos", "end_pos", "name").orderBy("chrom", "start_pos", "end_pos"), path, header=False, mode=mode)


def write_fasta(sequences: DataFrame, path: str, width: int = 60, mode: str = "error") -> None:
    """chrom, sequence as FASTA records with lines of ``width`` bases."""
    lines = F.array_join(F.regexp_extract_all("sequence", F.lit(f".{{1,{width}}}"), F.lit(0)), "\n")
    sequences.select(F.concat(F.lit(">"), F.col("chrom"), F.lit("\n"), lines).alias("value")).write.mode(mode).text(path)


def fastq_text(reads: DataFrame) -> DataFrame:
    """value: each read as the four lines of a FASTQ record."""
    return reads.select(F.concat_ws("\n", F.concat(F.lit("@"), F.col("name")), "sequence", F.lit("+"), "quality").alias("value"))


def write_fastq(reads: DataFrame, path: str, reads_per_file: int = 1_000_000, gzip: bool = True, mode: str = "error") -> None:
    """FASTQ files of at most so many reads."""
    options = {"maxRecordsPerFile": str(reads_per_file), "compression": "gzip" if gzip else "none"}
    fastq_text(reads).write.mode(mode).options(**options).text(path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).json(path)


def write_design(design: DataFrame, path: str, mode: str = "error") -> None:
    """sample, condition as lines separated by blanks. A name with white space or a comma in it is quoted."""
    named = lambda c: F.when(F.col(c).rlike(r"[\s,]"), F.concat(F.lit('"'), F.col(c), F.lit('"'))).otherwise(F.col(c))
    design.select(F.concat_ws("  ", named("sample"), named("condition")).alias("value")).write.mode(mode).text(path)


def dump(df: DataFrame, path: str, viewpoint: str | None = None, mode: str = "error") -> None:
    """A store or slices as text, of one viewpoint if given."""
    write_tsv(df if viewpoint is None else df.where(F.col("viewpoint") == viewpoint), path, mode=mode)
