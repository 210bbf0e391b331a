"""From sequences and reads to slices: digestion, duplicate reads, read names, gene models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.genomic import recognition_site


def _pieces(sequence: Column, site: str) -> Column:
    """array<struct<start, piece>>: what lies between the sites, with its place from 0."""
    parts = F.split(F.upper(sequence), site)
    starts = F.aggregate(
        parts,
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("array()").cast("array<bigint>").alias("starts")),
        lambda s, p: F.struct((s["at"] + F.length(p) + len(site)).alias("at"), F.array_append(s["starts"], s["at"]).alias("starts")),
        lambda s: s["starts"],
    )
    return F.arrays_zip(starts.alias("start"), parts.alias("piece"))


def digest_genome(sequences: DataFrame, enzyme: str, minimum: int = 18, keep_site: bool = False) -> DataFrame:
    """chrom, start_pos, end_pos: the fragments that an enzyme leaves of sequences (chrom, sequence).

    The site is removed, or begins the next fragment with ``keep_site``; fragments shorter than the
    minimum are left out. NULL and empty sequences give nothing.
    """
    site = recognition_site(enzyme)
    each = sequences.where("sequence IS NOT NULL").select("chrom", F.posexplode(F.split(F.upper("sequence"), site)).alias("i", "piece"))
    each = each.select("chrom", "i", F.length("piece").cast("long").alias("n"))
    earlier = Window.partitionBy("chrom").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("n") + len(site)).over(earlier), F.lit(0))
    before = F.when((F.col("i") > 0) & F.lit(keep_site), len(site)).otherwise(0)
    placed = each.withColumn("start", start).select("chrom", (F.col("start") - before).alias("start_pos"), (F.col("start") + F.col("n")).alias("end_pos"))
    return placed.where(F.col("end_pos") - F.col("start_pos") >= minimum)


#: Fragments that start within a stretch of this many bases are numbered by one task.
STRETCH = 1 << 20


def numbered(fragments: DataFrame) -> DataFrame:
    """Fragments with ``name``: their number in genomic order, from 0.

    Counts per stretch of a chromosome are added up, so that no task sees more than a stretch's
    fragments, or a row for each stretch.
    """
    parts = fragments.withColumn("__stretch__", F.floor(F.col("start_pos") / STRETCH))
    order = Window.partitionBy("chrom", "__stretch__").orderBy("start_pos", "end_pos")
    before = Window.orderBy("chrom", "__stretch__").rowsBetween(Window.unboundedPreceding, -1)  # one row a stretch
    counted = parts.groupBy("chrom", "__stretch__").agg(F.count(F.lit(1)).alias("n"))
    offset = counted.select("chrom", "__stretch__", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset__"))
    local = parts.withColumn("__i__", F.row_number().over(order) - 1).join(offset, ["chrom", "__stretch__"])
    return local.withColumn("name", F.col("__offset__") + F.col("__i__")).drop("__offset__", "__i__", "__stretch__")


def read_pieces(reads: DataFrame, enzyme: str) -> DataFrame:
    """name, read, uid, length of every piece of reads (name, read, sequence), short ones and whole reads too."""
    pieces = reads.where("sequence IS NOT NULL").select("name", "read", F.posexplode(_pieces(F.col("sequence"), recognition_site(enzyme))).alias("uid", "p"))
    return pieces.select("name", "read", "uid", F.length("p.piece").alias("length"))


def digest_reads(reads: DataFrame, enzyme: str, read_type: str = "flashed", minimum: int = 18) -> DataFrame:
    """slice_name, sequence, quality: the slices of reads (name, read, sequence, quality).

    Merged reads without a site are left out, unmerged ones kept. Names are ``parent|type|slice|uid``:
    slices are numbered through a fragment's reads (``read`` 1 and 2), uid within a read.
    """
    if read_type not in ("flashed", "pe"):
        raise ValueError(f"no read type {read_type}")
    site = recognition_site(enzyme)
    pieces = reads.where("sequence IS NOT NULL").withColumn("p", _pieces(F.col("sequence"), site))
    if read_type == "flashed":
        pieces = pieces.where(F.size("p") > 1)
    each = pieces.select("name", "read", "quality", F.posexplode("p").alias("uid", "p")).where(F.length("p.piece") >= minimum)
    order = Window.partitionBy("name").orderBy("read", "uid")
    out = each.withColumn("slice", F.row_number().over(order) - 1)
    quality = F.substring(F.col("quality"), (F.col("p.start") + 1).cast("int"), F.length("p.piece"))
    name = F.concat_ws("|", "name", F.lit(read_type), F.col("slice").cast("string"), F.col("uid").cast("string"))
    return out.select(name.alias("slice_name"), F.col("p.piece").alias("sequence"), quality.alias("quality"))


def deduplicate_reads(reads: DataFrame, key: str, sequences: Sequence[str]) -> DataFrame:
    """One read (the smallest key) for each set of sequences; NULL equals NULL.

    The whole sequences are compared. Duplicates are combined before they are shuffled.
    """
    kept = reads.groupBy(*sequences).agg(F.min(key).alias(key)).select(key)
    return reads.join(kept, key, "left_semi")


def deduplication_counts(reads: DataFrame, sequences: Sequence[str]) -> DataFrame:
    """total, unique, duplicates and the percentage of duplicates."""
    groups = reads.groupBy(*sequences).agg(F.count(F.lit(1)).alias("n"))
    n = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("unique"))
    duplicates = F.col("total") - F.col("unique")
    return n.select("total", "unique", duplicates.alias("duplicates"), F.round(F.try_divide(duplicates * 100.0, F.col("total").cast("double")), 4).alias("percentage"))


def regenerate_reads(reads: DataFrame, name: str, slices: DataFrame, parent: str = "parent_read") -> DataFrame:
    """The reads that slices came from."""
    return reads.join(slices.select(F.col(parent).alias(name)).distinct(), name, "left_semi")


def parse_read_name(c: Column) -> Column:
    """``parent|pe|slice|uid`` -> struct."""
    at = lambda i: F.get(F.split(c, r"\|"), F.lit(i))
    return F.struct(at(0).alias("parent_read"), F.lower(at(1)).alias("pe"), at(2).try_cast("int").alias("slice"), at(3).try_cast("int").alias("uid"))


def bed12(exons: DataFrame) -> DataFrame:
    """Genes (chrom, start_pos, end_pos, gene, strand: a row for each exon) as BED12."""
    order = F.sort_array(F.collect_set(F.struct("start_pos", "end_pos")))
    g = exons.groupBy("chrom", "gene", "strand").agg(F.min("start_pos").alias("first"), F.max("end_pos").alias("last"), order.alias("x"))
    listed = lambda f: F.concat(F.array_join(F.transform("x", lambda e: f(e).cast("string")), ","), F.lit(","))
    return g.select(
        "chrom", F.col("first").alias("start_pos"), F.col("last").alias("end_pos"), F.col("gene").alias("name"), F.lit(0).alias("score"), "strand",
        F.col("first").alias("thick_start"), F.col("last").alias("thick_end"), F.lit("0,0,0").alias("rgb"), F.size("x").alias("block_count"),
        listed(lambda e: e["end_pos"] - e["start_pos"]).alias("block_sizes"), listed(lambda e: e["start_pos"] - F.col("first")).alias("block_starts"),
    )


def samples_from_names(files: DataFrame, path: str = "path") -> DataFrame:
    """sample, condition, replicate, fq1, fq2 from file names such as ``cond_rep1_1.fastq.gz``."""
    base = F.regexp_replace(F.substring_index(path, "/", -1), r"\.f(ast)?q(\.gz)?$", "")
    pattern = r"^(.*?)_?R?([12])$"
    found = files.select(F.regexp_extract(base, pattern, 1).alias("sample"), F.regexp_extract(base, pattern, 2).alias("read"), F.col(path).alias("file")).where("read <> ''")
    wide = found.groupBy("sample").agg(*[F.min(F.when(F.col("read") == r, F.col("file"))).alias(f"fq{r}") for r in ("1", "2")])
    parts = F.split("sample", "_")
    return wide.select("sample", F.get(parts, F.lit(0)).alias("condition"), F.get(parts, F.lit(1)).alias("replicate"), "fq1", "fq2")


def viewpoint_fragments(hits: DataFrame) -> DataFrame:
    """One fragment for each viewpoint: the first in genomic order (name, chrom, start_pos, end_pos).

    The name ends before ``_L`` if it has one.
    """
    short = F.regexp_replace("name", r"_L.*$", "")
    first = F.min(F.struct("chrom", "start_pos", "end_pos")).alias("p")
    return hits.groupBy(short.alias("name")).agg(first).select("name", "p.*")
