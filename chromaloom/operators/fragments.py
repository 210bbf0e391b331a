"""Slices summarised by fragment, sample and capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .filters import captures, reporter_count, reporters
from .stats import percentage


def _joined(column: str, order: list[str]) -> Column:
    """The column's values joined by | in the given order."""
    ordered = F.sort_array(F.collect_list(F.struct(*order, F.col(column).alias("__v__"))))
    return F.array_join(F.transform(ordered, lambda x: x["__v__"]), "|")


def fragments(df: DataFrame) -> DataFrame:
    """One row for each fragment: sums, distinct counts, its places in genomic order, its reporters."""
    distinct = lambda c: F.size(F.collect_set(c)).cast("long")  # noqa: E731 - a fragment has few slices
    return df.groupBy("parent_id").agg(
        distinct("slice").alias("unique_slices"), F.min("pe").alias("pe"), F.sum("mapped").alias("mapped"), F.sum("multimapped").alias("multimapped"),
        distinct("capture").alias("unique_capture_sites"), F.sum("capture_count").alias("capture_count"),
        distinct("exclusion").alias("unique_exclusions"), F.sum("exclusion_count").alias("exclusion_count"),
        distinct("restriction_fragment").alias("unique_restriction_fragments"), F.sum("blacklist").alias("blacklist"),
        _joined("coordinates", ["chrom", "start_pos", "slice_id"]).alias("coordinates"), reporter_count().alias("reporter_count"),
    )


def fragments_tiled(df: DataFrame) -> DataFrame:
    """As fragments, with what a tiled assay keeps."""
    return fragments(df).select("parent_id", "unique_slices", "pe", "mapped", "multimapped", "capture_count", "unique_restriction_fragments", "blacklist", "coordinates")


def slice_stats(df: DataFrame) -> DataFrame:
    """One row of totals over all slices; zeros without any."""
    counted = lambda c: F.count_if(F.col(c) > 0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return df.agg(
        F.countDistinct("slice_name").alias("unique_slices"), F.countDistinct("parent_id").alias("unique_fragments"),
        total("mapped").alias("mapped"), total("multimapped").alias("multimapped"),
        F.countDistinct("capture").alias("unique_capture_sites"), counted("capture_count").alias("captured"),
        counted("exclusion_count").alias("excluded"), counted("blacklist").alias("blacklisted"),
        (F.count(F.lit(1)) - counted("capture_count")).alias("not_captured"),
    )


def slice_stats_tiled(df: DataFrame) -> DataFrame:
    """As slice_stats, with what a tiled assay keeps; blacklisted counts intervals, not slices."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return df.agg(
        F.countDistinct("slice_name").alias("unique_slices"), F.countDistinct("parent_id").alias("unique_fragments"), total("mapped"),
        total("multimapped"), F.count_if(F.col("capture_count") > 0).alias("captured"), total("blacklist"),
    )


def fragment_stats(per_fragment: DataFrame) -> DataFrame:
    """One row of totals over all fragments."""
    over = lambda c, n: F.count_if(F.col(c) > n)
    return per_fragment.agg(
        F.count(F.lit(1)).alias("unique_fragments"), over("unique_slices", 1).alias("multiple_slices"), over("capture_count", 0).alias("captured"),
        over("unique_capture_sites", 1).alias("several_captures"), over("exclusion_count", 0).alias("excluded"), over("blacklist", 0).alias("blacklisted"),
        F.coalesce(F.sum("reporter_count"), F.lit(0)).alias("reporters"),
    )


def capture_site_stats(df: DataFrame) -> DataFrame:
    """Captured slices of each capture."""
    return captures(df).groupBy("capture").agg(F.count(F.lit(1)).alias("n"))


def captures_and_reporters(df: DataFrame) -> DataFrame:
    """Each captured slice with each reporter of its fragment; NULLs where there is none."""
    named = lambda d, p: d.select("parent_id", *[F.col(c).alias(f"{p}_{c}") for c in d.columns if c != "parent_id"])
    return named(captures(df), "capture").join(named(reporters(df), "reporter"), "parent_id", "left")


def cis_or_trans(df: DataFrame) -> DataFrame:
    """viewpoint, cis_or_trans, n: capture and reporter pairs on one chromosome or not (without one: trans)."""
    pairs = captures_and_reporters(df)
    cis = F.when(F.col("capture_chrom") == F.col("reporter_chrom"), "cis").otherwise("trans")
    return pairs.groupBy(F.col("capture_capture").alias("viewpoint"), cis.alias("cis_or_trans")).agg(F.count(F.lit(1)).alias("n"))


def cis_or_trans_tiled(df: DataFrame) -> DataFrame:
    """viewpoint, cis_or_trans, n where captured slices count as reporters too.

    Of each fragment and capture the first captured slice is the capture; its other slices in that
    capture and those in none are the reporters. The capture's chromosome is its most frequent one.
    """
    captured = captures(df).where("capture IS NOT NULL")
    home = captured.groupBy("capture", "chrom").agg(F.count(F.lit(1)).alias("n"))
    home = home.groupBy("capture").agg(F.max_by("chrom", F.struct("n", "chrom")).alias("home"))
    first = Window.partitionBy("parent_id", "capture").orderBy("slice", "slice_id")
    inside = captured.withColumn("rank", F.row_number().over(first)).where("rank > 1").select("capture", "chrom")
    with_capture = captured.select("parent_id", "capture").distinct()
    outside = df.where("capture_count = 0").select("parent_id", "chrom").join(with_capture, "parent_id").select("capture", "chrom")
    both = inside.unionByName(outside).join(home, "capture")
    cis = F.when(F.col("chrom") == F.col("home"), "cis").otherwise("trans")
    return both.groupBy(F.col("capture").alias("viewpoint"), cis.alias("cis_or_trans")).agg(F.count(F.lit(1)).alias("n"))


def cis_or_trans_tiled_by_read_type(df: DataFrame) -> DataFrame:
    """viewpoint, read_type, cis_or_trans, n over all slices with a viewpoint (matrix.with_viewpoint): cis is
    the chromosome that most of the viewpoint's captured slices are on."""
    home = captures(df).groupBy("viewpoint", "chrom").agg(F.count(F.lit(1)).alias("n"))
    home = home.groupBy("viewpoint").agg(F.max_by("chrom", F.struct("n", "chrom")).alias("home"))
    cis = F.when(F.col("chrom") == F.col("home"), "cis").otherwise("trans")
    # the slices are added up before they meet the viewpoints' chromosomes
    each = df.where("viewpoint IS NOT NULL").groupBy("viewpoint", F.col("pe").alias("read_type"), "chrom").agg(F.count(F.lit(1)).alias("n"))
    return each.join(home, "viewpoint", "left").groupBy("viewpoint", "read_type", cis.alias("cis_or_trans")).agg(F.sum("n").alias("n"))


def duplicate_signatures(df: DataFrame, unmerged: bool) -> DataFrame:
    """parent_id -> what makes fragments duplicates of each other.

    Merged reads: their places in order of their text. Unmerged: first chromosome and start, last end,
    in genomic order.
    """
    if unmerged:
        place = F.struct("chrom", "start_pos", "end_pos")
        least, most = F.min(place), F.max(place)
        text = F.concat_ws("|", least["chrom"], least["start_pos"].cast("string"), most["end_pos"].cast("string"))
    else:
        text = F.array_join(F.sort_array(F.collect_list("coordinates")), ",")
    return df.groupBy("parent_id").agg(text.alias("signature"))


def deduplicate_fragments(df: DataFrame, unmerged: bool = False) -> DataFrame:
    """Slices of the fragment of the smallest parent_id for each signature."""
    kept = duplicate_signatures(df, unmerged).groupBy("signature").agg(F.min("parent_id").alias("parent_id"))
    return df.join(kept.select("parent_id"), "parent_id", "left_semi")


def without_duplicates(df: DataFrame, duplicates: DataFrame, key: str = "parent_id") -> DataFrame:
    """Rows whose key isn't among the duplicates'."""
    return df.join(duplicates.select(key).distinct(), key, "left_anti")


def deduplication_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Reads and slices before and after, duplicates, and percentages."""
    b = before.select(F.lit(1).alias("when"), "parent_id", "slice_id")
    a = after.select(F.lit(2).alias("when"), "parent_id", "slice_id")
    both = b.unionByName(a)
    at = lambda k, c: F.countDistinct(F.when(F.col("when") == k, F.col(c)))
    n = both.agg(at(1, "parent_id").alias("total_reads"), at(2, "parent_id").alias("unique_reads"), at(1, "slice_id").alias("total_slices"), at(2, "slice_id").alias("unique_slices"))
    for kind in ("reads", "slices"):
        n = n.withColumn(f"duplicated_{kind}", F.col(f"total_{kind}") - F.col(f"unique_{kind}"))
        n = n.withColumn(f"percent_{kind}", percentage(f"duplicated_{kind}", f"total_{kind}"))
    return n


def by_alignment_score(df: DataFrame, score: Column, prefer: list[str] = (), favour_cis: bool = False) -> DataFrame:
    """One alignment for each slice name: of the best score, then on a preferred chromosome.

    With ``favour_cis`` scores double on the chromosome that most of the read's alignments are on,
    and halve on others. Ties go to the smaller chromosome, start and record. An alignment without a
    score comes last; one without a chromosome has no say in its read's.
    """
    df = df.withColumn("score", score.cast("double"))
    if favour_cis:
        reads = df.where("chrom IS NOT NULL").groupBy("parent_id", "chrom").agg(F.count(F.lit(1)).alias("n")).groupBy("parent_id")
        home = reads.agg(F.max_by("chrom", F.struct("n", "chrom")).alias("home"))
        df = df.join(home, "parent_id", "left").withColumn("score", F.when(F.col("chrom") == F.col("home"), F.col("score") * 2).otherwise(F.col("score") / 2))
    preferred = F.col("chrom").isin(*prefer) if prefer else F.lit(False)
    best = Window.partitionBy("slice_name").orderBy(F.desc_nulls_last("score"), F.desc_nulls_last("preferred"), "chrom", "start_pos", "record_id")
    return df.withColumn("preferred", preferred).withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank", "preferred")
