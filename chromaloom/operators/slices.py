"""The slices table as delivered -> one clean row for each slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_missing, plain, plain_slice, sql_missing, sql_plain, sql_plain_slice

COLUMNS = (
    "slice_id", "slice_name", "parent_id", "pe", "slice", "uid", "mapped", "multimapped", "chrom", "start_pos", "end_pos",
    "coordinates", "bam", "capture", "capture_count", "exclusion", "exclusion_count", "blacklist", "restriction_fragment",
)


def chrom_name(c: Column) -> Column:
    """``chrN`` in one spelling; NULL where missing."""
    bare = F.upper(F.regexp_replace(plain(c), "^chr", ""))
    return F.when(~is_missing(c), F.concat(F.lit("chr"), bare))


def name_or_null(c: Column) -> Column:
    return F.when(~is_missing(c), plain(c))


def coordinates(chrom: Column, start: Column, end: Column) -> Column:
    """``chrom:start-end``, or an empty string where there is no place."""
    text = F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))
    return F.coalesce(text, F.lit(""))


def clean_slices(slices: DataFrame) -> DataFrame:
    """One row for each slice name in plain form, with names, chromosomes and counts in one spelling.

    Of several records the one with a chromosome, loaded last, of the smallest record_id is taken;
    its record_id is the slice_id. The read comes from the slice name, which is never NULL. Counts
    that are NULL are 0, places of unmapped slices NULL.
    """
    name = plain_slice(F.col("slice_name"))
    latest = Window.partitionBy("slice_name").orderBy("lost", F.desc_nulls_last("loaded_at"), "record_id")
    ranked = slices.withColumn("slice_name", name).withColumn("lost", is_missing(F.col("chrom")))
    one = ranked.withColumn("rank", F.row_number().over(latest)).where("rank = 1")
    placed = (F.col("mapped") == 1) & ~F.col("lost")
    chrom, start, end = (F.when(placed, c) for c in (chrom_name(F.col("chrom")), F.col("start_pos"), F.col("end_pos")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    # a count belongs to its name: none without one, at least one with one unless it was delivered
    counted = lambda c: F.when(is_missing(F.col(c)), 0).otherwise(F.coalesce(f"{c}_count", F.lit(1))).alias(f"{c}_count")
    return one.select(
        F.col("record_id").alias("slice_id"), "slice_name", F.split_part("slice_name", F.lit("|"), F.lit(1)).alias("parent_id"),
        "pe", "slice", "uid", F.when(placed, 1).otherwise(0).alias("mapped"), zero("multimapped"),
        chrom.alias("chrom"), start.alias("start_pos"), end.alias("end_pos"), coordinates(chrom, start, end).alias("coordinates"),
        "bam", name_or_null(F.col("capture")).alias("capture"), counted("capture"), name_or_null(F.col("exclusion")).alias("exclusion"),
        counted("exclusion"), zero("blacklist"), F.when(placed, F.col("restriction_fragment")).alias("restriction_fragment"),
    )


def sql_chrom(c: str) -> str:
    """``chrom_name`` in SQL."""
    return f"CASE WHEN NOT {sql_missing(c)} THEN 'chr' || upper(regexp_replace({sql_plain(c)}, '^chr', '')) END"


def sql_clean() -> str:
    """The same as a common table expression named s."""
    lost, chrom = sql_missing("chrom"), f"'chr' || upper(regexp_replace({sql_plain('chrom')}, '^chr', ''))"
    placed = "mapped = 1 AND NOT lost"
    return f"""
    s0 AS (SELECT *, {sql_plain_slice("slice_name")} AS name, {lost} AS lost FROM slices),
    s1 AS (SELECT * FROM s0 QUALIFY row_number() OVER (PARTITION BY name ORDER BY lost, loaded_at DESC NULLS LAST, record_id) = 1),
    s AS (
        SELECT record_id AS slice_id, name AS slice_name, split_part(name, '|', 1) AS parent_id, pe, slice, uid,
            CASE WHEN {placed} THEN 1 ELSE 0 END AS mapped, coalesce(multimapped, 0) AS multimapped,
            CASE WHEN {placed} THEN {chrom} END AS chrom, CASE WHEN {placed} THEN start_pos END AS start_pos, CASE WHEN {placed} THEN end_pos END AS end_pos,
            CASE WHEN {placed} THEN {chrom} || ':' || start_pos || '-' || end_pos ELSE '' END AS coordinates, bam,
            CASE WHEN NOT {sql_missing("capture")} THEN {sql_plain("capture")} END AS capture, CASE WHEN {sql_missing("capture")} THEN 0 ELSE coalesce(capture_count, 1) END AS capture_count,
            CASE WHEN NOT {sql_missing("exclusion")} THEN {sql_plain("exclusion")} END AS exclusion, CASE WHEN {sql_missing("exclusion")} THEN 0 ELSE coalesce(exclusion_count, 1) END AS exclusion_count,
            coalesce(blacklist, 0) AS blacklist, CASE WHEN {placed} THEN restriction_fragment END AS restriction_fragment
        FROM s1)"""
