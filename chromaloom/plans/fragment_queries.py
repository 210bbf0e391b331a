"""Fragments, their statistics, cis and trans, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import plain_slice, sql_missing, sql_plain, sql_plain_slice
from ..operators import filters, fragments
from ..operators.slices import chrom_name, sql_chrom, sql_clean
from .filter_queries import slices, sql_program
from .registry import Registry
from .tables import table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql

S = sql_clean()
SQL_FRAGMENTS = """fragments AS (
    SELECT parent_id, count(DISTINCT slice) AS unique_slices, min(pe) AS pe, CAST(sum(mapped) AS BIGINT) AS mapped, CAST(sum(multimapped) AS BIGINT) AS multimapped,
        count(DISTINCT capture) AS unique_capture_sites, CAST(sum(capture_count) AS BIGINT) AS capture_count, count(DISTINCT exclusion) AS unique_exclusions,
        CAST(sum(exclusion_count) AS BIGINT) AS exclusion_count, count(DISTINCT restriction_fragment) AS unique_restriction_fragments,
        CAST(sum(blacklist) AS BIGINT) AS blacklist, string_agg(coordinates, '|' ORDER BY chrom NULLS FIRST, start_pos NULLS FIRST, slice_id) AS coordinates,
        CAST(CASE WHEN sum(capture_count) > 0 THEN sum(mapped) - (sum(exclusion_count) + sum(capture_count) + sum(blacklist)) ELSE 0 END AS BIGINT) AS reporter_count
    FROM s GROUP BY parent_id)"""


def kept(spark: SparkSession, sf_dir: str, program: str = "capture") -> DataFrame:
    return filters.run_program(slices(spark, sf_dir), program)


@R.query(f"WITH {S}, {SQL_FRAGMENTS} SELECT * FROM fragments")
def fragments_cc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.fragments(slices(spark, sf_dir))


@R.query(
    f"""WITH {S}, {SQL_FRAGMENTS}
    SELECT parent_id, unique_slices, pe, mapped, multimapped, capture_count, unique_restriction_fragments, blacklist, coordinates FROM fragments"""
)
def fragments_tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.fragments_tiled(slices(spark, sf_dir))


@R.query(
    f"""WITH {S} SELECT count(DISTINCT slice_name) AS unique_slices, count(DISTINCT parent_id) AS unique_fragments, CAST(sum(mapped) AS BIGINT) AS mapped,
    CAST(sum(multimapped) AS BIGINT) AS multimapped, count(DISTINCT capture) AS unique_capture_sites, count(CASE WHEN capture_count > 0 THEN 1 END) AS captured,
    count(CASE WHEN exclusion_count > 0 THEN 1 END) AS excluded, count(CASE WHEN blacklist > 0 THEN 1 END) AS blacklisted,
    count(*) - count(CASE WHEN capture_count > 0 THEN 1 END) AS not_captured FROM s"""
)
def slice_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.slice_stats(slices(spark, sf_dir))


@R.query(
    f"""WITH {S}, {SQL_FRAGMENTS} SELECT count(*) AS unique_fragments, count(CASE WHEN unique_slices > 1 THEN 1 END) AS multiple_slices,
    count(CASE WHEN capture_count > 0 THEN 1 END) AS captured, count(CASE WHEN unique_capture_sites > 1 THEN 1 END) AS several_captures,
    count(CASE WHEN exclusion_count > 0 THEN 1 END) AS excluded, count(CASE WHEN blacklist > 0 THEN 1 END) AS blacklisted,
    CAST(sum(reporter_count) AS BIGINT) AS reporters FROM fragments"""
)
def fragment_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.fragment_stats(fragments.fragments(slices(spark, sf_dir)))


@R.query(f"WITH {S} SELECT capture, count(*) AS n FROM s WHERE capture_count = 1 GROUP BY capture")
def capture_site_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.capture_site_stats(slices(spark, sf_dir))


SQL_PAIRS = "SELECT c.parent_id, c.capture, c.chrom AS cc, r.chrom AS rc, r.slice_id AS reporter, c.slice_id AS captured, c.pe FROM k c LEFT JOIN k r ON r.parent_id = c.parent_id AND r.capture_count < 1 WHERE c.capture_count = 1"


@R.query(f"WITH {S}, {sql_program('capture', 'k')}, pairs AS ({SQL_PAIRS}) SELECT captured, reporter FROM pairs")
def captures_with_reporters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fragments.captures_and_reporters(kept(spark, sf_dir))
    return pairs.select(F.col("capture_slice_id").alias("captured"), F.col("reporter_slice_id").alias("reporter"))


@R.query(
    f"""WITH {S}, {sql_program("capture", "k")}, pairs AS ({SQL_PAIRS})
    SELECT capture AS viewpoint, CASE WHEN cc = rc THEN 'cis' ELSE 'trans' END AS cis_or_trans, count(*) AS n FROM pairs GROUP BY 1, 2"""
)
def cis_trans_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.cis_or_trans(kept(spark, sf_dir))


SQL_TILED = """
    c AS (SELECT * FROM k WHERE capture_count = 1 AND capture IS NOT NULL),
    home AS (SELECT capture, arg_max(chrom, (n, chrom)) AS home FROM (SELECT capture, chrom, count(*) AS n FROM c GROUP BY ALL) GROUP BY capture),
    pseudo AS (
        SELECT capture, chrom FROM c QUALIFY row_number() OVER (PARTITION BY parent_id, capture ORDER BY slice, slice_id) > 1
        UNION ALL SELECT w.capture, o.chrom FROM k o JOIN (SELECT DISTINCT parent_id, capture FROM c) w ON w.parent_id = o.parent_id WHERE o.capture_count = 0)"""


@R.query(
    f"""WITH {S}, {sql_program("tiled", "k")}, {SQL_TILED}
    SELECT p.capture AS viewpoint, CASE WHEN p.chrom = home THEN 'cis' ELSE 'trans' END AS cis_or_trans, count(*) AS n
    FROM pseudo p JOIN home ON home.capture = p.capture GROUP BY 1, 2"""
)
def cis_trans_tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.cis_or_trans_tiled(kept(spark, sf_dir, "tiled"))


@R.query(
    f"""WITH {S}, {sql_program("capture", "k")}, pairs AS ({SQL_PAIRS})
    SELECT capture AS viewpoint, pe AS read_type, CASE WHEN cc = rc THEN 'cis' ELSE 'trans' END AS cis_or_trans, count(*) AS n
    FROM pairs WHERE reporter IS NOT NULL GROUP BY 1, 2, 3"""
)
def cis_trans_by_read_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a capture and a reporter, by read type; captures alone don't count."""
    pairs = fragments.captures_and_reporters(kept(spark, sf_dir)).where("reporter_slice_id IS NOT NULL")
    cis = F.when(F.col("capture_chrom") == F.col("reporter_chrom"), "cis").otherwise("trans")
    return pairs.groupBy(F.col("capture_capture").alias("viewpoint"), F.col("capture_pe").alias("read_type"), cis.alias("cis_or_trans")).agg(F.count(F.lit(1)).alias("n"))


SQL_FLASHED = "m AS (SELECT * FROM s WHERE mapped = 1), u AS (SELECT min(parent_id) AS parent_id FROM (SELECT parent_id, string_agg(coordinates, ',' ORDER BY coordinates) AS x FROM m GROUP BY 1) GROUP BY x)"
SQL_PE = """m AS (SELECT * FROM s WHERE mapped = 1), u AS (SELECT min(parent_id) AS parent_id FROM (
    SELECT parent_id, arg_min(chrom, (chrom, start_pos, end_pos)) AS c, arg_min(start_pos, (chrom, start_pos, end_pos)) AS f, arg_max(end_pos, (chrom, start_pos, end_pos)) AS l FROM m GROUP BY 1) GROUP BY c, f, l)"""


@R.query(f"WITH {S}, {SQL_FLASHED} SELECT slice_id, parent_id FROM m WHERE parent_id IN (SELECT parent_id FROM u)")
def dedup_flashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.deduplicate_fragments(slices(spark, sf_dir).where("mapped = 1")).select("slice_id", "parent_id")


@R.query(f"WITH {S}, {SQL_PE} SELECT slice_id, parent_id FROM m WHERE parent_id IN (SELECT parent_id FROM u)")
def dedup_pe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.deduplicate_fragments(slices(spark, sf_dir).where("mapped = 1"), unmerged=True).select("slice_id", "parent_id")


@R.query(
    f"""WITH {S}, {SQL_FLASHED}, a AS (SELECT * FROM m WHERE parent_id IN (SELECT parent_id FROM u)),
    n AS (SELECT (SELECT count(DISTINCT parent_id) FROM m) AS total_reads, (SELECT count(DISTINCT parent_id) FROM a) AS unique_reads,
        (SELECT count(DISTINCT slice_id) FROM m) AS total_slices, (SELECT count(DISTINCT slice_id) FROM a) AS unique_slices)
    SELECT *, total_reads - unique_reads AS duplicated_reads, total_slices - unique_slices AS duplicated_slices,
        round((total_reads - unique_reads) * 100.0 / total_reads, 4)::DOUBLE AS percent_reads, round((total_slices - unique_slices) * 100.0 / total_slices, 4)::DOUBLE AS percent_slices FROM n"""
)
def dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = slices(spark, sf_dir).where("mapped = 1")
    return fragments.deduplication_stats(before, fragments.deduplicate_fragments(before))


@R.query(
    f"""WITH {S}, {SQL_FLASHED}, d AS (SELECT DISTINCT parent_id FROM m WHERE parent_id NOT IN (SELECT parent_id FROM u))
    SELECT count(*) AS n_slices, count(DISTINCT parent_id) AS n_reads FROM s WHERE parent_id NOT IN (SELECT parent_id FROM d)"""
)
def dedup_by_id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left without the fragments listed as duplicates."""
    s = slices(spark, sf_dir)
    mapped = s.where("mapped = 1")
    unique = fragments.deduplicate_fragments(mapped).select("parent_id").distinct()
    listed = mapped.select("parent_id").distinct().join(unique, "parent_id", "left_anti")
    return fragments.without_duplicates(s, listed).agg(F.count(F.lit(1)).alias("n_slices"), F.countDistinct("parent_id").alias("n_reads"))


SQL_RECORDS = f"""r0 AS (
    SELECT record_id, {sql_plain_slice("slice_name")} AS slice_name, {sql_plain("split_part(slice_name, '|', 1)")} AS parent_id, {sql_chrom("chrom")} AS chrom, start_pos,
        CASE WHEN NOT {sql_missing("chrom")} THEN end_pos - start_pos END AS score
    FROM slices WHERE mapped = 1)"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All mapped records, with slice, read and chromosome in plain form; no score where the chromosome is missing."""
    t = table(spark, sf_dir, "slices").where("mapped = 1")
    t = t.withColumns({"chrom": chrom_name(F.col("chrom")), "slice_name": plain_slice(F.col("slice_name"))})
    return t.withColumn("parent_id", F.split_part("slice_name", F.lit("|"), F.lit(1)))


def _aligned() -> Column:
    return F.when(F.col("chrom").isNotNull(), F.col("end_pos") - F.col("start_pos"))


@R.query(
    f"""WITH {SQL_RECORDS} SELECT record_id, chrom FROM r0
    QUALIFY row_number() OVER (PARTITION BY slice_name ORDER BY score DESC NULLS LAST, chrom = 'chr7' DESC NULLS LAST, chrom NULLS FIRST, start_pos NULLS FIRST, record_id) = 1"""
)
def dedup_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best alignment of each slice, by length, then on a preferred chromosome."""
    best = fragments.by_alignment_score(_records(spark, sf_dir), _aligned(), prefer=["chr7"])
    return best.select("record_id", "chrom")


@R.query(
    f"""WITH {SQL_RECORDS}, home AS (
        SELECT parent_id, arg_max(chrom, (n, chrom)) AS home FROM (SELECT parent_id, chrom, count(*) AS n FROM r0 WHERE chrom IS NOT NULL GROUP BY ALL) GROUP BY 1)
    SELECT record_id, r0.chrom FROM r0 LEFT JOIN home ON home.parent_id = r0.parent_id
    QUALIFY row_number() OVER (PARTITION BY slice_name ORDER BY CASE WHEN r0.chrom = home THEN score * 2.0 ELSE score / 2.0 END DESC NULLS LAST, r0.chrom NULLS FIRST, start_pos NULLS FIRST, record_id) = 1"""
)
def dedup_alignments_cis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best alignment of each slice, favouring the chromosome of most of its read's."""
    best = fragments.by_alignment_score(_records(spark, sf_dir), _aligned(), favour_cis=True)
    return best.select("record_id", "chrom")
