"""Queries over the operators for training data that belong to the core: files and skewed keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import is_missing, plain, sql_missing, sql_plain
from ..operators.compaction import compact
from ..operators.tree_aggregate import counting, greatest, least, summing, tree_aggregate
from .tables import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the regrouped files, read from what was published."""
    done = compact(table(spark, sf_dir, "slice_files"))
    return spark.read.parquet(done.data).select("parent_id", "slice")


def p3_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verified manifest: one row for each regrouped file."""
    return spark.read.parquet(compact(table(spark, sf_dir, "slice_files")).manifest)


def p3_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by the manifest, in the files, and different ones in the files: the same number three times."""
    done = compact(table(spark, sf_dir, "slice_files"))
    listed = spark.read.parquet(done.manifest).agg(F.coalesce(F.sum("n_records"), F.lit(0)).alias("n_listed"))
    held = spark.read.parquet(done.data).agg(F.count(F.lit(1)).alias("n_held"), F.countDistinct("parent_id", "slice").alias("n_different"))
    return listed.join(held)  # one row each


def _captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captured rows of both tables, with what the statistics per capture need."""

    def one(name: str) -> DataFrame:
        t = table(spark, sf_dir, name).where(~is_missing(F.col("capture")))
        start, end = F.col("start_pos").try_cast("bigint"), F.col("end_pos").try_cast("bigint")
        return t.select(
            F.lit(name).alias("table_name"), "bam", plain(F.col("capture")).alias("capture"),
            F.col("mapped").try_cast("bigint").alias("mapped"), start.alias("start_pos"), (end - start).alias("length"),
        )

    return one("slices").unionByName(one("test_slices_to_filter_capture"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures that hold at least an eighth of the captured rows of a bam, in either table."""
    n = tree_aggregate(_captured(spark, sf_dir), ["table_name", "bam", "capture"], {"n": counting()})
    # one row per capture is left here: small against the input, by as much as captures repeat
    total = F.sum("n").over(Window.partitionBy("table_name", "bam"))
    return n.withColumn("total", total).where("8 * n >= total").select("table_name", "bam", "capture")


def p4_capture_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, mapped rows, covered bases and smallest start for each capture of each table and bam."""
    states = {
        "n_rows": counting(), "n_mapped": summing(F.col("mapped")),
        "bases": summing(F.col("length")), "first_start": least(F.when(F.col("mapped") == 1, F.col("start_pos"))), "longest": greatest(F.col("length")),
    }
    return tree_aggregate(_captured(spark, sf_dir), ["table_name", "bam", "capture"], states)


def queries() -> dict:
    return {f.__name__: f for f in (p3_found, p3_manifest, p3_totals, p4_found, p4_capture_stats)}


def oracle_sql() -> dict[str, str]:
    captured = " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, bam, {sql_plain("capture")} AS capture, CAST(mapped AS BIGINT) AS mapped,
        TRY_CAST(start_pos AS BIGINT) AS start_pos, TRY_CAST(end_pos AS BIGINT) - TRY_CAST(start_pos AS BIGINT) AS length
        FROM {t} WHERE NOT {sql_missing("capture")}"""
        for t in ("slices", "test_slices_to_filter_capture")
    )
    records = r"""lines AS (SELECT unnest(regexp_split_to_array(body, '\r\n|\n|\r')) AS line FROM slice_files),
            fields AS (SELECT string_split(line, chr(9)) AS f FROM lines),
            records AS (
                SELECT TRY_CAST(trim(f[1]) AS HUGEINT) AS p, TRY_CAST(trim(f[2]) AS INTEGER) AS slice FROM fields
                WHERE len(f) = 5 AND regexp_full_match(trim(f[1]), '[+-]?[0-9]+')),
            once AS (
                SELECT DISTINCT CAST(CASE WHEN p >= 9223372036854775808 THEN p - 18446744073709551616 ELSE p END AS BIGINT) AS parent_id, slice
                FROM records WHERE p IS NOT NULL AND slice IS NOT NULL)"""
    return {
        "p3_found": f"WITH {records} SELECT parent_id, slice FROM once",
        "p3_totals": f"WITH {records} SELECT count(*) AS n_listed, count(*) AS n_held, count(*) AS n_different FROM once",
        "p4_found": f"""
            WITH captured AS ({captured}),
            n AS (SELECT table_name, bam, capture, count(*) AS n FROM captured GROUP BY ALL)
            SELECT table_name, bam, capture FROM (SELECT *, sum(n) OVER (PARTITION BY table_name, bam) AS total FROM n) WHERE 8 * n >= total""",
        "p4_capture_stats": f"""
            WITH captured AS ({captured})
            SELECT table_name, bam, capture, count(*) AS n_rows, CAST(sum(mapped) AS BIGINT) AS n_mapped, CAST(sum(length) AS BIGINT) AS bases,
                min(CASE WHEN mapped = 1 THEN start_pos END) AS first_start, max(length) AS longest
            FROM captured GROUP BY ALL""",
    }
