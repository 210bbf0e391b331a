"""Interval joins, annotation and interval arithmetic over slices, viewpoints and restriction fragments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import intervals
from ..operators.matrix import chrom_sizes
from ..operators.slices import sql_clean
from .filter_queries import slices
from .registry import Registry
from .tables import table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped clean slices without the annotations that were delivered."""
    return slices(spark, sf_dir).where("mapped = 1").select("slice_id", "chrom", "start_pos", "end_pos")


def viewpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "viewpoints").withColumn("name", F.lower("name"))


def fragment_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "restriction_fragments")


def exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.exclusion_zones(viewpoints(spark, sf_dir), 1000, chrom_sizes(fragment_map(spark, sf_dir)))


SQL_PLACED = f"""{sql_clean()}, p AS (SELECT slice_id, chrom, start_pos AS s, end_pos AS e FROM s WHERE mapped = 1),
    v AS (SELECT chrom, start_pos AS s, end_pos AS e, lower(name) AS name FROM viewpoints),
    rf AS (SELECT chrom, start_pos AS s, end_pos AS e, name FROM restriction_fragments)"""
SQL_MERGED = """
    {out}0 AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {t}),
    {out}1 AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS cluster FROM {out}0),
    {out} AS (SELECT chrom, cluster, min(s) AS s, max(e) AS e, count(*) AS n FROM {out}1 GROUP BY chrom, cluster)"""
SQL_EXCLUSIONS = f"""
    size AS (SELECT chrom, max(e) AS size FROM rf GROUP BY chrom),
    grown AS (SELECT v.name, v.chrom, greatest(v.s - 1000, 0) AS s, least(v.e + 1000, coalesce(size, v.e + 1000)) AS e FROM v LEFT JOIN size ON size.chrom = v.chrom),
    {SQL_MERGED.format(out="mv", t="v")},
    edges AS (
        SELECT g.name, g.chrom, g.s AS gs, g.e AS ge, m.s AS ms, m.e AS me, row_number() OVER w AS k, lag(m.e) OVER w AS before, lead(m.s) OVER w AS after
        FROM grown g JOIN mv m ON m.chrom = g.chrom AND m.s < g.e AND g.s < m.e WINDOW w AS (PARTITION BY g.name ORDER BY m.s)),
    x AS (
        SELECT name, chrom, CASE WHEN before IS NULL THEN gs ELSE before END AS s, ms AS e FROM edges
        UNION ALL SELECT name, chrom, me, ge FROM edges WHERE after IS NULL),
    zones AS (SELECT name, chrom, s, e FROM x WHERE e > s)"""


def _sql_get(b: str, part: int) -> str:
    """name of each b that covers at least part / 100 of a slice; with a fan-out."""
    return f"""SELECT p.slice_id, h.name AS name FROM p LEFT JOIN (
        SELECT p.slice_id, b.name FROM p JOIN {b} b ON b.chrom = p.chrom AND b.s < p.e AND p.s < b.e
        WHERE (least(p.e, b.e) - greatest(p.s, b.s)) * 100 >= {part} * (p.e - p.s)) h ON h.slice_id = p.slice_id"""


@R.query(f"WITH {SQL_PLACED} {_sql_get('v', 75)}")
def annotate_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.annotate_get(placed(spark, sf_dir), "slice_id", viewpoints(spark, sf_dir), "name", 0.75).select("slice_id", "name")


@R.query(f"WITH {SQL_PLACED} {_sql_get('rf', 51)}")
def annotate_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The restriction fragment that holds most of each slice: a range join of two large sides."""
    return intervals.annotate_get(placed(spark, sf_dir), "slice_id", fragment_map(spark, sf_dir), "name", 0.51).select("slice_id", "name")


@R.query(
    f"""WITH {SQL_PLACED} SELECT p.slice_id, arg_min(b.name, (-(least(p.e, b.e) - greatest(p.s, b.s)), b.name)) AS name
    FROM p LEFT JOIN rf b ON b.chrom = p.chrom AND b.s < p.e AND p.s < b.e GROUP BY p.slice_id"""
)
def annotate_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.annotate_best(placed(spark, sf_dir), "slice_id", fragment_map(spark, sf_dir), "name").select("slice_id", "name")


@R.query(
    f"""WITH {SQL_PLACED}, g AS (SELECT chrom, greatest(s - 400, 0) AS s, e + 400 AS e, name FROM v), {SQL_MERGED.format(out="m", t="g")},
    n AS (SELECT p.slice_id, count(*) AS n FROM p JOIN g ON g.chrom = p.chrom AND g.s < p.e AND p.s < g.e GROUP BY 1),
    c AS (SELECT p.slice_id, sum(least(p.e, m.e) - greatest(p.s, m.s)) AS covered, any_value(p.e - p.s) AS length FROM p JOIN m ON m.chrom = p.chrom AND m.s < p.e AND p.s < m.e GROUP BY 1)
    SELECT p.slice_id, CAST(coalesce(CASE WHEN covered * 4 >= length * 3 THEN n END, 0) AS INTEGER) AS n
    FROM p LEFT JOIN n ON n.slice_id = p.slice_id LEFT JOIN c ON c.slice_id = p.slice_id"""
)
def annotate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many viewpoints, with their surroundings, overlap slices that these cover to three quarters."""
    b = intervals.slop(viewpoints(spark, sf_dir), 400)
    return intervals.annotate_count(placed(spark, sf_dir), "slice_id", b, "n", 0.75).select("slice_id", "n")


@R.query(
    f"""WITH {SQL_PLACED}, {SQL_EXCLUSIONS}, c AS ({_sql_get("v", 75)}), x2 AS (
        SELECT p.slice_id, z.name FROM p JOIN zones z ON z.chrom = p.chrom AND z.s < p.e AND p.s < z.e),
    n AS (SELECT p.slice_id, count(z.name) AS n FROM p LEFT JOIN zones z ON z.chrom = p.chrom AND z.s < p.e AND p.s < z.e GROUP BY 1)
    SELECT c.slice_id, c.name AS capture, x2.name AS exclusion, CAST(n.n AS INTEGER) AS exclusion_count
    FROM c LEFT JOIN x2 ON x2.slice_id = c.slice_id JOIN n ON n.slice_id = c.slice_id"""
)
def annotate_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture, exclusion and number of exclusions in one go."""
    v, x = viewpoints(spark, sf_dir), exclusions(spark, sf_dir)
    specs = [
        {"action": "get", "b": v, "name": "capture", "fraction": 0.75},
        {"action": "get", "b": x, "name": "exclusion", "fraction": 1e-9},
        {"action": "count", "b": x, "name": "exclusion_count", "fraction": 1e-9},
    ]
    return intervals.annotate_many(placed(spark, sf_dir), "slice_id", specs).select("slice_id", "capture", "exclusion", "exclusion_count")


@R.query(f"WITH {SQL_PLACED} SELECT slice_id, CAST(NULL AS VARCHAR) AS name FROM p")
def annotate_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing to annotate with: every slice stays, with NULL."""
    none = viewpoints(spark, sf_dir).withColumn("end_pos", F.col("start_pos"))
    return intervals.annotate_get(placed(spark, sf_dir), "slice_id", none, "name").select("slice_id", "name")


@R.query(f"WITH {SQL_PLACED}, {SQL_EXCLUSIONS} SELECT name, chrom, s AS start_pos, e AS end_pos FROM zones")
def exclusion_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exclusions(spark, sf_dir).select("name", "chrom", "start_pos", "end_pos")


@R.query(f"WITH {SQL_PLACED}, {SQL_MERGED.format(out='m', t='p')} SELECT chrom, s AS start_pos, e AS end_pos FROM m")
def merge_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.merge_intervals(placed(spark, sf_dir))


@R.query(f"WITH {SQL_PLACED}, {SQL_MERGED.format(out='m', t='p')} SELECT chrom, s AS start_pos, e AS end_pos, n FROM m")
def cluster_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = intervals.cluster_intervals(placed(spark, sf_dir)).groupBy("chrom", "cluster")
    return runs.agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.count(F.lit(1)).alias("n")).drop("cluster")


@R.query(
    f"""WITH {SQL_PLACED}, bl AS (SELECT chrom, s, e FROM rf WHERE name % 7 = 0) SELECT slice_id FROM p
    WHERE NOT EXISTS (SELECT 1 FROM bl WHERE bl.chrom = p.chrom AND bl.s < p.e AND p.s < bl.e)"""
)
def outside_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices that no interval of a blacklist (here every seventh restriction fragment) touches."""
    bad = fragment_map(spark, sf_dir).where("name % 7 = 0")
    p = placed(spark, sf_dir)
    hit = intervals.overlaps(p, bad.select("chrom", "start_pos", "end_pos")).select("slice_id")
    return p.join(hit, "slice_id", "left_anti").select("slice_id")


@R.query(
    f"""WITH {SQL_PLACED} SELECT rf.chrom, rf.s AS start_pos, rf.e AS end_pos, rf.name AS fragment, v.name AS viewpoint
    FROM rf JOIN v ON v.chrom = rf.chrom AND v.s < rf.e AND rf.s < v.e"""
)
def baitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restriction fragments with the viewpoints that they hold."""
    hit = intervals.overlaps(fragment_map(spark, sf_dir), viewpoints(spark, sf_dir))
    return hit.select("chrom", "start_pos", "end_pos", F.col("name").alias("fragment"), F.col("b_name").alias("viewpoint"))


@R.query(
    f"""WITH {SQL_PLACED} SELECT v.name AS viewpoint, count(rf.name) AS n_fragments,
        count(CASE WHEN (least(v.e, rf.e) - greatest(v.s, rf.s)) * 100 >= 51 * (v.e - v.s) THEN 1 END) = 1 AS one_holds_most
    FROM v LEFT JOIN rf ON v.chrom = rf.chrom AND v.s < rf.e AND rf.s < v.e GROUP BY v.name"""
)
def fragments_per_viewpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many restriction fragments each viewpoint touches, and whether one holds most of it."""
    v = viewpoints(spark, sf_dir)
    hit = intervals.overlaps(v, fragment_map(spark, sf_dir))
    most = intervals.at_least(F.col("overlap"), F.col("end_pos") - F.col("start_pos"), 0.51)
    n = hit.groupBy("name").agg(F.count(F.lit(1)).alias("n_fragments"), (F.count_if(most) == 1).alias("one_holds_most"))
    out = v.select("name").join(n, "name", "left")
    return out.select(F.col("name").alias("viewpoint"), F.coalesce("n_fragments", F.lit(0)).alias("n_fragments"), F.coalesce("one_holds_most", F.lit(False)).alias("one_holds_most"))


@R.query(
    f"""WITH {SQL_PLACED} SELECT p.slice_id, v.name AS viewpoint, least(p.e, v.e) - greatest(p.s, v.s) AS overlap
    FROM p JOIN v ON v.chrom = p.chrom AND v.s < p.e AND p.s < v.e"""
)
def interval_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping pairs with the length that they share."""
    hit = intervals.overlaps(placed(spark, sf_dir), viewpoints(spark, sf_dir))
    return hit.select("slice_id", F.col("b_name").alias("viewpoint"), "overlap")


@R.query(f"WITH {SQL_PLACED} SELECT chrom, count(*) AS n, min(s) AS first_start, max(e) AS last_end, CAST(sum(e - s) AS BIGINT) AS bases FROM p GROUP BY chrom")
def intervals_by_chrom(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = placed(spark, sf_dir)
    return p.groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.min("start_pos").alias("first_start"), F.max("end_pos").alias("last_end"), F.sum(F.col("end_pos") - F.col("start_pos")).alias("bases"))
