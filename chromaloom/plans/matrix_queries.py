"""Counting, binning, merging, profiles and comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_missing, plain, sql_missing, sql_plain
from ..operators import matrix, pileup
from ..operators.slices import sql_clean
from ..session import scratch_path, settled
from .filter_queries import slices
from .registry import Registry
from .tables import table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql
WIDTH = 10_000

SQL_W = f"""{sql_clean()},
    w0 AS (SELECT * FROM s WHERE mapped = 1 AND restriction_fragment IS NOT NULL),
    w AS (SELECT *, max(capture) OVER f AS viewpoint, restriction_fragment AS rf FROM w0 WINDOW f AS (PARTITION BY parent_id) QUALIFY min(capture) OVER f = max(capture) OVER f),
    b AS (SELECT name AS bin_id, chrom, start_pos AS s, end_pos AS e FROM restriction_fragments),
    v AS (SELECT lower(name) AS viewpoint, chrom, start_pos AS s, end_pos AS e FROM viewpoints)"""
SQL_PX = f"""{SQL_W}, d AS (SELECT DISTINCT parent_id, bam AS sample, viewpoint, rf FROM w),
    px AS (SELECT x.sample, x.viewpoint, x.rf AS bin1_id, y.rf AS bin2_id, count(*) AS n FROM d x
        JOIN d y ON y.parent_id = x.parent_id AND y.sample = x.sample AND y.viewpoint = x.viewpoint AND x.rf < y.rf GROUP BY ALL),
    own AS (SELECT DISTINCT v.viewpoint, b.bin_id FROM v JOIN b ON b.chrom = v.chrom AND b.s < v.e AND v.s < b.e)"""
SQL_TOTALS = f"""{SQL_PX}, totals AS (
    SELECT px.sample, px.viewpoint, CAST(coalesce(sum(CASE WHEN (b1.chrom = v.chrom AND o1.bin_id IS NULL) OR (b2.chrom = v.chrom AND o2.bin_id IS NULL) THEN n END), 0) AS BIGINT) AS n_cis,
        CAST(sum(n) AS BIGINT) AS n_total
    FROM px JOIN v ON v.viewpoint = px.viewpoint JOIN b b1 ON b1.bin_id = bin1_id JOIN b b2 ON b2.bin_id = bin2_id
    LEFT JOIN own o1 ON o1.viewpoint = px.viewpoint AND o1.bin_id = bin1_id LEFT JOIN own o2 ON o2.viewpoint = px.viewpoint AND o2.bin_id = bin2_id GROUP BY 1, 2)"""


def bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "restriction_fragments").withColumnRenamed("name", "bin_id")


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped slices on restriction fragments, of reads with one capture, with their viewpoint."""
    return matrix.with_viewpoint(slices(spark, sf_dir).where("mapped = 1 AND restriction_fragment IS NOT NULL"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.count_pixels(contacts(spark, sf_dir))


def viewpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "viewpoints")


def own_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.viewpoint_bins(viewpoints(spark, sf_dir), bins(spark, sf_dir))


@R.query(f"WITH {SQL_PX} SELECT * FROM px")
def count_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels(spark, sf_dir)


@R.query(
    f"""WITH {SQL_W}, d AS (SELECT DISTINCT parent_id, bam AS sample, viewpoint, rf FROM w WHERE capture_count = 0 AND exclusion IS NULL OR capture_count = 0 AND exclusion <> viewpoint)
    SELECT x.sample, x.viewpoint, x.rf AS bin1_id, y.rf AS bin2_id, count(*) AS n FROM d x
    JOIN d y ON y.parent_id = x.parent_id AND y.sample = x.sample AND y.viewpoint = x.viewpoint AND x.rf < y.rf GROUP BY ALL"""
)
def count_pixels_reporters_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.count_pixels(contacts(spark, sf_dir), remove_viewpoint=True, remove_exclusions=True)


@R.query(
    f"""WITH {SQL_W}, d AS (SELECT DISTINCT parent_id, bam AS sample, viewpoint, rf FROM w)
    SELECT x.sample, x.viewpoint, x.rf AS bin1_id, y.rf AS bin2_id, count(*) AS n FROM d x
    JOIN d y ON y.parent_id = x.parent_id AND y.sample = x.sample AND y.viewpoint = x.viewpoint AND x.rf <= y.rf GROUP BY ALL"""
)
def count_pixels_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the diagonal."""
    return matrix.count_pixels(contacts(spark, sf_dir), within=True)


@R.query(
    f"""WITH {SQL_W}, d AS (SELECT DISTINCT parent_id, bam AS sample, viewpoint, rf FROM w WHERE CAST('0x' || substr(md5('7|' || parent_id), 1, 7) AS BIGINT) < {1 << 27})
    SELECT x.sample, x.viewpoint, x.rf AS bin1_id, y.rf AS bin2_id, count(*) AS n FROM d x
    JOIN d y ON y.parent_id = x.parent_id AND y.sample = x.sample AND y.viewpoint = x.viewpoint AND x.rf < y.rf GROUP BY ALL"""
)
def count_pixels_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the reads, chosen by a hash: the sampling operator itself."""
    return matrix.count_pixels(contacts(spark, sf_dir), subsample=0.5, seed=7)


@R.query(f"WITH {SQL_PX} SELECT DISTINCT v.viewpoint, b.bin_id, b.chrom FROM v JOIN b ON b.chrom = v.chrom AND b.s < v.e AND v.s < b.e")
def viewpoint_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return own_bins(spark, sf_dir)


@R.query(f"WITH {SQL_TOTALS} SELECT * FROM totals")
def n_cis_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.interaction_totals(pixels(spark, sf_dir), viewpoints(spark, sf_dir), bins(spark, sf_dir))


@R.query(f"WITH {SQL_PX} SELECT sample, viewpoint, bin1_id, bin2_id, 2 * n AS n FROM px")
def merge_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store merged with itself doubles."""
    px = pixels(spark, sf_dir)
    return matrix.merge_pixels([px, px])


@R.query(
    f"""WITH {SQL_TOTALS}, o AS (SELECT viewpoint, list_sort(list(bin_id)) AS bins FROM own GROUP BY 1)
    SELECT sample, t.viewpoint, t.viewpoint AS name, bins, 2 * n_cis AS n_cis, 2 * n_total AS n_total FROM totals t JOIN o ON o.viewpoint = t.viewpoint"""
)
def merge_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = matrix.interaction_totals(pixels(spark, sf_dir), viewpoints(spark, sf_dir), bins(spark, sf_dir))
    listed = own_bins(spark, sf_dir).groupBy("viewpoint").agg(F.sort_array(F.collect_set("bin_id")).alias("bins"))
    rows = totals.join(listed, "viewpoint").withColumn("name", F.col("viewpoint"))
    both = rows.withColumn("source", F.lit(1)).unionByName(rows.withColumn("source", F.lit(2)))
    return matrix.merge_metadata(both)


@R.query(f"WITH {SQL_PX} SELECT sample, viewpoint, bin1_id, bin2_id, n FROM px")
def store_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels through a store: written by viewpoint, read again."""
    path = scratch_path(spark, "store")
    matrix.write_store(pixels(spark, sf_dir), path)
    return matrix.read_store(spark, path).select("sample", "viewpoint", "bin1_id", "bin2_id", "n")


SQL_BINS = f"""
    size AS (SELECT chrom, max(e) AS size FROM b GROUP BY chrom),
    gb0 AS (SELECT chrom, size, unnest(range(0, size, {WIDTH})) AS s FROM size),
    gb AS (SELECT row_number() OVER (ORDER BY chrom, s) - 1 AS bin_id, chrom, s, least(s + {WIDTH}, size) AS e FROM gb0),
    mid AS (SELECT b.bin_id AS fragment_id, gb.bin_id FROM b JOIN gb ON gb.chrom = b.chrom AND (b.s + b.e) // 2 >= gb.s AND (b.s + b.e) // 2 < gb.s + {WIDTH})"""


def genome_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.fixed_bins(matrix.chrom_sizes(bins(spark, sf_dir)), WIDTH)


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.bins_by_midpoint(bins(spark, sf_dir), genome_bins(spark, sf_dir), WIDTH)


@R.query(f"WITH {SQL_W}, {SQL_BINS} SELECT bin_id, chrom, s AS start_pos, e AS end_pos FROM gb")
def fixed_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genome_bins(spark, sf_dir)


@R.query(f"WITH {SQL_W}, {SQL_BINS} SELECT fragment_id, bin_id FROM mid")
def bin_midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping(spark, sf_dir)


@R.query(
    f"""WITH {SQL_W}, {SQL_BINS} SELECT b.bin_id AS fragment_id, gb.bin_id FROM b JOIN gb ON gb.chrom = b.chrom AND b.s < gb.e AND gb.s < b.e
    WHERE (least(b.e, gb.e) - greatest(b.s, gb.s)) * 100 >= 51 * (b.e - b.s)"""
)
def bin_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.bins_by_overlap(bins(spark, sf_dir), genome_bins(spark, sf_dir))


SQL_RB = f"""{SQL_TOTALS}, {SQL_BINS}, rb AS (
    SELECT sample, viewpoint, least(x.bin_id, y.bin_id) AS bin1_id, greatest(x.bin_id, y.bin_id) AS bin2_id, CAST(sum(n) AS BIGINT) AS n
    FROM px JOIN mid x ON x.fragment_id = bin1_id JOIN mid y ON y.fragment_id = bin2_id GROUP BY 1, 2, 3, 4)"""


@R.query(f"WITH {SQL_RB} SELECT * FROM rb")
def bin_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.rebin(pixels(spark, sf_dir), mapping(spark, sf_dir))


@R.query(
    f"""WITH {SQL_RB}, k AS (SELECT bin_id, count(DISTINCT fragment_id) AS k FROM mid GROUP BY 1)
    SELECT rb.sample, rb.viewpoint, bin1_id, bin2_id, n, round(n / (k1.k + k2.k)::DOUBLE, 6) AS n_rf_norm,
        round(CASE WHEN n_cis > 0 THEN n * (1e6 / n_cis) END, 4) AS n_cis_norm, round(CASE WHEN n_cis > 0 THEN n / (k1.k + k2.k)::DOUBLE * (1e6 / n_cis) END, 4) AS n_cis_rf_norm
    FROM rb JOIN k k1 ON k1.bin_id = bin1_id JOIN k k2 ON k2.bin_id = bin2_id JOIN totals t ON t.sample = rb.sample AND t.viewpoint = rb.viewpoint"""
)
def bin_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = settled(pixels(spark, sf_dir), "pixels")  # read twice below
    to = mapping(spark, sf_dir)
    totals = matrix.interaction_totals(px, viewpoints(spark, sf_dir), bins(spark, sf_dir))
    out = matrix.normalise(matrix.rebin(px, to), to, totals)
    return out.withColumns({c: F.round(c, d) for c, d in (("n_rf_norm", 6), ("n_cis_norm", 4), ("n_cis_rf_norm", 4))})


@R.query(
    f"""WITH {SQL_PX}, g AS (SELECT DISTINCT bin1_id, bin2_id, viewpoint FROM px), k AS (SELECT count(DISTINCT bam) AS k FROM slices)
    SELECT viewpoint, bin1_id, bin2_id, round(sum(n) / any_value(k)::DOUBLE, 6) AS value FROM px, k GROUP BY 1, 2, 3"""
)
def matrix_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean over all samples, those without a pixel too."""
    k = table(spark, sf_dir, "slices").select("bam").distinct().count()
    return matrix.average_matrices(pixels(spark, sf_dir), k, "mean").withColumn("value", F.round("value", 6))


@R.query(f"WITH {SQL_PX} SELECT viewpoint, bin1_id, bin2_id, CAST(sum(n) AS DOUBLE) AS value FROM px GROUP BY 1, 2, 3")
def matrix_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.average_matrices(pixels(spark, sf_dir), 1, "sum")


@R.query(
    f"""WITH {SQL_PX}, k AS (SELECT DISTINCT bam AS sample FROM slices), g AS (SELECT DISTINCT viewpoint, bin1_id, bin2_id FROM px)
    SELECT g.viewpoint, g.bin1_id, g.bin2_id, median(coalesce(n, 0))::DOUBLE AS value FROM g CROSS JOIN k
    LEFT JOIN px ON px.viewpoint = g.viewpoint AND px.bin1_id = g.bin1_id AND px.bin2_id = g.bin2_id AND px.sample = k.sample GROUP BY 1, 2, 3"""
)
def matrix_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = table(spark, sf_dir, "slices").select("bam").distinct().count()
    return matrix.average_matrices(pixels(spark, sf_dir), k, "median")


@R.query(
    f"""WITH {SQL_PX}, r AS (SELECT bin_id FROM b WHERE chrom = 'chr7' AND s >= 600000 AND s < 660000),
    sq AS (SELECT x.bin_id AS bin1_id, y.bin_id AS bin2_id FROM r x CROSS JOIN r y), t AS (SELECT bin1_id, bin2_id, sum(n) AS n FROM px GROUP BY 1, 2)
    SELECT sq.bin1_id, sq.bin2_id, CAST(coalesce(t.n, u.n, 0) AS BIGINT) AS n FROM sq LEFT JOIN t ON t.bin1_id = sq.bin1_id AND t.bin2_id = sq.bin2_id
    LEFT JOIN t u ON u.bin1_id = sq.bin2_id AND u.bin2_id = sq.bin1_id"""
)
def matrix_dense_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region of the summed matrix in full."""
    region = bins(spark, sf_dir).where("chrom = 'chr7' AND start_pos >= 600000 AND start_pos < 660000").select("bin_id")
    return matrix.dense_region(pixels(spark, sf_dir), region)


@R.query(
    f"""WITH {SQL_PX}, r AS (SELECT bin_id FROM b WHERE chrom = 'chr7' AND s >= 600000 AND s < 660000),
    t AS (SELECT bin1_id, bin2_id, sum(n) AS n FROM px GROUP BY 1, 2)
    SELECT round(quantile_cont(coalesce(t.n, 0), 0.98), 6)::DOUBLE AS p98 FROM r x CROSS JOIN r y LEFT JOIN t ON t.bin1_id = x.bin_id AND t.bin2_id = y.bin_id WHERE x.bin_id < y.bin_id"""
)
def matrix_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 98th percentile of a region's upper triangle, zeros included."""
    return matrix_dense_region(spark, sf_dir).where("bin1_id < bin2_id").agg(F.round(F.percentile("n", F.lit(0.98)), 6).alias("p98"))


def _sql_rounds(rounds: int) -> str:
    """Rounds of balancing of rb, without a test of how far it came: v0, v1, ..."""
    steps = ["v0 AS (SELECT sample, viewpoint, bin1_id AS i, bin2_id AS j, n::DOUBLE AS v FROM rb)"]
    for k in range(rounds + 1):
        steps.append(f"be{k} AS (SELECT sample, viewpoint, i AS b, v FROM v{k} UNION ALL SELECT sample, viewpoint, j, v FROM v{k} WHERE i <> j)")
        steps.append(f"bs{k} AS (SELECT sample, viewpoint, b, sum(v) AS s FROM be{k} GROUP BY ALL)")
        steps.append(f"bm{k} AS (SELECT sample, viewpoint, avg(s) AS m, max(abs(s / mean - 1)) AS deviation FROM (SELECT *, avg(s) OVER (PARTITION BY sample, viewpoint) AS mean FROM bs{k}) GROUP BY ALL)")
        root = "" if k == rounds else " / (sqrt(x.s / m.m) * sqrt(y.s / m.m))"
        steps.append(
            f"""v{k + 1} AS MATERIALIZED (SELECT v.sample, v.viewpoint, i, j, v * (f.m / m.m){root} AS v FROM v{k} v JOIN bm{k} m ON m.sample = v.sample AND m.viewpoint = v.viewpoint
            JOIN bm0 f ON f.sample = v.sample AND f.viewpoint = v.viewpoint JOIN bs{k} x ON x.sample = v.sample AND x.viewpoint = v.viewpoint AND x.b = i
            JOIN bs{k} y ON y.sample = v.sample AND y.viewpoint = v.viewpoint AND y.b = j)"""
        )
    return ",\n".join(steps)


@R.query(f"WITH {SQL_RB}, {_sql_rounds(4)} SELECT v.sample, v.viewpoint, i AS bin1_id, j AS bin2_id, round(v, 4) AS balanced, round(bm4.deviation, 4) AS deviation FROM v5 v JOIN bm4 ON bm4.sample = v.sample AND bm4.viewpoint = v.viewpoint")
def ice_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four rounds of balancing, whatever they reach: what ice_balance repeats until bins' sums are equal."""
    binned = matrix.rebin(pixels(spark, sf_dir), mapping(spark, sf_dir))
    return matrix.balance(binned, 4, tolerance=0.0).select("sample", "viewpoint", "bin1_id", "bin2_id", F.round("balanced", 4).alias("balanced"), F.round("deviation", 4).alias("deviation"))


@R.query(
    f"""WITH {SQL_RB}, {_sql_rounds(4)} SELECT v.sample, v.viewpoint, i AS bin1_id, j AS bin2_id, round(CASE WHEN n_cis > 0 THEN v / n_cis * 1e6 END, 3) AS balanced
    FROM v5 v JOIN totals t ON t.sample = v.sample AND t.viewpoint = v.viewpoint"""
)
def ice_rounds_n_cis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for each million cis interactions."""
    px = settled(pixels(spark, sf_dir), "pixels")
    totals = matrix.interaction_totals(px, viewpoints(spark, sf_dir), bins(spark, sf_dir))
    out = matrix.balance_per_cis(matrix.rebin(px, mapping(spark, sf_dir)), totals, iterations=4, tolerance=0.0)
    return out.select("sample", "viewpoint", "bin1_id", "bin2_id", F.round("balanced", 3).alias("balanced"))


@R.query(f"WITH {SQL_RB}, {_sql_rounds(4)} SELECT v.sample, v.viewpoint, i AS bin1_id, j AS bin2_id, round(v / 2.5, 4) AS balanced FROM v5 v")
def ice_rounds_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same divided by a factor."""
    out = matrix.balance_by_factor(matrix.rebin(pixels(spark, sf_dir), mapping(spark, sf_dir)), 2.5, iterations=4, tolerance=0.0)
    return out.select("sample", "viewpoint", "bin1_id", "bin2_id", F.round("balanced", 4).alias("balanced"))


@R.query(
    f"""WITH {SQL_PX} SELECT sample, px.viewpoint, bin1_id, bin2_id, n FROM px
    WHERE NOT EXISTS (SELECT 1 FROM own WHERE own.viewpoint = px.viewpoint AND own.bin_id IN (px.bin1_id, px.bin2_id))"""
)
def pixels_without_viewpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.without_viewpoint(pixels(spark, sf_dir), own_bins(spark, sf_dir)).select("sample", "viewpoint", "bin1_id", "bin2_id", "n")


@R.query()
def ice_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced matrices of every sample and viewpoint at 10 kb."""
    binned = matrix.rebin(pixels(spark, sf_dir), mapping(spark, sf_dir))
    return matrix.balance(binned)


# Profiles

SQL_BG = f"""{SQL_TOTALS},
    sides AS (
        SELECT px.sample, px.viewpoint, bin1_id AS capture, bin2_id AS reporter, n FROM px JOIN own ON own.viewpoint = px.viewpoint AND own.bin_id = bin1_id
        UNION ALL SELECT px.sample, px.viewpoint, CASE WHEN o.bin_id IS NULL THEN bin2_id ELSE bin1_id END, CASE WHEN o.bin_id IS NULL THEN bin1_id ELSE bin2_id END, n
        FROM px JOIN own ON own.viewpoint = px.viewpoint AND own.bin_id = bin2_id LEFT JOIN own o ON o.viewpoint = px.viewpoint AND o.bin_id = bin1_id),
    bg AS (SELECT sample, viewpoint, chrom, s, e, CAST(sum(n) AS BIGINT) AS n FROM sides JOIN b ON b.bin_id = reporter GROUP BY ALL)"""


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.reporters(pixels(spark, sf_dir), own_bins(spark, sf_dir))


def track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.bedgraph(found(spark, sf_dir), bins(spark, sf_dir))


@R.query(f"WITH {SQL_BG} SELECT * FROM sides")
def reporters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark, sf_dir)


@R.query(f"WITH {SQL_BG} SELECT sample, viewpoint, chrom, s AS start_pos, e AS end_pos, n FROM bg")
def bedgraph_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return track(spark, sf_dir)


def _first(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    sample = table(spark, sf_dir, "slices").agg(F.min("bam")).first()[0]
    return sample, viewpoints(spark, sf_dir).agg(F.min(F.lower("name"))).first()[0]


@R.query(
    f"""WITH {SQL_BG} SELECT chrom, s AS start_pos, e AS end_pos, CAST(coalesce((SELECT sum(n) FROM sides
        WHERE reporter = bin_id AND sample = (SELECT min(bam) FROM slices) AND viewpoint = (SELECT min(lower(name)) FROM viewpoints)), 0) AS BIGINT) AS n FROM b"""
)
def bedgraph_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.bedgraph_dense(found(spark, sf_dir), bins(spark, sf_dir), *_first(spark, sf_dir))


@R.query(
    f"""WITH {SQL_BG}, r AS (SELECT *, max(e) OVER (PARTITION BY sample, viewpoint, chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM bg),
    k AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY sample, viewpoint, chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM r)
    SELECT sample, viewpoint, chrom, min(s) AS start_pos, max(e) AS end_pos, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY sample, viewpoint, chrom, k"""
)
def bedgraph_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.bedgraph_clustered(track(spark, sf_dir))


@R.query(
    f"""WITH {SQL_BG} SELECT bg.sample, bg.viewpoint, chrom, s AS start_pos, e AS end_pos, round(CASE WHEN n_cis > 0 THEN n / n_cis::DOUBLE * 1e6 END, 4) AS n
    FROM bg JOIN totals t ON t.sample = bg.sample AND t.viewpoint = bg.viewpoint"""
)
def bedgraph_n_cis(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = settled(pixels(spark, sf_dir), "pixels")
    totals = matrix.interaction_totals(px, viewpoints(spark, sf_dir), bins(spark, sf_dir))
    plain_track = pileup.bedgraph(pileup.reporters(px, own_bins(spark, sf_dir)), bins(spark, sf_dir))
    return pileup.normalise_cis(plain_track, totals).withColumn("n", F.round("n", 4))


@R.query(
    f"""WITH {SQL_BG}, t AS (SELECT bg.sample, bg.viewpoint, sum(n) AS total FROM bg JOIN v ON v.viewpoint = bg.viewpoint AND v.chrom = bg.chrom AND bg.s BETWEEN v.s - 50000 AND v.e + 50000 GROUP BY 1, 2)
    SELECT bg.sample, bg.viewpoint, chrom, s AS start_pos, e AS end_pos, round(n / total::DOUBLE * 1e6, 4) AS n FROM bg JOIN t ON t.sample = bg.sample AND t.viewpoint = bg.viewpoint"""
)
def bedgraph_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = viewpoints(spark, sf_dir)
    regions = v.select(F.lower("name").alias("viewpoint"), "chrom", (F.col("start_pos") - 50_000).alias("start_pos"), (F.col("end_pos") + 50_000).alias("end_pos"))
    return pileup.normalise_regions(settled(track(spark, sf_dir), "track"), regions).withColumn("n", F.round("n", 4))


@R.query(
    f"""WITH {SQL_BG} SELECT sample, bg.viewpoint, bg.chrom, bg.s AS start_pos, bg.e AS end_pos, n
    FROM bg JOIN v ON v.viewpoint = bg.viewpoint AND v.chrom = bg.chrom AND bg.s < v.e + 20000 AND bg.e > v.s - 20000"""
)
def bedgraph_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.near_viewpoint(track(spark, sf_dir), viewpoints(spark, sf_dir), 20_000)


@R.query(f"WITH {SQL_BG} SELECT sample, viewpoint, chrom, s AS start_pos, e AS end_pos, n FROM bg WHERE chrom = 'chr7' AND s < 700000 AND e > 600000")
def bedgraph_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.within(track(spark, sf_dir), "chr7", 600_000, 700_000)


@R.query(
    f"""WITH {SQL_BG}, {SQL_BINS} SELECT sample, viewpoint, gb.chrom, gb.s AS start_pos, gb.e AS end_pos, round(sum(n * (least(bg.e, gb.e) - greatest(bg.s, gb.s)) / (bg.e - bg.s)::DOUBLE), 4) AS n
    FROM bg JOIN gb ON gb.chrom = bg.chrom AND bg.s < gb.e AND gb.s < bg.e GROUP BY 1, 2, 3, 4, 5"""
)
def bedgraph_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.windowed(track(spark, sf_dir), genome_bins(spark, sf_dir)).withColumn("n", F.round("n", 4))


@R.query(
    f"""WITH {SQL_BG} SELECT sample, viewpoint, chrom, s AS start_pos, e AS end_pos,
    round(avg(n) OVER (PARTITION BY sample, viewpoint, chrom ORDER BY s ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS n FROM bg"""
)
def bedgraph_smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.smoothed(track(spark, sf_dir)).withColumn("n", F.round("n", 6))


@R.query(
    f"""WITH {SQL_BG}, i AS (SELECT *, row_number() OVER (PARTITION BY sample, viewpoint, chrom ORDER BY s, e) - 1 AS i FROM bg)
    SELECT sample, viewpoint, chrom, s AS start_pos, e AS end_pos, n FROM i WHERE i % 3 = 0"""
)
def bedgraph_every_third(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.every_nth(track(spark, sf_dir), 3)


@R.query(
    f"""WITH {SQL_BG}, two AS (SELECT sample, viewpoint, chrom, s, e, n * 2 + n AS n FROM bg)
    SELECT sample, viewpoint, chrom, s AS start_pos, e AS end_pos, CAST(n AS DOUBLE) AS n FROM two"""
)
def bedgraph_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile doubled, and added to itself."""
    t = settled(track(spark, sf_dir), "track")
    return pileup.arithmetic(pileup.arithmetic(t, 2, "*"), t, "+")


@R.query(
    f"""WITH {SQL_BG}, two AS (SELECT sample, viewpoint, chrom, s, e, n::DOUBLE AS a, CASE WHEN s % 2 = 0 THEN n + 1.0 ELSE 0.0 END AS b FROM bg)
    SELECT sample, viewpoint, chrom, s AS start_pos, e AS end_pos, unnest(['+', '-', '*', '/']) AS operation, round(unnest([a + b, a - b, a * b, CASE WHEN b <> 0 THEN a / b END]), 6) AS n FROM two"""
)
def bedgraph_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every operation with a profile that lacks some places."""
    t = settled(track(spark, sf_dir), "track")
    other = t.where("start_pos % 2 = 0").withColumn("n", F.col("n") + 1)
    each = [pileup.arithmetic(t, other, o).withColumn("operation", F.lit(o)) for o in "+-*/"]
    return reduce(DataFrame.unionByName, each).withColumn("n", F.round("n", 6))


# Comparisons between conditions

SQL_DESIGN = f"""design AS (SELECT bam AS sample, coalesce(min(CASE WHEN NOT {sql_missing("condition_label")} THEN {sql_plain("condition_label")} END), 'none') AS condition FROM design_matrix GROUP BY bam),
    k AS (SELECT condition, count(*) AS k FROM design GROUP BY condition)"""
SQL_MEANS = f"""{SQL_BG}, {SQL_DESIGN}, means AS (
    SELECT viewpoint, chrom, s, e, d.condition, sum(n) / any_value(k)::DOUBLE AS mean FROM bg JOIN design d ON d.sample = bg.sample JOIN k ON k.condition = d.condition GROUP BY 1, 2, 3, 4, 5)"""


def design(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample, condition; a library that is listed twice counts once, one without a condition has 'none'."""
    label = F.when(~is_missing(F.col("condition_label")), plain(F.col("condition_label")))
    return table(spark, sf_dir, "design_matrix").groupBy(F.col("bam").alias("sample")).agg(F.coalesce(F.min(label), F.lit("none")).alias("condition"))


@R.query(f"WITH {SQL_MEANS} SELECT viewpoint, chrom, s AS start_pos, e AS end_pos, condition, round(mean, 6) AS mean FROM means")
def summarise_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.condition_means(track(spark, sf_dir), design(spark, sf_dir)).withColumn("mean", F.round("mean", 6))


@R.query(
    f"""WITH {SQL_BG}, {SQL_DESIGN}, g AS (SELECT DISTINCT viewpoint, chrom, s, e, d.condition FROM bg JOIN design d ON d.sample = bg.sample)
    SELECT g.viewpoint, g.chrom, g.s AS start_pos, g.e AS end_pos, g.condition, median(coalesce(n, 0))::DOUBLE AS value FROM g JOIN design d ON d.condition = g.condition
    LEFT JOIN bg ON bg.sample = d.sample AND bg.viewpoint = g.viewpoint AND bg.chrom = g.chrom AND bg.s = g.s AND bg.e = g.e GROUP BY 1, 2, 3, 4, 5"""
)
def summarise_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.summarise(track(spark, sf_dir), design(spark, sf_dir), "median")


@R.query(
    f"""WITH {SQL_BG}, {SQL_DESIGN}, g AS (SELECT DISTINCT viewpoint, chrom, s, e, d.condition FROM bg JOIN design d ON d.sample = bg.sample),
    x AS (SELECT g.viewpoint, g.chrom, g.s, g.e, g.condition, coalesce(n, 0)::DOUBLE AS n FROM g JOIN design d ON d.condition = g.condition
        LEFT JOIN bg ON bg.sample = d.sample AND bg.viewpoint = g.viewpoint AND bg.chrom = g.chrom AND bg.s = g.s AND bg.e = g.e),
    y AS (SELECT viewpoint, chrom, s, e, condition, [sum(n), min(n), max(n), stddev_pop(n)] AS v FROM x GROUP BY 1, 2, 3, 4, 5)
    SELECT viewpoint, chrom, s AS start_pos, e AS end_pos, condition, unnest(['sum', 'min', 'max', 'std']) AS how, round(unnest(v), 6) AS value FROM y"""
)
def summarise_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum, least, greatest and standard deviation over a condition's samples, zeros included."""
    t, d = settled(track(spark, sf_dir), "track"), design(spark, sf_dir)
    each = [pileup.summarise(t, d, how).withColumn("how", F.lit(how)) for how in ("sum", "min", "max", "std")]
    return reduce(DataFrame.unionByName, each).withColumn("value", F.round("value", 6))


@R.query(
    f"""WITH {SQL_MEANS}, c AS (SELECT DISTINCT condition FROM means), p AS (SELECT x.condition AS a, y.condition AS b FROM c x, c y WHERE x.condition <> y.condition),
    g AS (SELECT DISTINCT viewpoint, chrom, s, e, a, b FROM means m JOIN p ON m.condition IN (a, b))
    SELECT g.viewpoint, g.chrom, g.s AS start_pos, g.e AS end_pos, g.a, g.b, round(coalesce(x.mean, 0) - coalesce(y.mean, 0), 6) AS difference FROM g
    LEFT JOIN means x ON x.viewpoint = g.viewpoint AND x.chrom = g.chrom AND x.s = g.s AND x.e = g.e AND x.condition = g.a
    LEFT JOIN means y ON y.viewpoint = g.viewpoint AND y.chrom = g.chrom AND y.s = g.s AND y.e = g.e AND y.condition = g.b"""
)
def subtraction_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = settled(pileup.condition_means(track(spark, sf_dir), design(spark, sf_dir)), "means")
    return pileup.subtractions(means).withColumn("difference", F.round("difference", 6))


@R.query(
    f"""WITH {SQL_BG}, {SQL_DESIGN} SELECT viewpoint, chrom, s AS start_pos, e AS end_pos, d.condition, round(avg(n), 6) AS mean, round(stddev_samp(n) / sqrt(count(*)), 6) AS sem, count(*) AS k
    FROM bg JOIN design d ON d.sample = bg.sample GROUP BY 1, 2, 3, 4, 5"""
)
def replicate_mean_sem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.replicates(track(spark, sf_dir), design(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("mean", "sem")})


@R.query(
    f"""WITH {SQL_BG}, seg0 AS (SELECT DISTINCT viewpoint, chrom, unnest([s, e]) AS s FROM bg),
    seg AS (SELECT viewpoint, chrom, s, lead(s) OVER (PARTITION BY viewpoint, chrom ORDER BY s) AS e FROM seg0)
    SELECT seg.viewpoint, seg.chrom, seg.s AS start_pos, seg.e AS end_pos, bg.sample, n FROM seg
    JOIN bg ON bg.viewpoint = seg.viewpoint AND bg.chrom = seg.chrom AND bg.s < seg.e AND seg.s < bg.e"""
)
def union_bedgraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every viewpoint's profiles cut at all samples' breakpoints."""
    from ..operators.intervals import union_segments

    t = settled(track(spark, sf_dir), "track")
    return union_segments(t, ["sample", "n"], by=["viewpoint"])


@R.query(
    f"""WITH {SQL_BG}, q AS (SELECT count(DISTINCT bam) AS k FROM slices)
    SELECT viewpoint, chrom, s AS start_pos, e AS end_pos, sample, n FROM bg, q QUALIFY count(CASE WHEN n >= 1 THEN 1 END) OVER (PARTITION BY viewpoint, chrom, s, e) = k"""
)
def counts_matrix_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places with a count in every sample."""
    k = table(spark, sf_dir, "slices").select("bam").distinct().count()
    return pileup.counts_over(track(spark, sf_dir), k, 1).select("viewpoint", "chrom", "start_pos", "end_pos", "sample", "n")


@R.query(
    f"""WITH {SQL_BG}, r AS (SELECT viewpoint, sample, ln(n) - avg(ln(n)) OVER (PARTITION BY viewpoint, chrom, s, e) AS r FROM bg)
    SELECT viewpoint, sample, round(exp(median(r)), 6) AS factor FROM r GROUP BY 1, 2"""
)
def median_ratio_size_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pileup.size_factors(track(spark, sf_dir)).withColumn("factor", F.round("factor", 6))


@R.query()
def nb_wald(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of conditions of the design, b against a, at every place with a count in either."""
    return pileup.differential_pairs(settled(track(spark, sf_dir), "track"), design(spark, sf_dir))


@R.query()
def nb_wald_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where every sample has five counts, up to an adjusted p of 0.05, the largest changes first."""
    found = pileup.differential_pairs(settled(track(spark, sf_dir), "track"), design(spark, sf_dir), most=0.05, over=5)
    return found.orderBy(F.desc(F.abs("log2_fold_change")), "p_adjusted", "viewpoint", "chrom", "start_pos", "a", "b")


@R.query(
    f"""WITH {SQL_BG}, {SQL_DESIGN}, two AS (SELECT sample, condition = 'wt' AS b FROM design WHERE condition IN ('wt', 'ko')),
    p AS (SELECT DISTINCT viewpoint, chrom, s, e FROM bg JOIN two ON two.sample = bg.sample)
    SELECT p.viewpoint, p.chrom, p.s AS start_pos, p.e AS end_pos, list(coalesce(n, 0)::DOUBLE ORDER BY two.b, two.sample) AS n FROM p CROSS JOIN two
    LEFT JOIN bg ON bg.sample = two.sample AND bg.viewpoint = p.viewpoint AND bg.chrom = p.chrom AND bg.s = p.s AND bg.e = p.e GROUP BY 1, 2, 3, 4"""
)
def counts_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that wt is tested against ko by, zeros included."""
    t = settled(track(spark, sf_dir), "track")
    return pileup.conditions_side_by_side(t, design(spark, sf_dir), "ko", "wt").select("viewpoint", "chrom", "start_pos", "end_pos", "n")
