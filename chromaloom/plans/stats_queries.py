"""Reports of reads and digestion, readers and writers by round trips, and what tiled assays count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import genomic
from ..operators import filters, fragments, intervals, matrix, preprocess, stats
from ..operators.slices import sql_clean
from ..session import scratch_path
from ..sources import readers, writers
from .filter_queries import slices, sql_program
from .interval_queries import SQL_PLACED, placed
from .matrix_queries import SQL_BG, SQL_PX, bins, pixels, track, viewpoints
from .preprocess_queries import SQL_DIGEST, SQL_SEQUENCES, sequences
from .registry import Registry
from .tables import table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql
S = sql_clean()

# Parts of a library stand for files of reads: by a slice's number in its read.
SQL_PARTS = "parts AS (SELECT bam AS sample, uid % 3 AS part, 1 + slice % 2 AS read_number, count(*) AS a, count(CASE WHEN mapped = 1 THEN 1 END) AS b, count(CASE WHEN capture_count = 1 THEN 1 END) AS c FROM slices GROUP BY ALL)"


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "slices").groupBy(F.col("bam").alias("sample"), (F.col("uid") % 3).alias("part"), (1 + F.col("slice") % 2).alias("read_number"))
    return t.agg(F.count(F.lit(1)).alias("a"), F.count_if(F.col("mapped") == 1).alias("b"), F.count_if(F.col("capture_count") == 1).alias("c"))


@R.query(
    f"""WITH {SQL_PARTS}, n AS (SELECT sample, read_number, CAST(sum(a) AS BIGINT) AS reads_input, CAST(sum(b) AS BIGINT) AS reads_output, CAST(sum(c) AS BIGINT) AS reads_with_adapter FROM parts GROUP BY 1, 2)
    SELECT sample, CAST(read_number AS INTEGER) AS read_number, reads_input, reads_output, reads_with_adapter,
        round(reads_with_adapter * 100.0::DOUBLE / reads_input, 4) AS percentage_trimmed, round(reads_output * 100.0::DOUBLE / reads_input, 4) AS percentage_kept FROM n"""
)
def trimming_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trimmer's report of parts, written, read and added up by sample and read."""
    name = F.concat("sample", F.lit("_part"), F.col("part").cast("string"), F.lit("_"), F.col("read_number").cast("string"))
    path = scratch_path(spark, "trimming")
    writers.write_tsv(_parts(spark, sf_dir).select(name.alias("Sample"), F.col("a").alias("r_processed"), F.col("b").alias("r_written"), F.col("c").alias("r_with_adapters")), path)
    return stats.trimming(readers.read_trimming(spark, path))


@R.query(
    f"""WITH {SQL_PARTS}, n AS (SELECT sample, CAST(sum(b) AS BIGINT) AS combined, CAST(sum(a - b) AS BIGINT) AS uncombined FROM parts GROUP BY 1)
    SELECT *, combined + uncombined AS total, round(combined * 100.0::DOUBLE / (combined + uncombined), 4) AS percentage FROM n"""
)
def merging_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read merger's report of parts, written, read and added up by sample."""
    p = _parts(spark, sf_dir).groupBy("sample", "part").agg(F.sum("b").alias("combopairs"), F.sum(F.col("a") - F.col("b")).alias("uncombopairs"))
    path = scratch_path(spark, "merging")
    writers.write_tsv(p.select(F.concat("sample", F.lit("_part"), F.col("part").cast("string")).alias("Sample"), "combopairs", "uncombopairs"), path)
    return stats.merging(readers.read_merging(spark, path))


SQL_PIECES = f"""{SQL_DIGEST}, pieces AS (SELECT chrom AS name, CASE WHEN CAST(substr(chrom, 2) AS BIGINT) % 2 = 0 THEN 1 ELSE 2 END AS read, length(piece) AS length FROM placed)"""


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the made-up sequences; even and odd ones stand for the two reads of pairs."""
    reads = sequences(spark, sf_dir).select(F.col("chrom").alias("name"), F.when(F.substring("chrom", 2, 9).cast("long") % 2 == 0, 1).otherwise(2).alias("read"), "sequence")
    return preprocess.read_pieces(reads, "GTA")


@R.query(
    f"""WITH {SQL_PIECES}, b AS (SELECT 'unfiltered' AS "when", read, name FROM pieces UNION ALL SELECT 'filtered', read, name FROM pieces WHERE length >= 18)
    SELECT "when", count(DISTINCT CASE WHEN read = 1 THEN name END) AS "1_reads", count(CASE WHEN read = 1 THEN 1 END) AS "1_slices",
        count(DISTINCT CASE WHEN read = 2 THEN name END) AS "2_reads", count(CASE WHEN read = 2 THEN 1 END) AS "2_slices" FROM b GROUP BY 1"""
)
def digestion_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads and slices before and after digestion's filter."""
    p = pieces(spark, sf_dir)
    return stats.digestion(p, p.where("length >= 18"))


@R.query(
    f"""WITH {SQL_PIECES}, k AS (SELECT 'unfiltered' AS kind, read, name, count(*) AS value FROM pieces GROUP BY ALL UNION ALL SELECT 'filtered', read, name, count(*) FROM pieces WHERE length >= 18 GROUP BY ALL)
    SELECT kind, read, value, count(*) AS n FROM k GROUP BY 1, 2, 3 UNION ALL SELECT 'lengths', read, length, count(*) FROM pieces WHERE length >= 18 GROUP BY 1, 2, 3"""
)
def digestion_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices in a read before and after, and lengths of slices."""
    return stats.digestion_histograms(pieces(spark, sf_dir), 18)


@R.query(
    f"""WITH {S} SELECT count(DISTINCT slice_name) AS unique_slices, count(DISTINCT parent_id) AS unique_fragments, CAST(sum(mapped) AS BIGINT) AS mapped,
    CAST(sum(multimapped) AS BIGINT) AS multimapped, count(CASE WHEN capture_count > 0 THEN 1 END) AS captured, CAST(sum(blacklist) AS BIGINT) AS blacklist FROM s"""
)
def slice_stats_tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.slice_stats_tiled(slices(spark, sf_dir))


@R.query(
    f"""WITH {S}, {sql_program("tiled", "k")},
    v AS (SELECT *, max(capture) OVER f AS viewpoint FROM k WINDOW f AS (PARTITION BY parent_id) QUALIFY min(capture) OVER f = max(capture) OVER f),
    home AS (SELECT viewpoint, arg_max(chrom, (n, chrom)) AS home FROM (SELECT viewpoint, chrom, count(*) AS n FROM v WHERE capture_count = 1 GROUP BY ALL) GROUP BY viewpoint)
    SELECT v.viewpoint, pe AS read_type, CASE WHEN chrom = home THEN 'cis' ELSE 'trans' END AS cis_or_trans, count(*) AS n FROM v LEFT JOIN home ON home.viewpoint = v.viewpoint GROUP BY 1, 2, 3"""
)
def cis_trans_tiled_by_read_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices on their viewpoint's chromosome or not, by read type, of what the tiled program keeps."""
    return fragments.cis_or_trans_tiled_by_read_type(matrix.with_viewpoint(filters.run_program(slices(spark, sf_dir), "tiled")))


# Round trips

@R.query(f"WITH {SQL_PLACED} SELECT s.slice_name, mapped, CASE WHEN mapped = 1 THEN chrom END AS chrom, start_pos, end_pos, multimapped, pe, slice, coordinates FROM s")
def sam_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices as alignments in text form and back, unmapped ones too."""
    s = slices(spark, sf_dir)
    flag = F.when(F.col("mapped") == 1, 0).otherwise(4) + F.when(F.col("multimapped") == 1, 256).otherwise(0)
    on = lambda c, other: F.when(F.col("mapped") == 1, c).otherwise(other)
    cigar = F.concat((F.col("end_pos") - F.col("start_pos")).cast("string"), F.lit("M"))
    line = F.concat_ws("\t", "slice_name", flag.cast("string"), on(F.col("chrom"), "*"), on((F.col("start_pos") + 1).cast("string"), "0"), F.lit("40"), on(cigar, "*"), F.lit("*\t0\t0\t*\t*"))
    path = scratch_path(spark, "sam")
    s.select(line.alias("value")).write.text(path)
    return readers.read_sam(spark, path, "x.bam").select("slice_name", "mapped", "chrom", "start_pos", "end_pos", "multimapped", "pe", "slice", "coordinates")


@R.query(f"WITH {S} SELECT chrom, start_pos, end_pos, slice_name AS name FROM s WHERE mapped = 1")
def alignments_to_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.sam_to_bed(slices(spark, sf_dir))


@R.query(f"WITH {SQL_SEQUENCES} SELECT chrom, sequence FROM seq")
def fasta_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences as FASTA with lines of 50 bases and back."""
    path = scratch_path(spark, "fasta")
    writers.write_fasta(sequences(spark, sf_dir), path, 50)
    return readers.read_fasta(spark, path)


@R.query(f"WITH {SQL_BG} SELECT chrom, s AS start_pos, e AS end_pos, CAST(n AS DOUBLE) AS n FROM bg")
def bedgraph_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All profiles as one sorted bedgraph and back."""
    path = scratch_path(spark, "bedgraph")
    writers.write_bedgraph(track(spark, sf_dir), path, gzip=True)
    return readers.read_bedgraph(spark, path)


@R.query("SELECT chrom, max(end_pos) AS size FROM restriction_fragments GROUP BY chrom")
def chrom_sizes_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of chromosomes as an index of a FASTA file and back."""
    path = scratch_path(spark, "sizes")
    sizes = matrix.chrom_sizes(table(spark, sf_dir, "restriction_fragments"))
    writers.write_tsv(sizes.select("chrom", "size", F.lit(6).alias("offset"), F.lit(60).alias("bases"), F.lit(61).alias("width")), path, header=False)
    return readers.read_chrom_sizes(spark, path)


@R.query(f"WITH {S} SELECT slice_id FROM s WHERE parent_id NOT IN (SELECT parent_id FROM s WHERE blacklist > 0 OR multimapped = 1)")
def without_listed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of fragments that two files of ids, JSON and text, don't list."""
    s = slices(spark, sf_dir)
    as_json, as_text = scratch_path(spark, "ids") + ".json", scratch_path(spark, "ids") + ".txt"
    s.where("blacklist > 0").select("parent_id").distinct().write.json(as_json)
    s.where("multimapped = 1").select(F.col("parent_id").alias("value")).distinct().write.text(as_text)
    listed = readers.read_ids(spark, as_json).unionByName(readers.read_ids(spark, as_text))
    return fragments.without_duplicates(s, listed).select("slice_id")


@R.query("SELECT true AS valid, count(*) FILTER (name IS NULL) = 0 AS named, count(DISTINCT name) < count(name) AS duplicated FROM viewpoints")
def bed_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.check_bed(viewpoints(spark, sf_dir))


@R.query(f"WITH {SQL_PLACED} SELECT slice_id FROM p WHERE chrom = 'chr7' AND s < 700000 AND e > 600000")
def slices_in_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.rows_by_region(placed(spark, sf_dir), "chr7", 600_000, 700_000).select("slice_id")


@R.query("SELECT count(*) AS n_rows, 2 AS n_columns FROM slices WHERE bam IS NULL AND record_id < 0 AND slice < 0")
def empty_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an empty output leaves: no rows, and its columns."""
    path = scratch_path(spark, "empty")
    writers.write_parquet(table(spark, sf_dir, "slices").where("bam IS NULL AND record_id < 0 AND slice < 0").select("record_id", "bam"), path)
    back = spark.read.parquet(path)
    return back.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(back.columns)))


@R.query(f"""WITH {S} SELECT slice_id, bam, starts_with(coordinates, 'chr7:') AS on_7, ends_with(slice_name, '|0') AS first_uid,
    CASE WHEN mapped = 1 THEN round(100.0::DOUBLE * (end_pos - start_pos) / 250, 4) END AS percent, (mapped + 2 * multimapped) & 2 <> 0 AS multi FROM s""")
def scalar_functions_on_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names' ends, coordinates, percentages and flags."""
    s = slices(spark, sf_dir)
    parts = genomic.coordinate_parts(F.col("coordinates"))
    percent = F.round(genomic.percentage(F.col("end_pos") - F.col("start_pos"), F.lit(250)), 4)
    return s.select(
        "slice_id", "bam", F.coalesce(parts["chrom"] == "chr7", F.lit(False)).alias("on_7"), genomic.ends_with_name(F.col("slice_name"), "|0").alias("first_uid"),
        F.when(F.col("mapped") == 1, percent).alias("percent"), genomic.flag_set(F.col("mapped") + 2 * F.col("multimapped"), 2).alias("multi"),
    )


# Tables with a column for each sample

@R.query(
    f"""WITH {SQL_BG}, one AS (SELECT sample, chrom, s, e, n FROM bg WHERE viewpoint = (SELECT min(viewpoint) FROM bg)),
    seg0 AS (SELECT DISTINCT chrom, unnest([s, e]) AS s FROM one), seg AS (SELECT chrom, s, lead(s) OVER (PARTITION BY chrom ORDER BY s) AS e FROM seg0),
    hit AS (SELECT seg.chrom, seg.s, seg.e, one.sample, one.n FROM seg JOIN one ON one.chrom = seg.chrom AND one.s < seg.e AND seg.s < one.e),
    g AS (SELECT DISTINCT chrom, s, e FROM hit), names AS (SELECT DISTINCT sample FROM one)
    SELECT g.chrom, g.s AS start_pos, g.e AS end_pos, names.sample, CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM g CROSS JOIN names
    LEFT JOIN hit ON hit.chrom = g.chrom AND hit.s = g.s AND hit.e = g.e AND hit.sample = names.sample GROUP BY 1, 2, 3, 4"""
)
def union_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One viewpoint's profiles side by side, a column for each sample, 0 where it has nothing; shown in long form."""
    t = track(spark, sf_dir)
    first = t.agg(F.min("viewpoint")).first()[0]
    own = t.where(F.col("viewpoint") == first)
    samples = sorted(r[0] for r in own.select("sample").distinct().collect())  # as many as there are libraries
    if not samples:
        return own.select("chrom", "start_pos", "end_pos", "sample", "n")
    return intervals.union_table(own, "sample", "n", samples).unpivot(["chrom", "start_pos", "end_pos"], [F.col(f"`{s}`") for s in samples], "sample", "n")


WIDTHS = (5_000, 20_000)
SQL_WIDTHS = " UNION ALL ".join(
    f"""SELECT '{w}' AS resolution, sample, viewpoint, least(x.i, y.i) AS bin1_id, greatest(x.i, y.i) AS bin2_id, n
    FROM px JOIN m{w} x ON x.f = px.bin1_id JOIN m{w} y ON y.f = px.bin2_id"""
    for w in WIDTHS
)
SQL_MAPS = ", ".join(
    f"""g{w} AS (SELECT row_number() OVER (ORDER BY chrom, s) - 1 AS i, chrom, s, least(s + {w}, size) AS e FROM (SELECT chrom, size, unnest(range(0, size, {w})) AS s FROM sz)),
    m{w} AS (SELECT b.bin_id AS f, g.i FROM b JOIN g{w} g ON g.chrom = b.chrom AND (b.s + b.e) // 2 >= g.s AND (b.s + b.e) // 2 < g.s + {w})"""
    for w in WIDTHS
)


@R.query(
    f"""WITH {SQL_PX}, sz AS (SELECT chrom, max(e) AS size FROM b GROUP BY chrom), {SQL_MAPS}, t AS ({SQL_WIDTHS})
    SELECT resolution, sample, viewpoint, bin1_id, bin2_id, CAST(sum(n) AS BIGINT) AS n FROM t GROUP BY ALL"""
)
def bin_pixels_at_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several resolutions in one job, through a store; only the resolutions' groups are written."""
    path = scratch_path(spark, "store")
    matrix.write_store(matrix.rebin_widths(pixels(spark, sf_dir), bins(spark, sf_dir), WIDTHS), path, None)
    back = matrix.read_store(spark, path)
    return back.select(F.col("resolution").cast("string").alias("resolution"), "sample", "viewpoint", "bin1_id", "bin2_id", "n")


@R.query(
    f"""WITH {SQL_PX}, sz AS (SELECT chrom, max(e) AS size FROM b GROUP BY chrom), {SQL_MAPS}
    SELECT i AS bin_id, chrom, s AS start_pos, e AS end_pos FROM g{WIDTHS[1]}"""
)
def shared_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of a store, once for each resolution; those of one of its groups."""
    path = scratch_path(spark, "store")
    matrix.write_bins(matrix.bins_of_widths(bins(spark, sf_dir), WIDTHS), path)
    return matrix.read_bins(spark, matrix.store_uri(path, "any", WIDTHS[1])).select("bin_id", "chrom", "start_pos", "end_pos")


@R.query(
    f"""WITH {SQL_PX}, sz AS (SELECT chrom, max(e) AS size FROM b GROUP BY chrom), {SQL_MAPS}
    SELECT DISTINCT v.viewpoint, g.i AS bin_id, g.chrom FROM v JOIN g{WIDTHS[1]} g ON g.chrom = v.chrom AND g.s < v.e AND v.s < g.e"""
)
def viewpoint_bins_at_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of a resolution that each viewpoint lies in."""
    return matrix.viewpoint_bins(viewpoints(spark, sf_dir), matrix.fixed_bins(matrix.chrom_sizes(bins(spark, sf_dir)), WIDTHS[1]))
