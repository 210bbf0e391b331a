"""Digestion, duplicate reads, names and statistics, on the tables that stand for their inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import genomic
from ..functions.text import plain_slice, sql_plain
from ..operators import filters, preprocess, stats
from ..operators.fragments import fragments
from ..operators.slices import sql_clean
from .filter_queries import slices, sql_program
from .registry import Registry
from .tables import table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql
S = sql_clean()

#: Bases at a place of a made-up genome: the last bits of a product. The same in both engines.
_BASE = "substr('ACGT', CAST(((name * 7919 + k * 104729 + (name * k) % 8191) % 16) {div} 4 AS INT) + 1, 1)"
SQL_SEQUENCES = f"""seq AS (SELECT 'f' || name AS chrom, string_agg({_BASE.format(div="//")}, '' ORDER BY k) AS sequence FROM restriction_fragments, range(0, 120) r(k) GROUP BY name)"""


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sequence of 120 bases for each restriction fragment, made up by arithmetic."""
    each = table(spark, sf_dir, "restriction_fragments").select("name", F.explode(F.sequence(F.lit(0), F.lit(119))).alias("k"))
    base = F.expr(_BASE.format(div="DIV"))
    letters = each.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("k", base.alias("b")))).alias("x"))
    return letters.select(F.concat(F.lit("f"), F.col("name").cast("string")).alias("chrom"), F.array_join(F.col("x.b"), "").alias("sequence"))


SQL_DIGEST = f"""{SQL_SEQUENCES}, parts AS (SELECT chrom, string_split(sequence, 'GTA') AS p FROM seq),
    each AS (SELECT chrom, p, unnest(range(1, len(p) + 1)) AS i FROM parts),
    placed AS (SELECT chrom, i, p[i] AS piece, CAST(coalesce(list_sum(list_transform(p[1:i - 1], lambda x: length(x) + 3)), 0) AS BIGINT) AS s FROM each)"""


@R.query(f"WITH {SQL_DIGEST} SELECT chrom, s AS start_pos, s + length(piece) AS end_pos FROM placed WHERE length(piece) >= 18")
def digest_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess.digest_genome(sequences(spark, sf_dir), "GTA", 18)


@R.query(
    f"""WITH {SQL_DIGEST}, f AS (SELECT chrom, s AS start_pos, s + length(piece) AS end_pos FROM placed WHERE length(piece) >= 18)
    SELECT *, row_number() OVER (ORDER BY chrom, start_pos) - 1 AS name FROM f"""
)
def digest_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fragments numbered in genomic order."""
    return preprocess.numbered(preprocess.digest_genome(sequences(spark, sf_dir), "GTA", 18))


@R.query(
    f"""WITH {SQL_DIGEST}, kept AS (SELECT *, i - 1 AS uid FROM placed WHERE length(piece) >= 18 AND chrom IN (SELECT chrom FROM parts WHERE len(p) > 1))
    SELECT chrom || '|flashed|' || (row_number() OVER (PARTITION BY chrom ORDER BY uid) - 1) || '|' || uid AS slice_name, piece AS sequence FROM kept"""
)
def digest_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = sequences(spark, sf_dir).select(F.col("chrom").alias("name"), F.lit(1).alias("read"), "sequence", F.repeat(F.lit("I"), F.length("sequence")).alias("quality"))
    return preprocess.digest_reads(reads, "GTA").select("slice_name", "sequence")


@R.query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY text, lang")
def dedup_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of each set of equal texts; the texts stand for reads."""
    reads = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return preprocess.deduplicate_reads(reads, "doc_id", ["text", "lang"]).select("doc_id")


@R.query(
    """WITH g AS (SELECT count(*) AS n FROM documents GROUP BY text, lang), t AS (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS "unique" FROM g)
    SELECT *, total - "unique" AS duplicates, round((total - "unique") * 100.0 / total, 4)::DOUBLE AS percentage FROM t"""
)
def dedup_reads_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess.deduplication_counts(table(spark, sf_dir, "documents"), ["text", "lang"])


@R.query(f"WITH {S}, {sql_program('capture', 'k')} SELECT record_id FROM slices WHERE {sql_plain("split_part(slice_name, '|', 1)")} IN (SELECT parent_id FROM k)")
def regenerate_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose read is one that the capture program keeps."""
    kept = filters.run_program(slices(spark, sf_dir), "capture")
    reads = table(spark, sf_dir, "slices").select("record_id", F.split_part(plain_slice(F.col("slice_name")), F.lit("|"), F.lit(1)).alias("name"))
    return preprocess.regenerate_reads(reads, "name", kept, "parent_id").select("record_id")


SQL_BED12 = """x AS (SELECT DISTINCT chrom, start_pos AS s, end_pos AS e, 'g' || (name // 5) AS gene FROM restriction_fragments WHERE name % 5 <> 2),
    g AS (SELECT chrom, gene, min(s) AS first, max(e) AS last, count(*) AS n, list(e - s ORDER BY s) AS z, list(s ORDER BY s) AS b FROM x GROUP BY chrom, gene)"""


@R.query(
    f"""WITH {SQL_BED12} SELECT chrom, first AS start_pos, last AS end_pos, gene AS name, 0 AS score, '+' AS strand, first AS thick_start, last AS thick_end, '0,0,0' AS rgb,
    CAST(n AS INTEGER) AS block_count, array_to_string(z, ',') || ',' AS block_sizes, array_to_string(list_transform(b, lambda v: v - first), ',') || ',' AS block_starts FROM g"""
)
def bed12_from_exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gene models; groups of restriction fragments stand for exons."""
    f = table(spark, sf_dir, "restriction_fragments").where("name % 5 <> 2")
    exons = f.select("chrom", "start_pos", "end_pos", F.concat(F.lit("g"), F.floor(F.col("name") / 5).cast("string")).alias("gene"), F.lit("+").alias("strand"))
    return preprocess.bed12(exons)


@R.query(
    r"""WITH f AS (SELECT DISTINCT regexp_replace(bam, '\.bam$', '') AS base FROM slices), s AS (SELECT base, base || '_1.fastq.gz' AS a, base || '_2.fastq.gz' AS b FROM f)
    SELECT base AS sample, split_part(base, '_', 1) AS condition, split_part(base, '_', 2) AS replicate, 'run/' || a AS fq1, 'run/' || b AS fq2 FROM s"""
)
def samples_from_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples and their pairs of files, from the files' names."""
    base = F.regexp_replace("bam", r"\.bam$", "")
    files = table(spark, sf_dir, "slices").select(base.alias("base")).distinct()
    paths = files.select(F.explode(F.array(*[F.concat(F.lit("run/"), "base", F.lit(f"_{r}.fastq.gz")) for r in (1, 2)])).alias("path"))
    return preprocess.samples_from_names(paths)


@R.query("SELECT coordinates, split_part(coordinates, ':', 1) AS chrom, CAST(regexp_extract(coordinates, ':([0-9]+)-', 1) AS BIGINT) AS start_pos, CAST(regexp_extract(coordinates, '-([0-9]+)$', 1) AS BIGINT) AS end_pos, record_id FROM slices WHERE coordinates <> ''")
def coordinate_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "slices").where("coordinates <> ''")
    return t.select("record_id", "coordinates", genomic.coordinate_parts(F.col("coordinates")).alias("p")).select("record_id", "coordinates", "p.*")


@R.query(
    """SELECT record_id, CASE WHEN mapped = 1 THEN chrom || ':' || start_pos || '-' || end_pos END AS place, regexp_full_match(capture, '[A-Za-z0-9_-]+') AND capture IS NOT NULL AS valid,
    CASE WHEN contains(bam, 'rep1') THEN 'first' WHEN contains(bam, 'rep2') THEN 'second' ELSE 'other' END AS replicate FROM slices WHERE chrom IS NOT NULL"""
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "slices").where("chrom IS NOT NULL")
    place = F.when(F.col("mapped") == 1, genomic.coordinate_text(F.col("chrom"), F.col("start_pos"), F.col("end_pos")))
    kind = genomic.first_match(F.col("bam"), [("rep1", "first"), ("rep2", "second")], "other")
    return t.select("record_id", place.alias("place"), genomic.valid_viewpoint_name(F.col("capture")).alias("valid"), kind.alias("replicate"))


SQL_SIZES = f"{S}, z AS (SELECT parent_id, min(pe) AS pe, count(DISTINCT slice) AS value FROM s GROUP BY parent_id), h AS (SELECT pe, value, count(*) AS n FROM z GROUP BY ALL)"


@R.query(f"WITH {SQL_SIZES} SELECT pe, value, n FROM h")
def slices_per_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of slices in a read, by read type."""
    return stats.histogram(fragments(slices(spark, sf_dir)), F.col("unique_slices"), ["pe"])


@R.query(f"WITH {SQL_SIZES} SELECT value, CAST(sum(n) * 2 AS BIGINT) AS n FROM h GROUP BY value")
def merged_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histograms of parts, kept as maps, added twice."""
    maps = stats.histogram_map(stats.histogram(fragments(slices(spark, sf_dir)), F.col("unique_slices"), ["pe"]), ["pe"])
    return stats.merged_histograms(maps.unionByName(maps)).select(F.explode("hist").alias("value", "n"))


SQL_COUNTS = "c AS (SELECT bam AS sample, pe AS read_type, count(*) AS total, count(CASE WHEN mapped = 1 THEN 1 END) AS mapped, count(CASE WHEN multimapped = 1 THEN 1 END) AS multi FROM slices GROUP BY ALL)"


@R.query(f"WITH {SQL_COUNTS} SELECT sample, CAST(sum(total) AS BIGINT) AS total, CAST(sum(total) - sum(mapped) AS BIGINT) AS duplicates, CAST(sum(mapped) AS BIGINT) AS \"unique\", round((sum(total) - sum(mapped)) * 100.0 / sum(total), 4)::DOUBLE AS percentage FROM c GROUP BY sample")
def additive_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by sample and read type, added up to samples, with derived figures; unmapped stand for duplicates."""
    t = table(spark, sf_dir, "slices")
    parts = t.groupBy(F.col("bam").alias("sample"), "pe").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("mapped") != 1).alias("duplicates"))
    return stats.read_duplicates(parts)


@R.query(f"WITH {SQL_COUNTS} SELECT sample, read_type, unnest(['total', 'mapped', 'multi']) AS stat, unnest([total, mapped, multi]) AS n FROM c")
def report_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "slices").groupBy(F.col("bam").alias("sample"), F.col("pe").alias("read_type"))
    counts = t.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("mapped") == 1).alias("mapped"), F.count_if(F.col("multimapped") == 1).alias("multi"))
    return stats.long_form(counts, ["sample", "read_type"], ["total", "mapped", "multi"], "stat", "n")


@R.query("SELECT bam AS sample, count(CASE WHEN pe = 'flashed' THEN 1 END) AS flashed, count(CASE WHEN pe = 'pe' THEN 1 END) AS pe FROM slices GROUP BY bam")
def report_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "slices").groupBy(F.col("bam").alias("sample"), F.col("pe").alias("read_type")).agg(F.count(F.lit(1)).alias("n"))
    return stats.wide_form(counts, ["sample"], "read_type", "n", ["flashed", "pe"])


@R.query(
    """WITH n AS (SELECT count(*) AS a, count(CASE WHEN mapped = 1 THEN 1 END) AS b, count(CASE WHEN mapped = 1 AND capture_count = 1 THEN 1 END) AS c FROM slices)
    SELECT 'all' AS stage, a AS n, 100.0::DOUBLE AS percent_of_first, NULL::DOUBLE AS percent_of_previous FROM n
    UNION ALL SELECT 'mapped', b, round(b * 100.0 / a, 4), round(b * 100.0 / a, 4) FROM n UNION ALL SELECT 'captured', c, round(c * 100.0 / a, 4), round(c * 100.0 / b, 4) FROM n"""
)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records each of three stages leaves."""
    t = table(spark, sf_dir, "slices")
    one = t.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("mapped") == 1).alias("mapped"), F.count_if((F.col("mapped") == 1) & (F.col("capture_count") == 1)).alias("captured"))
    return stats.run_report(one.unpivot([], ["all", "mapped", "captured"], "stage", "n"), ["all", "mapped", "captured"])


@R.query(
    f"""WITH {S}, e AS (SELECT DISTINCT capture, pe FROM s WHERE capture IS NOT NULL), n AS (SELECT capture, count(*) AS n FROM s WHERE capture IS NOT NULL AND mapped = 1 GROUP BY 1)
    SELECT e.capture AS viewpoint, e.pe, coalesce(n, 0) AS n FROM e LEFT JOIN n ON n.capture = e.capture WHERE coalesce(n, 0) > 0"""
)
def viewpoints_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Viewpoints and read types that occur, with the viewpoint's mapped slices where there are any."""
    s = slices(spark, sf_dir).where("capture IS NOT NULL")
    n = s.where("mapped = 1").groupBy("capture").agg(F.count(F.lit(1)).alias("n"))
    return s.select("capture", "pe").distinct().join(n, "capture").select(F.col("capture").alias("viewpoint"), "pe", "n")
