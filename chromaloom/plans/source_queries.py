"""Sources and sinks by round trips through files in the shared folder, and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import is_missing, plain, sql_missing, sql_plain
from ..operators import matrix
from ..operators.slices import sql_clean
from ..session import scratch_path
from ..sources import readers, writers
from ..streaming import deliveries
from .filter_queries import slices
from .interval_queries import viewpoints
from .matrix_queries import SQL_PX, SQL_W, contacts, pixels
from .preprocess_queries import SQL_SEQUENCES, sequences
from .registry import Registry
from .tables import table

R = Registry()
queries, oracle_sql = R.queries, R.oracle_sql
S = sql_clean()


@R.query(f"WITH {S} SELECT chrom, start_pos, end_pos, slice_name AS name FROM s WHERE mapped = 1")
def bed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices as BED and back."""
    path = scratch_path(spark, "bed")
    writers.write_bed(slices(spark, sf_dir).where("mapped = 1").withColumn("name", F.col("slice_name")), path)
    return readers.read_bed(spark, path)


@R.query("SELECT lower(name) AS name, chrom, start_pos, end_pos FROM viewpoints")
def tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Viewpoints as a compressed table with a header and back; an empty table beside it is passed over."""
    path, none = scratch_path(spark, "tsv"), scratch_path(spark, "tsv")
    writers.write_tsv(viewpoints(spark, sf_dir), path, gzip=True)
    writers.write_tsv(viewpoints(spark, sf_dir).limit(0), none)
    back = readers.read_tables(spark, [path, none])
    return back.select("name", "chrom", F.col("start_pos").cast("long"), F.col("end_pos").cast("long"))


@R.query(f"WITH {SQL_SEQUENCES} SELECT chrom AS name, sequence FROM seq")
def fastq_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences as FASTQ files of 5,000 reads and back."""
    path = scratch_path(spark, "fastq")
    reads = sequences(spark, sf_dir).select(F.col("chrom").alias("name"), "sequence", F.repeat(F.lit("I"), F.length("sequence")).alias("quality"))
    writers.write_fastq(reads, path, reads_per_file=5_000)
    return readers.read_fastq(spark, path).select("name", "sequence")


@R.query("SELECT record_id, slice_name, capture, multimapped FROM slices")
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    t = table(spark, sf_dir, "slices").select("record_id", "slice_name", "capture", "multimapped")
    writers.write_json(t, path)
    return spark.read.schema(t.schema).json(path)


@R.query(f"WITH {S} SELECT slice_id, slice_name FROM s")
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices in files of at most 10,000 rows."""
    path = scratch_path(spark, "parquet")
    writers.write_parquet(slices(spark, sf_dir).select("slice_id", "slice_name"), path, rows_per_file=10_000)
    return spark.read.parquet(path)


@R.query(f"WITH {SQL_PX} SELECT sample, bin1_id, bin2_id, n FROM px WHERE viewpoint = (SELECT min(lower(name)) FROM viewpoints)")
def dump_viewpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One viewpoint of a store as text and back; only its files are read."""
    store, text = scratch_path(spark, "store"), scratch_path(spark, "dump")
    matrix.write_store(pixels(spark, sf_dir), store)
    first = viewpoints(spark, sf_dir).agg(F.min("name")).first()[0]
    writers.dump(matrix.read_store(spark, matrix.store_uri(store, first)).select("sample", "viewpoint", "bin1_id", "bin2_id", "n"), text, first)
    schema = "sample string, viewpoint string, bin1_id long, bin2_id long, n long"
    return spark.read.options(sep="\t", header="true").schema(schema).csv(text).drop("viewpoint")


@R.query(f"SELECT bam AS sample, CASE WHEN NOT {sql_missing('condition_label')} THEN {sql_plain('condition_label')} END AS condition FROM design_matrix")
def design_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the design as text, separated by blanks, and back; a row without a condition keeps its sample."""
    path = scratch_path(spark, "design")
    label = F.when(~is_missing(F.col("condition_label")), plain(F.col("condition_label")))
    writers.write_design(table(spark, sf_dir, "design_matrix").select(F.col("bam").alias("sample"), label.alias("condition")), path)
    return readers.read_design(spark, path)


@R.query(
    f"""WITH {S}, a AS (SELECT slice_name, chrom, start_pos, slice % 3 AS mark FROM s WHERE mapped = 1 AND slice < 4)
    SELECT s.slice_id, a.mark FROM s JOIN a ON a.slice_name = s.slice_name AND a.chrom = s.chrom AND a.start_pos = s.start_pos"""
)
def merge_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices with a table of annotations, listed twice."""
    s = slices(spark, sf_dir)
    a = s.where("mapped = 1 AND slice < 4").select("slice_name", "chrom", "start_pos", (F.col("slice") % 3).alias("mark"))
    return readers.best_annotation(s, a.unionByName(a)).select("slice_id", "mark")


@R.query(f"WITH {S} SELECT slice_id, pe FROM s")
def concat_read_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged and unmerged slices from two stores, one below the other."""
    s = slices(spark, sf_dir)
    paths = []
    for kind in ("flashed", "pe"):
        paths.append(scratch_path(spark, kind))
        writers.write_parquet(s.where(F.col("pe") == kind).select("slice_id", "pe"), paths[-1])
    return spark.read.parquet(*paths)


@R.query(f"WITH {S} SELECT DISTINCT slice_name FROM s")
def stream_first_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slices table as a stream: each slice once, however often it is delivered."""
    source = scratch_path(spark, "incoming")
    t = table(spark, sf_dir, "slices")
    t.write.parquet(source)
    stream = deliveries.first_deliveries(deliveries.slice_stream(spark, source, t.schema), "3650 days").select("slice_name")
    out = scratch_path(spark, "delivered")
    deliveries.run_to_end(stream, out, scratch_path(spark, "progress"))
    return spark.read.parquet(out)


@R.query(f"WITH {SQL_W} SELECT viewpoint, count(*) AS n FROM w GROUP BY viewpoint ORDER BY n DESC, viewpoint LIMIT 10")
def top_viewpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of the ten viewpoints with most slices."""
    return contacts(spark, sf_dir).groupBy("viewpoint").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "viewpoint").limit(10)


@R.query(
    f"""WITH {SQL_PX}, r AS (SELECT sample, viewpoint, bin1_id, bin2_id, n, row_number() OVER (PARTITION BY sample, viewpoint ORDER BY n DESC, bin1_id, bin2_id) AS k FROM px)
    SELECT sample, viewpoint, bin1_id, bin2_id, n FROM r WHERE k <= 5"""
)
def top_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five strongest pixels of each sample and viewpoint."""
    order = Window.partitionBy("sample", "viewpoint").orderBy(F.desc("n"), "bin1_id", "bin2_id")
    return pixels(spark, sf_dir).withColumn("k", F.row_number().over(order)).where("k <= 5").drop("k")
