"""Slices as they are delivered: a stream of records that come late and more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_missing, plain, plain_slice


def slice_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 8) -> DataFrame:
    """New Parquet files of a folder, with loaded_at as an event time."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return stream.withColumn("loaded_at", F.col("loaded_at").cast("timestamp"))


def first_deliveries(stream: DataFrame, late: str = "30 days") -> DataFrame:
    """The first record of each slice; state is kept for as long as records may be late."""
    named = stream.withColumn("slice_name", plain_slice(F.col("slice_name"))).withWatermark("loaded_at", late)
    return named.dropDuplicatesWithinWatermark(["slice_name"])


def records_per_day(stream: DataFrame, late: str = "30 days") -> DataFrame:
    """day, bam, capture, n: records by day of loading, sent on once no more can come."""
    capture = F.when(~is_missing(F.col("capture")), plain(F.col("capture"))).otherwise("")
    marked = stream.withWatermark("loaded_at", late)
    return marked.groupBy(F.window("loaded_at", "1 day").alias("day"), "bam", capture.alias("capture")).agg(F.count(F.lit(1)).alias("n"))


def run_to_end(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Everything that is there now, into Parquet, exactly once across restarts."""
    query = df.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
    query.awaitTermination()
