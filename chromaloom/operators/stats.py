"""Statistics as additive records: partial results merge by the same functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import genomic


def percentage(part: str, whole: str) -> Column:
    """To four places; NULL of nothing."""
    return F.round(genomic.percentage(F.col(part), F.col(whole)), 4)


def added(parts: DataFrame, by: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Counts of several parts (files, lanes) added up by key."""
    return parts.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])


def read_duplicates(parts: DataFrame) -> DataFrame:
    """sample, total, duplicates -> with unique and percentage."""
    n = added(parts, ["sample"], ["total", "duplicates"])
    return n.withColumn("unique", F.col("total") - F.col("duplicates")).withColumn("percentage", percentage("duplicates", "total"))


def trimming(parts: DataFrame) -> DataFrame:
    """sample, read_number, reads_input, reads_output, reads_with_adapter -> added, with percentages."""
    n = added(parts, ["sample", "read_number"], ["reads_input", "reads_output", "reads_with_adapter"])
    return n.withColumn("percentage_trimmed", percentage("reads_with_adapter", "reads_input")).withColumn("percentage_kept", percentage("reads_output", "reads_input"))


def merging(parts: DataFrame) -> DataFrame:
    """Combined and uncombined reads of file parts (``sample_part0``) -> by sample, with total and percentage."""
    named = parts.withColumn("sample", F.substring_index("sample", "_part", 1))
    n = added(named, ["sample"], ["combined", "uncombined"])
    return n.withColumn("total", F.col("combined") + F.col("uncombined")).withColumn("percentage", percentage("combined", "total"))


def histogram(df: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """by, value, n."""
    return df.groupBy(*by, value.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def histogram_map(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, hist: value -> n. For values of few kinds."""
    return counts.groupBy(*by).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("value", "n")))).alias("hist"))


def merged_histograms(maps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Histograms added value by value."""
    each = maps.select(*by, F.explode("hist").alias("value", "n")).groupBy(*by, "value").agg(F.sum("n").alias("n"))
    return histogram_map(each, by)


def digestion(slices: DataFrame, kept: DataFrame, reads: Sequence[str] = ("1", "2")) -> DataFrame:
    """Reads and slices before and after digestion, for each read of a pair, side by side."""
    count = lambda d, when: d.groupBy("read").agg(F.countDistinct("name").alias("reads"), F.count(F.lit(1)).alias("slices")).withColumn("when", F.lit(when))
    both = count(slices, "unfiltered").unionByName(count(kept, "filtered"))
    return both.groupBy("when").pivot("read", list(reads)).agg(F.first("reads").alias("reads"), F.first("slices").alias("slices")).na.fill(0)


def digestion_histograms(pieces: DataFrame, minimum: int) -> DataFrame:
    """kind, read, value, n: slices in a read before and after short ones are left out, and lengths of those kept.

    ``pieces``: name, read, length.
    """
    kept = pieces.where(F.col("length") >= minimum)
    size = lambda d, kind: histogram(d.groupBy("name", "read").agg(F.count(F.lit(1)).alias("k")), F.col("k"), ["read"]).select(F.lit(kind).alias("kind"), "read", "value", "n")
    lengths = histogram(kept, F.col("length").cast("long"), ["read"]).select(F.lit("lengths").alias("kind"), "read", "value", "n")
    return size(pieces, "unfiltered").unionByName(size(kept, "filtered")).unionByName(lengths)


def alignment_duplicates(parts: DataFrame) -> DataFrame:
    """sample, total and unique reads and slices -> with duplicates and percentages."""
    n = added(parts, ["sample"], ["total_reads", "unique_reads", "total_slices", "unique_slices"])
    for kind in ("reads", "slices"):
        n = n.withColumn(f"duplicated_{kind}", F.col(f"total_{kind}") - F.col(f"unique_{kind}"))
        n = n.withColumn(f"percentage_{kind}", percentage(f"duplicated_{kind}", f"total_{kind}"))
    return n


def run_report(stages: DataFrame, order: Sequence[str]) -> DataFrame:
    """stage, n of several stages -> with the share of the first and of the one before, by their order."""
    at = F.create_map(*[F.lit(x) for i, s in enumerate(order) for x in (s, i)])
    held = stages.withColumn("i", F.try_element_at(at, F.col("stage"))).where("i IS NOT NULL")
    listed = held.agg(F.sort_array(F.collect_list(F.struct("i", "stage", "n"))).alias("x"))  # as many rows as stages
    each = listed.select(F.col("x")[0]["n"].alias("all"), F.posexplode("x").alias("k", "s"), "x")
    before = F.get("x", F.col("k") - 1)["n"]
    share = lambda w: F.round(F.try_divide(F.col("s.n") * 100.0, w.cast("double")), 4)
    return each.select("s.stage", "s.n", share(F.col("all")).alias("percent_of_first"), share(before).alias("percent_of_previous"))


def long_form(df: DataFrame, keys: Sequence[str], values: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(list(keys), list(values), name, value)


def wide_form(df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column for each name, 0 where there is nothing."""
    return df.groupBy(*keys).pivot(name, list(names)).agg(F.sum(value)).na.fill(0, list(names))
