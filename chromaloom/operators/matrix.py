"""Sparse contact matrices: counting, the store, binning, merging, normalising, balancing.

Pixels are rows (sample, viewpoint, bin1_id, bin2_id, n) with bin1_id <= bin2_id. A store is a
folder partitioned by resolution and viewpoint, so a URI of a group is a partition predicate.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .intervals import at_least, overlaps

PIXEL = ["sample", "viewpoint", "bin1_id", "bin2_id"]


def with_viewpoint(df: DataFrame) -> DataFrame:
    """Slices of fragments with one capture name, as ``viewpoint``."""
    fragment = Window.partitionBy("parent_id")
    own = df.withColumn("viewpoint", F.max("capture").over(fragment)).withColumn("__least__", F.min("capture").over(fragment))
    return own.where("viewpoint = __least__").drop("__least__")


def count_pixels(
    df: DataFrame, sample: str = "bam", remove_viewpoint: bool = False, remove_exclusions: bool = False, subsample: float | None = None,
    seed: int = 0, within: bool = False, block: int = 256,
) -> DataFrame:
    """Fragments that hold both restriction fragments, for each pair of them (with ``within`` also of one with itself).

    Pairs are made within a row, from a fragment's sorted restriction fragments: no join. Of a fragment
    with many of them each two blocks of ``block`` are a row of its own, dealt over all tasks.
    """
    if remove_viewpoint:
        df = df.where("capture_count = 0")
    if remove_exclusions:
        df = df.where("NOT (exclusion <=> viewpoint) OR exclusion IS NULL")
    if subsample is not None:  # 28 bits of a hash that other engines have too
        drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("parent_id").cast("string"))), 1, 7), 16, 10).cast("long")
        df = df.where(drawn < int(subsample * (1 << 28)))
    rows = df.where("restriction_fragment IS NOT NULL AND viewpoint IS NOT NULL")
    held = rows.groupBy("parent_id", F.col(sample).alias("sample"), "viewpoint").agg(F.sort_array(F.collect_set("restriction_fragment")).alias("rf"))
    ahead = (lambda x, i: F.slice("rf", i + 1, F.size("rf"))) if within else (lambda x, i: F.slice("rf", i + 2, F.size("rf")))
    paired = lambda one, others: F.flatten(F.transform(one, lambda x, i: F.transform(others(x, i), lambda y: F.struct(x.alias("bin1_id"), y.alias("bin2_id")))))
    few = held.where(F.size("rf") <= block).select("sample", "viewpoint", F.explode(paired("rf", ahead)).alias("p"))
    last = F.floor((F.size("rf") - 1) / block).cast("int")
    many = held.where(F.size("rf") > block).select("*", F.explode(F.sequence(F.lit(0), last)).alias("i"), last.alias("last"))
    many = many.select("*", F.explode(F.sequence("i", "last")).alias("j"))
    part = lambda k: F.slice("rf", F.col(k) * block + 1, block)
    many = many.select("parent_id", "sample", "viewpoint", "i", "j", part("i").alias("rf"), part("j").alias("other")).repartition("parent_id", "i", "j")
    inner = F.when(F.col("i") == F.col("j"), paired("rf", ahead)).otherwise(paired("rf", lambda x, i: F.col("other")))
    each = few.unionByName(many.select("sample", "viewpoint", F.explode(inner).alias("p"))).select("sample", "viewpoint", "p.*")
    return each.groupBy(*PIXEL).agg(F.count(F.lit(1)).alias("n"))


def viewpoint_bins(viewpoints: DataFrame, bins: DataFrame) -> DataFrame:
    """viewpoint, bin_id, chrom of the bins that overlap each viewpoint."""
    hit = overlaps(viewpoints.select("chrom", "start_pos", "end_pos", F.lower("name").alias("viewpoint")), bins.select("chrom", "start_pos", "end_pos", "bin_id"))
    return hit.select("viewpoint", F.col("b_bin_id").alias("bin_id"), "chrom").distinct()


def interaction_totals(pixels: DataFrame, viewpoints: DataFrame, bins: DataFrame, assay: str = "capture") -> DataFrame:
    """sample, viewpoint, n_cis and n_total.

    Cis is a pixel with a bin on the viewpoint's chromosome, the viewpoint's own bins not counting
    (for tiled assays they do).
    """
    home = viewpoints.select(F.lower("name").alias("viewpoint"), F.col("chrom").alias("home")).distinct()
    own = viewpoint_bins(viewpoints, bins).select("viewpoint", "bin_id")
    where = bins.select("bin_id", "chrom")
    wide = pixels.join(home, "viewpoint")
    for side in ("1", "2"):
        place = where.select(F.col("bin_id").alias(f"bin{side}_id"), F.col("chrom").alias(f"chrom{side}"))
        mark = own.select("viewpoint", F.col("bin_id").alias(f"bin{side}_id"), F.lit(assay != "tiled").alias(f"own{side}"))
        wide = wide.join(place, f"bin{side}_id", "left").join(mark, ["viewpoint", f"bin{side}_id"], "left")
    cis = lambda s: (F.col(f"chrom{s}") == F.col("home")) & ~F.coalesce(f"own{s}", F.lit(False))
    is_cis = F.coalesce(cis("1"), F.lit(False)) | F.coalesce(cis("2"), F.lit(False))
    return wide.groupBy("sample", "viewpoint").agg(F.coalesce(F.sum(F.when(is_cis, F.col("n"))), F.lit(0)).alias("n_cis"), F.sum("n").alias("n_total"))


def merge_pixels(stores: Sequence[DataFrame]) -> DataFrame:
    """Counts of equal pixels of several stores added up."""
    out = stores[0]
    for other in stores[1:]:
        out = out.unionByName(other)
    return out.groupBy(*PIXEL).agg(F.sum("n").alias("n"))


def merge_metadata(rows: DataFrame) -> DataFrame:
    """Metadata of a group from several stores: texts from the last, lists united in order, numbers added.

    ``rows``: sample, viewpoint, source (their order), name, bins, n_cis, n_total.
    """
    lists = F.sort_array(F.collect_list(F.struct("source", "bins")))
    return rows.groupBy("sample", "viewpoint").agg(
        F.max_by("name", "source").alias("name"), F.array_distinct(F.flatten(F.transform(lists, lambda x: x["bins"]))).alias("bins"),
        F.sum("n_cis").alias("n_cis"), F.sum("n_total").alias("n_total"),
    )


def chrom_sizes(fragments: DataFrame) -> DataFrame:
    return fragments.groupBy("chrom").agg(F.max("end_pos").alias("size"))


def fixed_bins(sizes: DataFrame, width: int) -> DataFrame:
    """bin_id, chrom, start_pos, end_pos: chromosomes by name cut into bins of a width, numbered from 0."""
    before = Window.orderBy("chrom").rowsBetween(Window.unboundedPreceding, -1)  # one row a chromosome
    counted = sizes.withColumn("bins", F.ceil(F.col("size") / width)).withColumn("offset", F.coalesce(F.sum("bins").over(before), F.lit(0)))
    each = counted.select("chrom", "size", "offset", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("i"))
    start = F.col("i") * width
    return each.select((F.col("offset") + F.col("i")).alias("bin_id"), "chrom", start.alias("start_pos"), F.least(start + width, F.col("size")).alias("end_pos"))


def bins_by_midpoint(fragments: DataFrame, bins: DataFrame, width: int) -> DataFrame:
    """fragment_id, bin_id: the bin that holds the middle. Arithmetic and an equi-join, no range join."""
    middle = F.floor((F.col("start_pos") + F.col("end_pos")) / (2 * width))
    at = fragments.select(F.col("bin_id").alias("fragment_id"), "chrom", middle.alias("i"))
    numbered = bins.select("bin_id", "chrom", F.floor(F.col("start_pos") / width).alias("i"))
    return at.join(numbered, ["chrom", "i"]).select("fragment_id", "bin_id")


def bins_by_overlap(fragments: DataFrame, bins: DataFrame, fraction: float = 0.51) -> DataFrame:
    """fragment_id, bin_id: bins that hold at least a fraction of the fragment."""
    hit = overlaps(fragments.select("chrom", "start_pos", "end_pos", F.col("bin_id").alias("fragment_id")), bins)
    return hit.where(at_least(F.col("overlap"), F.col("end_pos") - F.col("start_pos"), fraction)).select("fragment_id", F.col("b_bin_id").alias("bin_id"))


def rebin(pixels: DataFrame, mapping: DataFrame) -> DataFrame:
    """Fragment pixels -> pixels of bins; pixels of fragments without a bin are left out."""
    for side in ("1", "2"):
        to = mapping.select(F.col("fragment_id").alias(f"bin{side}_id"), F.col("bin_id").alias(f"to{side}"))
        pixels = pixels.join(to, f"bin{side}_id")
    low, high = F.least("to1", "to2").alias("bin1_id"), F.greatest("to1", "to2").alias("bin2_id")
    return pixels.select("sample", "viewpoint", low, high, "n").groupBy(*PIXEL).agg(F.sum("n").alias("n"))


def bins_of_widths(fragments: DataFrame, widths: Sequence[int]) -> DataFrame:
    """resolution, bin_id, chrom, start_pos, end_pos of several widths, each numbered from 0."""
    sizes = chrom_sizes(fragments)
    return reduce(DataFrame.unionByName, [fixed_bins(sizes, w).select(F.lit(str(w)).alias("resolution"), "bin_id", "chrom", "start_pos", "end_pos") for w in widths])


def rebin_widths(pixels: DataFrame, fragments: DataFrame, widths: Sequence[int]) -> DataFrame:
    """Fragment pixels at several widths in one job, with ``resolution``: pixels meet each side's map once."""
    sizes = chrom_sizes(fragments)
    maps = [bins_by_midpoint(fragments, fixed_bins(sizes, w), w).select(F.lit(str(w)).alias("resolution"), "fragment_id", "bin_id") for w in widths]
    to = reduce(DataFrame.unionByName, maps)
    one = to.select("resolution", F.col("fragment_id").alias("bin1_id"), F.col("bin_id").alias("to1"))
    two = to.select("resolution", F.col("fragment_id").alias("bin2_id"), F.col("bin_id").alias("to2"))
    both = pixels.join(one, "bin1_id").join(two, ["resolution", "bin2_id"])
    low, high = F.least("to1", "to2").alias("bin1_id"), F.greatest("to1", "to2").alias("bin2_id")
    return both.select("resolution", "sample", "viewpoint", low, high, "n").groupBy("resolution", *PIXEL).agg(F.sum("n").alias("n"))


def write_bins(bins: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The bins of a store, once for each resolution; groups of a resolution share them."""
    bins.write.mode(mode).partitionBy("resolution").parquet(f"{path.rstrip('/')}-bins")


def read_bins(spark, store: str) -> DataFrame:
    """The bins of a store or of one of its groups."""
    path, _, group = store.partition("::")
    df = spark.read.parquet(f"{path.rstrip('/')}-bins").withColumn("resolution", F.col("resolution").cast("string"))
    return df.where(F.col("resolution") == group.rsplit("/", 1)[1]) if "/resolutions/" in group else df


def normalise(pixels: DataFrame, mapping: DataFrame, totals: DataFrame, scale: float = 1e6) -> DataFrame:
    """Counts over the fragments of both bins, over cis interactions, and over both."""
    per = mapping.groupBy("bin_id").agg(F.countDistinct("fragment_id").alias("k"))
    for side in ("1", "2"):
        pixels = pixels.join(per.select(F.col("bin_id").alias(f"bin{side}_id"), F.col("k").alias(f"k{side}")), f"bin{side}_id", "left")
    wide = pixels.join(totals.select("sample", "viewpoint", "n_cis"), ["sample", "viewpoint"], "left")
    by_rf = F.try_divide(F.col("n").cast("double"), (F.col("k1") + F.col("k2")).cast("double"))
    by_cis = F.try_divide(F.lit(scale), F.col("n_cis").cast("double"))
    return wide.select(*PIXEL, "n", by_rf.alias("n_rf_norm"), (F.col("n") * by_cis).alias("n_cis_norm"), (by_rf * by_cis).alias("n_cis_rf_norm"))


def write_store(pixels: DataFrame, path: str, resolution: int | str | None = "fragments", mode: str = "append") -> None:
    """Adds pixels to a store; with resolution None by their own ``resolution``."""
    held = pixels if resolution is None else pixels.withColumn("resolution", F.lit(str(resolution)))
    held.write.mode(mode).partitionBy("resolution", "viewpoint").parquet(path)


def store_uri(store: str, viewpoint: str | None = None, resolution: int | str | None = None) -> str:
    """``store::/viewpoint/resolutions/n``; a store that already names a group keeps it."""
    if "::" in store:
        return store
    if viewpoint is None:
        return store
    return f"{store}::/{viewpoint}" + ("" if resolution is None else f"/resolutions/{resolution}")


def read_store(spark, uri: str) -> DataFrame:
    """A store or one of its groups; only that group's files are read."""
    path, _, group = uri.partition("::")
    df = spark.read.parquet(path)
    if group:
        named = re.fullmatch(r"/([^/]+)(?:/resolutions/(.+))?", group)
        if not named:
            raise ValueError(f"no group {group}")
        df = df.where((F.col("viewpoint") == named[1]) & (F.col("resolution") == (named[2] or "fragments")))
    return df


def dense_region(pixels: DataFrame, bins: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """bin1_id, bin2_id, n for all pairs of a region's bins (bin_id), zeros too, both triangles.

    Where ``own`` bins (bin_id) are given, a viewpoint's, their rows and columns are 0. Rows are made where they
    are needed, from the region's first and last bin; regions may be of any size.
    """
    spark = pixels.sparkSession
    first, last = bins.agg(F.min("bin_id"), F.max("bin_id")).first()
    if first is None:
        return pixels.select("bin1_id", "bin2_id", "n").limit(0)
    region = bins.select("bin_id").distinct()
    n = last - first + 1
    rows = spark.range(first, last + 1, 1, max(1, min(n, n * n >> 20))).join(region, F.col("id") == F.col("bin_id"), "left_semi")
    grid = rows.select(F.col("id").alias("bin1_id"), F.explode(F.sequence(F.lit(first), F.lit(last))).alias("bin2_id"))
    grid = grid.join(region, F.col("bin2_id") == F.col("bin_id"), "left_semi")
    inside = (F.col("bin1_id").between(first, last)) & (F.col("bin2_id").between(first, last))
    px = pixels.where(inside).select("bin1_id", "bin2_id", "n")
    if own is not None:
        for side in ("1", "2"):
            px = px.join(own.select(F.col("bin_id").alias(f"bin{side}_id")), f"bin{side}_id", "left_anti")
    mirrored = px.select("bin1_id", "bin2_id", "n").unionByName(px.where("bin1_id <> bin2_id").select(F.col("bin2_id").alias("bin1_id"), F.col("bin1_id").alias("bin2_id"), "n"))
    summed = mirrored.groupBy("bin1_id", "bin2_id").agg(F.sum("n").alias("n"))
    return grid.join(summed, ["bin1_id", "bin2_id"], "left").select("bin1_id", "bin2_id", F.coalesce("n", F.lit(0)).alias("n"))


def average_matrices(pixels: DataFrame, n_samples: int, how: str = "mean") -> DataFrame:
    """viewpoint, bin1_id, bin2_id, value: sum, mean or median over samples, a missing pixel being 0."""
    held = pixels.groupBy("viewpoint", "bin1_id", "bin2_id").agg(F.sum("n").alias("total"), F.sort_array(F.collect_list("n")).alias("each"))
    if how == "sum":
        value = F.col("total").cast("double")
    elif how == "mean":
        value = F.col("total") / F.lit(float(n_samples))
    elif how == "median":  # zeros stand before the counts
        zeros = F.lit(n_samples) - F.size("each")
        at = lambda i: F.when(F.lit(i) < zeros, F.lit(0)).otherwise(F.get("each", F.lit(i) - zeros))
        value = (at((n_samples - 1) // 2) + at(n_samples // 2)) / 2.0
    else:
        raise ValueError(f"no way to combine called {how}")
    return held.select("viewpoint", "bin1_id", "bin2_id", value.alias("value"))


def _balanced(one: np.ndarray, two: np.ndarray, n: np.ndarray, iterations: int, tolerance: float) -> tuple[np.ndarray, float]:
    """Balanced pixels of one matrix, and how far a bin's sum is from the mean sum at most, as a share of it."""
    bins, at = np.unique(np.concatenate([one, two]), return_inverse=True)
    i, j = at[: len(one)], at[len(one) :]
    apart = i != j  # a pixel on the diagonal counts once
    value = n.astype(float)
    for k in range(iterations + 1):
        sums = np.bincount(i, value, len(bins)) + np.bincount(j, value * apart, len(bins))
        mean = sums.mean()
        if mean <= 0:
            return value, 0.0
        if k == 0:
            before = mean
        value = value * (before / mean)
        bias = sums / mean
        deviation = float(np.abs(bias - 1).max())
        if deviation <= tolerance or k == iterations:
            return value, deviation
        root = np.sqrt(np.where(bias > 0, bias, 1.0))
        value = value / (root[i] * root[j])


def balance(pixels: DataFrame, iterations: int = 200, by: Sequence[str] = ("sample", "viewpoint"), tolerance: float = 1e-3) -> DataFrame:
    """Iterative correction: pixels with ``balanced``, in which all bins of a matrix have equal sums, of the mean they had.

    In each round every pixel is divided by the root of the biases of its bins, their sums over the
    mean sum, until no sum is further from the mean than ``tolerance``, as a share of it. That share
    comes out as ``deviation``: some sparse matrices, such as a star, can't be balanced, and end after
    ``iterations`` rounds above the tolerance. A task holds one matrix's pixels.
    """

    def run(matrix: pd.DataFrame) -> pd.DataFrame:
        matrix = matrix.sort_values(["bin1_id", "bin2_id"])  # sums don't depend on the order of arrival
        value, deviation = _balanced(*(matrix[c].to_numpy() for c in ("bin1_id", "bin2_id", "n")), iterations, tolerance)
        return matrix.assign(balanced=value, deviation=deviation)

    schema = StructType([*pixels.schema.fields, StructField("balanced", DoubleType()), StructField("deviation", DoubleType())])
    return pixels.groupBy(*by).applyInPandas(run, schema)


def balance_per_cis(pixels: DataFrame, totals: DataFrame, scale: float = 1e6, **options: object) -> DataFrame:
    """``balance``, for each ``scale`` cis interactions of the matrix (totals: sample, viewpoint, n_cis); NULL without any."""
    wide = balance(pixels, **options).join(totals.select("sample", "viewpoint", "n_cis"), ["sample", "viewpoint"], "left")
    return wide.withColumn("balanced", F.try_divide(F.col("balanced"), F.col("n_cis").cast("double")) * scale).drop("n_cis")


def balance_by_factor(pixels: DataFrame, factor: float, **options: object) -> DataFrame:
    """``balance``, divided by a scaling factor."""
    return balance(pixels, **options).withColumn("balanced", F.col("balanced") / F.lit(float(factor)))


def without_viewpoint(pixels: DataFrame, own: DataFrame) -> DataFrame:
    """Pixels without a bin of their viewpoint's own (viewpoint, bin_id)."""
    for side in ("1", "2"):
        pixels = pixels.join(own.select("viewpoint", F.col("bin_id").alias(f"bin{side}_id")).distinct(), ["viewpoint", f"bin{side}_id"], "left_anti")
    return pixels
