"""Profiles of viewpoints (bedgraphs), their normalisation, and comparisons between samples."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import fit
from .intervals import cluster_intervals, overlaps

PLACE = ["chrom", "start_pos", "end_pos"]
TRACK = ["sample", "viewpoint"]


def reporters(pixels: DataFrame, own: DataFrame) -> DataFrame:
    """sample, viewpoint, capture, reporter, n: pixels with a bin of the viewpoint's own (viewpoint, bin_id).

    A pixel between two of these comes out twice, once for each.
    """
    for side in ("1", "2"):
        mark = own.select("viewpoint", F.col("bin_id").alias(f"bin{side}_id"), F.lit(1).alias(f"own{side}")).distinct()
        pixels = pixels.join(mark, ["viewpoint", f"bin{side}_id"], "left")
    one, two = F.coalesce("own1", F.lit(0)), F.coalesce("own2", F.lit(0))
    kept = pixels.where(one + two > 0)
    capture, other = F.when(one == 1, F.col("bin1_id")).otherwise(F.col("bin2_id")), F.when(one == 1, F.col("bin2_id")).otherwise(F.col("bin1_id"))
    times = F.explode(F.sequence(F.lit(1), one + two)).alias("k")
    return kept.select(*TRACK, capture.alias("capture"), other.alias("reporter"), "n", times).drop("k")


def bedgraph(found: DataFrame, bins: DataFrame) -> DataFrame:
    """sample, viewpoint, chrom, start_pos, end_pos, n: counts at the reporters' bins."""
    at = bins.select(F.col("bin_id").alias("reporter"), *PLACE)
    return found.join(at, "reporter").groupBy(*TRACK, *PLACE).agg(F.sum("n").alias("n"))


def bedgraph_dense(found: DataFrame, bins: DataFrame, sample: str, viewpoint: str) -> DataFrame:
    """One profile over all bins, 0 where there is nothing."""
    own = found.where((F.col("sample") == sample) & (F.col("viewpoint") == viewpoint)).groupBy("reporter").agg(F.sum("n").alias("n"))
    return bins.join(own, F.col("bin_id") == F.col("reporter"), "left").select(*PLACE, F.coalesce("n", F.lit(0)).alias("n"))


def bedgraph_clustered(track: DataFrame, slack: int = 0) -> DataFrame:
    """Counts of intervals that overlap or touch added up, for viewpoints of several bins."""
    runs = cluster_intervals(track, slack, [*TRACK, "chrom"]).groupBy(*TRACK, "chrom", "cluster")
    return runs.agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.sum("n").alias("n")).drop("cluster")


def normalise_cis(track: DataFrame, totals: DataFrame, scale: float = 1e6) -> DataFrame:
    """Counts for each ``scale`` cis interactions."""
    wide = track.join(totals.select(*TRACK, "n_cis"), TRACK)
    return wide.withColumn("n", F.try_divide(F.col("n").cast("double"), F.col("n_cis").cast("double")) * scale).drop("n_cis")


def normalise_regions(track: DataFrame, regions: DataFrame, scale: float = 1e6) -> DataFrame:
    """Counts for each ``scale`` counts in the viewpoint's regions (viewpoint, chrom, start_pos, end_pos).

    An interval counts for a region on whose closed span it starts, for each such region.
    """
    spans = regions.select("viewpoint", "chrom", F.col("start_pos").alias("from"), F.col("end_pos").alias("to"))
    inside = track.join(spans, ["viewpoint", "chrom"]).where("start_pos BETWEEN `from` AND `to`")
    total = inside.groupBy(*TRACK).agg(F.sum("n").alias("total"))
    return track.join(total, TRACK).withColumn("n", F.try_divide(F.col("n").cast("double"), F.col("total").cast("double")) * scale).drop("total")


def within(track: DataFrame, chrom: str, start: int, end: int) -> DataFrame:
    """What overlaps a region; a predicate that reaches the scan."""
    return track.where((F.col("chrom") == chrom) & (F.col("start_pos") < end) & (F.col("end_pos") > start))


def near_viewpoint(track: DataFrame, viewpoints: DataFrame, distance: int) -> DataFrame:
    """What overlaps the surroundings of its own viewpoint."""
    own = viewpoints.select(F.lower("name").alias("viewpoint"), "chrom", (F.col("start_pos") - distance).alias("from"), (F.col("end_pos") + distance).alias("to"))
    return track.join(own, ["viewpoint", "chrom"]).where("start_pos < `to` AND end_pos > `from`").select(track.columns)


def windowed(track: DataFrame, bins: DataFrame) -> DataFrame:
    """The profile over wider bins: each interval's count goes to bins in proportion to the overlap."""
    hit = overlaps(track, bins.select(*PLACE))
    share = F.col("n") * F.col("overlap") / (F.col("end_pos") - F.col("start_pos"))
    return hit.groupBy(*TRACK, "b_chrom", "b_start_pos", "b_end_pos").agg(F.sum(share).alias("n")).withColumnsRenamed({f"b_{c}": c for c in PLACE})


def smoothed(track: DataFrame, half: int = 1) -> DataFrame:
    """Centred moving average over neighbouring intervals."""
    near = Window.partitionBy(*TRACK, "chrom").orderBy("start_pos").rowsBetween(-half, half)
    return track.withColumn("n", F.avg("n").over(near))


def every_nth(track: DataFrame, n: int) -> DataFrame:
    """The first of every n intervals of a chromosome."""
    order = Window.partitionBy(*TRACK, "chrom").orderBy("start_pos", "end_pos")
    return track.withColumn("__i__", F.row_number().over(order) - 1).where(F.col("__i__") % n == 0).drop("__i__")


def arithmetic(a: DataFrame, b: DataFrame | float, operation: str) -> DataFrame:
    """a + - * / b, another profile (by place; 0 where one has nothing) or a number; NULL for x / 0."""
    left = a.select(*TRACK, *PLACE, F.col("n").cast("double").alias("a"))
    if isinstance(b, DataFrame):
        both = left.join(b.select(*TRACK, *PLACE, F.col("n").cast("double").alias("b")), [*TRACK, *PLACE], "full").na.fill(0.0, ["a", "b"])
    else:
        both = left.withColumn("b", F.lit(float(b)))
    x, y = F.col("a"), F.col("b")
    value = {"+": x + y, "-": x - y, "*": x * y, "/": F.try_divide(x, y)}[operation]
    return both.select(*TRACK, *PLACE, value.alias("n"))


# Comparisons: profiles of several samples in long form, with a table of samples (sample, condition).


def condition_means(track: DataFrame, design: DataFrame) -> DataFrame:
    """viewpoint, place, condition, mean over all of the condition's samples, one without a count being 0."""
    size = design.groupBy("condition").agg(F.count(F.lit(1)).alias("k"))
    own = track.join(design, "sample").groupBy("viewpoint", *PLACE, "condition").agg(F.sum("n").alias("n"))
    return own.join(size, "condition").select("viewpoint", *PLACE, "condition", (F.col("n") / F.col("k")).alias("mean"))


def summarise(track: DataFrame, design: DataFrame, how: str = "mean") -> DataFrame:
    """As condition_means by another summary: mean, sum, max, min, median or std, over all samples with zeros."""
    if how == "mean":
        return condition_means(track, design).withColumnRenamed("mean", "value")
    size = design.groupBy("condition").agg(F.count(F.lit(1)).alias("k"))
    own = track.join(design, "sample").groupBy("viewpoint", *PLACE, "condition").agg(F.collect_list(F.col("n").cast("double")).alias("x"))
    padded = F.sort_array(F.concat("x", F.array_repeat(F.lit(0.0), (F.col("k") - F.size("x")).cast("int"))))
    wide = own.join(size, "condition").withColumn("x", padded)
    total = F.aggregate("x", F.lit(0.0), lambda s, v: s + v)
    mean = total / F.col("k")
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean))
    middle = lambda i: F.get("x", i.cast("int"))
    value = {
        "sum": total, "min": F.array_min("x"), "max": F.array_max("x"),
        "median": (middle(F.floor((F.col("k") - 1) / 2)) + middle(F.floor(F.col("k") / 2))) / 2, "std": F.sqrt(square / F.col("k")),
    }[how]
    return wide.select("viewpoint", *PLACE, "condition", value.alias("value"))


def subtractions(means: DataFrame) -> DataFrame:
    """viewpoint, place, a, b, difference: for each ordered pair of conditions, 0 where one has nothing."""
    held = means.groupBy("viewpoint", *PLACE).agg(F.map_from_entries(F.collect_list(F.struct("condition", "mean"))).alias("m"))
    # few conditions: bounded by the design
    names = sorted(r[0] for r in means.select("condition").distinct().limit(201).collect())
    if len(names) > 200:
        raise ValueError("more than 200 conditions")
    pairs = [(a, b) for a in names for b in names if a != b]
    if not pairs:
        return means.select("viewpoint", *PLACE, F.lit("").alias("a"), F.lit("").alias("b"), F.col("mean").alias("difference")).limit(0)
    each = held.withColumn("p", F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])))
    at = lambda k: F.coalesce(F.try_element_at("m", F.col(f"p.{k}")), F.lit(0.0))
    some = F.map_contains_key("m", F.col("p.a")) | F.map_contains_key("m", F.col("p.b"))
    return each.where(some).select("viewpoint", *PLACE, "p.a", "p.b", (at("a") - at("b")).alias("difference"))


def replicates(track: DataFrame, design: DataFrame) -> DataFrame:
    """viewpoint, place, condition, mean and standard error over the samples that have a count."""
    own = track.join(design, "sample").groupBy("viewpoint", *PLACE, "condition")
    error = F.stddev_samp("n") / F.sqrt(F.count(F.lit(1)))
    return own.agg(F.avg("n").alias("mean"), error.alias("sem"), F.count(F.lit(1)).alias("k"))


def counts_over(track: DataFrame, n_samples: int, threshold: int) -> DataFrame:
    """Counts at places where every sample has the threshold at least."""
    over = F.count_if(F.col("n") >= threshold).over(Window.partitionBy("viewpoint", *PLACE))
    return track.withColumn("__k__", over).where(F.col("__k__") == n_samples).drop("__k__")


def size_factors(counts: DataFrame) -> DataFrame:
    """viewpoint, sample, factor: the median over places of the count over the geometric mean of all samples."""
    mean = F.avg(F.log("n")).over(Window.partitionBy("viewpoint", *PLACE))
    ratio = counts.where("n > 0").withColumn("ratio", F.log("n") - mean)
    return ratio.groupBy("viewpoint", "sample").agg(F.exp(F.percentile("ratio", F.lit(0.5))).alias("factor"))


@dataclass(frozen=True)
class Model:
    """``least_width``: the standard deviation of log changes that the prior has at least."""

    least_width: float = 1e-3


@F.pandas_udf(DoubleType())
def _two_sided(z: pd.Series) -> pd.Series:
    return z.map(lambda x: None if x is None or math.isnan(x) else math.erfc(abs(x) / math.sqrt(2)))


def adjusted(p: str, by: Sequence[str]) -> Column:
    """p times the tests over those with as small a p, within groups; its running minimum from above is
    Benjamini and Hochberg's adjusted p."""
    group = Window.partitionBy(*by)
    as_small = F.count(p).over(group.orderBy(p).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return F.col(p) * F.count(p).over(group) / as_small


def conditions_side_by_side(counts: DataFrame, design: DataFrame, a: str, b: str) -> DataFrame:
    """viewpoint, place, n, factor: arrays over all samples of a, then of b, by name; a sample without a count has 0.

    Arrays are as long as the two conditions have samples. Size factors are those of the two conditions' samples,
    1 for a sample without any count of the viewpoint.
    """
    two = design.where(F.col("condition").isin(a, b)).select("sample", (F.col("condition") == b).cast("int").alias("side"))
    own = counts.join(two, "sample")
    factors = size_factors(own.select(counts.columns))
    held = factors.groupBy("viewpoint").agg(F.map_from_entries(F.collect_list(F.struct("sample", "factor"))).alias("factors"))
    # a row for the design, an array as long as it
    order = two.agg(F.sort_array(F.collect_list(F.struct("side", "sample"))).alias("order"))
    per = own.groupBy("viewpoint", *PLACE).agg(F.map_from_entries(F.collect_list(F.struct("sample", F.col("n").cast("double")))).alias("told"))
    wide = per.join(held, "viewpoint").join(order)  # one row
    at = lambda m, d: F.transform("order", lambda o: F.coalesce(F.try_element_at(F.col(m), o["sample"]), F.lit(d)))
    return wide.select("viewpoint", *PLACE, at("told", 0.0).alias("n"), at("factors", 1.0).alias("factor"), F.col("order.side").alias("side"))


def differential(counts: DataFrame, design: DataFrame, a: str, b: str, most: float | None = None, model: Model = Model()) -> DataFrame:
    """Negative binomial test of condition b against a at each place.

    A sample of the design without a count at a place has 0 there. The dispersion of a place is fitted by
    likelihood, drawn towards a trend over the viewpoint's means, and kept where it is far above it. The
    test is Wald's on the log ratio of the fitted means, of which each is half a count in all its samples at
    least, so that places which one condition lacks are tested too. ``shrunken`` is the log2 fold change drawn
    to 0 by a normal prior as wide as the viewpoint's changes. P values are adjusted by Benjamini and Hochberg's
    way; with ``most`` only places up to that adjusted p are left. Without a sample of both conditions: no rows.

    Fits are by place; a task holds of a viewpoint no more than a mean and a dispersion of each place.
    """
    wide = conditions_side_by_side(counts, design, a, b).where("exists(side, x -> x = 0) AND exists(side, x -> x = 1) AND exists(n, x -> x > 0)")
    own = wide.withColumn("f", fit.own_dispersion("n", "factor", "side")).select("*", "f.*").drop("f")
    trend = own.select("viewpoint", "base_mean", "own").groupBy("viewpoint").applyInPandas(fit.trend, "viewpoint string, asymptote double, slope double, spread double")
    drawn = own.join(trend, "viewpoint").withColumn("t", fit.tested("n", "factor", "side", "own", "base_mean", "asymptote", "slope", "spread")).select("*", "t.*").drop("t")
    width = drawn.groupBy("viewpoint").agg((F.percentile(F.abs("change"), F.lit(0.95)) / 1.96).alias("width"))
    variance = F.greatest(F.col("width"), F.lit(model.least_width)) ** 2
    wider = drawn.join(width, "viewpoint").withColumn("shrunken", F.col("change") * variance / (variance + F.col("error") ** 2))
    tested = wider.withColumn("p_value", _two_sided(F.col("change") / F.col("error")))
    ratio = tested.withColumn("ratio", adjusted("p_value", ["viewpoint"]))
    after = Window.partitionBy("viewpoint").orderBy("p_value").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    log2 = lambda c: (F.col(c) / math.log(2))
    out = ratio.select(
        "viewpoint", *PLACE, "mean_a", "mean_b", log2("change").alias("log2_fold_change"), log2("error").alias("standard_error"), log2("shrunken").alias("shrunken"),
        "dispersion", "p_value", F.least(F.min("ratio").over(after), F.lit(1.0)).alias("p_adjusted"),
    )
    return out if most is None else out.where(F.col("p_adjusted") <= most)


def differential_pairs(counts: DataFrame, design: DataFrame, most: float | None = None, over: int | None = None, limit: int = 200) -> DataFrame:
    """``differential`` of every pair of the design's conditions, with a and b; with ``over`` only places where
    every sample of the design has so many counts. Conditions come to the driver, ``limit`` of them at most."""
    names = sorted((r[0] for r in design.select("condition").distinct().limit(limit + 1).collect()), reverse=True)
    if len(names) > limit:
        raise ValueError(f"more than {limit} conditions")
    if over is not None:
        counts = counts_over(counts.join(design.select("sample").distinct(), "sample", "left_semi"), design.select("sample").distinct().count(), over)
    pairs = list(combinations(names, 2)) or [("", "")]  # without a pair there is no row
    return reduce(DataFrame.unionByName, [differential(counts, design, a, b, most).withColumns({"a": F.lit(a), "b": F.lit(b)}) for a, b in pairs])


def parse_groups(columns: Sequence[str], names: str, members: str) -> dict[str, str]:
    """Column -> group, from lists such as ``A,B`` and ``a1,a2;b1`` (columns or their numbers from 0)."""
    import re

    groups = [n for n in re.split(r"[,;\s]+", names.strip()) if n]
    parts = [p for p in members.split(";") if p.strip()]
    if len(groups) != len(parts):
        raise ValueError(f"{len(groups)} names for {len(parts)} groups")
    out = {}
    for group, part in zip(groups, parts):
        for member in re.split(r"[,\s]+", part.strip()):
            out[columns[int(member)] if member.isdigit() else member] = group
    return out
