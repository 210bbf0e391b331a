"""Joins and arithmetic of half-open intervals (chrom, start_pos, end_pos).

Overlap joins are equi-joins on (chrom, bucket): each interval is placed in all buckets that it
touches, and a pair is taken in the bucket where the later of the two begins, so it comes out once
and no pair is tested that isn't near. Spark broadcasts the other side if it is small enough, or
sorts and merges; neither compares whole chromosomes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settled

BUCKET = 4096


def _bucketed(df: DataFrame, width: int) -> DataFrame:
    """Empty intervals touch no bucket."""
    some = df.where("end_pos > start_pos AND chrom IS NOT NULL")
    first, last = F.floor(F.col("start_pos") / width), F.floor((F.col("end_pos") - 1) / width)
    return some.withColumn("__bucket__", F.explode(F.sequence(first, last)))


def overlaps(a: DataFrame, b: DataFrame, width: int = BUCKET, same: Sequence[str] = ()) -> DataFrame:
    """All pairs that share a base (and the columns ``same``): a's columns, b's with prefix ``b_``, and ``overlap``."""
    right = _bucketed(b, width)
    right = right.select(*[F.col(c).alias(f"b_{c}") for c in b.columns], F.col("__bucket__").alias("b___bucket__"))
    left = _bucketed(a, width)
    start, end = F.greatest("start_pos", "b_start_pos"), F.least("end_pos", "b_end_pos")
    equal = (F.col("chrom") == F.col("b_chrom")) & (F.col("__bucket__") == F.col("b___bucket__"))
    for c in same:
        equal = equal & F.col(c).eqNullSafe(F.col(f"b_{c}"))
    near = (F.col("start_pos") < F.col("b_end_pos")) & (F.col("b_start_pos") < F.col("end_pos"))
    once = F.col("__bucket__") == F.floor(start / width)
    return left.join(right, equal & near & once).withColumn("overlap", end - start).drop("__bucket__", "b___bucket__")


def at_least(part: Column, whole: Column, fraction: float) -> Column:
    """part / whole >= fraction, in whole numbers."""
    f = Fraction(str(fraction))
    return part * F.lit(f.denominator) >= whole * F.lit(f.numerator)


def annotate_get(a: DataFrame, key: str, b: DataFrame, name: str, fraction: float = 0.0, width: int = BUCKET) -> DataFrame:
    """a with ``name``: the name of each interval of b that covers enough of it; NULL if there is none.

    ``fraction`` is of a's length and holds for each pair. Several names give several rows.
    """
    pairs = overlaps(a.select(key, "chrom", "start_pos", "end_pos"), b.select("chrom", "start_pos", "end_pos", "name"), width)
    enough = pairs.where(at_least(F.col("overlap"), F.col("end_pos") - F.col("start_pos"), fraction))
    return a.join(enough.select(key, F.col("b_name").alias(name)), key, "left")


def annotate_best(a: DataFrame, key: str, b: DataFrame, name: str, fraction: float = 0.0, width: int = BUCKET) -> DataFrame:
    """As annotate_get with one row for each of a: the largest overlap, then the smallest name."""
    pairs = overlaps(a.select(key, "chrom", "start_pos", "end_pos"), b.select("chrom", "start_pos", "end_pos", "name"), width)
    enough = pairs.where(at_least(F.col("overlap"), F.col("end_pos") - F.col("start_pos"), fraction))
    best = enough.groupBy(key).agg(F.min_by("b_name", F.struct(-F.col("overlap"), "b_name")).alias(name))
    return a.join(best, key, "left")


def annotate_count(a: DataFrame, key: str, b: DataFrame, name: str, fraction: float = 0.0, width: int = BUCKET) -> DataFrame:
    """a with ``name``: how many intervals of b overlap it, where b as a whole covers enough of it; else 0."""
    place = a.select(key, "chrom", "start_pos", "end_pos")
    bare = b.select("chrom", "start_pos", "end_pos")
    count = overlaps(place, bare, width).groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("__n__"))
    covered = overlaps(place, merge_intervals(bare), width)
    covered = covered.groupBy(key).agg(F.sum("overlap").alias("__covered__"), F.first(F.col("end_pos") - F.col("start_pos")).alias("__length__"))
    kept = count.join(covered, key).where(at_least(F.col("__covered__"), F.col("__length__"), fraction))
    return a.join(kept.select(key, F.col("__n__").alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def _summaries(a: DataFrame, key: str, specs: Sequence[Mapping], width: int) -> DataFrame:
    """key and a column for each best or count: all sets of intervals go through one overlap join and one aggregation."""
    sets = []
    for k, spec in enumerate(specs):
        b = spec["b"]
        name = F.col("name").cast("string") if spec["action"] == "best" else F.lit(None).cast("string")
        sets.append(b.select("chrom", "start_pos", "end_pos", name.alias("name"), F.lit(2 * k).alias("k")))
        if spec["action"] == "count":
            sets.append(merge_intervals(b).select("chrom", "start_pos", "end_pos", F.lit(None).cast("string").alias("name"), F.lit(2 * k + 1).alias("k")))
    pairs = overlaps(a.select(key, "chrom", "start_pos", "end_pos"), reduce(DataFrame.unionByName, sets), width)
    length = F.col("end_pos") - F.col("start_pos")
    states, out = [], [F.col(key)]
    for k, spec in enumerate(specs):
        of = F.col("b_k") == 2 * k
        if spec["action"] == "best":
            kind = spec["b"].schema["name"].dataType
            named = F.col("b_name").cast(kind)
            states.append(F.min_by(F.when(of, named), F.when(of & at_least(F.col("overlap"), length, spec.get("fraction", 0.0)), F.struct(-F.col("overlap"), named))).alias(f"s{k}"))
            out.append(F.col(f"s{k}").alias(spec["name"]))
        else:
            states += [F.count_if(of).cast("int").alias(f"s{k}"), F.coalesce(F.sum(F.when(F.col("b_k") == 2 * k + 1, F.col("overlap"))), F.lit(0)).alias(f"c{k}")]
            out.append(F.when(at_least(F.col(f"c{k}"), F.col("__length__"), spec.get("fraction", 0.0)), F.col(f"s{k}")).alias(spec["name"]))
    return pairs.groupBy(key).agg(F.first(length).alias("__length__"), *states).select(*out)


def annotate_many(a: DataFrame, key: str, specs: Sequence[Mapping], width: int = BUCKET) -> DataFrame:
    """Several annotations: each a mapping of action (get, best or count), b, name and fraction.

    Those that give a row for each row of a are made in one pass; each get may give several rows. Where
    there are several passes, a is written to the shared folder before, so that it is made once.
    """
    single = [s for s in specs if s["action"] != "get"]
    passes = len(specs) - len(single) + bool(single)
    a = settled(a, "to-annotate") if passes > 1 else a
    read = [id(s["b"]) for s in specs for _ in range(2 if s["action"] == "count" else 1)]
    made = {i: settled(s["b"], "annotation") for i, s in {id(s["b"]): s for s in specs}.items() if read.count(i) > 1}
    specs = [{**s, "b": made.get(id(s["b"]), s["b"])} for s in specs]
    single = [s for s in specs if s["action"] != "get"]
    out = a
    for spec in specs:
        if spec["action"] == "get":
            out = annotate_get(out, key, spec["b"], spec["name"], spec.get("fraction", 0.0), width) if out is a else out.join(
                annotate_get(a.select(key, "chrom", "start_pos", "end_pos"), key, spec["b"], spec["name"], spec.get("fraction", 0.0), width).select(key, spec["name"]), key, "left"
            )
    if single:
        out = out.join(_summaries(a, key, single, width), key, "left")
    counts = {s["name"]: F.coalesce(s["name"], F.lit(0)) for s in single if s["action"] == "count"}
    return out.withColumns(counts).select(*a.columns, *[s["name"] for s in specs]) if specs else a


#: Name, action and least overlap of the usual annotations. Fixed values.
ANNOTATION_DEFAULTS = (
    ("restriction_fragment", "get", 0.51),
    ("capture", "get", 0.75),
    ("exclusion", "get", 1e-9),
    ("exclusion_count", "count", 1e-9),
    ("capture_count", "count", 0.75),
    ("blacklist", "count", 1e-9),
)


#: Intervals that start within a stretch of this many bases are taken by one task.
STRETCH = 1 << 18


def _before(summary: DataFrame, by: Sequence[str], value: Column, name: str) -> DataFrame:
    """by, __stretch__ and ``value`` over the earlier stretches; a row for each stretch, so by their number at most in a task."""
    earlier = Window.partitionBy(*by).orderBy("__stretch__").rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(*[F.col(c).alias(f"__{c}__") for c in by], F.col("__stretch__").alias("__at__"), value.over(earlier).alias(name))


def _with_before(df: DataFrame, before: DataFrame, by: Sequence[str]) -> DataFrame:
    same = F.col("__stretch__").eqNullSafe(F.col("__at__"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}__"))
    return df.join(before, same, "left").drop("__at__", *[f"__{c}__" for c in by])


def cluster_intervals(df: DataFrame, slack: int = 0, by: Sequence[str] = ("chrom",)) -> DataFrame:
    """df with ``cluster``, a number for each chrom (or other ``by``) and run of intervals that overlap or come within slack.

    With slack 0 touching intervals are one cluster, with -1 they aren't. Windows are over stretches of
    a chromosome; from stretch to stretch only how far intervals reach and how many clusters began is
    carried on.
    """
    by = list(by)
    parts = df.withColumn("__stretch__", F.floor(F.col("start_pos") / STRETCH))
    keys = [*by, "__stretch__"]
    order = Window.partitionBy(*keys).orderBy("start_pos", "end_pos")
    near = F.max("end_pos").over(order.rowsBetween(Window.unboundedPreceding, -1))
    far = _before(parts.groupBy(*keys).agg(F.max("end_pos").alias("__end__")), by, F.max("__end__"), "__reach__")
    reach = F.greatest("__near__", "__reach__")  # NULL only where both are
    begins = F.when(reach.isNull() | (F.col("start_pos") > reach + slack), 1).otherwise(0)
    begun = _with_before(parts.withColumn("__near__", near), far, by).withColumn("__begins__", begins).drop("__near__", "__reach__")
    earlier = _before(begun.groupBy(*keys).agg(F.sum("__begins__").alias("__n__")), by, F.sum("__n__"), "__earlier__")
    own = F.sum("__begins__").over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = _with_before(begun.withColumn("__own__", own), earlier, by)
    return numbered.withColumn("cluster", F.coalesce("__earlier__", F.lit(0)) + F.col("__own__")).drop("__begins__", "__own__", "__earlier__", "__stretch__")


def _local_clusters(df: DataFrame, slack: int, by: Sequence[str]) -> DataFrame:
    order = Window.partitionBy(*by).orderBy("start_pos", "end_pos")
    reach = F.max("end_pos").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("start_pos") > reach + slack), 1).otherwise(0)
    return df.withColumn("__begins__", begins).withColumn("cluster", F.sum("__begins__").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__begins__")


def merge_intervals(df: DataFrame, slack: int = 0) -> DataFrame:
    """The union of the intervals: chrom, start_pos, end_pos without overlaps.

    Intervals that start on one stretch of a chromosome are merged first, so that a whole chromosome
    only meets what is left of them.
    """
    some = df.where("end_pos > start_pos AND chrom IS NOT NULL").select("chrom", "start_pos", "end_pos")
    whole = [F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")]
    stretches = some.withColumn("stretch", F.floor(F.col("start_pos") / STRETCH))
    local = _local_clusters(stretches, slack, ("chrom", "stretch")).groupBy("chrom", "stretch", "cluster").agg(*whole)
    return _local_clusters(local.select("chrom", "start_pos", "end_pos"), slack, ("chrom",)).groupBy("chrom", "cluster").agg(*whole).drop("cluster")


def slop(df: DataFrame, by: int, sizes: DataFrame | None = None) -> DataFrame:
    """Intervals grown to either side, within their chromosome (sizes: chrom, size)."""
    grown = df.withColumn("start_pos", F.greatest(F.col("start_pos") - by, F.lit(0))).withColumn("end_pos", F.col("end_pos") + by)
    if sizes is None:
        return grown
    sized = grown.join(sizes.select("chrom", F.col("size").alias("__size__")), "chrom", "left")
    return sized.withColumn("end_pos", F.least("end_pos", F.coalesce("__size__", "end_pos"))).drop("__size__").select(df.columns)


def subtract(a: DataFrame, key: str, b: DataFrame, width: int = BUCKET) -> DataFrame:
    """What is left of each interval of a outside b: no, one or several rows with a's other columns."""
    place = a.select(key, "chrom", "start_pos", "end_pos")
    cut = overlaps(place, merge_intervals(b), width)
    holes = cut.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col("b_start_pos").alias("s"), F.col("b_end_pos").alias("e")))).alias("holes"))
    both = a.join(holes, key, "left").withColumn("holes", F.coalesce("holes", F.expr("array()").cast("array<struct<s:bigint,e:bigint>>")))
    starts, ends = F.concat(F.array("start_pos"), F.col("holes.e")), F.concat(F.col("holes.s"), F.array("end_pos"))
    pieces = both.withColumn("__piece__", F.explode(F.arrays_zip(starts.alias("s"), ends.alias("e"))))
    pieces = pieces.withColumn("start_pos", F.col("__piece__.s")).withColumn("end_pos", F.col("__piece__.e"))
    return pieces.where("end_pos > start_pos").select(a.columns)


def exclusion_zones(viewpoints: DataFrame, by: int = 1000, sizes: DataFrame | None = None) -> DataFrame:
    """The surroundings of viewpoints without any viewpoint."""
    return subtract(slop(viewpoints, by, sizes), "name", viewpoints)


def union_segments(df: DataFrame, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by, chrom, start_pos, end_pos and ``values`` (sample and value) on each elementary segment.

    Segments reach from one breakpoint of any sample to the next; a sample without an interval there
    has no row, and segments without any are left out. Segments are made apart for each value of ``by``.
    """
    points = df.select(*by, "chrom", F.explode(F.array("start_pos", "end_pos")).alias("start_pos")).distinct()
    ahead = Window.partitionBy(*by, "chrom").orderBy("start_pos")
    segments = points.withColumn("end_pos", F.lead("start_pos").over(ahead)).where("end_pos IS NOT NULL")
    pairs = overlaps(segments, df.select(*by, "chrom", "start_pos", "end_pos", *values), same=by)
    return pairs.select(*by, "chrom", "start_pos", "end_pos", *[F.col(f"b_{v}").alias(v) for v in values])


def union_table(df: DataFrame, sample: str, value: str, samples: Sequence[str]) -> DataFrame:
    """The segments with a column for each sample, 0 where it has nothing."""
    wide = union_segments(df, [sample, value]).groupBy("chrom", "start_pos", "end_pos").pivot(sample, list(samples)).agg(F.sum(value))
    return wide.select("chrom", "start_pos", "end_pos", *[F.coalesce(F.col(f"`{s}`"), F.lit(0)).alias(s) for s in samples])
