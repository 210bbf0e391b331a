"""Slice filters, and programs of them.

A filter maps slices to slices. Those that look at a whole fragment are window flags over parent_id:
filters in a row then share one shuffle. A program is a mapping of stages to filter names.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..session import settled

Filter = Callable[[DataFrame], DataFrame]
_FLAG = "__flag__"

REGISTRY: dict[str, Filter] = {}


def fragment() -> WindowSpec:
    return Window.partitionBy("parent_id")


def register(f: Filter) -> Filter:
    """Makes a filter known by its name; the way to add one's own."""
    REGISTRY[f.__name__] = f
    return f


def _where(df: DataFrame, flag: Column) -> DataFrame:
    return df.withColumn(_FLAG, flag).where(_FLAG).drop(_FLAG)


@register
def get_unfiltered_slices(df: DataFrame) -> DataFrame:
    return df


@register
def remove_unmapped_slices(df: DataFrame) -> DataFrame:
    return df.where("mapped = 1")


@register
def remove_orphan_slices(df: DataFrame) -> DataFrame:
    """Slices that are alone in their fragment go."""
    return _where(df, F.count(F.lit(1)).over(fragment()) > 1)


@register
def remove_multi_capture_fragments(df: DataFrame) -> DataFrame:
    """Fragments with exactly one capture name stay; NULL isn't a name."""
    return _where(df, F.coalesce(F.min("capture").over(fragment()) == F.max("capture").over(fragment()), F.lit(False)))


@register
def remove_excluded_slices(df: DataFrame) -> DataFrame:
    """Whole fragments stay that have a slice outside all exclusion zones but those of other viewpoints."""
    captured = F.when(F.col("capture_count") == 1, F.col("capture"))
    first, last = F.min(captured).over(fragment()), F.max(captured).over(fragment())
    # a slice meets each viewpoint of its fragment; if it differs from any, it differs from the first or the last
    df = df.withColumn("__first__", first).withColumn("__last__", last)
    free = (F.col("exclusion_count") < 1) | ~F.col("exclusion").eqNullSafe(F.col("__first__")) | ~F.col("exclusion").eqNullSafe(F.col("__last__"))
    return _where(df, F.max(free).over(fragment())).drop("__first__", "__last__")


@register
def remove_blacklisted_slices(df: DataFrame) -> DataFrame:
    return df.where("coalesce(blacklist, 0) = 0")


@register
def remove_non_reporter_fragments(df: DataFrame) -> DataFrame:
    """Fragments with a mapped slice left that is neither captured, excluded nor blacklisted."""
    left = F.sum(F.col("mapped") - F.col("capture_count") - F.col("blacklist") - F.col("exclusion_count"))
    return _where(df, left.over(fragment()) > 0)


def slices_with_viewpoint(df: DataFrame) -> DataFrame:
    """Each slice with each capture of its fragment as ``viewpoint``; NULL where there is none."""
    captures = df.where("capture_count = 1").select("parent_id", F.col("capture").alias("viewpoint"))
    return df.join(captures, "parent_id", "left")


def adjacent_fragments(df: DataFrame, n: int) -> DataFrame:
    """(viewpoint, restriction_fragment) of captured fragments and n to either side."""
    captured = df.where("capture_count = 1 AND capture IS NOT NULL AND restriction_fragment IS NOT NULL")
    own = captured.select(F.col("capture").alias("viewpoint"), F.col("restriction_fragment").alias("rf")).distinct()
    return own.select("viewpoint", F.explode(F.sequence(F.col("rf") - n, F.col("rf") + n)).alias("restriction_fragment")).distinct()


@register
def remove_viewpoint_adjacent_restriction_fragments(df: DataFrame, n_adjacent: int = 1) -> DataFrame:
    """Whole fragments go that have a slice, itself not captured, next to a capture of their viewpoint."""
    near = slices_with_viewpoint(df).where("capture_count = 0")
    hit = near.join(adjacent_fragments(df, n_adjacent), ["viewpoint", "restriction_fragment"], "left_semi").select("parent_id").distinct()
    return df.join(hit, "parent_id", "left_anti")


def _first_of_each(df: DataFrame, signature: DataFrame, by: Sequence[str]) -> DataFrame:
    """Slices of the smallest parent_id of each signature."""
    kept = signature.groupBy(*by).agg(F.min("parent_id").alias("parent_id")).select("parent_id")
    return df.join(kept, "parent_id", "left_semi")


@register
def remove_duplicate_slices(df: DataFrame) -> DataFrame:
    """Of fragments with the same places in slice order, the one of the smallest parent_id stays."""
    ordered = F.sort_array(F.collect_list(F.struct("slice", "slice_id", "coordinates")))
    signature = df.groupBy("parent_id").agg(F.array_join(F.transform(ordered, lambda x: x["coordinates"]), "|").alias("signature"))
    return _first_of_each(df, signature, ["signature"])


@register
def remove_duplicate_slices_pe(df: DataFrame, with_chrom: bool = True) -> DataFrame:
    """Of unmerged fragments that begin and end at the same places, the one of the smallest parent_id stays.

    Does nothing where there is no unmerged slice; otherwise it holds for merged ones too.
    """
    if not df.where("pe = 'pe'").head(1):
        return df
    place = F.struct("slice", "slice_id")
    signature = df.groupBy("parent_id").agg(
        F.min_by("chrom", place).alias("chrom"), F.min_by("start_pos", place).alias("first"), F.max_by("end_pos", place).alias("last")
    )
    return _first_of_each(df, signature, ["chrom", "first", "last"] if with_chrom else ["first", "last"])


@register
def remove_duplicate_re_frags(df: DataFrame) -> DataFrame:
    """The first slice of a fragment on each restriction fragment; NULL is one of them."""
    first = Window.partitionBy("parent_id", "restriction_fragment").orderBy("slice", "slice_id")
    return _where(df, F.row_number().over(first) == 1)


@register
def remove_slices_without_re_frag_assigned(df: DataFrame) -> DataFrame:
    return df.where("restriction_fragment IS NOT NULL")


def reporter_count() -> Column:
    """Of a fragment's sums: mapped slices that aren't captured, excluded or blacklisted; 0 without a capture."""
    sums = {c: F.sum(c) for c in ("mapped", "capture_count", "exclusion_count", "blacklist")}
    left = sums["mapped"] - (sums["exclusion_count"] + sums["capture_count"] + sums["blacklist"])
    return F.when(sums["capture_count"] > 0, left).otherwise(0)


@register
def remove_slices_with_one_reporter(df: DataFrame) -> DataFrame:
    sums = {c: F.sum(c).over(fragment()) for c in ("mapped", "capture_count", "exclusion_count", "blacklist")}
    left = sums["mapped"] - sums["exclusion_count"] - sums["capture_count"] - sums["blacklist"]
    return _where(df, (sums["capture_count"] > 0) & (left > 1))


@register
def remove_slices_outside_capture(df: DataFrame) -> DataFrame:
    return df.where("capture_count <> 0")


@register
def remove_non_capture_fragments(df: DataFrame) -> DataFrame:
    return _where(df, F.sum("capture_count").over(fragment()) > 0)


@register
def remove_dual_capture_fragments(df: DataFrame) -> DataFrame:
    """Fragments whose captured slices have more than one name go."""
    name = F.when(F.col("capture_count") == 1, F.col("capture"))
    return _where(df, F.coalesce(F.min(name).over(fragment()) == F.max(name).over(fragment()), F.lit(True)))


@register
def remove_religation(df: DataFrame) -> DataFrame:
    """Of slices on the same or neighbouring restriction fragments only the first stays; NULL stays."""
    order = fragment().orderBy(F.asc_nulls_last("restriction_fragment"), "slice_id")
    step = F.col("restriction_fragment") - F.lag("restriction_fragment").over(order)
    return _where(df, step.isNull() | (step > 1))


def reporters(df: DataFrame) -> DataFrame:
    return df.where("capture_count < 1")


def captures(df: DataFrame) -> DataFrame:
    return df.where("capture_count = 1")


PROGRAMS: dict[str, dict[str, list[str]]] = {
    "capture": {
        "pre-filtering": ["get_unfiltered_slices"],
        "mapped": ["remove_unmapped_slices"],
        "contains_single_capture": ["remove_orphan_slices", "remove_multi_capture_fragments"],
        "contains_capture_and_reporter": [
            "remove_excluded_slices", "remove_blacklisted_slices", "remove_non_reporter_fragments", "remove_viewpoint_adjacent_restriction_fragments",
        ],
        "duplicate_filtered": [
            "remove_slices_without_re_frag_assigned", "remove_duplicate_re_frags", "remove_duplicate_slices", "remove_duplicate_slices_pe", "remove_non_reporter_fragments",
        ],
    },
    "tri": {
        "pre-filtering": ["get_unfiltered_slices"],
        "mapped": ["remove_unmapped_slices", "remove_slices_without_re_frag_assigned"],
        "contains_single_capture": ["remove_orphan_slices", "remove_multi_capture_fragments"],
        "contains_capture_and_reporter": ["remove_blacklisted_slices", "remove_non_reporter_fragments"],
        "duplicate_filtered": ["remove_duplicate_re_frags", "remove_duplicate_slices", "remove_duplicate_slices_pe", "remove_non_reporter_fragments"],
        "tric_reporter": ["remove_slices_with_one_reporter"],
    },
    "tiled": {
        "pre-filtering": ["get_unfiltered_slices"],
        "mapped": ["remove_unmapped_slices", "remove_orphan_slices"],
        "not_blacklisted": ["remove_blacklisted_slices"],
        "contains_capture": ["remove_non_capture_fragments", "remove_dual_capture_fragments"],
        "duplicate_filtered": ["remove_slices_without_re_frag_assigned", "remove_duplicate_re_frags", "remove_duplicate_slices", "remove_duplicate_slices_pe"],
        "has_reporter": ["remove_orphan_slices", "remove_religation"],
    },
}


def load_program(source: str | Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """A program by name, as a mapping, or from the text or path of a YAML file; unknown filters raise."""
    if isinstance(source, str) and source in PROGRAMS:
        source = PROGRAMS[source]
    elif isinstance(source, str):
        source = read_stages(source)
    unknown = [f for fs in source.values() for f in fs if f not in REGISTRY]
    if unknown:
        raise AttributeError(f"unknown filters: {', '.join(unknown)}")
    return {stage: list(fs) for stage, fs in source.items()}


def read_stages(source: str) -> dict[str, list[str]]:
    """Stages from YAML: ``stage:`` lines followed by ``- filter`` lines, or ``stage: [filter, ...]``."""
    text = source
    if "\n" not in source:
        with open(source) as file:
            text = file.read()
    try:
        import yaml

        return {str(k): [str(f) for f in v] for k, v in (yaml.safe_load(text) or {}).items()}
    except ImportError:
        stages: dict[str, list[str]] = {}
        for line in text.splitlines():
            line = line.split("#")[0].rstrip()
            if line.strip().startswith("- ") and stages:
                stages[next(reversed(stages))].append(line.strip()[2:].strip())
            elif ":" in line:
                stage, _, rest = line.partition(":")
                stages[stage.strip()] = [f.strip() for f in rest.strip().strip("[]").split(",") if f.strip()]
        return stages


#: Filters that read their slices more than once.
REREAD = {"remove_viewpoint_adjacent_restriction_fragments", "remove_duplicate_slices", "remove_duplicate_slices_pe"}


def apply_filters(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The filters in turn. What one reads more than once is written to the shared folder before, so
    that the filters before it run once."""
    for name in names:
        df = REGISTRY[name](settled(df, name) if name in REREAD else df)
    return df


def run_program(df: DataFrame, program: str | Mapping[str, Sequence[str]]) -> DataFrame:
    return apply_filters(df, [name for names in load_program(program).values() for name in names])


def stage_stats(df: DataFrame, program: str | Mapping[str, Sequence[str]], by: Sequence[str] = ("pe",)) -> DataFrame:
    """stage, n_fragments and n_slices after each stage, for each value of ``by``.

    What a stage leaves is written to the shared folder, so that no stage is run twice.
    """
    out = None
    for stage, filters in load_program(program).items():
        df = settled(apply_filters(df, filters), f"stage-{stage}")
        one = df.groupBy(*by).agg(F.countDistinct("parent_id").alias("n_fragments"), F.count(F.lit(1)).alias("n_slices"))
        one = one.select(F.lit(stage).alias("stage"), *by, "n_fragments", "n_slices")
        out = one if out is None else out.unionByName(one)
    return out
