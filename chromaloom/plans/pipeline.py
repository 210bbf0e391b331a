"""From aligned slices to profiles and comparisons in one session."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.genomic import bin_sizes
from ..operators import filters, fragments, intervals, matrix, pileup
from ..session import settled


@dataclass(frozen=True)
class Config:
    """``assay``: capture, tri, tiled or a program of filters. ``bins``: widths, as numbers or text."""

    assay: str | Mapping = "capture"
    bins: object = ()
    normalisation: str = "n_cis"
    exclusion: int = 1000
    scale: float = 1e6
    remove_viewpoint: bool = False
    compare: bool = True


@dataclass
class Result:
    """What each step leaves; ``pixels`` by resolution."""

    slices: DataFrame
    stages: DataFrame
    cis_trans: DataFrame
    pixels: dict[str, DataFrame]
    totals: DataFrame
    profiles: DataFrame
    means: DataFrame | None = None
    differences: DataFrame | None = None
    metadata: dict[str, object] = field(default_factory=dict)


def annotate(slices: DataFrame, viewpoints: DataFrame, fragment_map: DataFrame, exclusion: int = 1000, blacklist: DataFrame | None = None) -> DataFrame:
    """Slices (slice_id, chrom, start_pos, end_pos, ...) with the usual annotations, the largest overlap's of several."""
    zones = intervals.exclusion_zones(viewpoints, exclusion, matrix.chrom_sizes(fragment_map))
    sources = {"restriction_fragment": fragment_map, "capture": viewpoints, "exclusion": zones, "exclusion_count": zones, "capture_count": viewpoints}
    if blacklist is not None:
        sources["blacklist"] = blacklist
    bare = slices.drop(*[n for n, *_ in intervals.ANNOTATION_DEFAULTS])
    specs = [{"action": "best" if a == "get" else a, "b": sources[n], "name": n, "fraction": f} for n, a, f in intervals.ANNOTATION_DEFAULTS if n in sources]
    out = intervals.annotate_many(bare, "slice_id", specs)
    return out if blacklist is not None else out.withColumn("blacklist", F.lit(0))


def run(slices: DataFrame, viewpoints: DataFrame, fragment_map: DataFrame, config: Config = Config(), design: DataFrame | None = None, blacklist: DataFrame | None = None) -> Result:
    """Annotation, filtering, counting, binning, profiles and, with a design, comparisons.

    Annotated and filtered slices and pixels are written to the shared folder, as they are read more than once.
    """
    named = viewpoints.withColumn("name", F.lower("name"))
    annotated = settled(annotate(slices, named, fragment_map, config.exclusion, blacklist), "annotated")
    stages = filters.stage_stats(annotated, config.assay)
    kept = settled(filters.run_program(annotated, config.assay), "filtered")
    tiled = config.assay == "tiled"
    cis_trans = fragments.cis_or_trans_tiled(kept) if tiled else fragments.cis_or_trans(kept)
    bins = fragment_map.withColumnRenamed("name", "bin_id")
    counted = matrix.count_pixels(matrix.with_viewpoint(kept), remove_viewpoint=config.remove_viewpoint)
    pixels = {"fragments": settled(counted, "pixels")}
    for width in bin_sizes(config.bins):
        grid = matrix.fixed_bins(matrix.chrom_sizes(fragment_map), width)
        pixels[str(width)] = matrix.rebin(pixels["fragments"], matrix.bins_by_midpoint(bins, grid, width))
    totals = matrix.interaction_totals(pixels["fragments"], viewpoints, bins, "tiled" if tiled else "capture")
    own = matrix.viewpoint_bins(viewpoints, bins)
    track = settled(pileup.bedgraph(pileup.reporters(pixels["fragments"], own), bins), "profiles")
    profiles = pileup.normalise_cis(track, totals, config.scale) if config.normalisation == "n_cis" else track
    result = Result(kept, stages, cis_trans, pixels, totals, profiles)
    if design is not None and config.compare:
        result.means = settled(pileup.condition_means(profiles.where("n IS NOT NULL"), design), "means")
        result.differences = pileup.subtractions(result.means)
    return result
