"""The operators from a shell: ``python -m chromaloom.cli GROUP COMMAND ...``.

Tables are read by their ending (Parquet, JSON, tab-separated, BED, FASTQ, SAM) and written as Parquet
folders, or as text where a command says so.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import filters, fragments, intervals, matrix, pileup, preprocess
from .plans import pipeline
from .session import build_session, clean_scratch
from .sources import readers, writers

COMMANDS: dict[tuple[str, str], tuple[Callable, list]] = {}


def command(group: str, name: str, *arguments: tuple) -> Callable[[Callable], Callable]:
    def add(f: Callable) -> Callable:
        COMMANDS[group, name] = (f, list(arguments))
        return f

    return add


def arg(*names: str, **options: object) -> tuple:
    return names, options


OUT = arg("-o", "--output", required=True)


def load(spark: SparkSession, path: str) -> DataFrame:
    kind = path.rstrip("/").removesuffix(".gz").rsplit(".", 1)[-1].lower()
    if kind in ("fastq", "fq"):
        return readers.read_fastq(spark, path)
    if kind in ("fa", "fasta"):
        return readers.read_fasta(spark, path)
    if kind == "sam":
        return readers.read_sam(spark, path)
    if kind == "bam":
        return readers.read_bam(spark, path)
    if kind == "bed":
        return readers.read_bed(spark, path)
    if kind in ("tsv", "csv", "txt"):
        return readers.read_tables(spark, [path], "," if kind == "csv" else "\t")
    return spark.read.json(path) if kind in ("json", "jsonl") else spark.read.parquet(path)


def numbered_bed(spark: SparkSession, path: str) -> DataFrame:
    """A restriction fragment map; names are numbers."""
    return load(spark, path).select("chrom", "start_pos", "end_pos", F.col("name").cast("long").alias("name"))


@command("fastq", "split", arg("input", nargs="+"), OUT, arg("-n", "--n_reads", type=int, default=1_000_000), arg("--gzip", action="store_true"))
def fastq_split(spark, a):
    writers.write_fastq(readers.read_fastq(spark, a.input), a.output, a.n_reads, a.gzip)


@command("fastq", "digest", arg("input", nargs="+"), OUT, arg("-r", "--enzyme", required=True), arg("-m", "--mode", default="flashed", choices=["flashed", "pe"]), arg("--minimum", type=int, default=18))
def fastq_digest(spark, a):
    if a.mode == "flashed" and len(a.input) > 1:
        raise SystemExit("merged reads come in one file")
    reads = readers.read_fastq(spark, a.input[0], 1)
    for k, path in enumerate(a.input[1:], 2):
        reads = reads.unionByName(readers.read_fastq(spark, path, k))
    out = preprocess.digest_reads(reads, a.enzyme, a.mode, a.minimum)
    writers.write_fastq(out.withColumnRenamed("slice_name", "name"), a.output, gzip=False)


@command("fastq", "deduplicate", arg("first"), arg("second"), OUT)
def fastq_deduplicate(spark, a):
    pairs = readers.read_pairs(spark, a.first, a.second)
    kept = preprocess.deduplicate_reads(pairs, "name", ["sequence1", "sequence2"])
    for k in ("1", "2"):
        writers.write_fastq(kept.select("name", F.col(f"sequence{k}").alias("sequence"), F.col(f"quality{k}").alias("quality")), f"{a.output}_{k}")
    preprocess.deduplication_counts(pairs, ["sequence1", "sequence2"]).show(truncate=False)


@command("genome", "digest", arg("fasta"), OUT, arg("-r", "--enzyme", required=True), arg("--minimum", type=int, default=18), arg("--keep_site", action="store_true"))
def genome_digest(spark, a):
    found = preprocess.digest_genome(readers.read_fasta(spark, a.fasta), a.enzyme, a.minimum, a.keep_site)
    writers.write_bed(preprocess.numbered(found), a.output)


@command(
    "alignments", "annotate", arg("slices"), OUT, arg("-b", "--bed", action="append", required=True), arg("-n", "--name", action="append", required=True),
    arg("-a", "--action", action="append", required=True, choices=["get", "best", "count"]), arg("-f", "--fraction", action="append", type=float, default=[]), arg("--blacklist"),
)
def alignments_annotate(spark, a):
    from .functions.genomic import for_each_file

    n = len(a.bed)
    many = [for_each_file(x or [0.0], n) for x in (a.action, a.name, a.fraction)]
    specs = [{"action": act, "b": readers.read_bed(spark, b), "name": name, "fraction": f} for act, name, f, b in zip(*many, a.bed)]
    slices = load(spark, a.slices)
    if a.blacklist:
        hit = intervals.overlaps(slices.select("slice_id", "chrom", "start_pos", "end_pos"), readers.read_bed(spark, a.blacklist))
        slices = slices.join(hit.select("slice_id"), "slice_id", "left_anti")
    writers.write_parquet(intervals.annotate_many(slices, "slice_id", specs), a.output)


@command("alignments", "filter", arg("slices"), OUT, arg("-m", "--method", default="capture", help="capture, tri, tiled or a YAML file"), arg("--annotations"), arg("--stats"))
def alignments_filter(spark, a):
    slices = load(spark, a.slices)
    if a.annotations:
        slices = readers.best_annotation(slices, load(spark, a.annotations))
    writers.write_parquet(filters.run_program(slices, a.method), a.output)
    if a.stats:
        writers.write_json(filters.stage_stats(slices, a.method), a.stats)


@command("interactions", "deduplicate", arg("slices"), OUT, arg("--read_type", default="flashed", choices=["flashed", "pe"]), arg("--stats"))
def interactions_deduplicate(spark, a):
    before = load(spark, a.slices)
    after = fragments.deduplicate_fragments(before, a.read_type == "pe")
    writers.write_parquet(after, a.output)
    if a.stats:
        writers.write_json(fragments.deduplication_stats(before, after), a.stats)


@command("interactions", "count", arg("slices"), OUT, arg("--remove_viewpoint", action="store_true"), arg("--remove_exclusions", action="store_true"), arg("--subsample", type=float))
def interactions_count(spark, a):
    counted = matrix.count_pixels(matrix.with_viewpoint(load(spark, a.slices)), remove_viewpoint=a.remove_viewpoint, remove_exclusions=a.remove_exclusions, subsample=a.subsample)
    matrix.write_store(counted, a.output)


@command("interactions", "fragments-to-bins", arg("store"), arg("fragment_map"), arg("viewpoints"), arg("-b", "--binsize", type=int, action="append", required=True), arg("--method", default="midpoint", choices=["midpoint", "overlap"]), arg("--normalise", action="store_true"), arg("--scale", type=float, default=1e6), arg("--assay", default="capture"))
def interactions_bins(spark, a):
    fragment_map = numbered_bed(spark, a.fragment_map)
    bins = fragment_map.withColumnRenamed("name", "bin_id")
    pixels = matrix.read_store(spark, a.store).where("resolution = 'fragments'").select(*matrix.PIXEL, "n")
    from .session import settled

    pixels = settled(pixels, "pixels")  # the store is added to below
    if not a.normalise and a.method == "midpoint":
        matrix.write_store(matrix.rebin_widths(pixels, bins, a.binsize), a.store, None)
        return
    for width in a.binsize:
        grid = matrix.fixed_bins(matrix.chrom_sizes(fragment_map), width)
        to = matrix.bins_by_midpoint(bins, grid, width) if a.method == "midpoint" else matrix.bins_by_overlap(bins, grid)
        out = matrix.rebin(pixels, to)
        if a.normalise:
            out = matrix.normalise(out, to, matrix.interaction_totals(pixels, readers.read_bed(spark, a.viewpoints), bins, a.assay), a.scale)
        matrix.write_store(out, a.store, width)


@command("interactions", "merge", arg("stores", nargs="+"), OUT)
def interactions_merge(spark, a):
    stores = [matrix.read_store(spark, s) for s in a.stores]
    out = None
    for s in stores:
        s = s.select(*matrix.PIXEL, "resolution", "n")
        out = s if out is None else out.unionByName(s)
    merged = out.groupBy(*matrix.PIXEL, "resolution").agg(F.sum("n").alias("n"))
    merged.write.partitionBy("resolution", "viewpoint").parquet(a.output)


@command("interactions", "pileup", arg("store"), arg("fragment_map"), arg("viewpoints"), OUT, arg("--normalisation", default="raw", choices=["raw", "n_cis", "region"]), arg("--regions"), arg("--scale", type=float, default=1e6), arg("--gzip", action="store_true"))
def interactions_pileup(spark, a):
    bins, v = numbered_bed(spark, a.fragment_map).withColumnRenamed("name", "bin_id"), readers.read_bed(spark, a.viewpoints)
    pixels = matrix.read_store(spark, a.store).where("resolution = 'fragments'").select(*matrix.PIXEL, "n")
    track = pileup.bedgraph(pileup.reporters(pixels, matrix.viewpoint_bins(v, bins)), bins)
    if a.normalisation == "n_cis":
        track = pileup.normalise_cis(track, matrix.interaction_totals(pixels, v, bins), a.scale)
    elif a.normalisation == "region":
        regions = readers.read_bed(spark, a.regions).withColumn("viewpoint", F.lower("name"))
        track = pileup.normalise_regions(track, regions, a.scale)
    options = {"sep": "\t", "compression": "gzip" if a.gzip else "none"}
    track.sort("sample", "viewpoint", "chrom", "start_pos").write.partitionBy("sample", "viewpoint").options(**options).csv(a.output)


@command("interactions", "compare-concat", arg("profiles"), OUT)
def compare_concat(spark, a):
    writers.write_parquet(intervals.union_segments(load(spark, a.profiles), ["sample", "n"], by=["viewpoint"]), a.output)


@command("interactions", "compare-summarise", arg("profiles"), OUT, arg("-d", "--design", required=True), arg("-m", "--method", default="mean"), arg("--subtract", action="store_true"))
def compare_summarise(spark, a):
    out = pileup.summarise(load(spark, a.profiles), readers.read_design(spark, a.design), a.method)
    writers.write_parquet(out, a.output)
    if a.subtract:
        writers.write_parquet(pileup.subtractions(out.withColumnRenamed("value", "mean")), f"{a.output}-subtraction")


@command("interactions", "differential", arg("profiles"), OUT, arg("-d", "--design", required=True), arg("--a"), arg("--b"), arg("--threshold", type=int, default=20), arg("--q", type=float, default=0.05))
def differential(spark, a):
    """Every pair of conditions, or b against a."""
    design, track = readers.read_design(spark, a.design), load(spark, a.profiles)
    if a.a and a.b:
        design = design.where(F.col("condition").isin(a.a, a.b))
    found = pileup.differential_pairs(track, design, a.q, a.threshold)
    writers.write_tsv(found.orderBy("a", "b", F.desc(F.abs("log2_fold_change")), "p_adjusted"), a.output)


@command("utilities", "gtf-to-bed12", arg("gtf"), OUT)
def gtf_to_bed12(spark, a):
    writers.write_tsv(preprocess.bed12(readers.read_gtf(spark, a.gtf)).orderBy("chrom", "start_pos"), a.output, header=False)


@command("utilities", "cis-and-trans-stats", arg("slices"), OUT, arg("--assay", default="capture"))
def cis_and_trans_stats(spark, a):
    s = load(spark, a.slices)
    writers.write_json(fragments.cis_or_trans_tiled(s) if a.assay == "tiled" else fragments.cis_or_trans(s), a.output)


@command("utilities", "dump", arg("input"), OUT, arg("--viewpoint"))
def dump(spark, a):
    path, _, group = a.input.partition("::")
    writers.dump(matrix.read_store(spark, a.input) if group else load(spark, path), a.output, a.viewpoint)


@command("utilities", "regenerate-fastq", arg("first"), arg("second"), arg("slices"), OUT)
def regenerate_fastq(spark, a):
    kept = preprocess.regenerate_reads(readers.read_pairs(spark, a.first, a.second), "name", load(spark, a.slices))
    for k in ("1", "2"):
        writers.write_fastq(kept.select("name", F.col(f"sequence{k}").alias("sequence"), F.col(f"quality{k}").alias("quality")), f"{a.output}_{k}")


@command("utilities", "interaction-maps", arg("fragment_map"), arg("viewpoints"), OUT)
def interaction_maps(spark, a):
    """The fragments as a map, and those that hold a viewpoint with its name."""
    fragment_map = numbered_bed(spark, a.fragment_map)
    writers.write_bed(fragment_map, f"{a.output}.rmap")
    hit = intervals.overlaps(fragment_map, readers.read_bed(spark, a.viewpoints))
    writers.write_tsv(hit.select("chrom", "start_pos", "end_pos", "name", "b_name").orderBy("chrom", "start_pos"), f"{a.output}.baitmap", header=False)


@command("utilities", "viewpoint-coordinates", arg("hits"), arg("fragment_map"), OUT)
def viewpoint_coordinates(spark, a):
    """The fragments of aligned viewpoint sequences."""
    hit = intervals.overlaps(numbered_bed(spark, a.fragment_map), readers.read_bed(spark, a.hits)).select("chrom", "start_pos", "end_pos", F.col("b_name").alias("name"))
    writers.write_bed(preprocess.viewpoint_fragments(hit), a.output)


@command("pipeline", "run", arg("slices"), arg("viewpoints"), arg("fragment_map"), OUT, arg("--assay", default="capture"), arg("--bins", default=""), arg("--design"), arg("--blacklist"))
def run_pipeline(spark, a):
    config = pipeline.Config(assay=a.assay, bins=a.bins or [])
    design = readers.read_design(spark, a.design) if a.design else None
    blacklist = readers.read_bed(spark, a.blacklist) if a.blacklist else None
    r = pipeline.run(load(spark, a.slices), readers.read_bed(spark, a.viewpoints), numbered_bed(spark, a.fragment_map), config, design, blacklist)
    writers.write_parquet(r.slices, f"{a.output}/slices")
    writers.write_json(r.stages, f"{a.output}/stages")
    writers.write_json(r.cis_trans, f"{a.output}/cis_trans")
    for resolution, pixels in r.pixels.items():
        matrix.write_store(pixels, f"{a.output}/store", resolution)
    writers.write_parquet(r.profiles, f"{a.output}/profiles")
    if r.differences is not None:
        writers.write_parquet(r.means, f"{a.output}/means")
        writers.write_parquet(r.differences, f"{a.output}/differences")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="chromaloom")
    top.add_argument("--shared-dir", help="a folder that all executors share, for tables in between")
    groups = top.add_subparsers(dest="group", required=True)
    known: dict[str, argparse._SubParsersAction] = {}
    for (group, name), (f, arguments) in COMMANDS.items():
        if group not in known:
            known[group] = groups.add_parser(group).add_subparsers(dest="command", required=True)
        one = known[group].add_parser(name, help=(f.__doc__ or name).strip().splitlines()[0])
        for names, options in arguments:
            one.add_argument(*names, **options)
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    run = COMMANDS[a.group, a.command][0]
    if spark is not None:
        return run(spark, a)
    try:
        run(build_session(**({"spark.checkpoint.dir": a.shared_dir} if a.shared_dir else {})), a)
    finally:
        clean_scratch()


if __name__ == "__main__":
    main()
