import pytest
from pyspark.sql import functions as F

from chromaloom.operators import filters
from chromaloom.operators.fragments import by_alignment_score, deduplicate_fragments, fragments, slice_stats

SCHEMA = "parent_id string, slice int, chrom string, start_pos long, end_pos long, capture string, capture_count int, exclusion string, exclusion_count int, blacklist int, restriction_fragment long, pe string, mapped int"


def make(spark, rows):
    """rows: dicts over defaults; slice_id is the position."""
    base = dict(parent_id="p", slice=0, chrom="chr1", start_pos=0, end_pos=10, capture=None, capture_count=0, exclusion=None, exclusion_count=0, blacklist=0, restriction_fragment=1, pe="flashed", mapped=1)
    full = [base | r for r in rows]
    data = [(i, f"{r['parent_id']}|{i}", 0, *[r[c.split()[0]] for c in SCHEMA.split(", ")]) for i, r in enumerate(full)]
    df = spark.createDataFrame(data, "slice_id long, slice_name string, multimapped int, " + SCHEMA)
    place = F.concat("chrom", F.lit(":"), "start_pos", F.lit("-"), "end_pos")
    return df.withColumn("coordinates", F.coalesce(place, F.lit("")))


def ids(df):
    return sorted(r.slice_id for r in df.select("slice_id").collect())


def test_orphans_and_captures(spark):
    df = make(spark, [{"parent_id": "a"}, {"parent_id": "b", "capture": "x", "capture_count": 1}, {"parent_id": "b"}, {"parent_id": "c", "capture": "x"}, {"parent_id": "c", "capture": "y"}])
    assert ids(filters.remove_orphan_slices(df)) == [1, 2, 3, 4]
    assert ids(filters.remove_multi_capture_fragments(df)) == [1, 2]


def test_same_places_in_another_order_are_no_duplicate(spark):
    order = {"f1": (1, 2, 3), "f2": (1, 2, 3), "f3": (3, 2, 1), "f4": (1, 2)}
    df = make(spark, [{"parent_id": p, "slice": i, "start_pos": s} for p, ss in order.items() for i, s in enumerate(ss)])
    kept = {r.parent_id for r in filters.remove_duplicate_slices(df).select("parent_id").collect()}
    assert kept == {"f1", "f3", "f4"}
    again = filters.remove_duplicate_slices(filters.remove_duplicate_slices(df))
    assert ids(again) == ids(filters.remove_duplicate_slices(df))


def test_duplicates_of_unmerged_reads(spark):
    rows = [{"parent_id": p, "slice": i, "start_pos": 10 * i + m, "end_pos": 10 * i + 5, "chrom": c} for p, m, c in (("a", 0, "chr1"), ("b", 0, "chr1"), ("c", 0, "chr2")) for i in (0, 1)]
    merged = make(spark, rows)
    assert len(ids(filters.remove_duplicate_slices_pe(merged))) == 6
    unmerged = merged.withColumn("pe", F.lit("pe"))
    assert {r.parent_id for r in filters.remove_duplicate_slices_pe(unmerged).collect()} == {"a", "c"}
    assert {r.parent_id for r in filters.remove_duplicate_slices_pe(unmerged, with_chrom=False).collect()} == {"a"}
    assert {r.parent_id for r in deduplicate_fragments(unmerged, unmerged=True).collect()} == {"a", "c"}


def test_religation_keeps_firsts_and_nulls(spark):
    df = make(spark, [{"restriction_fragment": rf} for rf in (5, 6, 6, 9, None)])
    kept = [r.restriction_fragment for r in filters.remove_religation(df).orderBy("slice_id").collect()]
    assert kept == [5, 9, None]


def test_one_slice_for_each_restriction_fragment(spark):
    df = make(spark, [{"slice": 1, "restriction_fragment": 4}, {"slice": 0, "restriction_fragment": 4}, {"restriction_fragment": None}, {"slice": 3, "restriction_fragment": None}])
    assert ids(filters.remove_duplicate_re_frags(df)) == [1, 2]
    assert ids(filters.remove_slices_without_re_frag_assigned(df)) == [0, 1]


def test_excluded(spark):
    inside = {"exclusion": "v", "exclusion_count": 1}
    df = make(spark, [
        {"parent_id": "a", "capture": "v", "capture_count": 1, **inside}, {"parent_id": "a", **inside},
        {"parent_id": "b", "capture": "v", "capture_count": 1, **inside}, {"parent_id": "b"},
        {"parent_id": "c", "capture": "w", "capture_count": 1, **inside}, {"parent_id": "c", **inside},
    ])
    assert {r.parent_id for r in filters.remove_excluded_slices(df).collect()} == {"b", "c"}


def test_next_to_the_capture(spark):
    df = make(spark, [
        {"parent_id": "a", "capture": "v", "capture_count": 1, "restriction_fragment": 10}, {"parent_id": "a", "restriction_fragment": 11},
        {"parent_id": "b", "capture": "v", "capture_count": 1, "restriction_fragment": 10}, {"parent_id": "b", "restriction_fragment": 12},
    ])
    assert {r.parent_id for r in filters.remove_viewpoint_adjacent_restriction_fragments(df).collect()} == {"b"}
    assert filters.remove_viewpoint_adjacent_restriction_fragments(df, 2).count() == 0


def test_tiled(spark):
    df = make(spark, [{"parent_id": "a", "capture": "x", "capture_count": 1}, {"parent_id": "a", "capture": "y", "capture_count": 1}, {"parent_id": "b", "capture": "x", "capture_count": 1}, {"parent_id": "c"}])
    assert ids(filters.remove_dual_capture_fragments(df)) == [2, 3]
    assert ids(filters.remove_non_capture_fragments(df)) == [0, 1, 2]
    assert ids(filters.remove_slices_outside_capture(df)) == [0, 1, 2]


def test_programs(spark, tmp_path):
    df = make(spark, [{"parent_id": "a", "capture": "v", "capture_count": 1, "restriction_fragment": 3, "pe": "pe"}, {"parent_id": "a", "slice": 1, "restriction_fragment": 30, "pe": "pe"}, {"parent_id": "b"}])
    assert ids(filters.run_program(df, "capture")) == [0, 1]
    stats = {r.stage: (r.n_fragments, r.n_slices) for r in filters.stage_stats(df, "capture", by=["pe"]).where("pe = 'pe'").collect()}
    assert stats["duplicate_filtered"] == (1, 2)
    path = tmp_path / "program.yml"
    path.write_text("one:\n  - remove_unmapped_slices\n  - remove_orphan_slices\n")
    assert filters.load_program(str(path)) == {"one": ["remove_unmapped_slices", "remove_orphan_slices"]}
    assert ids(filters.run_program(df, str(path))) == [0, 1]
    with pytest.raises(AttributeError):
        filters.load_program({"one": ["remove_multicapture_reporters"]})


def test_fragments_and_stats_of_nothing(spark):
    df = make(spark, [{"parent_id": "a", "capture": "v", "capture_count": 1}, {"parent_id": "a", "slice": 1, "start_pos": 50, "end_pos": 60}, {"parent_id": "a", "slice": 2, "start_pos": 20, "end_pos": 30}])
    one = fragments(df).first()
    assert (one.unique_slices, one.reporter_count, one.coordinates) == (3, 2, "chr1:0-10|chr1:20-30|chr1:50-60")
    assert all(x == 0 for x in slice_stats(df.limit(0)).first())


def test_best_alignment(spark):
    rows = [(1, "a", "p", "chr1", 5, 10), (2, "a", "p", "chr2", 5, 12), (3, "b", "p", "chr1", 1, 3), (4, "c", "p", "chr1", 1, 3)]
    df = spark.createDataFrame(rows, "record_id long, slice_name string, parent_id string, chrom string, start_pos long, score long")
    assert {r.record_id for r in by_alignment_score(df, F.col("score")).collect()} == {2, 3, 4}
    assert {r.record_id for r in by_alignment_score(df, F.col("score"), favour_cis=True).collect()} == {1, 3, 4}
    assert {r.record_id for r in by_alignment_score(df, F.lit(1), prefer=["chr2"]).collect()} == {2, 3, 4}
