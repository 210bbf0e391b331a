import math

from pyspark.sql import functions as F

from chromaloom.operators import matrix, pileup

PX = "sample string, viewpoint string, bin1_id long, bin2_id long, n long"


def test_pixels(spark):
    rows = [("a", 1), ("a", 2), ("a", 2), ("a", 5), ("b", 2), ("b", 1), ("c", 9), ("d", None), ("d", 3)]
    df = spark.createDataFrame([(p, "s", "v", rf, 0, None) for p, rf in rows], "parent_id string, bam string, viewpoint string, restriction_fragment long, capture_count int, exclusion string")
    got = {(r.bin1_id, r.bin2_id): r.n for r in matrix.count_pixels(df).collect()}
    assert got == {(1, 2): 2, (1, 5): 1, (2, 5): 1}
    diagonal = {(r.bin1_id, r.bin2_id): r.n for r in matrix.count_pixels(df, within=True).collect()}
    assert diagonal[(2, 2)] == 2 and diagonal[(9, 9)] == 1 and diagonal[(1, 2)] == 2


def test_pixels_of_a_large_fragment_in_blocks(spark):
    rows = [("hot", rf) for rf in range(40)] + [("b", 3), ("b", 39)]
    df = spark.createDataFrame([(p, "s", "v", rf) for p, rf in rows], "parent_id string, bam string, viewpoint string, restriction_fragment long")
    for within in (False, True):
        got = {(r.bin1_id, r.bin2_id): r.n for r in matrix.count_pixels(df, block=7, within=within).collect()}
        assert got == {(r.bin1_id, r.bin2_id): r.n for r in matrix.count_pixels(df, within=within).collect()}
        assert len(got) == 40 * 39 // 2 + 40 * within and got[3, 39] == 2


def test_a_fragment_of_very_many(spark):
    df = spark.range(2000).selectExpr("'hot' AS parent_id", "'s' AS bam", "'v' AS viewpoint", "id AS restriction_fragment")
    assert matrix.count_pixels(df).agg(F.sum("n")).first()[0] == 2000 * 1999 // 2


def test_bins_and_rebinning_keep_counts(spark):
    fragments = spark.createDataFrame([(i, "chr1", i * 7, i * 7 + 7) for i in range(20)] + [(20 + i, "chr2", i * 5, i * 5 + 5) for i in range(6)], "bin_id long, chrom string, start_pos long, end_pos long")
    bins = matrix.fixed_bins(matrix.chrom_sizes(fragments), 30)
    assert [(r.bin_id, r.chrom, r.end_pos) for r in bins.orderBy("bin_id").collect()] == [(0, "chr1", 30), (1, "chr1", 60), (2, "chr1", 90), (3, "chr1", 120), (4, "chr1", 140), (5, "chr2", 30)]
    mapping = matrix.bins_by_midpoint(fragments, bins, 30)
    assert mapping.count() == 26
    px = spark.createDataFrame([("s", "v", i, j, i + j) for i in range(0, 26, 3) for j in range(i + 1, 26, 5)], PX)
    assert matrix.rebin(px, mapping).agg(F.sum("n")).first()[0] == px.agg(F.sum("n")).first()[0]
    assert matrix.rebin(px, mapping).where("bin1_id > bin2_id").count() == 0
    overlap = {r.fragment_id: r.bin_id for r in matrix.bins_by_overlap(fragments, bins).collect()}
    assert overlap[3] == 0 and overlap[4] == 1 and overlap[5] == 1


def test_merging_commutes_and_doubles(spark):
    a = spark.createDataFrame([("s", "v", 1, 2, 3), ("s", "v", 1, 3, 1)], PX)
    b = spark.createDataFrame([("s", "v", 1, 2, 4), ("t", "v", 1, 2, 9)], PX)
    rows = lambda d: sorted(tuple(r[c] for c in PX.replace("string", "").replace("long", "").replace(" ", "").split(",")) for r in d.collect())
    assert rows(matrix.merge_pixels([a, b])) == rows(matrix.merge_pixels([b, a]))
    assert matrix.merge_pixels([a, a]).agg(F.sum("n")).first()[0] == 8
    meta = spark.createDataFrame([("s", "v", 1, "old", [2, 1], 5, 6), ("s", "v", 2, "new", [1, 3], 1, 2)], "sample string, viewpoint string, source int, name string, bins array<long>, n_cis long, n_total long")
    one = matrix.merge_metadata(meta).first()
    assert (one.name, one.bins, one.n_cis, one.n_total) == ("new", [2, 1, 3], 6, 8)


def test_balanced_sums_are_equal(spark):
    n = 8
    px = spark.createDataFrame([("s", "v", i, j, (i + 1) * (j + 2) + (i * j) % 3) for i in range(n) for j in range(i, n)], PX)
    out = matrix.balance(px, iterations=25).collect()
    sums = [0.0] * n
    for r in out:
        sums[r.bin1_id] += r.balanced
        if r.bin1_id != r.bin2_id:
            sums[r.bin2_id] += r.balanced
    assert max(sums) / min(sums) < 1.02


def test_dense_region_and_averages(spark):
    px = spark.createDataFrame([("s", "v", 1, 2, 3), ("t", "v", 1, 2, 6), ("s", "v", 2, 2, 5)], PX)
    region = spark.createDataFrame([(1,), (2,)], "bin_id long")
    assert {(r.bin1_id, r.bin2_id): r.n for r in matrix.dense_region(px, region).collect()} == {(1, 1): 0, (1, 2): 9, (2, 1): 9, (2, 2): 5}
    value = lambda how: {(r.bin1_id, r.bin2_id): r.value for r in matrix.average_matrices(px, 3, how).collect()}
    assert value("mean") == {(1, 2): 3.0, (2, 2): 5 / 3} and value("median") == {(1, 2): 3.0, (2, 2): 0.0} and value("sum")[(1, 2)] == 9.0


def test_store(spark, tmp_path):
    px = spark.createDataFrame([("s", "v", 1, 2, 3), ("s", "w", 1, 2, 6)], PX)
    store = str(tmp_path / "store")
    matrix.write_store(px, store)
    matrix.write_store(px.where("viewpoint = 'v'"), store, 5000)
    assert matrix.store_uri(store) == store and matrix.store_uri(store, "v", 5000).endswith("::/v/resolutions/5000") and matrix.store_uri("a::/b", "c") == "a::/b"
    assert matrix.read_store(spark, matrix.store_uri(store, "w")).count() == 1
    one = matrix.read_store(spark, matrix.store_uri(store, "v", 5000))
    assert one.count() == 1 and "PartitionFilters: [isnotnull" in one._jdf.queryExecution().toString()


def test_pixel_between_own_bins_comes_twice(spark):
    px = spark.createDataFrame([("s", "v", 1, 2, 3), ("s", "v", 2, 7, 1), ("s", "v", 8, 9, 4)], PX)
    own = spark.createDataFrame([("v", 1), ("v", 2)], "viewpoint string, bin_id long")
    got = sorted((r.capture, r.reporter, r.n) for r in pileup.reporters(px, own).collect())
    assert got == [(1, 2, 3), (1, 2, 3), (2, 7, 1)]


def test_differential(spark):
    rows = []
    for place in range(40):
        for k, sample in enumerate(("a1", "a2", "a3", "b1", "b2", "b3")):
            level = 100 + 13 * ((place * 7 + k * 5) % 4)
            rows.append((sample, "v", "chr1", place * 10, place * 10 + 10, level * (8 if place == 0 and sample[0] == "b" else 1)))
    counts = spark.createDataFrame(rows, "sample string, viewpoint string, chrom string, start_pos long, end_pos long, n long")
    design = spark.createDataFrame([(s, s[0]) for s in ("a1", "a2", "a3", "b1", "b2", "b3")], "sample string, condition string")
    out = {r.start_pos: r for r in pileup.differential(counts, design, "a", "b").collect()}
    assert out[0].p_adjusted < 0.01 and abs(out[0].log2_fold_change - 3) < 0.3
    others = [r for s, r in out.items() if s]
    assert sum(r.p_adjusted < 0.05 for r in others) <= 1 and all(r.p_adjusted >= r.p_value - 1e-12 for r in others)


def test_comparisons(spark):
    rows = [("a1", "v", "chr1", 0, 10, 4), ("a2", "v", "chr1", 0, 10, 2), ("b1", "v", "chr1", 10, 20, 6)]
    track = spark.createDataFrame(rows, "sample string, viewpoint string, chrom string, start_pos long, end_pos long, n long")
    design = spark.createDataFrame([("a1", "a"), ("a2", "a"), ("b1", "b"), ("b2", "b")], "sample string, condition string")
    means = pileup.condition_means(track, design)
    assert {(r.start_pos, r.condition): r["mean"] for r in means.collect()} == {(0, "a"): 3.0, (10, "b"): 3.0}
    assert {(r.start_pos, r.a): r.difference for r in pileup.subtractions(means).collect()} == {(0, "a"): 3.0, (0, "b"): -3.0, (10, "a"): -3.0, (10, "b"): 3.0}
    assert {r.condition: r.value for r in pileup.summarise(track, design, "max").collect()} == {"a": 4.0, "b": 6.0}
    assert math.isclose(pileup.summarise(track, design, "std").where("condition = 'b'").first().value, 3.0)
    assert pileup.arithmetic(track, 2, "/").where("sample = 'a1'").first().n == 2.0
    assert pileup.arithmetic(track, track, "-").agg(F.sum("n")).first()[0] == 0.0
    assert pileup.arithmetic(track, 0, "/").where("n IS NOT NULL").count() == 0
    assert pileup.parse_groups(["x", "y", "z"], "A,B", "0,1;z") == {"x": "A", "y": "A", "z": "B"}
