from chromaloom.plans import fragment_queries, matrix_queries, preprocess_queries

RECORDS = "record_id long, slice_id long, slice_name string, chrom string, start_pos long, end_pos long, mapped int"


def test_alignments_of_every_spelling_are_compared(spark, tmp_path):
    rows = [
        (1, 11, "r1|pe|0|0", "chr1", 0, 10, 1), (2, 12, "R1|pe|0|00", "CHR7", 0, 20, 1), (3, 13, "r1|pe|0|0", None, 0, 90, 1),
        (4, 14, "r1|pe|1|1", "1", 5, 10, 1), (5, 15, " r1|PE|1|1", "chr1 ", 5, 10, 1), (6, 16, "r2|pe|0|2", "chr12", 0, 9, 1),
        (7, 17, "r3|pe|0|3", ".", 0, 9, 1), (8, 18, "r4|pe|0|4", "chr1", 0, 9, 0), (9, 19, "r1|pe|2|5", "chr1", 0, 4, 1),
    ]
    spark.createDataFrame(rows, RECORDS).write.parquet(str(tmp_path / "slices.parquet"))
    rest = {(4, "chr1"), (6, "chr12"), (7, None), (9, "chr1")}
    assert {tuple(r) for r in fragment_queries.dedup_alignments(spark, str(tmp_path)).collect()} == {(2, "chr7")} | rest
    assert {tuple(r) for r in fragment_queries.dedup_alignments_cis(spark, str(tmp_path)).collect()} == {(1, "chr1")} | rest


def test_matrices_with_a_dominant_bin_are_balanced(spark, monkeypatch):
    n = 30
    dense = [("s", "v", i, j, 200 if i == 0 else 1 + (i * j) % 3) for i in range(n) for j in range(i, n)]
    star = [("s", "w", 0, j, 5) for j in range(1, 5)]
    px = spark.createDataFrame(dense + star, "sample string, viewpoint string, bin1_id long, bin2_id long, n long")
    monkeypatch.setattr(matrix_queries, "pixels", lambda *_: px)
    monkeypatch.setattr(matrix_queries, "mapping", lambda *_: spark.createDataFrame([(i, i) for i in range(n)], "fragment_id long, bin_id long"))
    sums, out = [0.0] * n, matrix_queries.ice_balance(spark, "").collect()
    for r in out:
        if r.viewpoint == "v":
            sums[r.bin1_id] += r.balanced
            sums[r.bin2_id] += r.balanced if r.bin1_id != r.bin2_id else 0
    assert max(sums) / min(sums) < 1.003
    deviation = {r.viewpoint: r.deviation for r in out}
    assert deviation["v"] <= 1e-3 < 1 < deviation["w"]


def test_every_pair_of_conditions_with_zeros(spark, monkeypatch):
    level = {"w1": 10, "w2": 12, "k1": 11, "k2": 9, "n1": 10}
    rows = [(s, place * 10, n + (place * 3 + n) % 4) for s, n in level.items() for place in range(20)]
    rows += [("w1", 500, 8), ("k1", 600, 40), ("k2", 600, 44)]  # one of two libraries; a place that wt lacks
    track = spark.createDataFrame([(s, "v", "chr1", at, at + 10, n) for s, at, n in rows], "sample string, viewpoint string, chrom string, start_pos long, end_pos long, n long")
    design = spark.createDataFrame([("w1", "wt"), ("w2", "wt"), ("k1", "ko"), ("k2", "ko"), ("n1", "none")], "sample string, condition string")
    monkeypatch.setattr(matrix_queries, "track", lambda *_: track)
    monkeypatch.setattr(matrix_queries, "design", lambda *_: design)
    out = {(r.a, r.b, r.start_pos): r for r in matrix_queries.nb_wald(spark, "").collect()}
    assert {k[:2] for k in out} == {("wt", "ko"), ("wt", "none"), ("none", "ko")}
    once, lacking = out["wt", "ko", 500], out["wt", "ko", 600]
    assert 3 < once.mean_a < 5 and once.mean_b == 0 and once.log2_fold_change < 0
    assert lacking.mean_a == 0 and lacking.log2_fold_change > 5 and lacking.p_adjusted < 0.05
    assert ("wt", "none", 600) not in out and all(0 <= r.p_value <= r.p_adjusted + 1e-12 for r in out.values())


def test_records_without_a_parent_read_are_regenerated(spark, tmp_path, monkeypatch):
    rows = [(1, "r1|pe|0|0", "r1"), (2, "R1 |pe|1|01", None), (3, "r2|pe|0|2", "r2"), (4, "r2|pe|1|3", None)]
    spark.createDataFrame(rows, "record_id long, slice_name string, parent_read string").write.parquet(str(tmp_path / "slices.parquet"))
    monkeypatch.setattr(preprocess_queries, "slices", lambda *_: None)
    monkeypatch.setattr(preprocess_queries.filters, "run_program", lambda *_: spark.createDataFrame([("r1",)], "parent_id string"))
    assert {r.record_id for r in preprocess_queries.regenerate_reads(spark, str(tmp_path)).collect()} == {1, 2}
