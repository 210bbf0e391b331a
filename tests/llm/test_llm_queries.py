from datetime import datetime, timedelta
from itertools import combinations

from chromaloom.llm import queries as q

SLICES = "record_id long, slice_name string, parent_read string, chrom string, multimapped int, bam string, capture string, loaded_at timestamp"


def delivered(spark, tmp_path, rows):
    """rows: (slice_name, parent_read, bam, day of January, capture)."""
    data = [(i, s, r, "chr1", 0, b, c, datetime(2024, 1, d, 12)) for i, (s, r, b, d, c) in enumerate(rows)]
    spark.createDataFrame(data, SLICES).write.parquet(str(tmp_path / "slices.parquet"))
    return str(tmp_path)


def test_distinct_counts_of_every_combination(spark, tmp_path):
    rows = [
        ("r1|pe|0|0", "r1", "a", 1, None), ("R1|pe|0|00", "R1 ", "a", 2, "."), ("r1|pe|1|1", "r1", "b", 1, "x"),
        ("r2|pe|0|2", "r2", "a", 1, " X"), ("r3|pe|0|3", None, "a", 1, "y"), ("r4|pe|0|4", "r4", "b", 2, None),
    ]
    plain = [
        ("r1|pe|0|0", "r1", "a", "2024-01-01", ""), ("r1|pe|0|0", "r1", "a", "2024-01-02", ""), ("r1|pe|1|1", "r1", "b", "2024-01-01", "x"),
        ("r2|pe|0|2", "r2", "a", "2024-01-01", "x"), ("r3|pe|0|3", None, "a", "2024-01-01", "y"), ("r4|pe|0|4", "r4", "b", "2024-01-02", ""),
    ]
    want = {}
    for k in (1, 2, 3):
        for dims in combinations(range(3), k):
            for row in plain:
                for kind, name in (("slice", row[0]), ("read", row[1])):
                    if name:
                        want.setdefault((kind, *[row[2 + d] if d in dims else None for d in range(3)]), set()).add(name)
    got = {(r.kind, r.bam, r.load_day, r.capture): r.n_distinct for r in q.p5_combinations(spark, delivered(spark, tmp_path, rows)).collect()}
    assert got == {k: len(v) for k, v in want.items()}


def test_many_loading_days_stay_sources(spark, tmp_path):
    days = [datetime(2020, 1, 1) + timedelta(days=k) for k in range(600)]
    rows = [(f"r{k}|pe|0|0", "chr1", day) for k, day in enumerate(days)]
    for k in range(40):  # three days of their own against one, whose value is the smaller
        rows += [(f"x{k}|pe|0|0", "chr2", days[3 * k + j]) for j in range(3)] + [(f"x{k}|pe|0|0", "chr1", days[400 + k])]
    data = [(i, s, "r", c, 0, "a", None, t) for i, (s, c, t) in enumerate(rows)]
    spark.createDataFrame(data, SLICES).write.parquet(str(tmp_path / "slices.parquet"))
    out = {r.slice_name: r.chrom for r in q.p2_fused(spark, str(tmp_path)).collect()}
    assert len(out) == 640 and {out[f"x{k}|pe|0|0"] for k in range(40)} == {"chr2"}
