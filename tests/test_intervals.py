from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chromaloom.operators import intervals

SPAN = st.tuples(st.sampled_from(["chr1", "chr2"]), st.integers(0, 300), st.integers(0, 60)).map(lambda t: (t[0], t[1], t[1] + t[2]))


def frame(spark, rows, key):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"{key} long, chrom string, start_pos long, end_pos long")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(SPAN, max_size=12), st.lists(SPAN, max_size=12), st.sampled_from([1, 7, 64, 4096]))
def test_bucketed_join_is_the_plain_one(spark, a, b, width):
    got = intervals.overlaps(frame(spark, a, "i"), frame(spark, b, "j"), width)
    found = sorted((r.i, r.b_j, r.overlap) for r in got.collect())
    want = sorted(
        (i, j, min(x[2], y[2]) - max(x[1], y[1])) for i, x in enumerate(a) for j, y in enumerate(b)
        if x[0] == y[0] and x[1] < y[2] and y[1] < x[2] and x[2] > x[1] and y[2] > y[1]
    )
    assert found == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(SPAN, max_size=10), st.lists(SPAN, max_size=8))
def test_subtract_and_merge_by_bases(spark, a, b):
    bases = lambda rows: {(c, x) for c, s, e in rows for x in range(s, e)}
    merged = [(r.chrom, r.start_pos, r.end_pos) for r in intervals.merge_intervals(frame(spark, b, "j")).collect()]
    assert bases(merged) == bases(b) and sum(e - s for _, s, e in merged) == len(bases(b))
    left = [(r.i, (r.chrom, r.start_pos, r.end_pos)) for r in intervals.subtract(frame(spark, a, "i"), "i", frame(spark, b, "j")).collect()]
    for i, x in enumerate(a):
        assert bases([y for k, y in left if k == i]) == bases([x]) - bases(b)


def test_annotations_keep_every_row(spark):
    a = spark.createDataFrame([(1, "chr1", 0, 100), (2, "chr1", 600, 700), (3, "chr2", 0, 50), (4, None, None, None)], "k long, chrom string, start_pos long, end_pos long")
    b = spark.createDataFrame([("chr1", 500, 2050, "CAPTURE"), ("chr1", 89, 89, "D")], "chrom string, start_pos long, end_pos long, name string")
    got = {r.k: r.capture for r in intervals.annotate_get(a, "k", b, "capture").collect()}
    assert got == {1: None, 2: "CAPTURE", 3: None, 4: None}
    count = {r.k: r.n for r in intervals.annotate_count(a, "k", b, "n").collect()}
    assert count == {1: 0, 2: 1, 3: 0, 4: 0}
    assert intervals.annotate_get(a, "k", b.limit(0), "capture").where("capture IS NULL").count() == 4


def test_fractions(spark):
    a = spark.createDataFrame([(1, "chr1", 0, 100)], "k long, chrom string, start_pos long, end_pos long")
    b = spark.createDataFrame([("chr1", 0, 40, "x"), ("chr1", 30, 75, "y")], "chrom string, start_pos long, end_pos long, name string")
    assert intervals.annotate_get(a, "k", b, "n", 0.45).first().n == "y"
    assert intervals.annotate_count(a, "k", b, "n", 0.75).first().n == 2  # both together cover enough
    assert intervals.annotate_count(a, "k", b, "n", 0.76).first().n == 0
    assert intervals.annotate_best(a, "k", b, "n").first().n == "y"


def test_touching_intervals(spark):
    b = spark.createDataFrame([("chr1", 0, 10), ("chr1", 10, 20)], "chrom string, start_pos long, end_pos long")
    assert intervals.merge_intervals(b).count() == 1
    assert intervals.merge_intervals(b, slack=-1).count() == 2


def test_union_of_profiles(spark):
    rows = [("a", "chr1", 0, 10, 1), ("b", "chr1", 5, 15, 2)]
    df = spark.createDataFrame(rows, "sample string, chrom string, start_pos long, end_pos long, n long")
    got = sorted(tuple(r) for r in intervals.union_table(df, "sample", "n", ["a", "b"]).collect())
    assert got == [("chr1", 0, 5, 1, 0), ("chr1", 5, 10, 1, 2), ("chr1", 10, 15, 0, 2)]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(SPAN, max_size=14), st.sampled_from([0, -1, 9]), st.sampled_from([8, 64, 1 << 18]))
def test_clusters_are_the_plain_ones_at_any_stretch(spark, a, slack, stretch):
    before, intervals.STRETCH = intervals.STRETCH, stretch
    try:
        rows = intervals.cluster_intervals(frame(spark, a, "i"), slack).collect()
    finally:
        intervals.STRETCH = before
    want, reach, number = {}, {}, {}
    for i, (c, s, e) in sorted(enumerate(a), key=lambda x: (x[1], x[0])):
        if c not in reach or s > reach[c] + slack:
            number[c] = number.get(c, 0) + 1
        reach[c] = max(reach.get(c, e), e)
        want[i] = (c, number[c])
    assert {r.i: (r.chrom, r.cluster) for r in rows} == want


def test_no_window_holds_a_chromosome(spark):
    df = spark.range(100).selectExpr("'chr1' AS chrom", "id * 5000000 AS start_pos", "id * 5000000 + 10 AS end_pos")
    plan = intervals.cluster_intervals(df)._jdf.queryExecution().optimizedPlan().toString()
    rows = [line for line in plan.splitlines() if "Window" in line]
    assert rows and all("__stretch__" in line for line in rows)
    assert {r.cluster for r in intervals.cluster_intervals(df).collect()} == set(range(1, 101))


def test_many_annotations_are_the_single_ones(spark):
    a = spark.createDataFrame([(i, "chr1", i * 50, i * 50 + 60) for i in range(20)] + [(20, None, None, None), (21, "chr9", 1, 5)], "k long, chrom string, start_pos long, end_pos long")
    b = spark.createDataFrame([("chr1", i * 70, i * 70 + 90, f"b{i}") for i in range(9)], "chrom string, start_pos long, end_pos long, name string")
    ids = b.selectExpr("chrom", "start_pos", "end_pos", "CAST(substr(name, 2) AS long) AS name")
    specs = [
        {"action": "best", "b": ids, "name": "f", "fraction": 0.3}, {"action": "get", "b": b, "name": "g", "fraction": 0.5},
        {"action": "count", "b": b, "name": "n", "fraction": 0.9}, {"action": "best", "b": b, "name": "h"}, {"action": "get", "b": ids, "name": "q"},
    ]
    many = intervals.annotate_many(a, "k", specs)
    assert many.columns == [*a.columns, "f", "g", "n", "h", "q"] and dict(many.dtypes)["f"] == "bigint"
    one = {"best": intervals.annotate_best, "get": intervals.annotate_get, "count": intervals.annotate_count}
    for s in specs:
        want = one[s["action"]](a, "k", s["b"], s["name"], s.get("fraction", 0.0)).select("k", s["name"]).distinct()
        assert sorted(map(repr, want.collect())) == sorted(map(repr, many.select("k", s["name"]).distinct().collect()))
    assert many.where("k >= 20").count() == 2
