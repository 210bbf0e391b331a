import math
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from chromaloom.llm import cooccurrence as c

ROWS = "g string, b string, i long"


def brute(rows):
    baskets = {}
    for g, b, i in rows:
        if b is not None:
            baskets.setdefault((g, b), set()).update([] if i is None else [i])
    n, one, two = Counter(), Counter(), Counter()
    for (g, _), items in baskets.items():
        n[g] += 1
        one.update((g, i) for i in items)
        two.update((g, *p) for p in combinations(sorted(items), 2))
    return {(g, a, b): (k, one[g, a], one[g, b], n[g]) for (g, a, b), k in two.items()}


def got(df):
    return {(r.grp, r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b, r.n) for r in df.collect()}


def random_rows(seed, n=1500):
    r = np.random.default_rng(seed)
    return [(str(r.integers(3)) if r.random() > 0.1 else None, f"b{r.integers(200)}" if r.random() > 0.05 else None, int(r.integers(12)) if r.random() > 0.1 else None) for _ in range(n)]


@pytest.mark.parametrize("run, block", [(1 << 22, 1024), (50, 1024), (7, 3)])
def test_counts_are_those_of_brute_force(spark, monkeypatch, run, block):
    rows = random_rows(run)
    monkeypatch.setattr(c, "RUN_CODES", run)
    monkeypatch.setattr(c, "BLOCK_ITEMS", block)
    assert got(c.cooccurrence(spark.createDataFrame(rows, ROWS), "g", "b", "i")) == brute(rows)


def test_a_large_basket_is_dealt_out_by_blocks(spark):
    baskets = spark.createDataFrame([("g", list(range(0, 33, 3))), (None, [1])], "grp string, items array<long>")
    rows = c.in_blocks(baskets, 4).collect()
    assert sorted((r.i, r.j) for r in rows if r.grp) == [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]
    codes = np.concatenate([x for r in rows if r.grp for x in c._block_codes(r.i == 0, np.array(r.one), None if r.i == r.j else np.array(r.other))])
    assert sorted(codes.tolist()) == sorted([-1] + [(a << 32) | b for a in range(0, 33, 3) for b in range(0, 33, 3) if a <= b])


def test_one_basket_of_many_items(spark):
    n = 3000
    df = spark.range(n).selectExpr("'g' AS g", "'hot' AS b", "id AS i").unionByName(spark.createDataFrame([("g", "x", 0), ("g", "x", n - 1)], ROWS).selectExpr("g", "b", "i"))
    out = c.cooccurrence(df, "g", "b", "i")
    assert out.count() == n * (n - 1) // 2
    assert got(out.where("n_ab = 2")) == {("g", 0, n - 1): (2, 2, 2, 2)}


def test_measures_and_least_count(spark):
    rows = [("g", str(k), i) for k in range(6) for i in ((1, 2) if k < 4 else (3,))]
    one = c.cooccurrence(spark.createDataFrame(rows, ROWS), "g", "b", "i", min_count=4).collect()
    assert len(one) == 1 and one[0].lift == 1.5 and math.isclose(one[0].log_odds, math.log(4.5 * 2.5 / (0.5 * 0.5)))
    assert c.cooccurrence(spark.createDataFrame(rows, ROWS), "g", "b", "i", min_count=5).count() == 0


def test_empty_single_and_out_of_range(spark):
    assert c.cooccurrence(spark.createDataFrame([], ROWS), "g", "b", "i").count() == 0
    assert c.cooccurrence(spark.createDataFrame([("g", "b", 1), ("g", None, 2), (None, "b", None)], ROWS), "g", "b", "i").count() == 0
    clash = spark.createDataFrame([("g", "b", 1, 5, 6), ("g", "b", 2, 5, 6), ("g", "b", 2, 5, 6)], "grp string, basket string, item long, n long, code long")
    assert got(c.cooccurrence(clash, "grp", "basket", "item")) == {("g", 1, 2): (1, 1, 1, 1)}
    with pytest.raises(Exception, match="packed"):
        c.cooccurrence(spark.createDataFrame([("g", "b", 1 << 31)], ROWS), "g", "b", "i").count()


def test_a_basket_with_a_third_of_all_rows(spark):
    rows = [("g", "hot", i % 40) for i in range(4000)] + [("g", f"b{i % 900}", i % 7) for i in range(8000)]
    assert got(c.cooccurrence(spark.createDataFrame(rows, ROWS), "g", "b", "i")) == brute(rows)
