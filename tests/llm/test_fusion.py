import random

import numpy as np
from pyspark.sql import functions as F

from chromaloom.llm import fusion as f

ROWS = "id long, k string, chrom string, mm int, t long"


def test_first_in_trust_is_the_ordered_first(spark):
    r = random.Random(3)
    rows = [(i, None if r.random() < 0.05 else f"k{r.randrange(60)}", r.choice([None, "", "chr1"]), r.choice([None, 0, 1]), r.choice([None, 1, 2, 3])) for i in range(600)]
    trust = {"a": [F.col("chrom").isNotNull() & (F.col("chrom") != ""), F.col("mm").isNotNull(), F.col("t")], "b": [F.col("t")]}
    got = {x.key: (x.a, x.b) for x in f.first_in_trust(spark.createDataFrame(rows, ROWS), F.col("k"), trust, "id", 2).collect()}
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    time = lambda t: (t is None, -(t or 0))
    want = {}
    for k, g in groups.items():
        if k is not None and len(g) > 1:
            a = min(g, key=lambda x: (x[2] in (None, ""), x[3] is None, *time(x[4]), x[0]))
            b = min(g, key=lambda x: (*time(x[4]), x[0]))
            want[k] = (a[0], b[0])
    assert got == want


def test_empty_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "k", "x", 0, 1)], ROWS).withColumn("key", F.lit(1)).withColumn("n", F.lit(1))
    assert f.first_in_trust(df.limit(0), F.col("k"), {"a": [F.col("t")]}, "id").count() == 0
    assert tuple(f.first_in_trust(df, F.col("k"), {"a": [F.col("t")]}, "id").first()) == ("k", 1)
    assert f.fuse(df.limit(0), F.col("k"), {"c": F.col("chrom")}, F.col("t")).count() == 0


def claims(seed=1, items=400):
    """Three good sources, a bad one, and two that copy it."""
    r = random.Random(seed)
    rows, truth = [], {}
    for i in range(items):
        truth[f"k{i}"] = str(r.randrange(6))
        wrong = lambda: str((int(truth[f"k{i}"]) + 1 + r.randrange(5)) % 6)  # noqa: E731, B023
        for s, accuracy in (("good1", 0.9), ("good2", 0.9), ("good3", 0.85)):
            if r.random() < 0.7:
                rows.append((f"k{i}", s, truth[f"k{i}"] if r.random() < accuracy else wrong()))
        bad = truth[f"k{i}"] if r.random() < 0.4 else wrong()
        rows += [(f"k{i}", s, bad) for s in ("bad", "copy1", "copy2")]
    return rows, truth


def test_copies_are_discounted(spark):
    rows, truth = claims()
    df = spark.createDataFrame(rows, "k string, s string, v string")
    out = {x.key: x.value for x in f.fuse(df, F.col("k"), {"v": F.col("v")}, F.col("s")).collect()}
    votes = {}
    for k, _, v in rows:
        votes.setdefault(k, []).append(v)
    majority = {k: max(sorted(set(v)), key=v.count) for k, v in votes.items()}
    right = lambda m: sum(m[k] == truth[k] for k in truth) / len(truth)
    assert right(out) > 0.85 > right(majority) + 0.1


def test_beliefs_and_dependence_by_hand():
    m = f.Model()
    accuracy, none = np.array([0.8, 0.8, 0.6]), np.zeros((3, 3))
    p = f.beliefs(np.array([0, 1, 2]), np.array([1, 1, 2]), accuracy, none, m)
    a, b = (10 * 0.8 / 0.2) ** 2, 10 * 0.6 / 0.4
    assert np.allclose(p, [a / (a + b + 9), b / (a + b + 9)])
    assert f.dependence_of(0, 20, 1, 0.6, 0.6, m) > 0.99 > 0.5 > f.dependence_of(5, 0, 20, 0.6, 0.6, m)


def test_values_missing_repeated_and_tied(spark):
    rows = [("a", "s", None), ("a", "t", None), ("b", "s", "y"), ("b", "t", "x"), ("c", "s", "z"), ("c", "s", "z"), (None, "s", "q"), ("d", None, "q")]
    out = {x.key: x.value for x in f.fuse(spark.createDataFrame(rows, "k string, s string, v string"), F.col("k"), {"v": F.col("v")}, F.col("s")).collect()}
    assert out == {"b": "x", "c": "z"}
