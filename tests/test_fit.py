import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from chromaloom.operators import fit, pileup


def test_log_gamma_and_trigamma():
    x = np.array([1e-6, 0.3, 1.0, 2.5, 40.0, 1e6])
    assert np.allclose(fit.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-9)
    assert abs(fit.trigamma(1.0) - math.pi**2 / 6) < 1e-7


def simulated(seed=3, places=600, k=4, dispersion=0.1):
    r = np.random.default_rng(seed)
    base = r.uniform(30, 300, places)
    change = np.where(np.arange(places) % 10 == 0, r.choice([-2.0, 2.0], places), 0.0)  # log2, in one of ten
    factor = np.array([1.0, 1.4, 0.8, 1.1, 0.9, 1.2, 1.0, 0.7][: 2 * k])
    mu = base[:, None] * factor * np.where(np.arange(2 * k) >= k, 2.0 ** change[:, None], 1.0)
    return r.poisson(r.gamma(1 / dispersion, mu * dispersion)), change, factor


def test_dispersion_and_means_by_likelihood():
    n, change, factor = simulated(places=400)
    side = np.tile([0.0] * 4 + [1.0] * 4, (400, 1))
    s = np.tile(factor, (400, 1))
    own = fit._best(n.astype(float), fit._fitted_means(n.astype(float), s, side, np.full(400, 0.1)), side)
    assert 0.07 < np.median(own) < 0.13
    q = fit.group_means(n.astype(float), s, side, np.full(400, 0.1))
    score = ((n - s * q[:, :1]) / (1 + 0.1 * s * q[:, :1]))[:, :4].sum(1)
    assert np.abs(score).max() < 1e-6  # the likelihood's slope is 0
    one = fit.trend(pd.DataFrame({"viewpoint": "v", "base_mean": n.mean(1), "own": own})).iloc[0]
    assert 0.05 < one.asymptote + one.slope / 150 < 0.15


def test_changes_are_found_and_false_ones_are_few(spark):
    n, change, _ = simulated()
    samples = [f"a{i}" for i in range(4)] + [f"b{i}" for i in range(4)]
    rows = [(s, "v", "chr1", p * 10, p * 10 + 10, int(n[p, i])) for p in range(len(n)) for i, s in enumerate(samples) if n[p, i]]
    track = spark.createDataFrame(rows, "sample string, viewpoint string, chrom string, start_pos long, end_pos long, n long")
    design = spark.createDataFrame([(s, s[0]) for s in samples], "sample string, condition string")
    out = pileup.differential(track, design, "a", "b").toPandas().set_index("start_pos")
    true = {p * 10 for p in range(len(n)) if change[p]}
    found = set(out.index[out.p_adjusted <= 0.05])
    assert len(found & true) >= 0.9 * len(true) and len(found - true) <= 0.12 * len(found)
    assert np.corrcoef([out.log2_fold_change[p] for p in sorted(true)], [change[p // 10] for p in sorted(true)])[0, 1] > 0.95
    assert (out.shrunken.abs() <= out.log2_fold_change.abs() + 1e-12).all() and out.p_value.between(0, 1).all()
    left = pileup.differential(track, design, "a", "b", most=0.05)
    assert left.count() == len(found)


def test_two_samples_empty_and_pairs(spark):
    schema = "sample string, viewpoint string, chrom string, start_pos long, end_pos long, n long"
    rows = [(s, "v", "chr1", p, p + 1, 10 + p) for s in "xyz" for p in range(5)]
    design = spark.createDataFrame([("x", "a"), ("y", "b"), ("z", "c")], "sample string, condition string")
    out = pileup.differential_pairs(spark.createDataFrame(rows, schema), design)
    assert {(r.a, r.b) for r in out.collect()} == {("b", "a"), ("c", "a"), ("c", "b")} and out.where(F.abs("log2_fold_change") > 1e-9).count() == 0
    assert pileup.differential_pairs(spark.createDataFrame([], schema), design).count() == 0
    assert pileup.differential_pairs(spark.createDataFrame(rows, schema), design.limit(1)).count() == 0
    assert pileup.differential_pairs(spark.createDataFrame(rows, schema), design, over=12).select("start_pos").distinct().count() == 3
