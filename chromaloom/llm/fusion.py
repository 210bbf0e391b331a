"""One surviving record for each group of duplicates, field by field.

``fuse`` is Bayesian fusion with copy detection. Sources vote for the values they deliver; a
source's vote weighs as its accuracy, and a value given by several sources counts less where they
seem to copy: sources that share values believed false are probably dependent. Accuracies,
dependence and beliefs are estimated in turn. Groups of equal structure (the same sources for the
same split into values) have equal beliefs, so estimation runs over distinct structures with
their number, not over groups.

``first_in_trust`` is another method, no fusion: the first record of each group in a given order.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settled


def first_in_trust(df: DataFrame, key: Column, trust: Mapping[str, Sequence[Column]], record_id: str, min_records: int = 1) -> DataFrame:
    """``key`` and, under each name of ``trust``, the id of the group's most trusted record.

    The columns of a trust order are compared from the left, the greatest first, NULL last; ties
    go to the smaller record id. One shuffle; records are combined before it, so a group may be
    of any size. Groups of fewer than ``min_records`` rows and rows with a NULL key are left out.
    """
    rows = df.select(key.alias("key"), F.col(record_id).alias("id"), *[F.struct(*order, F.bitwise_not(F.col(record_id))).alias(n) for n, order in trust.items()])
    last = [F.max(n).alias(n) for n in trust]
    kept = rows.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n"), *last).where(F.col("n") >= min_records)
    return kept.select("key", *[F.bitwise_not(F.col(n)[f"col{len(order) + 1}"]).alias(n) for n, order in trust.items()])


@dataclass(frozen=True)
class Model:
    """``false_values``: values that a source in error may give. ``prior`` and ``rate`` are of copying.

    ``accuracy`` is where sources begin, ``trusted`` what agreement is measured by in the first round.
    """

    false_values: int = 10
    prior: float = 0.2
    rate: float = 0.8
    accuracy: float = 0.8
    trusted: float = 0.9
    rounds: int = 4


def read_pattern(pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """'source:value,...' -> sources, values from 1."""
    pairs = np.array([x.split(":") for x in pattern.split(",")], np.int64)
    return pairs[:, 0], pairs[:, 1]


def beliefs(sources: np.ndarray, values: np.ndarray, accuracy: np.ndarray, dependence: np.ndarray, m: Model) -> np.ndarray:
    """Posterior of the values 1, 2, ... of one group."""
    score = np.zeros(values.max())
    for v in range(1, len(score) + 1):
        own = sources[values == v]
        own = own[np.argsort(-accuracy[own], kind="stable")]
        for i, s in enumerate(own):
            alone = np.prod(1 - m.rate * dependence[s, own[:i]])
            score[v - 1] += alone * np.log(m.false_values * accuracy[s] / (1 - accuracy[s]))
    top = max(score.max(), 0.0)
    e = np.exp(score - top)
    return e / (e.sum() + max(0, m.false_values + 1 - len(e)) * np.exp(-top))


def _pattern_beliefs(s: np.ndarray, v: np.ndarray, linked: list[dict] | None, accuracy: np.ndarray, m: Model) -> np.ndarray:
    """``beliefs`` of a pattern with the dependence of its own sources only: a, b, p."""
    own, local = np.unique(s, return_inverse=True)
    dependence = np.zeros((len(own), len(own)))
    if linked:
        i, j = (np.searchsorted(own, [x[c] for x in linked]) for c in "ab")
        dependence[i, j] = dependence[j, i] = [x["p"] for x in linked]
    return beliefs(local, v, accuracy[own], dependence, m)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Patterns -> pattern, a, b: each two sources that give the same value."""
    for batch in batches:
        for pattern in batch["pattern"].to_pylist():
            s, v = read_pattern(pattern)
            given = [np.sort(s[v == k]).tolist() for k in np.unique(v)]
            pairs = sorted({p for own in given for p in combinations(own, 2)})
            if pairs:
                yield pa.RecordBatch.from_pydict({"pattern": [pattern] * len(pairs), "a": pa.array([p[0] for p in pairs], pa.int32()), "b": pa.array([p[1] for p in pairs], pa.int32())})


def _evidence(accuracy: np.ndarray, m: Model):
    """Patterns with their number and dependence -> sums for the next estimate, added up by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[int, int], np.ndarray] = {}
            for pattern, n, linked in zip(batch["pattern"].to_pylist(), batch["n"].to_pylist(), batch["linked"].to_pylist()):
                s, v = read_pattern(pattern)
                if len(np.unique(s)) < 2:  # a lone source's claims say nothing about how good it is
                    continue
                p = _pattern_beliefs(s, v, linked, accuracy, m)[v - 1]
                for i in range(len(s)):
                    for j in range(i, len(s)):
                        a, b = (int(s[i]), int(s[j])) if s[i] <= s[j] else (int(s[j]), int(s[i]))
                        if i == j:
                            x = (p[i], 1.0, 0.0)  # its own: believed, claims
                        elif a == b:  # a source that contradicts itself says nothing about copying
                            continue
                        else:
                            x = (p[i], 1 - p[i], 0.0) if v[i] == v[j] else (0.0, 0.0, 1.0)
                        sums[a, b] = sums.get((a, b), 0) + n * np.array(x)
            keys = list(sums)
            yield pa.RecordBatch.from_pydict({"a": pa.array([k[0] for k in keys], pa.int32()), "b": pa.array([k[1] for k in keys], pa.int32()), **{c: pa.array([float(sums[k][i]) for k in keys], pa.float64()) for i, c in enumerate("xyz")}})

    return run


def dependence_of(same_true: float, same_false: float, different: float, a: float, b: float, m: Model) -> float:
    """Posterior probability that one of two sources copies the other."""
    both, neither, mean = a * b, (1 - a) * (1 - b) / m.false_values, (a + b) / 2
    apart = max(1 - both - neither, 1e-9)
    c = m.rate
    log = np.log(m.prior / (1 - m.prior)) + same_true * np.log((mean * c + both * (1 - c)) / both)
    log += same_false * np.log(((1 - mean) * c + neither * (1 - c)) / neither) + different * np.log(apart * (1 - c) / apart)
    return float(1 / (1 + np.exp(-np.clip(log, -500, 500))))


def agreement_of(same: float, different: float, m: Model) -> float:
    """The probability of copying by agreement alone, were both sources as accurate as ``m.trusted``."""
    a = m.trusted
    equal = a * a + (1 - a) * (1 - a) / m.false_values
    log = np.log(m.prior / (1 - m.prior)) + same * np.log((m.rate + (1 - m.rate) * equal) / equal) + different * np.log(1 - m.rate)
    return float(1 / (1 + np.exp(-np.clip(log, -500, 500))))


def _dependent(accuracy: np.ndarray, first: bool, m: Model):
    """Sums of two sources -> a, b, p."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch[c].to_pylist() for c in "abxyz"])
            p = [agreement_of(x + y, z, m) if first else dependence_of(x, y, z, accuracy[a], accuracy[b], m) for a, b, x, y, z in rows]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(p, pa.float64())], names=["a", "b", "p"])

    return run


def estimate(patterns: DataFrame, n_sources: int, m: Model) -> tuple[np.ndarray, DataFrame]:
    """Accuracies, and the patterns with the dependence of their sources (linked), in ``m.rounds`` rounds.

    The first round only looks for sources that agree suspiciously often, so that a crowd of copies
    can't pass for the truth before anything is known about accuracies. The driver holds a number
    for each source; what is known of each two stays in a table.
    """
    accuracy = np.full(n_sources, m.accuracy)
    agreeing = settled(patterns.mapInArrow(_agreeing, "pattern string, a int, b int"), "agreeing")
    told = patterns.withColumn("linked", F.lit(None).cast("array<struct<a:int,b:int,p:double>>"))
    for k in range(m.rounds):
        sums = told.mapInArrow(_evidence(accuracy, m), "a int, b int, x double, y double, z double")
        sums = settled(sums.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in "xyz"]), "evidence")
        if k:
            accuracy = accuracy.copy()
            for a, x, y in sums.where("a = b").select("a", "x", "y").collect():  # one row for each source
                accuracy[a] = np.clip((x + m.accuracy * 2) / (y + 2), 0.05, 0.999)
        dependence = sums.where("a <> b").mapInArrow(_dependent(accuracy, not k, m), "a int, b int, p double")
        linked = agreeing.join(dependence, ["a", "b"]).groupBy("pattern").agg(F.collect_list(F.struct("a", "b", "p")).alias("linked"))
        told = settled(patterns.join(linked, "pattern", "left").select("pattern", "n", "linked"), "linked")
    return accuracy, told


def _resolved(accuracy: np.ndarray, m: Model):
    """Patterns -> the place of the value of greatest posterior, from 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [_pattern_beliefs(*read_pattern(x), linked, accuracy, m) for x, linked in zip(batch["pattern"].to_pylist(), batch["linked"].to_pylist())]
            place, posterior = pa.array([int(p.argmax()) + 1 for p in each], pa.int32()), pa.array([float(p.max()) for p in each], pa.float64())
            yield pa.RecordBatch.from_arrays([batch["pattern"], place, posterior], names=["pattern", "place", "posterior"])

    return run


def fuse(df: DataFrame, key: Column, fields: Mapping[str, Column], source: Column, model: Model = Model()) -> DataFrame:
    """key, field, value, posterior: for each group and field the value of greatest posterior.

    ``fields`` are strings, NULL for a missing value: a group without any value of a field has no
    row for it. ``source`` names who delivered a record; the driver holds a number for each source.
    Equal votes go to the smaller value. Repeated rows count once, rows with a NULL key or source
    not at all.
    """
    values = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), v.cast("string").alias("value")) for n, v in fields.items()]))
    claims = df.select(key.alias("key"), source.cast("string").alias("source"), values.alias("f"))
    told = claims.select("key", "f.field", "f.value", F.concat_ws("|", "f.field", "source").alias("name"), "source")
    told = told.where("key IS NOT NULL AND value IS NOT NULL AND source IS NOT NULL").drop("source")
    names = sorted(r[0] for r in told.select("name").distinct().collect())
    numbers = df.sparkSession.createDataFrame([(x, k) for k, x in enumerate(names)], "name string, s int")
    told = told.join(numbers, "name").select("key", "field", F.struct("s", "value").alias("c"))
    # what is gathered for a group is bounded by sources times values, not by its records
    grouped = told.groupBy("key", "field").agg(F.collect_set("c").alias("c"))
    grouped = grouped.withColumn("vals", F.array_sort(F.array_distinct("c.value")))
    told_by = F.transform("c", lambda c: F.concat_ws(":", c["s"].cast("string"), F.array_position("vals", c["value"]).cast("string")))
    grouped = settled(grouped.select("key", "field", "vals", F.array_join(F.array_sort(told_by), ",").alias("pattern")), "claims")
    patterns = settled(grouped.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "patterns")
    accuracy, linked = estimate(patterns, len(names), model)
    best = linked.mapInArrow(_resolved(accuracy, model), "pattern string, place int, posterior double")
    return grouped.join(best, "pattern").select("key", "field", F.element_at("vals", F.col("place")).alias("value"), "posterior")
