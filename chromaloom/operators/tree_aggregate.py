"""Aggregation per key by a tree of merges, for keys that hold most of the rows.

Rows are numbered within their input partition and cut into chunks of a fixed size. Each
chunk is combined where it lies (the map side of the first shuffle), chunk states are spread
over ``fan_in ** rounds`` leaves, and in each round ``fan_in`` neighbouring leaves are merged.
No task ever receives more than about ``fan_in`` states of a key, however many rows or input
partitions the key has.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LEAF, _ROW = "__leaf__", "__row__"


@dataclass(frozen=True)
class State:
    """A mergeable aggregate: ``first`` makes a state from rows, ``merge`` one from states."""

    first: Column
    merge: str  # name of a function of one column

    def merged(self, name: str) -> Column:
        return getattr(F, self.merge)(name).alias(name)


def counting() -> State:
    return State(F.count(F.lit(1)), "sum")


def summing(c: Column) -> State:
    return State(F.sum(c), "sum")


def least(c: Column) -> State:
    return State(F.min(c), "min")


def greatest(c: Column) -> State:
    return State(F.max(c), "max")


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size of the optimized plan; only the number of rounds depends on it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def rounds_for(chunks: float, fan_in: int) -> int:
    return max(1, math.ceil(math.log(max(chunks, 2), fan_in)))


def tree_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    states: Mapping[str, State],
    chunk_rows: int = 65_536,
    fan_in: int = 16,
    rounds: int | None = None,
) -> DataFrame:
    """One row per key with its states, merged along a tree.

    NULL is a key like any other. An empty table gives no rows. Columns outside ``keys`` are
    only read by ``states``. ``rounds`` follows from the estimated size unless given; the
    result doesn't depend on it, nor on ``chunk_rows`` and ``fan_in``.
    """
    if fan_in < 2 or chunk_rows < 1:
        raise ValueError("fan_in must be 2 at least, chunk_rows 1 at least")
    if rounds is None:
        rounds = min(8, rounds_for(estimated_bytes(df) / (chunk_rows * 64), fan_in))
    keys = list(keys)
    numbered = df.withColumn(_ROW, F.monotonically_increasing_id())
    # the upper 31 bits number the partition, the lower 33 the row in it
    chunk = F.xxhash64(F.shiftright(_ROW, 33), F.floor(F.col(_ROW).bitwiseAND(F.lit((1 << 33) - 1)) / chunk_rows))
    level = numbered.withColumn(_LEAF, F.pmod(chunk, F.lit(fan_in**rounds)))
    level = level.groupBy(*keys, _LEAF).agg(*[s.first.alias(n) for n, s in states.items()])
    for left in range(rounds - 1, 0, -1):
        leaf = F.pmod(F.col(_LEAF), F.lit(fan_in**left)).alias(_LEAF)
        level = level.groupBy(*keys, leaf).agg(*[s.merged(n) for n, s in states.items()])
    return level.groupBy(*keys).agg(*[s.merged(n) for n, s in states.items()])
