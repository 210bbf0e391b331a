"""Items into containers of fixed capacity, by sum-of-squares packing.

Each item goes where the sum of the squared numbers of open containers per remaining gap becomes
smallest, which keeps gaps of all sizes at hand and wastes little on most mixes of sizes. Items are
dealt by hash to shards of a bounded number, each packed by itself: the containers that a shard
leaves partly filled are the price, a few in thousands. Only an item larger than the capacity is
cut, into full containers and a rest.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_ITEMS = 16_384


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container (0, 1, ...) of each item; sizes from 1 to the capacity, taken in their order.

    Of equal placements the fullest container's is taken, and a new container last.
    """
    number = np.zeros(capacity + 1, np.int64)  # open containers of each gap
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    out, opened = np.empty(len(sizes), np.int64), 0
    never = np.int64(1) << 40
    for i, size in enumerate(sizes.tolist()):
        before = number[size:]
        cost = 2 * (number[: capacity - size + 1] - before) + 2
        cost[before == 0] = never
        if before[0]:
            cost[0] = 1 - 2 * before[0]  # filled up: it is no open container any more
        cost[-1] = 2 * number[capacity - size] + 1 if size < capacity else 0
        left = int(cost.argmin())
        gap = left + size
        if gap == capacity:
            place, opened = opened, opened + 1
        else:
            place = open_at[gap].pop()
            number[gap] -= 1
        out[i] = place
        if left:
            open_at[left].append(place)
            number[left] += 1
    return out


def pack_sizes(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The containers by the better of two orders: as they come, and by falling size."""
    first = sum_of_squares(sizes, capacity)
    falling = np.argsort(-sizes, kind="stable")
    second = np.empty_like(first)
    second[falling] = sum_of_squares(sizes[falling], capacity)
    return second if len(sizes) and second.max() < first.max() else first


def pieces_of(tokens: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which item each piece is of, its first token and its size; an empty item is one empty piece."""
    n = np.maximum(1, -(-tokens // capacity))
    of = np.repeat(np.arange(len(tokens)), n)
    first = (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * capacity
    return of, first, np.minimum(tokens[of] - first, capacity)


def pack_shard(tokens: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Item, first token, size and container of each piece."""
    of, first, size = pieces_of(tokens, capacity)
    place = np.zeros(len(of), np.int64)
    some = np.flatnonzero(size > 0)
    place[some] = pack_sizes(size[some], capacity)  # empty pieces lie in container 0, opened or not
    return of, first, size, place


def _packed(group: pa.Table) -> pa.Table:
    key, tokens = group["key"].to_numpy(), group["n_tokens"].to_numpy()
    order = np.lexsort((tokens, key, group["h"].to_numpy()))
    key, tokens = key[order], tokens[order]
    capacity, shard = group["capacity"][0].as_py(), group["shard"][0].as_py()
    of, first, size, place = pack_shard(tokens, capacity)
    kind = pa.array([group["container_kind"][0].as_py()], pa.string()).take(pa.array(np.zeros(len(of), np.int32)))
    return pa.table({"container_kind": kind, "container_id": pa.array((shard << 32) + place), "key": pa.array(key[of]), "first_token": pa.array(first), "n_tokens": pa.array(size)})


def pack(items: DataFrame, key: str, size: str, containers: list[tuple[str, int]], n_items: int | None = None, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """container_kind, container_id, key, first_token, n_tokens: one row for each item or piece and kind.

    ``containers`` are (kind, capacity); ids are unique within a kind. Items of size 0 (or NULL)
    are placed too, using no room. Repeated rows are items of their own, rows with a NULL key are left
    out. No items or no containers give no rows. ``n_items`` (counted unless given) sets the number of
    shards of about ``shard_items``.
    """
    schema = f"container_kind string, container_id long, {key} long, first_token long, n_tokens long"
    rows = items.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("n_tokens"))
    kinds = [F.struct(F.lit(k).alias("container_kind"), F.lit(c).cast("long").alias("capacity")) for k, c in containers if c >= 1]
    if not kinds:
        return items.sparkSession.createDataFrame([], schema)
    shards = max(1, math.ceil((items.count() if n_items is None else n_items) / shard_items))
    dealt = rows.where("key IS NOT NULL").withColumn("h", F.xxhash64("key"))
    dealt = dealt.select("*", F.pmod("h", F.lit(shards)).alias("shard"), F.explode(F.array(*kinds)).alias("k"))
    dealt = dealt.select("key", "n_tokens", "h", "shard", "k.container_kind", "k.capacity")
    placed = dealt.groupBy("container_kind", "shard").applyInArrow(_packed, "container_kind string, container_id long, key long, first_token long, n_tokens long")
    return placed.withColumnRenamed("key", key)
