"""Items that appear together: pair counts by an external sort of packed 64-bit codes.

Each basket becomes its set of items, and each pair of items one 64-bit code, the smaller item in
the upper 32 bits. Codes are gathered into runs of a bounded number, sorted and run-length
counted before anything is shuffled; Spark's shuffle sort spills the runs and merges them, and a
last streaming pass adds up the counts of equal codes. An item alone is the code of the item with
itself, and the code -1 counts baskets, so one pass gives pair, item and basket counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled

#: Codes gathered before a run is sorted and counted: 32 MB.
RUN_CODES = 1 << 22
#: Items of a basket whose pairs are made by one task; of longer baskets each two blocks are a row of their own.
BLOCK_ITEMS = 1024
LARGEST_ITEM = (1 << 31) - 1
RUNS = "grp string, code long, n long"


def _pairs(matrix: np.ndarray) -> np.ndarray:
    """Packed pairs of each row of a matrix whose rows rise."""
    a, b = np.triu_indices(matrix.shape[1], 1)
    return ((matrix[:, a] << 32) | matrix[:, b]).ravel()


def _codes(offsets: np.ndarray, items: np.ndarray) -> Iterator[np.ndarray]:
    """All codes of some baskets (rising items between offsets), in arrays of bounded size."""
    yield np.full(len(offsets) - 1, -1, np.int64)
    yield (items << 32) | items
    sizes = np.diff(offsets)
    for k in np.unique(sizes):
        if k < 2:
            continue
        starts = offsets[:-1][sizes == k]
        step = max(1, RUN_CODES // int(k * (k - 1) // 2))
        for i in range(0, len(starts), step):
            yield _pairs(items[starts[i : i + step, None] + np.arange(k)])


def _block_codes(first: bool, one: np.ndarray, other: np.ndarray | None) -> Iterator[np.ndarray]:
    """The codes of a large basket's block with itself, or with a later block."""
    if other is not None:
        yield ((one[:, None] << 32) | other[None, :]).ravel()
        return
    if first:
        yield np.full(1, -1, np.int64)
    yield (one << 32) | one
    yield _pairs(one[None, :])


def _run(groups: list[str | None], gathered: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for g, arrays in gathered.items():
        codes, n = np.unique(np.concatenate(arrays), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([groups[g]], pa.string()).take(pa.array(np.zeros(len(codes), np.int32))), pa.array(codes), pa.array(n.astype(np.int64))],
            names=["grp", "code", "n"],
        )


def _checked(items: np.ndarray) -> np.ndarray:
    if len(items) and (items.min() < 0 or items.max() > LARGEST_ITEM):
        raise ValueError(f"items must lie between 0 and {LARGEST_ITEM} to be packed in pairs")
    return items


class _Runs:
    """Gathers codes by group, and gives them out as sorted, counted runs."""

    def __init__(self) -> None:
        self.groups: list[str | None] = []
        self.number: dict[str | None, int] = {}
        self.gathered: dict[int, list[np.ndarray]] = {}
        self.held = 0

    def add(self, group: str | None, codes: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if group not in self.number:
            self.number[group] = len(self.groups)
            self.groups.append(group)
        for c in codes:
            self.gathered.setdefault(self.number[group], []).append(c)
            self.held += len(c)
            if self.held >= RUN_CODES:
                yield from self.out()

    def out(self) -> Iterator[pa.RecordBatch]:
        yield from _run(self.groups, self.gathered)
        self.gathered, self.held = {}, 0


def _sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Baskets (grp, items) -> sorted, counted runs of codes."""
    runs = _Runs()
    for batch in batches:
        lists = batch["items"]
        offsets = lists.offsets.to_numpy().astype(np.int64)
        items = _checked(lists.values.to_numpy())
        names = batch["grp"].dictionary_encode()
        of = names.indices.fill_null(-1).to_numpy()
        known = names.dictionary.to_pylist()
        for i in np.unique(of):
            rows = np.flatnonzero(of == i)
            sizes = offsets[rows + 1] - offsets[rows]
            own = np.concatenate([[0], np.cumsum(sizes)])
            taken = items[np.repeat(offsets[rows] - own[:-1], sizes) + np.arange(own[-1])]
            yield from runs.add(None if i < 0 else known[i], _codes(own, taken))
    yield from runs.out()


def _block_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two blocks of a large basket (grp, i, j, one, other) in a row -> runs."""
    runs = _Runs()
    for batch in batches:
        for k in range(batch.num_rows):
            i, j = batch["i"][k].as_py(), batch["j"][k].as_py()
            one, other = (_checked(batch[c][k].values.to_numpy()) for c in ("one", "other"))
            yield from runs.add(batch["grp"][k].as_py(), _block_codes(i == 0, one, None if i == j else other))
    yield from runs.out()


def in_blocks(baskets: DataFrame, block: int) -> DataFrame:
    """Each two blocks of a basket in a row of its own, spread over all tasks: grp, i <= j, one, other."""
    last = F.floor((F.size("items") - 1) / block).cast("int")
    pairs = baskets.select("grp", "items", F.explode(F.sequence(F.lit(0), last)).alias("i"), last.alias("last"))
    pairs = pairs.select("grp", "items", "i", F.explode(F.sequence("i", "last")).alias("j"))
    of = lambda k: F.slice("items", F.col(k) * block + 1, block)
    return pairs.select("grp", "i", "j", of("i").alias("one"), of("j").alias("other")).repartition("grp", "i", "j", F.xxhash64("one"))


def _merged(min_count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts in order of (grp, code) -> one row for each; pairs below min_count are left out."""
        carry: tuple | None = None

        def batch_of(g, codes, n):
            keep = (n >= min_count) | (codes < 0) | (codes >> 32 == codes & 0xFFFFFFFF)
            return pa.RecordBatch.from_arrays([pa.array([g], pa.string()).take(pa.array(np.zeros(int(keep.sum()), np.int32))), pa.array(codes[keep]), pa.array(n[keep])], names=["grp", "code", "n"])

        for batch in batches:
            names = batch["grp"].dictionary_encode()
            of, known = names.indices.fill_null(-1).to_numpy(), names.dictionary.to_pylist()
            code, n = batch["code"].to_numpy(), batch["n"].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else []
            for start, stop in zip(starts, [*starts[1:], len(of)]):
                g = None if of[start] < 0 else known[of[start]]
                c, m = code[start:stop], n[start:stop]
                if carry and carry[0] == g:
                    c, m = np.concatenate([[carry[1]], c]), np.concatenate([[carry[2]], m])
                elif carry:
                    yield batch_of(carry[0], np.array([carry[1]], np.int64), np.array([carry[2]], np.int64))
                first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
                total = np.add.reduceat(m, first)
                carry = (g, int(c[first[-1]]), int(total[-1]))
                if len(first) > 1:
                    yield batch_of(g, c[first[:-1]], total[:-1])
        if carry:
            yield batch_of(carry[0], np.array([carry[1]], np.int64), np.array([carry[2]], np.int64))

    return run


def cooccurrence(df: DataFrame, group: str, basket: str, item: str, min_count: int = 1) -> DataFrame:
    """grp, item_a < item_b, n_ab, n_a, n_b, n and how much more often than chance.

    ``n`` counts the group's different baskets, those without items among them; ``n_a`` and ``n_b``
    those with the item, ``n_ab`` those with both. ``lift`` is n_ab * n / (n_a * n_b), and
    ``log_odds`` the logarithm of the odds ratio with half a basket added to each cell, so it is
    finite also when a cell is empty.

    Items are whole numbers from 0 to 2**31 - 1; others raise. Rows with a NULL basket are left
    out, a NULL item only counts its basket, repeated rows count once, a NULL group is a group.
    Pairs in fewer than ``min_count`` baskets are left out, after all have been counted.
    """
    rows = df.select(F.col(group).cast("string").alias("grp"), F.col(basket).alias("basket"), F.col(item).cast("long").alias("item"))
    # a basket's distinct items are bounded by the items there are; repeated rows collapse before the shuffle
    baskets = rows.where("basket IS NOT NULL").groupBy("grp", "basket").agg(F.sort_array(F.collect_set("item")).alias("items"))
    # baskets with many items are dealt out by blocks; both branches read one shuffle
    runs = baskets.where(F.size("items") <= BLOCK_ITEMS).select("grp", "items").mapInArrow(_sorted_runs, RUNS)
    runs = runs.unionByName(in_blocks(baskets.where(F.size("items") > BLOCK_ITEMS), BLOCK_ITEMS).mapInArrow(_block_runs, RUNS))
    merged = runs.repartition("grp", "code").sortWithinPartitions("grp", "code").mapInArrow(_merged(min_count), RUNS)
    counts = settled(merged, "pair-counts").select(
        "grp", "n", "code", F.shiftright("code", 32).alias("a"), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")
    )
    totals = counts.where("code = -1").select(F.col("grp").alias("gt"), F.col("n").alias("n_all"))
    alone = counts.where("code >= 0 AND a = b")
    one = alone.select(F.col("grp").alias("ga"), F.col("a").alias("ia"), F.col("n").alias("n_a"))
    two = alone.select(F.col("grp").alias("gb"), F.col("a").alias("ib"), F.col("n").alias("n_b"))
    pairs = counts.where("code >= 0 AND a <> b").select("grp", F.col("a").alias("item_a"), F.col("b").alias("item_b"), F.col("n").alias("n_ab"))
    joined = (
        pairs.join(one, F.col("grp").eqNullSafe(F.col("ga")) & (F.col("item_a") == F.col("ia")))
        .join(two, F.col("grp").eqNullSafe(F.col("gb")) & (F.col("item_b") == F.col("ib")))
        .join(totals, F.col("grp").eqNullSafe(F.col("gt")))
    )
    half = F.lit(0.5)
    neither = F.col("n_all") - F.col("n_a") - F.col("n_b") + F.col("n_ab")
    odds = F.log((F.col("n_ab") + half) * (neither + half) / ((F.col("n_a") - F.col("n_ab") + half) * (F.col("n_b") - F.col("n_ab") + half)))
    return joined.select(
        "grp", "item_a", "item_b", "n_ab", "n_a", "n_b", F.col("n_all").alias("n"),
        (F.col("n_ab") * F.col("n_all") / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"), odds.alias("log_odds"),
    )
