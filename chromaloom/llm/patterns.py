"""Distinct counts over large identifier sets, by membership patterns.

Each identifier is reduced to the set of cells that contain it, and identical sets are counted:
the pattern totals. The number of distinct identifiers in any combination of cells (a union, an
intersection, cells of one and not of another) is the sum of the totals of the patterns that
fulfil it, so answers are exact: the error bound is 0. Totals over disjoint sets of identifiers
merge by addition; parts over overlapping sets merge from their memberships.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settled


def cells_of(rows: DataFrame, dims: Sequence[str]) -> tuple[DataFrame, int]:
    """The cells (combinations of dims) with their number of rows and a 64-bit code for each; and the codes' seed.

    Codes are hashes; they are checked to differ, and made anew from another seed if they don't,
    so that nothing depends on luck.
    """
    counted = settled(rows.groupBy(*dims).agg(F.count(F.lit(1)).alias("n_records")), "cells")
    for seed in range(64):
        coded = counted.withColumn("cell", cell_code(dims, seed))
        if not coded.groupBy("cell").count().where("count > 1").head(1):
            return coded, seed
    raise RuntimeError("no seed gives different codes; there are too many cells")


def cell_code(dims: Sequence[str], seed: int) -> Column:
    # NULL leaves a hash as it was, so it gets a mark of its own
    marks = [x for d in dims for x in (F.col(d).isNull(), F.col(d))]
    return F.xxhash64(F.lit(seed), *marks)


def memberships(rows: DataFrame, identifier: str, cell: Column) -> DataFrame:
    """identifier -> the sorted set of its cells. Bounded by the cells there are, not by rows."""
    named = rows.select(F.col(identifier).alias("identifier"), cell.alias("cell")).where("identifier IS NOT NULL")
    return named.groupBy("identifier").agg(F.sort_array(F.collect_set("cell")).alias("cells"))


def merge_memberships(parts: Sequence[DataFrame]) -> DataFrame:
    """Memberships over any parts of the rows -> those over all of them."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("identifier").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("cells")))).alias("cells"))


def pattern_totals(members: DataFrame) -> DataFrame:
    """How many identifiers have each set of cells."""
    return members.groupBy("cells").agg(F.count(F.lit(1)).alias("n"))


def merge_totals(parts: Sequence[DataFrame]) -> DataFrame:
    """Totals over disjoint identifiers (shards by identifier) -> totals over all of them."""
    return reduce(DataFrame.unionByName, parts).groupBy("cells").agg(F.sum("n").alias("n"))


def distinct_per_cell(totals: DataFrame) -> DataFrame:
    return totals.select(F.explode("cells").alias("cell"), "n").groupBy("cell").agg(F.sum("n").alias("n_distinct"))


def distinct_per(totals: DataFrame, cells: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Distinct identifiers of each value of some of the cells' dimensions, from the totals.

    A pattern counts once for each value that any of its cells has.
    """
    return distinct_per_each(totals, cells, [dims]).select(*dims, "n_distinct")


def distinct_per_each(totals: DataFrame, cells: DataFrame, subsets: Sequence[Sequence[str]]) -> DataFrame:
    """As distinct_per for several sets of dimensions in one pass: all dimensions, NULL where not of the set,
    ``subset`` (the set's place in the list) and n_distinct."""
    every = list(dict.fromkeys(d for dims in subsets for d in dims))
    kinds = {d: cells.schema[d].dataType for d in every}
    numbered = totals.select(F.monotonically_increasing_id().alias("pattern"), "cells", "n")
    exploded = numbered.select("pattern", "n", F.explode("cells").alias("cell")).join(cells.select("cell", *every), "cell")
    sets = [F.struct(F.lit(i).alias("subset"), *[(F.col(d) if d in dims else F.lit(None).cast(kinds[d])).alias(d) for d in every]) for i, dims in enumerate(subsets)]
    reached = exploded.select("pattern", "n", F.explode(F.array(*sets)).alias("s")).select("pattern", "n", "s.*").distinct()
    return reached.groupBy("subset", *every).agg(F.sum("n").alias("n_distinct"))


def combination(totals: DataFrame, any_of: Column | None = None, all_of: Sequence[Column] = (), none_of: Column | None = None) -> DataFrame:
    """One row: the identifiers in a cell of ``any_of``, one of each of ``all_of`` and none of ``none_of``.

    The arguments are array columns of cell codes.
    """
    told = totals
    if any_of is not None:
        told = told.where(F.arrays_overlap("cells", any_of))
    for cells in all_of:
        told = told.where(F.arrays_overlap("cells", cells))
    if none_of is not None:
        told = told.where(~F.arrays_overlap("cells", none_of))
    return told.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_distinct"))
