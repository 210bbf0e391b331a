import pytest
from pyspark.sql import functions as F

from chromaloom.operators import tree_aggregate as t


def rows(spark):
    data = [("hot" if i % 3 else None if i % 2 else f"k{i}", i) for i in range(1000)]
    return spark.createDataFrame(data, "k string, x long").repartition(7)


@pytest.mark.parametrize("chunk_rows, fan_in, rounds", [(1, 2, 4), (10, 3, 2), (65_536, 16, None), (7, 2, 1)])
def test_the_tree_gives_what_one_group_by_gives(spark, chunk_rows, fan_in, rounds):
    df = rows(spark)
    states = {"n": t.counting(), "s": t.summing(F.col("x")), "low": t.least(F.col("x")), "high": t.greatest(F.col("x"))}
    got = t.tree_aggregate(df, ["k"], states, chunk_rows, fan_in, rounds)
    want = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.min("x").alias("low"), F.max("x").alias("high"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_empty_and_clashing_names(spark):
    assert t.tree_aggregate(rows(spark).limit(0), ["k"], {"n": t.counting()}).count() == 0
    df = rows(spark).withColumn("n", F.lit(5)).withColumn("extra", F.lit("x"))
    assert t.tree_aggregate(df, ["k"], {"n": t.summing(F.col("n"))}).where("k = 'hot'").first().n == 5 * 666
    with pytest.raises(ValueError):
        t.tree_aggregate(df, ["k"], {"n": t.counting()}, fan_in=1)
