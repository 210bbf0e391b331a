from pyspark.sql import functions as F

from chromaloom.functions.text import is_missing, plain, plain_slice


def test_missing_and_plain(spark):
    rows = [(None, True), ("", True), (" ", True), (".", True), ("-_*", True), ("a", False), (" 7 ", False), ("é", False), ("核", False)]
    df = spark.createDataFrame(rows, "x string, missing boolean")
    assert df.where(is_missing(F.col("x")) != F.col("missing")).count() == 0
    out = spark.createDataFrame([(" \t Ab C　\n",)], "x string").select(plain(F.col("x"))).first()[0]
    assert out == "ab c"


def test_slice_names(spark):
    rows = [("A:1|PE|01|007", "a:1|pe|1|7"), (" a:1 | pe | 1 | 7\t", "a:1|pe|1|7"), ("a|b", "a|b"), ("a|pe|x|0", "a|pe|x|0"), (None, None), ("A| b |c|d|E", "a|b|c|d|e")]
    df = spark.createDataFrame(rows, "x string, y string").withColumn("z", plain_slice(F.col("x")))
    assert [(r.y, r.z) for r in df.collect() if r.y != r.z] == []
