"""A dedupe dealt out into more partitions keeps the same rows (F1)."""

from pyspark.sql import functions as F

from botiquin.operators.dedupe import keep_first, keep_newest_date


def test_keep_first_over_given_partitions(spark):
    rows = [("a", 3), ("a", 1), (None, 2), (None, 0), ("b", 5), ("b", 4), ("a", 1)]
    df = spark.createDataFrame(rows, "k string, _row int")
    out = keep_first(df, ["k"], "_row", partitions=37)
    assert out.rdd.getNumPartitions() == 37
    assert sorted(out.collect(), key=str) == sorted(keep_first(df, ["k"], "_row").collect(), key=str)
    assert sorted((r.k, r._row) for r in out.collect() if r.k) == [("a", 1), ("b", 4)]


def test_keep_newest_date_over_given_partitions(spark):
    rows = [("x", "1", 2, 0), ("x", "1", None, 1), ("x", "1", 2, 2), ("y", None, 1, 3), ("y", None, 1, 4)]
    df = spark.createDataFrame(rows, "a string, b string, d int, _row int")
    out = keep_newest_date(df, ["a", "b"], F.col("d"), "_row", partitions=29)
    assert out.rdd.getNumPartitions() == 29
    assert sorted(r._row for r in out.collect()) == [0, 3]
