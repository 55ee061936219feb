"""Lines joined with their orders are dealt out by order into partitions that grow with the tables (F5)."""

from pyspark.sql import functions as F

from botiquin.plans import roles
from botiquin.plans.roles import Tables


def test_lines_of_orders_spread_by_table_bytes(spark, tmp_path, monkeypatch):
    lines = [(k % 7, n, float(k)) for k in range(60) for n in (1, 2)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double").write.parquet(
        str(tmp_path / "lineitem.parquet")
    )
    spark.createDataFrame([(k, f"o{k}") for k in range(5)], "o_orderkey long, o_comment string").write.parquet(
        str(tmp_path / "orders.parquet")
    )
    t = Tables(spark, str(tmp_path))
    plain = sorted(t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).collect())
    monkeypatch.setattr(roles, "_TABLE_BYTES", 64)
    joined = roles.lines_of_orders(t)
    assert joined.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(joined.collect()) == plain
