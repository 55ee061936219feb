"""Boards deal their lines out as seldom as their joins allow (round 4: F1 board_legacy, F2 low_coverage)."""

import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from botiquin.plans import kpis, roles
from botiquin.plans.board import board
from botiquin.plans.registered import QUERIES, plain
from botiquin.plans.roles import AS_OF, Tables


@pytest.fixture
def folder(spark, tmp_path):
    """Tables in which keys are missing, come twice or match nothing."""
    n = F.col("id")
    text = lambda name, c: F.concat(F.lit(name), c.cast("string"))
    pick = lambda c, *values: F.get(F.array(*map(F.lit, values)), (c % len(values)).cast("int"))
    tables = {
        "lineitem": spark.range(900).select(
            F.when(n % 97 > 0, n % 110).alias("l_orderkey"),
            F.when(n % 41 > 0, n * 7 % 60).alias("l_partkey"),
            F.when(n % 53 > 0, n * 3 % 21).alias("l_suppkey"),
            (n % 7 + 1).cast("int").alias("l_linenumber"),
            (n % 50 + 1).cast("double").alias("l_quantity"),
            (n * 17 % 9000 + 0.25).cast("double").alias("l_extendedprice"),
            (n % 11 / 100).cast("double").alias("l_discount"),
            F.lit(0.0).alias("l_tax"),
            pick(n, "A", "N", "R", None).alias("l_returnflag"),
            pick(n, "O", "F", None).alias("l_linestatus"),
            F.timestamp_seconds(F.lit(990_000_000) + n * 40_000).alias("l_shipdate"),
        ),
        "orders": spark.range(105).select(
            F.when(n > 0, n % 101).alias("o_orderkey"),
            (n % 13).alias("o_custkey"),
            pick(n, "F", "O", "P", None).alias("o_orderstatus"),
            (n * 10.5).cast("double").alias("o_totalprice"),
            F.timestamp_seconds(n).alias("o_orderdate"),
            pick(n, "1-URGENT", " 2-HIGH", None).alias("o_orderpriority"),
        ),
        "part": spark.range(62).select(
            F.when(n > 0, n % 58).alias("p_partkey"), text("p", n % 58).alias("p_name"),
            (n % 30).cast("int").alias("p_size"),
        ),
        "supplier": spark.range(22).select(
            F.when(n > 0, n % 19).alias("s_suppkey"), text("s", n % 19).alias("s_name"),
            (n % 5).cast("int").alias("s_nationkey"),
        ),
        "customer": spark.range(12).select(
            n.alias("c_custkey"), text("c", n).alias("c_name"), (n % 5).cast("int").alias("c_nationkey"),
            pick(n, "BUILDING", "FURNITURE", None).alias("c_mktsegment"),
        ),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    sizes = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in sizes:
        spark.conf.set(key, "-1")
    yield str(tmp_path)
    for key in sizes:
        spark.conf.unset(key)


def ran(df):
    """The rows, and by what the shuffles behind them dealt rows out."""
    rows = sorted(map(str, df.collect()))
    final = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    made = re.findall(r"[+:]- Exchange hashpartitioning\((.*), \d+\),", final)
    return rows, Counter(re.sub(r"#\d+L?", "", keys) for keys in made)


@pytest.mark.parametrize("spread", [False, True])
def test_legacy_board_shuffles(spark, folder, monkeypatch, spread):
    """Execution and orders read one exchange of lines with their suppliers, stock joins where the
    lines lie since they got their names, and all joins by call share one exchange of lines."""
    if spread:
        monkeypatch.setattr(roles, "_TABLE_BYTES", 2048)
    t = Tables(spark, folder)
    want = sorted(map(str, plain(board(roles.board_inputs(t), AS_OF, legacy=True)).collect()))
    rows, dealt = ran(QUERIES["board_legacy"](spark, folder))
    assert rows == want and len(rows) > 500
    assert dealt["l_suppkey"] == 2              # lines; lots
    assert dealt["l_orderkey"] == 2             # lines with suppliers; requests
    assert dealt["codigo"] == 2                 # stock; stock with lots
    assert dealt["id_llamado"] == 2             # lines; contracts
    assert not any(keys.startswith("id_llamado,") for keys in dealt)


def test_low_coverage_shuffles(spark, folder):
    """Items are deduped, and joined by call, where their lines lie since they met their orders."""
    t = Tables(spark, folder)
    inputs = replace(roles.board_inputs(t), execution=roles.board_inputs(t, by_code=True).execution)
    other = kpis.low_coverage_items(board(inputs, AS_OF, dedupe_keys=roles.ITEM))
    rows, dealt = ran(QUERIES["low_coverage"](spark, folder))
    assert rows == sorted(map(str, plain(other).collect())) and len(rows) > 50
    assert dealt["l_orderkey"] == 3             # named lines; order lines; requests
    assert dealt["codigo"] == 3                 # stock; stock with lots; board lines
    assert dealt["id_llamado"] == 1             # contracts
    assert not any(keys.startswith("id_llamado,") for keys in dealt)
