"""Tables in a relational database, through Spark's JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 1000


def scan_options(
    url: str, table: str, column: str | None = None, lower: int = 0, upper: int = 0, parts: int = 1
) -> dict[str, str]:
    """Options of a scan, split on a numeric column into ``parts`` range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000"}
    if column and parts > 1:
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return options


def scan(spark: SparkSession, url: str, table: str, **split) -> DataFrame:
    """A whole table. (SRC-3)"""
    return spark.read.format("jdbc").options(**scan_options(url, table, **split)).load()


def append(df: DataFrame, url: str, table: str, batch_rows: int = BATCH_ROWS) -> None:
    """Insert in batches from every partition. (SNK-3)"""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows)}
    df.write.format("jdbc").options(**options).mode("append").save()
