"""Session settings and the shared working folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession

# Everything here can also be set by the cluster; nothing in the library depends on a value
# other than the time zone. AQE is what splits hot join keys and picks broadcasts from
# measured sizes, so the jobs carry no broadcast hints.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build(app_name: str = "botiquin", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where it is unset, as in tests, a folder beside the session's tables takes its place.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for one job below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate data once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def partitions_for(spark: SparkSession, paths: list[str], bytes_each: int) -> int | None:
    """A shuffle's number of partitions so that each gets about ``bytes_each`` of the files at
    ``paths``; None where the session's number already gives no more than that."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    size = 0
    for path in paths:
        found = jvm.org.apache.hadoop.fs.Path(path)
        size += found.getFileSystem(conf).getContentSummary(found).getLength()
    wanted = math.ceil(size / bytes_each)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None
