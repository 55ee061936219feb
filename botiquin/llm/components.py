"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botiquin.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for all nodes of edges ``a``, ``b``.

    Every round hooks each root to its smallest neighbouring root, shortens the chains that arise,
    and carries the edges over to the roots, until none joins two of them. Rounds grow with the
    logarithm of the longest path. Tables of each round are written to the shared folder. Null ends
    and loops are ignored; an empty table gives none.
    """
    edges = stored(edges.where("a < b or a > b").select("a", "b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = stored(nodes.select("node", F.col("node").alias("component")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = both.groupBy("a").agg(F.min("b").alias("root")).where("root < a")
        hooks = _shortened(stored(hooks.select(F.col("a").alias("node"), "root"), "hooks"))
        labels = stored(
            labels.join(hooks.withColumnRenamed("node", "component"), "component", "left")
            .select("node", F.coalesce("root", "component").alias("component")),
            "labels",
        )
        edges = stored(_moved(_moved(edges, hooks, "a"), hooks, "b").where("a <> b").distinct(), "edges")
    return labels


def _shortened(hooks: DataFrame) -> DataFrame:
    """Point each node at the end of its chain of hooks, by doubling."""
    while True:
        further = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
        if hooks.join(further, "root", "left_semi").isEmpty():
            return hooks
        hooks = stored(
            hooks.join(further, "root", "left")
            .select("node", F.coalesce("next", "root").alias("root")),
            "hooks",
        )


def _moved(edges: DataFrame, hooks: DataFrame, end: str) -> DataFrame:
    return edges.join(hooks.withColumnRenamed("node", end), end, "left").select(
        *[F.coalesce("root", c).alias(c) if c == end else c for c in ("a", "b")]
    )
