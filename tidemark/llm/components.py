"""Connected components of a graph whose edges do not fit in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import written


# Rows of small tables that one task takes: few edges are not spread over many tasks.
TASK_ROWS = 10_000


def _gathered(df: DataFrame) -> DataFrame:
    return df.coalesce(1 + df.count() // TASK_ROWS)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node of ``links(a, b)``, both bigint.

    Each round hooks every node to its smallest neighbour if that is smaller, follows the hooks to their ends by doubling, and
    contracts the edges to those ends. Every round at least halves the nodes that still have edges. All steps are joins and
    aggregates that merge before the shuffle; nothing is gathered per node. Each step is a written table, so a lost
    executor costs one step.
    """
    edges = _gathered(written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"))
    roots = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = _gathered(written(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("root")), "hooks"))
        while True:
            ends = hooks.select(F.col("node").alias("root"), F.col("root").alias("further"))
            doubled = _gathered(written(hooks.join(ends, "root").select("node", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")), "hooks"))
            hooks = doubled.select("node", "root")
            if doubled.where("moved").isEmpty():
                break
        roots = hooks if roots is None else written(_renamed(roots, hooks, "root"), "roots")
        edges = _gathered(written(_renamed(_renamed(edges, hooks, "a"), hooks, "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"))
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _renamed(df: DataFrame, hooks: DataFrame, column: str) -> DataFrame:
    """Replace the nodes of a column by their roots; nodes without a hook stay."""
    to = hooks.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return df.join(to, column, "left").withColumn(column, F.coalesce("_root", column)).select(*df.columns)
