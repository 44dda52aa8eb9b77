"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.sources.scratch import Workspace


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    )


def components(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(node, component): every node of ``links`` (a, b), with the smallest it can reach.

    Each round joins every node to the smallest of its neighbours and itself, first for the
    larger neighbours, then for the smaller ones; paths halve, so the rounds grow with the
    logarithm of the longest path.  A node with very many links is a skewed key of a join
    between two written tables, which adaptive execution splits.
    """

    def least(edges: DataFrame, label: str) -> DataFrame:
        return work.stage(
            edges.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("least")), label
        )

    edges = work.stage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b").distinct(),
        f"{name}-0",
    )
    mark, k = _mark(edges), 0
    while mark[0]:
        k += 1
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = least(both.union(both.select("a", F.col("a").alias("b"))), f"{name}-{k}-low")
        large = (
            both.filter("b > a").join(low, F.col("a") == F.col("of"))
            .select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()
        )
        large = work.stage(large, f"{name}-{k}-large")
        low = least(large, f"{name}-{k}-low2")
        small = large.join(low, F.col("a") == F.col("of")).select(
            F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b")
        )
        next_edges = work.stage(small.filter("a <> b").distinct(), f"{name}-{k}")
        next_mark = _mark(next_edges)
        work.drop(f"{name}-{k}-low", f"{name}-{k}-large", f"{name}-{k}-low2", f"{name}-{k - 1}")
        edges, done = next_edges, next_mark == mark
        mark = next_mark
        if done:
            break
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = found.select(F.col("component").alias("node"), "component").distinct()
    return work.stage(found.union(roots), f"{name}-components")
