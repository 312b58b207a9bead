"""Connected components of a table of edges, by alternating large and small stars.

Every round links nodes with smaller ones of their neighbourhood, as counts and minima that are combined
before each shuffle, so a hub does not gather its neighbours in one task. Rounds are written to the
shared folder and end when the edges stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of ``edges`` (a, b)."""
    edges = staged(_oriented(edges), "edges")
    state = _state(edges)
    while state[0]:
        edges = staged(_small_star(_large_star(edges)), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return (
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Number and fingerprint of the edges."""
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("mark")
    return tuple(edges.agg(F.count("*").alias("n"), mark).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours with the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    # Larger neighbours of a node: the edges that end in it.
    ends = edges.select(F.col("b").alias("centre"), F.col("a").alias("larger"))
    moved = ends.join(least.withColumnRenamed("a", "centre"), "centre")
    return moved.select(F.col("larger").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours with the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a")
    return (
        moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
        .filter("a != b")
        .unionByName(least.select("a", F.col("least").alias("b")))
        .distinct()
    )
