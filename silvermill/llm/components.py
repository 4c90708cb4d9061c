"""Connected components of an edge table, by large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond": each step links
nodes to the smallest neighbour they know, which shrinks every component to a
star in a logarithmic number of steps. A step aggregates with map-side combine
and joins on the node, so a hub may have any number of neighbours. Before the
first step, each partition of the edges joins up what it holds. Every step is
written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from silvermill.scratch import stored


def _joined_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A star for each component of a batch's edges."""
    for frame in frames:
        root: dict[int, int] = {}

        def find(node: int) -> int:
            while (above := root.setdefault(node, node)) != node:
                root[node] = root[above]
                node = above
            return node

        for a, b in zip(frame["a"].tolist(), frame["b"].tolist()):
            low, high = sorted((find(a), find(b)))
            root[high] = low
        stars = [(node, find(node)) for node in list(root)]
        yield pd.DataFrame([x for x in stars if x[0] != x[1]], columns=["a", "b"]).astype("int64")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return (
        _beside(both, least).where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
    )


def _beside(edges: DataFrame, least: DataFrame) -> DataFrame:
    """The edges with their node's `low`.

    A hash is one more join key, which gives the join exchanges of its own:
    adaptive execution splits a hub's edges only above these. Edges grow with
    the corpus, so neither side is broadcast.
    """
    spread = F.xxhash64("a").alias("spread")
    return edges.select("*", spread).join(least.select("*", spread).hint("merge"), ["a", "spread"])


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    kept = _beside(down, least).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return kept.where("a <> b").union(least.select("a", F.col("low").alias("b"))).distinct()


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node has one parent, a centre being its own."""
    parents = edges.select("a", "b").union(edges.select("b", "b"))
    several = parents.groupBy("a").agg((F.min("b") != F.max("b")).alias("several"))
    return not several.agg(F.max("several")).first()[0]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a neighbour; nodes are longs, and the
    smallest of a component is its root.

    Edges have no direction; loops, repeats and nulls do not count. No edges give
    no rows.
    """
    pairs = edges.select(
        F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b")
    ).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    current = stored(
        pairs.repartition(tasks, "b").mapInPandas(_joined_up, "a long, b long"), "edges"
    )
    while not _only_stars(current):
        current = stored(_small_star(_large_star(current)), "edges")
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(current.select("b", "b")).distinct()
