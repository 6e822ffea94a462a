"""Connected components by union-find inside tasks and star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlane.llm.common import small, written

EDGES = "node long, root long"


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the edges of one task, some thousand at a time: every node with the smallest node it reaches there."""
    for batch in batches:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while (up := parent.get(root, root)) != root:
                root = up
            while x != root:
                parent[x], x = root, parent.get(x, x)
            return root

        for a, b in zip(batch["node"].tolist(), batch["root"].tolist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        yield pd.DataFrame({"node": nodes, "root": [find(x) for x in nodes]}, dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node that is not the smallest of its component; edges: node, root in any order.

    Each task first unites its own edges, which makes stars: nodes with a smaller root. Then, in rounds, nodes whose root has
    a smaller root itself are handed to that one, and roots that share a node to the smallest of them. The number of
    rounds grows with the logarithm of the longest path. It ends when every node has one root and no root has one. Roots
    are looked up in a written table, so a root with very many nodes is split like any skewed join key.
    """
    edges = edges.select(F.col("node").cast("long"), F.col("root").cast("long")).filter("node <> root")
    stars = written(edges.mapInPandas(_forest, EDGES).filter("node <> root").distinct(), "edges")
    while True:
        parents = written(stars.groupBy("node").agg(F.min("root").alias("least"), F.count(F.lit(1)).alias("roots")), "parents")
        roots = stars.select(F.col("root").alias("centre")).distinct()
        moved = written(parents.join(roots, F.expr("node = centre")).select("centre", "least"), "centres")
        if moved.isEmpty() and parents.filter("roots > 1").isEmpty():
            return stars
        stars = written(_joined_roots(_lifted(stars, moved)), "edges")


def _lifted(stars: DataFrame, moved: DataFrame) -> DataFrame:
    """Nodes with the smallest root of their root, where it has one."""
    joined = stars.join(small(moved), F.expr("root = centre"), "left")
    return joined.select("node", F.coalesce("least", "root").alias("root")).distinct()


def _joined_roots(stars: DataFrame) -> DataFrame:
    """Every node with its smallest root only, and its other roots with that one as theirs."""
    least = stars.groupBy("node").agg(F.min("root").alias("least"))
    others = stars.join(least.withColumnRenamed("node", "of"), F.expr("node = of")).filter("root <> least")
    return (
        others.select(F.col("root").alias("node"), F.col("least").alias("root"))
        .unionByName(least.select("node", F.col("least").alias("root")))
        .distinct()
    )
