"""Sums over all subtrees of a forest by centroid decomposition.

A component of the forest is split at its centroid, the deepest node that has more than half of the component's weight at or
below it. The total of what lies at and below the centroid is added to all nodes on the way from it up to the component's top;
the centroid is done, and its children's parts and the rest above it are components of at most half the weight. So every node
takes part in as many rounds as the logarithm of the weight, however long the paths are.

Components of more than `block` weight are split by joins, all of them in one round; smaller ones are gathered, each in one task,
and split there in the same way. Weights are at least one per node, so a gathered component has at most `block` nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlane.llm.common import dropped, small, written

#: Weight of a component that one task splits.
BLOCK = 20_000
VALUES = ("leaves", "saved")
_STATE = ("name", "depth", "parent", "top", "top_depth", "weight", *VALUES, *[f"more_{v}" for v in VALUES])


def subtree_sums(parents: list[int], own: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """The sums over every node's subtree. Nodes come parents first; the first is the only one without a parent (-1)."""
    n = len(parents)
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        children[parents[i]].append(i)
    sums = [[0] * len(values[0]) for _ in range(n)]
    gone = [False] * n
    weight = [0] * n
    tops = [0] if n else []
    while tops:
        top = tops.pop()
        part = [top]
        for i in part:
            part += [c for c in children[i] if not gone[c]]
        for i in part:
            weight[i] = own[i]
        for i in reversed(part[1:]):
            weight[parents[i]] += weight[i]
        centre = top
        while down := [c for c in children[centre] if not gone[c] and 2 * weight[c] > weight[top]]:
            centre = down[0]
        below = [centre]
        for i in below:
            below += [c for c in children[i] if not gone[c]]
        total = [sum(x) for x in zip(*[values[i] for i in below], strict=True)]
        at = centre
        while True:
            sums[at] = [a + b for a, b in zip(sums[at], total, strict=True)]
            if at == top:
                break
            at = parents[at]
        gone[centre] = True
        tops += [c for c in children[centre] if not gone[c]]
        if centre != top:
            tops.append(top)
    return sums


def _gathered(nodes: DataFrame) -> DataFrame:
    """Sums of whole components, each in one task."""
    columns = ("top_depth", "top", "depth", "name", "parent", "own", *VALUES, *[f"more_{v}" for v in VALUES])

    def done(rows: list[tuple]) -> list[tuple]:
        at = {(depth, name): i for i, (_, _, depth, name, *_) in enumerate(rows)}
        parents = [-1, *[at[r[2] - 1, r[4]] for r in rows[1:]]]
        sums = subtree_sums(parents, [r[5] for r in rows], [r[6 : 6 + len(VALUES)] for r in rows])
        return [(r[3], r[2], *[a + b for a, b in zip(s, r[6 + len(VALUES) :], strict=True)]) for r, s in zip(rows, sums, strict=True)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch[c].to_pylist() for c in columns], strict=True):
                if rows and rows[-1][:2] != row[:2]:
                    out += done(rows)
                    rows = []
                rows.append(row)
            if out:
                yield _batch(out)
                out = []
        if rows:
            yield _batch(done(rows))

    placed = nodes.select(*columns).repartition("top_depth", "top").sortWithinPartitions("top_depth", "top", "depth", "name")
    return placed.mapInArrow(read, ", ".join(f"{c} long" for c in ("name", "depth", *VALUES)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["name", "depth", *VALUES])


def rollup(nodes: DataFrame, paths: DataFrame, block: int = BLOCK) -> DataFrame:
    """name, depth and the sums of VALUES over every node's subtree.

    nodes: name and depth (together the key), parent (its name, NULL at the top), own (weight of the node), weight (of its
    subtree) and VALUES. paths: the way down to every node that bears a name: conv (the name), depth, name (of the node there)
    and parent (its name).
    """
    zero = {f"more_{v}": F.lit(0).cast("long") for v in VALUES}
    whole = nodes.filter("parent IS NULL").agg(F.max("weight")).first()[0] or 0
    start = nodes.withColumns(zero)
    if whole <= block:
        top = nodes.filter("parent IS NULL").select(F.col("name").alias("top")).first()
        return _gathered(start.withColumns({"top": F.lit(top[0] if top else None).cast("long"), "top_depth": F.lit(0).cast("long")}))
    top = nodes.filter("parent IS NULL").first()["name"]
    start = start.withColumns({"top": F.lit(top).cast("long"), "top_depth": F.lit(0).cast("long")})
    state = written(start.select("own", *_STATE), "components")
    found = []
    while True:
        done, state, rest = _split(state, paths, block)
        found += [done, written(_gathered(rest), "gathered")]
        if state is None:
            out = found[0]
            for more in found[1:]:
                out = out.unionByName(more)
            return out


def _split(state: DataFrame, paths: DataFrame, block: int) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """One round over all components: the sums of the centroids, then the nodes of components that are still large, and of those that are small."""
    of = F.expr("top <=> t AND top_depth = td")
    totals = state.groupBy(F.col("top").alias("t"), F.col("top_depth").alias("td")).agg(F.max("weight").alias("total"))
    totals = written(totals, "totals")
    heavy = state.join(small(totals), of).filter(2 * F.col("weight") > F.col("total"))
    deepest = F.max(F.struct("depth", "name", "weight")).alias("x")
    centres = heavy.groupBy("t", "td").agg(deepest).select(
        "t", "td", F.col("x.depth").alias("x_depth"), F.col("x.name").alias("x_name"), F.col("x.weight").alias("x_weight")
    )
    centres = written(centres, "centroids")

    placed = state.join(small(centres), of).drop("t", "td")
    # Whether a deeper node lies below the centroid, and below which of its children, is on the way down to it.
    steps = paths.select(F.col("conv").alias("c"), (F.col("depth") - 1).alias("d"), F.col("name").alias("child"), F.col("parent").alias("over"))
    placed = placed.join(steps, F.expr("depth > x_depth AND name = c AND x_depth = d"), "left").drop("c", "d")
    placed = placed.withColumn("below", F.coalesce(F.col("over") == F.col("x_name"), F.lit(False)))
    placed = placed.withColumn("centre", F.expr("name = x_name AND depth = x_depth"))
    # What lies above the centroid, up to the component's top, is on the way down to it too.
    way = paths.select(F.col("conv").alias("c"), F.col("depth").alias("d"), F.col("name").alias("passed"))
    above = centres.join(way, F.expr("x_name = c AND d >= td AND d < x_depth")).select(F.col("passed").alias("p"), F.col("d").alias("pd"), F.lit(True).alias("above"))
    placed = written(placed.join(above, F.expr("name = p AND depth = pd"), "left").drop("p", "pd", "over"), "split")

    inside = placed.filter("below OR centre").groupBy(F.col("top").alias("t"), F.col("top_depth").alias("td"))
    sums = written(inside.agg(*[F.sum(v).alias(f"sum_{v}") for v in VALUES]), "sums")
    joined = placed.join(small(sums), of)
    add = {f"more_{v}": F.col(f"more_{v}") + F.when(F.expr("above OR centre"), F.col(f"sum_{v}")).otherwise(0) for v in VALUES}
    joined = joined.withColumns(add)
    done = written(joined.filter("centre").select("name", "depth", *[F.col(f"more_{v}").alias(v) for v in VALUES]), "done")
    left = joined.filter("NOT centre").withColumns({
        "weight": F.col("weight") - F.when(F.col("above"), F.col("x_weight")).otherwise(0),
        "top": F.when(F.col("below"), F.col("child")).otherwise(F.col("top")),
        "top_depth": F.when(F.col("below"), F.col("x_depth") + 1).otherwise(F.col("top_depth")),
    })
    left = left.select("own", *_STATE)
    sizes = left.groupBy(F.col("top").alias("t"), F.col("top_depth").alias("td")).agg(F.max("weight").alias("size"))
    sized = written(left.join(small(written(sizes, "sizes")), of).drop("t", "td"), "components")
    dropped(state, placed, totals, centres, sums)
    large = sized.filter(F.col("size") > block).drop("size")
    return done, None if large.isEmpty() else large, sized.filter(F.col("size") <= block).drop("size")
