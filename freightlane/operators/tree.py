"""Row-level differences by checksum trees: only rows whose part of the tree differs are shuffled.

A row belongs to a leaf, the first bits of its key's hash, and a node of the tree holds the number of rows below it and
the sums of their row hashes. Sums are added up from the leaves to the root, so trees of batches add up to the tree of
the table, and a tree is kept beside its table and built once. Two trees are compared from the root down: below equal nodes
nothing is read. The rows of the unequal leaves alone go into the exact comparison of reconcile.row_diff().

Rows that lie in order of their leaves (by_leaf) are also skipped by the scan. A tree has at most 2^bits leaves, however many rows
there are; that bounds what is compared, broadcast and sent to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from freightlane.functions.scalars import quoted
from freightlane.operators.reconcile import common_types, row_diff, row_hash_halves

BITS = 16
#: Bits that one level of the tree adds to the one above.
STEP = 4
LEAF = "_leaf"
#: Ranges of leaves that a scan is asked for; more of them are merged over the narrowest gaps between them.
RANGES = 64
_SUMS = ("rows", "h0", "h1", "h2", "h3")


def leaf_of(key: Sequence[str], types: Mapping[str, T.DataType], bits: int = BITS) -> Column:
    """The leaf of a row: the first bits of the hash of its key. NULL parts of keys are values of their own."""
    parts = [part for k in key for part in (F.col(quoted(k)).isNull(), F.col(quoted(k)).cast(types[k]))]
    return F.shiftrightunsigned(F.xxhash64(*parts), 64 - bits)


def by_leaf(df: DataFrame, key: Sequence[str], types: Mapping[str, T.DataType] | None = None, bits: int = BITS) -> DataFrame:
    """The rows with their leaf as column `_leaf`, in its order, so that files of them are skipped by it when they are read."""
    known = types or {f.name: f.dataType for f in df.schema}
    return df.withColumn(LEAF, leaf_of(key, known, bits)).repartitionByRange(LEAF).sortWithinPartitions(LEAF)


def _placed(df: DataFrame, key: Sequence[str], types: Mapping[str, T.DataType], bits: int) -> Column:
    return F.col(LEAF) if LEAF in df.columns else leaf_of(key, types, bits)


def build_tree(
    df: DataFrame,
    key: Sequence[str],
    types: Mapping[str, T.DataType] | None = None,
    bits: int = BITS,
    step: int = STEP,
) -> DataFrame:
    """level (0 is the root), prefix, rows and four sums of row hashes, for every node that has rows.

    One pass over the rows, map-side combined to one row per leaf and task. `types` are those in which the two sides are
    compared (reconcile.common_types), by default the frame's own.
    """
    columns = [c for c in df.columns if c != LEAF]
    known = types or {f.name: f.dataType for f in df.schema}
    aligned = df.select(
        _placed(df, key, known, bits).alias("prefix"), *[F.col(quoted(c)).cast(known[c]).alias(c) for c in columns]
    )
    halves = row_hash_halves(columns)
    leaves = aligned.select("prefix", F.lit(1).cast("long").alias("rows"), *[h.alias(f"h{i}") for i, h in enumerate(halves)])
    return _levels(_summed(leaves), bits, step)


def _summed(nodes: DataFrame, *more: str) -> DataFrame:
    return nodes.groupBy(*more, "prefix").agg(*[F.sum(c).alias(c) for c in _SUMS])


def _levels(leaves: DataFrame, bits: int, step: int) -> DataFrame:
    """All levels from the leaves; a leaf adds one row to each level, and levels are shuffled once together."""
    depths = list(range(0, bits, step)) + [bits]
    nodes = F.explode(F.array(*[
        F.struct(F.lit(n).alias("level"), F.shiftrightunsigned("prefix", bits - d).alias("p")) for n, d in enumerate(depths)
    ]))
    every = leaves.withColumn("node", nodes).select("node.level", F.col("node.p").alias("prefix"), *_SUMS)
    return _summed(every, "level")


def add_trees(trees: DataFrame) -> DataFrame:
    """One tree from several, given as one frame: that of all their rows together."""
    return _summed(trees, "level")


def save_tree(tree: DataFrame, place: str) -> None:
    tree.write.mode("overwrite").partitionBy("level").parquet(place)


def unequal_leaves(source: DataFrame, target: DataFrame, bits: int = BITS, step: int = STEP) -> list[int]:
    """The leaves in which two trees differ, found level by level; nothing below equal nodes is read.

    Every level compares the children of the unequal nodes above only. At most 2^bits numbers come to the driver.
    """
    depths = list(range(0, bits, step)) + [bits]
    open_: list[int] | None = None
    for level, depth in enumerate(depths):
        children = None
        if open_ is not None:
            width = depth - depths[level - 1]
            children = _within([(n << width, ((n + 1) << width) - 1) for n in open_], "prefix")
        # A side's sums count plus and minus, so a node that only one side has differs too.
        sides = [
            tree.filter(F.col("level") == level).select("prefix", *[(F.col(c) * sign).alias(c) for c in _SUMS])
            for tree, sign in ((source, 1), (target, -1))
        ]
        both = sides[0].unionByName(sides[1])
        both = both if children is None else both.filter(children)
        differ = reduce(or_, [F.col(c) != 0 for c in _SUMS])
        open_ = sorted(r["prefix"] for r in _summed(both).filter(differ).select("prefix").collect())
        if not open_:
            return []
    return open_


def ranges_of(parts: Sequence[tuple[int, int]], most: int = RANGES) -> list[tuple[int, int]]:
    """At most `most` ranges that hold all the given ones (in order, apart); the narrowest gaps between them are closed."""
    gaps = sorted(range(1, len(parts)), key=lambda i: parts[i - 1][1] - parts[i][0])
    cuts = sorted(i for i in gaps[: most - 1] if parts[i][0] - parts[i - 1][1] > 1)
    starts, stops = [0, *cuts], [*cuts, len(parts)]
    return [(parts[a][0], parts[b - 1][1]) for a, b in zip(starts, stops, strict=True)] if parts else []


def _within(parts: Sequence[tuple[int, int]], column: str) -> Column:
    """A filter that a scan can use to skip row groups."""
    ranges = [F.col(column).between(a, b) for a, b in ranges_of(parts)]
    return reduce(or_, ranges) if ranges else F.lit(False)


def rows_of(df: DataFrame, leaves: Sequence[int], key: Sequence[str], types: Mapping[str, T.DataType], bits: int = BITS) -> DataFrame:
    """The rows in some leaves. Where the rows lie by leaf, ranges of leaves reach the scan."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(n,) for n in leaves], "leaf long")
    if LEAF in df.columns:
        df = df.filter(_within([(n, n) for n in leaves], LEAF))
    return df.join(F.broadcast(wanted), _placed(df, key, types, bits) == F.col("leaf"), "left_semi").drop(LEAF)


def tree_diff(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    source_tree: DataFrame | None = None,
    target_tree: DataFrame | None = None,
    bits: int = BITS,
    step: int = STEP,
) -> DataFrame:
    """The same rows as reconcile.row_diff(source, target, key).

    Trees that were kept are taken as they are, so an unchanged side is not read to compare it; missing ones are built.
    Both must have been built with the same key, types, bits and step. Work grows with the rows in unequal leaves.
    """
    plain = [df.drop(LEAF) for df in (source, target)]
    types = common_types(*plain)
    trees = [
        tree if tree is not None else build_tree(df, key, types, bits, step)
        for df, tree in ((source, source_tree), (target, target_tree))
    ]
    leaves = unequal_leaves(*trees, bits=bits, step=step)
    return row_diff(*[rows_of(df, leaves, key, types, bits).select(*plain[0].columns) for df in (source, target)], key)
