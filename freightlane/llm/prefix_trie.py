"""Trie of conversation prefixes: every distinct sequence of first turns is a node, with sums over its subtree.

A turn is known by a 122-bit hash of its role and text, and a prefix by its length and the sum of its turns' hashes times
powers of a base, modulo a prime. Such sums can be added up part by part, so a conversation may lie over many tasks: turns are
sorted into ranges of conversation and turn, every range sums up its own, and what earlier ranges hold of a conversation is added
from a table of at most two rows per range. Prefixes with equal keys are one node, named by its smallest member.

Sums over subtrees come by centroid decomposition (centroids.py); a node weighs as much as it has members, so weights of
subtrees are known without one. The ids of the conversations that end at a node are joined in sorted blocks, and only the blocks
of a node are hashed in one task, one after the other, as a digest of them all must be.

Defined cases: NULL turns come first, equal ones in order of role and text; a NULL role or text is empty; repeated rows
are turns of their own; rows without a conversation are left out; ids are whole numbers; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freightlane.llm.centroids import BLOCK, rollup
from freightlane.llm.common import count_words, written

FAMILY = 20
SHARED = 4
PRIME = (1 << 61) - 1
_BASES = (0x1F3D5B79A2C4E687, 0x0C0FFEE123456789)
#: Ids that a task joins before it passes them on.
ENDS = 10_000


def turn_hashes(role: str, text: str) -> tuple[int, int]:
    first, second = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
    digest = xxhash.xxh3_128_intdigest(len(first).to_bytes(8, "little") + first + second)
    return (digest >> 64) % PRIME, digest % (1 << 64) % PRIME


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, part, nth (in the part), one, other (halves of the hash) and words of every turn."""
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = conversations.select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), plain(role).alias("role"), plain(text).alias("text")
    ).filter("conv IS NOT NULL")
    # Only the beginning of a text is a bound of a range; within a range the whole text is the order.
    ranges = rows.repartitionByRange("conv", "turn", "role", F.left("text", F.lit(16))).sortWithinPartitions("conv", "turn", "role", "text")
    ranges = ranges.select("conv", F.spark_partition_id().alias("part"), "role", "text", count_words(F.col("text")).alias("words"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            nth, hashes = [], []
            for conv, role, text in zip(batch["conv"].to_pylist(), batch["role"], batch["text"], strict=True):
                n = n + 1 if conv == last else 0
                last = conv
                nth.append(n)
                hashes.append(turn_hashes(role.as_py(), text.as_py()))
            halves = [pa.array([h[i] for h in hashes], pa.int64()) for i in (0, 1)]
            made = [batch["conv"], batch["part"], pa.array(nth, pa.int64()), *halves, batch["words"]]
            yield pa.RecordBatch.from_arrays(made, ["conv", "part", "nth", "one", "other", "words"])

    return written(ranges.mapInArrow(read, "conv long, part int, nth long, one long, other long, words long"), "turns")


def _carried(parts: DataFrame, *values: str) -> DataFrame:
    """c, p and, as first_<value>, the sums of the values in earlier parts of a conversation; parts: a row per conv and part.

    Only conversations in several parts have rows, and every part but the last begins just one more of them.
    """
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    several = parts.groupBy("conv").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("conv")
    wide = [F.coalesce(F.sum(F.col(v).cast("decimal(38,0)")).over(before), F.lit(0).cast("decimal(38,0)")).alias(f"first_{v}") for v in values]
    return parts.join(several, "conv").select(F.col("conv").alias("c"), F.col("part").alias("p"), *wide)


def rebuilt(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The turns (conv, depth from 1, one, other, words, total) of the rebuilt conversations, and conv, total of each of them.

    A conversation takes the first h turns of its family's first one, c - c % FAMILY, and its own after its first h.
    """
    turns = _turns(conversations, conv, turn, role, text)
    parts = written(turns.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n")), "parts")
    placed = turns.join(F.broadcast(_carried(parts, "n")), F.expr("conv = c AND part = p"), "left")
    placed = placed.select("conv", (F.col("nth") + F.coalesce(F.col("first_n").cast("long"), F.lit(0))).alias("place"), "one", "other", "words")

    sizes = parts.groupBy("conv").agg(F.sum("n").alias("n"))
    bases = sizes.select(F.col("conv").alias("first"), F.col("n").alias("first_n"))
    plan = sizes.withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED)).withColumn("base", F.expr(f"conv - conv % {FAMILY}"))
    plan = plan.join(bases, F.expr("base = first"), "left").withColumn("taken", F.least("h", F.coalesce("first_n", F.lit(0))))
    total = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    plan = written(plan.select("conv", "h", "base", "taken", total.alias("total")), "plan")

    own = placed.join(plan.select(F.col("conv").alias("c"), "h", "taken", "total"), F.expr("conv = c AND place >= h"))
    own = own.select("conv", (F.col("taken") + F.col("place") - F.col("h") + 1).alias("depth"), "one", "other", "words", "total")
    heads = placed.filter(F.col("place") < SHARED).select(F.col("conv").alias("head"), "place", "one", "other", "words")
    shared = plan.join(heads, F.expr("base = head AND place < h"))
    shared = shared.select("conv", (F.col("place") + 1).alias("depth"), "one", "other", "words", "total")
    return own.unionByName(shared), plan.select("conv", "total")


def keyed(turns: DataFrame) -> DataFrame:
    """conv, depth, total, words, the key (one, other) of the prefix that ends with each turn, and (above, above_other) of that before it."""
    ranges = turns.repartitionByRange("conv", "depth").sortWithinPartitions("conv", "depth").withColumn("part", F.spark_partition_id())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sums, powers = None, (0, 0), (1, 1)
        for batch in batches:
            out: list[list[int]] = [[], [], [], []]
            for conv, depth, *hashes in zip(*[batch[c].to_pylist() for c in ("conv", "depth", "one", "other")], strict=True):
                if conv != last:
                    last, sums, powers = conv, (0, 0), tuple(pow(b, depth, PRIME) for b in _BASES)
                ended = tuple((s + p * h) % PRIME for s, p, h in zip(sums, powers, hashes, strict=True))
                for column, value in zip(out, (*ended, *sums), strict=True):
                    column.append(value)
                sums, powers = ended, tuple(p * b % PRIME for p, b in zip(powers, _BASES, strict=True))
            made = [batch[c] for c in ("conv", "part", "depth", "total", "words")] + [pa.array(x, pa.int64()) for x in out]
            yield pa.RecordBatch.from_arrays(made, ["conv", "part", "depth", "total", "words", "one", "other", "above", "above_other"])

    schema = "conv long, part int, depth long, total long, words long, one long, other long, above long, above_other long"
    sums = written(ranges.select("conv", "part", "depth", "total", "words", "one", "other").mapInArrow(read, schema), "sums")
    ends = F.max_by(F.struct("one", "other"), "depth").alias("x")
    parts = written(sums.groupBy("conv", "part").agg(ends).select("conv", "part", "x.one", "x.other"), "ends")
    joined = sums.join(F.broadcast(_carried(parts, "one", "other")), F.expr("conv = c AND part = p"), "left")
    add = lambda x, more: F.when(F.col(more).isNull(), F.col(x)).otherwise(((F.col(x) + F.col(more)) % PRIME).cast("long")).alias(x)
    return joined.select(
        "conv", "depth", "total", "words", add("one", "first_one"), add("other", "first_other"),
        add("above", "first_one"), add("above_other", "first_other"),
    )


def _nodes(keys: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes but for the root: depth, key, name (smallest member), parent's name, members, children, words, weight."""
    nodes = keys.groupBy("depth", "one", "other").agg(
        F.min("conv").alias("name"),
        F.count(F.lit(1)).alias("own"),
        F.max("words").alias("words"),
        F.min("above").alias("above"),
        F.min("above_other").alias("above_other"),
        F.sum(F.col("total") - F.col("depth") + 1).alias("weight"),
    )
    nodes = written(nodes, "nodes")
    root = convs.agg(F.min("conv")).first()[0]
    kids = nodes.groupBy((F.col("depth") - 1).alias("d"), F.col("above").alias("a"), F.col("above_other").alias("b")).agg(F.count(F.lit(1)).alias("children"))
    nodes = nodes.join(kids, F.expr("depth = d AND one = a AND other = b"), "left").drop("d", "a", "b")
    over = nodes.select((F.col("depth") + 1).alias("d"), F.col("one").alias("a"), F.col("other").alias("b"), F.col("name").alias("over"))
    nodes = nodes.join(over, F.expr("depth = d AND above = a AND above_other = b"), "left").drop("d", "a", "b")
    parent = F.when(F.col("depth") == 1, F.lit(root)).otherwise(F.col("over"))
    return written(nodes.select("depth", "one", "other", "name", parent.alias("parent"), "own", F.coalesce("children", F.lit(0)).alias("children"), "words", "weight"), "trie")


def _digests(ends: DataFrame) -> DataFrame:
    """name, depth, ends_sha256 of the nodes at which conversations end; ends: name, depth, conv."""
    schema = "depth long, name long, first long, ids string"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids = None, None, []
        out: list[tuple] = []
        for batch in batches:
            for depth, name, conv in zip(*[batch[c].to_pylist() for c in ("depth", "name", "conv")], strict=True):
                if (depth, name) != node or len(ids) >= ENDS:
                    out += [(*node, first, ",".join(ids))] if ids else []
                    node, first, ids = (depth, name), conv, []
                ids.append(str(conv))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("depth", "name", "first", "ids"), x, strict=True)) for x in out])
                out = []
        if ids:
            yield pa.RecordBatch.from_pylist([{"depth": node[0], "name": node[1], "first": first, "ids": ",".join(ids)}])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for depth, name, ids in zip(batch["depth"].to_pylist(), batch["name"].to_pylist(), batch["ids"], strict=True):
                if (depth, name) != node:
                    out += [(*node, state.hexdigest())] if node else []
                    node, state = (depth, name), hashlib.sha256(ids.as_py().encode())
                else:
                    state.update(b"," + ids.as_py().encode())
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("d", "at", "ends_sha256"), x, strict=True)) for x in out])
        if node:
            yield pa.RecordBatch.from_pylist([{"d": node[0], "at": node[1], "ends_sha256": state.hexdigest()}])

    blocks = ends.repartitionByRange("depth", "name", "conv").sortWithinPartitions("depth", "name", "conv").mapInArrow(join, schema)
    blocks = blocks.repartition("depth", "name").sortWithinPartitions("depth", "name", "first")
    return blocks.mapInArrow(digest, "d long, at long, ends_sha256 string")


def trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(conversations, conv, turn, role, text)
    keys = written(keyed(turns), "keys")
    nodes = _nodes(keys, convs)
    key = F.expr("depth = d AND one = a AND other = b")
    names = nodes.select(F.col("depth").alias("d"), F.col("one").alias("a"), F.col("other").alias("b"), "name", "parent")
    paths = written(keys.select("conv", "depth", "total", "one", "other").join(names, key).select("conv", "depth", "total", "name", "parent"), "paths")

    every = convs.agg(F.min("conv").alias("name"), F.count(F.lit(1)).alias("own"), F.sum(F.col("total") + 1).alias("weight")).first()
    values = {"depth": 0, "name": every["name"], "parent": None, "own": every["own"], "children": nodes.filter("depth = 1").count(), "words": 0, "weight": every["weight"]}
    root = [F.lit(v).cast("long").alias(k) for k, v in values.items()]
    one_row = conversations.sparkSession.range(1 if every["own"] else 0)
    tree = nodes.drop("one", "other").unionByName(one_row.select(*root))
    leaves = F.when(F.col("children") == 0, 1).otherwise(0).cast("long")
    tree = written(tree.withColumns({"leaves": leaves, "saved": (F.col("own") - 1) * F.col("words")}), "tree")
    ways = paths.select("conv", "depth", "name", "parent")
    ways = ways.unionByName(ways.select("conv").distinct().select("conv", *root[:3]))
    sums = rollup(tree, ways, block)

    at_root = convs.filter("total = 0").select(*root[:2], "conv")
    digests = _digests(paths.filter("depth = total").select("depth", "name", "conv").unionByName(at_root))
    sums = sums.select(F.col("name").alias("of"), F.col("depth").alias("of_depth"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    out = tree.join(sums, F.expr("name = of AND depth = of_depth")).join(digests, F.expr("name = at AND depth = d"), "left")
    none: Column = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        F.col("name").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("own").alias("n_convs"),
        F.col("children").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )

