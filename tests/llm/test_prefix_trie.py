"""Conversation prefix trie."""

import hashlib
import random
import zlib

import pytest

from freightlane.llm import prefix_trie as pt
from freightlane.llm.centroids import subtree_sums
from freightlane.llm.queries import op13_prefix_trie
from tests.llm.helpers import words

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def expected(rows):
    """One tuple per node; rows: conv_id, turn, role, text."""
    turns = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], (r[1] is not None, r[1] or 0), r[2] or "", r[3] or "")):
        turns.setdefault(c, []).append((role or "", text or ""))
    members = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        made = turns.get(c - c % 20, [])[:h] + own[h:]
        for d in range(len(made) + 1):
            members.setdefault(tuple(made[:d]), []).append((c, len(made)))
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        own = (len(members[node]) - 1) * len(words(node[-1][1])) if node else 0
        saved[node] = own + sum(saved[x] for x in below)
        name = lambda n: min(c for c, _ in members[n])
        ends = ",".join(str(c) for c in sorted(c for c, n in members[node] if n == len(node)))
        parent = name(node[:-1]) if node else None
        out.append((name(node), len(node), parent, len(members[node]), len(below), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op13_prefix_trie(spark, folder)) == expected(rows)


def talk(n, seed, longest=6, texts=3):
    draw = random.Random(seed)
    return [
        (c, t, "user" if t % 2 == 0 else "assistant", draw.choice(["hello you", "x", "", "a b c"][:texts]))
        for c in range(n)
        for t in range(draw.randrange(longest))
    ]


@pytest.mark.parametrize("block", [1, 5, 60, 10_000])
def test_blocks_of_any_size_give_the_same(spark, block):
    rows = talk(120, 3)
    assert found(pt.trie(spark.createDataFrame(rows, SCHEMA), block=block)) == expected(rows)


def test_long_conversations_over_many_ranges(spark):
    """One conversation holds most rows and shares long prefixes with others."""
    rows = [(40, t, "user", f"turn {t % 7}") for t in range(600)] + [(43, t, "user", f"turn {t % 7}") for t in range(400)]
    rows += [(47, t, "user", f"turn {t % 7}") for t in range(300)] + talk(30, 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = found(pt.trie(spark.createDataFrame(rows, SCHEMA).repartition(5), block=200))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == expected(rows)


def test_a_first_turn_shared_by_a_third_and_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(pt, "ENDS", 7)
    rows = [(c, t, "user", "same" if t == 0 and c % 3 == 0 else f"{c} {t}") for c in range(300) for t in range(5)]
    rows += [(c, t, "user", f"copy {t}") for c in range(1000, 1200) for t in range(4)]
    assert found(pt.trie(spark.createDataFrame(rows, SCHEMA), block=100)) == expected(rows)


def test_subtree_sums_of_random_trees():
    draw = random.Random(7)
    for n in (1, 2, 3, 10, 60):
        for shape in ("random", "path", "star"):
            parents = [-1] + [{"random": draw.randrange(i), "path": i - 1, "star": 0}[shape] for i in range(1, n)]
            values = [(draw.randrange(9), i) for i in range(n)]
            sums = [list(v) for v in values]
            for i in range(n - 1, 0, -1):
                sums[parents[i]] = [a + b for a, b in zip(sums[parents[i]], sums[i], strict=True)]
            assert subtree_sums(parents, [draw.randrange(1, 9) for _ in range(n)], values) == sums


def test_messy_rows(spark):
    rows = [
        (1, None, None, None), (1, None, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 2, None, "x y"), (0, 1, "user", None),
        (None, 1, "user", "lost"), (2, 1, "us", "erhi"), (3, 1, "user", "hi"), (22, 5, "user", "hi"), (22, 6, "user", "é 漢 🙂"), (45, 0, "a", "b"),
        (61, 1, "user", "w " * 50_000), (61, 2, "user", "w"), (20, 1, "user", "w " * 50_000), (20, 9, "", ""),
    ]
    extra = "name string, depth string, own string, total string, part string, `top` string"
    df = spark.createDataFrame([(*r, *["x"] * 6) for r in rows], f"{SCHEMA}, {extra}")
    assert found(pt.trie(df)) == expected(rows)
    assert pt.trie(df.limit(0)).count() == 0
    alone = [(1, 0, "user", "a")]
    assert found(pt.trie(spark.createDataFrame(alone, SCHEMA))) == expected(alone)
