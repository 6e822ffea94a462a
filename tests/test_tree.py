"""Checksum trees against the full row diff."""

import pytest

from freightlane.operators import reconcile, tree
from tests.conftest import plan_of, rows

SCHEMA = "k long, part string, v string, d decimal(10,2)"


def table(spark, n, changed=(), gone=(), more=()):
    made = [(i, None if i % 7 == 0 else "p", f"v{i}" if i not in changed else "other", None) for i in range(n) if i not in gone]
    return spark.createDataFrame([*made, *[(i, "p", "new", None) for i in more]], SCHEMA)


@pytest.mark.parametrize(
    "change",
    [{}, {"changed": {3, 900}}, {"gone": {0, 7, 500}}, {"more": [5, 5, 2000]}, {"changed": set(range(0, 1000, 3)), "gone": {1}, "more": [7]}],
)
@pytest.mark.parametrize(("bits", "step"), [(16, 4), (6, 5), (1, 1)])
def test_same_as_the_full_diff(spark, change, bits, step):
    source, target = table(spark, 1000), table(spark, 1000, **change)
    got = tree.tree_diff(source, target, ["k", "part"], bits=bits, step=step)
    assert rows(got) == rows(reconcile.row_diff(source, target, ["k", "part"]))


def test_only_rows_of_unequal_leaves_are_compared(spark, monkeypatch):
    """Equal rows are neither shuffled by key, nor are their row groups asked for."""
    seen = []
    monkeypatch.setattr(tree, "row_diff", lambda a, b, key: seen.append((a, b)) or reconcile.row_diff(a, b, key))
    source, target = table(spark, 20_000), table(spark, 20_000, changed={11})
    assert [r["k"] for r in tree.tree_diff(source, target, ["k"]).collect()] == [11]
    assert 1 <= seen[0][0].count() < 20
    tree.tree_diff(source, source, ["k"])
    assert seen[1][0].count() == seen[1][1].count() == 0


def test_kept_trees_and_rows_by_leaf(spark, tmp_path, monkeypatch):
    types = reconcile.common_types(table(spark, 1), table(spark, 1))
    kept = []
    for name, df in (("a", table(spark, 5000)), ("b", table(spark, 5000, changed={42}, gone={43}))):
        tree.by_leaf(df, ["k"], types).write.parquet(str(tmp_path / name))
        tree.save_tree(tree.build_tree(spark.read.parquet(str(tmp_path / name)), ["k"], types), str(tmp_path / f"{name}-tree"))
        kept.append((spark.read.parquet(str(tmp_path / name)), spark.read.parquet(str(tmp_path / f"{name}-tree"))))
    monkeypatch.setattr(tree, "build_tree", None)
    (a, a_tree), (b, b_tree) = kept
    got = tree.tree_diff(a, b, ["k"], a_tree, b_tree)
    assert sorted((r["k"], r["difference"]) for r in got.collect()) == [(42, "changed"), (43, "missing")]
    leaves = tree.unequal_leaves(a_tree, b_tree)
    assert 1 <= len(leaves) <= 2 and "GreaterThanOrEqual(_leaf" in plan_of(tree.rows_of(a, leaves, ["k"], types))


def test_trees_of_batches_add_up(spark):
    whole, key = table(spark, 500), ["k"]
    parts = [tree.build_tree(whole.filter(f"k % 3 = {i}"), key) for i in range(3)]
    added = tree.add_trees(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert rows(added) == rows(tree.build_tree(whole, key))


def test_types_that_differ_empty_sides_and_repeated_rows(spark):
    source = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    target = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")
    for a, b in ((source, target), (target, source), (source, target.limit(0)), (source.limit(0), target.limit(0))):
        assert rows(tree.tree_diff(a, b, ["k"])) == rows(reconcile.row_diff(a, b, ["k"]))


def test_ranges():
    ones = lambda numbers: [(n, n) for n in numbers]
    assert tree.ranges_of([]) == [] and tree.ranges_of([(4, 4)]) == [(4, 4)]
    assert tree.ranges_of(ones([1, 2, 3, 9, 10, 30]), 2) == [(1, 10), (30, 30)]
    assert tree.ranges_of(ones([1, 2, 3, 9, 10, 30]), 9) == [(1, 3), (9, 10), (30, 30)]
    assert tree.ranges_of([(0, 15), (64, 79), (80, 95)], 2) == [(0, 15), (64, 95)]
    assert tree.ranges_of(ones(range(0, 1000, 5)), 4)[-1][1] == 995 and len(tree.ranges_of(ones(range(0, 1000, 5)), 4)) == 4
