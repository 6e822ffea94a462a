from pyspark.sql import functions as F

from freightlane.operators.keys import foreign_key_checks, key_check, latest_per_key, not_loaded, one_per_key, orphan_keys, orphan_rows
from freightlane.plans.contract import Contract, ForeignKey
from tests.conftest import rows


def test_one_row_per_key_is_the_smallest(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (1, None, 3), (2, "z", 0), (None, "n", 1), (None, "m", 1)], "k int, s string, n int")
    assert rows(one_per_key(df, ["k"])) == sorted([(1, None, 3), (2, "z", 0), (None, "m", 1)], key=repr)


def test_key_of_all_columns(spark):
    df = spark.createDataFrame([(1, 2), (1, 2)], "a int, b int")
    assert rows(one_per_key(df, ["a", "b"])) == [(1, 2)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 3, "y"), ("a", 3, "x"), ("b", None, "never"), ("b", 0, "first")], "k string, t int, v string")
    assert rows(latest_per_key(df, ["k"], "t")) == [("a", 3, "x"), ("b", 0, "first")]


def test_columns_without_an_order_are_kept(spark):
    df = spark.sql("select 1 as k, map('a', 1) as m union all select 1, map('a', 1)")
    assert [r.m for r in one_per_key(df, ["k"]).collect()] == [{"a": 1}]


def test_not_loaded(spark):
    incoming = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "x int, y int, v string")
    loaded = spark.createDataFrame([(1, 1, "old"), (1, 1, "old")], "x int, y int, v string")
    assert rows(not_loaded(incoming, loaded, ["x", "y"])) == [(1, 2, "b"), (2, 1, "c")]


def test_key_check(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (1, 2), (None, 2), (None, 2)], "x int, y int")
    assert rows(key_check(df, ["x", "y"], "t")) == [("t", "x,y", 6, 2, 2, 2, 3, False)]
    assert rows(key_check(df.limit(0), ["x"], "t")) == [("t", "x", 0, 0, 0, 0, 0, True)]
    assert key_check(spark.range(5), ["id"], "t").first().is_unique


def test_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (7, "b"), (7, "c"), (None, "d")], "ref int, v string")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert rows(orphan_keys(child, parent, {"ref": "id"})) == [(7, 2)]
    assert rows(orphan_rows(child, parent, {"ref": "id"})) == [(7, "b"), (7, "c")]


def test_two_column_foreign_key(spark):
    child = spark.createDataFrame([(1, 1), (1, 2), (1, None)], "a int, b int")
    parent = spark.createDataFrame([(1, 1)], "x int, y int")
    assert rows(orphan_keys(child, parent, {"a": "x", "b": "y"})) == [(1, 2, 1)]


def test_a_hot_key_of_a_third_of_all_rows(spark):
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    assert one_per_key(df, ["k"]).count() == df.select("k").distinct().count()
    check = key_check(df, ["k"], "t").first()
    assert (check.row_count, check.most_copies) == (n, n // 3)
    assert rows(orphan_keys(df, df.filter("k <> 0"), {"k": "k"})) == [(0, n // 3)]


def test_foreign_keys_of_a_contract(spark):
    child = spark.createDataFrame([(1, "a"), (7, "b"), (7, None), (None, "a")], "ref int, kind string")
    parents = {"p": spark.createDataFrame([(1,)], "id int"), "k": spark.createDataFrame([("a",), ("b",)], "name string")}
    contract = Contract("s.c", "w.c", (), foreign_keys=(ForeignKey("ref", "p", "id"), ForeignKey("kind", "k", "name")))
    assert rows(foreign_key_checks(contract, child, parents)) == [("c", "kind", "k.name", 0, 0, True), ("c", "ref", "p.id", 1, 2, False)]
    assert foreign_key_checks(Contract("s.c", "w.c", ()), child, {}).count() == 0
