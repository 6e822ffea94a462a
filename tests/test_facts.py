"""Facts of batches that merge into a profile, and pages by a quantile sketch."""

import random

import pytest
from pyspark.sql import functions as F

from freightlane.operators import facts, profile
from freightlane.sources import tables as src
from tests.conftest import rows

SCHEMA = "a long, b string, c double, d date, e boolean, f binary, g struct<x:int>, h decimal(8,2)"


def table(spark, n, seed):
    draw = random.Random(seed)
    some = lambda v: None if draw.random() < 0.1 else v
    return spark.range(n).select(
        (F.col("id") * 7919 % 5000 + seed).alias("a"),
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("n"), (F.col("id") % 700).cast("string"))).alias("b"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 1000) / 8).alias("c"),
        F.date_add(F.lit("2020-01-01"), (F.col("id") % 400).cast("int")).alias("d"),
        (F.col("id") % 2 == 0).alias("e"),
        F.lit(some(b"x")).cast("binary").alias("f"),
        F.struct((F.col("id") % 3).cast("int").alias("x")).alias("g"),
        F.lit(None).cast("decimal(8,2)").alias("h"),
    )


EXACT = ["column_name", "null_rate", "min_value", "max_value", "max_length"]


def test_merged_batches_equal_a_full_profile(spark, tmp_path):
    parts = [table(spark, n, seed) for n, seed in ((4000, 1), (1, 2), (0, 3), (2500, 1))]
    for i, part in enumerate(parts):
        facts.store_facts(part, str(tmp_path), "r", i)
    facts.store_facts(parts[0], str(tmp_path), "r", 0)
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    got = facts.stored_profile(spark, str(tmp_path), "t")
    full = profile.profile(whole, "t")
    assert rows(got.select(*EXACT)) == rows(full.select(*EXACT))
    counts = {r["column_name"]: r["distinct_count"] for r in full.collect()}
    for r in got.collect():
        assert abs(r["distinct_estimate"] - counts[r["column_name"]]) <= 0.05 * counts[r["column_name"]] + 1 and r["rows"] == 6501
    quartiles = {r["column_name"]: (r["q1"], r["median"], r["q3"]) for r in got.collect()}
    for c in ("a", "c"):
        values = sorted(r[0] for r in whole.select(c).collect() if r[0] is not None)
        for p, q in zip((0.25, 0.5, 0.75), quartiles[c], strict=True):
            assert abs(sum(v <= q for v in values) / len(values) - p) < 0.04
    assert quartiles["b"] == quartiles["h"] == (None, None, None)


def test_a_merge_of_merges_is_the_same(spark):
    parts = [facts.batch_facts(table(spark, n, 1)) for n in (300, 500, 200)]
    first = facts.merged(parts[0].unionByName(parts[1])).select(*parts[2].columns)
    twice, once = facts.merged(first.unionByName(parts[2])), facts.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    plain = [c for c in once.columns if not c.startswith(("distinct", "ranks"))]
    assert rows(twice.select(*plain)) == rows(once.select(*plain))


@pytest.mark.parametrize("pages", [1, 2, 8, 13])
def test_pages_hold_their_share_in_order(spark, pages):
    n = 6000
    keys = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.col("id") * 10**9).otherwise(F.col("id")).alias("clustered"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("text"),
        F.date_add(F.lit("2000-01-01"), F.col("id").cast("int")).alias("day"),
        F.when(F.col("id") % 4 > 0, -F.col("id") / 3).alias("fraction"),
    )
    for key, present in (("clustered", n), ("day", n), ("fraction", n * 3 // 4)):
        paged = src.with_sketched_page(keys, key, pages).filter(F.col(key).isNotNull()).groupBy("page")
        found = sorted(map(tuple, paged.agg(F.count(F.lit(1)), F.min(key), F.max(key)).collect()))
        assert len(found) == pages and all(size * pages <= 1.5 * present for _, size, *_ in found)
        assert all(a[3] < b[2] for a, b in zip(found, found[1:], strict=False))
    text = src.with_sketched_page(keys, "text", 4).groupBy("page").agg(F.count(F.lit(1)), F.min("text"), F.max("text")).collect()
    assert max(r[1] for r in text) * 4 <= 1.5 * n and len({r[0] for r in text}) == 4


def test_odd_keys(spark):
    empty = spark.createDataFrame([], "k long, t string")
    assert src.with_sketched_page(empty, "k", 4).count() == 0 and src.with_sketched_page(empty, "t", 4).count() == 0
    df = spark.createDataFrame([(None, None), (None, "")] + [(5, "same")] * 20, "k long, t string")
    assert {r["page"] for r in src.with_sketched_page(df, "k", 4).collect()} == {0}
    assert src.with_sketched_page(df, "t", 4).count() == 22
