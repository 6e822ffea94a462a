"""Distinct counts by lanes, and views that follow their tables."""

import random

import pytest
from pyspark.sql import functions as F

from freightlane.operators import lanes
from freightlane.plans import maintained, views
from tests.conftest import plan_of, rows
from workload import queries as q


def facts(spark, n, seed):
    draw = random.Random(seed)
    some = lambda *values: draw.choice([None, *values])
    made = [(some("g", "h"), draw.randrange(3), some(1, 2, 3), some("", "x", "y"), some(0.0, -0.0, 2.5), some(b"a", b"b"), draw.random() < 0.5) for _ in range(n)]
    return spark.createDataFrame(made, "g string, k int, i int, s string, d double, b binary, t boolean")


def test_lanes_against_count_distinct(spark):
    df, group = facts(spark, 400, 1), ["g", "k"]
    counted = {c: F.col(c) for c in ("i", "s", "d", "b", "t")}
    got = lanes.distinct_from(lanes.lane_counts(df, group, counted), group, list(counted))
    assert rows(got) == rows(df.groupBy(*group).agg(*[F.count_distinct(c).alias(c) for c in counted]))
    assert "Expand" not in plan_of(got)


def test_counts_add_up_and_deleted_rows_go(spark):
    first, second, group = facts(spark, 100, 2), facts(spark, 100, 3), ["g", "k"]
    counted = {c: F.col(c) for c in ("i", "s")}
    plus = [lanes.lane_counts(df, group, counted) for df in (first, second)]
    minus = lanes.lane_counts(first, group, counted, F.lit(-1))
    both = lanes.added(plus[0].unionByName(plus[1]).unionByName(minus), group)
    assert rows(lanes.distinct_from(both, group, ["i", "s"])) == rows(lanes.distinct_from(plus[1], group, ["i", "s"]))


@pytest.mark.parametrize("hot", [True, False])
def test_gathered_counts(spark, hot):
    """A group with half of all rows is dealt out; without one, the distinct counts follow without another shuffle."""
    df = spark.range(4000).select(
        (F.when((F.col("id") % 2 == 0) & F.lit(hot), F.lit(None)).otherwise(F.col("id") % 1000)).alias("g"),
        (F.col("id") % 2).cast("string").alias("h"), F.col("id").alias("i"), F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("s"),
    )
    group, names = ["g", "h"], ["i", "s"]
    sides = [lanes.lane_counts(part, group, {c: F.col(c) for c in names}, F.lit(n)) for part, n in ((df, 1), (df, 1), (df.filter("id % 3 = 0"), -2))]
    counts = sides[0].unionByName(sides[1]).unionByName(sides[2])
    got = lanes.gathered(counts, group, ["g"])
    assert (lanes.SALT in got.columns) == hot
    assert rows(lanes.distinct_from(got, group, names, rows="n")) == rows(lanes.distinct_from(lanes.added(counts, group), group, names, rows="n"))
    assert rows(lanes.distinct_from(got, group, names)) == rows(df.filter("id % 3 <> 0").groupBy(*group).agg(*[F.count_distinct(c).alias(c) for c in names]))
    if hot:
        assert got.filter("g IS NULL").select(lanes.SALT).distinct().count() > 100


def test_hot_groups_of_one_collation_are_one(spark):
    df = spark.range(600).select(F.when(F.col("id") % 2 == 0, "a").otherwise("A").cast("string collate UTF8_LCASE").alias("g"), (F.col("id") % 50).alias("i"))
    got = lanes.distinct_from(lanes.gathered(lanes.lane_rows(df, ["g"], {"i": F.col("i")}), ["g"]), ["g"], ["i"])
    assert [r["i"] for r in got.collect()] == [50]


def test_stored_batches_are_moved_once(spark, tmp_path):
    """Each part is shuffled to the key of the joins, and neither its sums nor its distinct counts nor the joins move it again."""
    n = spark.range(3000)
    details = n.select((F.col("id") % 1000).alias("workbook_id"), F.lit("w").alias("workbook"), "id", F.lit(views.WORKBOOK).alias("flag"))
    details = details.select("*", *[F.col("id").alias(c) for c in ("dashboard_id", "sheet_id", "field_id", "datasource_id", "column_name", "table_name")])
    tables = {
        "dashboard_details": details, "datasource_details": details,
        "custom_queries": details.select("workbook_id", F.col("id").alias("custom_query_id")),
        "usage": details.select("workbook_id", F.col("id").cast("int").alias("total_views")),
    }
    half = lambda i: {t: df.filter(F.col("workbook_id") % 2 == i) for t, df in tables.items()}
    maintained.follow_workbooks(str(tmp_path), "r", 0, half(0))
    maintained.follow_workbooks(str(tmp_path), "r", 1, half(1), half(0))
    maintained.follow_workbooks(str(tmp_path), "r", 2, half(0))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = maintained.workbook_summary(spark, str(tmp_path))
        assert plan_of(got).count("Exchange hashpartitioning") == len(maintained.WORKBOOK_PARTS)
        assert rows(got) == rows(views.workbook_summary(**tables))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(("incremental", "whole"), [("views_incremental", "v4_entity_summary"), ("views_incremental_source", "v1_status_summary")])
def test_batches_give_the_whole_view(spark, folder, incremental, whole):
    assert rows(q.QUERIES[incremental](spark, folder)) == rows(q.QUERIES[whole](spark, folder))


def test_no_expand_in_the_summaries(spark, folder):
    for name in ("v1_status_summary", "v4_entity_summary"):
        assert "Expand" not in plan_of(q.QUERIES[name](spark, folder))


def test_a_repeated_batch_counts_once(spark, tmp_path):
    history = spark.createDataFrame([("2024-01-01", "a", 1), ("2024-01-02", "b", None)], "load_time string, datasource string, datasource_id long")
    names = ("datasource", "datasource_id")
    for _ in range(2):
        maintained.follow_log(str(tmp_path), "r", 0, history, names)
    maintained.follow_log(str(tmp_path), "r", 1, history.limit(1), names, gone=history)
    assert maintained.load_log(spark, str(tmp_path), names).collect() == [("2024-01-01", "a", 1)]


def test_new_interactions(spark):
    details = spark.createDataFrame([(1, "d1", 7, views.DATASOURCE), (1, "d1", 7, views.DATASOURCE), (2, "d2", 8, "other")], "datasource_luid long, datasource string, datasource_id long, flag string")
    events = spark.createDataFrame([(i, 1 + i % 3, "t", "x") for i in range(9)], "event_id long, item_luid long, event_type string, event_date string")
    more_details = spark.createDataFrame([(3, "d3", 9, views.DATASOURCE)], details.schema)
    more_events = spark.createDataFrame([(100, 1, "t", "x"), (101, 3, "t", "x")], events.schema)
    before = views.datasource_interactions(details, events)
    after = views.datasource_interactions(details.unionByName(more_details), events.unionByName(more_events))
    new = maintained.new_interactions(views.datasource_interactions, details, more_details, events, more_events)
    assert rows(before.unionByName(new)) == rows(after)
