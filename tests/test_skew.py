"""One key with a third of all rows: results stay right, and the work of that key is spread or combined."""

import pytest
from pyspark.sql import functions as F

from freightlane.operators import profile as pf, reconcile as rc
from freightlane.operators.joins import fan_out_join, hot_keys
from freightlane.operators.keys import one_per_key
from freightlane.plans import views

N = 60_000


def hot_key():
    return F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000)


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which the test data counts as large and skewed."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_a_hot_event_key_is_split(spark, small_partitions):
    events = spark.range(0, N, 1, 8).select(hot_key().alias("item"), F.col("id").alias("event"))
    details = spark.range(0, 6000, 1, 8).select((F.col("id") % 3000).alias("item_id"), F.lit("x").alias("name"))
    joined = fan_out_join(details, events, "item_id", "item", ["name"])
    expected = 2 * events.filter("item < 3000").count()
    assert joined.count() == expected
    joined.write.format("noop").mode("overwrite").save()
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_found_and_dealt_out(spark, small_partitions):
    """Half of all events have one key: after salting the longest partition has at most three times the median's rows."""
    events = spark.range(0, N, 1, 8).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("item"), F.col("id").alias("event"))
    details = spark.range(0, 6000, 1, 8).select((F.col("id") % 3000).alias("item_id"), F.lit("x").alias("name"))
    assert hot_keys(events, "item") == [7] and hot_keys(events.filter("item <> 7"), "item") == []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    sizes = {}
    for salts in (0, 64):
        joined = fan_out_join(details, events, "item_id", "item", ["name"], salts)
        sizes[salts] = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes[salts]) == 2 * events.filter("item < 3000").count()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes[64][-1] <= 3 * sizes[64][len(sizes[64]) // 2] < sizes[0][-1]


def test_a_hot_key_leaves_each_task_as_one_row(spark):
    """Rows that reach the shuffle: at most one per key and input task."""
    df = spark.range(0, N, 1, 8).select(hot_key().alias("k"), F.col("id").alias("v"))
    out = one_per_key(df, ["k"])
    assert out.count() == 5000
    assert out.filter("k = 0").first().v == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_diff_profile_and_summary_with_a_hot_key(spark):
    df = spark.range(0, N, 1, 8).select(hot_key().alias("k"), F.col("id").alias("v"))
    changed = df.withColumn("v", F.when(F.col("v") == 3, -1).otherwise(F.col("v")))
    assert [tuple(r) for r in rc.row_diff(df, changed, ["k"]).collect()] == [(0, "changed", N // 3 + 8, N // 3 + 8)]
    assert {r.column_name: r.distinct_count for r in pf.distinct_counts(df, ["k", "v"]).collect()} == {"k": 5000, "v": N}
    usage = df.select(F.col("k").alias("workbook_id"), F.lit(1).alias("total_views"))
    dashboards = df.select(
        F.col("k").alias("workbook_id"),
        F.lit("w").alias("workbook"),
        *[F.col("v").alias(c) for c in ("dashboard_id", "sheet_id", "field_id", "datasource_id", "column_name", "table_name")],
    )
    details = dashboards.withColumn("flag", F.lit("Workbook"))
    queries = df.select(F.col("k").alias("workbook_id"), F.col("v").alias("custom_query_id"))
    hot = views.workbook_summary(dashboards, details, queries, usage).filter("workbook_id = '0'").first()
    assert (hot.dashboard_cnt, hot.total_table_cnt, hot.custom_query_cnt, hot.view_cnt) == (N // 3 + 8,) * 4
