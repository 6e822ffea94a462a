"""The six views on hand-made tables in their own column names."""

from datetime import datetime

import pytest

from freightlane.operators.joins import fan_out_join, repeat_rows
from freightlane.plans import views
from tests.conftest import rows

T1, T2 = datetime(2026, 1, 1), datetime(2026, 1, 2)


@pytest.fixture(scope="module")
def details(spark):
    columns = (
        "workbook_id string, datasource_id string, datasource string, contains_extract boolean, ds_project string, "
        "dashboard_id string, sheet_id string, field_id string, table_name string, column_name string, flag string, "
        "datasource_luid string"
    )
    return spark.createDataFrame(
        [
            ("w1", "d1", "sales", True, "p", "", "s1", "f1", "t1", "c1", "Datasource", "L1"),
            ("w2", "d1", "sales", True, "p", "b1", "s1", "f2", None, "c1", "Datasource", "L1"),
            ("w1", "d2", "stock", False, None, None, "", "f3", "t1", "", "Datasource", "L2"),
            ("w1", "d1", "sales", True, "p", "b9", "s9", "f9", "t9", "c9", "Workbook", "L1"),
            ("w1", "d1", "sales", True, "p", "b9", "s9", "f8", "t9", None, "Workbook", "L1"),
            ("w1", "d1", "sales", True, "p", "b9", "s9", None, "t9", "", "Workbook", "L1"),
            (None, "d1", "sales", True, "p", "b9", "s9", "f7", "t9", "c9", "Workbook", None),
        ],
        columns,
    )


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([("w1", "q1"), ("w1", "q2"), ("w1", "q1"), ("w3", "d1"), ("w3", "d1"), ("w3", "")], "workbook_id string, custom_query_id string")


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(
        [("e1", "L1", "view", T1), ("e2", "L1", "edit", T2), ("e3", "L1", "view", T2), ("e4", "v1", "view", T1), ("e5", None, "view", T1)],
        "event_id string, item_luid string, event_type string, event_date timestamp_ntz",
    )


def test_datasource_summary(details, queries):
    out = views.datasource_summary(details, queries)
    assert out.columns == [
        "datasource_id", "datasource", "contains_extract", "ds_project", "dashboard_cnt", "sheet_cnt", "field_cnt",
        "workbook_cnt", "table_cnt", "column_cnt", "custom_query_cnt",
    ]
    assert rows(out) == [
        ("d1", "sales", True, "p", 1, 1, 2, 2, 1, 1, 1),
        ("d2", "stock", False, None, 0, 0, 1, 1, 1, 0, 0),
    ]


def test_interactions_keep_their_fan_out(details, events):
    out = views.datasource_interactions(details, events)
    assert out.columns == ["event_id", "datasource", "datasource_id", "interaction_type", "interaction_date"]
    assert rows(out) == sorted([(e, "sales", "d1", k, t) for e, k, t in [("e1", "view", T1), ("e2", "edit", T2), ("e3", "view", T2)]] * 2)


def test_workbook_summary(spark, details, queries):
    dashboards = spark.createDataFrame(
        [
            ("w1", "a", "b1", "s1", "f1", "d1", "c1", "t1"),
            ("w1", "a", "b1", "s2", "f1", "d1", None, "t1"),
            ("w1", "a", "b2", "s2", "f2", "d1", "", "t1"),
            ("w1", "b", "b1", "s1", "f1", "d1", "c1", "t1"),
            ("w2", "c", None, None, None, None, None, None),
            (None, "n", "b1", "s1", "f1", "d1", "c1", "t1"),
        ],
        "workbook_id string, workbook string, dashboard_id string, sheet_id string, field_id string, datasource_id string, "
        "column_name string, table_name string",
    )
    usage = spark.createDataFrame([("w1", 3), ("w1", 4), ("w9", 1)], "workbook_id string, total_views int")
    out = views.workbook_summary(dashboards, details, queries, usage)
    assert out.columns == [
        "workbook_id", "workbook", "dashboard_cnt", "sheet_cnt", "datasource_cnt", "total_field_cnt", "used_field_cnt",
        "total_column_cnt", "used_column_cnt", "total_table_cnt", "used_table_cnt", "custom_query_cnt", "view_cnt",
    ]
    # NULL and '' parts of a concatenation are the same value; two names of one id repeat its totals; a NULL id never joins.
    assert rows(out) == sorted(
        [
            ("w1", "a", 2, 2, 1, 2, 2, 2, 2, 1, 1, 2, 7),
            ("w1", "b", 1, 1, 1, 2, 1, 2, 1, 1, 1, 2, 7),
            ("w2", "c", 0, 0, 0, 0, 0, 0, 1, 0, 1, 0, 0),
            (None, "n", 1, 1, 0, 0, 1, 0, 1, 0, 1, 0, 0),
        ],
        key=repr,
    )


def test_load_logs_are_distinct_and_newest_first(spark):
    history = spark.createDataFrame(
        [(T1, "a", "1"), (T2, "a", "1"), (T1, "a", "1"), (T1, "b", "2")], "load_time timestamp_ntz, workbook string, workbook_id string"
    )
    out = views.workbook_load_log(history).collect()
    assert [r.load_time for r in out] == [T2, T1, T1]
    assert len({tuple(r) for r in out}) == 3
    renamed = history.withColumnsRenamed({"workbook": "datasource", "workbook_id": "datasource_id"})
    assert [r.load_time for r in views.datasource_load_log(renamed).collect()] == [T2, T1, T1]


def test_workbook_interactions(spark, events):
    usage = spark.createDataFrame([("v1", "a", "w1"), ("v2", "b", "w2")], "view_id string, workbook string, workbook_id string")
    out = views.workbook_interactions(usage, events)
    assert out.columns == ["event_id", "workbook", "workbook_id", "event_type", "event_date"]
    assert rows(out) == [("e4", "a", "w1", "view", T1)]


@pytest.mark.parametrize("times", [1, 2, 9_999, 10_000, 10_001, 20_000, 25_003])
def test_rows_repeat_exactly(spark, times):
    assert repeat_rows(spark.sql(f"select 1 as v, bigint({times}) as n"), "n").count() == times


def test_fan_out_join_equals_a_plain_join(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    plain = lines.join(orders, lines.l_orderkey.cast("string") == orders.o_orderkey.cast("string"))
    plain = plain.select("o_orderkey", "l_returnflag").groupBy("o_orderkey", "l_returnflag").count()
    mine = fan_out_join(lines, orders, "l_orderkey", "o_orderkey", ["l_returnflag"]).groupBy("o_orderkey", "l_returnflag").count()
    assert rows(mine) == rows(plain)


def test_views_can_be_queried_by_name(spark, details, queries, events):
    ready = views.register_views(
        {"datasource_details_base": details, "custom_query_details_base": queries, "event_details_base": events}
    )
    assert ready == ["datasource_details_base_smry", "datasource_interaction_smry"]
    assert spark.sql("select sum(field_cnt) as n from datasource_details_base_smry").first().n == 3
