"""Every registered query against its SQL, and what the plans must and must not contain."""

import os
import shutil
from pathlib import Path
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from freightlane.session import work_folder
from tests.conftest import plan_of
from workload.oracles import ORACLES
from workload.queries import QUERIES

LOADS = {"load_stream", "load_progress", "load_summary", "load_totals"}


@pytest.fixture(scope="module")
def sql(folder):
    connection = duckdb.connect()
    for name in os.listdir(folder):
        connection.execute(f"CREATE VIEW {Path(name).stem} AS SELECT * FROM '{folder}/{name}'")
    return connection


def normal(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in values]
    return [columns[i] for i in order], sorted(plain, key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, folder, sql, name):
    df = QUERIES[name](spark, folder)
    cursor = sql.execute(contract.oracle_sql()[name])
    expected = normal([d[0] for d in cursor.description], cursor.fetchall())
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == expected


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in LOADS])
def test_plan_stays_in_the_jvm_without_cross_joins(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


def test_one_row_per_key_is_cut_down_before_the_shuffle(spark, folder):
    plan = plan_of(QUERIES["dedupe_lineitem"](spark, folder))
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:shuffle] and "WindowGroupLimit" in plan[shuffle:]


def test_load_shares_one_partitioning(spark, folder):
    """The anti-join needs no shuffle of its own for the incoming rows: one per side."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["load_anti"](spark, folder))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 2


def test_row_diff_shuffles_once(spark, folder):
    plan = plan_of(QUERIES["row_diff"](spark, folder))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_conform_and_split_do_not_shuffle(spark, folder):
    for name in ("conform_orders", "conform_json", "reject_split", "accepted_rows"):
        assert "Exchange" not in plan_of(QUERIES[name](spark, folder))


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("setting", ["/shared/place/", "hdfs://name/place"])
def test_work_folder_is_in_the_shared_folder(setting):
    session = SimpleNamespace(conf={"spark.checkpoint.dir": setting})
    first, second = work_folder(session, "x"), work_folder(session, "x")
    assert first.startswith(f"{setting.rstrip('/')}/x-") and first != second


class Settings(dict):
    def get(self, key, default=None):
        return super().get(key, default)


def test_work_folder_without_a_shared_folder_is_in_the_warehouse():
    local = SimpleNamespace(conf=Settings({"spark.sql.warehouse.dir": "/ware/house", "spark.master": "local[4]"}))
    assert work_folder(local, "x").startswith("/ware/house/work/x-")
    stored = SimpleNamespace(conf=Settings({"spark.sql.warehouse.dir": "hdfs://name/house", "spark.master": "yarn"}))
    assert work_folder(stored, "x").startswith("hdfs://name/house/work/x-")


@pytest.mark.parametrize("master", ["yarn", "spark://host:1", "local-cluster[2,1,1024]"])
def test_a_local_warehouse_is_no_shared_folder(master):
    session = SimpleNamespace(conf=Settings({"spark.sql.warehouse.dir": "file:/ware/house", "spark.master": master}))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(session, "x")


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("v1_status_summary", "EqualTo(o_orderstatus,F)"),
        ("v3_interactions", "EqualTo(c_mktsegment,BUILDING)"),
        ("v4_entity_summary", "EqualTo(l_returnflag,R)"),
    ],
)
def test_flags_reach_the_scan(spark, folder, name, pushed):
    assert pushed in plan_of(QUERIES[name](spark, folder)).replace(" ", "")


def test_keys_of_one_kind_are_joined_as_they_are(spark, folder):
    for name in ("v1_status_summary", "v3_interactions", "v6_interactions"):
        joins = [x for x in plan_of(QUERIES[name](spark, folder)).splitlines() if "Join" in x]
        assert joins and all("as string" not in x for x in joins)


def test_foreign_keys_read_a_child_once(spark, folder):
    from workload.queries import REFERENCES, table

    from freightlane.operators.keys import foreign_key_checks

    parents = {fk.parent_table: table(spark, folder, fk.parent_table) for fk in REFERENCES[0].foreign_keys}
    plan = plan_of(foreign_key_checks(REFERENCES[0], table(spark, folder, "lineitem"), parents))
    assert plan.count("lineitem.parquet") == 1


@pytest.mark.parametrize("parts", [1, 3])
def test_streams_read_their_table_only(spark, folder, tmp_path, parts):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    if parts == 1:
        shutil.copy(f"{folder}/orders.parquet", tmp_path / "orders.parquet")
    else:
        orders.repartition(parts).write.parquet(str(tmp_path / "orders.parquet"))
    orders.withColumn("o_orderkey", -F.col("o_orderkey") - 1).write.parquet(str(tmp_path / "orders.parquet_old"))
    assert QUERIES["load_stream"](spark, str(tmp_path)).count() == orders.count()
