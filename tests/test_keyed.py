"""Loads that keep their keys in the stream's state."""

from pathlib import Path

import pytest

from freightlane.operators import load
from freightlane.plans.contract import ColumnSpec, Contract
from freightlane.streaming.keyed import PROVIDER, keyed_load
from tests.conftest import rows
from workload import queries as q

ITEMS = Contract("s.items", "w.items", (ColumnSpec("id", "INT8"), ColumnSpec("name", "TEXT", length=5), ColumnSpec("n", "INT4", "amount")), ("id",))
SCHEMA = "id long, name string, amount string"


@pytest.fixture
def place(tmp_path):
    return {k: str(tmp_path / k) for k in ("source", "target", "state", "rejects")}


def drop_in(spark, place, *values):
    spark.createDataFrame(list(values), SCHEMA).coalesce(1).write.mode("append").parquet(place["source"])


def run(spark, place, **options):
    return keyed_load(spark, place["source"], ITEMS, place["target"], place["state"], "r", max_files=1, **options)


def keys_in_state(query):
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1]


def test_first_rows_stay_whatever_comes_later(spark, place):
    drop_in(spark, place, (1, "b", "1"), (1, "a", "2"), (1, "a", None), (2, "x", "1"), (3, "toolong", "1"), (None, "y", "1"))
    drop_in(spark, place, (1, "A", "0"), (4, "d", "4"), (4, None, "4"))
    query = run(spark, place, rejects=place["rejects"])
    expected = [(1, "a", None), (2, "x", 1), (4, None, 4)]
    assert rows(load.read_target(spark, place["target"], ITEMS)) == sorted(expected, key=repr) and keys_in_state(query) == 3
    assert spark.read.option("header", True).csv(place["rejects"]).count() == 2
    drop_in(spark, place, (2, "a", "0"), (5, "e", "5"))
    query = run(spark, place, rejects=place["rejects"])
    assert rows(load.read_target(spark, place["target"], ITEMS)) == sorted([*expected, (5, "e", 5)], key=repr) and keys_in_state(query) == 4
    run(spark, place)
    assert load.read_target(spark, place["target"], ITEMS).count() == 4
    assert "RocksDB" not in (spark.conf.get(PROVIDER, "") or "")


def test_a_killed_batch_is_repeated_with_the_same_rows(spark, place):
    """The batch had written its files, but the stream died before it was committed."""
    drop_in(spark, place, (1, "a", "1"), (2, "b", "2"))
    drop_in(spark, place, (2, "A", "0"), (3, "c", "3"))
    run(spark, place)
    before = rows(load.read_target(spark, place["target"], ITEMS))
    commits = Path(place["state"]) / "r" / "items" / "keyed" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (commits / name).unlink()
    drop_in(spark, place, (3, "b", "0"), (4, "d", "4"))
    run(spark, place)
    assert rows(load.read_target(spark, place["target"], ITEMS)) == sorted([*before, (4, "d", 4)], key=repr)


def test_a_table_without_a_key_is_refused(spark, place):
    with pytest.raises(ValueError):
        keyed_load(spark, place["source"], Contract("s.x", "w.x", (ColumnSpec("a", "INT8"),)), place["target"], place["state"], "r")


def test_the_query_writes_its_files_by_many_tasks_and_loads_parts_whole(spark, tmp_path, monkeypatch):
    """No task reads the whole table, and a key's smallest row in its part stays, whichever of the part's files it is in."""
    lines = "id % 40 AS l_orderkey, id AS l_partkey, id AS l_suppkey, int(id % 2) AS l_linenumber, 1d AS l_quantity, double(id) AS l_extendedprice, 0d AS l_discount, 0d AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus, timestamp_ntz '2024-01-01' AS l_shipdate"
    spark.range(400).selectExpr(*lines.split(", ")).repartition(4).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(q, "work_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    found = q.load_stateful(spark, str(tmp_path))
    by_key = {(r["order_id"], r["line_no"]): r for r in found.collect()}
    assert rows(found) == rows(q.load_overlap(spark, str(tmp_path))) and found.count() == len(by_key)
    assert len(list((tmp_path / "stateful/source").glob("*.parquet"))) > 4
    assert len([p for p in (tmp_path / "stateful/state/run-1/lineitem/keyed/commits").iterdir() if p.name.isdigit()]) == 2
