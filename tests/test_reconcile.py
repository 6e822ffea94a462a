import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from freightlane.functions.compare import counts_match, values_match
from freightlane.operators import reconcile as rc
from freightlane.plans.contract import ColumnSpec, Contract
from freightlane.sources.sinks import report, write_profile, write_report
from tests.conftest import rows

SALES = Contract(
    "s.sales",
    "w.sales",
    (
        ColumnSpec("id", "INT8", "sale_id", role="primary_key"),
        ColumnSpec("amount", "DECIMAL", precision=18, scale=2),
        ColumnSpec("at", "DATETIME"),
        ColumnSpec("note", "TEXT", length=20),
    ),
)
SCHEMA = "sale_id long, amount decimal(18,2), at timestamp_ntz, note string"


def sales(spark, *values):
    return spark.createDataFrame([(i, F_dec(a), t, n) for i, a, t, n in values], SCHEMA)


def F_dec(value):
    from decimal import Decimal

    return None if value is None else Decimal(str(value))


def loaded(df):
    return df.withColumnRenamed("sale_id", "id")


T0, T1 = datetime(2024, 1, 1, 10, 0, 56, 160000), datetime(2024, 1, 1, 10, 0, 56)
BASE = [(1, 10, T0, "a"), (2, 20, T1, "b"), (3, None, None, None)]


def failed(checks):
    return {(r.check, r.column_name) for r in checks.collect() if not r["pass"]}


@pytest.mark.parametrize(
    "source, target, kind, expected",
    [
        (None, None, "numeric", True),
        (None, "1", "numeric", False),
        ("1", None, "numeric", False),
        ("0", "1e-10", "numeric", True),
        ("0", "0.1", "numeric", False),
        ("0.0", "-1e-10", "numeric", True),
        ("10000", "10001", "numeric", True),
        ("10000", "10002", "numeric", False),
        ("-10000", "-10001", "numeric", True),
        ("abc", "abc", "numeric", True),
        ("abc", "abd", "numeric", False),
        ("abc", "1", "numeric", False),
        ("5", "5.00", "numeric", True),
        ("nan", "nan", "numeric", False),
        ("2024-01-01 10:00:56.16", "2024-01-01 10:00:56.000000", "temporal", True),
        ("2024-01-01T10:00:56", "2024-01-01 10:00:56", "temporal", True),
        ("2024-01-01 10:00:56", "2024-01-01 10:00:57", "temporal", False),
        ("2024-01-01", "2024-01-01", "temporal", True),
        ("soon", "soon", "temporal", True),
        ("5", "5.0", "exact", False),
        ("5", "5", "exact", True),
    ],
)
def test_values_match(spark, source, target, kind, expected):
    df = spark.createDataFrame([(source, target, kind)], "s string, t string, k string")
    assert df.select(values_match(F.col("s"), F.col("t"), F.col("k"), 1e-4)).first()[0] is expected


@pytest.mark.parametrize(
    "source, target, tolerance, strict, expected",
    [(10, 10, 0.0, True, True), (10, 9, 0.0, True, False), (10, 9, 0.1, True, True), (10, 12, 0.1, True, False),
     (0, 5, 0.0, True, False), (0, 5, 0.0, False, True), (0, 0, 0.0, True, True)],
)
def test_counts_match(spark, source, target, tolerance, strict, expected):
    df = spark.createDataFrame([(source, target)], "s long, t long")
    assert df.select(counts_match(F.col("s"), F.col("t"), tolerance, strict)).first()[0] is expected


def test_a_table_agrees_with_itself(spark):
    df = sales(spark, *BASE)
    checks = rc.table_checks(df, loaded(df), SALES)
    assert failed(checks) == set()
    assert {(r.check, r.column_name) for r in checks.collect()} == {
        ("L1_ROW_COUNT", None), ("L2_SUM", "id"), ("L2_MIN", "id"), ("L2_MAX", "id"), ("L3_DISTINCT", "id"),
        ("L2_SUM", "amount"), ("L2_MIN", "amount"), ("L2_MAX", "amount"), ("L2_MIN", "at"), ("L2_MAX", "at"),
    }


@pytest.mark.parametrize(
    "target, expected",
    [
        ([(1, 10, T0, "a"), (2, 21, T1, "b"), (3, None, None, None)], {("L2_SUM", "amount"), ("L2_MAX", "amount")}),
        ([(1, 10, T1, "x"), (2, 20, T1, "b"), (3, None, None, None)], set()),
        ([(1, 10, None, "a"), (2, 20, None, "b"), (3, None, None, None)], {("L2_MIN", "at"), ("L2_MAX", "at")}),
        (BASE + [(3, None, None, None)], {("L1_ROW_COUNT", None), ("L2_SUM", "id")}),
        ([(1, 10, T0, "a"), (2, 20, T1, "b"), (2, None, None, None)], {("L2_SUM", "id"), ("L2_MAX", "id"), ("L3_DISTINCT", "id")}),
    ],
)
def test_a_planted_defect_fails_its_own_checks_only(spark, target, expected):
    assert failed(rc.table_checks(sales(spark, *BASE), loaded(sales(spark, *target)), SALES)) == expected


def test_missing_and_wrong_columns_are_error_rows(spark):
    df = sales(spark, *BASE)
    target = loaded(df).drop("at").withColumn("amount", F.col("amount").cast("string"))
    checks = {(r.check, r.column_name): r for r in rc.table_checks(df, target, SALES).collect()}
    assert checks[("L2_MIN", "at")].error == "target column at is missing"
    assert checks[("L2_SUM", "amount")].error == "target column amount is string, not a number"
    assert not checks[("L2_MIN", "at")]["pass"] and checks[("L2_SUM", "id")]["pass"]
    assert len(checks) == 10


def test_missing_table_is_an_error_row(spark):
    df = sales(spark, *BASE)
    checks = rc.table_checks(df, None, SALES)
    assert all(r.error == "target table is missing" and r["pass"] is False for r in checks.collect())
    assert ("L1_ROW_COUNT", None) in failed(checks)
    assert {r.error for r in rc.table_checks(None, loaded(df), SALES).collect()} == {"source table is missing"}


def test_empty_source(spark):
    empty, some = sales(spark), loaded(sales(spark, *BASE))
    assert ("L1_ROW_COUNT", None) in failed(rc.table_checks(empty, some, SALES))
    assert ("L1_ROW_COUNT", None) not in failed(rc.table_checks(empty, some, SALES, strict=False))
    assert failed(rc.table_checks(empty, loaded(empty), SALES)) == set()


def test_all_null_columns_agree(spark):
    df = sales(spark, (1, None, None, None))
    assert failed(rc.table_checks(df, loaded(df), SALES)) == set()


def test_integer_sums_do_not_overflow(spark):
    df = sales(spark, (2**63 - 1, 1, T0, ""), (2**63 - 2, 1, T0, ""))
    checks = {(r.check, r.column_name): r for r in rc.table_checks(df, loaded(df), SALES).collect()}
    assert checks[("L2_SUM", "id")].source == str(2**64 - 3)


def test_verdicts_and_report(spark, tmp_path):
    df = sales(spark, *BASE)
    good = rc.table_checks(df, loaded(df), SALES)
    bad = rc.table_checks(df, loaded(df).drop("at"), SALES).withColumn("table_name", F.lit("other"))
    checks = rc.all_checks([good, bad])
    assert rows(rc.table_verdicts(checks)) == [("other", 10, 8, 2, False), ("sales", 10, 10, 0, True)]
    assert tuple(rc.run_verdict(checks).first()) == (2, 1, 1, 18, 2, False)
    assert report(good, "postgres", "mysql").first().all_pass is True
    write_report(checks, str(tmp_path / "report"), "postgres", "mysql")
    (file,) = (tmp_path / "report").glob("*.json")
    written = json.loads(file.read_text())
    assert written["all_pass"] is False and written["source_engine"] == "postgres" and "T" in written["validated_at"]
    assert [(t["table_name"], t["pass"], len(t["checks"])) for t in written["tables"]] == [("other", False, 10), ("sales", True, 10)]
    write_profile(good.drop("pass"), str(tmp_path / "profile"))
    assert spark.read.json(str(tmp_path / "profile")).count() == 10


def test_row_diff_classes(spark):
    source = sales(spark, (1, 1, T0, "a"), (2, 2, T0, "b"), (3, 3, T0, None), (None, 5, T0, "k"))
    target = sales(spark, (1, 1, T0, "a"), (2, 2, T0, "B"), (4, 4, T0, "d"), (None, 5, T0, "k"))
    assert rows(rc.row_diff(source, target, ["sale_id"])) == [(2, "changed", 1, 1), (3, "missing", 1, 0), (4, "extra", 0, 1)]
    assert rows(rc.row_diff(source, source, ["sale_id"])) == []


def test_row_diff_sees_values_that_swap_places_with_null(spark):
    source = spark.createDataFrame([(1, 5, None)], "k int, a int, b int")
    target = spark.createDataFrame([(1, None, 5)], "k int, a int, b int")
    assert rows(rc.row_diff(source, target, ["k"])) == [(1, "changed", 1, 1)]


def test_row_diff_compares_repeated_keys_as_multisets(spark):
    schema = "k int, v string"
    source = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "x"), (2, "y")], schema)
    target = spark.createDataFrame([(1, "c"), (1, "c"), (1, "b"), (2, "y"), (2, "x")], schema)
    assert rows(rc.row_diff(source, target, ["k"])) == [(1, "changed", 3, 3)]
    fewer = spark.createDataFrame([(1, "a"), (1, "b"), (2, "x"), (2, "y")], schema)
    assert rows(rc.row_diff(source, fewer, ["k"])) == [(1, "changed", 3, 2)]


def test_row_diff_equals_brute_force(spark, folder):
    from collections import Counter

    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_suppkey", "l_returnflag", "l_quantity")
    other = lines.filter("not (l_suppkey = 3 and l_quantity = 7)").withColumn(
        "l_returnflag", F.when((F.col("l_suppkey") == 5) & (F.col("l_quantity") == 9), "Z").otherwise(F.col("l_returnflag"))
    )
    left, right = {}, {}
    for frame, into in ((lines, left), (other, right)):
        for r in frame.collect():
            into.setdefault(r[0], Counter())[tuple(r)] += 1
    expected = sorted(
        (k, "changed", sum(left[k].values()), sum(right[k].values())) for k in left if k in right and left[k] != right[k]
    )
    assert rows(rc.row_diff(lines, other, ["l_suppkey"])) == expected and expected


def test_reconcile_tables_goes_on_past_a_missing_one(spark, tmp_path):
    df = sales(spark, *BASE)
    gone = Contract("s.gone", "w.gone", SALES.columns)

    def read_target(contract):
        return spark.read.parquet(str(tmp_path / "nothing")) if contract is gone else loaded(df)

    checks = rc.reconcile_tables([SALES, gone], lambda c: df, read_target)
    assert {r.table_name: r["pass"] for r in rc.table_verdicts(checks).collect()} == {"gone": False, "sales": True}
    only = rc.reconcile_tables([SALES, gone], lambda c: df, read_target, tables=["s.sales"])
    assert {r.table_name for r in only.collect()} == {"sales"}


def test_reconcile_tables_goes_on_past_an_unreadable_file(spark, tmp_path):
    one = Contract("s.one", "w.one", (ColumnSpec("k", "INT8", role="primary_key"),))
    two = Contract("s.two", "w.two", (ColumnSpec("k", "INT8", role="primary_key"),))
    for name in ("one", "two"):
        spark.range(5).withColumnRenamed("id", "k").coalesce(1).write.parquet(str(tmp_path / name))
    for file in (tmp_path / "two").glob("*.parquet"):
        file.write_bytes(b"PAR1 this is no table PAR1")
    for crc in (tmp_path / "two").glob(".*.crc"):
        crc.unlink()
    read = lambda c: spark.read.schema("k long").parquet(str(tmp_path / c.name))
    checks = rc.reconcile_tables([one, two], read, read)
    assert {(r["table_name"], r["pass"]) for r in checks.collect()} == {("one", True), ("two", False)}
    failures = [r for r in checks.collect() if r.table_name == "two"]
    assert failures and all(r.error for r in failures)
    assert checks.filter("table_name = 'one'").count() == 5
    assert {r["table_name"]: r["pass"] for r in rc.table_verdicts(checks).collect()} == {"one": True, "two": False}


def test_row_diff_of_different_types_compares_texts(spark):
    ours = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "k int, v int")
    theirs = spark.createDataFrame([(1, "7"), (2, "eight"), (3, None)], "k long, v string")
    assert [(r.k, r.difference) for r in rc.row_diff(ours, theirs, ["k"]).collect()] == [(2, "changed")]
