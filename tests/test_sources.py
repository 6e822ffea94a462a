import pytest
from pyspark.sql import functions as F

from freightlane.plans.contract import ColumnSpec, Contract
from freightlane.sources import jdbc, tables
from tests.conftest import plan_of, rows


def test_scan_prunes_columns_and_pushes_filters(spark, folder):
    df = tables.scan(tables.read_files(spark, f"{folder}/lineitem.parquet"), ["l_orderkey"], "l_quantity > 49 and l_returnflag = 'R'")
    plan = plan_of(df)
    assert "GreaterThan(l_quantity,49.0)" in plan and "EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in plan
    assert df.columns == ["l_orderkey"]


def test_scan_without_options_is_the_table(spark, folder):
    df = tables.read_files(spark, f"{folder}/nation.parquet")
    assert rows(tables.scan(df)) == rows(df)
    assert tables.row_count(df).first().row_count == 25


def test_a_snapshot_stays_the_same(spark):
    changing = spark.range(50).select("id", F.rand().alias("v"))
    kept = tables.snapshot(changing)
    assert rows(kept) == rows(kept) and kept.schema.names == ["id", "v"] and kept.count() == 50
    assert rows(changing.withColumn("v", F.rand())) != rows(kept)


@pytest.mark.parametrize("key", ["n", "t", "d"])
def test_pages_follow_the_rows(spark, key):
    df = spark.range(4000).select(
        F.when(F.col("id") < 3900, F.col("id")).otherwise(F.col("id") * 10**9).alias("n"),
        F.concat(F.lit("k/"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("t"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("d"),
    )
    df = df.unionByName(spark.createDataFrame([(None, None, None)], "n long, t string, d date"))
    for keys in (100_000, 1000):
        bounds = tables.page_bounds(df, key, 8, keys)
        assert len(bounds) == 7 and bounds == sorted(bounds)
        sizes = dict(tables.with_page_of(df, key, bounds).groupBy("page").count().collect())
        assert sum(sizes.values()) == 4001 and set(sizes) == set(range(8)) and max(sizes.values()) < 1000
    assert tables.page_bounds(df.limit(0), key, 8) == []


def test_a_frequent_key_is_one_bound(spark):
    df = spark.createDataFrame([(7,)] * 50 + [(i,) for i in range(20)], "k int")
    bounds = tables.page_bounds(df, "k", 10)
    assert len(bounds) == len(set(bounds)) and tables.with_page_of(df, "k", bounds).count() == 70


def test_bounds_go_to_database_predicates(spark):
    bounds = tables.page_bounds(spark.createDataFrame([("a",), ("b",), ("c'd",), ("e",)], "k string"), "k", 4)
    assert len(jdbc.boundary_predicates("postgres", "k", bounds)) == len(bounds) + 1


def test_pages_cover_every_row_once_in_key_order(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    paged = tables.with_page(orders, "o_orderkey", 7)
    assert paged.count() == orders.count()
    bounds = paged.groupBy("page").agg(F.min("o_orderkey").alias("a"), F.max("o_orderkey").alias("b")).orderBy("page").collect()
    assert [r.page for r in bounds] == list(range(7))
    assert all(x.b < y.a for x, y in zip(bounds, bounds[1:]))


def test_pages_of_odd_keys(spark):
    df = spark.createDataFrame([(5,), (5,), (None,)], "k int")
    assert rows(tables.with_page(df, "k", 4)) == [(5, 0), (5, 0), (None, 0)]
    wide = spark.createDataFrame([(-(2**63),), (0,), (2**63 - 1,)], "k long")
    assert [r.page for r in tables.with_page(wide, "k", 2).orderBy("k").collect()] == [0, 1, 1]


def test_split_by_range(spark):
    parts = tables.split_by_range(spark.range(1000), 4, "id").select(F.spark_partition_id().alias("p"), "id")
    spans = parts.groupBy("p").agg(F.min("id"), F.max("id")).orderBy("p").collect()
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_urls_and_identifiers():
    assert jdbc.url("postgres", "h", "d") == "jdbc:postgresql://h:5432/d"
    assert jdbc.url("sqlserver", "h", "d", 1500) == "jdbc:sqlserver://h:1500;databaseName=d"
    assert jdbc.url("mysql", "h", "d") == "jdbc:mysql://h:3306/d?rewriteBatchedStatements=true"
    assert jdbc.identifier("postgres", 'public.we"ird') == '"public"."we""ird"'
    assert jdbc.identifier("sqlserver", "dbo.a]b") == "[dbo].[a]]b]"
    assert jdbc.identifier("mysql", "t") == "`t`"


def test_read_options():
    options = jdbc.read_options("sqlserver", "jdbc:x", "dbo.t", "u", "p", dirty=True)
    assert options["dbtable"] == "[dbo].[t]"
    assert options["sessionInitStatement"] == "SET TRANSACTION ISOLATION LEVEL READ UNCOMMITTED"
    assert "sessionInitStatement" not in jdbc.read_options("postgres", "jdbc:x", "t", "u", "p", dirty=True)
    assert jdbc.range_options("id", 1, 99, 10) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "10"
    }


def test_write_and_catalog_options():
    options = jdbc.write_options("mysql", "jdbc:x", "db.t", "u", "p", writers=8)
    assert (options["batchsize"], options["numPartitions"], options["dbtable"]) == ("5000", "8", "`db`.`t`")
    settings = jdbc.catalog_settings("shop", "postgres", "jdbc:x", "u", "p")
    assert settings["spark.sql.catalog.shop"].endswith("JDBCTableCatalog")
    assert settings["spark.sql.catalog.shop.pushDownAggregate"] == "true"


@pytest.mark.parametrize("pages", [1, 2, 7, 200])
def test_range_predicates_take_every_row_once(spark, pages):
    df = spark.range(-3, 120).select(F.nullif(F.col("id"), F.lit(50)).alias("id"))
    predicates = [p.replace('"', "`") for p in jdbc.range_predicates("postgres", "id", 0, 99, pages)]
    assert len(predicates) <= max(pages, 100)
    hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    assert df.filter(hits != 1).count() == 0


def test_boundary_predicates_quote_text():
    assert jdbc.boundary_predicates("postgres", "id", ["a'b"]) == ['"id" < \'a\'\'b\' OR "id" IS NULL', "\"id\" >= 'a''b'"]
    assert jdbc.boundary_predicates("postgres", "id", []) == ["1 = 1"]
