"""Operators on keys: one row per key, not-yet-loaded rows, uniqueness and orphan checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from freightlane.functions.scalars import quoted, stacked
from freightlane.plans.contract import Contract

RANK = "_rank"


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(quoted(c)).isNull() for c in columns])


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def one_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The first row of every key by `order`, ties broken by the remaining columns, smallest first.

    Without `order` that is the smallest row, so a repeated load keeps the same row. The rank filter lets
    Spark keep only the best row per key in each map task before the shuffle, so a hot key moves one row
    per task.
    """
    ties = [
        F.col(quoted(f.name)).asc_nulls_first() if _orderable(f.dataType) else F.to_json(F.col(quoted(f.name)))
        for f in df.schema
        if f.name not in key
    ]
    ranking = [*order, *ties] or [F.lit(1)]
    window = Window.partitionBy(*[quoted(k) for k in key]).orderBy(*ranking)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) == 1).drop(RANK)


def latest_per_key(df: DataFrame, key: Sequence[str], time: str) -> DataFrame:
    """The newest row of every key in a history table."""
    return one_per_key(df, key, [F.desc_nulls_last(quoted(time))])


def not_loaded(incoming: DataFrame, loaded: DataFrame, key: Sequence[str], null_keys: bool = True) -> DataFrame:
    """Rows of `incoming` whose key is not in `loaded`. Only the key columns of `loaded` are read.

    Distinct keys cost no extra shuffle (the join needs the same partitioning) and collapse repeated keys
    before it. NULL parts of keys equal each other, as in one_per_key(); such rows are compared apart, so that the
    others keep the plain join. `null_keys=False` says that there are none.
    """
    known = loaded.select(*[quoted(k) for k in key]).distinct()
    if not null_keys:
        return incoming.join(known, list(key), "left_anti")
    there = known.filter(_any_null(key)).select(*[F.col(quoted(k)).alias(f"_known{i}") for i, k in enumerate(key)])
    same = reduce(and_, [F.col(quoted(k)).eqNullSafe(F.col(f"_known{i}")) for i, k in enumerate(key)])
    whole = incoming.filter(~_any_null(key)).join(known, list(key), "left_anti")
    partial = incoming.filter(_any_null(key)).join(there, same, "left_anti")
    return whole.select(*[quoted(c) for c in incoming.columns]).unionByName(partial)


def key_check(df: DataFrame, key: Sequence[str], table: str) -> DataFrame:
    """One row per table: rows, distinct keys, rows with a NULL in the key, surplus copies, uniqueness."""
    null_key = F.col("null_key")
    per_key = df.groupBy(*[quoted(k) for k in key]).agg(F.count(F.lit(1)).alias("copies"))
    summary = per_key.withColumn("null_key", _any_null(key)).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count_if(~null_key).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(null_key, F.col("copies"))), F.lit(0)).alias("null_key_rows"),
        F.coalesce(F.sum(F.when(~null_key, F.col("copies") - 1)), F.lit(0)).alias("surplus_rows"),
        F.coalesce(F.max(F.when(~null_key, F.col("copies"))), F.lit(0)).alias("most_copies"),
    )
    return summary.select(
        F.lit(table).alias("table_name"),
        F.lit(",".join(key)).alias("key_columns"),
        "*",
        ((F.col("null_key_rows") == 0) & (F.col("surplus_rows") == 0)).alias("is_unique"),
    )


def orphan_keys(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child key values without a parent, with the number of child rows each. `on` is child -> parent column.

    A key with a NULL part refers to nothing and is no orphan. Child rows are counted per key before the
    join, so a hot key reaches it as one row.
    """
    columns = [quoted(c) for c in on]
    known = parent.select(*[F.col(quoted(p)).alias(c) for c, p in on.items()]).distinct()
    used = child.filter(~_any_null(list(on))).groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    return used.join(known, list(on), "left_anti")


def orphan_rows(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """The child rows themselves. A hot orphan key is split by Spark's skew join (left side of left_anti)."""
    known = parent.select(*[F.col(quoted(p)).alias(c) for c, p in on.items()]).distinct()
    present = reduce(and_, [F.col(quoted(c)).isNotNull() for c in on])
    return child.filter(present).join(known, list(on), "left_anti")


def foreign_key_checks(contract: Contract, child: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """One row per foreign key of a contract: how many key values, and child rows, have no parent.

    `parents` holds the referenced tables by the name the contract uses.
    """
    schema = "table_name string, column_name string, parent string, orphan_keys long, orphan_rows long, pass boolean"
    if not contract.foreign_keys:
        return child.sparkSession.createDataFrame([], schema)
    types = {f.name: f.dataType for f in child.schema}
    # Values of all keys side by side, each as text beside its position: one scan, repeats combined before the shuffle.
    rows = [(str(i), f"string({quoted(fk.column)})") for i, fk in enumerate(contract.foreign_keys)]
    used = stacked(child, ("nth", "value"), rows).filter("value IS NOT NULL").groupBy("nth", "value")
    used = used.agg(F.count(F.lit(1)).alias("row_count"))
    known = reduce(
        DataFrame.unionByName,
        [
            parents[fk.parent_table]
            .select(F.lit(i).alias("nth"), F.col(quoted(fk.parent_column)).try_cast(types[fk.column]).cast("string").alias("value"))
            .distinct()
            for i, fk in enumerate(contract.foreign_keys)
        ],
    )
    lost = used.join(known, ["nth", "value"], "left_anti").groupBy("nth").agg(
        F.count(F.lit(1)).alias("orphan_keys"), F.sum("row_count").alias("orphan_rows")
    )
    names = [
        (i, contract.name, fk.column, f"{fk.parent_table}.{fk.parent_column}") for i, fk in enumerate(contract.foreign_keys)
    ]
    listed = child.sparkSession.createDataFrame(names, "nth int, table_name string, column_name string, parent string")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("orphan_keys", "orphan_rows")]
    return listed.join(lost, "nth", "left").select(
        "table_name", "column_name", "parent", *counts, F.col("orphan_rows").isNull().alias("pass")
    )
