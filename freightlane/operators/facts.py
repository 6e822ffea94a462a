"""Profiles that grow with their table: facts per load batch that can be merged, so old data are not read again.

A batch is profiled once and leaves one row: rows, and per column NULLs, minimum, maximum, greatest length, and two sketches, of
distinct values (HyperLogLog) and, for numbers, of their quantiles (KLL). Sums, extremes and sketches of batches merge into those
of the table. All but distinct counts and quartiles are exact. With 2^12 registers a distinct count has a relative standard error
of 1.04 / 64, 1.6 %; with k = 200 a quartile's rank is off by 1.65 % of the rows or less in 99 of 100 cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from freightlane.functions.scalars import literal, quoted, size_of, stacked
from freightlane.functions.types import is_fractional, is_integral
from freightlane.operators.load import batch_folder
from freightlane.operators.profile import flat_columns

REGISTERS = 12  # as a power of two
KLL_K = 200
NAMES = (
    "table_name", "column_name", "rows", "null_rate", "distinct_estimate", "min_value", "max_value", "max_length", "q1", "median", "q3",
)


def _distinct_value(c: Column, dtype: T.DataType) -> Column:
    """The value as a type that sketches take; equal values stay equal."""
    if is_integral(dtype) or isinstance(dtype, T.BooleanType):
        return c.cast("long")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (c.cast("double") + F.lit(0.0)).cast("string")
    return c if isinstance(dtype, T.BinaryType) else c.cast("string")


def _is_number(dtype: T.DataType) -> bool:
    return is_integral(dtype) or is_fractional(dtype)


def batch_facts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The one row of facts of a batch. One pass; nothing but one row per task is shuffled."""
    names = list(columns or df.columns)
    flat = flat_columns(df, names)
    found = [F.count(F.lit(1)).alias("n")]
    for i, field in enumerate(flat.schema):
        c, dtype = F.col(quoted(field.name)), field.dataType
        found += [F.count_if(c.isNull()).alias(f"nulls{i}"), F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}")]
        found.append(F.hll_sketch_agg(_distinct_value(c, dtype), F.lit(REGISTERS)).alias(f"distinct{i}"))
        if isinstance(dtype, (T.StringType, T.BinaryType)):
            found.append(F.max(size_of(c, dtype)).alias(f"length{i}"))
        if _is_number(dtype):
            found.append(F.kll_sketch_agg_double(c.cast("double"), F.lit(KLL_K)).alias(f"ranks{i}"))
    return flat.agg(*found).withColumn("names", F.array(*[F.lit(n) for n in names]))


def store_facts(df: DataFrame, place: str, run: str, batch: int, columns: Sequence[str] | None = None) -> None:
    """Keep the facts of a batch; a repeated batch replaces its own."""
    batch_facts(df, columns).coalesce(1).write.mode("overwrite").parquet(batch_folder(place, run, batch))


def merged(facts: DataFrame) -> DataFrame:
    """The facts of several batches as one row, which is a batch's facts again."""
    out = [F.sum("n").alias("n"), F.first("names").alias("names")]
    for c in facts.columns:
        kind = c.rstrip("0123456789")
        if kind in ("nulls", "min", "max", "length"):
            out.append({"nulls": F.sum, "min": F.min}.get(kind, F.max)(c).alias(c))
        elif kind == "distinct" and c != kind:
            out.append(F.hll_union_agg(c, F.lit(True)).alias(c))
        elif kind == "ranks":
            out.append(F.kll_merge_agg_double(c).alias(c))
    return facts.agg(*out)


def stored_profile(spark: SparkSession, place: str, table: str) -> DataFrame:
    """One row per column of the table whose batches' facts lie in a folder: NAMES.

    Reads the facts only, one row per batch. min_value and max_value are those of the column's own type, as text; q1, median
    and q3 are NULL for columns that hold no numbers.
    """
    facts = merged(spark.read.parquet(place))
    names = spark.read.parquet(place).select("names").first()["names"]
    rows = []
    for i, name in enumerate(names):
        binary = isinstance(facts.schema[f"min{i}"].dataType, T.BinaryType)
        low, high = (f"hex({end}{i})" if binary else f"string({end}{i})" for end in ("min", "max"))
        length = f"CAST(length{i} AS INT)" if f"length{i}" in facts.columns else "CAST(NULL AS INT)"
        quartiles = [f"CASE WHEN n > nulls{i} THEN kll_sketch_get_quantile_double(ranks{i}, {p}D) END" for p in (0.25, 0.5, 0.75)]
        if f"ranks{i}" not in facts.columns:
            quartiles = ["CAST(NULL AS DOUBLE)"] * 3
        rows.append((
            literal(table), literal(name), "n", f"nulls{i} / greatest(n, 1)",
            f"CASE WHEN n > nulls{i} THEN hll_sketch_estimate(distinct{i}) ELSE 0L END", low, high, length, *quartiles,
        ))
    return stacked(facts, NAMES, rows)
