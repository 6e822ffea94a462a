"""Column profiles, exact distinct counts over many columns, and the cast-loss report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from freightlane.functions.scalars import INTEGER_BITS, literal, loses_fraction, quoted, safe_cast, size_of, stacked
from freightlane.functions.types import is_fractional, is_integral, is_nested, is_temporal
from freightlane.operators.conform import becomes_json, staged_values
from freightlane.plans.contract import Contract

# Text longer than this many bytes is shuffled as a SHA-256 digest when only its identity matters. The digest
# itself takes 71 bytes.
DIGEST_ABOVE = 64


def flat_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the given columns, nested ones as JSON text."""
    types = {f.name: f.dataType for f in df.schema}
    return df.select(*[
        (F.to_json(F.col(quoted(c)), {"ignoreNullFields": "false"}) if is_nested(types[c]) else F.col(quoted(c))).alias(c)
        for c in columns
    ])


def _lane(c: Column, dtype: T.DataType) -> tuple[str, Column]:
    """(type, value) under which equal values are equal. Long text becomes a digest, which no short text can
    equal because it is longer than all of them."""
    if is_integral(dtype) or isinstance(dtype, T.BooleanType):
        return "bigint", c.cast("bigint")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "double", c.cast("double")
    if isinstance(dtype, T.BinaryType):
        return "string", F.sha2(c, 256)
    if isinstance(dtype, T.StringType) and dtype.collation == "UTF8_BINARY":
        return "string", F.when(F.octet_length(c) > DIGEST_ABOVE, F.concat(F.lit("sha256:"), F.sha2(c, 256))).otherwise(c)
    return dtype.simpleString(), c


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, distinct_count) of each column, exact, NULLs not counted; one scan, one wide shuffle.

    Rows are unpivoted to (column, value) with the value in a lane of its own type, so repeats collapse in
    the map tasks and one frequent value is one row per task. Columns without a value give no row.
    """
    flat = flat_columns(df, columns)
    split = [_lane(F.col(quoted(f.name)), f.dataType) for f in flat.schema]
    lanes = {lane: value for lane, value in split}
    position = {lane: n for n, lane in enumerate(lanes)}
    wide = flat.select(
        *[value.alias(f"v{i}") for i, (_, value) in enumerate(split)],
        *[F.when(F.lit(False), value).alias(f"none_{position[lane]}") for lane, value in lanes.items()],
    )
    sets = ", ".join(
        "(" + ", ".join(f"v{i}" if lane == own else f"none_{n}" for lane, n in position.items()) + f") AS `{i}`"
        for i, (own, _) in enumerate(split)
    )
    names = [f"lane_{n}" for n in position.values()]
    query = f"SELECT * FROM {{wide}} UNPIVOT INCLUDE NULLS (({', '.join(names)}) FOR position IN ({sets}))"
    long = df.sparkSession.sql(query, wide=wide).select("position", *names)
    # A count beside the keys lets Spark use its faster hash table for them.
    values = (
        long.filter(reduce(or_, [F.col(n).isNotNull() for n in names]))
        .groupBy("position", *names)
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    labels = F.array(*[F.lit(c) for c in columns])
    return values.groupBy("position").agg(F.count("copies").alias("distinct_count")).select(
        F.get(labels, F.col("position").cast("int")).alias("column_name"), "distinct_count"
    )


def _as_int(c: Column, dtype: T.DataType) -> Column | None:
    """The value as a 32-bit integer, fractions rounded; None for types that have no such reading."""
    if isinstance(dtype, T.DecimalType):
        return safe_cast(F.round(c, 0), dtype, T.IntegerType())
    if is_fractional(dtype):
        return safe_cast(F.rint(c), T.DoubleType(), T.IntegerType())
    if is_integral(dtype) or isinstance(dtype, (T.BooleanType, T.StringType)):
        return safe_cast(c, dtype, T.IntegerType())
    return None


def profile(
    df: DataFrame,
    table: str,
    columns: Sequence[str] | None = None,
    approximate: bool = False,
    integers_first: bool = False,
    sample: float | None = None,
) -> DataFrame:
    """One row per column: null_rate, distinct_count, min_value, max_value, max_length.

    Minimum and maximum are taken in the column's own type and then written as text. With
    `integers_first`, a column whose every value reads as a 32-bit integer is ordered and written as
    integers. `approximate` replaces the exact distinct counts by sketches, which need no shuffle of
    values; `sample` profiles a share of the rows.
    """
    names = list(columns or df.columns)
    flat = flat_columns(df, names)
    if sample is not None:
        flat = flat.sample(sample, seed=0)
    # Minima of text need Spark's sort aggregate; apart from it, the other columns keep the compiled hash
    # aggregate. The two parts read different columns.
    text = [f for f in flat.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    other = [f for f in flat.schema if f not in text]
    result = reduce(
        DataFrame.unionByName, [_facts(flat, table, part, approximate, integers_first) for part in (other, text) if part]
    )
    if approximate:
        return result
    # Both sides have one row per column of the table, so the broadcast is bounded by its width.
    counts = distinct_counts(flat, names)
    return result.drop("distinct_count").join(F.broadcast(counts), "column_name", "left").select(
        "table_name",
        "column_name",
        "null_rate",
        F.coalesce("distinct_count", F.lit(0).cast("long")).alias("distinct_count"),
        "min_value",
        "max_value",
        "max_length",
    )


def profile_tables(tables: Mapping[str, DataFrame], **options: object) -> DataFrame:
    """The profiles of several tables as one frame; `options` go to profile()."""
    return reduce(DataFrame.unionByName, [profile(df, name, **options) for name, df in tables.items()])


def _facts(
    df: DataFrame, table: str, fields: Sequence[T.StructField], approximate: bool, integers_first: bool
) -> DataFrame:
    """The profile rows of some columns from one aggregate; distinct_count is NULL unless approximate."""
    aggregates = [F.count(F.lit(1)).alias("n")]
    rows = []
    for i, field in enumerate(fields):
        c, dtype = quoted(field.name), field.dataType
        low, high = (f"hex({end}{i})" if isinstance(dtype, T.BinaryType) else f"string({end}{i})" for end in ("min", "max"))
        length = counted = "NULL"
        aggregates += [F.expr(f"count_if({c} IS NULL)").alias(f"nulls{i}")]
        aggregates += [F.expr(f"{end}({c})").alias(f"{end}{i}") for end in ("min", "max")]
        if isinstance(dtype, (T.StringType, T.BinaryType)):
            aggregates.append(F.max(size_of(F.col(c), dtype)).alias(f"length{i}"))
            length = f"length{i}"
        if approximate:
            aggregates.append(F.expr(f"approx_count_distinct({c})").alias(f"distinct{i}"))
            counted = f"distinct{i}"
        whole = _as_int(F.col(c), dtype) if integers_first else None
        if whole is not None:
            aggregates += [
                F.count_if(F.col(c).isNotNull() & whole.isNull()).alias(f"nonint{i}"),
                F.min(whole).alias(f"imin{i}"),
                F.max(whole).alias(f"imax{i}"),
            ]
            low, high = (f"if(nonint{i} = 0, string(i{end}{i}), {native})" for end, native in (("min", low), ("max", high)))
        rows.append((
            literal(table), literal(field.name), f"nulls{i} / greatest(n, 1)", f"CAST({counted} AS BIGINT)",
            low, high, f"CAST({length} AS INT)",
        ))
    names = ("table_name", "column_name", "null_rate", "distinct_count", "min_value", "max_value", "max_length")
    return stacked(df.agg(*aggregates), names, rows)


def _altered(value: Column, cast: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """True where a number or time survives the cast but comes back as another value; None where that cannot happen."""
    if have == want or (is_integral(have) and is_integral(want)):
        return None
    numeric = (is_integral(have) or is_fractional(have)) and (is_integral(want) or is_fractional(want))
    return value != safe_cast(cast, want, have) if numeric or (is_temporal(have) and is_temporal(want)) else None


def _uncastable(value: Column, cast: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """True where a value has no form in the wanted type; None where that cannot happen."""
    wider = is_integral(have) and is_integral(want) and INTEGER_BITS[have.simpleString()] <= INTEGER_BITS[want.simpleString()]
    return None if have == want or wider or becomes_json(have, want) else value.isNotNull() & cast.isNull()


def cast_loss(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per contract column: how many values do not survive its type. One scan, no shuffle of rows.

    What cannot happen between two types is not counted.
    """
    staged = staged_values(df, contract)
    aggregates, rows = [], []
    for i, spec in enumerate(contract.columns):
        value, cast = F.col(f"v{i}"), F.col(f"c{i}")
        have, want = staged.schema[f"v{i}"].dataType, staged.schema[f"c{i}"].dataType
        fraction = loses_fraction(value, cast, have, want)
        counted = {
            "uncastable": _uncastable(value, cast, have, want),
            "fraction_lost": fraction,
            "altered": None if fraction is not None else _altered(value, cast, have, want),
            "too_long": size_of(cast, want) > spec.length if spec.length else None,
        }
        found = {name: f"{name}{i}" if condition is not None else "0L" for name, condition in counted.items()}
        if fraction is not None:  # a lost fraction is another value
            found["altered"] = found["fraction_lost"]
        aggregates.append(F.count(value).alias(f"non_null{i}"))
        aggregates += [F.count(F.when(c, 1)).alias(found[name]) for name, c in counted.items() if c is not None]
        rows.append((literal(contract.name), literal(spec.target), literal(spec.base), f"non_null{i}", *found.values()))
    names = ("table_name", "column_name", "canonical_type", "non_null", "uncastable", "fraction_lost", "altered", "too_long")
    return stacked(staged.agg(*aggregates), names, rows)
