"""Conform a source frame to a contract, and separate the rows that break it."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from freightlane.functions.scalars import converted, guarded, loses_fraction, loses_scale, quoted, size_of
from freightlane.functions.types import is_nested
from freightlane.plans.contract import ColumnSpec, Contract

REASONS = "reject_reasons"


def wanted_type(spec: ColumnSpec, decimal_as_double: bool) -> T.DataType:
    if decimal_as_double and spec.base == "DECIMAL":
        return T.DoubleType()
    return spec.dtype


def becomes_json(have: T.DataType, want: T.DataType) -> bool:
    """Nested values kept as JSON text, where an empty object may turn into NULL."""
    return is_nested(have) and isinstance(want, T.StringType)


def _received(df: DataFrame, contract: Contract) -> DataFrame:
    """The value each contract column starts from, as v0, v1, ...; an absent source column is NULL."""
    present = {name.lower() for name in df.columns}

    def value(spec: ColumnSpec) -> Column:
        if spec.transform:
            return guarded(df, spec.transform)[0]
        if spec.source_name.lower() in present:
            return F.col(quoted(spec.source_name))
        return F.lit(None).cast(spec.dtype)

    failed = [
        guarded(df, spec.transform)[1].alias(f"f{i}") for i, spec in enumerate(contract.columns) if spec.transform
    ]
    return df.select(*[value(spec).alias(f"v{i}") for i, spec in enumerate(contract.columns)], *failed)


def staged_values(df: DataFrame, contract: Contract, decimal_as_double: bool = False) -> DataFrame:
    """Received values v0, v1, ... beside their converted forms c0, c1, ..."""
    received = _received(df, contract)
    return received.select(
        "*",
        *[
            converted(F.col(f"v{i}"), received.schema[i].dataType, wanted_type(spec, decimal_as_double)).alias(f"c{i}")
            for i, spec in enumerate(contract.columns)
        ],
    )


def _conformed(staged: DataFrame, contract: Contract) -> DataFrame:
    return staged.select(
        *[F.col(f"c{i}").alias(s.target, metadata=s.field.metadata) for i, s in enumerate(contract.columns)]
    )


def _breaches(staged: DataFrame, contract: Contract) -> list[tuple[str, Column]]:
    """(reason, condition) of every rule of the contract. Conditions are never NULL."""
    rules: list[tuple[str, Column]] = []
    for i, spec in enumerate(contract.columns):
        value, cast = F.col(f"v{i}"), F.col(f"c{i}")
        have, want = staged.schema[f"v{i}"].dataType, staged.schema[f"c{i}"].dataType
        if spec.transform:
            rules.append((f"{spec.target}:transform_failed", F.col(f"f{i}")))
        if spec.required:
            empty = value.isNull() | cast.isNull() if becomes_json(have, want) else value.isNull()
            rules.append((f"{spec.target}:null", empty))
        if have != want and not becomes_json(have, want):
            rules.append((f"{spec.target}:uncastable", value.isNotNull() & cast.isNull()))
        fraction = loses_fraction(value, cast, have, want)
        if fraction is not None:
            rules.append((f"{spec.target}:fraction_lost", F.coalesce(fraction, F.lit(False))))
        scale = loses_scale(value, cast, have, want)
        if scale is not None:
            rules.append((f"{spec.target}:scale_lost", F.coalesce(scale, F.lit(False))))
        if spec.length:
            too_long = size_of(cast, want) > spec.length
            rules.append((f"{spec.target}:too_long", F.coalesce(too_long, F.lit(False))))
    return rules


def breaks_contract(staged: DataFrame, contract: Contract) -> Column:
    return reduce(or_, [condition for _, condition in _breaches(staged, contract)], F.lit(False))


def _as_received(c: Column, dtype: T.DataType) -> Column:
    if is_nested(dtype):
        return F.to_json(c, {"ignoreNullFields": "false"})
    if isinstance(dtype, T.BinaryType):
        return F.base64(c)
    return c.cast("string")


def conform(df: DataFrame, contract: Contract, decimal_as_double: bool = False) -> DataFrame:
    """Rename, null-fill, transform, cast, JSON-encode and order columns; keeps every row.

    A value that does not fit its type becomes NULL here; use split() to set such rows aside.
    """
    return _conformed(staged_values(df, contract, decimal_as_double), contract)


def split(df: DataFrame, contract: Contract, decimal_as_double: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows conformed to the contract, rejected rows as text with reject_reasons).

    Every input row lands in exactly one of the two. Both are narrow projections of the same scan: no
    shuffle, nothing cached. The reasons are joined by ';'.
    """
    staged = staged_values(df, contract, decimal_as_double)
    rules, bad = _breaches(staged, contract), breaks_contract(staged, contract)
    rejects = staged.filter(bad).select(
        F.concat_ws(";", *[F.when(condition, F.lit(reason)) for reason, condition in rules]).alias(REASONS),
        *[_as_received(F.col(f"v{i}"), staged.schema[f"v{i}"].dataType).alias(s.target) for i, s in enumerate(contract.columns)],
    )
    return _conformed(staged.filter(~bad), contract), rejects


def reject_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """One row: rows_read and rows_rejected. Reads only the columns the rules need."""
    staged = staged_values(df, contract)
    return staged.select(breaks_contract(staged, contract).alias("bad")).agg(
        F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col("bad")).alias("rows_rejected")
    )
