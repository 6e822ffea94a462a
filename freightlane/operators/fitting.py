"""The narrowest type of the contract's types that loses no value of a column.

Every column has a ladder of types, the narrowest first. All rungs of all columns are tried in one aggregate, by the rules
of the cast-loss report, so each answer comes with its proof: nothing is lost on the rung it names, something on the one
below. Numbers in text must also come back as the same text, so '007' stays text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from freightlane.functions.scalars import quoted, safe_cast, size_of
from freightlane.functions.types import is_integral, spark_type
from freightlane.operators.profile import cast_loss
from freightlane.plans.contract import ColumnSpec, Contract

_WHOLE = ("INT2", "INT4", "INT8")
SCHEMA = (
    "table_name string, column_name string, stored_type string, fitted_type string, lost long, narrower_type string, narrower_lost long"
)


def ladder(dtype: T.DataType) -> tuple[str, ...]:
    """The types that a column may have, the narrowest first; the last one holds every value."""
    if isinstance(dtype, T.BooleanType):
        return ("BOOL",)
    if is_integral(dtype):
        return _WHOLE
    if isinstance(dtype, T.DecimalType):
        return (*_WHOLE, f"DECIMAL({dtype.precision},{dtype.scale})")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (*_WHOLE, "FLOAT4", "FLOAT8")
    if isinstance(dtype, T.StringType):
        return (*_WHOLE, "TEXT")
    if isinstance(dtype, T.TimestampNTZType):
        return ("DATE", "DATETIME")
    if isinstance(dtype, T.TimestampType):
        return ("DATE", "DATETIMETZ")
    return ("DATE",) if isinstance(dtype, T.DateType) else ("VARBYTES",) if isinstance(dtype, T.BinaryType) else ("JSON",)


def _spec(target: str, kind: str, source: str) -> ColumnSpec:
    base, _, sizes = kind.partition("(")
    precision, scale = map(int, sizes.rstrip(")").split(",")) if sizes else (None, None)
    return ColumnSpec(target, base, source, precision=precision, scale=scale)


def fitted_types(df: DataFrame, table: str) -> DataFrame:
    """One row per column: the type as it is stored, the fitted one, what is lost there (nothing), the next narrower and its losses.

    Two narrow aggregates over the table, whatever the number of types; one row per column and rung comes to the driver.
    """
    rungs = [(i, j, f.name, kind) for i, f in enumerate(df.schema) for j, kind in enumerate(ladder(f.dataType))]
    contract = Contract(table, table, tuple(_spec(f"{i}_{j}", kind, name) for i, j, name, kind in rungs))
    # A lost fraction is an altered value too.
    lost = {
        r["column_name"]: r["uncastable"] + r["too_long"] + max(r["fraction_lost"], r["altered"])
        for r in cast_loss(df, contract).collect()
    }
    found = {}
    for i, f in enumerate(df.schema):
        c = F.col(quoted(f.name))
        if isinstance(f.dataType, T.StringType):
            found |= {f"{i}_{j}": F.count_if(safe_cast(c, f.dataType, spark_type(k)).cast("string") != c) for j, k in enumerate(_WHOLE)}
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            found[f"size_{i}"] = F.max(size_of(c, f.dataType))
    more = df.agg(*[v.alias(k) for k, v in found.items()]).first().asDict() if found else {}
    rows = []
    for i, f in enumerate(df.schema):
        kinds = ladder(f.dataType)
        losses = [lost[f"{i}_{j}"] + (more.get(f"{i}_{j}") or 0) for j in range(len(kinds))]
        at = next((j for j, n in enumerate(losses) if n == 0), len(kinds) - 1)
        size = more.get(f"size_{i}")
        sized = f"({max(size, 1)})" if size is not None and kinds[at] in ("TEXT", "VARBYTES") else ""
        below = (kinds[at - 1], losses[at - 1]) if at else (None, None)
        rows.append((table, f.name, f.dataType.simpleString(), kinds[at] + sized, losses[at], *below))
    return df.sparkSession.createDataFrame(rows, SCHEMA)


def fit_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The fitted types of several tables as one frame."""
    out = None
    for name, df in tables.items():
        part = fitted_types(df, name)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no tables are given")
    return out
