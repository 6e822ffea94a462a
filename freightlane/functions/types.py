"""Canonical column types and how they map to Spark types."""

from __future__ import annotations

import re

from pyspark.sql import types as T

DEFAULT_LENGTH = 255
DEFAULT_PRECISION = 38
DEFAULT_SCALE = 10

# Canonical type name -> Spark type. DECIMAL is parameterised and handled in spark_type().
# INT1 is unsigned 0-255 at its source, so it needs a ShortType.
CANONICAL_TYPES: dict[str, T.DataType] = {
    "INT8": T.LongType(),
    "INT4": T.IntegerType(),
    "INT2": T.ShortType(),
    "INT1": T.ShortType(),
    "DECIMAL": T.DecimalType(DEFAULT_PRECISION, DEFAULT_SCALE),
    "FLOAT8": T.DoubleType(),
    "FLOAT4": T.FloatType(),
    "TEXT": T.StringType(),
    "NTEXT": T.StringType(),
    "CHAR": T.StringType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "DATETIMETZ": T.TimestampType(),
    "BOOL": T.BooleanType(),
    "BYTES": T.BinaryType(),
    "VARBYTES": T.BinaryType(),
    "CLOB": T.StringType(),
    "BLOB": T.BinaryType(),
    "JSON": T.StringType(),
    "XML": T.StringType(),
}

# Which canonical types carry a maximum length, and which take part in which checks.
SIZED_TYPES = frozenset({"TEXT", "NTEXT", "CHAR", "BYTES", "VARBYTES"})
INTEGER_TYPES = frozenset({"INT1", "INT2", "INT4", "INT8"})
NUMERIC_TYPES = INTEGER_TYPES | {"DECIMAL", "FLOAT4", "FLOAT8"}
TEMPORAL_TYPES = frozenset({"DATE", "DATETIME", "DATETIMETZ"})

# Native type name of the source system -> canonical type.
SOURCE_TYPES: dict[str, dict[str, str]] = {
    "sqlserver": {
        "bigint": "INT8",
        "int": "INT4",
        "smallint": "INT2",
        "tinyint": "INT1",
        "decimal": "DECIMAL",
        "numeric": "DECIMAL",
        "money": "DECIMAL",
        "smallmoney": "DECIMAL",
        "float": "FLOAT8",
        "real": "FLOAT4",
        "varchar": "TEXT",
        "nvarchar": "NTEXT",
        "char": "CHAR",
        "nchar": "CHAR",
        "text": "CLOB",
        "ntext": "CLOB",
        "date": "DATE",
        "datetime": "DATETIME",
        "datetime2": "DATETIME",
        "smalldatetime": "DATETIME",
        "datetimeoffset": "DATETIMETZ",
        "time": "DATETIME",
        "bit": "BOOL",
        "binary": "BYTES",
        "varbinary": "VARBYTES",
        "image": "BLOB",
        "xml": "XML",
        "uniqueidentifier": "TEXT",
    },
    "postgres": {
        "bigint": "INT8",
        "integer": "INT4",
        "smallint": "INT2",
        "serial": "INT4",
        "bigserial": "INT8",
        "numeric": "DECIMAL",
        "double precision": "FLOAT8",
        "real": "FLOAT4",
        "character varying": "TEXT",
        "varchar": "TEXT",
        "character": "CHAR",
        "char": "CHAR",
        "text": "CLOB",
        "date": "DATE",
        "timestamp without time zone": "DATETIME",
        "timestamp with time zone": "DATETIMETZ",
        "boolean": "BOOL",
        "bytea": "BLOB",
        "json": "JSON",
        "jsonb": "JSON",
        "xml": "XML",
        "uuid": "TEXT",
        "inet": "TEXT",
        "cidr": "TEXT",
        "macaddr": "TEXT",
        "interval": "TEXT",
        "money": "DECIMAL",
    },
}

# Source types whose precision and scale are implied by the name.
IMPLIED_PRECISION = {("sqlserver", "money"): (19, 4), ("sqlserver", "smallmoney"): (10, 4)}


class UnknownCanonicalType(KeyError, ValueError):
    """Raised for a canonical type name outside CANONICAL_TYPES."""


def split_type(text: str) -> tuple[str, list[int]]:
    """'DECIMAL(18,2)' -> ('DECIMAL', [18, 2]); a name without parameters gives an empty list."""
    name, _, rest = text.partition("(")
    return name.strip().upper(), [int(n) for n in re.findall(r"\d+", rest)]


def spark_type(
    canonical: str, precision: int | None = None, scale: int | None = None
) -> T.DataType:
    """Spark type of a canonical type; explicit precision and scale win over 'DECIMAL(p,s)'."""
    name, params = split_type(canonical)
    if name not in CANONICAL_TYPES:
        raise UnknownCanonicalType(canonical)
    if name != "DECIMAL":
        return CANONICAL_TYPES[name]
    if precision is None and params:
        precision, scale = params[0], (params[1] if len(params) > 1 else 0)
    if precision is None:
        return CANONICAL_TYPES[name]
    return T.DecimalType(precision, scale or 0)


def canonical_of(engine: str, native_type: str) -> tuple[str, int | None, int | None]:
    """(canonical type, precision, scale) of a source system's type name; unknown names become TEXT."""
    native = native_type.strip().lower()
    precision, scale = IMPLIED_PRECISION.get((engine, native), (None, None))
    return SOURCE_TYPES[engine].get(native, "TEXT"), precision, scale


def is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def is_fractional(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType))


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.MapType, T.ArrayType, T.VariantType))


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))
