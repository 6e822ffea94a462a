import pytest
from pyspark.sql import types as T

from freightlane.functions.types import (
    CANONICAL_TYPES,
    SOURCE_TYPES,
    UnknownCanonicalType,
    canonical_of,
    spark_type,
    split_type,
)

ALL = (
    "INT8 INT4 INT2 INT1 DECIMAL FLOAT8 FLOAT4 TEXT NTEXT CHAR DATE DATETIME DATETIMETZ BOOL BYTES VARBYTES CLOB BLOB JSON XML"
).split()


@pytest.mark.parametrize("name", ALL)
def test_every_canonical_type_has_a_spark_type(name):
    assert isinstance(spark_type(name), T.DataType)


def test_no_other_canonical_types():
    assert sorted(CANONICAL_TYPES) == sorted(ALL)


@pytest.mark.parametrize("engine, native", [(e, n) for e, names in SOURCE_TYPES.items() for n in names])
def test_source_types_lead_to_canonical_types(engine, native):
    assert canonical_of(engine, native.upper())[0] in CANONICAL_TYPES


def test_number_of_source_types():
    assert {e: len(names) for e, names in SOURCE_TYPES.items()} == {"sqlserver": 28, "postgres": 27}


def test_unknown_source_type_is_text():
    assert canonical_of("postgres", "my_enum") == ("TEXT", None, None)


def test_money_has_its_precision():
    assert canonical_of("sqlserver", "money") == ("DECIMAL", 19, 4)
    assert canonical_of("sqlserver", "smallmoney") == ("DECIMAL", 10, 4)


def test_decimal_parameters():
    assert spark_type("DECIMAL") == T.DecimalType(38, 10)
    assert spark_type("DECIMAL", 18, 4) == T.DecimalType(18, 4)
    assert spark_type("decimal(12,3)") == T.DecimalType(12, 3)
    assert spark_type("DECIMAL", 9) == T.DecimalType(9, 0)


def test_split_type():
    assert split_type("VARCHAR(36)") == ("VARCHAR", [36])
    assert split_type("LONGTEXT") == ("LONGTEXT", [])


@pytest.mark.parametrize("error", [KeyError, ValueError, UnknownCanonicalType])
def test_unknown_canonical_type_raises(error):
    with pytest.raises(error):
        spark_type("NONEXISTENT")


def test_unsigned_tinyint_fits(spark):
    df = spark.sql("select 255 as v")
    assert df.select(df.v.cast(spark_type("INT1")).alias("v")).first().v == 255
