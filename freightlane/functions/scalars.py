"""Scalar expressions shared by the views, the conform step and the checks."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from freightlane.functions.types import is_fractional, is_integral, is_nested

# The text forms that Spark reads as a whole number (of 64 bits, so of 19 digits at most), a number and a boolean.
_BLANK = r"[\s\p{Cntrl}]*"
WHOLE_TEXT = rf"^{_BLANK}[+-]?0*\d{{1,19}}{_BLANK}$"
NUMBER_TEXT = rf"(?i)^{_BLANK}[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?[df]?|inf|infinity|nan){_BLANK}$"
BOOLEAN_TEXT = rf"(?i)^{_BLANK}(t|true|y|yes|1|f|false|n|no|0){_BLANK}$"
INTEGER_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def quoted(name: str) -> str:
    """A column name as an SQL identifier, so that dots and spaces in names are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str | None) -> str:
    """A text as an SQL literal."""
    if text is None:
        return "CAST(NULL AS STRING)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stacked(df: DataFrame, names: Sequence[str], rows: Sequence[Sequence[str]]) -> DataFrame:
    """Each row of `df` as several rows, given as SQL expressions. One expression for all of them keeps the
    driver's work small for wide tables."""
    values = ", ".join(expression for row in rows for expression in row)
    return df.selectExpr(f"stack({len(rows)}, {values}) AS ({', '.join(names)})")


def as_text(c: Column) -> Column:
    return c.cast("string")


def blank_to_null(c: Column) -> Column:
    """The text of a value, with the empty text read as missing."""
    return F.nullif(as_text(c), F.lit(""))


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("long"))


def joined_text(*parts: Column) -> Column:
    """Concatenation in which a NULL part counts as empty instead of making the whole NULL."""
    return F.concat_ws("", *[as_text(p) for p in parts])


def ignoring_case(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame with some text columns compared, grouped and joined without regard to case."""
    return df.withColumns({c: F.col(quoted(c)).cast("string collate UTF8_LCASE") for c in columns})


def to_second(c: Column) -> Column:
    """A time without zone cut to the second, as text: date_trunc would pass through the session's zone, where
    two times around a clock change can meet."""
    return F.substring(as_text(c), 1, 19)


def json_text(c: Column) -> Column:
    """A nested value as JSON text. Null fields are kept; an empty object counts as missing."""
    return F.nullif(F.to_json(c, {"ignoreNullFields": "false"}), F.lit("{}"))


def _plausible(c: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """False for values that cannot be cast, as a cheap test; None where no test is needed."""
    if isinstance(have, T.StringType):
        if is_integral(want):
            bits = INTEGER_BITS[want.simpleString()]
            if bits == 64:
                return c.rlike(WHOLE_TEXT)
            # Not "rlike and between": Spark takes a cast that stands twice out of an AND and tries it on every value.
            return safe_cast(c, have, T.LongType()).between(-(1 << (bits - 1)), (1 << (bits - 1)) - 1)
        if is_fractional(want):
            return c.rlike(NUMBER_TEXT)
        return c.rlike(BOOLEAN_TEXT) if isinstance(want, T.BooleanType) else None
    if not (is_integral(have) or is_fractional(have)):
        return None
    if is_integral(want):
        bits = INTEGER_BITS[want.simpleString()]
        if is_integral(have) and INTEGER_BITS[have.simpleString()] <= bits:
            return None
        bound = 1 << (bits - 1)
        if is_integral(have):
            return c.between(-bound, bound - 1)
        # The cast drops the fraction, so anything above -bound - 1 still fits; 64 bits are exact as doubles.
        if isinstance(have, T.DecimalType):
            return (c > F.lit(Decimal(-bound - 1))) & (c < F.lit(Decimal(bound)))
        low = c >= float(-bound) if bits == 64 else c > float(-bound - 1)
        return low & (c < float(bound))
    if isinstance(want, T.DecimalType):
        digits = want.precision - want.scale
        bound = F.lit(float(10**digits)) if isinstance(have, (T.FloatType, T.DoubleType)) else F.lit(Decimal(10**digits))
        return (c > -bound) & (c < bound) if digits < 38 else None
    return None


def safe_cast(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """try_cast that tests values first: a failing try_cast raises and catches an error for each value, which
    is some thirty times slower than the test."""
    if have == want:
        return c
    plausible = _plausible(c, have, want)
    cast = c.try_cast(want)
    return cast if plausible is None else F.when(plausible, cast)


def converted(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """`c` in the wanted type; a value that cannot be represented becomes NULL, never an error."""
    if is_nested(have):
        c, have = json_text(c), T.StringType()
    return safe_cast(c, have, want)


def loses_fraction(c: Column, cast: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """True where a cast to an integer type dropped a fraction; None where that cannot happen."""
    if is_fractional(have) and is_integral(want):
        return c != cast.cast(have)
    return None


def loses_scale(c: Column, cast: Column, have: T.DataType, want: T.DataType) -> Column | None:
    """True where a cast to a decimal type rounded decimal places away; None where that cannot happen."""
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType) and have.scale > want.scale:
        return c != cast
    return None


def guarded(df: DataFrame, expression: str) -> tuple[Column, Column]:
    """The value of an SQL expression, NULL where its evaluation fails, and whether it failed.

    try_to_binary() gives NULL for any error below it. So the value goes through it as text, behind a letter that tells
    a NULL value from a failure, and comes back in the expression's own type.
    """
    dtype = df.select(F.expr(expression).alias("value")).schema[0].dataType
    if isinstance(dtype, T.NullType):
        return F.expr(expression), F.lit(False)
    nested = is_nested(dtype)
    text = f"to_json({expression}, map('ignoreNullFields', 'false'))" if nested else f"CAST(({expression}) AS STRING)"
    tried = F.expr(f"CAST(try_to_binary(coalesce(concat('v', {text}), 'n'), 'utf-8') AS STRING)")
    value = F.when(tried != "n", F.substring(tried, 2, 2**31 - 1))
    return (F.from_json(value, dtype.simpleString()) if nested else value.cast(dtype)), tried.isNull()


def size_of(c: Column, dtype: T.DataType) -> Column:
    """Length in characters, or in bytes for binary values."""
    return F.octet_length(c) if isinstance(dtype, T.BinaryType) else F.char_length(c)
