"""Comparison rules for a source value and a target value, both given as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from freightlane.functions.scalars import to_second

# Fixed value: how far from zero a target may be when the source is exactly zero.
ZERO_TOLERANCE = 1e-9


def values_match(source: Column, target: Column, kind: Column, tolerance: float) -> Column:
    """Equal up to the second for kind 'temporal', up to a relative tolerance for numbers, else exact.

    `kind` is 'temporal', 'numeric' or 'exact'. Two NULLs match; one NULL does not. Text that is not
    a number (or time) on both sides is compared as it stands.
    """
    s, t = source.try_cast("double"), target.try_cast("double")
    s_ts, t_ts = source.try_cast("timestamp_ntz"), target.try_cast("timestamp_ntz")
    return (
        F.when(source.isNull() & target.isNull(), F.lit(True))
        .when(source.isNull() | target.isNull(), F.lit(False))
        .when((kind == "temporal") & s_ts.isNotNull() & t_ts.isNotNull(), to_second(s_ts) == to_second(t_ts))
        .when((kind != "numeric") | s.isNull() | t.isNull(), source == target)
        .when(s == 0, F.abs(t) < ZERO_TOLERANCE)
        .otherwise(F.abs(s - t) / F.abs(F.nullif(s, F.lit(0.0))) <= tolerance)
    )


def counts_match(source: Column, target: Column, tolerance: float, strict: bool) -> Column:
    """Row counts equal within a share of the source count.

    An empty source matches only an empty target when strict, and any target otherwise.
    """
    empty_source = (target == 0) if strict else F.lit(True)
    return F.when(source > 0, F.abs(source - target) <= source * F.lit(tolerance)).otherwise(empty_source)
