"""Several distinct counts per group from counted values, without repeating rows once per count.

Every counted column is a lane. A row becomes one narrow (group, lane, value) per lane that has a value, which are counted and so
collapse in the map tasks; a hot group is spread over tasks by its values. The counts are additive: those of a batch, or minus
those of deleted rows, can be added to those of a table, and distinct counts are read off without the table. Counts that are
combined already are moved once for both, to their groups (`gathered`); only a hot group is dealt over salts by its values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from freightlane.functions.scalars import quoted
from freightlane.functions.types import is_integral
from freightlane.operators.joins import HOT_SHARE, hot_keys

#: The lane that counts the rows of a group, whatever they hold.
PRESENCE = -1
LANE, WHOLE, TEXT, COUNT = "lane", "whole", "text", "n"
#: Over how many parts the values of a hot group are dealt: a group that has all rows is in no part larger than a group that is not hot.
SALT, SALTS = "_salt", int(1 / HOT_SHARE)


def _value(c: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """(whole, text): equal values have equal pairs, and NULL none. Whole numbers stay numbers."""
    nothing = {"whole": F.lit(None).cast("long"), "text": F.lit(None).cast("string")}
    if is_integral(dtype) or isinstance(dtype, T.BooleanType):
        return c.cast("long"), nothing["text"]
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return nothing["whole"], (c.cast("double") + F.lit(0.0)).cast("string")
    if isinstance(dtype, T.BinaryType):
        return nothing["whole"], F.hex(c)
    return nothing["whole"], c.cast("string")


def lane_rows(rows: DataFrame, group: Sequence[str], counted: Mapping[str, Column], weight: Column | None = None) -> DataFrame:
    """The group's columns, lane (the place in `counted`, or PRESENCE), whole, text, n: one row per value that stands in a row.

    `weight` is what a row counts, by default 1; -1 takes a deleted row away again.
    """
    values = rows.select(*[quoted(g) for g in group], (F.lit(1) if weight is None else weight).cast("long").alias("_w"), *[
        c.alias(f"_c{i}") for i, c in enumerate(counted.values())
    ])
    pairs = [_value(F.col(f"_c{i}"), values.schema[f"_c{i}"].dataType) for i in range(len(counted))]
    lanes = [F.struct(F.lit(PRESENCE).alias(LANE), F.lit(None).cast("long").alias(WHOLE), F.lit(None).cast("string").alias(TEXT))]
    lanes += [
        F.when(F.col(f"_c{i}").isNotNull(), F.struct(F.lit(i).alias(LANE), whole.alias(WHOLE), text.alias(TEXT)))
        for i, (whole, text) in enumerate(pairs)
    ]
    each = values.select(*[quoted(g) for g in group], "_w", F.explode(F.array(*lanes)).alias("_v")).filter(F.col("_v").isNotNull())
    return each.select(*[quoted(g) for g in group], f"_v.{LANE}", f"_v.{WHOLE}", f"_v.{TEXT}", F.col("_w").alias(COUNT))


def lane_counts(rows: DataFrame, group: Sequence[str], counted: Mapping[str, Column], weight: Column | None = None) -> DataFrame:
    """The rows of lane_rows() added up: how often each value stands in each group."""
    return added(lane_rows(rows, group, counted, weight), group)


def added(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per group, lane and value, with the counts added up; what comes to nothing is left out."""
    summed = counts.groupBy(*[quoted(g) for g in group], LANE, WHOLE, TEXT).agg(F.sum(COUNT).alias(COUNT))
    return summed.filter((F.col(COUNT) != 0) | (F.col(LANE) == PRESENCE))


def gathered(counts: DataFrame, group: Sequence[str], by: Sequence[str] | None = None) -> DataFrame:
    """`added` for distinct_from(), of counts that few rows share a value of, such as those of batches.

    They are moved once, to the partition of their group, where the distinct counts are taken too. `by` are the columns of
    the group to place it by, so that a join on them follows without a shuffle. Groups with more than HOT_SHARE of the rows, told by
    a sketch in a pass over the columns `by`, are dealt over SALTS parts by their values, and their parts' counts added up.
    Text with a collation is equal without having equal hashes, so such groups are only added up.
    """
    by = list(by or group)
    types = [counts.schema[c].dataType for c in by]
    if any(isinstance(t, T.StringType) and t.collation != "UTF8_BINARY" for t in types):
        return added(counts, group)
    mark = F.xxhash64(*[quoted(c) for c in by])
    hot = hot_keys(counts.select(mark.alias("_group")), "_group")
    places = [F.col(quoted(c)) for c in by]
    if not hot:
        return added(counts.repartition(*places), group)
    salt = F.when(mark.isin(hot), F.pmod(F.xxhash64(LANE, WHOLE, TEXT), F.lit(SALTS)).cast("int")).otherwise(0)
    return added(counts.withColumn(SALT, salt).repartition(*places, F.col(SALT)), [*group, SALT])


def distinct_from(counts: DataFrame, group: Sequence[str], names: Sequence[str], rows: str | None = None) -> DataFrame:
    """The group's columns and one distinct count per lane, for groups that have rows; `rows` names a column for their sum.

    Groups are hashed once more, with one row per task and group, unless the counts are `gathered` and no group is hot.
    """
    keys = [quoted(g) for g in group]
    here = F.sum(F.when(F.col(LANE) == PRESENCE, F.col(COUNT)))
    numbers = [F.count_if((F.col(LANE) == i) & (F.col(COUNT) > 0)).alias(n) for i, n in enumerate(names)]
    salted = [SALT] if SALT in counts.columns else []
    out = counts.groupBy(*keys, *salted).agg(*numbers, here.alias("_rows"))
    if salted:
        out = out.groupBy(*keys).agg(*[F.sum(quoted(n)).alias(n) for n in (*names, "_rows")])
    if rows:
        return out.withColumnRenamed("_rows", rows)
    return out.filter(F.col("_rows") > 0).drop("_rows")
