"""An inner join whose fan-out is part of the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from freightlane.functions.scalars import as_text, quoted
from freightlane.functions.types import is_integral

# Longest array built to repeat one row; larger counts are reached by nesting two arrays.
REPEAT_BLOCK = 10_000


def comparable(left: T.DataType, right: T.DataType) -> bool:
    """Whether two key types give the same matches compared as they are as compared by their texts. Keys that keep
    their type can be filtered at the scan, and stored buckets of them can be used."""
    same = left == right and isinstance(left, (T.StringType, T.DateType))
    return same or (is_integral(left) and is_integral(right))


def key_of(c: Column, plain: bool) -> Column:
    return c if plain else as_text(c)


def repeat_rows(df: DataFrame, count: str) -> DataFrame:
    """Every row `count` times, without a shuffle and without one array of the full length."""
    n = F.col(quoted(count))
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / REPEAT_BLOCK))
    left_over = F.least(F.lit(REPEAT_BLOCK).cast("long"), n - F.col("_block") * REPEAT_BLOCK)
    return (
        df.withColumn("_block", F.explode(blocks))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), left_over)))
        .drop("_block", "_copy", count)
    )


#: A key with more than this share of the rows is hot; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.005
#: Values that the sketch of frequent keys follows at once.
TRACKED = 10_000


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list[object]:
    """The values of a key that more than a share of the rows have, by a sketch: one pass, map-side combined.

    The sketch may name a key that is a little less frequent, and misses none.
    """
    c = quoted(key)
    found = df.filter(F.col(c).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k({c}, {int(1 / share)}, {TRACKED})").alias("top")
    ).first()
    return [t["item"] for t in found["top"] or [] if t["count"] > share * found["n"]]


def salted(many: DataFrame, few: DataFrame, key: str, hot: Sequence[object], salts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on `key` with a column `_salt` to join on as well.

    Rows of `many` with a hot key are dealt over the salts by their contents; rows of `few` with one stand once per salt. All others
    have salt 0, so only the hot keys' rows of `few` are repeated.
    """
    is_hot = F.col(quoted(key)).isin(list(hot)) if hot else F.lit(False)
    dealt = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in many.columns]), F.lit(salts)).cast("int")
    each = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return many.withColumn("_salt", F.when(is_hot, dealt).otherwise(0)), few.withColumn("_salt", F.explode(each))


def fan_out_join(
    detail: DataFrame, events: DataFrame, detail_key: str, event_key: str, keep: Sequence[str], salts: int = 0
) -> DataFrame:
    """`detail` x `events` on the text of their keys: one row per pair, with the `keep` columns of detail
    and all columns of events. Keys of the same kind are compared as they are.

    Equal detail rows are counted before the join and repeated after it. So a detail table with many equal
    rows per key shuffles one row per distinct value, and the repeats are written where the match is found.
    A hot event key is left to Spark's skew join, which splits its partition, but not where an aggregate or a sort by
    the key follows. With `salts` the hot keys are found first, by a pass over the events, and dealt over so many parts.
    """
    plain = comparable(detail.schema[detail_key].dataType, events.schema[event_key].dataType)
    counted = (
        detail.select(key_of(F.col(quoted(detail_key)), plain).alias("_key"), *[quoted(c) for c in keep])
        .filter(F.col("_key").isNotNull())
        .groupBy("_key", *[quoted(c) for c in keep])
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    keyed = events.withColumn("_key", key_of(F.col(quoted(event_key)), plain))
    if not salts:
        return repeat_rows(keyed.join(counted, "_key"), "_times").drop("_key")
    keyed, counted = salted(keyed, counted, "_key", hot_keys(keyed, "_key"), salts)
    return repeat_rows(keyed.join(counted, ["_key", "_salt"]), "_times").drop("_key", "_salt")
