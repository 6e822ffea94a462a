"""What several operators share: word patterns, row packing, tables written between steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlane.session import remove_folder, work_folder

#: Words between white space, and what stands between words of letters, digits and characters beyond ASCII.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
BETWEEN_TOKENS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Small tables are broadcast up to so many rows of at most some hundred bytes; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000


def text_of(name: str = "text") -> Column:
    """The text column, NULL as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def words_of(text: Column) -> Column:
    """The words between white space, in order."""
    return F.array_remove(F.split(text, SPACES), "")


def tokens_of(text: Column) -> Column:
    """Lower-cased words of letters and digits, in order.

    lower() also changes letters beyond ASCII, which keeps where words begin and end, but for the dotted capital I and
    the Kelvin sign: it makes ASCII letters of them. Texts that hold one have only A-Z lowered.
    """
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    odd = text.contains("İ") | text.contains("K")
    lowered = F.when(odd, F.translate(text, capitals, capitals.lower())).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, BETWEEN_TOKENS), "")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as one struct column `row`, beside the given columns: no name of the row can clash with them."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), *[v.alias(k) for k, v in columns.items()])


def unpacked(df: DataFrame, *more: str | Column) -> DataFrame:
    """The columns of `row`, then more columns; those replace columns of the row with the same name."""
    extra = [F.col(m).alias(m) if isinstance(m, str) else m for m in more]
    names = {df.select(e).columns[0] for e in extra}
    fields = [f for f in df.schema["row"].dataType.names if f not in names]
    return df.select(*[F.col("row").getField(f).alias(f) for f in fields], *extra)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back: later steps start from files, not from its lineage."""
    spark = df.sparkSession
    place = work_folder(spark, purpose)
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def dropped(*frames: DataFrame) -> None:
    """Removes the files of written frames that nothing reads any more."""
    for df in frames:
        folders = {file.rpartition("/")[0] for file in df.inputFiles()}
        for folder in folders:
            remove_folder(df.sparkSession, folder)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame, to be broadcast if a count finds it small enough, else left to a shuffled join.

    Count only what is cheap to read again: written tables and constants.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
