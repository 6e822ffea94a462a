"""Table scans: projection, filter, row count and key pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from freightlane.functions.scalars import quoted
from freightlane.session import work_folder


def read_files(spark: SparkSession, path: str, schema: T.StructType | None = None, format: str = "parquet") -> DataFrame:
    """A table stored as files. With a schema nothing is inferred from the data."""
    reader = spark.read.format(format)
    return (reader.schema(schema) if schema else reader).load(path)


def scan(df: DataFrame, columns: Sequence[str] | None = None, where: str | None = None) -> DataFrame:
    """Only some columns and rows. Both reach the file or JDBC scan as pushed-down work."""
    kept = df.filter(F.expr(where)) if where else df
    return kept.select(*[quoted(c) for c in columns]) if columns else kept


def snapshot(df: DataFrame) -> DataFrame:
    """The rows as they are now, copied once into the shared work folder.

    For sources that change or are costly to read, such as databases: checks and load then see the same rows,
    the source is read once, and the copy can be loaded as frozen.
    """
    place = f"{work_folder(df.sparkSession, 'snapshot')}/rows"
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def with_page(df: DataFrame, key: str, pages: int) -> DataFrame:
    """Every row with the number of its key page: `pages` equal ranges between smallest and largest key.

    Pages replace offset paging: they do not depend on row order, no row is skipped or repeated, and the
    rows are not moved. The bounds are a one-row subquery, which Spark sends to all tasks. Rows without a
    key belong to page 0.
    """
    k = F.col(quoted(key)).cast("decimal(38,0)")
    bounds = df.agg(F.min(k).alias("low"), F.max(k).alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    position = F.floor((k - low).cast("double") * pages / (high - low + 1).cast("double"))
    page = F.when(k.isNull(), 0).otherwise(F.least(position, F.lit(pages - 1)))
    return df.withColumn("page", page.cast("int"))


# Keys looked at to place page bounds; the pages themselves hold every row.
BOUND_KEYS = 20_000


def page_bounds(df: DataFrame, key: str, pages: int, keys: int = BOUND_KEYS, seed: int = 42) -> list[object]:
    """Up to `pages` - 1 increasing key values that divide the rows into about equal pages, for any ordered key type.

    They are the quantiles of a random sample of about `keys` rows, so that clustered keys get as many pages as
    they have rows. A value more frequent than a page is one bound, and a page of its own. For databases the bounds go
    to jdbc.boundary_predicates().
    """
    k = F.col(quoted(key)).alias("key")
    present = df.select(k).filter("key IS NOT NULL")
    total = present.agg(F.count(F.lit(1))).first()[0]
    chosen = present if total <= keys else present.sample(keys / total, seed)
    found = [r[0] for r in chosen.orderBy("key").collect()]
    return list(dict.fromkeys(found[i * len(found) // pages] for i in range(1, pages) if found))


def with_page_of(df: DataFrame, key: str, bounds: Sequence[object]) -> DataFrame:
    """Every row with the number of its page: how many bounds are not above its key. Rows without a key are in page 0."""
    dtype = df.schema[key].dataType
    steps = [F.when(F.col(quoted(key)) >= F.lit(b).cast(dtype), 1).otherwise(0) for b in bounds]
    return df.withColumn("page", sum(steps, F.lit(0)).cast("int"))


#: Characters of a text key, behind what all keys share, that place it among the pages; they make one whole number.
PLACED_CHARACTERS = 3
_CHARACTER = 1 << 21


def key_position(key: str, dtype: T.DataType, shared: int = 0) -> Column:
    """A whole number that grows with the key, so that a sketch of numbers knows where keys lie.

    Numbers are their whole part, dates and times their count of days or microseconds, text its first characters behind
    `shared` ones. Keys may share a number, never swap places.
    """
    k = F.col(quoted(key))
    if isinstance(dtype, T.StringType):
        codes = [F.coalesce(F.ascii(F.substring(k, shared + 1 + i, 1)), F.lit(0)).cast("long") for i in range(PLACED_CHARACTERS)]
        return F.when(k.isNotNull(), sum((c * _CHARACTER ** (PLACED_CHARACTERS - 1 - i) for i, c in enumerate(codes)), F.lit(0).cast("long")))
    if isinstance(dtype, T.DateType):
        return F.unix_date(k).cast("long")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(k.cast("timestamp"))
    return F.floor(k).cast("long")


def sketched_pages(df: DataFrame, key: str, pages: int, k: int = 4_000) -> tuple[Column, list[int]]:
    """The position of a key, and up to `pages` - 1 increasing positions that divide the rows into about equal pages.

    One pass for a quantile sketch (KLL), map-side combined: no keys are sampled, sorted or sent to the driver but the bounds. With
    k = 4,000 a bound's rank is off by some 0.1 % of the rows. For text a pass before finds what all keys begin with.
    """
    dtype, shared = df.schema[key].dataType, 0
    if isinstance(dtype, T.StringType):
        ends = df.agg(F.min(quoted(key)), F.max(quoted(key))).first()
        low, high = (e or "" for e in ends)
        shared = next((i for i, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
    position = key_position(key, dtype, shared)
    ranks = ", ".join(f"{i / pages!r}D" for i in range(1, pages))
    sketch = df.select(position.alias("p")).filter("p IS NOT NULL").agg(F.count("p").alias("n"), F.kll_sketch_agg_bigint("p", F.lit(k)).alias("s"))
    found = sketch.select(F.expr(f"CASE WHEN n > 0 THEN kll_sketch_get_quantile_bigint(s, array({ranks})) END").alias("q")).first()["q"] if pages > 1 else []
    return position, sorted(set(found or []))


def with_sketched_page(df: DataFrame, key: str, pages: int) -> DataFrame:
    """Every row with the number of its page of about equally many rows, in order of the key. Rows without a key are in page 0."""
    position, bounds = sketched_pages(df, key, pages)
    steps = [F.when(F.col("_position") > b, 1).otherwise(0) for b in bounds]
    return df.withColumn("_position", position).withColumn("page", sum(steps, F.lit(0)).cast("int")).drop("_position")


def split_by_range(df: DataFrame, pages: int, *keys: str) -> DataFrame:
    """The rows moved into key-ordered partitions, for a sink that is written one page at a time.

    Further keys divide the rows that share a frequent first key.
    """
    return df.repartitionByRange(pages, *[quoted(k) for k in keys])
