"""A filter of the loaded keys beside a target, so that a load need not look at the target for keys that are new.

Every batch of a target has bitmaps of its keys' hashes, below `load_run=<run>/load_batch=<n>/` of a folder of its own. A key
whose bit is set in no batch is certainly new. The others, few unless a load repeats old keys, are held against the batches that
have their bit, and only those batches' keys are read. The exact comparison decides, so the filter's size changes the work
and never the result.

A filter is removed before its batch's files are replaced and written after them. A batch without one, because its load
died or it was loaded without filter, is always looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from freightlane.functions.scalars import quoted
from freightlane.operators.keys import not_loaded, one_per_key
from freightlane.session import remove_folder, work_folder

#: 2^BITS bits per batch at most: 8 MB, for some millions of keys. About 16 bits per key of the target rule out most new keys.
BITS = 26
#: Rows of a batch up to which may_be_in() tells most keys apart.
FEW_ROWS = 1 << (BITS - 3)
#: Bits of one stored bitmap, as Spark's bitmap functions have them.
_BITMAP_BITS = 32_768
RUN, BATCH = "load_run", "load_batch"
SCHEMA = f"bucket long, bits binary, {RUN} string, {BATCH} long"


def folder_of(target: str, bits: int = BITS) -> str:
    """Where the filters of a target lie: beside it, so that a scan of the target does not meet them."""
    return f"{target.rstrip('/')}__keys/bits={bits}"


def _place(key: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*[F.col(quoted(k)) for k in key]), 64 - bits)


def bitmaps(rows: DataFrame, key: Sequence[str], bits: int = BITS) -> DataFrame:
    """bucket, bits: the bitmaps of the keys' hashes. Map-side combined, so a hot key is one bit per task."""
    place = rows.select(_place(key, bits).alias("place"))
    return place.groupBy(F.floor(F.col("place") / _BITMAP_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.pmod("place", F.lit(_BITMAP_BITS))).alias("bits")
    )


def _is_set(bits: Column, place: Column) -> Column:
    """Whether a bit of a bitmap is set; bitmaps hold eight bits a byte, the lowest first."""
    at = F.pmod(place, F.lit(_BITMAP_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8))) == 1, F.lit(False))


def _stored(spark: SparkSession, target: str, bits: int) -> DataFrame:
    try:
        return spark.read.schema(SCHEMA).parquet(folder_of(target, bits))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def _batch_folder(target: str, run: str, batch: int, bits: int) -> str:
    return f"{folder_of(target, bits)}/{RUN}={run}/{BATCH}={batch}"


def forget(spark: SparkSession, target: str, run: str, batch: int, bits: int = BITS) -> None:
    """Remove a batch's filter, before its files are replaced."""
    remove_folder(spark, _batch_folder(target, run, batch, bits))


def remember(rows: DataFrame, target: str, key: Sequence[str], run: str, batch: int, bits: int = BITS) -> None:
    """Store the filter of a batch that has been written. An empty batch has an empty one."""
    bitmaps(rows, key, bits).write.mode("overwrite").parquet(_batch_folder(target, run, batch, bits))


def may_be_in(batch: DataFrame, key: Sequence[str], rows: int) -> Column:
    """Whether the key of another frame's row may be one of `batch`, which has up to `rows` rows: certainly not, if this is false.

    The batch's own bitmap of at least eight bits a row, up to 2^BITS, is one value that goes to all tasks: 16 MB at most, as it is
    told in digits of four bits. A digit is the low half of a character, so that a look takes a few instructions and no join.
    """
    bits = min(BITS, max(_BITMAP_BITS, 8 * rows - 1).bit_length())
    spot, at = F.floor(F.col("place") / _BITMAP_BITS).alias("bucket"), F.pmod("place", F.lit(_BITMAP_BITS)).alias("at")
    placed = batch.select(_place(key, bits).alias("place")).select(spot, at)
    # Every bucket is there, be it empty, so that places are found by counting.
    every = batch.sparkSession.range(0, (1 << bits) // _BITMAP_BITS, 1, 1).select(F.col("id").alias("bucket"), F.lit(None).cast("long").alias("at"))
    whole = placed.unionByName(every).groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
    digits = F.translate(F.hex("bits"), "ABCDEF", ":;<=>?").alias("digits")
    row = F.array_sort(F.collect_list(F.struct("bucket", digits)))
    told = whole.agg(F.array_join(F.transform(row, lambda b: b["digits"]), "").cast("binary")).scalar()
    place = _place(key, bits)
    # Bitmaps hold the lower half of a byte first, digits the upper one.
    digit = F.substring(told, (F.shiftright(place, 2).bitwiseXOR(F.lit(1)) + 1).cast("int"), F.lit(1))
    return F.getbit(F.ascii(digit.cast("string")), F.pmod(place, F.lit(4)).cast("int")) == 1


def batches_of(df: DataFrame) -> set[tuple[str, int]]:
    """The (run, batch) folders among the files of a frame; their names alone are read."""
    found = set()
    for file in df.inputFiles():
        parts = dict(p.split("=", 1) for p in file.split("/") if p.startswith((f"{RUN}=", f"{BATCH}=")))
        if len(parts) == 2:
            found.add((parts[RUN], int(parts[BATCH])))
    return found


def new_by_filter(good: DataFrame, loaded: DataFrame | None, key: Sequence[str], target: str, bits: int = BITS) -> tuple[DataFrame, dict[str, int]]:
    """One row per key of `good`, without the keys that `loaded` has, and how much was looked at.

    `loaded` is the target with its run and batch columns; keys must have no NULL parts. The counts are: keys that the filter
    left over, batches that were read for them, and all batches.
    """
    unique = one_per_key(good, key)
    if loaded is None:
        return unique, {"maybe": 0, "batches_read": 0, "batches": 0}
    spark = good.sparkSession
    kept = _stored(spark, target, bits)
    every, known = batches_of(loaded), batches_of(kept)
    kept = kept.select(RUN, BATCH, "bucket", "bits").join(_named(spark, every & known), [RUN, BATCH], "left_semi")
    unknown = every - known
    # All batches' bitmaps as one: at most 2^bits bits, whatever the number of batches.
    union = kept.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    union = F.broadcast(union) if bits <= 29 else union

    keys = good.select(*[quoted(k) for k in key]).distinct().withColumn("_place", _place(key, bits))
    keys = keys.withColumn("_bucket", F.floor(F.col("_place") / _BITMAP_BITS))
    if not unknown:
        probed = keys.join(union, F.col("_bucket") == F.col("bucket"))
        keys = probed.filter(_is_set(F.col("bits"), F.col("_place"))).drop("bucket", "bits")
    place = work_folder(spark, "maybe-loaded")
    keys.write.parquet(place)
    maybe = spark.read.schema(keys.schema).parquet(place)
    left = maybe.count()
    if not left:
        return unique, {"maybe": 0, "batches_read": 0, "batches": len(every)}
    hits = maybe.join(kept, F.col("_bucket") == F.col("bucket")).filter(_is_set(F.col("bits"), F.col("_place")))
    wanted = {(r[RUN], r[BATCH]) for r in hits.select(RUN, BATCH).distinct().collect()} | unknown
    there = loaded.filter(_in_batches(wanted)).select(*[quoted(k) for k in key])
    # The few keys in question are the small side; the target's keys need not be shuffled for them.
    asked = maybe.select(*[quoted(k) for k in key])
    found = work_folder(spark, "already-loaded")
    there.join(asked, list(key), "left_semi").distinct().write.parquet(found)
    old = spark.read.schema(asked.schema).parquet(found)
    return not_loaded(unique, old, key, null_keys=False), {"maybe": left, "batches_read": len(wanted), "batches": len(every)}


def _named(spark: SparkSession, batches: set[tuple[str, int]]) -> DataFrame:
    return F.broadcast(spark.createDataFrame(sorted(batches), f"{RUN} string, {BATCH} long"))


def _in_batches(batches: set[tuple[str, int]]) -> Column:
    """A filter on the folders' columns, so folders of other batches are not read."""
    by_run: dict[str, list[int]] = {}
    for run, batch in sorted(batches):
        by_run.setdefault(run, []).append(batch)
    found = F.lit(False)
    for run, numbers in by_run.items():
        found = found | ((F.col(RUN) == run) & F.col(BATCH).isin(numbers))
    return found


