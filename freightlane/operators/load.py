"""Idempotent loads: reject bad rows, keep one row per key, skip keys already in the target.

A target is a folder of Parquet files below `load_run=<run>/load_batch=<n>/`. Writing a batch replaces
exactly its own folder, and the "already loaded" test leaves that folder out. So a batch can be replayed
after any failure, at any point, and gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from freightlane.functions.scalars import quoted
from freightlane.operators import keyfilter
from freightlane.operators.conform import breaks_contract, conform, reject_counts, split, staged_values
from freightlane.operators.keys import not_loaded, one_per_key
from freightlane.plans.contract import Contract
from freightlane.sources.sinks import write_rejects

RUN, BATCH = "load_run", "load_batch"
LOG_SCHEMA = (
    "table_name string, load_run string, load_batch long, rows_read long, rows_loaded long, "
    "rows_rejected long, rows_ignored long, error string, loaded_at timestamp"
)
# Key types whose smallest and largest incoming value can prune the target scan.
_PRUNABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DecimalType, T.DateType)


class TooManyRejects(RuntimeError):
    """The share of rejected rows is above the allowed rate; nothing but the rejects was written."""


def batch_folder(root: str, run: str, batch: int) -> str:
    return f"{root.rstrip('/')}/{RUN}={run}/{BATCH}={batch}"


def target_files(spark: SparkSession, target: str, contract: Contract) -> DataFrame | None:
    """All loaded rows with the run and batch that brought them, or None where nothing was loaded yet."""
    schema = T.StructType([*contract.schema.fields, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())])
    try:
        return spark.read.schema(schema).parquet(target)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_target(spark: SparkSession, target: str, contract: Contract) -> DataFrame:
    """The loaded table, without the load columns. Empty where nothing was loaded yet."""
    loaded = target_files(spark, target, contract)
    if loaded is None:
        return spark.createDataFrame([], contract.schema)
    return loaded.select(*[quoted(c) for c in contract.targets])


def _in_key_range(loaded: DataFrame, contract: Contract, low: object, high: object) -> DataFrame:
    """The target rows whose first key column is in a range. The range reaches the scan, so a batch over a
    key range reads only the matching row groups."""
    c, dtype = contract.key[0], contract.schema[contract.key[0]].dataType
    if low is None or not isinstance(dtype, _PRUNABLE):
        return loaded
    return loaded.filter(F.col(quoted(c)).between(F.lit(low).cast(dtype), F.lit(high).cast(dtype)))


def new_rows(good: DataFrame, loaded: DataFrame | None, contract: Contract, null_keys: bool = True) -> DataFrame:
    """One row per key of `good`, without keys that `loaded` already has.

    The anti-join reuses the partitioning of the de-duplication. Without a key every row is new. NULL parts of keys equal
    each other; `null_keys=False` says that there are none, as after split().
    """
    if not contract.key:
        return good
    unique = one_per_key(good, contract.key)
    return unique if loaded is None else not_loaded(unique, loaded, contract.key, null_keys)


def first_look(df: DataFrame, contract: Contract) -> dict[str, object]:
    """What one narrow pass over a source tells: rows_read, rows_rejected, and the low and high end of the first key
    column among the good rows. Nothing is shuffled but one row per task."""
    staged = staged_values(df, contract)
    bad = breaks_contract(staged, contract)
    first = F.col(f"c{contract.targets.index(contract.key[0])}")
    return (
        staged.select(bad.alias("bad"), F.when(~bad, first).alias("first"))
        .agg(
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if("bad").alias("rows_rejected"),
            F.min("first").alias("low"),
            F.max("first").alias("high"),
        )
        .first()
        .asDict()
    )


def load_batch(
    df: DataFrame,
    contract: Contract,
    target: str,
    run: str,
    batch: int = 0,
    rejects: str | None = None,
    log: str | None = None,
    max_reject_rate: float = 1.0,
    frozen: bool = False,
    key_bits: int | None = None,
) -> dict[str, object]:
    """Load one batch and return its log row. Counts are of rows really written, not of rows sent.

    Bad rows go to `rejects` as CSV and the load goes on, unless their share is above `max_reject_rate`.
    The source is scanned once for the columns the rules need, and once for the load; rejects are only
    written when there are any. A `frozen` source (files) gives the same rows every time it is read, so its
    key range, found by the first scan, may prune the target; a batch of up to keyfilter.FEW_ROWS rows also tells by a filter of
    its own keys which of the target's are worth a comparison. Key columns are required, so no key has a NULL part.
    With `key_bits` a filter of that many bits (2^key_bits) is kept beside the target for each batch, and the target is read
    only for keys that the filters cannot rule out (operators/keyfilter.py). Loads of one target should agree on it.
    """
    spark = df.sparkSession
    ranged = frozen and bool(contract.key)
    counts = first_look(df, contract) if ranged else reject_counts(df, contract).first().asDict()
    good, bad = split(df, contract)
    if counts["rows_rejected"]:
        if rejects:
            write_rejects(bad, rejects, contract.name, run, batch)
        if counts["rows_rejected"] > max_reject_rate * counts["rows_read"]:
            raise TooManyRejects(
                f"{contract.name}: {counts['rows_rejected']} of {counts['rows_read']} rows break the contract"
            )
    loaded = target_files(spark, target, contract)
    if loaded is not None:
        loaded = loaded.filter(~((F.col(RUN) == run) & (F.col(BATCH) == batch)))
        if ranged:
            loaded = _in_key_range(loaded, contract, counts["low"], counts["high"])
            if not key_bits and counts["rows_read"] <= keyfilter.FEW_ROWS:
                # Of a large target's keys only those that a small batch may have are shuffled and compared.
                loaded = loaded.filter(keyfilter.may_be_in(conform(df, contract), contract.key, counts["rows_read"]))
    folder = batch_folder(target, run, batch)
    if key_bits and contract.key:
        fresh, _ = keyfilter.new_by_filter(good, loaded, contract.key, target, key_bits)
        keyfilter.forget(spark, target, run, batch, key_bits)
    else:
        fresh = new_rows(good, loaded, contract, null_keys=False)
    fresh.write.mode("overwrite").parquet(folder)
    # Row counts of Parquet files come from their footers.
    stored = spark.read.schema(contract.schema).parquet(folder)
    written = stored.count()
    if key_bits and contract.key:
        keyfilter.remember(stored, target, contract.key, run, batch, key_bits)
    entry = {
        "table_name": contract.name,
        RUN: run,
        BATCH: batch,
        "rows_read": counts["rows_read"],
        "rows_loaded": written,
        "rows_rejected": counts["rows_rejected"],
        "rows_ignored": counts["rows_read"] - counts["rows_rejected"] - written,
        "error": None,
        "loaded_at": datetime.now(timezone.utc),
    }
    if log:
        place = f"{log.rstrip('/')}/{contract.name}/{run}/{batch}"
        _log_line(spark, entry).write.mode("overwrite").json(place)
    return entry


def append_bucketed(df: DataFrame, contract: Contract, table: str, buckets: int) -> None:
    """Add the new keys of conformed rows to a catalog table bucketed by its key, creating it if needed.

    The stored buckets serve as the target's side of the anti-join, so a large target is never shuffled,
    whatever its key looks like. Repeating the call adds nothing, because its keys are there already.
    """
    if not contract.key:
        raise ValueError(f"{contract.name} has no key to bucket by")
    spark = df.sparkSession
    loaded = spark.table(table) if spark.catalog.tableExists(table) else None
    first, *rest = contract.key
    new_rows(df, loaded, contract).write.bucketBy(buckets, first, *rest).mode("append").saveAsTable(table)


def log_frame(spark: SparkSession, entries: Iterable[dict[str, object]]) -> DataFrame:
    schema = T.StructType.fromDDL(LOG_SCHEMA)
    return spark.createDataFrame([tuple(e[f.name] for f in schema) for e in entries], schema)


def _log_line(spark: SparkSession, entry: dict[str, object]) -> DataFrame:
    """One log row as literals, so that no Python process starts for it, as one does for rows of log_frame()."""
    fields = T.StructType.fromDDL(LOG_SCHEMA)
    return spark.range(0, 1, 1, 1).select(*[F.lit(entry[f.name]).cast(f.dataType).alias(f.name) for f in fields])


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", True).json(log)


def load_progress(log: DataFrame) -> DataFrame:
    """Per table: batches, rows so far and the time of the last batch."""
    return log.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("batches"),
        *[F.sum(c).alias(c) for c in ("rows_read", "rows_loaded", "rows_rejected", "rows_ignored")],
        F.max("loaded_at").alias("last_loaded_at"),
    )


def load_tables(
    spark: SparkSession,
    contracts: Sequence[Contract],
    read: Callable[[Contract], DataFrame],
    target: str,
    run: str,
    rejects: str | None = None,
    log: str | None = None,
    tables: Iterable[str] | None = None,
    at_once: int = 4,
    stop_on_error: bool = False,
    max_reject_rate: float = 1.0,
    frozen: bool = False,
) -> DataFrame:
    """Load several tables, each into its own folder below `target`; the log rows, one per table.

    Tables are independent jobs, `at_once` of them submitted together so that small tables do not leave the
    cluster idle. A failed table gives a row with its error and the others go on, unless `stop_on_error`.
    """
    wanted = set(tables) if tables else None
    chosen = sorted((c for c in contracts if wanted is None or c.source_table in wanted), key=lambda c: c.name)

    def load(contract: Contract) -> dict[str, object]:
        try:
            folder = f"{target.rstrip('/')}/{contract.name}"
            return load_batch(
                read(contract), contract, folder, run, 0, rejects=rejects, log=log, max_reject_rate=max_reject_rate, frozen=frozen
            )
        except Exception as failure:
            if stop_on_error:
                raise
            nothing = dict.fromkeys(("rows_read", "rows_loaded", "rows_rejected", "rows_ignored"), 0)
            now = datetime.now(timezone.utc)
            return {"table_name": contract.name, RUN: run, BATCH: 0, **nothing, "error": str(failure), "loaded_at": now}

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return log_frame(spark, list(pool.map(load, chosen)))


def run_totals(log: DataFrame) -> DataFrame:
    """Per run: tables, failed tables and summed row counts."""
    return log.groupBy(RUN).agg(
        F.count_distinct("table_name").alias("tables"),
        F.count_if(F.col("error").isNotNull()).alias("failures"),
        *[F.sum(c).alias(c) for c in ("rows_read", "rows_loaded", "rows_rejected", "rows_ignored")],
    )
