"""A resumable load that remembers its keys in the stream's state, so that no batch looks at the target.

The state holds, per key, the row that was loaded for it and the time of the batch that brought it: the smallest row of the first
batch with that key. A key that comes again leaves its state as it is, and a batch writes those rows only that bear
its own time. Time is that of the batch, which the checkpoint keeps, so a batch that is repeated writes the same rows into the same
folder. State lies in RocksDB, on disk beside the tasks and in the checkpoint; it has one row per key ever loaded, spread
over spark.sql.shuffle.partitions of the first run.

The stream has to be the target's only writer; targets with other writers are for streaming/resume.py.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from freightlane.functions.scalars import quoted
from freightlane.operators.conform import split
from freightlane.operators.load import batch_folder
from freightlane.plans.contract import Contract
from freightlane.sources.sinks import write_rejects

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_AT, _FIRST = "_at", "_first"


def first_rows(good: DataFrame, contract: Contract) -> DataFrame:
    """Of a stream of conformed rows, for every key that a batch brings for the first time, its smallest row in the batch."""
    others = [c for c in contract.targets if c not in contract.key]
    marked = good.withColumn(_AT, F.current_timestamp())
    kept = marked.groupBy(*[quoted(k) for k in contract.key]).agg(
        F.min(F.struct(_AT, *[quoted(c) for c in others])).alias(_FIRST)
    )
    fresh = kept.filter(F.col(f"{_FIRST}.{_AT}") == F.current_timestamp())
    return fresh.select(*[
        F.col(quoted(c)) if c in contract.key else F.col(f"{_FIRST}.{quoted(c)}").alias(c) for c in contract.targets
    ])


def keyed_load(
    spark: SparkSession,
    source: str,
    contract: Contract,
    target: str,
    state: str,
    run: str,
    schema: T.StructType | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Load all files of a folder or glob that were not loaded yet, then stop; one row per key, the first one stays.

    `state` holds the checkpoint, which has the keys. Calling again with the same run goes on after the last finished batch.
    The number of keys in the state stands in the query's progress (stateOperators.numRowsTotal).
    """
    if not contract.key:
        raise ValueError(f"{contract.name} has no key to remember")
    place = f"{state.rstrip('/')}/{run}/{contract.name}"
    options = {}
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    if max_bytes:
        options["maxBytesPerTrigger"] = str(max_bytes)
    if schema is None:
        schema = spark.read.parquet(source).schema

    def stream() -> DataFrame:
        return spark.readStream.schema(schema).options(**options).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(target, run, number))

    def write_bad(batch: DataFrame, number: int) -> None:
        write_rejects(batch, rejects, contract.name, run, number)

    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        good, _ = split(stream(), contract)
        query = (
            first_rows(good, contract)
            .writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", f"{place}/keyed")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        if rejects:
            _, bad = split(stream(), contract)
            bad.writeStream.foreachBatch(write_bad).option("checkpointLocation", f"{place}/rejects").trigger(availableNow=True).start().awaitTermination()
        return query
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
