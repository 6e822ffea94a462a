"""A load that resumes where it stopped: file stream, checkpoint, idempotent batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from freightlane.operators.load import load_batch
from freightlane.plans.contract import Contract


def resume_load(
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
    max_reject_rate: float = 1.0,
    key_bits: int | None = None,
) -> StreamingQuery:
    """Load all files of a folder or glob that were not loaded yet, in batches of `max_files` files or `max_bytes`, then stop.

    `state` holds the stream's checkpoint and the load log, both named after run and table. Calling again
    with the same run continues after the last finished batch; an unfinished batch is repeated and replaces
    what it had written. A batch costs one look at the target's keys in its range, so on large tables
    batches should be large (hundreds of GB), or `key_bits` given, which keeps a filter of the loaded keys.
    """
    place = f"{state.rstrip('/')}/{run}/{contract.name}"
    log = f"{state.rstrip('/')}/{run}/log"
    options = {}
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    if max_bytes:
        options["maxBytesPerTrigger"] = str(max_bytes)
    if schema is None:
        schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).options(**options).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        load_batch(
            batch,
            contract,
            target,
            run,
            number,
            rejects=rejects,
            log=log,
            max_reject_rate=max_reject_rate,
            frozen=True,
            key_bits=key_bits,
        )

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{place}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
