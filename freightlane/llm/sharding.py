"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Every partition's rows are counted; the counts decide how many rows each partition sends to each shard, drawn as in a
uniform shuffle of all rows (a multivariate hypergeometric draw per partition from what the shards still lack). A
partition then deals its rows by a local permutation of exactly those labels, the rows are exchanged, and a random key
permutes every shard once more.

Defined cases: shard sizes differ by at most one, the first shards being larger; repeated rows are rows of their own;
NULLs are carried along; an empty table gives no rows; a column named like one of the added columns is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType
from pyspark.sql.window import Window

from freightlane.llm.common import packed, unpacked, written

SHARDS = 16
#: Rows of a shard that one task sorts, about.
BLOCK_ROWS = 50_000


def communication_matrix(counts: dict[int, int], shards: int, seed: int) -> dict[int, list[int]]:
    """Rows that each partition sends to each shard: row sums are the partitions' counts, column sums the shard sizes.

    One number per partition and shard lies on the driver, however many rows there are.
    """
    total = sum(counts.values())
    room = np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)
    draw = np.random.Generator(np.random.PCG64(seed))
    matrix = {}
    for partition in sorted(counts):
        sent = drawn(draw, room, counts[partition])
        room = room - sent
        matrix[partition] = [int(x) for x in sent]
    return matrix


def drawn(draw: np.random.Generator, room: np.ndarray, n: int) -> np.ndarray:
    """How many of n places, drawn from all free places without replacement, fall to each shard.

    The library's draw takes fewer than 10^9 free places. Beyond, n distinct places are drawn one by one and counted by
    shard, which is the same distribution.
    """
    free = int(room.sum())
    if free < 1_000_000_000:
        return draw.multivariate_hypergeometric(room, n, method="marginals")
    places = np.unique(draw.integers(0, free, n))
    while len(places) < n:
        places = np.union1d(places, draw.integers(0, free, n - len(places)))
    return np.diff(np.searchsorted(places, np.concatenate([[0], np.cumsum(room)])))


def local_labels(sent: list[int], seed: int, partition: int) -> np.ndarray:
    """The shard of each row of a partition, in row order: a permutation of exactly the drawn labels."""
    labels = np.repeat(np.arange(len(sent), dtype=np.int32), sent)
    np.random.Generator(np.random.PCG64([seed, partition])).shuffle(labels)
    return labels


def deal(docs: DataFrame, shards: int = SHARDS, seed: int = 42, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows with their columns `shard` and `slot`, its gapless place in the shard from 0 on.

    The rows are written once with the number of their partition and their place in it, so that a task that runs again
    deals them as before.
    """
    spark = docs.sparkSession
    place = F.monotonically_increasing_id()
    numbered = packed(docs, place=place).withColumns({
        "part": F.shiftright("place", 33),
        "nth": F.col("place").bitwiseAND(F.lit((1 << 33) - 1)),
        "mixed": F.xxhash64(F.lit(seed), F.col("place")),
    })
    rows = written(numbered, "dealt")
    counts = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    matrix = spark.sparkContext.broadcast(communication_matrix(counts, shards, seed))

    @F.pandas_udf(IntegerType())
    def dealt(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        kept, labels = None, None
        for part, nth in batches:
            out = np.empty(len(part), dtype=np.int32)
            for p in part.unique():
                if p != kept:
                    kept, labels = p, local_labels(matrix.value[int(p)], seed, int(p))
                here = (part == p).to_numpy()
                out[here] = labels[nth[here].to_numpy()]
            yield pd.Series(out)

    return _slots(rows, dealt, sum(counts.values()), shards, block_rows)


def _slots(rows: DataFrame, dealt, total: int, shards: int, block_rows: int) -> DataFrame:
    """Permute within the shards: blocks of a random key are numbered apart and put one after the other."""
    blocks = max(1, total // (shards * block_rows))
    block = F.pmod(F.shiftright("mixed", 20), F.lit(blocks)).cast("int")
    sent = rows.withColumns({"shard": dealt(F.col("part"), F.col("nth")), "block": block})
    within = Window.partitionBy("shard", "block").orderBy("mixed", "place")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sent.groupBy("shard", "block")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select("shard", "block", "first")
    )
    placed = sent.withColumn("nth_in_block", F.row_number().over(within) - 1).join(offsets, ["shard", "block"])
    return unpacked(placed, F.col("shard").cast("int").alias("shard"), (F.col("first") + F.col("nth_in_block")).alias("slot"))


def write_shards(dealt: DataFrame, place: str, block_rows: int = BLOCK_ROWS) -> None:
    """One folder per shard; its files hold consecutive slots in order."""
    spans = dealt.withColumn("__span", F.floor(F.col("slot") / block_rows))
    names = [c for c in dealt.columns]
    spans.repartition("shard", "__span").sortWithinPartitions("shard", "slot").select(*names).write.partitionBy("shard").parquet(place)
