"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, sharding, each over what the last one kept.

Every stage takes the columns of its input through unchanged, whatever their names, and gives no rows for an empty table. A NULL id
is no ground to drop a document: rows without an id are kept as documents of their own by all stages. Ids are whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from freightlane.llm import decontaminate, host_quality, mixing, near_dedup, sharding
from freightlane.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules of documents and hosts keep.

    NULL and empty texts have no words and go; NULL is a host of its own; repeated rows are judged alike.
    """
    return host_quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8.

    Texts without words are linked with nothing and stay; of rows with one id and text one stays; rows that share an id but not
    the text are documents of their own.
    """
    return near_dedup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a proven overlap with the benchmark.

    NULL and empty texts have none and stay; rows that share an id are judged by their own texts.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    NULL is a source of its own; a text without words has size 0 and goes with its hash; of equal rows some may be taken once more.
    """
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, shuffled into shards: with `shard` and `slot`, which replace columns of those names.

    Every row has a place of its own, repeated rows and NULLs too.
    """
    return sharding.deal(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("shards", shards),
]
#: Signatures and hash thresholds have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
