"""Every operator as a query over the whole of its table, with the columns that its contract names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlane.llm import (
    decontaminate,
    host_quality,
    html_extract,
    license_scan,
    mixing,
    near_dedup,
    prefix_trie,
    sharding,
    spelling,
    substring_dedup,
    token_count,
    tool_calls,
    warc,
)
from freightlane.llm.common import table, text_of, written
from freightlane.llm.oracles import ORACLES
from freightlane.session import work_folder


def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(table(spark, folder, "pages"))


def op2_warc_salvage(spark: SparkSession, folder: str) -> DataFrame:
    place = work_folder(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), place)
    records = written(warc.read_archives(spark, place, keep_payload=False), "records")
    found = warc.resolved(records)
    return found.select(
        warc.page_id(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_id(F.col("refers_to")).alias("refers_to"),
    )


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.token_counts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.groups(table(spark, folder, "documents"), k=2)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    out = mixing.mix(table(spark, folder, "documents"), carry=["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op7_host_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    judged = host_quality.judge(docs, keep_text=False)
    facts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *facts, "base_failed", "kept")


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs of document and benchmark item with a proven overlap."""
    return decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"), shortest=1)


def op9_shard(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return sharding.deal(rows).withColumn("grown_shard", F.lit(None).cast("int"))


def op10_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    return tool_calls.transcripts(table(spark, folder, "conversations"), each=True)


def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digests(table(spark, folder, "documents"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(spelling.runs(table(spark, folder, "documents"), every=31)))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    "op1_main_text": op1_main_text,
    "op2_warc_salvage": op2_warc_salvage,
    "op3_license_scan": op3_license_scan,
    "op4_token_counts": op4_token_counts,
    "op5_near_dedup": op5_near_dedup,
    "op6_mix_sources": op6_mix_sources,
    "op7_host_quality": op7_host_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_shard": op9_shard,
    "op10_tool_calls": op10_tool_calls,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_spelling": op12_spelling,
    "op13_prefix_trie": op13_prefix_trie,
}
