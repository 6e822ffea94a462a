"""Uniform shuffle into shards of exact sizes."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from freightlane.llm import sharding
from freightlane.llm.queries import op9_shard
from tests.llm.helpers import messy, no_rows


@pytest.mark.parametrize("counts", [{0: 5, 3: 0, 7: 12}, {0: 1000}, {i: i for i in range(40)}, {}])
def test_matrix_has_the_right_sums(counts):
    matrix = sharding.communication_matrix(counts, 7, 1)
    assert {p: sum(row) for p, row in matrix.items()} == counts
    total = sum(counts.values())
    sizes = [sum(row[s] for row in matrix.values()) for s in range(7)]
    assert sizes == [total // 7 + (s < total % 7) for s in range(7)]


def test_draw_beyond_the_library_has_the_same_distribution():
    room = np.array([30, 10, 60])
    draw = np.random.Generator(np.random.PCG64(1))
    plain = np.mean([sharding.drawn(draw, room, 20) for _ in range(4000)], axis=0)
    large = room * 10**8
    drawn = sharding.drawn(draw, large, 1000)
    assert drawn.sum() == 1000 and np.allclose(drawn / 1000, room / 100, atol=0.06)
    assert np.allclose(plain / 20, room / 100, atol=0.02)


def test_labels_are_a_permutation():
    labels = sharding.local_labels([3, 0, 4], 1, 2)
    assert Counter(labels.tolist()) == {0: 3, 2: 4}
    assert labels.tolist() == sharding.local_labels([3, 0, 4], 1, 2).tolist() != sharding.local_labels([3, 0, 4], 1, 3).tolist()


def check_slots(rows, shards, total):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert sum(sizes) == total and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_query(spark, folder):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op9_shard(spark, folder).collect()
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs.items()
    }
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    check_slots(rows, 16, len(docs))


def test_many_blocks_and_partitions_are_mixed(spark):
    out = sharding.deal(spark.range(0, 6000, 1, 9), shards=4, block_rows=100).collect()
    check_slots(out, 4, 6000)
    first = sorted((r for r in out if r["shard"] == 0), key=lambda r: r["slot"])
    ids = np.array([r["id"] for r in first])
    assert abs(np.corrcoef(ids, np.arange(len(ids)))[0, 1]) < 0.1
    assert abs(ids.mean() - 3000) < 200


def test_the_same_rows_are_dealt_alike_again(spark):
    rows = spark.range(0, 500, 1, 5)
    once, again = ({tuple(r) for r in sharding.deal(rows, 3).collect()} for _ in range(2))
    assert once == again


def test_messy_rows(spark):
    rows = messy(spark)
    out = sharding.deal(rows, shards=4)
    assert set(out.columns) == {*rows.columns, "slot"} and out.schema["shard"].dataType.simpleString() == "int"
    got = out.collect()
    check_slots(got, 4, 11)
    plain = rows.drop("shard")
    assert Counter(map(tuple, out.select(plain.columns).collect())) == Counter(map(tuple, plain.collect()))
    assert sharding.deal(no_rows(spark)).count() == 0


def test_written_shards_are_in_order(spark, tmp_path):
    out = sharding.deal(spark.range(0, 300, 1, 4), shards=3)
    sharding.write_shards(out, str(tmp_path / "shards"), block_rows=40)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 300
    files = back.withColumn("file", F.col("_metadata.file_path")).groupBy("file", "shard").agg(F.min("slot"), F.max("slot"), F.count("*"))
    assert all(r[3] - r[2] + 1 == r[4] for r in files.collect())
