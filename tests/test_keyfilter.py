"""Key filters beside a target: the same rows as without, and how much of the target is read."""

import random

import pytest

from freightlane.operators import keyfilter, load
from freightlane.plans.contract import ColumnSpec, Contract
from tests.conftest import rows

CONTRACT = Contract(
    "s.things", "w.things", (ColumnSpec("k", "INT8"), ColumnSpec("p", "TEXT", length=9), ColumnSpec("v", "TEXT", length=20)), ("k", "p")
)


def frame(spark, keys, value="v"):
    return spark.createDataFrame([(k, f"p{k % 3}", f"{value}{k}") for k in keys], "k long, p string, v string")


def loaded(spark, batches, place, **options):
    return [load.load_batch(df, CONTRACT, place, "r", i, **options)["rows_loaded"] for i, df in enumerate(batches)]


@pytest.mark.parametrize("bits", [16, 26])
def test_same_target_as_without(spark, tmp_path, bits):
    draw = random.Random(bits)
    batches = [frame(spark, [draw.randrange(3000) for _ in range(700)], f"b{i}-") for i in range(4)]
    plain = loaded(spark, batches, str(tmp_path / "plain"))
    assert loaded(spark, batches, str(tmp_path / "filtered"), key_bits=bits) == plain
    both = [rows(load.read_target(spark, str(tmp_path / x), CONTRACT)) for x in ("plain", "filtered")]
    assert both[0] == both[1] and len(both[0]) == sum(plain)


def test_random_new_keys_read_no_rows_of_the_target(spark, tmp_path):
    """Keys all over the range of the target's: ranges cannot prune, the filter does."""
    place, draw = str(tmp_path / "t"), random.Random(1)
    numbers = draw.sample(range(10**9), 4000)
    loaded(spark, [frame(spark, numbers[i * 1000 : (i + 1) * 1000]) for i in range(3)], place, key_bits=30)
    target = load.target_files(spark, place, CONTRACT)
    fresh, seen = keyfilter.new_by_filter(frame(spark, numbers[3000:]), target, CONTRACT.key, place, 30)
    assert fresh.count() == 1000 and seen["batches"] == 3 and seen["maybe"] <= 5 and seen["batches_read"] <= seen["maybe"]
    fresh, seen = keyfilter.new_by_filter(frame(spark, [*numbers[1000:1200], *numbers[3000:]]), target, CONTRACT.key, place, 30)
    assert fresh.count() == 1000 and 200 <= seen["maybe"] <= 205 and 1 <= seen["batches_read"] <= 3


def test_a_batch_without_filter_is_always_read(spark, tmp_path):
    place = str(tmp_path / "t")
    load.load_batch(frame(spark, range(10)), CONTRACT, place, "r", 0)
    assert load.load_batch(frame(spark, range(5, 15)), CONTRACT, place, "r", 1, key_bits=20)["rows_loaded"] == 5
    keyfilter.forget(spark, place, "r", 1, 20)
    assert load.load_batch(frame(spark, range(20)), CONTRACT, place, "r", 2, key_bits=20)["rows_loaded"] == 5


def test_a_replayed_batch_gives_the_same(spark, tmp_path):
    place = str(tmp_path / "t")
    batches = [frame(spark, range(50)), frame(spark, range(40, 90))]
    loaded(spark, batches, place, key_bits=20)
    once = rows(load.read_target(spark, place, CONTRACT))
    assert load.load_batch(batches[1], CONTRACT, place, "r", 1, key_bits=20)["rows_loaded"] == 40
    assert rows(load.read_target(spark, place, CONTRACT)) == once
    assert load.load_batch(batches[0].limit(0), CONTRACT, place, "r", 2, key_bits=20)["rows_loaded"] == 0


def test_bits_of_bitmaps(spark):
    df = frame(spark, range(500))
    for bits in (15, 20, 30):
        maps = keyfilter.bitmaps(df.limit(100), ["k"], bits)
        assert maps.selectExpr("sum(bitmap_count(bits)) AS n").first()["n"] <= 100
        place = keyfilter._place(["k"], bits)
        found = df.withColumn("place", place).join(maps, (place / 32768).cast("long") == maps["bucket"])
        known = {r["k"] for r in found.filter(keyfilter._is_set(found["bits"], found["place"])).collect()}
        assert known >= {r["k"] for r in df.limit(100).collect()}


def test_a_small_batch_compares_few_keys_of_a_large_target(spark, tmp_path, monkeypatch):
    """Its keys lie at both ends of the target's range, so the range prunes nothing."""
    place, seen, real = str(tmp_path / "t"), [], load.new_rows

    def watched(good, target, *args, **options):
        seen.append(None if target is None else target.count())
        return real(good, target, *args, **options)

    monkeypatch.setattr(load, "new_rows", watched)
    batches = [frame(spark, range(6000)), frame(spark, [0, 1, 5999, 7000], "again")]
    assert loaded(spark, batches, place, frozen=True) == [6000, 1]
    assert seen[0] is None and 3 <= seen[1] < 600
    assert loaded(spark, batches, place, frozen=True) == [6000, 1]
    assert load.read_target(spark, place, CONTRACT).count() == 6001


@pytest.mark.parametrize("kind", ["long", "string", "decimal(12,3)", "double", "date", "binary"])
@pytest.mark.parametrize("n", [1, 3, 5000, 40_000])
def test_no_key_of_the_batch_is_ruled_out_and_most_others_are(spark, kind, n):
    number = {"date": "date_from_unix_date(int(id))", "binary": "cast(string(id) as binary)", "double": "double(id) / 7"}.get(kind, f"cast(id as {kind})")
    batch = spark.range(n).selectExpr(f"{number} AS k", "int(id % 5) AS p")
    others = spark.range(100_000, 110_000).selectExpr(f"{number} AS k", "int(id % 5) AS p")
    told = keyfilter.may_be_in(batch, ["k", "p"], n)
    assert batch.filter(told).count() == n
    assert others.filter(told).count() < 2_000


def test_zeros_of_both_signs_are_one_key_of_the_batch(spark):
    batch = spark.sql("SELECT double('-0.0') AS k UNION ALL SELECT double('NaN')")
    target = spark.sql("SELECT 0d AS k UNION ALL SELECT double('NaN')")
    assert target.filter(keyfilter.may_be_in(batch, ["k"], 2)).count() == 2


def test_an_empty_batch_has_no_key(spark):
    assert frame(spark, range(50)).filter(keyfilter.may_be_in(frame(spark, [1]).limit(0), CONTRACT.key, 0)).count() == 0
