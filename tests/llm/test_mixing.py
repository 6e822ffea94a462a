"""Mixing sources to target weights."""

import pytest

from freightlane.llm import mixing
from freightlane.llm.queries import op6_mix_sources
from tests.llm.helpers import messy, no_rows, prose, words


def filled(sizes, weights=(5, 2, 1), budget=1.5, passes=2):
    """Targets by resharing the excess until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = {}, budget * sum(sizes.values()), set(order)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > passes * sizes[s]}
        if not full:
            return target | {s: unit * weight[s] for s in open_}
        for s in full:
            target[s] = passes * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 10, "d": 500, None: 7, "": 3},
        {"x": 5},
        {"a": 0, "b": 10},
        {"é": 4, "z": 9, "Z": 9, "🙂": 8, "￿": 2},
        {"a": 0},
    ],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    assert got == pytest.approx(filled(sizes))


def check(rows, docs):
    """rows: id -> (size, source_size, target, taken); docs: id -> (source, text)."""
    sizes = {}
    for source, text in docs.values():
        sizes[source] = sizes.get(source, 0) + len(words(text))
    target = filled(sizes)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for i, (source, text) in docs.items():
        size, source_size, goal, took = rows[i]
        assert size == len(words(text)) and source_size == sizes[source] and goal == pytest.approx(target[source])
        assert took in (0, size, 2 * size)
        taken[source] += took
        largest[source] = max(largest[source], size)
    for source in sizes:
        assert abs(taken[source] - target[source]) <= largest[source] / 2 + 1e-6


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01"])
def test_query(spark, table):
    place = f"/root/testdata/{table}"
    docs = {r["doc_id"]: (r["source"], r["text"]) for r in spark.read.parquet(f"{place}/documents.parquet").collect()}
    once, again = ({r["doc_id"]: tuple(r)[1:] for r in op6_mix_sources(spark, place).collect()} for _ in range(2))
    check(once, docs)
    assert once == again


def test_a_larger_mix_holds_a_smaller_one(spark):
    docs = spark.createDataFrame([(i, prose(10 + i % 7), "abc"[i % 3]) for i in range(400)], "doc_id long, text string, source string")
    copies = [{r["doc_id"]: r["copies"] for r in mixing.mix(docs, weights=(1,), budget=b).collect()} for b in (0.2, 0.6, 1.1, 2.0)]
    for less, more in zip(copies, copies[1:], strict=False):
        assert all(less[i] <= more[i] for i in less) and less != more
    assert set(copies[-1].values()) == {2}


def test_one_source_holds_most_rows(spark):
    docs = {i: ("hot" if i % 3 else f"s{i % 7}", prose(1 + i % 40)) for i in range(900)}
    frame = spark.createDataFrame([(i, t, s) for i, (s, t) in docs.items()], "doc_id long, text string, source string")
    check({r["doc_id"]: (r["size"], r["source_size"], r["target"], r["copies"] * r["size"]) for r in mixing.mix(frame).collect()}, docs)


def test_messy_rows(spark):
    rows = messy(spark)
    out = mixing.mix(rows)
    assert set(out.columns) == {*rows.columns, "source_size", "target", "copies"}
    assert out.schema["size"].dataType.simpleString() == "bigint" and out.count() == 11
    sizes = {}
    for r in rows.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words(r["text"]))
    target = filled(sizes)
    for r in out.collect():
        assert r["size"] == len(words(r["text"])) and r["copies"] in (0, 1, 2)
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
    assert mixing.mix(no_rows(spark)).count() == 0


def test_mixed_rows_stand_as_often_as_they_are_taken(spark):
    rows = messy(spark)
    plan = {(r["doc_id"], r["source"]): r["copies"] for r in mixing.mix(rows).collect()}
    out = mixing.mixed(rows)
    assert out.columns == rows.columns
    got = {}
    for r in out.collect():
        got[r["doc_id"], r["source"]] = got.get((r["doc_id"], r["source"]), 0) + 1
    repeated = {(1, "a"): 2}
    assert got == {k: n * repeated.get(k, 1) for k, n in plan.items() if n}
    assert mixing.mixed(no_rows(spark)).count() == 0


def test_copies_at_the_threshold_are_told_apart(spark):
    """200 copies of one row, some with another language, and 200 rows of their own: the target is met to half a document."""
    schema = "doc_id long, text string, source string, lang string"
    rows = [(0, "a b c d e f", "s", "x" if i % 3 else "y") for i in range(200)] + [(i, f"w{i} x y z", "s", "x") for i in range(1, 201)]
    for budget in (0.3, 0.9, 1.15, 1.4, 1.9):
        runs = [mixing.mix(spark.createDataFrame(part, schema), budget=budget).collect() for part in (rows, rows[::-1])]
        for out in runs:
            assert len(out) == len(rows) and {r["copies"] for r in out} <= {0, 1, 2}
            assert abs(sum(r["copies"] * r["size"] for r in out) - budget * 2000) <= 3
        key = lambda r: (r["doc_id"], r["lang"], r["copies"])
        assert sorted(map(key, runs[0])) == sorted(map(key, runs[1]))
