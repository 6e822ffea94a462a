"""Benchmark decontamination against brute force over all alignments."""

import itertools
import math

import pytest

from freightlane.llm import decontaminate as dc
from freightlane.llm.queries import op8_decontaminate
from tests.llm.helpers import messy, no_rows, prose, tokens

ITEMS = "item_id long, text string, id string, words string"


def overlap(text, item, window=dc.WINDOW, agree=dc.AGREE):
    """Whether some alignment has a window that agrees."""
    a, b = tokens(text), tokens(item)
    length = min(window, len(b))
    if len(b) < len(dc.MASKS[0]):
        return False
    for diagonal in range(-len(b) + length, len(a) - length + 1):
        same = [a[diagonal + i] == b[i] for i in range(max(0, -diagonal), min(len(b), len(a) - diagonal))]
        sums = [sum(same[i : i + length]) for i in range(len(same) - length + 1)]
        if sums and max(sums) >= math.ceil(length * agree):
            return True
    return False


def test_query_against_brute_force(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    vocabulary = {i: set(tokens(t)) for i, t in items}
    expected = set()
    for d, text in docs:
        known = set(tokens(text))
        expected |= {(d, i) for i, t in items if len(known & vocabulary[i]) > 7 and overlap(text, t)}
    got = {(r["doc_id"], r["item_id"]) for r in op8_decontaminate(spark, folder).collect()}
    assert got == expected and expected


def frame(spark, texts, schema="doc_id long, text string"):
    return spark.createDataFrame(list(enumerate(texts)), schema)


def leaks(spark, texts, items, **options):
    found = dc.overlaps(frame(spark, texts), frame(spark, items, "item_id long, text string"), **options)
    return {(r["doc_id"], r["item_id"]): r.asDict() for r in found.collect()}


ITEM = prose(30, 900)


def replaced(text, places):
    return " ".join("other" if i in places else w for i, w in enumerate(text.split()))


def test_exact_and_substituted_passages(spark):
    texts = [
        prose(40) + " " + ITEM.upper() + ". " + prose(9, 50),
        prose(40) + " " + replaced(ITEM, {4, 13, 22}),
        replaced(ITEM, set(range(0, 30, 3))),
        " ".join(ITEM.split()[:13]) + " " + prose(20),
        " ".join(ITEM.split()[:8]) + " " + prose(20),
        " ".join(reversed(ITEM.split())),
    ]
    found = leaks(spark, texts, [ITEM, prose(40, 5000)])
    assert set(found) == {(0, 0), (1, 0), (3, 0)}
    assert [found[0, 0][c] for c in ("first_word", "n_agree", "n_aligned", "share")] == [40, 30, 30, 1.0]
    assert (found[1, 0]["n_agree"], found[1, 0]["first_word"]) == (27, 40)
    assert found[3, 0]["n_agree"] == 13


@pytest.mark.parametrize("place", range(0, 13))
def test_any_single_substitution_is_tolerated(spark, place):
    passage = replaced(" ".join(ITEM.split()[5:18]), {place})
    assert set(leaks(spark, [prose(20) + " " + passage], [ITEM])) == {(0, 0)}


def allowed(n):
    """Substitutions that the rule allows among n aligned words."""
    return n - math.ceil(n * dc.AGREE)


@pytest.mark.parametrize("n", range(9, dc.WINDOW + 1))
def test_masks_hit_every_window_within_the_rule(n):
    places = [{at + i for i, on in enumerate(m) if on == "1"} for m in dc.MASKS for at in range(n - len(m) + 1)]
    for gone in itertools.combinations(range(n), allowed(n)):
        assert any(p.isdisjoint(gone) for p in places), gone


@pytest.mark.parametrize("n", [9, 10, 11, 13])
def test_all_substitutions_that_the_rule_allows(spark, n):
    item = " ".join(ITEM.split()[:n])
    texts = [prose(11) + " " + replaced(item, gone) + " " + prose(9, 50) for gone in itertools.combinations(range(n), allowed(n))]
    assert set(leaks(spark, texts, [item])) == {(i, 0) for i in range(len(texts))}


def test_part_of_a_long_item_at_an_edge(spark):
    parts = [" ".join(ITEM.split()[-13:]), " ".join(ITEM.split()[:13])]
    texts = [replaced(parts[0], {4, 8}) + " " + prose(20), prose(20) + " " + replaced(parts[1], {4, 8})]
    assert set(leaks(spark, texts, [ITEM])) == {(0, 0), (1, 0)}


def test_short_items_and_blocks(spark):
    items = [prose(8, 100), prose(9, 200), prose(12, 300), "", None]
    texts = [prose(8, 100), "x " + prose(9, 200), prose(12, 300) + " y"]
    assert set(leaks(spark, texts, items)) == {(1, 1), (2, 2)}
    assert set(leaks(spark, texts, items, block_seeds=3)) == {(1, 1), (2, 2)}


@pytest.mark.parametrize("n", range(1, 9))
def test_masks_of_short_items(n):
    masks = dc.short_masks(n)
    assert all(len(m) == n and "1" in m for m in masks)
    for gone in itertools.combinations(range(n), allowed(n)):
        assert any(all(m[i] == "0" for i in gone) for m in masks)


def test_items_shorter_than_the_masks(spark):
    items = [prose(n, 100 * n) for n in range(1, 9)] + [ITEM]
    texts = [prose(30, 5000) + " " + items[n - 1] + " " + prose(7, 6000) for n in range(1, 9)]
    texts += [items[n - 1] for n in range(1, 9)]
    texts += [prose(3, 5000) + " " + replaced(items[n - 1], {n // 2}) for n in range(1, 9)]
    texts += [replaced(items[n - 1], {0, n - 1}) for n in range(2, 9)]
    expected = {(i, i % 8) for i in range(16)} | {(15 + n, n - 1) for n in range(5, 9)}
    assert set(leaks(spark, texts, items, shortest=1)) == expected
    assert set(leaks(spark, texts, items, shortest=1, block_seeds=3)) == expected
    kept = dc.clean(frame(spark, texts), frame(spark, items, "item_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in expected}


def test_messy_rows(spark):
    rows = messy(spark)
    items = spark.createDataFrame([(1, prose(20, 520), "x", "y"), (1, prose(20, 520), "x", "y"), (None, prose(20, 110), None, None), (3, None, "x", "y")], ITEMS)
    found = {(r["doc_id"], r["item_id"]) for r in dc.overlaps(rows, items).collect()}
    assert found == {(None, 1), (8, None)}
    kept = dc.clean(rows, items)
    assert kept.columns == rows.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 1, 2, 3, 4, 5, 6, 7, 9]
    assert dc.overlaps(no_rows(spark), items).count() == dc.overlaps(rows, items.limit(0)).count() == 0
    assert dc.clean(rows, items.limit(0)).count() == 11


def test_shared_names_of_ids(spark):
    found = dc.overlaps(frame(spark, [ITEM]), frame(spark, [ITEM]), item_column="doc_id")
    assert found.columns[:2] == ["doc_id", "benchmark_doc_id"] and found.count() == 1
