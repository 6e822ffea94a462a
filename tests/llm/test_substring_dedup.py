"""Removal of repeated passages."""

import hashlib
import random

import numpy as np
import pytest

from freightlane.llm import substring_dedup as sd
from freightlane.llm.queries import op11_substring_dedup
from tests.llm.helpers import MESSY_SCHEMA, messy, no_rows, prose, words


def expected(texts, span):
    """(words, words removed, words kept) of every text."""
    split, seen = [words(t) for t in texts], {}
    for w in split:
        for i in range(len(w) - span + 1):
            key = tuple(w[i : i + span])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for w in split:
        gone = {i + j for i in range(len(w) - span + 1) if seen[tuple(w[i : i + span])] > 1 for j in range(span)}
        out.append((len(w), len(gone), [x for i, x in enumerate(w) if i not in gone]))
    return out


def digest(kept):
    return hashlib.sha256(" ".join(kept).encode()).hexdigest()


def found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=repr)


def wanted(rows, span):
    return sorted(((i, n, gone, digest(kept)) for (i, _), (n, gone, kept) in zip(rows, expected([t for _, t in rows], span), strict=True)), key=repr)


def test_query_against_brute_force(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = found(op11_substring_dedup(spark, folder))
    assert got == wanted(rows, 35) and sum(g for _, _, g, _ in got) > 0


@pytest.mark.parametrize("period", [*range(1, 16), 21])
def test_cover_meets_every_shift(period):
    cover = sd.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert len(sd.difference_cover(21)) == 5


@pytest.mark.parametrize(("span", "period"), [(6, 3), (6, 6), (8, 7), (5, 1)])
def test_random_texts_of_few_words(spark, span, period):
    draw = random.Random(span * 100 + period)
    texts = [" ".join(draw.choice("ab") if draw.random() < 0.8 else f"w{draw.randrange(9)}" for _ in range(draw.randrange(60))) for _ in range(60)]
    block = prose(span + 2)
    texts += [f"{prose(9, 100)} {block} {prose(3, 200)}", f"{block} x", f"y {block}", f"{prose(span - 1, 500)} 1", f"{prose(span - 1, 500)} 2", "a " * 50]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(sd.digests(docs, span=span, period=period)) == wanted(rows, span)
    kept = {r["doc_id"]: r["text"] for r in sd.without_repeats(docs, span=span, period=period).collect()}
    for i, (_, gone, rest) in enumerate(expected(texts, span)):
        assert kept[i] == (" ".join(rest) if gone else texts[i])


def test_a_third_of_all_rows_are_copies_and_one_text_is_long(spark):
    rows = [(i, prose(40)) for i in range(300)] + [(1000 + i, prose(60, 1000 * i + 100)) for i in range(300)]
    rows += [(2000 + i, f"{prose(40)} {prose(20, 900_000 + 100 * i)}") for i in range(300)] + [(5000, prose(30_000, 2_000_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(sd.digests(docs)) == wanted(rows, 35)


def test_hashes_of_windows_follow_their_words():
    w = [x.encode() for x in (prose(50) + " " + prose(50)).split()]
    one, other = sd.window_hashes(w, 7)
    assert np.array_equal(one[:44], one[50:]) and len(set(one.tolist())) == 50 and np.array_equal(other[:44], other[50:])
    assert len(sd.window_hashes(w[:6], 7)[0]) == 0


def test_messy_rows(spark):
    rows = messy(spark)
    pairs = [(r["doc_id"], r["text"]) for r in rows.collect()]
    assert found(sd.digests(rows)) == wanted(pairs, 35)
    out = sd.without_repeats(rows)
    assert out.dtypes == rows.dtypes and out.count() == rows.count()
    assert {r["text"] for r in out.collect() if r["doc_id"] == 1} == {""}
    assert sd.digests(no_rows(spark)).count() == 0 and sd.without_repeats(spark.createDataFrame([], MESSY_SCHEMA)).count() == 0
    text_ids = spark.createDataFrame([("a", prose(40)), ("b", prose(40)), ("c", "x")], "doc_id string, text string")
    assert [x[2] for x in found(sd.digests(text_ids))] == [40, 40, 0]
