"""License scan against brute force."""

import pytest

from freightlane.llm import license_scan as ls
from freightlane.llm.queries import op3_license_scan
from tests.llm.helpers import messy, no_rows, prose, tokens


def base(text):
    words = tokens(text)
    places, labels = [], set()
    for phrase, label in ls.PHRASES.items():
        parts = phrase.split()
        found = [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def facts(r):
    return r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01"])
def test_base_of_the_test_data(spark, table):
    place = f"/root/testdata/{table}"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{place}/documents.parquet").collect()}
    rows = op3_license_scan(spark, place).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert facts(r) == base(docs[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "")


def scanned(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.asDict() for r in sorted(ls.scan(frame).collect(), key=lambda r: r["doc_id"])]


def test_phrases(spark):
    texts = [
        "The MIT License, and the mit-license; MIT\nLICENSE",
        "GNU General Public License. general public, license general license public",
        "mit license mit license mit",
        "limit license mit licenses",
        "MİT LICENSE MIT LICENSE MIT LİCENSE",
        "mit license apache license",
    ]
    for r, text in zip(scanned(spark, texts), texts, strict=True):
        assert facts(r) == base(text)


def test_changed_notices(spark):
    words = ls.NOTICES["bsd"].split()
    exact = prose(30) + " " + " ".join(words) + " " + prose(20, 50)
    inserted = words[:8] + ["really"] + words[8:14] + words[15:]
    substituted = [w if i not in (6, 13) else "other" for i, w in enumerate(words)]
    partial = words[:6]
    rows = scanned(spark, [exact, " ".join(inserted), " ".join(substituted), " ".join(partial), " ".join(reversed(words))])
    assert [r["labels"] for r in rows] == ["bsd", "bsd", "bsd", "", ""]
    assert rows[0]["score"] == 1 and 0.6 <= rows[1]["score"] < 1
    assert all(r["n_base"] == 0 and r["first_word"] is None for r in rows)


def test_spans_of_far_diagonals_are_apart(spark):
    words = ls.NOTICES["mit"].split()
    halves = " ".join(words[:20]) + " " + prose(200) + " " + " ".join(words[20:])
    assert scanned(spark, [halves])[0]["labels"] in ("", "mit")
    twice = " ".join(words) + " " + prose(9) + " " + " ".join(words)
    assert scanned(spark, [twice])[0]["score"] == 1


def test_messy_rows(spark):
    rows = messy(spark)
    got = sorted(((r["doc_id"], facts(r)) for r in ls.scan(rows).collect()), key=repr)
    assert got == sorted(((r["doc_id"], base(r["text"])) for r in rows.collect()), key=repr)
    assert ls.scan(no_rows(spark)).count() == 0


def test_copies_and_repeated_rows_do_not_add_votes(spark):
    text = "x mit license y apache license"
    frame = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string")
    assert [facts(r) for r in ls.scan(frame).collect()] == [base(text)] * 4
