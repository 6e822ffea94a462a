"""Spelling variants."""

import random
import re
import zlib

import pytest

from freightlane.llm import spelling as sp
from freightlane.llm.queries import op12_spelling
from tests.llm.helpers import lower_ascii, messy, no_rows


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes one of the other."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def expected(counts, ratio=10):
    groups = {}
    for w in counts:  # near words share a word with one letter less
        for i in range(len(w)):
            groups.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        groups.setdefault(w, set()).add(w)
    partners = {w: set() for w in counts}
    for g in groups.values():
        for a in g:
            partners[a] |= {b for b in g if near(a, b)}
    forms = {}
    for w, found in partners.items():
        best = min(found, key=lambda b: (-counts[b], b), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            forms[w] = best
    rows = []
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        rows.append((w, forms.get(w), root, n, len(partners[w]), counts[forms[w]] if w in forms else None))
    return sorted(rows, key=repr)


def counted(docs, every=31):
    counts = {}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower_ascii(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if n >= 2}


def found(df):
    return sorted(((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("place", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, place):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{place}/documents.parquet").collect()]
    rows = expected(counted(docs))
    assert found(op12_spelling(spark, place)) == rows
    assert any(r[1] for r in rows) and any(r[4] > 1 for r in rows)


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "aéÿ"])
def test_all_words_of_few_letters(spark, letters):
    draw = random.Random(len(letters))
    counts = {"".join(draw.choice(letters) for _ in range(draw.randrange(1, 9))): draw.choice([2, 3, 20, 30, 300, 4000]) for _ in range(400)}
    assert found(sp.variants(frame(spark, counts))) == expected(counts)


def test_ranges_of_any_size_number_alike(spark):
    """Prefixes that go on through many ranges, words that are prefixes of others, one range per word."""
    draw = random.Random(5)
    stem = "internationalisation"
    counts = {stem[: draw.randrange(3, 21)] + "".join(draw.choice("abn") for _ in range(draw.randrange(4))): draw.randrange(2, 2000) for _ in range(300)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n, small in (("97", "false"), ("3", "false"), ("1", "true")):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", small)
        assert found(sp.variants(frame(spark, counts))) == expected(counts)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_numbers_of_nodes_are_one_per_prefix():
    words = sorted({"".join(random.Random(i).choices("abc", k=1 + i % 7)) for i in range(300)})
    for size in (1, 2, 7, 1000):
        ranges = [words[i : i + size] for i in range(0, len(words), size)]
        crossing = [[0], *sp.crossing_nodes([(r[0], r[-1]) for r in ranges]), [0]]
        nodes = {}
        for i, r in enumerate(ranges):
            numbering = sp.Numbering(i, r[-1], crossing[i], crossing[i + 1])
            for w in r:
                for k, node in enumerate(numbering.nodes_of(w)):
                    assert nodes.setdefault(w[:k], node) == node
        assert len(set(nodes.values())) == len(nodes)


def test_a_form_with_very_many_variants_and_ties(spark):
    word = "abcdefgh"
    counts = {word: 10_000, "abcdefgi": 10_000}
    for i in range(len(word) + 1):
        for c in "abcdefghijklmnopqrstuvwxyz":
            counts.setdefault(word[:i] + c + word[i:], 2)
            counts.setdefault(word[:i] + c + word[i + 1 :], 1000)
    counts |= {"zyxwvutsr": 2, "zyxwvutsrq": 20, "zyxwvutsrqp": 200, "zyxwvutsrqpo": 2000, "zyxwvutsrqpon": 20_000}
    assert found(sp.variants(frame(spark, counts))) == expected(counts)


def test_long_runs(spark):
    counts = {"a" * 3000: 2, "a" * 3001: 30, "a" * 1500 + "b" + "a" * 1499: 4, "é" * 40: 5}
    assert found(sp.variants(frame(spark, counts))) == expected(counts)


def test_messy_rows(spark):
    rows = messy(spark).select("*").unionByName(messy(spark))
    odd = [(None, "Straßenbahn Straßenbahnen straßenbahn", *["x"] * 5), (3, "ÀÉÎabcde Àéîabcde àÉÎABCDE × abcdefg÷hijklmn", *["x"] * 5)]
    rows = spark.createDataFrame(odd * 40, "doc_id long, text string, word string, wid string, n string, key string, place string")
    docs = [(r["doc_id"], r["text"]) for r in rows.collect()]
    assert found(sp.variants(sp.vocabulary(sp.runs(rows, every=3)))) == expected(counted(docs, 3))
    for few in (messy(spark), no_rows(spark)):
        docs = [(r["doc_id"], r["text"]) for r in few.collect()]
        assert found(sp.variants(sp.vocabulary(sp.runs(few)))) == expected(counted(docs, None))
