"""Token counts against the library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from freightlane.llm.queries import op4_token_counts
from freightlane.llm.token_count import Counter, Vocabulary, token_counts
from tests.llm.helpers import messy, no_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return Counter(Vocabulary.read(PATH))


def test_proven_strings_are_one_token(library, counter):
    proven = list(counter.vocabulary.proven)
    assert len(proven) > 30_000
    assert all(len(e) == 1 for e in library.encode_batch(proven[::7], add_special_tokens=False))


def test_random_texts(library, counter):
    draw = random.Random(3)
    letters = "aA bB'sS'll 1２²½éÉßİKΣσς\x1c\x1d\x85\xa0　\n\t漢字かな🙂👍🏽!?,.()ﬁǆ​\0ÅÅ"
    for _ in range(3000):
        text = "".join(draw.choice(letters) for _ in range(draw.randrange(30)))
        text += draw.choice(["", "", "<|endoftext|>", "<|startoftext|>x", "<|endoftext"])
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False)), repr(text)


def test_forgetting_changes_nothing(counter, library, monkeypatch):
    monkeypatch.setattr("freightlane.llm.token_count.REMEMBERED", 0)
    text = "unseenword anotherunseen thing"
    assert counter.count(text) == counter.count(text) == len(library.encode(text, add_special_tokens=False))


def test_query_against_the_library(spark, folder, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in op4_token_counts(spark, folder).collect():
        n = len(library.encode(docs[r["doc_id"]], add_special_tokens=False))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(docs[r["doc_id"]].encode()), n > 2048)


def test_messy_rows(spark, library):
    rows = messy(spark)
    got = sorted(map(tuple, token_counts(rows, PATH).collect()), key=repr)
    expected = []
    for r in rows.collect():
        text = r["text"] or ""
        n = len(library.encode(text, add_special_tokens=False))
        expected.append((r["doc_id"], len(text.encode()), n, n > 2048))
    assert got == sorted(expected, key=repr)
    assert token_counts(no_rows(spark), PATH).count() == 0


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises((ValueError, TypeError, KeyError)):
        Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json"))
