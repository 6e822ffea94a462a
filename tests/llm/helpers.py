"""Small tables with everything that real ones hold, and helpers of the tests."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(text or "")


def tokens(text):
    return TOKEN.findall(lower_ascii(text or ""))


def prose(n, start=0):
    """n different words."""
    return " ".join(f"w{start + i}x" for i in range(n))


MESSY_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, kept string, size string, host string,"
    " shard string, words string, id string, bucket int, place string"
)


def messy(spark):
    """NULLs in every column, empty and odd texts, repeated rows, ties, and columns named like those that operators add."""
    extra = ("r", "k", "s", "h", "sh", "w", "i", 1, "p")
    rows = [
        (1, prose(60), "en", "a", 5, *extra),
        (1, prose(60), "en", "a", 5, *extra),
        (2, None, "en", "a", 0, *extra),
        (3, "", None, "b", 0, *extra),
        (4, " \n\t ", "en", None, 3, *extra),
        (None, prose(70, 500), "en", "b", 9, *[None] * 9),
        (5, None, None, None, None, *[None] * 9),
        (6, "one", "en", "", 3, *extra),
        (7, "one", "en", "c", 3, *extra),
        (8, prose(55, 100) + " É İ K 漢字 \x1c 🙂", "en", "c", 3, *extra),
        (9, prose(3000, 10_000), "en", "d", 3, *extra),
    ]
    return spark.createDataFrame(rows, MESSY_SCHEMA)


def no_rows(spark):
    return spark.createDataFrame([], MESSY_SCHEMA)


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}
