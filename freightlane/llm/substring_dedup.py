"""Removal of passages that stand more than once, by difference-cover anchors.

A difference cover of a period holds, for every shift, two places that are that shift apart. So two equal windows of `span`
words, wherever they begin, hold a pair of anchors (shorter windows at cover places, counted modulo the period) at the
same place of both. Steps:

1. only the anchors of every document are hashed, 5 of 21 places, and counted; those with an equal one elsewhere are hits;
2. every hit is extended to all windows of `span` words that hold it; these are hashed by 128 bits, and a window whose
   hash stands once only is dropped again;
3. the words of the windows that are left are removed from the texts.

A hit costs the windows around it, never pairs of places. Equal texts are worked on once: a text that stands twice
is repeated as a whole. Windows are judged on the input. Anchors that agree by chance only cost time; two different windows
would have to agree in 128 bits to be taken as equal.

Defined cases: a NULL text has no words; a text with fewer words than a window keeps all of them; repeated rows are repeated
texts, so their windows go from each of them; ids may repeat or be NULL; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlane.llm.common import dropped, packed, small, text_of, written

SPAN = 35
PERIOD = 21
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def difference_cover(period: int) -> tuple[int, ...]:
    """The first smallest set of places whose differences take every value modulo the period."""
    size = 1
    while True:
        for rest in itertools.combinations(range(1, period), size - 1):
            places = (0, *rest)
            if len({(a - b) % period for a in places for b in places}) == period:
                return places
        size += 1


def _inverse_powers(base: np.uint64, n: int) -> np.ndarray:
    return _powers(np.uint64(pow(int(base), -1, 1 << 64)), n)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def words_of(text: str | None) -> list[bytes]:
    # Splitting of bytes knows ASCII white space only, which is the definition of a word here.
    return (text or "").encode("utf-8", "surrogatepass").split()


def window_hashes(words: list[bytes], length: int, halves: int = 2) -> list[np.ndarray]:
    """Hashes of all windows of `length` words, 64 bits each of a half: sums of word hashes times powers of a base."""
    n = len(words)
    if n < length:
        return [np.empty(0, dtype=np.uint64)] * halves
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), dtype="<u8").reshape(n, 2)
    found = []
    for base, hashes in list(zip(_BASES, digests.T, strict=True))[:halves]:
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * _powers(base, n), dtype=np.uint64)])
        found.append((sums[length:] - sums[:-length]) * _inverse_powers(base, n - length + 1))
    return found


class Cover:
    """Where the anchors of a document stand, and which windows hold which of them."""

    def __init__(self, span: int, period: int) -> None:
        self.span, self.period = span, period
        #: So long that every window holds whole anchors at all cover places of a period.
        self.length = span - period + 1
        if self.length < 1:
            raise ValueError("the period must not be longer than a window")
        self.places = np.array(difference_cover(period), dtype=np.int64)

    def anchors(self, n_words: int) -> np.ndarray:
        """The places of the anchors in a document of so many words, none if it has no window."""
        if n_words < self.span:
            return np.empty(0, dtype=np.int64)
        firsts = np.arange(0, n_words - self.length + 1, self.period, dtype=np.int64)
        places = (firsts[:, None] + self.places).ravel()
        return places[places <= n_words - self.length]

    def around(self, hits: np.ndarray, n_words: int) -> np.ndarray:
        """The places of all windows that hold one of the anchors (numbers of anchors, in any order)."""
        at = self.anchors(n_words)[np.sort(hits)]
        last = n_words - self.span
        change = np.zeros(n_words + 1, dtype=np.int64)
        np.add.at(change, np.maximum(at - (self.span - self.length), 0), 1)
        np.add.at(change, np.minimum(at, last) + 1, -1)
        return np.flatnonzero(np.cumsum(change)[: last + 1])


def covered(starts: np.ndarray, n_words: int, span: int) -> np.ndarray:
    """Whether each word lies in one of the windows."""
    change = np.zeros(n_words + 1, dtype=np.int64)
    change[starts] += 1
    np.subtract.at(change, np.minimum(starts + span, n_words), 1)
    return np.cumsum(change)[:n_words] > 0


def _keys(id_column: str, text: str) -> dict[str, Column]:
    """A document's identity: its id and 128 bits of its text."""
    content = text_of(f"`{text}`")
    return {"id": F.col(f"`{id_column}`"), "a": F.xxhash64(content), "b": F.xxhash64(F.lit(PERIOD), content)}


def _light(docs: DataFrame, id_column: str, text: str, cover: Cover) -> DataFrame:
    """id, a, b, n_words, whole (digest of all words) and the hashes of the anchors in order; `place` numbers the rows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                counts, digests, anchors = [], [], []
                for value in part["text"]:
                    words = words_of(value.as_py())
                    counts.append(len(words))
                    digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    found = window_hashes(words, cover.length, 1)[0]
                    anchors.append(found[cover.anchors(len(words))].view(np.int64))
                ends = np.cumsum([0, *map(len, anchors)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(anchors)))
                made = [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), lists]
                yield pa.RecordBatch.from_arrays([part[c] for c in ("id", "a", "b")] + made, ["id", "a", "b", "n_words", "whole", "anchors"])

    rows = docs.select(*[v.alias(k) for k, v in _keys(id_column, text).items()], F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(read, f"id {kind}, a long, b long, n_words long, whole string, anchors array<long>")
    return written(found.withColumn("place", F.monotonically_increasing_id()), "anchors")


def _hits(nodes: DataFrame) -> DataFrame:
    """place -> numbers of the anchors that stand elsewhere too."""
    placed = nodes.select("place", F.posexplode("anchors").alias("nth", "anchor"))
    counts = placed.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counts = written(counts.select(F.col("anchor").alias("repeated")), "repeated")
    found = placed.join(counts, F.expr("anchor = repeated"))
    return found.groupBy("place").agg(F.collect_list("nth").alias("hits"))


def _windows(texts: DataFrame, cover: Cover) -> DataFrame:
    """place, start and the two halves of the hash of every window around a hit."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, text, hits in zip(batch["place"], batch["text"], batch["hits"], strict=True):
                words = words_of(text.as_py())
                starts = cover.around(hits.values.to_numpy(zero_copy_only=False), len(words))
                one, other = window_hashes(words, cover.span)
                made = [np.full(len(starts), place.as_py()), starts, one[starts].view(np.int64), other[starts].view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["place", "start", "one", "other"])

    return texts.select("place", "text", "hits").mapInArrow(read, "place long, start long, one long, other long")


def _cleaned(texts: DataFrame, cover: Cover, kind: str) -> DataFrame:
    """place, n_removed and, by `kind`, the digest of the words that stay or their text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, removed, made = [], [], []
            for place, text, hits, single in zip(*[batch[c] for c in ("place", "text", "hits", "single")], strict=True):
                words = words_of(text.as_py())
                starts = cover.around(hits.values.to_numpy(zero_copy_only=False), len(words))
                if single.is_valid:
                    starts = np.setdiff1d(starts, single.values.to_numpy(zero_copy_only=False), assume_unique=True)
                gone = covered(starts, len(words), cover.span)
                rest = b" ".join(itertools.compress(words, ~gone))
                places.append(place.as_py())
                removed.append(int(gone.sum()))
                made.append(hashlib.sha256(rest).hexdigest() if kind == "kept_sha256" else rest.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(removed, pa.int64()), pa.array(made, pa.string())], ["place", "n_removed", kind])

    return texts.select("place", "text", "hits", "single").mapInArrow(read, f"place long, n_removed long, {kind} string")


def _found(docs: DataFrame, id_column: str, text: str, span: int, period: int, kind: str) -> tuple[DataFrame, DataFrame]:
    """The documents with their keys, n_words, whole, `n` (rows of that text) and place; and place -> n_removed and `kind`."""
    cover = Cover(span, period)
    light = _light(docs, id_column, text, cover)
    copies = light.groupBy("a", "b").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = written(copies.select(F.col("a").alias("copy_a"), F.col("b").alias("copy_b"), "first", "n"), "copies")
    nodes = light.join(small(copies), F.expr("a = copy_a AND b = copy_b"), "left")
    firsts = nodes.filter("first IS NULL OR place = first")
    marked = firsts.select("place", "id", "a", "b", "n").join(_hits(firsts.select("place", "anchors")), "place")
    marked = written(marked, "hits").select("place", "hits", "n", F.struct("id").alias("of"), F.col("a").alias("of_a"), F.col("b").alias("of_b"))
    # The anchors are done with, and larger than all that is kept beside them.
    nodes = written(nodes.drop("anchors", "copy_a", "copy_b", "first"), "nodes")
    dropped(light)

    keys = _keys(id_column, text)
    texts = docs.select(F.struct(keys["id"].alias("id")).alias("key"), keys["a"].alias("a"), keys["b"].alias("b"), text_of(f"`{text}`").alias("text"))
    same = F.expr("a = of_a AND b = of_b AND key <=> of")
    # Texts with hits move once; all that follows reads them from here.
    texts = written(texts.join(marked, same).select("place", "text", "hits", "n"), "hit-texts")
    # A window stands once if no other row has its hash; those carry their own place, so nothing is joined back.
    windows = _windows(texts, cover)
    single = windows.groupBy("one", "other").agg(F.count(F.lit(1)).alias("seen"), F.min("place").alias("at"), F.min("start").alias("start"))
    single = written(single.filter("seen = 1").groupBy("at").agg(F.collect_list("start").alias("single")), "single")
    # Texts that stand more than once are repeated as wholes and need no look at their windows.
    left = texts.filter("n IS NULL").join(single, F.expr("place = at"), "left")
    return nodes, written(_cleaned(left, cover, kind).filter("n_removed > 0"), "removed")


def digests(docs: DataFrame, id_column: str = "doc_id", text: str = "text", span: int = SPAN, period: int = PERIOD) -> DataFrame:
    """id, n_words, n_removed and kept_sha256 (of the words that stay, joined by one space) of every document."""
    nodes, found = _found(docs, id_column, text, span, period, "kept_sha256")
    found = found.select(F.col("place").alias("at"), "n_removed", "kept_sha256")
    out = nodes.select("place", "id", "n_words", "whole", "n").join(small(found), F.expr("place = at"), "left")
    all_gone = (F.col("n") > 1) & (F.col("n_words") >= span)
    return out.select(
        F.col("id").alias(id_column),
        "n_words",
        F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(all_gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", span: int = SPAN, period: int = PERIOD) -> DataFrame:
    """The documents, all columns, with the words of repeated windows cut from their texts. Texts that lose words come out
    with one space between words, the others as they were."""
    nodes, found = _found(docs, id_column, text, span, period, "kept")
    gone = F.when((F.col("n") > 1) & (F.col("n_words") >= span), F.lit("")).otherwise(F.col("kept"))
    cut = nodes.select("place", "id", "a", "b", "n", "n_words").join(found.select(F.col("place").alias("at"), "kept"), F.expr("place = at"), "left")
    cut = cut.select(F.struct("id").alias("of"), F.col("a").alias("of_a"), F.col("b").alias("of_b"), gone.alias("new")).filter("new IS NOT NULL")
    cut = written(cut.dropDuplicates(["of", "of_a", "of_b"]), "cut")
    keys = _keys(id_column, text)
    rows = packed(docs, key=F.struct(keys["id"].alias("id")), a=keys["a"], b=keys["b"])
    joined = rows.join(cut, F.expr("a = of_a AND b = of_b AND key <=> of"), "left")
    fields = [F.coalesce("new", f"row.`{c}`").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    return joined.select(*fields)
