"""Benchmark decontamination by spaced-seed hashing.

A mask selects some of the positions of a window of words; the words at those positions are hashed, those at the others
are ignored, so a substituted word there does not break the hash. The hashes of the benchmark's windows are joined to
those of all documents' windows, for every mask. Hits are gathered by their diagonal, and document and item are compared word by word
on each diagonal once; an overlap is proven if some run of `window` aligned words (or the whole item, if shorter) agrees in at least
`agree` of them. MASKS, slid over any 13 words with two substitutions, or over an item of 9 to 12 words with as many as the
rule allows it, always have a place that none of them touches (tested by enumeration), so every pair that the rule proves
has a hit. Other values of `window` and `agree` need masks of their own for that.

An item with fewer words than the masks are long has masks of its own length, at whose only place the whole item is hashed:
without substitutions all its words, else all but some groups of its words, so that each choice of substituted words leaves
some mask untouched. `shortest` bounds the items that are looked for; overlaps() alone begins at the length of MASKS, clean()
and the query at one word. Documents are hashed by the masks of lengths that the benchmark has.

Defined cases: a NULL or empty text, and an item with fewer words than `shortest`, can have no overlap;
repeated rows and items each count as themselves, a pair of ids stands once; empty tables give no rows.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlane.llm.common import BROADCAST_ROWS, packed, small, text_of, tokens_of, written

#: 1 = the word at this place counts. Every mask selects five of nine words.
MASKS = ("110010101", "001110011", "101001101", "011101100")
WINDOW = 13
AGREE = 0.8
#: Seeds of the benchmark up to which they are broadcast; more are joined by a shuffle.
BLOCK_SEEDS = BROADCAST_ROWS
#: Bits of the filter that document seeds pass before the join: 2 MB, however large the benchmark is.
FILTER_BITS = 24


def short_masks(n: int, agree: float = AGREE) -> tuple[str, ...]:
    """Masks of an item of n words that are laid on all of it: each leaves out some of its groups of words.

    So many groups are left out as substitutions are allowed, of two more groups than that, and a substitution touches one.
    """
    gone = n - math.ceil(n * agree)
    groups = gone + 2 if gone else 1
    chosen = itertools.combinations(range(groups), gone)
    return tuple(dict.fromkeys("".join("0" if i % groups in out else "1" for i in range(n)) for out in chosen))


def _seed(mask: str, hashed, at: Column) -> Column:
    return F.xxhash64(F.lit(int(f"1{mask}", 2)), *[hashed(at + i) for i, on in enumerate(mask) if on == "1"])


def _placed(rows: DataFrame) -> DataFrame:
    """A row per place: `place`, `hashes` and `n` beside the columns of the rows. Masks need not fit there; a filter for
    that would split the texts once more to know how many words they have."""
    hashed = rows.withColumns({"hashes": F.transform("words", lambda w: F.xxhash64(w)), "n": F.size("words")}).drop("words")
    return hashed.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("n"))))


def _at(masks: tuple[str, ...], place: Column, fits) -> list[Column]:
    """The seeds of all masks at a place, NULL where one does not fit."""
    hashed = lambda i: F.get("hashes", i)
    return [F.when((place >= 0) & fits(m), _seed(m, hashed, place)) for m in masks]


def _seeds(placed: DataFrame, masks: tuple[str, ...], fits) -> DataFrame:
    """seed and `before` (the same mask's seed one place earlier) of every place, beside its columns."""
    here = _at(masks, F.col("place"), lambda m: fits(m, F.col("place")))
    earlier = _at(masks, F.col("place") - 1, lambda m: fits(m, F.col("place") - 1))
    both = F.array(*[F.struct(s.alias("seed"), e.alias("before")) for s, e in zip(here, earlier, strict=True)])
    return placed.withColumn("x", F.explode(both)).select("*", "x.*").drop("x", "hashes", "n").filter("seed IS NOT NULL")


def _may_be_known(seeds: DataFrame):
    """A test whether a seed may be among these: one bit for some of its bits, in one array of FILTER_BITS."""
    place = F.shiftrightunsigned("seed", 64 - FILTER_BITS)
    bits = seeds.select(F.shiftright(place, 6).alias("i"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int")).alias("bits"))
    every = seeds.sparkSession.range(1 << (FILTER_BITS - 6)).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("bits"))
    words = written(bits.unionByName(every).groupBy("i").agg(F.bit_or("bits").alias("bits")), "seed-bits")
    known = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "bits"))), lambda x: x["bits"]).alias("known"))

    def test(seed: Column) -> Column:
        word = F.get(known.scalar(), F.shiftrightunsigned(seed, 64 - FILTER_BITS + 6).cast("int"))
        bit = F.shiftrightunsigned(seed, 64 - FILTER_BITS).bitwiseAND(F.lit(63)).cast("int")
        return F.coalesce(F.getbit(word, bit) == 1, F.lit(False))

    return test


def _lengths(items: DataFrame, shortest: int | None, span: int) -> list[int]:
    """The lengths below the masks' that the benchmark's items have."""
    lengths = list(range(span if shortest is None else max(1, shortest), span))
    found = items.select(F.size("words")).filter(F.size("words").isin(lengths)).distinct()
    return sorted(r[0] for r in found.collect()) if lengths else []


def diagonals(docs: DataFrame, items: DataFrame, masks: tuple[str, ...], whole: tuple[str, ...], block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """id, hash (of documents), number (of items), diagonal: those with a seed in common, each once.

    docs: id, hash, words; items: number, words. Masks of `whole` lie on whole items only, but on every place of a document.
    """
    every = (*masks, *whole)
    fits_item = lambda m, at: (at == 0) & (F.col("n") == len(m)) if m in whole else at + len(m) <= F.col("n")
    fits = lambda m, at: at + len(m) <= F.col("n")
    of_items = _seeds(_placed(items.select("number", "words").distinct()), every, fits_item)
    of_items = written(of_items.select("number", F.col("place").alias("item_place"), "seed", F.col("before").alias("item_before")), "seeds")
    may = _may_be_known(of_items)
    placed = _placed(docs)
    hit = None
    for seed in _at(every, F.col("place"), lambda m: fits(m, F.col("place"))):
        hit = may(seed) if hit is None else hit | may(seed)
    seeds = _seeds(placed.filter(hit), every, fits).withColumnRenamed("seed", "doc_seed")
    # Where the seeds one place earlier agree too, the hit there stands for this one: a long overlap is one hit per mask.
    begins = F.expr("doc_seed = seed AND coalesce(before <> item_before, true)")
    joined = seeds.join(small(of_items, block_seeds), begins)
    return joined.select("id", "hash", "number", (F.col("place") - F.col("item_place")).alias("diagonal")).distinct()


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    masks: tuple[str, ...] = MASKS,
    window: int = WINDOW,
    agree: float = AGREE,
    block_seeds: int = BLOCK_SEEDS,
    shortest: int | None = None,
) -> DataFrame:
    """doc id, item id, first_word (in the document), n_agree, n_aligned, share (of the item): one row per pair with a proven overlap.

    The documents are hashed once. Their seeds pass a bit filter of the benchmark's, of fixed size, before they are joined to
    them; the benchmark's seeds and words are broadcast if a count finds them few, else joined by a shuffle. Only the texts
    of documents with hits are read again, and compared once per diagonal.
    """
    content = text_of(f"`{text}`")
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(content).alias("hash"), content.alias("text"))
    items = benchmark.select(F.col(f"`{item_column}`").alias("item"), tokens_of(text_of(item_text)).alias("words"))
    items = written(items.withColumn("number", F.xxhash64("item", "words")).distinct(), "items")
    whole = tuple(m for n in _lengths(items, shortest, max(map(len, masks))) for m in short_masks(n, agree))
    found = diagonals(texts.select("id", "hash", tokens_of(F.col("text")).alias("words")), items, masks, whole, block_seeds)
    found = written(found.withColumnsRenamed({"id": "of", "hash": "of_hash"}), "diagonals")

    same = F.expr("id <=> of AND hash = of_hash")
    wanted = texts.join(small(found.select("of", "of_hash").distinct()), same, "left_semi")
    there = wanted.select("id", "hash", tokens_of(F.col("text")).alias("words")).distinct()
    known = items.select(F.col("number").alias("item_number"), "item", F.col("words").alias("item_words"))
    pairs = there.join(small(found), same).join(_few_words(known), F.expr("number = item_number"))
    best = _proven(pairs, window, agree).groupBy("id", "item").agg(
        F.max(F.struct("n_agree", "n_aligned", F.negate("first_word").alias("earliest"), "share")).alias("best")
    )
    return best.select(
        F.col("id").alias(id_column),
        F.col("item").alias(item_column if item_column != id_column else f"benchmark_{item_column}"),
        F.negate("best.earliest").cast("long").alias("first_word"),
        F.col("best.n_agree").cast("long").alias("n_agree"),
        F.col("best.n_aligned").cast("long").alias("n_aligned"),
        F.col("best.share").alias("share"),
    )


def _few_words(items: DataFrame) -> DataFrame:
    """The items, to be broadcast if all their words are few, however they are spread over items."""
    words = items.agg(F.sum(F.size("item_words") + 8)).first()[0] or 0
    return F.broadcast(items) if words <= 8 * BROADCAST_ROWS else items


def _proven(pairs: DataFrame, window: int, agree: float) -> DataFrame:
    """Compares document and item along each diagonal.

    A run of words agrees well enough if it holds no more than so many substitutions, so it is enough to look how
    far apart the substitutions before and behind that many are.
    """
    # The part of the item that lies in the document.
    start = F.greatest(F.lit(0), F.negate("diagonal"))
    stop = F.least(F.size("item_words"), F.size("words") - F.col("diagonal"))
    aligned = pairs.withColumn("start", start).select(
        "id",
        "item",
        (F.col("diagonal") + F.col("start")).alias("first_word"),
        F.size("item_words").alias("n_item"),
        F.slice("words", F.col("diagonal") + F.col("start") + 1, stop - F.col("start")).alias("there"),
        F.slice("item_words", F.col("start") + 1, stop - F.col("start")).alias("here"),
    )
    differ = F.transform(F.zip_with("there", "here", lambda a, b: a != b), lambda x, i: F.when(x, i))
    length = F.least(F.lit(window), F.col("n_item"))
    allowed = F.col("length") - F.ceil(F.col("length") * agree)
    ends = F.concat(F.array(F.lit(-1)), F.array_compact(differ), F.array(F.size("here")))
    room = lambda x, i: F.coalesce(F.get("ends", i + F.col("allowed") + 1), F.col("n_aligned")) - x > F.col("length")
    return (
        aligned.withColumns({"ends": ends, "n_aligned": F.size("here"), "length": length})
        .withColumn("allowed", allowed.cast("int"))
        .filter(F.col("n_aligned") >= F.col("length"))
        .filter(F.array_max(F.transform("ends", room)))
        .withColumn("n_agree", F.col("n_aligned") + 2 - F.size("ends"))
        .select("id", "item", "first_word", "n_agree", "n_aligned", (F.col("n_agree") / F.col("n_item")).alias("share"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without a proven overlap; rows that share an id share the verdict, and a NULL id has its own.

    The ids of documents with overlaps are written, then broadcast if they are few.
    """
    # A row is known by its id and its text's hash, so ids that repeat with other texts are told apart.
    key = F.struct(F.col(f"`{id_column}`").alias("a"), F.xxhash64(text_of(text)).alias("b"))
    keyed = docs.select(key.alias("__key"), F.col(f"`{text}`").alias("text"))
    bad = overlaps(keyed, benchmark, "__key", "text", **{"shortest": 1, **options}).select(F.col("__key").alias("bad")).distinct()
    bad = written(bad.select("bad.a", "bad.b"), "leaks")
    rows = packed(docs, a=F.col(f"`{id_column}`"), b=F.xxhash64(text_of(text)))
    kept = rows.alias("r").join(small(bad).alias("x"), F.expr("r.a <=> x.a AND r.b = x.b"), "left_anti")
    return kept.select("row.*")
