"""Spelling variants by a dictionary of pairs of trie nodes.

All words are put into a trie and, reversed, into a second one, whose nodes have numbers. A word with a letter skipped is a
pair of numbers: the node of what stands before the letter, and the reversed trie's node of what stands behind it. A
word as it is, cut at some place, is such a pair too. Two words differ by one replaced letter if they share a pair with a letter
skipped in both, by one inserted or deleted letter if one's pair with a letter skipped is one of the other's cuts. In a run of
equal letters only the first one is skipped for the latter, so two near words share just one pair. Members of a pair
are told apart by the one letter skipped, so there are at most as many as letters; they are counted, never listed as pairs.

Tries are numbered in sorted order: words are sorted into ranges, and every range numbers the nodes that its words add to those
of the word before. Only prefixes that go on from one range into the next have numbers from the driver, which needs the
first and the last word of every range for that.

A word's form is its near word of largest count, if that is `ratio` times its own; forms are followed to the root by
pointer doubling (counts grow by the ratio with every step, so there are few).

Defined cases: a NULL or empty text has no runs; a NULL id is the empty text in the check sum; repeated rows count as often as
they stand there; ties go to the smallest word in code-point order; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlane.llm.common import text_of, written

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
#: The letters of a run; as many words can share a pair of nodes, and one more.
LETTERS = r"A-Za-zÀ-ÿ"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Numbers of a range's nodes begin at its own number times this.
_PER_RANGE = 1 << 40
_SKIP, _FIRST_OF_RUN, _CUT = 0, 1, 2


def runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, every: int | None = None) -> DataFrame:
    """word: every maximal run of at least min_length letters, A-Z lowered.

    With `every`, runs whose check sum (with the id) it divides lose one letter, as a known error to be found again.
    """
    found = F.regexp_extract_all(text_of(f"`{text}`"), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    words = docs.select(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    lowered = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _CAPITALS, _CAPITALS.lower())).otherwise(F.col("run"))
    words = words.withColumn("word", lowered)
    if every:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        words = words.withColumn("h", h)
        less = "concat(substring(word, 1, cast(h % length(word) AS int)), substring(word, cast(h % length(word) AS int) + 2))"
        words = words.withColumn("word", F.when(F.col("h") % every == 0, F.expr(less)).otherwise(F.col("word")))
    return words.select("word").filter(F.length("word") >= min_length)


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words that stand at least min_count times."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def shared_length(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def crossing_nodes(bounds: list[tuple[str, str]]) -> list[list[int]]:
    """For every range but the first, the numbers of the prefixes that its first word shares with the word before.

    bounds: first and last word of the ranges in order. Numbers begin at -1 downwards; 0 is the root.
    """
    numbers: dict[tuple[int, str], int] = {}
    found = []
    for (_, last), (first, _) in pairwise(bounds):
        path = [0]
        for letter in first[: shared_length(last, first)]:
            path.append(numbers.setdefault((path[-1], letter), -1 - len(numbers)))
        found.append(path)
    return found


class Numbering:
    """Numbers the trie nodes of one range's words, which come in order."""

    def __init__(self, place: int, last: str, before: list[int], after: list[int]) -> None:
        self.last, self.before, self.after = last, before, after
        self.next = self.first = place * _PER_RANGE
        self.word, self.nodes = "", [0]

    def nodes_of(self, word: str) -> list[int]:
        """The nodes of all prefixes of a word, the root's first."""
        known = shared_length(self.word, word)
        nodes = self.nodes[: known + 1]
        if len(self.before) > 1:
            # The range's first word goes on from the range before.
            nodes, self.before = self.before[: len(word) + 1], [0]
        if len(self.after) > len(nodes):
            ends = min(shared_length(word, self.last) + 1, len(self.after))
            nodes = nodes + self.after[len(nodes) : ends]
        while len(nodes) <= len(word):
            self.next += 1
            nodes.append(self.next)
        self.word, self.nodes = word, nodes
        return nodes


def numbered(words: DataFrame, forward: bool) -> DataFrame:
    """The rows (key: a word, others: longs) with the nodes of the key's prefixes; if forward, also `wid`, in the order of
    the keys, and whether each letter differs from the one before."""
    others = [c for c in words.columns if c != "key"]
    ranges = written(words.repartitionByRange("key").sortWithinPartitions("key").withColumn("place", F.spark_partition_id()), "sorted")
    bounds = ranges.groupBy("place").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("place").collect()
    crossing = [[0], *crossing_nodes([(b["first"], b["last"]) for b in bounds]), [0]]
    known = {b["place"]: (b["last"], crossing[i], crossing[i + 1]) for i, b in enumerate(bounds)}
    kinds = {"key": "string", **dict.fromkeys(others, "long"), "nodes": "array<long>"} | ({"wid": "long", "fresh": "array<boolean>"} if forward else {})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, numbering, wid = None, None, 0
        for batch in batches:
            nodes, wids, fresh = [], [], []
            for place, word in zip(batch["place"].to_pylist(), batch["key"].to_pylist(), strict=True):
                if place != at:
                    at, numbering, wid = place, Numbering(place, *known[place]), place * _PER_RANGE
                wid += 1
                nodes.append(numbering.nodes_of(word))
                if forward:
                    wids.append(wid)
                    fresh.append([x != y for x, y in zip(word, "\0" + word, strict=False)])
            made = [*[batch[c] for c in ("key", *others)], pa.array(nodes, pa.list_(pa.int64()))]
            made += [pa.array(wids, pa.int64()), pa.array(fresh, pa.list_(pa.bool_()))] if forward else []
            yield pa.RecordBatch.from_arrays(made, list(kinds))

    # A range is numbered by one task, in order.
    placed = ranges.repartition("place").sortWithinPartitions("place", "key").select("place", "key", *others)
    return placed.mapInArrow(number, ", ".join(f"{c} {kind}" for c, kind in kinds.items()))


def _pairs(words: DataFrame) -> DataFrame:
    """p, s, and what shares that pair of nodes: n, w (the word's number, negated, so that larger is earlier), kind."""
    length = F.size("fresh")
    skip = lambda i: F.struct(
        F.get("prefixes", i).alias("p"),
        F.get("suffixes", length - i - 1).alias("s"),
        F.when(F.get("fresh", i), _FIRST_OF_RUN).otherwise(_SKIP).alias("kind"),
    )
    cut = lambda i: F.struct(F.get("prefixes", i).alias("p"), F.get("suffixes", length - i).alias("s"), F.lit(_CUT).alias("kind"))
    both = F.concat(F.transform(F.sequence(F.lit(0), length - 1), skip), F.transform(F.sequence(F.lit(0), length), cut))
    return words.select(F.explode(both).alias("x"), "n", F.negate("wid").alias("w")).select("x.p", "x.s", "n", "w", "x.kind")


def near_words(words: DataFrame) -> DataFrame:
    """w, n_near, best (n, w of the near word of largest count) of every word that has near words."""
    members = _pairs(words).groupBy("p", "s").agg(F.collect_list(F.struct("n", "w", "kind")).alias("members")).filter(F.size("members") > 1)
    near = lambda m, x: (x["w"] != m["w"]) & (
        ((x["kind"] < _CUT) & (m["kind"] < _CUT)) | (x["kind"] + m["kind"] == _CUT + _FIRST_OF_RUN)
    )
    others = lambda m: F.filter("members", lambda x: near(m, x))
    seen = F.transform("members", lambda m: F.struct(m["w"].alias("w"), others(m).alias("near")))
    each = members.select(F.explode(seen).alias("m")).select("m.w", "m.near").filter(F.size("near") > 0)
    each = each.select("w", F.size("near").alias("n_near"), F.array_max("near").alias("best"))
    best = F.max(F.struct(F.col("best.n").alias("n"), F.col("best.w").alias("w")))
    return each.groupBy("w").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """wid -> root, the end of the way along the forms; forms: wid, form."""
    roots = forms.select("wid", F.col("form").alias("root"))
    while True:
        ends = roots.select(F.col("wid").alias("at"), F.col("root").alias("further"))
        moved = written(roots.join(ends, F.expr("root = at"), "left"), "roots")
        if moved.filter("further IS NOT NULL").isEmpty():
            return moved.select("wid", "root")
        roots = moved.select("wid", F.coalesce("further", "root").alias("root"))


def variants(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of counts (word, n)."""
    forward = numbered(counts.select(F.col("word").alias("key"), F.col("n").cast("long").alias("n")), True)
    forward = written(forward.select("wid", F.col("key").alias("word"), "n", F.col("nodes").alias("prefixes"), "fresh"), "prefixes")
    backward = numbered(forward.select(F.reverse("word").alias("key"), "wid"), False).select(F.col("wid").alias("of"), F.col("nodes").alias("suffixes"))
    joined = forward.join(backward, F.expr("wid = of")).select("wid", "n", "fresh", "prefixes", "suffixes")
    near = near_words(joined).select(F.negate("w").alias("of"), "n_near", F.col("best.n").alias("best_n"), F.negate("best.w").alias("best"))
    words = forward.select("wid", "word", "n").join(near, F.expr("wid = of"), "left")
    formed = F.col("best_n") >= ratio * F.col("n")
    words = words.withColumns({"form": F.when(formed, F.col("best")), "form_n": F.when(formed, F.col("best_n"))})
    words = written(words.select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form", "form_n"), "near")

    changed = words.filter("form IS NOT NULL").select("wid", "form")
    names = lambda of, name: words.select(F.col("wid").alias(of), F.col("word").alias(name))
    ways = changed.join(_roots(changed).withColumnRenamed("wid", "from"), F.expr("wid = from"))
    ways = ways.join(names("f", "form_word"), F.expr("form = f")).join(names("r", "root_word"), F.expr("root = r"))
    ways = ways.select(F.col("wid").alias("of"), "form_word", "root_word")
    out = words.join(ways, F.expr("wid = of"), "left")
    return out.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", F.col("n_near").cast("long").alias("n_near"), "form_n"
    )
