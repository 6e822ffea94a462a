"""Mixing sources to target weights by hash-threshold histograms.

Every document has a size (words) and a hash. A source's budget is met by whole passes over it, plus the documents whose
hash lies below a threshold. The threshold is found without sorting: sizes are summed by source and hash bucket, the
bucket in which the budget ends is the boundary, and only its documents are summed again by the next bits of the hash,
until the boundary is one hash value. Thresholds of larger budgets nest, so a larger mix holds a smaller one.

Defined cases: a NULL text has size 0; NULL is a source of its own, last in order; repeated rows (same id and text) share
a hash, and those at a threshold are told apart by their number, so a target is missed by half a document at most; a document without words counts as taken 0 words; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freightlane.llm.common import count_words, packed, small, text_of, unpacked, written

WEIGHTS = (5, 2, 1)
BUDGET = 1.5  # of all sizes
PASSES = 2  # at most, over any document
#: Bits of the 63-bit hash that each level of the histogram resolves: a source has 512 buckets at a time.
LEVELS = (9, 9, 9, 9, 9, 9, 9)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, passes: int = PASSES) -> DataFrame:
    """source, source_size -> also `target`: the budget shared by weight, no target above `passes` times its size.

    One row per source, in order of the sources' code points, gives the weights. Sources fill up in order of their limit
    per weight; the level at which the rest of the budget meets the rest of the weights holds for all others.
    """
    everything = Window.partitionBy(F.lit(1))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    before = everything.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    level = (F.col("budget") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    return (
        sizes.withColumns({"weight": weight, "most": F.col("source_size") * F.lit(float(passes))})
        .withColumns({"ratio": F.col("most") / F.col("weight"), "budget": F.sum("source_size").over(everything) * F.lit(budget)})
        .withColumn("level", level)
        .withColumn("open", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
        .withColumn("target", F.when(F.col("level") <= F.col("ratio"), F.col("open") * F.col("weight")).otherwise(F.col("most")))
        .select("source", "source_size", "target")
    )


def _bucket(level: int) -> Column:
    """The hash down to the bits that the first levels resolve."""
    return F.shiftright("hashed", 63 - sum(LEVELS[: level + 1]))


def thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """source -> the hash below which documents are taken once more, and `some`: how many of the copies that have just that hash.

    rows: source, size, hashed; wanted: source, need. Each level sums the rows of the boundary bucket only, which it writes for
    the next one. At the last one the boundary value itself is taken if that brings the sum nearer to the need, or as many of its copies
    as do. Sources whose need covers them all have no boundary and no row here.
    """
    state = wanted.select("source", "need", F.lit(0).cast("long").alias("prefix"))
    for level in range(len(LEVELS)):
        inside = rows.alias("r").join(small(state).alias("s"), F.expr("r.source <=> s.source"))
        if level:
            inside = inside.filter(_bucket(level - 1) == F.col("prefix"))
            rows = written(inside.select("r.source", "r.size", "hashed"), "mix-boundary")
            inside = rows.alias("r").join(small(state).alias("s"), F.expr("r.source <=> s.source"))
        sums = inside.groupBy(F.col("r.source").alias("source"), _bucket(level).alias("bucket")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"), F.first("need").alias("need")
        )
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        state = written(
            sums.withColumn("upto", F.sum("size").over(upto))
            .filter(F.col("upto") > F.col("need"))
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "upto", "size", "need", "rows")).alias("b"))
            .select(
                "source",
                (F.col("b.need") - (F.col("b.upto") - F.col("b.size"))).alias("need"),
                F.col("b.bucket").alias("prefix"),
                F.col("b.size").alias("last"),
                F.col("b.rows").alias("rows"),
            ),
            "mix-level",
        )
    # What is left at the last level is one row, or copies of it, of which some are taken.
    some = F.round(F.col("need") * F.col("rows") / F.col("last")).cast("long")
    every = F.col("prefix") + F.when(some >= F.col("rows"), 1).otherwise(0)
    return state.select("source", every.alias("threshold"), F.when((some > 0) & (some < F.col("rows")), some).alias("some"))


def _planned(docs: DataFrame, id_column: str, text: str, source: str, weights, budget, passes, carry) -> DataFrame:
    keys = {
        "source": F.col(f"`{source}`").cast("string"),
        "size": count_words(text_of(text)),
        "hashed": F.shiftrightunsigned(F.xxhash64(F.col(f"`{id_column}`"), text_of(text)), 1),
    }
    rows = packed(docs, **keys)
    if carry is not None:
        rows = rows.withColumn("row", F.struct(*[F.col("row").getField(c).alias(c) for c in carry]))
    # Sizes and hashes alone are written; the rows are read again at the end, so their texts take no work space.
    light = written(rows.select("source", "size", "hashed"), "mix-rows")
    sizes = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = written(targets(sizes, weights, budget, passes), "mix-targets")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goals = goals.withColumn("full", F.least(F.floor(share), F.lit(passes)).cast("int"))
    goals = goals.withColumn("need", F.col("target") - F.col("full") * F.col("source_size"))
    below = thresholds(light, goals.filter("need > 0"))
    plan = goals.alias("g").join(small(below).alias("b"), F.expr("g.source <=> b.source"), "left")
    # Without a threshold a source's need is nothing, or all that it has.
    once_more = F.expr("CASE WHEN threshold IS NOT NULL THEN hashed < threshold ELSE need > 0 END")
    copies = F.least(F.col("full") + once_more.cast("int"), F.lit(passes))
    plan = written(plan.select("g.source", "source_size", "target", "full", "need", "threshold", "some"), "mix-plan")
    joined = rows.alias("r").join(small(plan).alias("p"), F.expr("r.source <=> p.source"))
    names = ("row", "size", "source_size", "target")
    if plan.filter("some IS NOT NULL").isEmpty():
        return joined.select(*names, copies.alias("copies"))
    at_threshold = F.expr("some IS NOT NULL AND hashed = threshold")
    others = joined.filter(~F.coalesce(at_threshold, F.lit(False))).select(*names, copies.alias("copies"))
    return others.unionByName(_some_copies(joined.filter(at_threshold).select("r.source", *names[1:], "row", "full", "some")).select(*others.columns))


def _some_copies(rows: DataFrame) -> DataFrame:
    """Rows at their source's threshold: `some` of them are taken once more, in order of their contents.

    Equal rows are counted, so a source may have very many; any of them gives the same mix.
    """
    same = rows.withColumn("contents", F.xxhash64(F.to_json("row"))).groupBy("source", "contents", F.to_json("row").alias("json")).agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("row", "size", "source_size", "target", "full", "some")]
    )
    before = Window.partitionBy("source").orderBy("contents", "json").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.least(F.col("n"), F.greatest(F.lit(0), F.col("some") - F.coalesce(F.sum("n").over(before), F.lit(0))))
    each = same.withColumn("taken", taken).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return each.withColumn("copies", (F.col("full") + F.when(F.col("nth") <= F.col("taken"), 1).otherwise(0)).cast("int"))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    passes: int = PASSES,
    carry: list[str] | None = None,
) -> DataFrame:
    """The documents (all columns, or those to carry) with size, source_size, target and `copies`: how often each is taken."""
    planned = _planned(docs, id_column, text, source, weights, budget, passes, carry)
    return unpacked(planned, "size", "source_size", "target", "copies")


def mixed(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    passes: int = PASSES,
) -> DataFrame:
    """The mix itself: every document with the columns it had, as often as it is taken."""
    planned = _planned(docs, id_column, text, source, weights, budget, passes, None).filter("copies > 0")
    return planned.select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("row.*")
