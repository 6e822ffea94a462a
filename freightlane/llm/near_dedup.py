"""Near-duplicate documents by SuperMinHash, banding, verification on full shingle sets, and union-find grouping.

Documents with equal shingle sets are one node, known by its smallest id. Nodes whose signatures agree in a whole band
share a bucket. No bucket's pairs are listed as such:

1. every node is compared with one bucket leader (smallest id), the one it shares most buckets with; linked nodes unite;
2. nodes are compared with their other leaders, where these are in another component;
3. what is left of a bucket outside its largest component is compared with all nodes of the bucket in other components,
   a block of nodes against a block of nodes; only links leave a block, never its pairs.

So every two nodes of a bucket are compared or already connected, and large groups of copies cost about one comparison
per member. Pairs of step 2 whose signatures or sizes rule out a link (by six standard deviations) are left out; all
links are confirmed on full sets. Two sets of similarity 0.8 share no bucket with a probability of 5e-6.

Defined cases: a document without words or with NULL text is linked with nothing; one with fewer words than a shingle has
its whole sequence as its shingle; rows that share an id but not the text are grouped text by text; rows without an id
are linked with nothing and kept; repeated rows have the same result each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlane.llm.common import packed, small, text_of, written
from freightlane.llm.components import components
from freightlane.llm.superminhash import band_keys, set_key, shingle_set, short_signature, signatures

SHINGLE = 5
SIMILARITY = 80  # per cent
PER_BAND = 6
#: Two sets of just the similarity asked for share no band with about this probability.
MISSED = 5.5e-6
#: Nodes of a bucket that are compared with as many others at a time.
BLOCK_NODES = 500
#: Ids alone are small: so many of them are broadcast.
ID_ROWS = 1_000_000


def bands_for(similarity: int) -> int:
    """How many bands of PER_BAND values find that similarity; 40 for 80 per cent."""
    return math.ceil(math.log(MISSED) / math.log1p(-min(similarity / 100, 0.999) ** PER_BAND))


def signed(docs: DataFrame, k: int, bands: int, id_column: str, text: str) -> DataFrame:
    """id, n_shingles, set_key, bands and signature of every document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t.as_py(), k) for t in part["text"]]
                rows = signatures(sets, bands * PER_BAND)
                keys, short = band_keys(rows, bands, PER_BAND), short_signature(rows)
                of = lambda values: [v if len(s) else None for v, s in zip(values, sets, strict=True)]  # noqa: E731, B023
                made = [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(of(map(set_key, sets)), pa.binary()),
                    pa.array(of(keys), pa.list_(pa.int64())),
                    pa.array(of(x.tobytes() for x in short), pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([part["id"], *made], ["id", "n_shingles", "set_key", "bands", "signature"])

    schema = "id long, n_shingles long, set_key binary, bands array<long>, signature binary"
    return _rows(docs, id_column, text).mapInArrow(sign, schema)


def _rows(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))


def verified(pairs: DataFrame, texts: DataFrame, k: int, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    Only the texts of these pairs' documents are moved.
    """
    wanted = written(pairs.select(F.col("a").alias("wanted")).union(pairs.select("b")).distinct(), "wanted")
    chosen = texts.join(small(wanted, ID_ROWS), F.expr("id = wanted"), "left_semi").dropDuplicates(["id", "text"])
    chosen = written(chosen, "wanted-texts")
    one = chosen.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    other = chosen.select(F.col("id").alias("b"), F.col("text").alias("text_b"))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last_text, last_set = None, None
        for frame in frames:
            good = np.zeros(len(frame), dtype=bool)
            for i, (x, y) in enumerate(zip(frame["text_a"], frame["text_b"], strict=True)):
                if x != last_text:
                    last_text, last_set = x, shingle_set(x, k)
                s = shingle_set(y, k)
                both = len(np.intersect1d(last_set, s, assume_unique=True))
                good[i] = both > 0 and 100 * both >= similarity * (len(last_set) + len(s) - both)
            yield frame.loc[good, ["a", "b"]]

    joined = pairs.join(other, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInPandas(compare, "a long, b long").distinct()


def _may_link(pairs: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    """Pairs whose sizes and signatures allow the similarity; an estimate six standard deviations below it does not."""
    slots = bands_for(similarity) * PER_BAND
    s = similarity / 100
    least = slots * s - 6 * (slots * s * (1 - s)) ** 0.5

    def estimate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                one = np.frombuffer(b"".join(frame["sig_a"]), dtype=np.uint16).reshape(len(frame), slots)
                other = np.frombuffer(b"".join(frame["sig_b"]), dtype=np.uint16).reshape(len(frame), slots)
                yield frame.loc[(one == other).sum(axis=1) >= least, ["a", "b"]]

    known = lambda x: nodes.select(
        F.col("id").alias(x), F.col("signature").alias(f"sig_{x}"), F.col("n_shingles").alias(f"n_{x}")
    )
    joined = pairs.join(known("a"), "a").join(known("b"), "b")
    near = f"100 * least(n_a, n_b) >= {similarity} * greatest(n_a, n_b)"
    return joined.filter(near).select("a", "b", "sig_a", "sig_b").mapInPandas(estimate, "a long, b long").distinct()


def _labelled(pairs: DataFrame, roots: DataFrame, column: str, label: str) -> DataFrame:
    known = roots.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    joined = pairs.join(known, F.col(column) == F.col("__node"), "left")
    return joined.withColumn(label, F.coalesce("__root", column)).drop("__node", "__root")


def _united(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components after links (a, b) between nodes are added."""
    links = written(links, "links")
    if links.isEmpty():
        return roots
    across = _labelled(_labelled(links, roots, "a", "x"), roots, "b", "y").select(F.col("x").alias("node"), F.col("y").alias("root"))
    return written(components(across.unionByName(roots)), "roots")


def groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", k: int = SHINGLE, similarity: int = SIMILARITY
) -> DataFrame:
    """One row per document: the id, n_shingles and component_id, the smallest id of its group (NULL without an id)."""
    light = written(signed(docs, k, bands_for(similarity), id_column, text), "signed")
    named = light.filter("n_shingles > 0 AND id IS NOT NULL")
    copies = named.groupBy("set_key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = written(copies.filter("n > 1").select(F.col("set_key").alias("copy_key"), "first"), "copies")
    keys = F.expr("set_key = copy_key")
    nodes = named.join(small(copies), keys, "left").filter("first IS NULL OR id = first")
    nodes = nodes.select("id", "n_shingles", "bands", "signature")
    texts = _rows(docs, id_column, text)

    places = nodes.select("id", F.explode("bands").alias("bucket"))
    leaders = places.groupBy("bucket").agg(F.min("id").alias("leader"), F.max("id").alias("highest"))
    leaders = written(leaders.filter("leader < highest").select(F.col("bucket").alias("of"), "leader"), "buckets")
    members = written(places.join(small(leaders, ID_ROWS), F.expr("bucket = of")).select("bucket", "id", "leader"), "members")

    stars = members.filter("id <> leader").groupBy(F.col("leader").alias("a"), F.col("id").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    stars = written(stars, "stars")
    best = stars.groupBy("b").agg(F.max(F.struct("n", F.negate("a").alias("a"))).alias("m")).select(F.negate("m.a").alias("a"), "b")
    links = verified(best, texts, k, similarity)
    roots = written(components(links.select(F.col("b").alias("node"), F.col("a").alias("root"))), "roots")

    apart = _labelled(_labelled(stars.select("a", "b"), roots, "a", "x"), roots, "b", "y").filter("x <> y").select("a", "b")
    apart = written(apart.join(best.select("a", "b"), ["a", "b"], "left_anti"), "apart")
    roots = _united(roots, verified(written(_may_link(apart, nodes, similarity), "maybe"), texts, k, similarity))

    left = written(_block_links(_open(members, roots), texts, k, similarity), "left")
    roots = _united(roots, verified(left, texts, k, similarity))

    placed = light.select("id", "n_shingles", "set_key").join(small(copies), keys, "left")
    node = F.when(F.col("id").isNotNull(), F.coalesce("first", "id"))
    placed = placed.withColumn("node", node).select("id", "n_shingles", "node")
    return _labelled(placed, roots, "node", "component_id").select(F.col("id").alias(id_column), "n_shingles", "component_id")


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes of buckets with several components: bucket, id, root, whether it is outside the largest one (`few`), and
    how many blocks the bucket's nodes (`blocks`) and its few (`few_blocks`) make."""
    labelled = _labelled(members.select("bucket", "id"), roots, "id", "root").distinct()
    parts = labelled.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    buckets = parts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("largest")
    )
    buckets = buckets.filter("parts > 1").select(
        F.col("bucket").alias("of"),
        F.col("largest.root").alias("largest"),
        F.ceil(F.col("n") / BLOCK_NODES).cast("int").alias("blocks"),
        F.ceil((F.col("n") - F.col("largest.n")) / BLOCK_NODES).cast("int").alias("few_blocks"),
    )
    found = labelled.join(small(written(buckets, "open-buckets"), ID_ROWS), F.expr("bucket = of"))
    return written(found.withColumn("few", F.col("root") != F.col("largest")).drop("of", "largest"), "open")


def _block_links(open_nodes: DataFrame, texts: DataFrame, k: int, similarity: int) -> DataFrame:
    """Pairs (a, b) of a bucket's nodes in different components that may be similar enough, one of them of the few.

    Shingles are compared by 32 bits of their hashes here, which can only make an intersection look larger.
    """
    wanted = written(open_nodes.select(F.col("id").alias("wanted")).distinct(), "open-ids")
    chosen = texts.join(small(wanted, ID_ROWS), F.expr("id = wanted"), "left_semi").dropDuplicates(["id", "text"])

    def shortened(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingle_set(t, k) for t in frame["text"]]
            short = [np.unique((x >> np.uint64(32)).astype(np.uint32)).tobytes() for x in sets]
            yield pd.DataFrame({"node": frame["id"].to_numpy(), "n": [len(x) for x in sets], "short": short})

    sets = written(chosen.mapInPandas(shortened, "node long, n long, short binary"), "open-sets")
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = open_nodes.filter("few").withColumns({"x": block("few_blocks"), "side": F.lit(0)}).withColumn("y", every("blocks"))
    other = open_nodes.withColumns({"y": block("blocks"), "side": F.lit(1)}).withColumn("x", every("few_blocks"))
    cell = ("bucket", "x", "y")
    placed = one.select(*cell, "side", "id", "root").unionByName(other.select(*cell, "side", "id", "root"))
    cells = placed.join(sets, F.expr("id = node")).select(*cell, "side", "id", "root", "n", "short")
    return cells.repartition(*cell).sortWithinPartitions(*cell, "side").mapInPandas(_compared(similarity), "a long, b long").distinct()


def _compared(similarity: int):
    """Reads the nodes of one cell after the other and yields its links."""

    def links(cell: pd.DataFrame) -> pd.DataFrame:
        few, all_ = cell[cell["side"] == 0], cell[cell["side"] == 1]
        sets = [np.frombuffer(x, dtype=np.uint32) for x in all_["short"]]
        found: list[tuple[int, int]] = []
        if len(few) and sets:
            known, place = np.unique(np.concatenate(sets), return_inverse=True)
            owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            ids, roots, sizes = (all_[c].to_numpy() for c in ("id", "root", "n"))
            for own, root, n, short in zip(few["id"], few["root"], few["n"], few["short"], strict=True):
                mine = np.frombuffer(short, dtype=np.uint32)
                here = np.zeros(len(known), dtype=bool)
                at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                here[at[known[at] == mine]] = True
                both = np.bincount(owner[here[place]], minlength=len(sets)) + (n - len(mine))
                good = (100 * both >= similarity * (n + sizes - both)) & (roots != root)
                found += [(min(own, x), max(own, x)) for x in ids[good].tolist()]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            if not len(frame):
                continue
            number = frame[["bucket", "x", "y"]].diff().ne(0).any(axis=1).cumsum()
            # The last cell may go on in the next frame.
            last = number.iloc[-1]
            rest = frame[number == last]
            done = frame[number != last]
            yield from (links(cell) for _, cell in done.groupby(number[number != last], sort=False))
        if rest is not None and len(rest):
            yield links(rest)

    return compare


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group, with its columns: that with the smallest id; of rows with that id and text, one.

    Rows that share an id but not the text are documents of their own. Of rows with one id and text the first by their JSON
    stays, and of texts that share an id and a group the one with the smallest hash.
    """
    known = {"id": F.col(f"`{id_column}`").cast("long"), "hash": F.xxhash64(text_of(f"`{text}`"))}
    texts = docs.select(*[v.alias(k) for k, v in known.items()], F.col(f"`{text}`").cast("string").alias("text"))
    spread = texts.groupBy("id").agg(F.min("hash").alias("first"), F.max("hash").alias("last")).filter("id IS NOT NULL AND first <> last")
    spread = written(spread.select(F.col("id").alias("of"), "first"), "shared-ids")
    # The first text of an id goes by the id, any other by a number of its own.
    node = F.when(F.expr("of IS NULL OR hash = first"), F.col("id")).otherwise(F.xxhash64("id", "hash"))
    noded = lambda df: df.join(small(spread, ID_ROWS), F.expr("id = of"), "left").withColumn("node", node)
    found = written(groups(noded(texts).select("node", "text"), "node", "text", **options), "groups")
    if not spread.isEmpty():
        found = _smallest_first(found, noded(texts).filter("of IS NOT NULL").select("node", "id", "hash").distinct())
    kept = written(found.filter("node = component_id").groupBy(F.col("node").alias("kept_node")).agg(F.count(F.lit(1)).alias("n")), "kept")
    gone = written(found.filter("node <> component_id").select(F.col("node").alias("gone_node")).distinct(), "gone")
    rows = noded(packed(docs, **known)).select("row", "node")
    stay = rows.join(small(gone, ID_ROWS), F.expr("node = gone_node"), "left_anti")
    repeated = small(kept.filter("n > 1").select(F.col("kept_node").alias("repeated")), ID_ROWS)
    once = stay.join(repeated, F.expr("node = repeated"), "left_anti")
    several = stay.join(repeated, F.expr("node = repeated"), "left_semi").groupBy("node").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return once.select("row").unionByName(several.select("row")).select("row.*")


def _smallest_first(found: DataFrame, shared: DataFrame) -> DataFrame:
    """The groups, those with nodes of shared ids named by the node with the smallest id and hash."""
    shared = written(shared.select(F.col("node").alias("of"), "id", "hash"), "shared-nodes")
    of = F.expr("node = of")
    touched = written(found.join(small(shared, ID_ROWS), of, "left_semi").select(F.col("component_id").alias("touched")).distinct(), "touched")
    inside = found.join(small(touched, ID_ROWS), F.expr("component_id = touched"), "left_semi").join(small(shared, ID_ROWS), of, "left")
    order = F.struct(F.coalesce("id", "node"), "hash", "node")
    leaders = written(inside.groupBy(F.col("component_id").alias("touched")).agg(F.min_by("node", order).alias("leader")), "leaders")
    named = found.join(small(leaders, ID_ROWS), F.expr("component_id = touched"), "left")
    return named.select("node", "n_shingles", F.coalesce("leader", "component_id").alias("component_id"))
