"""Quality rules of documents and hosts.

A document has hard rules, which alone reject it, and soft rules. A failed soft rule is weighed by its host: failures
are counted by host and rule, the rates are shrunk towards the rate of all hosts by a beta prior fitted to the hosts
(method of moments), and a host whose shrunk rate lies above `max_rate` has a bad verdict for that rule. A document is
rejected if it fails a hard rule, or a soft rule for which its host's verdict is bad. So a clean document stays, whatever
its host, and a stray failure on a clean host stays too.

Defined cases: a NULL text has no words and fails the hard rules; NULL is a host of its own; repeated rows count as often
as they stand there; an empty table gives no rows; added columns replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlane.llm.common import packed, small, text_of, unpacked, words_of, written

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
MAX_RATE = 0.02
SYMBOLS = "[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"
#: Words of a repeated window.
WINDOW = 3
#: rule -> whether a document fails it; divisions are multiplied out, so empty texts fail none.
SOFT_RULES = {
    "symbols": "10 * n_symbols > word_chars",
    "dup_lines": "2 * n_dup_lines > n_lines",
    "repeats": "100 * n_repeat_words > 35 * n_words",
}
FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def with_facts(rows: DataFrame, text: Column) -> DataFrame:
    """Adds the FACTS, n_lines and one fail_<rule> per soft rule to the packed rows."""
    last = F.size("words") - WINDOW
    windows = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(WINDOW)])
    )
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda i, x: F.coalesce(F.get("placed", i)["h"] == x["h"], F.lit(False))
    found = F.filter("placed", lambda x, i: same(i - 1, x) | same(i + 1, x))
    covered = F.flatten(F.transform(found, lambda x: F.array(*[x["i"] + j for j in range(WINDOW)])))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(HAS_WORD))
    names = [*FACTS, "n_lines", *[f"fail_{rule}" for rule in SOFT_RULES]]
    kept = [c for c in rows.columns if c not in ("row", "read")]
    facts = (
        rows.withColumns({"words": words_of(text), "lines": lines, "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long")})
        .withColumn("windows", F.when(F.size("words") >= WINDOW, windows).otherwise(F.expr("array(0L)")))
        .withColumn("placed", F.when(repeats, placed))
        .withColumns({
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_repeat_words": F.when(F.col("placed").isNull(), 0).otherwise(F.size(F.array_distinct(covered))).cast("long"),
        })
        .drop("words", "lines", "windows", "placed")
        .withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words"))
        .withColumns({f"fail_{rule}": F.expr(test) for rule, test in SOFT_RULES.items()})
    )
    # Filters on the facts do not pass a generator. Pushed below it, they would hold all of the above in place of
    # each fact, and split the text again for every word.
    return facts.select("row", F.inline(F.array(F.struct(*kept, *names))))


def host_verdicts(facts: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """host -> n_docs, and per soft rule rate_<rule> (shrunk) and bad_<rule>.

    The prior of a rule is a beta distribution with the mean of all documents and the variance of the hosts' rates
    beyond what their sizes explain; one row of moments over all hosts goes to the driver for it.
    """
    hosts = facts.groupBy("host").agg(
        F.count(F.lit(1)).cast("double").alias("n_docs"),
        *[F.count_if(f"fail_{rule}").cast("double").alias(f"n_{rule}") for rule in SOFT_RULES],
    )
    hosts = written(hosts, "hosts")
    sums = [F.sum(f"n_{r}").alias(f"sum_{r}") for r in SOFT_RULES]
    squares = [F.sum(F.expr(f"n_{r} * n_{r} / n_docs")).alias(f"squares_{r}") for r in SOFT_RULES]
    all_hosts = hosts.agg(F.sum("n_docs").alias("docs"), F.count(F.lit(1)).alias("hosts"), *sums, *squares).first()
    for r in SOFT_RULES:
        mean, prior = beta_prior(all_hosts["docs"], all_hosts["hosts"], all_hosts[f"sum_{r}"], all_hosts[f"squares_{r}"])
        rate = (F.col(f"n_{r}") + mean * prior) / (F.col("n_docs") + prior)
        hosts = hosts.withColumns({f"rate_{r}": rate, f"bad_{r}": rate > max_rate})
    return hosts.select("host", "n_docs", *[f"rate_{r}" for r in SOFT_RULES], *[f"bad_{r}" for r in SOFT_RULES])


def beta_prior(docs: float | None, hosts: int, failed: float | None, squares: float | None) -> tuple[float, float]:
    """Mean of a rule's rate and the number of documents the prior counts for, between one and a million.

    squares is the sum of failed * failed / docs over the hosts. The variance that sizes explain is taken off.
    """
    if not docs:
        return 0.0, 1.0
    mean = failed / docs
    noise = mean * (1 - mean)
    between = squares / docs - mean * mean - noise * hosts / docs
    return mean, min(max(noise / between - 1, 1.0), 1e6) if between > 0 else 1e6


def _judged(docs: DataFrame, text: str, host: str | Column, max_rate: float, keep_text: bool) -> DataFrame:
    where = host if isinstance(host, Column) else F.col(f"`{host}`")
    rows = packed(docs, host=where.cast("string"), read=text_of(text))
    if not keep_text:
        rows = rows.withColumn("row", F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != text]))
    facts = with_facts(rows, F.col("read"))
    # Without texts the facts are small and are written; with them they are worked out again at the end instead.
    if not keep_text:
        facts = written(facts, "facts")
    verdicts = written(host_verdicts(facts.select("host", *[f"fail_{r}" for r in SOFT_RULES]), max_rate), "verdicts")
    joined = facts.alias("f").join(small(verdicts).alias("v"), F.expr("f.host <=> v.host"), "left")
    rejected = F.expr(" OR ".join(["base_failed", *[f"(fail_{r} AND bad_{r})" for r in SOFT_RULES]]))
    return joined.select("row", *FACTS, (~rejected).alias("kept"))


def judge(docs: DataFrame, text: str = "text", host: str | Column = "source", max_rate: float = MAX_RATE, keep_text: bool = True) -> DataFrame:
    """The documents with the FACTS and `kept`. Without keep_text the text column is left out of the result."""
    return unpacked(_judged(docs, text, host, max_rate, keep_text), *FACTS, "kept")


def kept_documents(docs: DataFrame, text: str = "text", host: str | Column = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """The documents that the rules keep, with the columns they had."""
    return _judged(docs, text, host, max_rate, True).filter("kept").select("row.*")
