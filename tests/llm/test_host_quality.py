"""Quality rules of documents and hosts."""

import re

import pytest

from freightlane.llm import host_quality as hq
from freightlane.llm.queries import op7_host_quality
from tests.llm.helpers import messy, no_rows, prose, words


def facts(text):
    text = text or ""
    w = words(text)
    seen, places = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    for found in seen.values():
        if len(found) > 1:
            places |= {i + j for i in found for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(places) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(places), failed


FACTS = list(hq.FACTS)


def test_query_against_brute_force(spark, folder):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in op7_host_quality(spark, folder).collect()}
    assert rows.keys() == docs.keys()
    assert {i: tuple(r[c] for c in FACTS) for i, r in rows.items()} == {i: facts(r["text"]) for i, r in docs.items()}
    kept = expected_kept([(i, r["text"], r["source"]) for i, r in docs.items()])
    assert {i for i, r in rows.items() if r["kept"]} == kept


def expected_kept(rows, max_rate=hq.MAX_RATE):
    hosts, fails = {}, {}
    for i, text, host in rows:
        n, chars, symbols, dup, repeat, base = facts(text)
        lines = len([x for x in (text or "").split("\n") if words(x)])
        fails[i] = (base, {"symbols": 10 * symbols > chars, "dup_lines": 2 * dup > lines, "repeats": 100 * repeat > 35 * n})
        hosts.setdefault(host, []).append(i)
    bad = {}
    for rule in hq.SOFT_RULES:
        counts = {h: (len(v), sum(fails[i][1][rule] for i in v)) for h, v in hosts.items()}
        mean, prior = hq.beta_prior(len(rows), len(hosts), sum(f for _, f in counts.values()), sum(f * f / n for n, f in counts.values()))
        bad |= {(h, rule): (f + mean * prior) / (n + prior) > max_rate for h, (n, f) in counts.items()}
    return {i for h, v in hosts.items() for i in v if not fails[i][0] and not any(f and bad[h, r] for r, f in fails[i][1].items())}


@pytest.mark.parametrize(
    "text",
    [
        "a b c a b c",
        "a a a a",
        "a b c\na b c\n\na b c \n \n",
        "x\x0by\x0cz\r\nx\x0by\x0cz",
        "é漢 🙂 é漢 🙂 é漢 🙂 <|>",
        "a b c d a b c e b c d",
        "\x1c \x85 \xa0",
        prose(20_000) + " " + prose(20_000),
    ],
)
def test_facts(spark, text):
    got = hq.judge(spark.createDataFrame([(1, text, "h")], "doc_id long, text string, source string")).first()
    assert tuple(got[c] for c in FACTS) == facts(text)


def test_hosts_decide_on_soft_failures_only(spark):
    junk = lambda i: " ".join(f"w{i}y{j}%%%" for j in range(60))
    rows = [(i, prose(60, 100 * i), "clean") for i in range(300)] + [(1000, junk(0), "clean")]
    rows += [(2000 + i, junk(i), "dirty") for i in range(30)] + [(3000 + i, prose(70, 9 * i), "dirty") for i in range(30)]
    rows += [(4000, junk(1), "tiny"), (4001, prose(60), "tiny"), (4002, prose(10), "clean")]
    out = hq.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r["doc_id"] for r in out.collect() if r["kept"]}
    assert kept == expected_kept(rows)
    assert kept >= {*range(300), *range(3000, 3030), 4001, 1000}
    assert not kept & {*range(2000, 2030), 4002}


def test_prior():
    assert hq.beta_prior(None, 0, None, None) == (0.0, 1.0)
    assert hq.beta_prior(100, 10, 0, 0) == (0.0, 1e6)
    mean, weight = hq.beta_prior(200, 2, 100, 100.0)
    assert mean == 0.5 and weight == 1.0
    assert hq.beta_prior(200, 2, 100, 50.0)[1] == 1e6


def test_messy_rows(spark):
    rows = messy(spark)
    out = hq.judge(rows)
    assert set(out.columns) == {*rows.columns, *FACTS}
    got = sorted(((r["doc_id"], *[r[c] for c in FACTS]) for r in out.collect()), key=repr)
    assert got == sorted(((r["doc_id"], *facts(r["text"])) for r in rows.collect()), key=repr)
    assert {r["doc_id"] for r in out.collect() if r["kept"]} == {1, None, 8, 9}
    assert sorted(out.select("row", "host").collect(), key=repr) == sorted(rows.select("row", "host").collect(), key=repr)
    assert hq.judge(no_rows(spark)).count() == 0


def test_documents_and_verdicts_agree_and_no_filter_reads_the_text(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = hq.kept_documents(docs)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.split("\n") if "Filter " in x and ("split(" in x or "sort_array" in x)]
    judged = {r["doc_id"] for r in hq.judge(docs, keep_text=False).collect() if r["kept"]}
    assert {r["doc_id"] for r in kept.collect()} == judged
