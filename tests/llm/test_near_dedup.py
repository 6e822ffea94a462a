"""SuperMinHash, components and near-duplicate groups."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freightlane.llm import near_dedup as nd
from freightlane.llm import superminhash as sm
from freightlane.llm.components import components
from freightlane.llm.queries import op5_near_dedup
from tests.llm.helpers import messy, no_rows, prose


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


class Union:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def expected_groups(docs, k, similarity=80):
    sets = {i: shingles(t, k) for i, t in docs.items()}
    union, ids = Union(docs), sorted(docs)
    holders = {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    common = {}
    for found in holders.values():
        for n, a in enumerate(found):
            for b in found[:n]:
                common[b, a] = common.get((b, a), 0) + 1
    for (a, b), both in common.items():
        if 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
            union.join(a, b)
    return {i: (len(sets[i]), union.find(i)) for i in ids}


def scalar_signature(elements, slots):
    """SuperMinHash element by element, as published, with the same random numbers."""
    out = [None] * slots
    for e in elements:
        p = list(range(slots))
        for j in range(slots):
            draw = int(sm.mixed(np.array([(int(e) + (j + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1)], dtype=np.uint64))[0])
            pick = j + ((draw >> 32) * (slots - j) >> 32)
            p[j], p[pick] = p[pick], p[j]
            value = j << 32 | draw & 0xFFFFFFFF
            out[p[j]] = value if out[p[j]] is None else min(out[p[j]], value)
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 40, 300])
def test_signature_is_that_of_the_definition(n):
    draw = np.random.Generator(np.random.PCG64(n))
    sets = [np.unique(draw.integers(0, 2**63, n).astype(np.uint64)) for _ in range(3)] + [np.empty(0, dtype=np.uint64)]
    rows = sm.signatures(sets, 24)
    assert [list(map(int, r)) for r in rows[:3]] == [scalar_signature(s, 24) for s in sets[:3]]
    assert (rows[3] == 2**64 - 1).all()


def test_long_sets_are_cut_and_merged(monkeypatch):
    s = np.arange(1000, dtype=np.uint64)
    whole = sm.signatures([s], 32)
    monkeypatch.setattr(sm, "BLOCK", 64)
    assert (sm.signatures([s, s[:5]], 32)[0] == whole[0]).all()


def test_estimates_vary_less_than_those_of_independent_hashes():
    draw = np.random.Generator(np.random.PCG64(1))
    errors = []
    for _ in range(200):
        x = np.unique(draw.integers(0, 2**63, 60).astype(np.uint64))
        a, b = sm.signatures([x[:50], x[10:]], 128)
        errors.append((a == b).mean() - 2 / 3)
    assert abs(np.mean(errors)) < 0.01 and np.var(errors) < 2 / 9 / 128


@given(st.text(max_size=60), st.integers(1, 4))
@settings(max_examples=200, deadline=None)
def test_shingle_sets(text, k):
    text = text.encode("utf-8", "replace").decode()
    assert len(sm.shingle_set(text, k)) == len(shingles(text, k))


def test_components_of_random_graphs(spark):
    draw = random.Random(2)
    for edges in (
        [(draw.randrange(400), draw.randrange(400)) for _ in range(260)],
        [(i, i + 1) for i in range(150)],
        [(0, i) for i in range(1, 200)] + [(5, 900)],
        [(3, 3)],
        [],
    ):
        union = Union({x for e in edges for x in e})
        for a, b in edges:
            union.join(a, b)
        got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "node long, root long").repartition(5)).collect()}
        assert got == {x: union.find(x) for x in union.parent if union.find(x) != x}


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, table):
    place = f"/root/testdata/{table}"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{place}/documents.parquet").collect()}
    rows = op5_near_dedup(spark, place).collect()
    expected = expected_groups(docs, 2)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows) and len(rows) == len(docs)


def test_a_large_group_of_copies_around_the_threshold(spark):
    """Copies of one text with up to a fifth of their words changed: some pairs are linked, some are not."""
    draw = random.Random(4)
    base = [f"v{i}" for i in range(80)]
    docs = {i: prose(80, 1000 * i) for i in range(1000, 1010)}
    for i in range(160):
        copy = base[:]
        for _ in range(draw.randrange(9)):
            copy[draw.randrange(80)] = f"n{draw.randrange(10**6)}"
        docs[i] = " ".join(copy)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(6)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nd.groups(frame, k=2).collect()}
    assert got == expected_groups(docs, 2)
    assert len({c for _, c in got.values()}) > 12


def test_similarity_at_the_threshold(spark):
    """Eight of ten shingles in common are enough, 79 of 100 are not."""
    docs = {
        1: prose(9),
        2: prose(8) + " y",
        3: prose(89, 1000),
        4: prose(79, 1000) + " " + prose(10, 5000),
        5: prose(40, 9000),
        6: prose(33, 9000) + " " + prose(7, 9900),
    }
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for similarity in (80, 66):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nd.groups(frame, k=1, similarity=similarity).collect()}
        assert got == expected_groups(docs, 1, similarity)
    assert nd.bands_for(80) == 40 < nd.bands_for(66)


def test_messy_rows(spark):
    rows = messy(spark)
    got = sorted(map(tuple, nd.groups(rows, k=2).collect()), key=lambda r: (r[0] is None, r))
    assert got.pop() == (None, 69, None)
    assert got == [(1, 59, 1), (1, 59, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (8, 60, 8), (9, 2999, 9)]
    kept = nd.deduplicated(rows, k=2)
    assert kept.columns == rows.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 2, 3, 4, 5, 6, 8, 9, None]
    assert nd.groups(no_rows(spark)).count() == nd.deduplicated(no_rows(spark)).count() == 0


def test_ids_shared_by_different_texts(spark):
    near = prose(100).replace("w99x", "other")
    rows = [
        (1, prose(100), "a"),
        (5, prose(100), "copy of 1"),
        (5, prose(60, 3000), "its own"),
        (6, near, "near 1"),
        (6, prose(60, 4000), "its own"),
        (6, prose(60, 4000), "its own, again"),
        (7, prose(60, 5000), "kept"),
        (7, prose(60, 6000), "copied by 8"),
        (8, prose(60, 6000), "copy of 7"),
        (9, prose(60, 7000), "two texts of a group"),
        (9, prose(60, 7000).upper(), "two texts of a group"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string")
    expected = [(1, "a"), (5, "its own"), (6, "its own"), (7, "copied by 8"), (7, "kept"), (9, "two texts of a group")]
    for n in (1, 3):
        kept = nd.deduplicated(docs.repartition(n), k=2)
        assert kept.columns == docs.columns
        assert sorted((r["doc_id"], r["id"]) for r in kept.collect()) == expected


def test_blocks_of_a_bucket_find_every_link(spark, monkeypatch):
    """The comparison of what is left of a bucket, cut into many blocks."""
    monkeypatch.setattr(nd, "BLOCK_NODES", 7)
    draw = random.Random(8)
    base = [f"v{i}" for i in range(60)]
    docs = {i: " ".join(w if draw.random() > 0.004 * (i % 40) else f"n{draw.randrange(10**6)}" for w in base) for i in range(90)}
    texts = spark.createDataFrame(list(docs.items()), "id long, text string").repartition(5)
    members = spark.createDataFrame([(bucket, i) for bucket in (4, -9) for i in docs if i % 2 or bucket > 0], "bucket long, id long")
    united = {i: i % 3 for i in docs if i % 3 != i}
    roots = spark.createDataFrame(list(united.items()), "node long, root long")
    got = {tuple(r) for r in nd._block_links(nd._open(members, roots), texts, 1, 80).collect()}
    sets = {i: shingles(t, 1) for i, t in docs.items()}
    near = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    expected = {(a, b) for a in docs for b in docs if a < b and a % 3 != b % 3 and near(a, b)}
    largest = {r["root"] for r in nd._open(members, roots).filter("NOT few").collect()}
    assert expected and got == {(a, b) for a, b in expected if not {a % 3, b % 3} <= largest or len(largest) > 1}
