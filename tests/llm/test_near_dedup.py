import itertools
import random

import numpy as np
import pytest

from llm.cases import frame, odd_rows, prose
from shopgrain.llm import near_dedup as N
from shopgrain.llm.graph import components
from shopgrain.llm.shingles import counted, shingles


def union(pairs, nodes):
    parent = {n: n for n in nodes}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components_match_union_find(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    pairs += [(i, i + 1) for i in range(300, 340)] + [(500, 500 + k) for k in range(60)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in components(
        spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    nodes = {x for p in pairs for x in p if p[0] != p[1]}
    want = union([p for p in pairs if p[0] != p[1]], nodes)
    assert {n: got[n] for n in nodes} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 2**63, 100).astype(np.uint64)])
    wa, wb = rng.integers(1, 6, 400), rng.integers(1, 6, 400)
    text = np.repeat([0, 1], 400)
    owner = N.signatures(np.concatenate([a, b]), np.concatenate([wa, wb]), text, 2, 4000)
    order_a, order_b = np.argsort(a), np.argsort(b)
    exact = N.probability_jaccard((a[order_a], wa[order_a]), (b[order_b], wb[order_b]))
    x, y = dict(zip(a.tolist(), wa.tolist())), dict(zip(b.tolist(), wb.tolist()))
    brute = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys())
                for i in x.keys() & y.keys())
    assert exact == pytest.approx(brute)
    assert (owner[0] == owner[1]).mean() == pytest.approx(exact, abs=0.04)


def test_equal_weights_give_the_plain_measure():
    a, b = np.arange(10).astype(np.uint64), np.arange(5, 20).astype(np.uint64)
    one = np.ones(15, int)
    assert N.probability_jaccard((a, one[:10]), (b, one)) == pytest.approx(5 / 20)


def brute_classes(rows):
    sets = {}
    for i, t in rows:
        h, w, _ = counted(*shingles([t]))
        sets[i] = (h, w)
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2)
             if N.probability_jaccard(sets[a], sets[b]) >= 0.8]
    return union(pairs, sets)


@pytest.fixture(scope="module")
def families():
    """A large group of near copies, chains of edits, shared passages, and single texts."""
    rng = random.Random(9)
    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        return words
    base, rows = prose(rng, 200).split(), []
    rows += [" ".join(edited(base, rng.randrange(1, 4))) for _ in range(60)]
    chain = prose(rng, 150).split()
    for _ in range(25):
        chain = edited(chain, 2)
        rows.append(" ".join(chain))
    common = prose(rng, 60)
    rows += [f"{common} {prose(rng, 50)}" for _ in range(40)]
    rows += [prose(rng, rng.randrange(1, 120)) for _ in range(60)]
    return [(i, t) for i, t in enumerate(rows)]


def test_classes_match_brute_force(spark, families):
    want = brute_classes(families)
    rows = [(i, t, "en", "s", 0) for i, t in families] + [(1000 + i, t, "en", "s", 0) for i, t in families[:30]]
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(frame(spark, rows)).collect()}
    assert {i: got[i] for i in want} == want
    assert all(got[1000 + i] == want[i] for i in range(30))
    kept = [r["doc_id"] for r in N.keep_one(frame(spark, rows)).collect()]
    assert sorted(kept) == sorted(set(want.values()))


def test_odd_rows(spark):
    docs = frame(spark)
    got = N.near_duplicates(docs).collect()
    assert len(got) == len(odd_rows())
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[1]["class_id"] == by_id[2]["class_id"] == 1 and by_id[2]["n_in_class"] >= 3
    assert all(by_id[i]["class_id"] == i and by_id[i]["n_in_class"] == 1 for i in (3, 4, 5, 6, 7, 8))
    kept = N.keep_one(docs).collect()
    assert sorted((r["doc_id"] or -1) for r in kept if (r["text"] or "").strip()).count(1) == 1
    assert sum(1 for r in kept if not (r["text"] or "").strip()) == 4  # without words: all stay
    assert N.near_duplicates(frame(spark, [])).count() == 0
    assert N.keep_one(frame(spark, [])).count() == 0
