import numpy as np
import pytest

from shopgrain.llm import topk as K


def brute(ids, points, query, k):
    q = [i for i, x in enumerate(ids) if x == query]
    best = {}
    for i in q:
        for j, x in enumerate(ids):
            if x != query:
                s = sum(int(a) * int(b) for a, b in zip(points[i], points[j]))
                best[x] = max(s, best.get(x, s))
    return sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k]


def test_cover_tree_covers():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-9, 9, (300, 2)), np.zeros((50, 2), int)])
    order, nodes = K.cover_tree(points)
    assert sorted(order) == list(range(len(points)))
    for first, end, radius, child, children in nodes:
        members = points[order[int(first):int(end)]]
        d = np.sqrt(((members - members[0]) ** 2).sum(1))
        assert d.max() <= radius + 1e-9
        if children:
            own = nodes[int(child):int(child + children)]
            assert own[0][0] == first and own[-1][1] == end
            assert all(a[1] == b[0] for a, b in zip(own, own[1:]))
            assert all(o[2] <= radius / 2 + 1e-6 for o in own)
        else:
            assert radius == 0 and (members == members[0]).all()


def products(queries, points, k=10):
    """The answers of one pair of blocks, and the share of the products that were taken."""
    q, x = (K.Block.build(ids, p) for ids, p in (queries, (np.arange(len(points)), points)))
    search = K.DualSearch(q, x, k, np.full(len(q.ids), K.NONE))
    who, ids, scores = search.found()
    for i, v in zip(*queries):
        s = (points @ v).astype(int)
        want = sorted((-t, j) for j, t in enumerate(s.tolist()) if j != i)[:k]
        assert [(-t, j) for a, j, t in zip(who, ids, scores) if a == i] == want
    return search.products / (len(queries[0]) * len(points))


def test_clusters_are_pruned():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(200, 64)) * 300
    points = np.round(centres.repeat(20, 0) + rng.normal(size=(4000, 64)) * 5)
    some = np.arange(0, 4000, 50)
    share = products((some, points[some]), points)
    print("200 clusters of 20 in 64 dimensions:", share)
    assert share < 0.2


def test_low_dimensions_are_pruned_and_noise_is_not():
    rng = np.random.default_rng(4)
    plane, noise = (np.round(rng.normal(size=(3000, d)) * 300) for d in (2, 64))
    some = np.arange(0, 3000, 60)
    assert products((some, plane[some]), plane) < 0.2
    assert products((some, noise[some]), noise) <= 1.1


def test_copies_are_one_place():
    rng = np.random.default_rng(5)
    points = np.concatenate([np.tile([[50.0, 1, 2]], (3000, 1)), np.round(rng.normal(size=(500, 3)) * 9)])
    some = np.array([7, 2999, 3100, 3499])
    assert products((some, points[some]), points) < 0.2


@pytest.mark.parametrize("dims", [2, 5])
def test_against_brute_force(spark, dims):
    rng = np.random.default_rng(dims)
    points = np.concatenate([rng.normal(size=(250, dims)), rng.normal(size=(3, dims)).repeat(60, 0)])
    ids = rng.permutation(len(points))
    rows = [(int(i), [float(v) for v in p]) for i, p in zip(ids, points, strict=True)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = K.top_k(df, df.where("vec_id % 20 = 0"), pivots=4, block_rows=40, query_rows=8).collect()
    whole = np.floor(1024 * np.array([[np.float32(v) for v in p] for p in points], np.float64)).astype(int)
    for q in {r["query_id"] for r in got}:
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [(v, s) for _, v, s in mine] == brute(ids.tolist(), whole, q, 10)
    assert {r["query_id"] for r in got} == {i for i in range(len(points)) if i % 20 == 0}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0]),
            (20, [-1.0, 0.5]), (9, [1e307, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = K.top_k(df, df.where("vec_id % 20 = 0"), k=3).collect()
    answers = {q: [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])
                   if r["query_id"] == q] for q in (0, 20)}
    one = 1024 * 1024
    assert answers[0] == [(2, 2 * one), (1, one), (20, -one)]
    assert answers[20] == [(0, -one), (1, -one), (2, -one)]
    assert K.top_k(df.limit(0), df.limit(0)).count() == 0
    assert K.top_k(df, df.limit(0)).count() == 0


@pytest.mark.parametrize("block_rows", [4, 1000])
def test_repeated_rows_and_ids_of_several_vectors(spark, block_rows):
    rng = np.random.default_rng(9)
    points, k = rng.integers(-20, 20, (90, 3)), 5
    ids = np.append(np.arange(60), np.arange(30))  # half of the ids have two vectors
    rows = [(int(i), [float(v) for v in p]) for i, p in zip(ids, points, strict=True)] * k
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = K.top_k(df, df.where("vec_id % 10 = 0"), k=k, scale=1, pivots=4, block_rows=block_rows,
                  query_rows=2).collect()
    for q in range(0, 60, 10):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [(v, s) for _, v, s in mine] == brute(ids.tolist(), points, q, k)


def test_large_components_stay(spark):
    rows = [(1, [0.1, 0.2]), (2, [20000.0, 0.1]), (3, [0.3, 0.1]), (4, [-9e5, 3e5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    whole = np.floor(1024 * np.array([v for _, v in rows])).astype(int)
    got = K.top_k(df, df).collect()
    for q in (1, 2, 3, 4):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [(v, s) for _, v, s in mine] == brute([1, 2, 3, 4], whole, q, 10)


def test_sums_beyond_doubles_and_longs():
    q, x = (K.Block.build(np.array(ids), np.array(p, float)) for ids, p in (
        ([1], [[2.0**40, 3]]), ([2, 3], [[2.0**21, 5], [2.0**21, 6]])))
    found = K.DualSearch(q, x, 10, np.array([K.NONE])).found()
    assert list(zip(*(c.tolist() for c in found))) == [(1, 3, 2**61 + 18), (1, 2, 2**61 + 15)]
    with pytest.raises(OverflowError):
        K.DualSearch(q, K.Block.build(np.array([2]), np.array([[2.0**40, 0]])), 10, np.array([K.NONE]))
