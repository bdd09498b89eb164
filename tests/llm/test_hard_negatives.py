from collections import defaultdict
from math import ceil, floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopgrain.llm import hard_negatives as H


def brute(rows, scale, every, positives=5, negatives=10):
    """(anchor, positive, rank, negative, positive score, negative score) in plain Python."""
    rows = {i: (label, [floor(scale * x) for x in v]) for i, label, v in rows}
    out = []
    for a, (label, v) in rows.items():
        if a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), i, other)
                         for i, (other, w) in rows.items() if i != a and len(w) == len(v)))
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            p = -p
            fit = [(-s, i) for s, i, other in scored if other != label
                   and 30 * p <= -100 * s <= 90 * p][:negatives]
            out += [(a, positive, r + 1, i, p, s) for r, (s, i) in enumerate(fit)]
    return sorted(out)


def found(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"],
                   r["positive_score"], r["negative_score"]) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")


@pytest.mark.parametrize("dims", [1, 3, 16, 21])
def test_bounds_hold_at_every_level(dims):
    rng = np.random.default_rng(dims)
    blocks = []
    for n in (7, 9):
        points = np.floor(rng.normal(size=(n, dims)) * rng.choice([1, 50, 900], (n, 1)))
        blocks.append(H.Block(*H.Block.pack(np.arange(n), np.zeros(n, int), points)))
    exact = blocks[0].points @ blocks[1].points.T
    widths = []
    for (mean, spread), (mean_x, spread_x) in zip(blocks[0].levels, blocks[1].levels, strict=True):
        middle, reach = mean @ mean_x.T, spread @ spread_x.T
        assert (np.abs(exact - middle) <= reach + 1e-6).all()
        widths.append(reach.sum())
    assert widths == sorted(widths, reverse=True)  # finer summaries are never wider


@pytest.mark.parametrize("sizes", [dict(block_rows=16, query_rows=4, lane_blocks=2), {}])
def test_against_brute_force(spark, sizes):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    points = np.concatenate([rng.normal(size=(120, 8)), centres.repeat(25, 0)
                             + rng.normal(scale=0.2, size=(150, 8)), centres.repeat(10, 0)])
    ids = rng.permutation(len(points)).tolist()
    rows = [(i, int(rng.integers(0, 4)), [float(x) for x in p]) for i, p in zip(ids, points)]
    got = H.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, scale=64, **sizes)
    assert found(got) == brute(rows, 64, 10)


def test_one_label_and_ties(spark):
    rows = [(i, 1 if i % 3 else 2, [float(i % 4), 1.0]) for i in range(60)]
    got = H.hard_negatives(frame(spark, rows), F.col("vec_id") % 20 == 0, scale=10, block_rows=8)
    assert found(got) == brute(rows, 10, 20)
    alone = frame(spark, [(i, 7, [1.0, float(i)]) for i in range(30)])
    assert H.hard_negatives(alone, F.col("vec_id") % 10 == 0).count() == 0


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    sound = [(0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.5, 0.5]), (3, 2, [0.6, -0.2]),
             (100, 2, [-1.0, 0.0]), (4, 2, [-0.5, 0.0]), (5, 1, [-0.4, 0.0]), (200, 3, [1.0]),
             (6, 3, [1.0]), (7, 4, [0.5])]
    odd = [(8, None, [1.0, 0.0]), (9, 1, None), (10, 1, []), (11, 1, [nan, 1.0]), (12, 2, [inf, 1.0]),
           (13, 1, [None, 1.0]), (None, 1, [1.0, 1.0]), (14, 1, [1e307, 0.0])]
    df = frame(spark, sound + odd + sound[:3])  # repeated rows are one
    want = brute(sound, 256, 100)
    assert want
    assert found(H.hard_negatives(df, F.col("vec_id") % 100 == 0)) == want
    clash = df.selectExpr("*", "1 AS id", "2 AS v", "3 AS score", "4 AS asked", "5 AS dims", "6 AS `a.b`")
    assert found(H.hard_negatives(clash, F.col("vec_id") % 100 == 0)) == want
    assert H.hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert H.hard_negatives(df, F.lit(False)).count() == 0
    # Of an id with several rows the smallest counts.
    two = frame(spark, [*sound, (2, 1, [0.5, 0.5])])
    assert found(H.hard_negatives(two, F.col("vec_id") % 100 == 0)) == brute(
        [s for s in sound if s[0] != 2] + [(2, 1, [0.5, 0.5])], 256, 100)


def test_large_components(spark):
    rows = [(0, 1, [3e6, 1.0]), (1, 1, [2.5e6, 7.0]), (2, 2, [1e6, 3.0]), (3, 2, [2e6, 5.0])]
    assert found(H.hard_negatives(frame(spark, rows), F.col("vec_id") == 0, scale=1024)) == brute(
        rows, 1024, 100)
    assert H.exact_products(np.array([[2.0**40, 3.0]]), np.array([[2.0**21, 5.0]]))[0, 0] == 2**61 + 15
    with pytest.raises(OverflowError):
        H.exact_products(np.array([[2.0**40, 0.0]]), np.array([[2.0**40, 0.0]]))


def test_summaries_settle_pairs():
    """Where segments tell vectors apart, hardly any pair is scored exactly."""
    rng = np.random.default_rng(8)
    n, dims = 4000, 64
    centre = rng.normal(size=(40, 16)).repeat(4, 1) * 300
    points = np.round(centre.repeat(n // 40, 0) + rng.normal(size=(n, dims)) * 3)
    labels = np.arange(40).repeat(n // 40)
    rows = H.Block(*H.Block.pack(np.arange(n), labels, points))
    some = np.arange(0, n, 100)
    anchors = H.Block(*H.Block.pack(some, labels[some], points[some]))
    own = (points[some] ** 2).sum(1).astype(int)[:, None]
    search = H.Search(anchors, own * 95 // 100, own * 99 // 100, 10, True)
    search.add(rows)
    scores = (points[some] @ points.T).astype(int)
    want = defaultdict(list)
    for a, i in enumerate(some):
        fit = [(-s, j) for j, s in enumerate(scores[a].tolist()) if labels[j] == labels[i] and j != i
               and ceil(own[a, 0] * 95 // 100) <= s <= own[a, 0] * 99 // 100]
        want[a] = [j for _, j in sorted(fit)[:10]]
    at, _, ids, _ = search.answers()
    assert all([j for k, j in zip(at, ids) if k == a] == want[a] for a in range(len(some)))
    other = H.Search(anchors, own * 60 // 100, own * 90 // 100, 10, False)
    other.add(rows)
    assert other.products < 0.05 * other.pairs
