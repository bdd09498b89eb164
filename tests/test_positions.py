"""Global positions, quintiles and medians against Spark's own single-task functions."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from conftest import rows
from shopgrain.operators.positions import exact_median, global_ntile, global_ntiles, rows_at


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "v BIGINT, k BIGINT").repartition(4)


def shapes():
    rng = random.Random(7)
    yield "distinct", [(rng.randrange(-10**15, 10**15), k) for k in range(700)]
    yield "one value holds a third", [(5 if k % 3 == 0 else rng.randrange(100), k)
                                      for k in range(700)]
    yield "all equal", [(3, k) for k in range(300)]
    yield "far outlier", [(rng.randrange(10), k) for k in range(300)] + [(2**62, 1000)]
    yield "fewer rows than tiles", [(2, 0), (1, 1), (1, 2)]
    yield "one row", [(1, 1)]
    yield "borders among NULLs", [(None if k % 2 else rng.randrange(9), k) for k in range(200)]
    yield "all NULL", [(None, k) for k in range(20)]
    yield "NULLs in both", [(None, None), (1, None), (1, 2), (None, 3), (2, None), (2, -4)]


@pytest.mark.parametrize("pairs", [p for _, p in shapes()], ids=[n for n, _ in shapes()])
@pytest.mark.parametrize("fanout", [3, 4096])
def test_ntile_equals_window_function(spark, pairs, fanout):
    df = frame(spark, pairs)
    expected = df.withColumn("t", F.ntile(5).over(W.orderBy("v", "k")))
    got = df.withColumn("t", global_ntile(df, ["v", "k"], 5, fanout))
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("pairs", [p for _, p in shapes()], ids=[n for n, _ in shapes()])
def test_median_equals_percentile(spark, pairs):
    df = frame(spark, pairs)
    assert exact_median(df, "v") == df.agg(F.percentile("v", 0.5)).first()[0]


def test_median_of_nothing(spark):
    assert exact_median(frame(spark, [(None, 1)]), "v") is None
    assert exact_median(frame(spark, []), "v") is None


def test_small_fanout_needs_several_rounds(spark):
    pairs = [(k * k % 1009, k) for k in range(500)]
    got = rows_at(frame(spark, pairs), ["v", "k"], lambda n: [1, 250, n], fanout=3)
    ordered = sorted(pairs)
    assert got == {1: ordered[0], 250: ordered[249], 500: ordered[499]}


def test_position_outside(spark):
    with pytest.raises(ValueError):
        rows_at(frame(spark, [(1, 1)]), ["v", "k"], lambda n: [n + 1])


def test_several_orders_share_their_rounds(spark):
    rng = random.Random(3)
    df = frame(spark, [(rng.randrange(50), k) for k in range(300)])
    one, two = global_ntiles(df, [["v", "k"], ["k"]], 4)
    got = df.withColumns({"a": one, "b": two})
    want = df.withColumns({"a": F.ntile(4).over(W.orderBy("v", "k")), "b": F.ntile(4).over(W.orderBy("k"))})
    assert rows(got) == rows(want)
