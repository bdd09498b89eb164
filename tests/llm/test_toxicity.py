import math
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm.cases import frame
from shopgrain.llm import toxicity as X
from shopgrain.llm.frames import fold


def brute_segments(scores):
    """All maximal scoring segments: the best one, and those left and right of it."""
    def search(lo, hi):
        best = None
        for i in range(lo, hi):
            for j in range(i + 1, hi + 1):
                s = sum(scores[i:j])
                if s > 0 and (best is None or s > best[0]):
                    best = (s, i, j)
        if best is None:
            return []
        _, i, j = best
        return search(lo, i) + [(i, j)] + search(j, hi)
    return search(0, len(scores))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-5, 5).map(lambda x: x + 0.0), max_size=14))
def test_segments_have_the_scores_of_brute_force(values):
    scores = np.array([v + 1e-3 * (k + 2) ** 0.5 for k, v in enumerate(values)])  # no ties
    got = X.segments(scores)
    want = brute_segments(scores.tolist())
    assert sorted((a, b) for a, b, _ in got) == sorted(want)
    for a, b, s in got:
        assert abs(s - scores[a:b].sum()) < 1e-6


def test_segments_take_linear_time():
    """Twice the scores, twice the steps: counted by the comparisons of sums."""
    class Counted(float):
        steps = 0

        def __ge__(self, other):
            Counted.steps += 1
            return float(self) >= float(other)

    class Scores(np.ndarray):
        def tolist(self):
            return [Counted(x) if isinstance(x, float) else x for x in super().tolist()]

    rng = np.random.default_rng(1)
    shapes = {"falling": lambda n: np.tile([1.0, -2.0], n), "rising": lambda n: np.tile([2.0, -1.0], n),
              "noise": lambda n: rng.normal(size=2 * n), "stairs": lambda n: np.concatenate(
                  [np.tile([2.0, -1.5], n // 2), np.tile([0.2, -2.0], n // 2)])}
    for make in shapes.values():
        for n in (5_000, 20_000):
            Counted.steps = 0
            scores = make(n)
            total = np.concatenate([[0.0], np.cumsum(scores)]).view(Scores)
            found = X.segments(scores, total)
            assert found and Counted.steps <= 8 * n


def test_held_out_texts(spark, folder):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = X.train(X.labelled(docs, labels, fold("doc_id", 5) != 0))
    found = X.passages(docs, model).join(labels, "doc_id").where(fold("doc_id", 5) == 0)
    rates = {r["toxic"]: r["p"] for r in found.groupBy("toxic").agg(
        F.avg((F.col("score") >= 0.5).cast("int")).alias("p")).collect()}
    print("held-out texts found toxic:", rates)
    assert rates[1] >= 0.65 and rates[0] <= 0.06


def test_odd_rows(spark):
    rows = frame(spark).withColumn("toxic", F.when(F.col("doc_id") < 3, 1).when(F.col("doc_id") > 5, 0))
    model = X.train(rows)
    got = X.passages(rows.withColumn("score", F.lit("clash")), model).collect()
    assert len(got) == rows.count()
    assert all(0 <= r["score"] <= 1 for r in got)
    assert all(r["n_tokens"] == 0 and r["passages"] == [] for r in got if not (r["text"] or "").strip())
    one_kind = X.train(rows.where("toxic = 1"))
    assert len({r["score"] for r in X.passages(rows, one_kind).collect()}) == 1
    assert X.passages(rows.limit(0), X.train(rows.limit(0))).count() == 0


def test_labels_of_one_id(spark):
    docs = frame(spark, [(1, "a", None, None, 0), (None, "b", None, None, 0), (2, "c", None, None, 0)])
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None)], "doc_id bigint, toxic int")
    assert [tuple(r) for r in X.labelled(docs, labels, F.lit(True)).collect()] == [("a", 1)]


def test_words_only_in_toxic_texts(spark):
    rows = [(f"plain{i % 50} thing{i % 7}" + (f" slur{i // 12}" if i < 120 else ""), int(i < 120))
            for i in range(1200)]
    model = X.train(spark.createDataFrame(rows, "text string, toxic int"))
    words = [f"slur{i}" for i in range(10)] + [f"plain{i}" for i in range(50)]
    features = X.Features()
    rows = features.of(words)
    hashes = features.hashes[rows][:, 0]
    known = dict(zip(model.hashes.tolist(), model.odds.tolist(), strict=True))
    assert all(known.get(h, 0) > 0 for h in hashes[:10].tolist())
    assert not any(h in known for h in hashes[10:].tolist())


def test_whole_score_against_plain_python(spark):
    """Counts, log-odds, significance, lambda, K, evidence and the curve, all worked out again."""
    rng = random.Random(31)
    plain = [f"{a}{b}" for a in ("wor", "tal", "gre", "sun") for b in ("den", "ker", "ing", "olo", "ust")]
    foul = ["vilest", "rotten", "scummy", "vilely"]
    rows = []
    for i in range(400):
        words = rng.choices(plain, k=rng.randrange(3, 40))
        if i % 4 == 0:
            at = rng.randrange(len(words))
            words[at:at] = rng.choices(foul, k=rng.randrange(1, 5))
        rows.append((" ".join(words), int(i % 4 == 0)))
    rows += [("", 0), ("", 1), (None, 0)]
    df = spark.createDataFrame(rows, "text string, toxic int")
    model = X.train(df, prior=20.0, z_least=4.0, drift=0.25, null_quantile=0.95)

    def features(word):
        return [f"w{word}", *[f"p{word[:n]}" if len(word) >= n else f"w{word}" for n in X.PREFIXES]]

    n = [sum(t == k for _, t in rows) for k in (0, 1)]
    seen = [Counter(f for text, t in rows if t == k
                    for f in {f for w in (text or "").split() for f in features(w)}) for k in (0, 1)]
    odds, z = {}, {}
    for f in set(seen[0]) | set(seen[1]):
        b, a = seen[0][f], seen[1][f]
        has, lacks, total = a + b, sum(n) - a - b, sum(n)
        ratio = sum(c * math.log(c * total / (m * texts)) for c, m, texts in (
            (a, has, n[1]), (b, has, n[0]), (n[1] - a, lacks, n[1]), (n[0] - b, lacks, n[0])) if c)
        alpha = has * 20.0 / total + 0.01
        x, y = a + alpha, b + alpha
        strength = math.copysign(math.sqrt(2 * max(ratio, 0)), 1 if a / n[1] >= b / n[0] else -1)
        if abs(strength) >= 4:
            z[f] = strength
            odds[f] = (math.log(x / max(n[1] + 20 - x, 0.5)) - math.log(y / max(n[0] + 20 - y, 0.5)))
    assert len(model.hashes) == len(odds) > 4

    def score(word):
        known = [f for f in features(word) if f in z]
        return (odds[max(known, key=lambda f: abs(z[f]))] if known else 0.0) - 0.25

    scores = [[score(w) for w in (text or "").split()] for text, _ in rows]
    best = [max([sum(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1)], default=0.0)
            for s in scores]
    best = [max(b, 0.0) for b in best]
    null = [x for s, (_, t) in zip(scores, rows) if not t for x in s]
    low, high = 1e-6, 64.0
    for _ in range(200):  # sum p exp(lambda s) = 1
        mid = (low + high) / 2
        low, high = (low, mid) if sum(math.exp(min(mid * x, 700)) for x in null) > len(null) else (mid, high)
    assert abs(model.rate - high) < 1e-6 * max(high, 1) or (high > 60 and model.rate >= 60)
    rate = model.rate
    tail = [rate * b - math.log(len(s)) for b, s, (_, t) in zip(best, scores, rows) if not t and s]
    log_k = float(np.quantile(tail, 0.95)) + math.log(-math.log(0.95))
    assert abs(model.log_k - log_k) < 1e-6
    for r, s in zip(sorted(X.passages(df, model).collect(), key=lambda r: str(r["text"])),
                    [s for _, s in sorted(zip((str(t) for t, _ in rows), scores))]):
        parts = [sum(s[a:b]) for a, b in brute_segments(s)]
        evidence = sum(max(rate * p - log_k - math.log(len(s)), 0.0) for p in parts)
        assert abs(r["evidence"] - evidence) < 1e-6 * max(1, evidence)
        curve = 1 / (1 + math.exp(-(model.intercept + model.slope * math.log1p(evidence))))
        assert abs(r["score"] - curve) < 1e-9
    right = [(r["score"] >= 0.5) == bool(r["toxic"]) for r in X.passages(df.where("text <> ''"), model).collect()]
    assert sum(right) >= 0.97 * len(right)
