import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm.cases import frame
from shopgrain.llm import language as L


def test_trigrams_keep_texts_apart():
    found, ends = L.trigrams(["Ab!! c", None, "", "é"])
    def key(*s):
        return s[0] << 14 | s[1] << 7 | s[2]
    e = 27 + ord("é") % 101
    assert found.tolist() == [key(0, 0, 1), key(0, 1, 2), key(1, 2, 0), key(2, 0, 3), key(0, 3, 0),
                              key(0, 0, e), key(0, e, 0)]
    assert ends.tolist() == [5, 5, 5, 7]


def test_kneser_ney_is_a_distribution_and_matches_brute_force():
    rng = np.random.default_rng(3)
    seen = Counter(tuple(x) for x in rng.integers(0, 5, (300, 3)))
    counts = np.zeros(L.SIZE, np.int64)
    for (u, v, w), n in seen.items():
        counts[u << 14 | v << 7 | w] = n
    parts = L.kneser_ney(counts)
    models = L.Models(["x"], *[[p] for p in parts])
    table = np.exp(models.look_up(np.arange(L.SIZE))[:, 0]).reshape((L.SYMBOLS,) * 3)
    assert np.allclose(table.sum(2), 1, atol=1e-4)
    want = brute_model(seen)
    for u, v, w in list(seen)[:40]:
        assert math.isclose(table[u, v, w], want(u, v, w), rel_tol=1e-4)


def brute_model(seen):
    """p(u, v, w) of trigram counts in plain Python."""
    def discount(values):
        n1, n2 = (sum(v == k for v in values) for k in (1, 2))
        return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    c2 = Counter((v, w) for _, v, w in seen)
    c1 = Counter(w for _, w in c2)
    d1, d2, d3 = discount(c1.values()), discount(c2.values()), discount(seen.values())
    def p1(w):
        return max(c1[w] - d1, 0) / len(c2) + d1 * len(c1) / len(c2) / L.SYMBOLS
    def p2(v, w):
        own = [n for (a, _), n in c2.items() if a == v]
        if not own:
            return p1(w)
        return max(c2[v, w] - d2, 0) / sum(own) + d2 * len(own) / sum(own) * p1(w)
    def p3(u, v, w):
        own = [k for (a, b, _), k in seen.items() if (a, b) == (u, v)]
        if not own:
            return p2(v, w)
        return max(seen[u, v, w] - d3, 0) / sum(own) + d3 * len(own) / sum(own) * p2(v, w)
    return p3


def brute_trigrams(text):
    """Symbols of a text, runs of non-letters as one, in threes."""
    out, last = [], 0
    for c in text + "\0":
        low = ord(c.lower()[0]) if c.isalpha() else 0
        s = 0 if not low else low - 96 if 97 <= low <= 122 else 27 + low % 101
        if s or last:
            out.append(s)
        last = s
    padded = [0, 0, *out]
    return list(zip(padded, padded[1:], padded[2:])) if out else []


def test_predictions_match_brute_force(spark):
    rng = random.Random(6)
    syllables = {"aa": ["ba", "lo", "mi", "ta"], "bb": ["zu", "krö", "st", "ba"], "cc": ["né", "lo", "qu", "io"]}
    rows = [(i, " ".join("".join(rng.choice(syllables[x]) for _ in range(rng.randrange(1, 4)))
                         for _ in range(rng.randrange(1, 25))), x)
            for i, x in enumerate(rng.choices(sorted(syllables), k=90))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    models = L.train(docs, F.col("doc_id") < 60, F.col("doc_id") >= 60, key=("doc_id",))
    counts = {x: Counter(t for i, text, y in rows if y == x and i < 60 for t in brute_trigrams(text))
              for x in syllables}
    model = {x: brute_model(counts[x]) for x in syllables}
    asked = docs.unionByName(spark.createDataFrame(
        [(100, "zu 12 mi!", None), (101, "ωω xyz", None)], docs.schema))
    entropies = {}
    for r in L.predict(asked, models).collect():
        parts = brute_trigrams(r["text"])
        e = {x: -sum(math.log(p(*t)) for t in parts) / len(parts) for x, p in model.items()}
        best = min(e, key=lambda x: (e[x], x))
        assert r["lang_pred"] == best and abs(r["cross_entropy"] - e[best]) < 1e-4
        z = sum(math.exp(-models.scale * len(parts) ** 0.5 * (h - e[best])) for h in e.values())
        assert abs(r["score"] - 1 / z) < 1e-3
        assert r["rejected"] == (e[best] > models.limits[sorted(e).index(best)])
        entropies[r["doc_id"]] = e[best]
    own = sorted(entropies[i] for i in range(60, 90))
    assert all(own[-1] <= limit <= own[-1] + 1.5 + 1e-6 for limit in models.limits)


def test_calibration_draws_copies_apart(spark):
    """With an id, a text that makes up a third of the rows is not drawn whole or not at all."""
    rows = [(i, "ba lo mi ta" if i % 3 == 0 else f"mi {'ta' * (i % 17)} lo{i}", "aa") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    drawn = L.bounded_sample(docs, F.struct("text", "doc_id"), 300)
    copies = drawn.where("doc_id % 3 = 0").count()
    assert 60 < copies < 150 and 200 < drawn.count() < 400


def test_calibration_takes_every_row(spark):
    """The limits are quantiles over all calibration rows, however many there are."""
    rng = random.Random(4)
    rows = [(i, " ".join("".join(rng.choice(["ba", "lo", "mi", "ta", "zu"]) for _ in range(3))
                         for _ in range(rng.randrange(1, 9))), "ab"[i % 2] * 2) for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    models = L.train(docs, F.col("doc_id") < 500, F.col("doc_id") >= 500)
    e = {i: L._entropies(pa.record_batch({"text": [text]}), "text", models)[0][0]
         for i, text, _ in rows if i >= 500}
    low, best = np.array([x.min() for x in e.values()]), np.array([x.argmin() for x in e.values()])
    overall = np.quantile(low, 0.999)
    want = [max(overall, np.quantile(low[best == k], 0.999)) + 1.5 for k in range(2)]
    assert np.allclose(models.limits, want, atol=1e-9)


def test_counts_cover_all_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("lang = 'fr'").select("text", "lang")
    got = L.count_trigrams(docs, "text", "lang").agg(F.sum("n")).first()[0]
    assert got == sum(len(L.trigrams([r["text"]])[0]) for r in docs.collect())


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    models = L.train_on_folds(docs)
    found = L.predict(docs, models)
    held = found.where(L.fold("doc_id", 4) == 2).agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("rejected").cast("int")))
    right, rejected = held.first()
    assert right > 0.95 and rejected < 0.02


def test_odd_rows_and_no_learning_rows(spark):
    docs = frame(spark)
    models = L.train(docs, F.lit(True), F.lit(True))
    got = L.predict(docs.withColumn("score", F.lit("clash")), models).collect()
    assert len(got) == docs.count()
    for r in got:
        none = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == none and 0 <= r["score"] <= 1
        assert r["rejected"] or not none
    empty = L.train(docs.limit(0), F.lit(True), F.lit(True))
    assert {r["lang_pred"] for r in L.predict(docs, empty).collect()} == {"und"}
    assert L.predict(docs.limit(0), models).count() == 0
