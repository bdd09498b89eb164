"""Toxic passages by maximum-scoring segments over token log-odds.

Learning counts in how many toxic and in how many other texts each feature occurs, over all labelled
learning rows; the features of a word are the word and its beginnings, so that unseen inflections
share what their stem has shown. Log-odds under an informative Dirichlet prior (the pooled
frequencies) score the features that a likelihood-ratio test finds significant. A word has the log-odds of its most significant
feature, less a small drift, so that an average text loses score.

In each text one linear scan finds all maximal scoring segments. A segment's significance follows
the extreme-value law of such segments, E = K n exp(-lambda S), with lambda solved from the scores'
distribution in other texts and K from an upper quantile of their best segments. A text's evidence is the sum of
-ln E over its significant segments; a logistic curve fitted on a bounded sample of labelled
learning rows turns it into the score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.llm.frames import add_columns, bounded_sample, limit_batches, slices
from shopgrain.session import materialise

PREFIXES = (4, 5, 6)
KNOWN_WORDS = 400_000
_words = re.compile(r"[^\W_]+").findall


class Features:
    """The features of words: the hash of the word and of its beginnings, remembered by a worker."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.hashes = np.empty((1 << 12, 1 + len(PREFIXES)), np.uint64)

    def of(self, words: list[str]) -> np.ndarray:
        """A row of self.hashes for each word."""
        if len(self.rows) > KNOWN_WORDS:
            self.rows.clear()
        found = list(map(self.rows.get, words))
        if None in found:
            for i, x in enumerate(found):
                if x is None:
                    found[i] = self._learn(words[i])
        return np.array(found, np.int64)

    def _learn(self, word: str) -> int:
        row = self.rows.get(word)
        if row is None:
            row = self.rows[word] = len(self.rows)
            if row == len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
            whole = xxhash.xxh64_intdigest(f"w{word}".encode())
            self.hashes[row] = [whole, *(
                xxhash.xxh64_intdigest(f"p{word[:n]}".encode()) if len(word) >= n else whole
                for n in PREFIXES)]
        return row


def words_of(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The words of all texts in a row, and where each text's begin and end."""
    words: list[str] = []
    ends = np.zeros(len(texts) + 1, np.int64)
    for k, text in enumerate(texts):
        if text:
            words += _words(text.lower())
        ends[k + 1] = len(words)
    return words, ends


def segments(scores: np.ndarray, total: np.ndarray | None = None) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), by one pass over the positive scores.

    Each positive score opens a candidate, which joins the candidates to its left back to the
    nearest one whose left sum is smaller, as long as the right sum of that one is smaller too. A
    candidate knows the nearest one to its left with a smaller left sum, so that those between need
    no look; where there is none, all candidates so far are final. The steps are linear in number.
    """
    if total is None:
        total = np.concatenate([[0.0], np.cumsum(scores)])
    done: list[tuple[int, int, float, float]] = []
    open_: list[tuple[int, int, float, float]] = []
    smaller: list[int] = []
    at = np.flatnonzero(scores > 0)
    for i, left, right in zip(at.tolist(), total[at].tolist(), total[at + 1].tolist(), strict=True):
        start, j = i, len(open_) - 1
        while True:
            while j >= 0 and open_[j][2] >= left:
                j = smaller[j]
            if j < 0:
                done += open_
                open_, smaller = [], []
                break
            if open_[j][3] >= right:
                break
            start, left = open_[j][0], open_[j][2]
            before = smaller[j]
            del open_[j:], smaller[j:]
            j = before
        open_.append((start, i + 1, left, right))
        smaller.append(j)
    return [(a, b, r - x) for a, b, x, r in done + open_]


@dataclass
class Model:
    """Significant features by ascending hash with their log-odds and z, and the calibration."""

    hashes: np.ndarray
    odds: np.ndarray
    z: np.ndarray
    drift: float
    rate: float = 1.0         # lambda
    log_k: float = 0.0
    intercept: float = -2.0
    slope: float = 1.0

    def scores(self, hashes: np.ndarray) -> np.ndarray:
        """The score of each row of features: the log-odds of its most significant one."""
        if not len(self.hashes):
            return np.full(len(hashes), -self.drift)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        z = np.where(self.hashes[at] == hashes, self.z[at], 0.0)
        best = np.abs(z).argmax(1)
        here = np.arange(len(hashes))
        return np.where(z[here, best] != 0, self.odds[at[here, best]], 0.0) - self.drift

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> float:
        """Sum of -ln E over the segments with E below 1; 0 without any."""
        if not found:
            return 0.0
        x = self.rate * np.array([s for _, _, s in found]) - self.log_k - np.log(max(n, 1))
        return float(x[x > 0].sum())

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * np.log1p(evidence), -30, 30)))


def count_presence(df: DataFrame, text: str, toxic: str) -> DataFrame:
    """feature, toxic_texts, other_texts over all rows; feature 0 counts the texts themselves."""
    limit_batches(df.sparkSession)
    features = Features()

    def run(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                words, ends = words_of(piece.column("text").to_pylist())
                rows, found = features.of(words), ([], [])
                for mark, a, b in zip(piece.column("toxic").to_pylist(), ends, ends[1:], strict=False):
                    own = np.unique(features.hashes[np.unique(rows[a:b])])
                    found[not mark].append(np.append(own, np.uint64(0)))
                for mark in (0, 1):
                    if found[mark]:
                        at, n = np.unique(np.concatenate(found[mark]), return_counts=True)
                        none = np.zeros(len(at), np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(at.view(np.int64)), pa.array(none if mark else n),
                             pa.array(n if mark else none)],
                            ["feature", "toxic_texts", "other_texts"])

    found = df.select(F.col(text).alias("text"), (F.col(toxic) != 0).alias("toxic"))
    return found.mapInArrow(run, "feature bigint, toxic_texts bigint, other_texts bigint").groupBy(
        "feature").agg(F.sum("toxic_texts").alias("toxic_texts"),
                       F.sum("other_texts").alias("other_texts"))


def log_odds(counts: DataFrame, n_toxic: int, n_other: int, prior: float) -> DataFrame:
    """counts with delta, the log-odds under a Dirichlet prior of pooled frequencies, and its z.

    z is the signed root of the likelihood ratio of presence in toxic and in other texts. It needs
    no variance, so that a feature that one side never has is judged by the counts of the other.
    """
    a, b = F.col("toxic_texts"), F.col("other_texts")
    n = n_toxic + n_other

    def term(seen: Column, total: Column, texts: int) -> Column:
        return F.when(seen > 0, seen * F.log(seen * n / (total * texts))).otherwise(0.0)

    has, lacks = a + b, n - a - b
    ratio = (term(a, has, n_toxic) + term(b, has, n_other)
             + term(n_toxic - a, lacks, n_toxic) + term(n_other - b, lacks, n_other))
    side = F.when(a / n_toxic >= b / n_other, 1.0).otherwise(-1.0)
    alpha = has * (prior / n) + 0.01
    x, y = a + alpha, b + alpha
    delta = (F.log(x / F.greatest(n_toxic + prior - x, F.lit(0.5)))
             - F.log(y / F.greatest(n_other + prior - y, F.lit(0.5))))
    return counts.withColumn("delta", delta).withColumn(
        "z", side * F.sqrt(2 * F.greatest(ratio, F.lit(0.0))))


def decay(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum w exp(lambda s) = 1, for scores of negative mean."""
    w = weights / weights.sum()

    def excess(x: float) -> float:
        return float((w * np.exp(np.minimum(x * scores, 700))).sum()) - 1

    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if excess(mid) > 0 else (mid, high)
    return max(high, 1e-3)


def train(
    rows: DataFrame, text: str = "text", toxic: str = "toxic", prior: float = 20.0,
    z_least: float = 4.0, drift: float = 0.25, label_rows: int = 1 << 20,
    calibration_rows: int = 6000, null_quantile: float = 0.95,
) -> Model:
    """A model from labelled rows; rows with a NULL label teach nothing, NULL texts have no words.

    The model learns from about label_rows rows, from all where there are no more, and keeps every
    feature whose |z| reaches z_least. The curve is fitted on a sample of about calibration_rows
    rows. Samples are drawn by all columns of rows, so that a document id keeps copies apart. Without a toxic and another row no word scores,
    and all texts get one low score.
    """
    rows = rows.where(F.col(toxic).isNotNull())
    rows = bounded_sample(rows, F.struct(*rows.columns), label_rows)
    counts = materialise(count_presence(rows, text, toxic), "presence")
    total = counts.where("feature = 0").first()
    n_tox, n_oth = (total["toxic_texts"], total["other_texts"]) if total else (0, 0)
    if not n_tox or not n_oth:
        none = np.empty(0)
        return Model(none.astype(np.uint64), none, none, drift, slope=0.0)
    kept = log_odds(counts.where("feature <> 0"), n_tox, n_oth, prior).where(
        F.abs("z") >= z_least).select("feature", "delta", "z").toArrow()
    hashes = kept.column("feature").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    delta, z = (kept.column(c).to_numpy()[order] for c in ("delta", "z"))
    model = Model(hashes[order], delta, z, drift)
    some = bounded_sample(rows, F.struct(*rows.columns), calibration_rows).select(
        F.col(text).alias("text"), (F.col(toxic) != 0).alias("toxic"))
    seen = passages(some, model, "text").select(
        "toxic", "n_tokens", "word_scores",
        F.transform("passages", lambda p: p["score"]).alias("s")).toArrow()
    n = seen.column("n_tokens").to_numpy()
    y = np.array(seen.column("toxic").to_pylist(), bool)
    s = seen.column("s").to_pylist()
    best = np.array([max(x, default=0.0) for x in s])
    others = ~y & (n > 0)
    null = [v for v, other in zip(seen.column("word_scores").to_pylist(), others, strict=True) if other]
    if null:
        values = np.concatenate([np.array([x["value"] for x in v]) for v in null])
        weights = np.concatenate([np.array([x["words"] for x in v]) for v in null])
        model.rate = decay(values, weights)
    if others.any():  # a share of exp(-E) of other texts has no better segment
        tail = model.rate * best[others] - np.log(n[others])
        model.log_k = float(np.quantile(tail, null_quantile) + np.log(-np.log(null_quantile)))
    x = np.log1p([model.evidence([(0, 0, v) for v in v_s], k) for v_s, k in zip(s, n, strict=True)])
    model.intercept, model.slope = logistic(x, y)
    return model


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a lightly damped logistic regression, by Newton steps."""
    design, beta = np.column_stack([np.ones_like(x), x]), np.zeros(2)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (y - p) - 0.01 * beta
        hess = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        beta = beta + np.linalg.solve(hess, grad)
    return float(beta[0]), float(beta[1])


_spread = T.StructType([T.StructField("value", T.DoubleType()),
                        T.StructField("words", T.LongType())])
_passage = T.StructType([T.StructField("first_token", T.IntegerType()),
                         T.StructField("end_token", T.IntegerType()),
                         T.StructField("score", T.DoubleType())])


def passages(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """df with n_tokens, word_scores, passages (all maximal segments), evidence and score.

    word_scores is how many words have each value of the token score. NULL and empty texts have no
    token and no passage, and the score of no evidence. Rows are independent of each other, and
    columns with one of the five names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    features, known = Features(), [np.empty(0)]

    def fill(batch: pa.RecordBatch) -> list[pa.Array]:
        m = shared.value
        words, ends = words_of(batch.column(text).to_pylist())
        before = len(features.rows)
        rows = features.of(words)
        if len(features.rows) < before or not len(known[0]):  # it has forgotten, or is new
            known[0] = np.empty(0)
        fresh = features.hashes[len(known[0]):len(features.rows)]
        known[0] = np.concatenate([known[0], m.scores(fresh)])
        scores, n = known[0][rows], np.diff(ends)
        parts, spread = [], []
        for a, b in zip(ends, ends[1:], strict=False):
            parts.append(segments(scores[a:b]))
            spread.append(zip(*np.unique(scores[a:b], return_counts=True), strict=True))
        evidence = np.array([m.evidence(p, k) for p, k in zip(parts, n, strict=True)])
        return [
            pa.array(n, pa.int64()),
            pa.array([[{"value": v, "words": k} for v, k in x] for x in spread], pa.list_(
                pa.struct([("value", pa.float64()), ("words", pa.int64())]))),
            pa.array([[{"first_token": a, "end_token": b, "score": s} for a, b, s in p]
                      for p in parts],
                     pa.list_(pa.struct([("first_token", pa.int32()), ("end_token", pa.int32()),
                                         ("score", pa.float64())]))),
            pa.array(evidence, pa.float64()), pa.array(m.probability(evidence), pa.float64()),
        ]

    fields = [T.StructField("n_tokens", T.LongType()),
              T.StructField("word_scores", T.ArrayType(_spread)),
              T.StructField("passages", T.ArrayType(_passage)),
              T.StructField("evidence", T.DoubleType()), T.StructField("score", T.DoubleType())]
    return add_columns(df, fields, text, fill)


def labelled(df: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic",
             with_id: bool = False) -> DataFrame:
    """The texts of learning rows with their labels; of several labels of an id the largest.

    Labels grow with the corpus, so the join is a shuffle at every size.
    """
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(label).alias("toxic")).where("toxic IS NOT NULL")
    return df.where(learn).select("doc_id", "text").join(
        marks.hint("merge"), "doc_id").select(*["doc_id"] * with_id, "text", "toxic")
