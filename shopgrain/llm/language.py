"""Language identification by character language models with interpolated Kneser-Ney smoothing.

Training counts character trigrams of all learning texts, per language, in one pass and one
aggregation. A trigram's hash packs three symbols of seven bits, so it is exact: 0 stands for any
run of non-letters, 1 to 26 for a to z, and the remaining letters share 101 symbols, neighbours in
Unicode apart. A model therefore holds at most 2^21 trigrams however large the corpus; it is kept
as arrays sorted by hash, and so are the distinct trigrams of a batch that are looked up in them.

A text gets the language of lowest cross-entropy per character. A softmax over the entropies,
scaled by the square root of the length, gives the score; the scale and the entropy beyond which a
text is rejected are set on learning rows that were left out of the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.llm.frames import add_columns, bounded_sample, fold, limit_batches, slices  # noqa: F401
from shopgrain.operators.positions import rows_at
from shopgrain.session import materialise

BITS = 7
SYMBOLS = 1 << BITS
SIZE = SYMBOLS ** 3
UNKNOWN = "und"
MODEL = {"hashes": np.int32, "log_probs": np.float32, "backoff": np.float32, "lower": np.float32}
SCALES = 2.0 ** np.arange(-5, 6)  # that are tried
UNITS = 1 << 40  # of entropy, in which quantiles are counted
HELD_LANGUAGES = 16  # languages whose dense counts one task holds before it hands them on

_symbols: list[np.ndarray] = []


def symbol_table() -> np.ndarray:
    """The symbol of each code point; the capital counts as its small letter."""
    if not _symbols:
        points = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                low = ord(x.lower()[0])
                points[c] = low - 96 if 97 <= low <= 122 else 27 + low % 101
        _symbols.append(points)
    return _symbols[0]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the trigrams of all texts in a row, and where each text's hashes end.

    Each text is read as if a non-letter stood before and after it. Texts without a letter have none.
    """
    joined = "\0\0" + "".join(f"{t}\0\0" if t else "\0\0" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) if t else 0 for t in texts])
    text_of = np.repeat(np.arange(len(texts)), lengths + 2)
    s = symbol_table()[points[2:]]
    blank = s == 0
    keep = ~(blank & np.concatenate([[True], blank[:-1]]))  # one blank for a run of them
    starts = np.zeros(len(s), bool)
    starts[np.cumsum(lengths + 2) - (lengths + 2)] = True
    s, text_of = s[keep].astype(np.int32), text_of[keep]
    if not len(s):
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    first = np.concatenate([[True], text_of[1:] != text_of[:-1]])
    one = np.concatenate([[0], s[:-1]])
    one[first] = 0
    two = np.concatenate([[0], one[:-1]])
    two[first] = 0
    ends = np.cumsum(np.bincount(text_of, minlength=len(texts)))
    return (two << 2 * BITS) | (one << BITS) | s, ends


@dataclass
class Models:
    """Sorted hash arrays per language, and the calibration."""

    languages: list[str]
    hashes: list[np.ndarray]        # seen trigrams, ascending
    log_probs: list[np.ndarray]     # their log probability
    backoff: list[np.ndarray]       # log weight of the shorter history, by pair of symbols
    lower: list[np.ndarray]         # log probability after one symbol, by pair of symbols
    scale: float = 1.0
    limits: list[float] | None = None

    def look_up(self, wanted: np.ndarray) -> np.ndarray:
        """Log probability of each hash, a column per language; unseen trigrams back off."""
        out = np.empty((len(wanted), len(self.languages)), np.float32)
        history, pair = wanted >> BITS, wanted & (SYMBOLS * SYMBOLS - 1)
        for k, hashes in enumerate(self.hashes):
            at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
            out[:, k] = np.where(hashes[at] == wanted, self.log_probs[k][at],
                                 self.backoff[k][history] + self.lower[k][pair])
        return out


def kneser_ney(counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hashes, log probabilities, back-off weights and lower order of one language's counts."""
    def discount(c):
        n1, n2 = (c == 1).sum(), (c == 2).sum()
        return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    def ratio(a, b, otherwise):
        return np.divide(a, b, out=np.full(np.broadcast(a, b).shape, otherwise), where=b > 0)

    c3 = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
    c2 = (c3 > 0).sum(0).astype(np.float64)  # histories a pair follows
    c1 = (c2 > 0).sum(0).astype(np.float64)
    d1, d2, d3 = (discount(c) for c in (c1, c2, c3))
    p1 = np.maximum(c1 - d1, 0) / c1.sum() + d1 * (c1 > 0).sum() / c1.sum() / SYMBOLS
    total = c2.sum(1, keepdims=True)
    p2 = ratio(np.maximum(c2 - d2, 0), total, 0.0) + ratio(
        d2 * (c2 > 0).sum(1, keepdims=True), total, 1.0) * p1
    total = c3.sum(2, keepdims=True)
    weight = ratio(d3 * (c3 > 0).sum(2, keepdims=True), total, 1.0)
    hashes = np.flatnonzero(counts)
    u, v, w = hashes >> 2 * BITS, (hashes >> BITS) % SYMBOLS, hashes % SYMBOLS
    seen = np.maximum(c3[u, v, w] - d3, 0) / total[u, v, 0] + weight[u, v, 0] * p2[v, w]
    return (hashes.astype(np.int32), np.log(seen).astype(np.float32),
            np.log(weight).reshape(-1).astype(np.float32), np.log(p2).reshape(-1).astype(np.float32))


def count_trigrams(df: DataFrame, text: str, lang: str) -> DataFrame:
    """lang, hash, n over all texts: dense partial counts per task, then one sum."""
    limit_batches(df.sparkSession)

    def give(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, dense in held.items():
            at = np.flatnonzero(dense)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                 pa.array(dense[at])], ["lang", "hash", "n"])
        held.clear()

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in slices(batch, "text"):
                texts, langs = piece.column("text").to_pylist(), piece.column("lang").to_pylist()
                for name in sorted(set(langs)):
                    if name not in held and len(held) == HELD_LANGUAGES:
                        yield from give(held)
                    dense = held.setdefault(name, np.zeros(SIZE, np.int64))
                    found, _ = trigrams([t for t, x in zip(texts, langs, strict=True) if x == name])
                    at, n = np.unique(found, return_counts=True)
                    dense[at] += n
        yield from give(held)

    found = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"))
    return found.mapInArrow(run, "lang string, hash int, n bigint").groupBy("lang", "hash").agg(
        F.sum("n").alias("n"))


def _entropies(batch: pa.RecordBatch, text: str, models: Models):
    """Cross-entropy per character and language of each text, and its number of trigrams."""
    found, ends = trigrams(batch.column(text).to_pylist())
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    n = ends - starts
    sums = np.zeros((len(n), len(models.languages)))
    full = np.flatnonzero(n)
    if len(full):
        met = np.zeros(SIZE, bool)
        met[found] = True
        distinct = np.flatnonzero(met)
        place = np.empty(SIZE, np.int32)
        place[distinct] = np.arange(len(distinct))
        table = models.look_up(distinct)
        sums[full] = np.add.reduceat(table[place[found]], starts[full], axis=0, dtype=np.float64)
    return -sums / np.maximum(n, 1)[:, None], n


def train(
    df: DataFrame, learn, calibrate, text: str = "text", lang: str = "lang",
    reject_quantile: float = 0.999, reject_margin: float = 1.5,
    key: tuple[str, ...] = (),
) -> Models:
    """Models from the rows where learn holds, calibrated on rows where calibrate holds.

    Counts cover every learning row, the scale and the limits every calibration row: tasks add up
    losses, and quantiles are found by counting. Columns of `key` may be named and change nothing.
    Rows without a text or a language teach nothing. With no learning row at all there is no
    language, and every text stays unknown.
    """
    def fit(table: pa.Table) -> pa.Table:
        dense = np.zeros(SIZE, np.int64)
        dense[table.column("hash").to_numpy()] = table.column("n").to_numpy()
        parts = kneser_ney(dense)
        return pa.table([table.column("lang").slice(0, 1), *[pa.array([p.tobytes()], pa.binary())
                                                             for p in parts]], ["lang", *MODEL])

    # A model is made by one task from at most 2^21 sums; only models reach the driver.
    made = count_trigrams(df.where(learn), text, lang).groupBy("lang").applyInArrow(
        fit, "lang string, " + ", ".join(f"{c} binary" for c in MODEL)).toArrow().sort_by("lang")
    languages = made.column("lang").to_pylist()
    models = Models(languages, *[[np.frombuffer(x, kind) for x in made.column(c).to_pylist()]
                                 for c, kind in MODEL.items()])
    if not languages:
        return models
    rows = df.where(calibrate & F.col(text).isNotNull() & F.col(lang).isin(languages)).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"))
    shared = df.sparkSession.sparkContext.broadcast(models)

    def fill(batch: pa.RecordBatch) -> list[pa.Array]:
        e, n = _entropies(batch, "text", shared.value)
        true = [languages.index(x) for x in batch.column("lang").to_pylist()]
        apart = np.sqrt(n)[:, None] * (e - e.min(1, keepdims=True))
        own = apart[np.arange(len(true)), true]
        losses = np.stack([np.log(np.exp(-x * apart).sum(1)) + x * own for x in SCALES], 1)
        units = np.rint(e.min(1) * UNITS).astype(np.int64)
        return [pa.array(losses.tolist(), pa.list_(pa.float64())), pa.array(e.argmin(1), pa.int64()),
                pa.array(units, pa.int64()), pa.array(n, pa.int64())]

    fields = [T.StructField("losses", T.ArrayType(T.DoubleType())), T.StructField("best", T.LongType()),
              T.StructField("units", T.LongType()), T.StructField("n", T.LongType())]
    seen = materialise(add_columns(rows, fields, "text", fill).where("n > 0").select(
        "losses", "best", "units"), "calibration")
    sums = seen.groupBy("best").agg(F.count(F.lit(1)).alias("rows"), *[
        F.sum(F.col("losses")[k]).alias(f"loss_{k}") for k in range(len(SCALES))]).collect()
    if sums:
        totals = [sum(r[f"loss_{k}"] for r in sums) for k in range(len(SCALES))]
        models.scale = float(SCALES[int(np.argmin(totals))])
        of_language = {r["best"]: r["rows"] for r in sums}
        overall, = quantiles(seen, ["units"], [sum(of_language.values())], reject_quantile)
        own = dict(zip(sorted(of_language), quantiles(
            seen, ["best", "units"], [of_language[k] for k in sorted(of_language)], reject_quantile),
            strict=True))
        models.limits = [max(overall, own.get(k, overall)) + reject_margin
                         for k in range(len(languages))]
    return models


def quantiles(df: DataFrame, order: list[str], sizes: list[int], share: float) -> list[float]:
    """The quantile of the last column of order, in entropy, of each run of so many rows in that order."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int).tolist()
    places = [(start + share * (n - 1), start + n - 1) for start, n in zip(starts, sizes, strict=True)]
    pairs = [(int(x) + 1, min(int(x) + 1, last) + 1, x - int(x)) for x, last in places]
    held = rows_at(df, order, lambda _: sorted({p for a, b, _ in pairs for p in (a, b)}))
    return [(held[a][-1] + part * (held[b][-1] - held[a][-1])) / UNITS for a, b, part in pairs]


def predict(df: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """df with lang_pred, score, cross_entropy and rejected.

    NULL texts and texts without a letter are `und` with score 0 and no entropy, and are rejected. Other texts get
    a language, rejected where its cross-entropy lies beyond the calibrated limit; ties go to the
    first language by name. Rows are independent of each other; columns with one of the four names
    are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(models)

    def fill(batch: pa.RecordBatch) -> list[pa.Array]:
        m = shared.value
        if not m.languages:
            k = batch.num_rows
            return [pa.array([UNKNOWN] * k), pa.array([0.0] * k), pa.nulls(k, pa.float64()),
                    pa.array([True] * k)]
        e, n = _entropies(batch, text, m)
        best, low = e.argmin(1), e.min(1)
        z = np.exp(-m.scale * np.sqrt(n)[:, None] * (e - low[:, None]))
        known = n > 0
        limits = np.array(m.limits or [np.inf] * len(m.languages))
        return [
            pa.array([m.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)],
                     pa.string()),
            pa.array(np.where(known, 1 / z.sum(1), 0.0), pa.float64()),
            pa.array(low, pa.float64(), mask=~known),
            pa.array(~known | (low > limits[best]), pa.bool_()),
        ]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
              T.StructField("cross_entropy", T.DoubleType()),
              T.StructField("rejected", T.BooleanType())]
    return add_columns(df, fields, text, fill)


def train_on_folds(df: DataFrame, doc_id: str = "doc_id", **options) -> Models:
    """Models from the rows whose crc32(id) mod 4 is not 2; one in 16 of them only calibrates."""
    apart = fold(doc_id, 4) != 2
    for_calibration = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    kept_out = F.shiftright(for_calibration, 2) % 16 == 0
    return train(df, apart & ~kept_out, apart & kept_out, key=(doc_id,), **options)
