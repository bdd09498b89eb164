"""Hard negatives for contrastive training, by segment summary filtering.

A vector is cut into segments, and each segment is summed up by its mean and its deviation. With
segments of length l the inner product of two vectors lies within

    sum l (mean mean' - deviation deviation')  ..  sum l (mean mean' + deviation deviation')

so a pair can be settled by its summaries: left out where the upper bound is below the worst score
still wanted, or the lower bound above the highest one allowed. Pairs that stay open are looked at
again with segments of half the length, and only those that no summary settles are scored exactly.
The same bounds over whole blocks (ranges of means, greatest deviations) settle pairs of blocks.

Anchors are a stated set of rows; their blocks are compared with blocks of all rows. A task takes a
block of anchors through a lane of several blocks and keeps the best answers found so far, which
raises the score that later rows have to reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.llm.frames import limit_batches
from shopgrain.session import materialise

LABELS, SIGNS = 64, 10  # rows are laid out in cells of 64 label buckets and 2^10 directions
NONE = np.iinfo(np.int64).min + 1  # no score; it can be negated
NO_ID = np.iinfo(np.int64).max
STRIP = 1024  # rows of a block that are filtered at once
FINEST = 16  # segments of the finest summaries


def finite_whole(vector: str, scale: int) -> Column:
    """Components floor(scale * x) as doubles; NULL for a vector that cannot be scored."""
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    sound = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floor() gives a long, which is too small for large components; those are whole as they are.
    whole = F.transform(scaled, lambda x: F.when(
        F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x))
    return F.when((F.size(vector) > 0) & F.coalesce(sound, F.lit(False)), whole)


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole vectors as longs; fails where one is no long."""
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[-1]
    if largest < 2.0**53:
        return (q @ x.T).astype(np.int64)
    if largest < 2.0**63:
        return q.astype(np.int64) @ x.astype(np.int64).T
    whole = [[[int(v) for v in row] for row in side] for side in (q, x)]
    return np.array([[sum(map(int.__mul__, a, b)) for b in whole[1]] for a in whole[0]],
                    np.int64).reshape(len(q), len(x))


def summaries(points: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment, both times the root of its length."""
    parts = np.array_split(points, segments, axis=1)
    root = np.sqrt([p.shape[1] for p in parts])
    mean = np.stack([p.mean(1) for p in parts], 1)
    spread = np.stack([p.std(1) for p in parts], 1)
    return mean * root, spread * root


def coarser(mean: np.ndarray, spread: np.ndarray, lengths: np.ndarray) -> tuple:
    """The summaries of neighbouring segments taken together, two at a time."""
    if mean.shape[1] % 2:  # an odd segment stays alone
        last = (mean[:, -1:], spread[:, -1:], lengths[-1:])
        if mean.shape[1] == 1:
            return last
        head = coarser(mean[:, :-1], spread[:, :-1], lengths[:-1])
        return tuple(np.concatenate(p, -1) for p in zip(head, last, strict=True))
    both = lengths[::2] + lengths[1::2]
    joined = (mean[:, ::2] * np.sqrt(lengths[::2]) + mean[:, 1::2] * np.sqrt(lengths[1::2]))
    joined /= np.sqrt(both)
    squares = (mean**2 + spread**2)
    rest = squares[:, ::2] + squares[:, 1::2] - joined**2
    return joined, np.sqrt(np.maximum(rest, 0)), both


class Block:
    """Rows with ids, labels and whole components, and the summaries of all levels, coarse first."""

    def __init__(self, ids: bytes, labels: bytes, points: bytes, summary: bytes):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        self.points = np.frombuffer(points, "<f8").reshape(len(self.ids), -1)
        dims = self.points.shape[1]
        finest = min(FINEST, dims)
        stored = np.frombuffer(summary, "<f8").reshape(2, len(self.ids), finest)
        lengths = np.array([len(p) for p in np.array_split(np.arange(dims), finest)], np.float64)
        level = (stored[0], stored[1], lengths)
        self.levels = [level[:2]]
        while level[0].shape[1] > 1:
            level = coarser(*level)
            self.levels.insert(0, level[:2])

    @staticmethod
    def pack(ids: np.ndarray, labels: np.ndarray, points: np.ndarray) -> list[bytes]:
        mean, spread = summaries(points, min(FINEST, points.shape[1]))
        return [ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(),
                points.astype("<f8").tobytes(), np.stack([mean, spread]).astype("<f8").tobytes()]


class Search:
    """The best answers of a block of anchors in each of their windows of scores.

    low and high (anchors x windows) bound the scores allowed; a window with low > high has none.
    same tells whether answers have the anchor's label or another one.
    """

    def __init__(self, anchors: Block, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.anchors, self.low, self.high, self.k, self.same = anchors, low, high, k, same
        self.score = np.full((*low.shape, k), NONE)
        self.id = np.full((*low.shape, k), NO_ID)
        self.products = self.pairs = 0

    def wanted(self) -> tuple[np.ndarray, np.ndarray]:
        """The scores between which a row can still be an answer of an anchor."""
        least = np.maximum(self.low, self.score[:, :, -1]).astype(np.float64)
        closed = self.low > self.high
        least = np.where(closed, np.inf, least).min(1, initial=np.inf)
        return least, np.where(closed, -np.inf, self.high.astype(np.float64)).max(1, initial=-np.inf)

    def add(self, block: Block) -> None:
        for start in range(0, len(block.ids), STRIP):
            self._strip(block, slice(start, start + STRIP))

    def _strip(self, block: Block, rows: slice) -> None:
        a, ids = self.anchors, block.ids[rows]
        equal = a.labels[:, None] == block.labels[rows][None]
        open_ = (equal if self.same else ~equal) & (a.ids[:, None] != ids[None])
        self.pairs += int(open_.sum())
        least, most = self.wanted()
        for (mean_a, spread_a), (mean_x, spread_x) in zip(a.levels, block.levels, strict=True):
            who = np.flatnonzero(open_.any(1))
            what = np.flatnonzero(open_.any(0))
            if not len(who):
                return
            middle = mean_a[who] @ mean_x[rows][what].T
            reach = spread_a[who] @ spread_x[rows][what].T
            slack = 1e-9 * (np.abs(middle) + reach) + 1e-6
            fits = (middle + reach + slack >= least[who, None]) & (
                middle - reach - slack <= most[who, None])
            open_[np.ix_(who, what)] &= fits
        self._score(block, rows, open_)

    def _score(self, block: Block, rows: slice, open_: np.ndarray) -> None:
        who, what = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
        if not len(who):
            return
        open_ = open_[np.ix_(who, what)]
        self.products += int(open_.sum())
        found = exact_products(self.anchors.points[who], block.points[rows][what])
        ids = block.ids[rows][what]
        for w in range(self.low.shape[1]):
            hit = open_ & (found >= np.maximum(self.low[who, w], self.score[who, w, -1])[:, None])
            hit &= found <= self.high[who, w][:, None]
            some = np.flatnonzero(hit.any(1))
            if not len(some):
                continue
            at = who[some]
            score = np.concatenate([self.score[at, w], np.where(hit[some], found[some], NONE)], 1)
            near = np.where(hit[some], ids[None], NO_ID)
            near = np.concatenate([self.id[at, w], near], 1)
            kth = -np.partition(-score, self.k - 1, 1)[:, self.k - 1:self.k]
            width = max(int((score >= kth).sum(1).max()), self.k)  # all that tie with the last stay
            if width < score.shape[1]:
                take = np.argpartition(-score, width - 1, 1)[:, :width]
                # Rows with more ties than others still have all of theirs: width is the largest.
                score, near = (np.take_along_axis(v, take, 1) for v in (score, near))
            order = np.lexsort((near, -score), 1)[:, :self.k]
            self.score[at, w] = np.take_along_axis(score, order, 1)
            self.id[at, w] = np.take_along_axis(near, order, 1)

    def answers(self) -> tuple[np.ndarray, ...]:
        """anchor, window, id and score of all answers."""
        at, w, j = np.nonzero(self.id != NO_ID)
        return at, w, self.id[at, w, j], self.score[at, w, j]


def packed_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """dims, number, n, buckets, low, high, spread and the packed Block of about block_rows rows each.

    rows has id, label and v. Rows are laid out by the bucket of their label and the signs of their
    segment sums; a cell with more rows than a block spans several, by a hash of the id. Blocks of
    one length are numbered from 0; low, high and spread bound their summaries by four segments.
    """
    def sign(k: int) -> Column:
        n = F.size("v")
        first, end = (F.floor(n * j / SIGNS).cast("int") for j in (k, k + 1))
        total = F.aggregate(F.slice("v", first + 1, end - first), F.lit(0.0), lambda s, x: s + x)
        return F.when(total >= 0, 1 << k).otherwise(0)

    bucket = F.pmod(F.xxhash64("label"), F.lit(LABELS)).cast("int")
    laid = rows.withColumn("dims", F.size("v")).withColumn("bucket", bucket).withColumn(
        "cell", F.col("bucket") * (1 << SIGNS) + sum(
            (sign(k) for k in range(1, SIGNS)), sign(0)))
    sizes = laid.groupBy("dims", "cell").agg(F.count(F.lit(1)).alias("n_cell"))
    before = F.coalesce(F.sum("n_cell").over(Window.partitionBy("dims").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    cells = materialise(sizes.withColumn("first", before), "cells")
    dealt = laid.join(cells, ["dims", "cell"]).withColumn("number", F.floor(
        (F.col("first") + F.pmod(F.xxhash64("id"), F.col("n_cell"))) / block_rows))

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        points = np.array(table.column("v").to_pylist(), np.float64).reshape(len(table), -1)
        packed = Block.pack(table.column("id").to_numpy(), table.column("label").to_numpy(), points)
        mean, spread = summaries(points, min(4, points.shape[1]))
        return pa.table([
            pa.array([points.shape[1]], pa.int32()), table.column("number").slice(0, 1),
            pa.array([len(table)], pa.int32()),
            pa.array([sorted(set(table.column("bucket").to_pylist()))], pa.list_(pa.int32())),
            *[pa.array([v.tolist()], pa.list_(pa.float64()))
              for v in (mean.min(0), mean.max(0), spread.max(0))],
            *[pa.array([p], pa.binary()) for p in packed]],
            ["dims", "number", "n", "buckets", "low", "high", "spread", *PACKED])

    return materialise(dealt.groupBy("dims", "number").applyInArrow(
        build, "dims int, number bigint, n int, buckets array<int>, low array<double>, "
        "high array<double>, spread array<double>, ids binary, labels binary, points binary, "
        "summary binary"), "blocks")


PACKED = ["ids", "labels", "points", "summary"]


def _reach(sign: int) -> Column:
    """A bound of all products between blocks q and x: the upper one, or with -1 the lower one."""
    pick = F.greatest if sign > 0 else F.least

    def part(i: Column) -> Column:
        corners = [F.col(f"q.{a}")[i] * F.col(f"x.{b}")[i] for a in ("low", "high") for b in ("low", "high")]
        return pick(*corners) + sign * F.col("q.spread")[i] * F.col("x.spread")[i]

    total = F.aggregate(F.sequence(F.lit(0), F.size("q.low") - 1), F.lit(0.0), lambda s, i: s + part(i))
    return total + sign * (F.abs(total) * 1e-9 + 1e-6)


def block_pairs(asked: DataFrame, data: DataFrame) -> DataFrame:
    """qn, xn, dims, upper, lower, shares: all pairs of a block of anchors and a block of rows.

    Every block of anchors is stated against all blocks of its length, by their numbers. shares
    tells whether they can have a label in common.
    """
    many = data.groupBy("dims").agg((F.max("number") + 1).alias("many"))
    brief = ["dims", "number", "buckets", "low", "high", "spread"]
    q = asked.select(*brief).join(many, "dims").select(
        F.struct(*brief).alias("q"), "dims", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.col("many") - 1)).alias("number"))
    x = data.select(F.struct(*brief).alias("x"), "dims", "number")
    return q.join(x, ["dims", "number"]).select(
        "dims", F.col("q.number").alias("qn"), F.col("x.number").alias("xn"),
        _reach(1).alias("upper"), _reach(-1).alias("lower"),
        F.arrays_overlap("q.buckets", "x.buckets").alias("shares"))


def hard_negatives(
    rows: DataFrame, anchors: Column, vec_id: str = "vec_id", label: str = "label",
    vector: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 10,
    least_percent: int = 30, most_percent: int = 90, block_rows: int = 8192,
    query_rows: int = 1024, lane_blocks: int = 8,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of components floor(scale * x). The positives of an anchor (a row
    for which the condition `anchors` holds) are its best rows of the same label; the negatives of a
    positive are the best rows of other labels whose score lies within least_percent and
    most_percent of the positive's. Ties go to smaller ids, a row is never its own answer, and where
    there are fewer rows there are fewer answers.

    Labels are whole numbers. Rows without an id or label, and rows whose vector is NULL, empty, or
    holds a NULL or non-finite component (before or after scaling) take no part; vectors are
    compared with those of their length. An id is one row: of several, the one with the smallest
    label, then vector. A score that is no long fails. Blocks and lanes bound memory; they decide
    where rows are compared, never whether.
    """
    limit_batches(rows.sparkSession)
    packed = rows.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("bigint").alias("label"),
        F.col(f"`{vector}`").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asked"))
    packed = packed.withColumn("v", finite_whole("vector", scale)).where(
        "id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    found = materialise(packed.groupBy("id").agg(F.min(F.struct("label", "v", "asked")).alias(
        "r")).select("id", "r.*"), "vectors")
    data = packed_blocks(found.drop("asked"), block_rows)
    asked = packed_blocks(found.where("asked").drop("asked"), query_rows)
    pairs = materialise(block_pairs(asked, data), "block_pairs")

    near = _searched(pairs.where("shares"), asked, data, None, positives, lane_blocks)
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "found")
    near = materialise(near.withColumn("r", F.row_number().over(best)).where(
        F.col("r") <= positives), "positives")
    def percent(p: int, up: bool) -> Column:
        part = F.col("score").cast("decimal(25,0)") * p / 100
        return (F.ceil(part) if up else F.floor(part)).cast("bigint")

    windows = materialise(near.select(
        "dims", "qn", "anchor", "found", "score", percent(least_percent, True).alias("low"),
        percent(most_percent, False).alias("high")).where("low <= high").groupBy("dims", "qn").agg(
        F.collect_list(F.struct("anchor", "found", "score", "low", "high")).alias("windows"),
        F.min("low").alias("least"), F.max("high").alias("most")), "windows")
    open_ = pairs.join(windows.drop("windows"), ["dims", "qn"]).where(
        (F.col("upper") >= F.col("least")) & (F.col("lower") <= F.col("most")))
    far = _searched(open_, asked, data, windows.select("dims", "qn", "windows"), negatives,
                    lane_blocks)
    ranked = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "found")
    return far.withColumn("rank", F.row_number().over(ranked)).where(
        F.col("rank") <= negatives).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _searched(pairs: DataFrame, asked: DataFrame, data: DataFrame, windows: DataFrame | None,
              k: int, lane_blocks: int) -> DataFrame:
    """dims, qn, anchor, positive, positive_score, found, score: the k best of each lane of pairs.

    Without windows the answers have the anchor's label, else another one.
    """
    q = asked.select("dims", F.col("number").alias("qn"), *[F.col(c).alias(f"q_{c}") for c in PACKED])
    if windows is not None:
        q = q.join(windows, ["dims", "qn"])
    else:
        q = q.withColumn("windows", F.lit(None).cast(
            "array<struct<anchor:bigint,found:bigint,score:bigint,low:bigint,high:bigint>>"))
    x = data.select("dims", F.col("number").alias("xn"), *PACKED)
    lane = F.floor(F.col("xn") / lane_blocks)
    both = pairs.select("dims", "qn", "xn", "upper", lane.alias("lane")).join(
        x, ["dims", "xn"]).join(q, ["dims", "qn"])
    # The blocks of a lane that reach highest come first.
    both = both.repartition("dims", "qn", "lane").sortWithinPartitions(
        "dims", "qn", "lane", F.desc("upper"), "xn")
    columns = ["dims", "qn", "lane", "windows", *[f"q_{c}" for c in PACKED], *PACKED]
    limit_batches(asked.sparkSession, 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = search = wide = None

        def flush() -> Iterator[pa.RecordBatch]:
            if search is None:
                return
            at, w, ids, scores = search.answers()
            n = len(ids)
            named = wide[at, w] if wide is not None else np.zeros((n, 2), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, key[0], np.int32)), pa.array(np.full(n, key[1], np.int64)),
                 pa.array(search.anchors.ids[at]), pa.array(named[:, 0].copy()),
                 pa.array(named[:, 1].copy()), pa.array(ids), pa.array(scores)],
                ["dims", "qn", "anchor", "positive", "positive_score", "found", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in ("dims", "qn", "lane")}
                if key != tuple(r.values()):
                    yield from flush()
                    key = tuple(r.values())
                    anchors = Block(*[batch.column(f"q_{c}")[i].as_py() for c in PACKED])
                    given = batch.column("windows")[i].as_py()
                    low, high, wide = _windows(anchors.ids, given)
                    search = Search(anchors, low, high, k, given is None)
                search.add(Block(*[batch.column(c)[i].as_py() for c in PACKED]))
        yield from flush()

    return materialise(both.select(*columns).mapInArrow(
        run, "dims int, qn bigint, anchor bigint, positive bigint, positive_score bigint, "
        "found bigint, score bigint"), "answers")


def _windows(ids: np.ndarray, given: list[dict] | None) -> tuple:
    """low and high per anchor and window, and the positive's id and score of each."""
    if given is None:
        return np.full((len(ids), 1), NONE + 1), np.full((len(ids), 1), NO_ID), None
    of: dict[int, list] = {}
    for w in given:
        of.setdefault(w["anchor"], []).append(w)
    most = max(map(len, of.values()), default=1)
    low, high = np.full((len(ids), most), NO_ID), np.full((len(ids), most), NONE)
    wide = np.zeros((len(ids), most, 2), np.int64)
    for i, a in enumerate(ids.tolist()):
        for j, w in enumerate(of.get(a, [])):
            low[i, j], high[i, j], wide[i, j] = w["low"], w["high"], (w["found"], w["score"])
    return low, high, wide
