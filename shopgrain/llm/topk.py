"""Exact top-k inner products by dual-tree search over cover trees.

Vectors and queries are grouped around pivots into blocks of bounded size, hot pivots into several,
and each block gets a cover tree: the children of a node are centred on points of the node, a
level's covering radius is half its parent's, and the tree goes down to single places. A query
block and a data block are searched together: a pair of nodes can be skipped where

    <q, x>  <=  <cq, cx> + |cq| rx + |cx| rq + rq rx

lies below the worst k-th score that the queries of the node have so far. Between blocks the same
bound works level by level: each query block is first searched in a data block of its own pivot,
which gives every query a floor; then pairs of pivots, of query blocks and pivots, and of blocks
are formed one from the other, and only those whose bound reaches the worst floor go on.

Scores are whole numbers: products of components floor(scale * x), exact as longs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.llm.frames import bounded_sample, limit_batches
from shopgrain.llm.hard_negatives import exact_products, finite_whole
from shopgrain.session import materialise

NONE = np.iinfo(np.int64).min  # below any score
SEEDS = 256  # centres that are tried at once
AT_ONCE = 64  # query blocks that one task has beside a data block


def _distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - centre) ** 2).sum(1))


def _covered(x: np.ndarray, cover: float) -> list[np.ndarray]:
    """The points in parts, each within about `cover` of its first, which no earlier part covers."""
    left, parts = np.arange(len(x)), []
    norms = (x**2).sum(1)
    while len(left):
        seeds, away = left[:SEEDS], np.ones(len(left), bool)
        near = norms[seeds, None] + norms[left] - 2 * x[seeds] @ x[left].T <= cover**2
        for i, seed in enumerate(seeds):
            if away[i]:
                mine = away & near[i]
                mine[i] = False
                parts.append(np.append(seed, left[mine]))
                away[mine] = away[i] = False
        left = left[away]
    return parts


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the points and the nodes (first, end, radius, child, n_children).

    Nodes are listed level by level; the points of a node are neighbours in the order, the first of
    them is its centre, and a node without children is a single place.
    """
    x = points.astype(np.float64)
    order = np.arange(len(x))
    nodes = [[0, len(x), float(_distances(x, x[0]).max()), 0, 0]]
    at = 0
    while at < len(nodes):
        first, end, radius = nodes[at][:3]
        if radius > 0:
            members = order[first:end].copy()
            parts = _covered(x[members], radius / 2)
            if len(parts) < 2:  # rounding left the node whole: part it into its places
                _, at_place = np.unique(x[members], axis=0, return_inverse=True)
                at_place = at_place.reshape(-1)
                parts = [np.flatnonzero(at_place == k) for k in range(at_place.max() + 1)]
            nodes[at][3:] = [len(nodes), len(parts)]
            for part in parts:
                own = members[part]
                order[first:first + len(own)] = own
                nodes.append([first, first + len(own), float(_distances(x[own], x[own[0]]).max()),
                              0, 0])
                first += len(own)
        at += 1
    return order, np.array(nodes, np.float64)


class Block:
    """Vectors in the order of their tree, with ids and nodes."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, nodes: np.ndarray):
        self.ids, self.points, self.nodes = ids, points, nodes
        self.first, self.end = nodes[:, :2].astype(np.int64).T
        self.radius = nodes[:, 2]
        self.child, self.children = nodes[:, 3:].astype(np.int64).T
        self.centres = points[self.first]
        self.norms = np.sqrt((self.centres**2).sum(1))
        self.largest = float(np.abs(points).max(initial=0))
        self.unique = len(np.unique(ids)) == len(ids)

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray) -> Block:
        by_id = np.argsort(ids, kind="stable")
        order, nodes = cover_tree(points[by_id])
        ids, points = ids[by_id][order], points[by_id][order].astype(np.float64)
        for first, end, _, _, children in nodes[nodes[:, 4] == 0].astype(np.int64):
            ids[first:end].sort()  # the points of a place are equal
        return cls(ids, points, nodes)

    def pack(self) -> list[bytes]:
        kind = "<i4" if self.largest < 2**31 else "<f8"
        return [self.ids.astype("<i8").tobytes(), self.points.astype(kind).tobytes(),
                self.nodes.astype("<f8").tobytes()]

    @classmethod
    def unpack(cls, ids: bytes, points: bytes, nodes: bytes, dims: int) -> Block:
        ids_ = np.frombuffer(ids, "<i8")
        kind = "<i4" if len(points) == 4 * dims * len(ids_) else "<f8"
        return cls(ids_, np.frombuffer(points, kind).reshape(len(ids_), dims).astype(np.float64),
                   np.frombuffer(nodes, "<f8").reshape(-1, 5))


class DualSearch:
    """The k best of a data block for each query of a block, by score and then id.

    floor is a score each query has k answers of elsewhere, or NONE; answers below it are left out.
    A query's own id never answers it, and an id with several vectors answers once, with its best.
    `products` counts the inner products that were taken.
    """

    def __init__(self, queries: Block, data: Block, k: int, floor: np.ndarray):
        self.q, self.x, self.k, self.products = queries, data, k, 0
        n = len(queries.ids)
        self.score = [np.empty(0, np.int64)] * n
        self.id = [np.empty(0, np.int64)] * n
        self.floor, self.worst = floor, floor.astype(np.float64)
        size = queries.largest * data.largest * queries.points.shape[1]
        if size < 2.0**63:
            self.exact = size < 2.0**53
            self._visit(0, np.array([0]), self._products(np.array([0]), np.array([0]))[0])
        else:  # only whole numbers of any size tell what is a long
            found = exact_products(queries.points, data.points)
            for i in range(n):
                self._answers(i, found[i], data.ids)

    def _products(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        self.products += len(i) * len(j)
        return self.q.centres[i] @ self.x.centres[j].T

    def _bound(self, i: int, j: np.ndarray, middle: np.ndarray) -> np.ndarray:
        norm, rq, rx = self.q.norms[i], self.q.radius[i], self.x.radius[j]
        slack = 1e-11 * (norm + rq) * (self.x.norms[j] + rx) + 1e-6
        return middle + norm * rx + self.x.norms[j] * rq + rq * rx + slack

    def _split(self, j: np.ndarray, middle: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The children of nodes j, and the products of their centres with that of query node i.

        The first child has its parent's centre, whose product is known.
        """
        n = self.x.children[j]
        head = np.cumsum(n) - n
        below = np.arange(n.sum()) + np.repeat(self.x.child[j] - head, n)
        fresh = np.ones(len(below), bool)
        fresh[head] = False
        out = np.empty(len(below))
        out[head] = middle
        out[fresh] = self._products(np.array([i]), below[fresh])[0]
        return below, out

    def _visit(self, i: int, j: np.ndarray, middle: np.ndarray) -> None:
        """Search the queries of node i in the nodes j; middle has the products of the centres."""
        q, x = self.q, self.x
        if not q.children[i]:
            for one in range(q.first[i], q.end[i]):
                self._single(i, one, j, middle)
            return
        while True:
            open_ = self._bound(i, j, middle) >= self.worst[q.first[i]:q.end[i]].min()
            j, middle = j[open_], middle[open_]
            large = (x.radius[j] > q.radius[i]) & (x.children[j] > 0)
            if not large.any():
                break
            below, known = self._split(j[large], middle[large], i)
            j, middle = np.append(j[~large], below), np.append(middle[~large], known)
        if not len(j):
            return
        below = np.arange(q.child[i], q.child[i] + q.children[i])
        known = np.concatenate([middle[None], self._products(below[1:], j)])
        for c, row in zip(below, known, strict=True):
            self._visit(c, j, row)

    def _single(self, i: int, one: int, j: np.ndarray, middle: np.ndarray) -> None:
        """Search one query, whose place is node i: the nodes of the highest bounds first."""
        x = self.x
        while len(j):
            bound = self._bound(i, j, middle)
            open_ = bound >= self.worst[one]
            j, middle, bound = j[open_], middle[open_], bound[open_]
            place = x.children[j] == 0
            if place.any():
                self._places(one, j[place], middle[place])
                j, middle, bound = j[~place], middle[~place], bound[~place]
            if not len(j):
                return
            top = np.zeros(len(j), bool)
            top[np.argpartition(-bound, min(self.k, len(j)) - 1)[:self.k]] = True
            below, known = self._split(j[top], middle[top], i)
            j, middle = np.append(j[~top], below), np.append(middle[~top], known)

    def _places(self, one: int, j: np.ndarray, middle: np.ndarray) -> None:
        """Take the points of the places j as answers; of equal points the smallest ids will do."""
        x = self.x
        n = np.minimum(x.end[j] - x.first[j], self.k + 1)
        head = np.cumsum(n) - n
        at = np.arange(n.sum()) + np.repeat(x.first[j] - head, n)
        if self.exact:
            score = np.repeat(middle, n).astype(np.int64)
        else:
            score = exact_products(self.q.points[one][None], x.points[at])[0]
        self._answers(one, score, x.ids[at])

    def _answers(self, one: int, score: np.ndarray, ids: np.ndarray) -> None:
        own = (ids == self.q.ids[one]) | (score < self.floor[one])
        score, ids = score[~own], ids[~own]
        if self.x.unique and len(score) > 8 * self.k:  # the k best reach the k-th score
            kth = np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids = score[score >= kth], ids[score >= kth]
        score, ids = np.append(self.score[one], score), np.append(self.id[one], ids)
        order = np.lexsort((ids, -score))
        score, ids = score[order], ids[order]
        _, best = np.unique(ids, return_index=True)
        best = np.sort(best)[:self.k]
        self.score[one], self.id[one] = score[best], ids[best]
        if len(best) == self.k:
            self.worst[one] = max(self.worst[one], float(score[best[-1]]))

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query id, id and score of all answers."""
        sizes = [len(s) for s in self.score]
        return (np.repeat(self.q.ids, sizes), np.concatenate([*self.id, np.empty(0, np.int64)]),
                np.concatenate([*self.score, np.empty(0, np.int64)]))


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def blocks(vectors: DataFrame, pivots: np.ndarray, rows: int) -> DataFrame:
    """block, pivot, dims, n, centre, radius, and a packed tree of at most ~2 * rows vectors each.

    vectors has id and v. A vector joins its nearest pivot; a pivot of many vectors is dealt to as
    many blocks as its count asks for, by a hash of the id.
    """
    limit_batches(vectors.sparkSession, 4096)
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(pivots)

    def nearest(batches):
        p = shared.value.astype(np.float64)
        for batch in batches:
            column = batch.column("v")
            dims = column.value_lengths().to_numpy(zero_copy_only=False)
            out = np.zeros(len(dims), np.int64)
            fit = np.flatnonzero(dims == p.shape[1])
            if len(fit) and len(p):
                x = matrix(column.take(pa.array(fit)), p.shape[1])
                out[fit] = ((p**2).sum(1) - 2 * x @ p.T).argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), column, pa.array(out)], ["id", "v", "pivot"])

    placed = materialise(vectors.select("id", "v").mapInArrow(
        nearest, "id bigint, v array<double>, pivot bigint"), "placed")
    placed = placed.withColumn("dims", F.size("v"))
    sizes = placed.groupBy("pivot", "dims").agg(F.ceil(F.count(F.lit(1)) / rows).alias("parts"))
    dealt = placed.join(sizes, ["pivot", "dims"]).withColumn(
        "part", F.pmod(F.xxhash64("id"), F.col("parts")))

    def build(table: pa.Table) -> pa.Table:
        dims = table.column("dims")[0].as_py()
        b = Block.build(table.column("id").to_numpy(), matrix(table.column("v"), dims))
        ids, packed, nodes = b.pack()
        first = {c: table.column(c).slice(0, 1) for c in ("pivot", "dims", "part")}
        return pa.table({
            **first, "n": pa.array([len(b.ids)], pa.int32()),
            "centre": pa.array([b.centres[0].tolist()], pa.list_(pa.float64())),
            "radius": [float(b.radius[0])], "ids": pa.array([ids], pa.binary()),
            "points": pa.array([packed], pa.binary()), "nodes": pa.array([nodes], pa.binary())})

    built = dealt.groupBy("pivot", "dims", "part").applyInArrow(
        build, "pivot bigint, dims int, part bigint, n int, centre array<double>, radius double, "
        "ids binary, points binary, nodes binary")
    return materialise(built.withColumn("block", F.concat_ws("-", "dims", "pivot", "part")), "blocks")


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda s, t: s * t), F.lit(0.0), lambda s, t: s + t)


def _bound(qc: str, qr: str, xc: str, xr: str) -> Column:
    """The highest product between a ball around qc and one around xc."""
    norm, other = F.sqrt(_dot(qc, qc)), F.sqrt(_dot(xc, xc))
    slack = (norm + F.col(qr)) * (other + F.col(xr)) * 1e-11 + 1e-6
    return _dot(qc, xc) + norm * F.col(xr) + other * F.col(qr) + F.col(qr) * F.col(xr) + slack


def _balls(found: DataFrame) -> DataFrame:
    """dims, pivot, centre, radius: for each pivot a ball that holds all its blocks."""
    middle = found.groupBy("dims", "pivot").agg(F.min_by("centre", "block").alias("middle"))
    apart = F.sqrt(F.aggregate(F.zip_with("centre", "middle", lambda s, t: (s - t) * (s - t)),
                               F.lit(0.0), lambda s, t: s + t))
    return found.join(middle, ["dims", "pivot"]).groupBy("dims", "pivot").agg(
        F.any_value("middle").alias("centre"),
        (F.max(apart + F.col("radius")) * (1 + 1e-12)).alias("radius"))


def _searched(pairs: DataFrame, asked: DataFrame, data: DataFrame, floors: DataFrame | None,
              k: int) -> DataFrame:
    """qb, query_id, vec_id, score: the answers of pairs of blocks (qb, xb), k a query and pair.

    floors has qb and, per query, a score it has k answers of. A task has a data block and some of
    the query blocks that are to be searched in it.
    """
    sizes = pairs.groupBy("xb").agg(F.ceil(F.count(F.lit(1)) / AT_ONCE).alias("parts"))
    dealt = pairs.select("qb", "xb").join(sizes, "xb").withColumn(
        "part", F.pmod(F.xxhash64("qb"), F.col("parts")))
    body = ["dims", "ids", "points", "nodes"]
    right = dealt.join(asked.select(F.col("block").alias("qb"), *body), "qb")
    right = right.join(floors.select("qb", "floors"), "qb", "left") if floors is not None else (
        right.withColumn("floors", F.lit(None).cast("map<bigint,bigint>")))
    places = dealt.select(F.col("xb").alias("place"), F.col("part").alias("place_part")).distinct()
    left = places.join(data.select(F.col("block").alias("place"), *body), "place")

    def run(one: pa.Table, several: pa.Table) -> pa.Table:
        def block(table: pa.Table, i: int) -> Block:
            dims, *packed = (table.column(c)[i].as_py() for c in body)
            return Block.unpack(*packed, dims)

        x, out = block(one, 0), [(np.empty(0, np.int64),) * 3]
        named: list[str] = []
        for i in range(len(several)):
            q = block(several, i)
            known = dict(several.column("floors")[i].as_py() or [])
            out.append(DualSearch(q, x, k, np.array([known.get(z, NONE) for z in q.ids.tolist()])
                                  ).found())
            named += [several.column("qb")[i].as_py()] * len(out[-1][0])
        return pa.table([pa.array(named, pa.string()), *[pa.array(np.concatenate(c)) for c in zip(
            *out, strict=True)]], ["qb", "query_id", "vec_id", "score"])

    return materialise(left.groupBy("place", "place_part").cogroup(
        right.groupBy("xb", "part")).applyInArrow(
        run, "qb string, query_id bigint, vec_id bigint, score bigint"), "answers")


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id",
    vector: str = "embedding", scale: int = 1024, pivots: int = 32, block_rows: int = 4096,
    query_rows: int = 512, pivot_sample: int = 2000,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each query, exactly.

    A query is compared with all vectors of its length but those of its own id. Ties go to smaller
    ids, rows of one id count once (that of the best score), and a query with fewer candidates has
    fewer answers. Rows without an id, or with a vector that is NULL, empty, or holds a NULL or
    non-finite component (before or after scaling) take no part; a score that is no long fails. An
    empty side gives no rows. Pivots are drawn from a sample of about pivot_sample vectors; they
    decide where vectors are searched, never whether.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), finite_whole(
            f"`{vector}`", scale).alias("v")).where("id IS NOT NULL AND v IS NOT NULL").distinct()

    found = materialise(clean(vectors), "vectors")
    drawn = bounded_sample(found, F.struct("id", "v"), pivot_sample).select("v").toArrow()
    rows = drawn.column("v").to_pylist()
    width = max(set(map(len, rows)), key=list(map(len, rows)).count) if rows else 1
    points = np.unique(np.array([r for r in rows if len(r) == width]).reshape(-1, width), axis=0)
    spread = points[np.linspace(0, len(points) - 1, min(pivots, len(points))).astype(int)] if len(
        points) else points
    data = blocks(found, spread, block_rows)
    asked = blocks(clean(queries), spread, query_rows)

    # A data block of its own pivot gives each query block its floors.
    own = data.groupBy("dims", "pivot").agg(F.min("block").alias("xb"))
    first_pairs = materialise(asked.join(own, ["dims", "pivot"]).select(
        F.col("block").alias("qb"), "xb"), "first_pairs")
    first = _searched(first_pairs, asked, data, None, k)
    in_block = Window.partitionBy("qb", "query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(in_block)).where(F.col("rank") == k)
    floors = materialise(kth.groupBy("qb").agg(F.map_from_entries(F.collect_list(
        F.struct("query_id", "score"))).alias("floors"), F.min("score").alias("least"),
        F.count(F.lit(1)).alias("full")), "floors")

    # Pairs of pivots, of query blocks and pivots, and of blocks; each level from the one above.
    least = F.when(F.col("full") >= F.col("n_ids"), F.col("least").cast("double"))
    q = materialise(asked.select("dims", "pivot", "block", "centre", "radius", "ids").join(
        floors.drop("floors").withColumnRenamed("qb", "block"), "block", "left").withColumn(
        "n_ids", F.length("ids") / 8).withColumn(
        "worst", F.coalesce(least, F.lit(float("-inf")))).drop("ids"), "query_balls")
    x_pivots = _balls(data).select(
        "dims", F.col("pivot").alias("xp"), F.col("centre").alias("xc"), F.col("radius").alias("xr"))
    q_pivots = _balls(q).join(q.groupBy("dims", "pivot").agg(F.min("worst").alias("worst")), [
        "dims", "pivot"])
    reach = _bound("centre", "radius", "xc", "xr") >= F.col("worst")
    pivot_pairs = q_pivots.join(x_pivots, "dims").where(reach).select(
        "dims", "pivot", "xp", "xc", "xr")
    near = q.join(pivot_pairs, ["dims", "pivot"]).where(reach).select(
        "dims", "xp", F.col("block").alias("qb"), "centre", "radius", "worst")
    pairs = near.join(data.select(
        "dims", F.col("pivot").alias("xp"), F.col("block").alias("xb"), F.col("centre").alias("xc"),
        F.col("radius").alias("xr")), ["dims", "xp"]).where(reach).select("qb", "xb")
    rest = materialise(pairs.join(first_pairs, ["qb", "xb"], "left_anti"), "block_pairs")
    second = _searched(rest, asked, data, floors, k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return first.unionByName(second).groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score")).withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
