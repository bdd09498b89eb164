"""Alignment of the tokens that two tokenizers cut from one text, by diagonal run skipping.

A text's tokens are given by their end offsets in bytes, so a group of tokens ends where both have
an end. Most groups are one token on either side: at the current index shift the two end arrays are
compared over windows of 1, 2, 4, ... tokens, and the equal stretch is jumped. At the first unequal
place the irregular group is resolved by stepping the side that is behind until the ends meet, which
gives the new shift. Texts of a batch lie one after the other, and the whole is cut at common ends
into many lanes that take these steps together as arrays.

Token A of a text and token B are linked where their bytes overlap. How often each pair of ids is
linked in all texts is counted from sums per task; texts get the counts of their pairs by blocks of
bounded size, each of which asks for its distinct pairs once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import replace
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.llm.bpe import KNOWN_WORDS, Encoder, Ids, Tables
from shopgrain.llm.frames import limit_batches, slices
from shopgrain.session import materialise

SPACE = "▁"  # stands for a space in pieces
LANE = 256  # tokens of A that a lane has, about
TRIES = 8  # places where a lane may begin
BLOCK_LINKS = 1 << 23  # links of a block of texts, or one text
SUMS = 1 << 20  # distinct pairs that a task sums before it hands them on


class Pieces(Encoder):
    """Encodes texts by a sentence-piece model; the words of a text are encoded once.

    No piece has a space after another character, so a text falls into words that are merged apart,
    each with the spaces before it. Where a model has such pieces, or rewrites white space, a text
    is one word.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = [bytes.fromhex(n[3:5]) if self.model.is_byte(i) else
                       n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        probe = "a  b \t　 \xa0c\n d "
        kept = "".join(self.model.encode(probe, out_type=str)).replace(SPACE, " ")
        self.whole = any(SPACE in n.lstrip(SPACE) for n in names) or not kept.startswith(" a  b ")
        self.findall = (lambda text: [text]) if self.whole else re.compile(" *[^ ]+| +").findall
        self.tables, self.marks = replace(EMPTY), None
        self.forget()

    def _learn(self, words: list[str]) -> None:
        self._store(words, *self.ids_of(words))

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that begin with a space in a row, and how many each has."""
        # A word has the leading space that the model adds; that of a lone space is the word itself.
        found = [[self.model.piece_to_id(SPACE)] if w == " " else ids for w, ids in zip(
            words, self.model.encode([w[1:] for w in words], num_threads=1), strict=True)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, sizes.sum()), sizes


_NONE = np.empty(0, np.int64)
EMPTY = Tables(_NONE, _NONE, _NONE, _NONE, [])


# A text's words for both sides: neither has a token over a space that follows other than white
# space. Where white space of other kinds comes before a space, A's split depends on what follows.
_BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_PATTERN = f" *[^ ]+(?:(?<=[{_BLANK}]) +[^ ]*)*| +"


class Pair(Encoder):
    """Both tokenizers of a worker, with the bytes of their tokens.

    A text is cut once into words that both encode apart, and remembered are the ids of both sides,
    and whether these give the bytes of the word back.
    """

    def __init__(self, tables: Tables, model: bytes):
        self.one, self.two = Encoder(replace(tables, special={})), Pieces(model)
        self.bytes = [tables.pieces, self.two.pieces]
        self.lengths = [np.array([len(p) for p in pieces], np.int64) for pieces in self.bytes]
        self.sizes = [len(p) for p in self.bytes]
        # Ids as text, followed by what follows in a group or after it.
        self.names = [np.array([f"{i}{mark}" for mark in marks for i in range(n)], object)
                      for n, marks in zip(self.sizes, (",|", ",;"), strict=True)]
        self.findall = self.two.findall if self.two.whole else re.compile(WORD_PATTERN).findall
        self.forget()

    def forget(self) -> None:
        self.known, self.held, self.exact = {}, (Ids(), Ids()), np.empty(0, bool)

    def _learn(self, words: list[str]) -> None:
        # One after the other, words are cut as they are apart, unless white space ends them.
        parts: list[list[str]] = [[], [], []]
        for w in words:
            parts[2 if w[-1].isspace() else not w.isascii()].append(w)
        words = [*chain.from_iterable(parts)]
        pieces = [*chain.from_iterable(map(self.one.findall, [*map("".join, parts[:2]), *parts[2]]))]
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        n = np.searchsorted(np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))), ends) + 1
        if len(self.one.known) > KNOWN_WORDS:
            self.one.forget()
        ids, cut = self.one.held.gather(self.one.places(pieces))
        coded = [(ids, np.diff(cut[np.append(0, n)])), self.two.ids_of(words)]
        raw = [w.encode() for w in words]
        whole, lengths = b"".join(raw), np.fromiter(map(len, raw), np.int64, len(raw))
        exact = np.ones(len(words), bool)
        for side, (ids, sizes) in enumerate(coded):
            self.held[side].add(ids, sizes)
            cut = np.append(0, np.cumsum(sizes))
            exact &= _per_text(self.lengths[side][ids], cut) == lengths
            if not exact.all() or self.joined(side, ids) != whole:
                exact &= [self.joined(side, ids[a:b]) == r
                          for a, b, r in zip(cut[:-1], cut[1:], raw, strict=True)]
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words)), strict=True))
        self.exact = np.concatenate([self.exact, exact])

    def joined(self, side: int, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes[side].__getitem__, ids.tolist()))

    def encode_both(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of A and of B of all texts in a row, and the bounds of each text's on both sides.

        A text has none where either's bytes are not the text's.
        """
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        spaced = [" " + t if t else "" for t in texts]
        found = [self.findall(t) for t in spaced]
        ends = np.concatenate([[0], np.cumsum(list(map(len, found)))]).astype(np.int64)
        places = self.places(list(chain.from_iterable(found)))
        odd = np.flatnonzero(_per_text(~self.exact[places], ends)).tolist()
        kept = np.ones(len(places), bool)
        for k in odd:  # words may make up for each other
            some, raw = places[ends[k]:ends[k + 1]], spaced[k].encode()
            kept[ends[k]:ends[k + 1]] = all(
                self.joined(side, held.gather(some)[0]) == raw for side, held in enumerate(self.held))
        places, ends = places[kept], np.concatenate([[0], np.cumsum(kept)])[ends]
        flat, totals = zip(*(held.gather(places) for held in self.held), strict=True)
        return [x.astype(np.int64) for x in flat], [total[ends] for total in totals]


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def lane_starts(x: np.ndarray, y: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in x and y, both 0 or behind a common end, about `lane` places of x apart."""
    i = np.arange(lane - 1, len(x) - TRIES, lane)
    j = np.searchsorted(y, x[i])
    for _ in range(TRIES):
        off = np.flatnonzero(y[np.minimum(j, len(y) - 1)] != x[i])
        if not len(off):
            break
        i[off] += 1
        j[off] = np.searchsorted(y, x[i[off]])
    met = y[np.minimum(j, len(y) - 1)] == x[i]
    return np.append(0, i[met] + 1), np.append(0, j[met] + 1)


def align_ends(x: np.ndarray, y: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of either side end a group: those whose end the other side has, too.

    x and y ascend strictly and have the same last end (or are empty).
    """
    cut_x, cut_y = np.zeros(len(x), bool), np.zeros(len(y), bool)
    if not len(x):
        return cut_x, cut_y
    i, j = lane_starts(x, y, max(lane, 2 * TRIES))
    stop_i, stop_j = np.append(i[1:], len(x)), np.append(j[1:], len(y))
    width = np.ones(len(i), np.int64)
    while len(i):
        n = np.minimum(width, np.minimum(stop_i - i, stop_j - j))
        start = np.cumsum(n) - n
        step = np.arange(start[-1] + n[-1]) - np.repeat(start, n)
        at_x, at_y = np.repeat(i, n) + step, np.repeat(j, n) + step
        differ = x[at_x] != y[at_y]
        run = np.minimum.reduceat(np.where(differ, step, len(x)), start)
        run = np.minimum(run, n)
        inside = step < np.repeat(run, n)
        cut_x[at_x[inside]] = True
        cut_y[at_y[inside]] = True
        i, j = i + run, j + run
        width = np.where(run == n, 2 * width, 1)
        odd = np.flatnonzero(run < n)
        p, q, open_ = i[odd], j[odd], np.arange(len(odd))
        while len(open_):
            a, b = x[p[open_]], y[q[open_]]
            p[open_] += a < b
            q[open_] += b < a
            open_ = open_[a != b]
        cut_x[p] = True
        cut_y[q] = True
        i[odd], j[odd] = p + 1, q + 1
        left = i < stop_i
        i, j, stop_i, stop_j, width = (v[left] for v in (i, j, stop_i, stop_j, width))
    return cut_x, cut_y


def links(x: np.ndarray, y: np.ndarray, cut_x: np.ndarray, cut_y: np.ndarray) -> tuple:
    """The places in x and y of all pairs of tokens whose bytes overlap, in the order of the text.

    Between two neighbouring ends of either side lies one token of each, so every end is a link.
    """
    order = np.argsort(np.concatenate([x, y[~cut_y]]), kind="stable")
    of_x = order < len(x)
    of_y = ~of_x
    of_y[of_x] = cut_x
    return np.cumsum(of_x) - of_x, np.cumsum(of_y) - of_y


def group_texts(pair: Pair, flat: list[np.ndarray], cuts: list[np.ndarray],
                bounds: list[np.ndarray]) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` for each text: the ids of A and of B by group."""
    n_a, n_b = (np.flatnonzero(c) + 1 for c in cuts)
    group_a, group_b = (np.cumsum(c) - c for c in cuts)
    out = np.empty(len(flat[0]) + len(flat[1]), object)
    before = np.append(0, n_b)[group_a]
    out[np.arange(len(flat[0])) + before] = pair.names[0][flat[0] + cuts[0] * pair.sizes[0]]
    out[np.arange(len(flat[1])) + n_a[group_b]] = pair.names[1][flat[1] + cuts[1] * pair.sizes[1]]
    ends = bounds[0] + bounds[1]
    return ["".join(out[a:b].tolist())[:-1] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes each; _unpack needs their count."""
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if values.max(initial=0) <= np.iinfo(k).max)
    return values.astype(kind).tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}") if n else np.empty(0, "<u1")


def align_texts(pair: Pair, texts: list[str | None]) -> dict[str, list]:
    """n_a, n_b, n_groups, n_links, groups, and the linked id pairs of each text with their counts."""
    flat, bounds = pair.encode_both(texts)
    ends = [np.cumsum(n[f]) for n, f in zip(pair.lengths, flat, strict=True)]
    cuts = list(align_ends(*ends))
    n_a, n_b = (np.diff(b) for b in bounds)
    n_groups = _per_text(cuts[0], bounds[0])
    at_a, at_b = links(*ends, *cuts)
    text = np.repeat(np.arange(len(texts)), n_a)[at_a]
    space = pair.sizes[0] * pair.sizes[1]
    found, n = np.unique(text * space + flat[0][at_a] * pair.sizes[1] + flat[1][at_b],
                         return_counts=True)
    cut = np.searchsorted(found, np.arange(len(texts) + 1) * space)
    codes = found % space
    spans = list(zip(cut[:-1], cut[1:], strict=True))
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_a + n_b - n_groups,
        "groups": group_texts(pair, flat, cuts, bounds), "n_pairs": np.diff(cut),
        "codes": [_pack(codes[a:b]) for a, b in spans], "counts": [_pack(n[a:b]) for a, b in spans]}


_pairs: dict[tuple[str, str], Pair] = {}


def _sums(batches: Iterator, columns: tuple[str, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows (n_pairs, codes, counts) summed in parts of bounded size."""
    held: list[tuple] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        codes, at = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
        return codes, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

    for batch in batches:
        for n, codes, counts in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            held.append((_unpack(codes, n).astype(np.int64), _unpack(counts, n).astype(np.int64)))
            size += n
            if size > 2 * SUMS:
                held = [merged()]
                size = len(held[0][0])
                if size > SUMS:
                    yield held[0]
                    held, size = [], 0
    if size:
        yield merged()


def align(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep: list[str] | None = None,
    store: Callable[[Column], Column] = lambda groups: groups, block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """docs with n_a, n_b, n_groups, n_links, n_best, count_sum and groups.

    `path_a` is a byte-level vocabulary, applied to a space and the text, `path_b` a sentence-piece
    model, which adds the space; strings of special tokens are plain text. NULL and empty texts, and
    texts whose tokens of A or B do not give the bytes of the text back (a model may write a
    character otherwise), have no tokens: zeros and empty groups. `groups` lists the ids of both
    sides by group, `a1,a2|b1;a3|b2,b3`.

    A pair's count is the number of links that hold it in all of docs, repeated rows and copies
    included; n_best counts a text's links whose pair has the highest count of its B id (ties
    included), count_sum sums the counts over its links. `keep` names the columns that travel, all
    by default; those that share a name with an added one are replaced. `store` is applied to
    groups before rows are written, where a digest will do. A text is aligned whole, whatever its
    length; an empty table gives none.
    """
    added = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]
    plain = [f"c{i}" for i in range(len(names))]
    spark = limit_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{n}`").alias(c) for n, c in zip(
        names, plain, strict=True)], F.lit(0).alias("none")).alias("row"), F.col(f"`{text}`").alias("body"))
    tables = spark.sparkContext.broadcast(Tables.read(path_a))
    with open(path_b, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())

    counts = ["n_a", "n_b", "n_groups", "n_links"]
    fields = [*[T.StructField(c, T.LongType()) for c in counts], T.StructField("groups", T.StringType()),
              T.StructField("n_pairs", T.LongType()), T.StructField("codes", T.BinaryType()),
              T.StructField("counts", T.BinaryType()), T.StructField("block", T.LongType())]
    kinds = dict.fromkeys([*counts, "n_pairs", "block"], pa.int64()) | {
        "groups": pa.string(), "codes": pa.binary(), "counts": pa.binary()}

    def run(batches):
        if (path_a, path_b) not in _pairs:
            _pairs.clear()
            _pairs[path_a, path_b] = Pair(tables.value, model.value)
        pair = _pairs[path_a, path_b]
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for piece in slices(batch, "body"):
                found = align_texts(pair, piece.column("body").to_pylist())
                total = np.cumsum(found["n_links"]) + held
                found["block"] = block + np.maximum(total - 1, 0) // block_links
                held = int(total[-1])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), *[pa.array(found[f.name], kinds[f.name]) for f in fields]],
                    ["row", *[f.name for f in fields]])

    aligned = rows.mapInArrow(run, T.StructType([rows.schema["row"], *fields]))
    aligned = materialise(aligned.withColumn("groups", store(F.col("groups"))), "aligned")
    in_row = ("n_pairs", "codes", "counts")

    def totals(batches):
        for codes, n in _sums(batches, in_row):
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["code", "total"])

    size_b = F.lit(_piece_count(path_b))
    summed = aligned.select(*in_row).mapInArrow(totals, "code bigint, total bigint").groupBy(
        "code").agg(F.sum("total").alias("total")).withColumn("b", F.col("code") % size_b)
    summed = materialise(summed, "pair_totals")
    highest = summed.groupBy("b").agg(F.max("total").alias("highest"))
    judged = summed.join(highest, "b").select(
        "code", "total", (F.col("total") == F.col("highest")).alias("best"))

    def asked(batches):
        block, held, size = None, [], 0
        for batch in batches:
            for b, n, codes in zip(*(batch.column(c).to_pylist() for c in (
                    "block", "n_pairs", "codes")), strict=True):
                if held and (b != block or size > 2 * SUMS):
                    held = [np.unique(np.concatenate(held))]
                    size = len(held[0])
                    if b != block or size > SUMS:
                        yield _wanted(block, held[0])
                        held, size = [], 0
                block = b
                held.append(_unpack(codes, n).astype(np.int64))
                size += n
        if held:
            yield _wanted(block, np.unique(np.concatenate(held)))

    wanted = aligned.select("block", "n_pairs", "codes").where("n_pairs > 0").mapInArrow(
        asked, "block bigint, code bigint")  # a block read by two tasks may ask for a pair twice
    answers = wanted.join(judged, "code")

    kept = ["row", *counts, "groups"]
    out = T.StructType([aligned.schema[c] for c in kept] + [
        T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        code, total = right.column("code").to_numpy(), right.column("total").to_numpy()
        best = right.column("best").to_numpy()
        order = np.argsort(code)
        code, total, best = code[order], total[order], best[order]
        n_best, count_sum = [], []
        for n, codes, counts_ in zip(*(left.column(c).to_pylist() for c in in_row), strict=True):
            at = np.searchsorted(code, _unpack(codes, n).astype(np.int64))
            times = _unpack(counts_, n).astype(np.int64)
            n_best.append(int(times[best[at]].sum()))
            count_sum.append(int((times * total[at]).sum()))
        made = left.select(kept)
        return made.append_column("n_best", pa.array(n_best, pa.int64())).append_column(
            "count_sum", pa.array(count_sum, pa.int64()))

    scored = aligned.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, out)
    return scored.select(*[F.col(f"row.{c}").alias(n) for n, c in zip(names, plain, strict=True)],
                         *added)


def _wanted(block: int, codes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(codes), block)), pa.array(codes)], ["block", "code"])


def _piece_count(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
