"""Byte-pair encoding and decoding with a contiguous rank array per short word.

A word is held as a row of part ids beside a row of the ranks of adjacent pairs. The smallest rank
is found by scanning the row, its boundary is deleted by moving what follows one place to the
left, and the two neighbouring ranks are looked up anew. All short words of a piece of text that
are not known yet take these steps together, as matrices. Words beyond SHORT bytes use a heap over
linked parts instead, where rescanning would cost the square of the length.

The tables come from the vocabulary file, whose size is fixed, and are broadcast.
"""

from __future__ import annotations

import bisect
import heapq
import json
import re
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shopgrain.llm.frames import add_columns

SHORT = 32
BLOCK = 4096
KNOWN_WORDS = 800_000  # words a worker remembers; beyond it forgets all and starts anew
NO_RANK = np.iinfo(np.int32).max

# Fixed value: the split of byte-level BPE, with white space by its Unicode property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

# The same for texts within Latin-1, whose short classes the standard module scans faster.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
LATIN_PATTERN = (
    rf" ?[{_LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}


@dataclass
class Tables:
    """A vocabulary as arrays: pairs sorted by key, and the bytes of each id."""

    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    byte_ids: np.ndarray
    pieces: list[bytes]
    special: dict[str, int] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> Tables:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pieces = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in vocab.items():
            if token not in special:
                pieces[i] = bytes(letters[c] for c in token)
        for token, i in special.items():
            pieces[i] = token.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys)
        byte_ids = np.zeros(256, np.int32)
        for letter, b in letters.items():
            byte_ids[b] = vocab[letter]
        return cls(keys[order], order.astype(np.int32), merged[order], byte_ids, pieces, special)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; NO_RANK where the pair is not in the vocabulary."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], NO_RANK), self.merged[at]


def merge_short(words: list[bytes], tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in a row, and how many each has, by matrices of parts and ranks."""
    width = max(map(len, words))
    joined = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8)
    parts = tables.byte_ids[joined].reshape(len(words), width)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    # A spare column on the right, so that a neighbour can always be read.
    parts = np.pad(parts, ((0, 0), (0, 1)), constant_values=-1)
    parts[np.arange(width + 1) >= lengths[:, None]] = -1
    ranks, merged = tables.look_up(parts[:, :-1], parts[:, 1:])
    out, rows, column = parts.copy(), np.arange(len(words)), np.arange(width, dtype=np.int32)
    while True:
        at = ranks.argmin(1)
        here = np.arange(len(rows))
        live = ranks[here, at] != NO_RANK
        left = np.count_nonzero(live)
        if left <= 0.7 * len(rows):  # set finished words aside
            out[rows[~live], :parts.shape[1]] = parts[~live]
            out[rows[~live], parts.shape[1]:] = -1
            used = int((parts[live] >= 0).sum(1).max(initial=0))
            rows, at = rows[live], at[live]
            parts, ranks, merged = parts[live, :used + 1], ranks[live, :used], merged[live, :used]
            here, live = np.arange(left), np.ones(left, bool)
        if not left:
            break
        here, at = here[live], at[live]
        new = merged[here, at]
        # Delete the boundary: all behind it moves one place to the left.
        n = parts.shape[1] - 1
        stop = np.full(len(rows), n + 1, np.int32)
        stop[here] = at
        behind = column[:n] > stop[:, None]
        np.copyto(parts[:, :-1], parts[:, 1:], where=behind)
        np.copyto(ranks[:, :-1], ranks[:, 1:], where=behind[:, :-1])
        np.copyto(merged[:, :-1], merged[:, 1:], where=behind[:, :-1])
        ranks[here, -1] = NO_RANK
        parts[here, -1] = -1
        parts[here, at] = new
        # Refresh the ranks on both sides of the new part.
        before = at > 0
        r = np.concatenate([here, here[before]])
        c = np.concatenate([at, at[before] - 1])
        ranks[r, c], merged[r, c] = tables.look_up(parts[r, c], parts[r, c + 1])
    return out[out >= 0], (out >= 0).sum(1)


def merge_long(word: bytes, tables: Tables) -> np.ndarray:
    """The ids of one long word: smallest rank first, the left one of equals, from a heap."""
    parts = tables.byte_ids[np.frombuffer(word, np.uint8)]
    ranks, merged = tables.look_up(parts[:-1], parts[1:])
    ids, n = parts.tolist(), len(parts)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(int(ranks[i]), int(i), ids[i], ids[i + 1], int(merged[i]))
            for i in np.flatnonzero(ranks != NO_RANK)]
    heapq.heapify(heap)

    def push(i: int) -> None:
        j = after[i]
        if j < n:
            rank, new = tables.look_up(np.array([ids[i]]), np.array([ids[j]]))
            if rank[0] != NO_RANK:
                heapq.heappush(heap, (int(rank[0]), i, ids[i], ids[j], int(new[0])))

    while heap:
        _, i, left, right, new = heapq.heappop(heap)
        j = after[i] if ids[i] == left else n
        if j >= n or ids[j] != right:
            continue
        ids[i], ids[j], after[i] = new, -1, after[j]
        if after[j] < n:
            before[after[j]] = i
        if before[i] >= 0:
            push(before[i])
        push(i)
    return np.array([x for x in ids if x >= 0], np.int32)


class Ids:
    """The ids of many words in a row, found by the place of a word among them."""

    def __init__(self):
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = self.n = 0
        self.starts = np.empty(1 << 14, np.int64)
        self.sizes = np.empty(1 << 14, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        n, first, end = len(ids), self.n, self.n + len(sizes)
        while self.used + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while end > len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.empty_like(self.sizes)])
        self.flat[self.used:self.used + n] = ids
        self.starts[first:end] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:end] = sizes
        self.used += n
        self.n = end

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at these places in a row, and the bounds of each word's."""
        sizes = self.sizes[places]
        total = np.concatenate([[0], np.cumsum(sizes)])
        move = np.repeat(self.starts[places] - total[:-1], sizes)
        return self.flat[move + np.arange(total[-1])], total


class Encoder:
    """Encodes texts, and remembers the words it has met."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.split = regex.compile(PATTERN).findall
        self.split_latin = re.compile(LATIN_PATTERN).findall
        names = sorted(tables.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.forget()

    def findall(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.split(text)
        return self.split_latin(text)

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = Ids()

    def _store(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words)), strict=True))
        self.held.add(ids, sizes)

    def _learn(self, words: list[str]) -> None:
        pairs = sorted([(len(b), w, b) for w in words for b in (w.encode(),)])
        cut = bisect.bisect_right(pairs, SHORT, key=lambda x: x[0])
        for i in range(0, cut, BLOCK):
            some = pairs[i:min(i + BLOCK, cut)]
            self._store([w for _, w, _ in some], *merge_short([b for _, _, b in some], self.tables))
        for _, word, as_bytes in pairs[cut:]:
            ids = merge_long(as_bytes, self.tables)
            self._store([word], ids, np.array([len(ids)]))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; a missing text has none."""
        ids, cut = self.encode_flat(texts)
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the bounds of each text's."""
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        words: list[str] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        special = self.tables.special
        for k, text in enumerate(texts):
            for piece in self.marks.split(text) if self.marks and text else [text or ""]:
                if piece in special:
                    if piece not in self.known:
                        self._store([piece], np.array([special[piece]]), np.array([1]))
                    words.append(piece)
                else:
                    words += self.findall(piece)
            ends[k + 1] = len(words)
        if not words:
            return np.empty(0, np.uint32), ends
        ids, total = self.held.gather(self.places(words))
        return ids, total[ends]

    def places(self, words: list[str]) -> np.ndarray:
        """Where each word's ids are held; words that are not known are learned."""
        found = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            new = [words[i] for i in missing]
            self._learn(list(set(new)))
            found[missing] = [self.known[w] for w in new]
        return found


_encoders: dict[str, Encoder] = {}


def worker_encoder(path: str, tables: Broadcast) -> Encoder:
    """The encoder of this worker; what it remembers serves the tasks that follow."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(tables.value)
    return _encoders[path]


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """df with n_tokens and ids, the token ids of `text` as little-endian unsigned 32-bit integers.

    The strings of special tokens become those tokens. NULL and empty texts have no tokens and an
    empty `ids`. Rows are independent, so repeated rows, ties and other columns change nothing;
    columns named n_tokens or ids are replaced. The work is one pass without a shuffle.
    """
    tables = df.sparkSession.sparkContext.broadcast(Tables.read(path))

    def fill(batch: pa.RecordBatch) -> list[pa.Array]:
        found = worker_encoder(path, tables).encode(batch.column(text).to_pylist())
        return [pa.array([len(x) for x in found], pa.int64()),
                pa.array([x.astype("<u4").tobytes() for x in found], pa.binary())]

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    return add_columns(df, fields, text, fill)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """df with decoded, the text of `ids`; special tokens give their strings.

    Bytes that are not UTF-8 become the replacement character. NULL ids give NULL, no ids the empty
    text, and an id outside the vocabulary fails. A column named decoded is replaced.
    """
    tables = df.sparkSession.sparkContext.broadcast(Tables.read(path))

    def fill(batch: pa.RecordBatch) -> list[pa.Array]:
        pieces = tables.value.pieces
        return [pa.array([
            None if x is None else b"".join(
                map(pieces.__getitem__, np.frombuffer(x, "<u4").tolist())
            ).decode("utf-8", "replace") for x in batch.column(ids).to_pylist()
        ], pa.string())]

    return add_columns(df, [T.StructField("decoded", T.StringType())], ids, fill)
