"""Near-duplicate documents by ProbMinHash signatures, banding and exact verification.

A text is its five-word shingles, weighted by how often they occur. Each shingle starts a Poisson
process whose rate is its weight; every arrival falls on a random register, and a register keeps
the shingle of its earliest arrival. A shingle whose next arrival lies beyond the latest register
of its text is done, which ends most after one arrival. Two registers agree with the probability
Jaccard similarity of the texts.

Copies share a text and are one node throughout. Texts that agree on all registers of a band meet
in a bucket. A bucket is first settled by a star: all members are verified against the one that
meets most texts over its buckets, which in a family of edited copies is the least edited. A large
family so costs a star, not all its pairs. Buckets that still hold several components are grouped
by their hub's component, members of a group are packed into blocks of bounded size, and every two
blocks are compared in one task, exactly, by products of their shingle matrices; only links between
different components leave it. So no pair of a bucket stays undecided. Before a star's texts are
fetched, registers may agree by `slack`, four standard deviations, less than the similarity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.llm.frames import add_columns, fresh, limit_batches
from shopgrain.llm.graph import components
from shopgrain.llm.shingles import GOLDEN, SPACE, counted, mix, shingles, uniform
from shopgrain.session import materialise


@dataclass(frozen=True)
class Settings:
    similarity: float = 0.8
    bands: int = 25
    band_rows: int = 5
    slack: float = 0.15
    block: int = 256  # texts of a bucket that are compared with as many others at once,
    block_shingles: int = 100_000  # and their shingles

    @property
    def registers(self) -> int:
        return self.bands * self.band_rows


def signatures(
    hashes: np.ndarray, weights: np.ndarray, text: np.ndarray, n_texts: int, registers: int,
) -> np.ndarray:
    """The shingle in each register of each text; texts without shingles keep zeros."""
    earliest = np.full(n_texts * registers, np.inf)
    owner = np.zeros(n_texts * registers, np.uint64)
    at, live = np.zeros(len(hashes)), np.arange(len(hashes))
    step = 0
    while len(live):
        step += 1
        h = mix(hashes[live] + GOLDEN * np.array([step], np.uint64))
        at[live] -= np.log(uniform(h)) / weights[live]
        place = text[live] * registers + (mix(h) % np.uint64(registers)).astype(np.int64)
        when = at[live]
        better = when < earliest[place]
        live_b, place_b, when_b = live[better], place[better], when[better]
        np.minimum.at(earliest, place_b, when_b)
        won = earliest[place_b] == when_b
        owner[place_b[won]] = hashes[live_b[won]]
        latest = earliest.reshape(n_texts, registers).max(1)
        live = live[at[live] < latest[text[live]]]
    return owner.reshape(n_texts, registers)


def band_hashes(owner: np.ndarray, settings: Settings) -> np.ndarray:
    parts = owner.reshape(len(owner), settings.bands, settings.band_rows)
    out = np.broadcast_to(np.arange(1, settings.bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(settings.band_rows):
        out = mix(out * GOLDEN + parts[:, :, k])
    return out


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two texts, each as ascending distinct shingles and their weights."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    only_a = a[1].sum() - a[1][i].sum()
    only_b = b[1].sum() - b[1][j].sum()
    kinds, times = np.unique(np.stack([a[1][i], b[1][j]]), axis=1, return_counts=True)
    x, y = kinds.astype(np.float64)
    worse = np.maximum(x[None, :] / x[:, None], y[None, :] / y[:, None])
    total = worse @ times + only_a / x + only_b / y
    return float((times / total).sum())


def sign(texts: DataFrame, text: str, settings: Settings) -> DataFrame:
    """texts with n_shingles, bands (one hash each) and registers (32 bits of each)."""
    def fill(batch: pa.RecordBatch) -> list[pa.Array]:
        hashes, bounds = shingles(batch.column(text).to_pylist())
        owner = signatures(*counted(hashes, bounds), batch.num_rows, settings.registers)
        bands = band_hashes(owner, settings).view(np.int64)
        low = (owner & np.uint64(0x7FFFFFFF)).astype(np.int32)
        def lists(x):
            return pa.ListArray.from_arrays(
                np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.reshape(-1)))

        return [pa.array(np.diff(bounds)), lists(bands), lists(low)]

    fields = [T.StructField("n_shingles", T.LongType()),
              T.StructField("bands", T.ArrayType(T.LongType())),
              T.StructField("registers", T.ArrayType(T.IntegerType()))]
    return add_columns(texts, fields, text, fill)


def similarities(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """pairs with similarity, from the two texts of each row."""
    def of(text: str) -> tuple[np.ndarray, np.ndarray]:
        h, w, _ = counted(*shingles([text]))
        return h, w

    def fill(batch: pa.RecordBatch) -> list[pa.Array]:
        known: dict[str, tuple] = {}
        out = []
        for a, b in zip(*(batch.column(c).to_pylist() for c in (left, right)), strict=True):
            if b not in known:
                known = {b: of(b)}  # rows of one hub follow each other
            out.append(probability_jaccard(of(a), known[b]))
        return [pa.array(out, pa.float64())]

    return add_columns(pairs, [T.StructField("similarity", T.DoubleType())], left, fill)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def near_duplicate_links(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """a, b, similarity over distinct texts by key: links enough to connect all similar texts.

    Within a component not every similar pair is listed, but every two texts of a bucket that are
    similar enough are connected.
    """
    bodies = docs.where(F.col(text).isNotNull()).select(
        text_key(F.col(text)).alias("key"), F.col(text).alias("body"))
    signed = sign(bodies, "body", settings).where("n_shingles > 0").drop("body")
    signed = materialise(signed.dropDuplicates(["key"]), "signed")
    members = signed.select("key", "n_shingles", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialise(members.join(sizes, "bucket"), "shared")

    # The star of each bucket, around the member that meets most texts.
    central = shared.groupBy("key").agg(F.sum("n").alias("meets"))
    hubs = materialise(shared.select("bucket", "key").join(central, "key").groupBy("bucket").agg(
        F.max(F.struct("meets", "key")).getField("key").alias("b")), "hubs")
    stars = materialise(shared.join(hubs, "bucket").where("key <> b").select(
        F.col("key").alias("a"), "b").distinct(), "stars")
    links = verified(stars, signed, bodies, settings)

    # Buckets of several components, by the component of their hub.
    labels = components(links)

    def part_of(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.join(labels, F.col(key) == F.col("node"), "left").withColumn(
            name, F.coalesce("label", key)).drop("node", "label")

    marked = part_of(shared.select("bucket", "key", "n_shingles"), "key", "part")
    mixed = marked.groupBy("bucket").agg(F.min("part").alias("x"), F.max("part").alias("y"))
    groups = part_of(hubs.join(mixed.where("x <> y"), "bucket").select("bucket", "b"), "b", "family")
    rest = materialise(marked.join(groups.select("bucket", "family"), "bucket").select(
        "family", "key", "part", "n_shingles").distinct(), "rest")
    return links.unionByName(compare_blocks(rest, bodies, settings))


def wanted_texts(keys: DataFrame, bodies: DataFrame, name: str) -> DataFrame:
    """key, body of the texts asked for, one row each. Keys grow with the corpus: never broadcast."""
    # Copies become one within each task, before texts are shuffled.
    texts = bodies.dropDuplicates(["key"])
    return materialise(texts.join(keys.distinct().hint("merge"), "key", "left_semi"), name)


def verified(pairs: DataFrame, signed: DataFrame, bodies: DataFrame, settings: Settings) -> DataFrame:
    """The similar ones among pairs (a, b), by registers first and then by their texts."""
    same = F.aggregate(F.zip_with("ra", "rb", lambda x, y: (x == y).cast("int")), F.lit(0),
                       lambda s, x: s + x)
    least = (settings.similarity - settings.slack) * settings.registers
    near = pairs.join(
        signed.select(F.col("key").alias("a"), F.col("registers").alias("ra")), "a").join(
        signed.select(F.col("key").alias("b"), F.col("registers").alias("rb")), "b").where(
        same >= least).select("a", "b")
    near = materialise(near, "near")
    texts = wanted_texts(near.select(F.col("a").alias("key")).union(near.select("b")), bodies, "texts")
    both = near.join(texts.select(F.col("key").alias("a"), F.col("body").alias("ta")), "a").join(
        texts.select(F.col("key").alias("b"), F.col("body").alias("tb")), "b")
    return materialise(similarities(both, "ta", "tb").where(
        F.col("similarity") >= settings.similarity).select("a", "b", "similarity"), "links")


def compare_blocks(rest: DataFrame, bodies: DataFrame, settings: Settings) -> DataFrame:
    """Links between different parts of each family of rest (family, key, part, n_shingles)."""
    def fill(batch: pa.RecordBatch) -> list[pa.Array]:
        h, n, text = counted(*shingles(batch.column("body").to_pylist()))
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
        spans = list(zip(cut, cut[1:], strict=False))
        return [pa.array([h[a:b].astype("<u8").tobytes() for a, b in spans], pa.binary()),
                pa.array([b"" if (n[a:b] == 1).all() else n[a:b].astype("<u4").tobytes()
                          for a, b in spans], pa.binary())]

    texts = wanted_texts(rest.select("key"), bodies, "texts")
    hashed = add_columns(texts, [T.StructField("shingles", T.BinaryType()),
                                 T.StructField("weights", T.BinaryType())], "body", fill).drop("body")
    sizes = rest.groupBy("family").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / settings.block, F.sum("n_shingles") / settings.block_shingles)
    ).cast("int").alias("blocks"))
    packed = rest.drop("n_shingles").join(sizes, "family").join(hashed, "key").groupBy(
        "family", "blocks", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block")
    ).agg(F.collect_list(F.struct("key", "part", "shingles", "weights")).alias("members"))
    packed = materialise(packed, "packed")
    left = packed.select("family", "block", F.explode(F.sequence(
        "block", F.col("blocks") - 1)).alias("other"), F.col("members").alias("left"))
    right = packed.select("family", F.explode(F.sequence(F.lit(0), "block")).alias("low"),
                          F.col("block").alias("high"), F.col("members").alias("right"))
    pairs = left.join(right, (left["family"] == right["family"]) & (F.col("block") == F.col("low"))
                      & (F.col("other") == F.col("high"))).select("left", "right")
    limit_batches(rest.sparkSession, 4)

    def members(column) -> tuple:
        rows = column.flatten()
        keys, parts, hashes, weights = (
            rows.field(c).to_pylist() for c in ("key", "part", "shingles", "weights"))
        sets = []
        for h, w in zip(hashes, weights, strict=True):
            x = np.frombuffer(h, "<u8")
            sets.append((x, np.frombuffer(w, "<u4").astype(np.int64) if w else np.ones(len(x), int)))
        return keys, parts, sets

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                out = list(block_links(*(members(batch.column(c).slice(i, 1))
                                         for c in ("left", "right")), settings.similarity))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in out], kind) for k, kind in enumerate(
                        (pa.binary(), pa.binary(), pa.float64()))], ["a", "b", "similarity"])

    return materialise(pairs.mapInArrow(run, "a binary, b binary, similarity double"), "links")


def block_links(left: tuple, right: tuple, similarity: float, columns: int = 8192):
    """Links between different parts of two blocks of members (keys, parts, sets).

    The mass that a text has on shingles of the other bounds their similarity from above; for texts
    without repeated shingles common counts give it exactly. A part that has met another is one
    with it from then on.
    """
    keys, parts, sets = ([*a, *b] for a, b in zip(left, right, strict=True))
    n, cut = len(keys), len(left[0])
    text = np.repeat(np.arange(n), [len(h) for h, _ in sets])
    _, column, times = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True,
                                 return_counts=True)
    share = np.concatenate([w / w.sum() for _, w in sets]).astype(np.float32)
    several = times[column] > 1  # a shingle of one text is common to none
    _, column = np.unique(column[several], return_inverse=True)
    text, share = text[several], share[several]
    common, mass_a, mass_b = (np.zeros((cut, n - cut), np.float32) for _ in range(3))
    order = np.argsort(column, kind="stable")
    for start in range(0, int(column.max(initial=-1)) + 1, columns):
        a, b = np.searchsorted(column[order], (start, start + columns))
        at = order[a:b]
        held, weighed = (np.zeros((n, columns), np.float32) for _ in range(2))
        held[text[at], column[at] - start] = 1
        weighed[text[at], column[at] - start] = share[at]
        common += held[:cut] @ held[cut:].T
        mass_a += weighed[:cut] @ held[cut:].T
        mass_b += held[:cut] @ weighed[cut:].T
    sizes = np.array([len(h) for h, _ in sets], np.float32)
    plain = np.array([bool((w == 1).all()) for _, w in sets])
    exact = common / np.maximum(sizes[:cut, None] + sizes[None, cut:] - common, 1)
    both = plain[:cut, None] & plain[None, cut:]
    bound = np.where(both, exact, np.minimum(mass_a, mass_b)) + 1e-4
    number = {p: k for k, p in enumerate(dict.fromkeys(parts))}
    label = np.array([number[p] for p in parts])
    i, j = np.nonzero((bound >= similarity) & (label[:cut, None] != label[None, cut:]))
    met: dict[bytes, bytes] = {}

    def root(part: bytes) -> bytes:
        while part in met:
            part = met[part]
        return part

    for x, y in zip(i.tolist(), (j + cut).tolist(), strict=True):
        one, two = root(parts[x]), root(parts[y])
        if one != two:
            value = probability_jaccard(sets[x], sets[y])
            if value >= similarity:
                met[one] = two
                yield keys[x], keys[y], value


def classes(docs: DataFrame, doc_id: str, text: str, settings: Settings) -> DataFrame:
    """class_key, class_label, class_id, n_in_class, is_kept: a row per distinct text with words.

    The class of a text is named by the smallest known document id in it. is_kept holds for one
    text of the class, the first by hash that has that id.
    """
    keyed = with_key(docs.select(doc_id, text), text).where("class_key IS NOT NULL")
    owners = materialise(keyed.groupBy("class_key").agg(
        F.min(doc_id).alias("owner"), F.count(F.lit(1)).alias("copies")), "owners")
    labels = components(near_duplicate_links(docs, text, settings))
    labelled = owners.join(labels, F.col("class_key") == F.col("node"), "left").select(
        "class_key", "owner", "copies", F.coalesce("label", "class_key").alias("class_label"))
    least = F.min(F.struct(F.col("owner").isNull().alias("unknown"), "owner", "class_key"))
    whole = labelled.groupBy("class_label").agg(
        F.sum("copies").alias("n_in_class"), least.alias("first"))
    return labelled.join(whole, "class_label").select(
        "class_key", "class_label", F.col("first.owner").alias("class_id"), "n_in_class",
        (F.col("first.class_key") == F.col("class_key")).alias("is_kept"))


def with_key(docs: DataFrame, text: str, key: str = "class_key") -> DataFrame:
    """docs with the hash of the text as `key`; NULL for texts without words."""
    has_words = F.coalesce(F.col(text), F.lit("")).rlike(f"[^{SPACE[1:]}")
    return docs.withColumn(key, F.when(has_words, text_key(F.col(text))))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings(),
) -> DataFrame:
    """docs with class_id and n_in_class: one row per document.

    Documents with the same text, or connected by texts of enough similarity, form a class, named
    by its smallest document id that is not NULL. Documents without words (NULL, empty, white
    space) are each a class of their own. Repeated rows count as documents. Columns of the two
    names are replaced.
    """
    docs = docs.drop("class_id", "n_in_class")
    key = fresh(docs, "class_key")
    found = materialise(classes(docs, doc_id, text, settings), "classes")
    marked = with_key(docs, text, key).join(
        found.select(F.col("class_key").alias(key), "class_id", "n_in_class"), key, "left")
    return marked.withColumns({
        "class_id": F.when(F.col(key).isNull(), F.col(doc_id)).otherwise(F.col("class_id")),
        "n_in_class": F.coalesce("n_in_class", F.lit(1).cast("bigint"))}).drop(key)


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings(),
) -> DataFrame:
    """One document of each class: the one of the smallest id; of repeated rows one stays.

    Documents without words are kept as they are. Texts move once, to meet the kept ids.
    """
    columns = docs.columns
    found = classes(docs, doc_id, text, settings).where("is_kept")
    found = materialise(found.select("class_key", F.col("class_id").alias("keep_id")), "kept")
    key = fresh(docs, "class_key")
    keyed = with_key(docs, text, key)
    kept = keyed.join(found, (keyed[key] == found["class_key"])
                      & keyed[doc_id].eqNullSafe(found["keep_id"]), "left_semi")
    both = kept.dropDuplicates([key, doc_id]).unionByName(keyed.where(F.col(key).isNull()))
    return both.drop(key).select(*[f"`{c}`" for c in columns])
