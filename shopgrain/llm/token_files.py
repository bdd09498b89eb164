"""Token counts of documents in flat token files that have no index.

A flat file is one stream of little-endian 16-bit token ids in which every document ends with an
end-of-document id. Files are read as blocks of fixed size, each by whichever task comes: a block
knows nothing of the documents before it. One vectorised search per block finds its separators and
so the lengths of its pieces of documents. How many separators lie in earlier blocks of the file, a
prefix scan over block totals (blocks within spans, then spans), numbers the pieces, and pieces of
one number add up to a document, however many blocks it crosses.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopgrain.llm.frames import limit_batches, slices
from shopgrain.session import scratch_dir

DTYPE = np.dtype("<u2")
END = 0xFFFF
VOCABULARY = 50_000
BLOCK = 1 << 20  # bytes; a multiple of the token size
SPAN = 4096      # blocks
SPACES = r"[\x20\x09-\x0D]+"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, which any executor may open."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def word_ids(text: str) -> list[int]:
    """Ids of the words between ASCII white space, by hash, below the end-of-document id."""
    return [zlib.crc32(w) % VOCABULARY for w in text.encode().split()]


def write_token_files(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """file, ordinal, doc_id: where each document stands in the flat files written to `folder`.

    Each task writes one file, under a name of its own that is only listed here once it is complete,
    so a task that is run again leaves nothing that is read. NULL and empty texts are documents
    without tokens. Words are split at ASCII white space.
    """
    limit_batches(docs.sparkSession)

    def run(batches) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        name, sink, n, known = f"{uuid.uuid4().hex}.tokens", None, 0, {}
        for batch in batches:
            for piece in slices(batch, "text"):
                sink = sink or store.open_output_stream(f"{root}/{name}")
                flat: list[int] = []
                for t in piece.column("text").to_pylist():
                    flat += word_ids(t) if t else ()
                    flat.append(END)
                sink.write(np.array(flat, DTYPE).tobytes())
                k = piece.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * k), pa.array(np.arange(n, n + k)),
                     piece.column("doc_id")], ["file", "ordinal", "doc_id"])
                n += k
        if sink:
            sink.close()

    found = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return found.mapInArrow(run, "file string, ordinal bigint, doc_id bigint")


def token_blocks(spark: SparkSession, folder: str, files: DataFrame, block: int = BLOCK) -> DataFrame:
    """file, block, start and size of all blocks of the files named in `files`; reads no content."""
    listed = spark.read.format("binaryFile").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length"))
    listed = listed.join(files.select("file").distinct(), "file", "left_semi").where("length > 0")
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(block).cast("bigint"))
    return listed.select("file", "length", F.posexplode(starts).alias("block", "start")).select(
        "file", F.col("block").cast("bigint").alias("block"), "start",
        F.least(F.lit(block).cast("bigint"), F.col("length") - F.col("start")).alias("size"))


def scan_blocks(blocks: DataFrame, folder: str, end: int = END, dtype: np.dtype = DTYPE) -> DataFrame:
    """file, block, separators and lengths: of each block, its pieces of documents in order.

    A block of k separators has k + 1 pieces; the last is open, and may be empty.
    """
    limit_batches(blocks.sparkSession, 64)

    def run(batches) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for batch in batches:
            for file, block, start, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(f"{root}/{file}") as f:
                    tokens = np.frombuffer(f.read_at(size, start), dtype)
                at = np.flatnonzero(tokens == end)
                lengths = np.diff(np.concatenate([[-1], at, [len(tokens)]])) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block]), pa.array([len(at)], pa.int64()),
                     pa.array([lengths.tolist()], pa.list_(pa.int64()))],
                    ["file", "block", "separators", "lengths"])

    spread = blocks.select("file", "block", "start", "size").repartition("file", "block")
    return spread.mapInArrow(run, "file string, block bigint, separators bigint, lengths array<bigint>")


def document_lengths(scanned: DataFrame, span: int = SPAN) -> DataFrame:
    """file, ordinal, n_tokens of every document, from the pieces of all blocks."""
    totals = scanned.select("file", "block", "separators",
                            F.floor(F.col("block") / span).alias("span"))
    within = Window.partitionBy("file", "span").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    across = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = totals.groupBy("file", "span").agg(F.sum("separators").alias("n")).select(
        "file", "span", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("before_span"))
    first = totals.withColumn(
        "before", F.coalesce(F.sum("separators").over(within), F.lit(0))).join(
        spans, ["file", "span"]).select(
        "file", "block", (F.col("before") + F.col("before_span")).alias("first"))
    pieces = scanned.join(first, ["file", "block"]).select(
        "file", "separators", "first", F.posexplode("lengths").alias("k", "n"))
    # The open piece of a block counts to the document that the next block ends or goes on with.
    return pieces.groupBy("file", (F.col("first") + F.col("k")).alias("ordinal")).agg(
        F.sum("n").alias("n_tokens"))


def count_document_tokens(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK,
) -> DataFrame:
    """doc_id, n_tokens: writes docs as flat token files and counts by scanning these.

    Every row of docs gives a row, repeated and NULL ids included. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    where = f"{folder}-places"
    write_token_files(docs, folder, doc_id, text).write.parquet(where)
    places = spark.read.schema("file string, ordinal bigint, doc_id bigint").parquet(where)
    if places.isEmpty():
        return places.select("doc_id", F.lit(0).cast("bigint").alias("n_tokens"))
    counted = document_lengths(scan_blocks(token_blocks(spark, folder, places, block), folder))
    return places.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens")
