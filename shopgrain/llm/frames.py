"""Small helpers the operators share: Arrow passes that keep a frame's columns, and readers."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_CHARS = 4 << 20  # text handled at once inside a task


def limit_batches(spark: SparkSession, rows: int = 512) -> SparkSession:
    """Bound what crosses to Python at once, so that long texts cannot fill a worker.

    Python workers also get the folder this package was imported from; a cluster has the package
    installed or sent with --py-files.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    root, paths = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [paths.get("PYTHONPATH"), root]))
    return spark


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    found = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return found.select(*columns) if columns else found


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most SLICE_CHARS bytes of text (one row at least)."""
    sizes = [len(x) if x else 0 for x in batch.column(column).to_pylist()]
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > SLICE_CHARS:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def add_columns(
    df: DataFrame, fields: list[T.StructField], text: str,
    fill: Callable[[pa.RecordBatch], list[pa.Array]],
) -> DataFrame:
    """df with the columns that fill computes from each piece of rows.

    An input column that has the name of an added one is replaced.
    """
    limit_batches(df.sparkSession)
    names = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in names]

    def run(batches):
        for batch in batches:
            for piece in slices(batch, text):
                held = [piece.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays(
                    [*held, *fill(piece)], [f.name for f in [*kept, *fields]])

    return df.mapInArrow(run, T.StructType([*kept, *fields]))


def fresh(df: DataFrame, name: str) -> str:
    """The name, with as many underscores as make it none of df's columns."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once: higher-order functions would repeat it."""
    return F.transform(F.array(value), use)[0]


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; NULL ids count as the empty text."""
    as_text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % folds


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About `rows` rows of df, those whose key hashes low; all, if there are no more.

    The share follows from a count, so the expected size does not grow with df and no task gathers
    candidates. The same rows are drawn every time; rows of one key are drawn together.
    """
    n = df.count()
    if n <= rows:
        return df
    share = int(rows / n * (1 << 40))
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < F.lit(share))
