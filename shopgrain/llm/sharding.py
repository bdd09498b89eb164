"""Sharding by proportional stratified interleaving.

The rows of each stratum (a source) are put into an order drawn by a seed. The r-th of a stratum's n
rows has the fractional rank (r + phase) / n, the phase being drawn per stratum. All rows are sorted
by fractional rank and cut into runs of equal count, so each shard, and any stretch within one, has
the mixture of the whole.

No task sees a stratum or the table whole: ranks and positions are counted in ranges of bounded
size, whose first positions are running totals of range counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.session import materialise

HASH_BITS = 60
RANGE_ROWS = 1 << 13  # rows that one range has, about
COPIES = 1 << 12  # equal rows that are spread out at once


def drawn(*parts: Column) -> Column:
    """A whole number below 2^60 from the texts of the parts; NULLs count as missing."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _bits(rows: Column, range_rows: int) -> Column:
    """How many upper bits of a hash part `rows` rows into ranges of about range_rows."""
    return F.greatest(F.ceil(F.log2(rows / F.lit(float(range_rows)))), F.lit(0)).cast("int")


def interleave(
    rows: DataFrame, stratum: str, shards: int = 16, seed: str = "shard",
    key: list[str] | None = None, range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """rows with shard (0 to shards - 1) and slot (its place in the shard, without gaps).

    All columns travel: give it ids and what tells rows apart, and join texts by them, or whole rows
    (`write_shards`). `key` names the columns the order is drawn from, all by default; rows that tie
    are ordered by all columns, and rows equal in every column are interchangeable, each with a slot
    of its own. Shards differ by one row at most; fewer rows than shards leave shards empty, an
    empty table gives none. A NULL stratum is a stratum. Columns named shard or slot are replaced.
    Columns must be comparable (no maps). The same rows, seed and key give the same result, however
    the rows are stored; `range_rows` bounds what is sorted together and changes nothing else.
    """
    rows = rows.drop("shard", "slot")
    names, plain = rows.columns, [f"c{i}" for i in range(len(rows.columns))]
    column = dict(zip(names, plain, strict=True))
    packed = rows.toDF(*plain).select(F.struct(*plain).alias("row"))
    # Equal rows are one row with a count, so that a group of copies is never sorted in one task.
    packed = materialise(packed.groupBy("row").agg(F.count(F.lit(1)).alias("copies")).select(
        "row", "copies", F.struct(F.col(f"row.{column[stratum]}").alias("of")).alias("stratum"),
        drawn(F.lit(seed), *[F.col(f"row.{column[c]}") for c in key or names]).alias("draw")), "rows")
    # In a struct a NULL stratum equals itself, so that joins and windows share their partitioning.
    phase = drawn(F.lit(seed), F.lit("phase"), F.col("stratum.of")) / F.lit(float(1 << HASH_BITS))
    strata = materialise(packed.groupBy("stratum").agg(F.sum("copies").alias("n")).select(
        "stratum", "n", phase.alias("phase"),
        _bits(F.col("n"), range_rows).alias("bits")), "strata")
    total = strata.agg(F.sum("n")).first()[0] or 0

    placed = packed.join(strata, "stratum").withColumn(
        "range", F.expr(f"shiftright(draw, {HASH_BITS} - bits)"))
    sizes = placed.groupBy("stratum", "range").agg(F.sum("copies").alias("in_range"))
    before = F.coalesce(F.sum("in_range").over(Window.partitionBy("stratum").orderBy(
        "range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = materialise(sizes.select(
        "stratum", "range", before.alias("first")), "starts")
    in_range = Window.partitionBy("stratum", "range").orderBy("draw", "row")
    within = F.coalesce(F.sum("copies").over(
        in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = placed.withColumn("within", within).join(starts, ["stratum", "range"])
    # One row for each copy, in two steps, so that no long list is made of a large group.
    chunks = ranked.withColumn("chunk", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPIES).cast("bigint"))))
    single = chunks.withColumn("copy", F.explode(F.sequence(
        "chunk", F.least(F.col("chunk") + COPIES, F.col("copies")) - 1)))
    rank = F.col("first") + F.col("within") + F.col("copy")
    cells = 1 << max(0, math.ceil(math.log2(max(total, 1) / range_rows)))
    fraction = (rank + F.col("phase")) / F.col("n")
    spread = materialise(single.select("row", "stratum", fraction.alias("fraction")).withColumn(
        "cell", F.floor(F.col("fraction") * F.lit(float(cells))).cast("bigint")), "fractions")

    # Fractions are even by construction, so all cells have about the same number of rows.
    cell_sizes = spread.groupBy("cell").agg(F.count(F.lit(1)).alias("in_cell"))
    earlier = F.coalesce(F.sum("in_cell").over(Window.orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    cell_starts = materialise(cell_sizes.select(
        "cell", earlier.alias("cell_first")), "cells")
    in_cell = Window.partitionBy("cell").orderBy("fraction", "stratum")
    numbered = spread.withColumn("within", F.row_number().over(in_cell)).join(
        cell_starts, "cell").withColumn(
        "place", F.col("cell_first") + F.col("within") - 1)
    shard = F.expr(f"place * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {max(total, 1)} + {shards - 1}) div {shards}")
    return numbered.withColumn("shard", shard).withColumn("slot", F.col("place") - first).select(
        *[F.col(f"row.{column[c]}").alias(c) for c in names], F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"))


def write_shards(
    rows: DataFrame, path: str, stratum: str, shards: int = 16, file_rows: int = 1 << 20,
    **options: object,
) -> DataFrame:
    """Write rows interleaved (see interleave) below path, a folder per shard, and read them back.

    A file has file_rows rows of a shard at most, in slot order. Nothing that lies at path is
    replaced.
    """
    placed = interleave(rows, stratum, shards, **options)
    file = F.floor(F.col("slot") / file_rows)
    placed.repartition("shard", file).sortWithinPartitions("shard", "slot").write.option(
        "maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path)
    return rows.sparkSession.read.schema(placed.schema).parquet(path)
