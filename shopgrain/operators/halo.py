"""Row frames over keys that are too large for one task: buckets of rows, each with its halo.

A frame of the last n rows of a key needs, at the beginning of a bucket, the n - 1 rows before it.
Each bucket hands on its last rows; as every bucket that exists has a row, the rows wanted lie in
the n - 1 buckets before, so that a bounded look back over buckets finds them. Keys with so few rows
that their halos would outweigh them stay whole, as one bucket.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from shopgrain.session import materialise

# Rows of a key per row of a halo up to which the key is one bucket.
WHOLE_UP_TO = 16


def with_halo(df: DataFrame, keys: list[str], order: str, bucket: Column, rows: int) -> DataFrame:
    """df with _bucket and _halo: each bucket has its rows, and up to `rows` rows before it (_halo).

    `bucket` ascends with `order` within a key. A frame of rows - at most `rows` before the present
    one - over (keys, _bucket) gives the rows that are not halo what it would give them over keys.
    """
    columns = df.columns
    large = materialise(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") > WHOLE_UP_TO * rows).select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.lit(True).alias("_large")), "large")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    placed = df.withColumn("_bucket", bucket).join(large, same, "left").select(
        *columns, F.when(F.col("_large"), F.col("_bucket")).otherwise(F.lit(0)).alias("_bucket"), "_large")
    latest = W.partitionBy(*keys, "_bucket").orderBy(F.desc(order))
    parted, placed = placed.where("_large").drop("_large"), placed.drop("_large")
    last = parted.withColumn("_n", F.row_number().over(latest)).where(F.col("_n") <= rows)
    row = F.struct(F.col(order).alias("_at"), *columns)
    tails = last.groupBy(*keys, "_bucket").agg(F.sort_array(F.collect_list(row)).alias("_tail"))
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(-rows, -1)
    earlier = tails.withColumn("_earlier", F.flatten(F.collect_list("_tail").over(before)))
    first = F.greatest(F.size("_earlier") - rows + 1, F.lit(1))
    wanted = earlier.select("_bucket", F.explode(F.slice("_earlier", first, rows)).alias("_r"))
    halo = wanted.select(*[F.col(f"_r.{c}").alias(c) for c in columns], "_bucket")
    return placed.withColumn("_halo", F.lit(False)).unionByName(halo.withColumn("_halo", F.lit(True)))
