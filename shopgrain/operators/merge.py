"""Insert-if-absent, upsert, update-from-aggregate and table difference on plain DataFrames.

Each takes the present table and the incoming rows and returns the full next table; a writer then
stores it as a new version, so nothing is overwritten while it is read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from shopgrain.session import materialise


def reject_duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """df itself, failing the job if two rows share a key.

    Counting over a window leaves df partitioned and sorted by key, which the merge join reuses;
    a grouping would add a map-side pass that cannot shrink rows with distinct keys.
    """
    return reject_counted(count_copies(df, keys, "_copies"), keys, ["_copies"])


def count_copies(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """df with a column that tells how many rows share the row's key."""
    return df.withColumn(name, F.count(F.lit(1)).over(W.partitionBy(*keys)))


def reject_counted(df: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """df without the counts of `count_copies`, failing the job if one of them is above 1."""
    name = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    failure = F.raise_error(F.concat(F.lit("duplicate upsert key: "), name))
    several = reduce(lambda x, y: x | y, [F.col(c) > 1 for c in counts])
    return df.where(F.when(several, failure.cast("boolean")).otherwise(True)).drop(*counts)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """existing plus the incoming rows whose key it does not hold yet."""
    fresh = incoming.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: list[str],
    update_cols: list[str] | None = None,
) -> DataFrame:
    """existing with incoming rows added, or merged into the row of the same key.

    By default every non-key column is updated; `update_cols` freezes all others at the value of
    the first insert. A key that occurs twice in incoming is an error.
    """
    rest = [c for c in existing.columns if c not in keys]
    updated = set(rest if update_cols is None else update_cols)
    unknown = updated - set(rest)
    if unknown:
        raise ValueError(f"cannot update {sorted(unknown)}")
    old = existing.select(*keys, F.struct(*rest).alias("_old"))
    new = reject_duplicate_keys(incoming.select(*existing.columns), keys)
    new = new.select(*keys, F.struct(*rest).alias("_new"))

    def merged(c: str):
        has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
        take_new = has_new if c in updated else ~has_old
        return F.when(take_new, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)

    joined = old.join(new, keys, "full")
    return joined.select(*keys, *[merged(c) for c in rest]).select(*existing.columns)


def held_apart(existing: DataFrame, incoming_keys: DataFrame, keys: list[str]) -> DataFrame | None:
    """Keys of existing that `replace_rows` must look at: absent in incoming, or held several times.

    Stored with `_copies` and whether they are `_absent`; None if there are none, as after a repeated
    load. Only keys are shuffled.
    """
    # Dealt by the first key alone, as incoming keys may be by then.
    held = existing.select(*keys).repartition(keys[0]).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"))
    seen = incoming_keys.select(*keys).distinct().withColumn("_seen", F.lit(True))
    apart = materialise(held.join(seen, keys, "left").select(
        *keys, "_copies", F.col("_seen").isNull().alias("_absent")
    ).where("_copies > 1 OR _absent"), "held_apart")
    return None if apart.isEmpty() else apart


def replace_rows(
    existing: DataFrame, incoming: DataFrame, keys: list[str], apart: DataFrame | None,
) -> DataFrame:
    """`upsert` of all columns, by the keys that `held_apart` found.

    Rows of existing are read only for keys that incoming lacks, so that a load that repeats most of
    a large table does not shuffle it. incoming must be free of keys that occur twice.
    """
    rows = incoming.select(*existing.columns)
    if apart is None:
        return rows
    copies = apart.where("NOT _absent").drop("_absent")
    rows = rows.join(copies, keys, "left").withColumn(
        "_copy", F.explode(F.array_repeat(F.lit(1), F.coalesce(F.col("_copies"), F.lit(1)).cast("int"))))
    absent = apart.where("_absent").select(*[F.col(c).alias(f"_{c}") for c in keys])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    return rows.select(*existing.columns).unionByName(existing.join(absent, same, "left_semi"))


def update_from(
    target: DataFrame, source: DataFrame, keys: list[str], columns: dict[str, str]
) -> DataFrame:
    """target with each `columns` key set from the source column named by its value.

    Source holds at most one row per key; target rows without one keep their values.
    """
    picked = source.select(*keys, F.struct(*columns.values()).alias("_src"))
    joined = target.join(picked, keys, "left")

    def value(c: str):
        if c not in columns:
            return F.col(c)
        changed = F.col(f"_src.{columns[c]}").cast(target.schema[c].dataType)
        return F.when(F.col("_src").isNotNull(), changed).otherwise(F.col(c)).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def row_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with `change` copies gained (negative: lost).

    Empty means the two tables are equal as bags. One shuffle with map-side combine, where
    `exceptAll` both ways would take four.
    """
    columns = before.columns
    signed = [before.withColumn("_sign", F.lit(-1)),
              after.select(*columns).withColumn("_sign", F.lit(1))]
    both = reduce(DataFrame.unionByName, signed)
    return both.groupBy(*columns).agg(F.sum("_sign").alias("change")).where("change <> 0")


def fingerprints(df: DataFrame, by: str) -> DataFrame:
    """Per value of `by` the row count and two sums of row hashes, equal for equal bags of rows.

    A hash is summed in its upper 32 bits and in two lower parts of 16, as whole numbers: exact for
    2^32 rows of one value, and far cheaper than decimals that hold the sum of 64 bits.
    """
    hashes = {name: F.xxhash64(F.lit(seed), *df.columns) for name, seed in (("one", 1), ("two", 2))}

    def total(name: str):
        c = F.col(f"_{name}")
        parts = (F.shiftright(c, 32), F.shiftright(c, 16).bitwiseAND(0xFFFF), c.bitwiseAND(0xFFFF))
        return F.struct(*[F.sum(part).alias(f"p{k}") for k, part in enumerate(parts)]).alias(name)

    return df.select(by, *[c.alias(f"_{name}") for name, c in hashes.items()]).groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), total("one"), total("two"))


def row_diff_by(before: DataFrame, after: DataFrame, by: str) -> DataFrame:
    """`row_diff` of two states of a large table: only ranges whose fingerprints differ are compared.

    Of a range of equal rows only its fingerprint is shuffled. Rows that differ pass unseen if two
    64-bit sums agree by chance.
    """
    sums = ["n", "one", "two"]
    old, new = (fingerprints(df.select(*before.columns), by).select(
        F.struct(F.col(by)).alias("r"), F.struct(*sums).alias(name))
        for df, name in ((before, "old"), (after, "new")))
    differing = materialise(old.join(new, "r", "full").where(
        ~F.col("old").eqNullSafe(F.col("new"))).select(F.col("r")[by].alias("_by")), "differing")
    if differing.isEmpty():
        return row_diff(before.limit(0), before.limit(0))
    parts = [df.join(differing, F.col(by).eqNullSafe(F.col("_by")), "left_semi") for df in (before, after)]
    return row_diff(*parts)
