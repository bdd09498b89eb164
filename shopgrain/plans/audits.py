"""Rules a database would enforce on write, as audit jobs over written tables.

Each audit returns one row per rule: table_name, rule, violations, sample_key. The sample is the
smallest offending key as text, so it is one value however many rows offend. Rows are counted per
key on the executors before any join or final count, so a frequent key is cheap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from shopgrain.operators.joins import join_size
from shopgrain.sources.schemas import (
    SHOP_DDL, STAR_DDL, STAR_FOREIGN_KEYS, STAR_NULLABLE, STAR_UNIQUE_KEYS, ForeignKey, Rules,
)
from shopgrain.sources.tables import Shop


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _key_text(columns: tuple[str, ...] | list[str]) -> Column:
    return F.concat_ws("/", *[F.col(c).cast("string") for c in columns])


def _verdict(df: DataFrame, table: str, rule: str, violations: Column, sample: Column):
    return df.agg(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"),
        F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
        sample.alias("sample_key"),
    )


def duplicate_keys(df: DataFrame, table: str, key: tuple[str, ...]) -> DataFrame:
    """Keys held by more than one row; keys with a NULL part are never equal."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    repeated = (
        df.where(present).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    )
    return _verdict(repeated, table, f"unique({', '.join(key)})", F.count(F.lit(1)),
                    F.min(_key_text(key)))


def audit_unique(shop: Shop, rules: Rules = Rules()) -> DataFrame:
    return _union([
        duplicate_keys(shop.table(table), table, key)
        for table, keys in rules.unique.items() for key in keys
    ])


def _row_rules(df: DataFrame, table: str, key: str, broken: dict[str, Column]) -> DataFrame:
    """Any number of row-wise rules of one table in a single pass."""
    sample = _key_text([key])
    outcomes = F.array(*[
        F.struct(
            F.lit(table).alias("table_name"), F.lit(rule).alias("rule"),
            F.count_if(bad).alias("violations"), F.min(F.when(bad, sample)).alias("sample_key"),
        )
        for rule, bad in broken.items()
    ])
    return df.agg(outcomes.alias("o")).select(F.explode("o").alias("o")).select("o.*")


def _key_of(table: str, rules: Rules) -> str:
    return rules.unique[table][0][0]


def audit_not_null(shop: Shop, rules: Rules = Rules()) -> DataFrame:
    parts = []
    for table, ddl in SHOP_DDL.items():
        names = [part.split()[0] for part in ddl.split(", ")]
        required = [n for n in names if n not in rules.nullable.get(table, set())]
        df = shop.table(table)
        broken = {f"{n} IS NOT NULL": F.col(n).isNull() for n in required if n in df.columns}
        parts.append(_row_rules(df, table, _key_of(table, rules), broken))
    return _union(parts)


def _checks(shop: Shop, checks: dict[str, list[str]], rules: Rules) -> DataFrame:
    parts = []
    for table, texts in checks.items():
        # A NULL outcome passes, so a row is bad only where the rule is plainly false.
        broken = {text: ~F.coalesce(F.expr(text), F.lit(True)) for text in texts}
        parts.append(_row_rules(shop.table(table), table, _key_of(table, rules), broken))
    return _union(parts)


def audit_domains(shop: Shop, rules: Rules = Rules()) -> DataFrame:
    return _checks(shop, rules.domains, rules)


def audit_cross_column(shop: Shop, rules: Rules = Rules()) -> DataFrame:
    return _checks(shop, rules.cross_column, rules)


def _orphans(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """Child rows whose reference has no parent; NULL references are allowed.

    The child is counted per referenced key first, so the anti join sees each key once.
    """
    used = child.where(F.col(fk.column).isNotNull()).groupBy(F.col(fk.column).alias("ref")).agg(
        F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(fk.parent_column).alias("ref"))
    return _verdict(used.join(parents, "ref", "left_anti"), fk.table,
                    f"{fk.column} references {fk.parent}", F.sum("n"), F.min(_key_text(["ref"])))


def audit_foreign_keys(shop: Shop, rules: Rules = Rules()) -> DataFrame:
    return _union([_orphans(shop.table(fk.table), shop.table(fk.parent), fk)
                   for fk in rules.foreign_keys])


def star_audit_unique(star: dict[str, DataFrame]) -> DataFrame:
    return _union([duplicate_keys(star[table], table, key)
                   for table, keys in STAR_UNIQUE_KEYS.items() for key in keys])


def star_audit_not_null(star: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for table, ddl in STAR_DDL.items():
        names = [part.split()[0] for part in ddl.split(", ")]
        required = [n for n in names if n not in STAR_NULLABLE.get(table, set()) | {"order_month"}]
        parts.append(_row_rules(star[table], table, STAR_UNIQUE_KEYS[table][0][0],
                                {f"{n} IS NOT NULL": F.col(n).isNull() for n in required}))
    return _union(parts)


def star_audit_foreign_keys(star: dict[str, DataFrame]) -> DataFrame:
    return _union([_orphans(star[fk.table], star[fk.parent], fk) for fk in STAR_FOREIGN_KEYS])


def cascade_plan(shop: Shop, users: DataFrame, coupons: DataFrame) -> DataFrame:
    """Rows that deleting these users and coupons would reach: (table_name, action, rows).

    Orders of deleted users go with their lines, payments and shipments, reviews go with their
    author, and other orders merely lose a deleted coupon.
    """
    gone_users = users.select("user_id").distinct()
    gone_coupons = coupons.select("coupon_id").distinct()
    orders = shop.orders.select("order_id", "user_id", "coupon_id")
    doomed = orders.join(gone_users, "user_id", "left_semi").select("order_id")

    def reach(df: DataFrame, table: str, action: str) -> DataFrame:
        return df.agg(F.lit(table).alias("table_name"), F.lit(action).alias("action"),
                      F.count(F.lit(1)).alias("rows_affected"))

    def with_order(table: str) -> DataFrame:
        return shop.table(table).select("order_id").join(doomed, "order_id", "left_semi")

    uncouponed = (
        orders.join(gone_users, "user_id", "left_anti")
        .join(gone_coupons, "coupon_id", "left_semi")
    )
    reviews = shop.reviews.select("user_id").join(gone_users, "user_id", "left_semi")
    return _union([
        reach(gone_users, "users", "delete"),
        reach(doomed, "orders", "delete"),
        reach(with_order("order_items"), "order_items", "delete"),
        reach(with_order("payments"), "payments", "delete"),
        reach(with_order("shipments"), "shipments", "delete"),
        reach(reviews, "reviews", "delete"),
        reach(gone_coupons, "coupons", "delete"),
        reach(uncouponed, "orders", "set coupon_id null"),
    ])


def join_fanout_report(joins: dict[str, tuple[DataFrame, DataFrame, list[str]]]) -> DataFrame:
    """For each named join: rows before and after, worst key, and rows without a match."""
    return _union([
        join_size(left, right, on).select(F.lit(name).alias("join_name"), "*")
        for name, (left, right, on) in joins.items()
    ])


def scd2_audit(dim_customer: DataFrame) -> DataFrame:
    """Faults in a history: several open versions, overlaps, empty intervals, wrong flags.

    The window holds one user's versions, whose number the version key limits.
    """
    later = W.partitionBy("user_id").orderBy("valid_from", "customer_key")
    open_ended = F.col("valid_to").isNull()
    rows = dim_customer.select(
        "user_id", "customer_key", "valid_from", "valid_to", "is_current",
        F.lead("valid_from").over(later).alias("next_from"),
    )
    overlap = F.col("next_from").isNotNull() & (
        open_ended | (F.col("next_from") < F.col("valid_to"))
    )
    per_row = _row_rules(rows, "dim_customer", "customer_key", {
        "no overlapping versions": overlap,
        "no empty interval": F.coalesce(F.col("valid_to") <= F.col("valid_from"), F.lit(False)),
        "is_current means open": F.col("is_current") != open_ended,
    })
    open_versions = dim_customer.where(open_ended).select("user_id")
    return per_row.unionByName(
        duplicate_keys(open_versions, "dim_customer", ("user_id",))
        .withColumn("rule", F.lit("one open version per user"))
    )


def table_counts(shop: Shop) -> DataFrame:
    """Rows of each shop table."""
    return _union([
        shop.table(name).agg(F.lit(name).alias("table_name"),
                             F.count(F.lit(1)).alias("row_count"))
        for name in SHOP_DDL
    ])
