"""Readers for the shop tables: Parquet, CSV with a NULL marker, JDBC."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.sources.schemas import NULLABLE, SHOP_DDL
from shopgrain.sources.versions import VersionedTables


class Shop:
    """The ten shop tables as attributes, each loaded when first asked for."""

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in SHOP_DDL:
            raise KeyError(f"no shop table called {name!r}")
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self.table(name)
        except KeyError as missing:
            raise AttributeError(str(missing)) from None


def read_parquet_shop(spark: SparkSession, folder: str) -> Shop:
    """`<folder>/<table>.parquet` for every table."""
    def load(name: str) -> DataFrame:
        return spark.read.schema(SHOP_DDL[name]).parquet(f"{folder}/{name}.parquet")

    return Shop(load)


def write_parquet_shop(shop: Shop, folder: str) -> None:
    """Store all ten tables where `read_parquet_shop` finds them, replacing older ones.

    Rows are spread evenly over files of the size AQE advises.
    """
    for name in SHOP_DDL:
        shop.table(name).hint("rebalance").write.mode("overwrite").parquet(
            f"{folder}/{name}.parquet"
        )


def read_csv(
    spark: SparkSession, path: str, table: str, line_breaks_in_text: bool = False
) -> DataFrame:
    """Headerless CSV in the table's column order; an unquoted \\N is NULL, quotes double.

    Quoted line breaks need `line_breaks_in_text`; each file is then read by one task, so such a
    table should come in many files.
    """
    return (
        spark.read.schema(SHOP_DDL[table])
        .option("nullValue", "\\N")
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", str(line_breaks_in_text).lower())
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, table: str) -> None:
    """The inverse of `read_csv`."""
    columns = [part.split()[0] for part in SHOP_DDL[table].split(", ")]
    (
        df.select(*columns)
        .write.mode("overwrite")
        .option("nullValue", "\\N")
        .option("escape", '"')
        .csv(path)
    )


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int,
    partitions: int, **options: str,
) -> DataFrame:
    """A table of the operational database, read in parallel ranges of an integer key."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=str(lower),
                 upperBound=str(upper), numPartitions=str(partitions), **options)
        .load()
    )


def reload_parquet(df: DataFrame, path: str) -> DataFrame:
    """Truncate and reload: df takes the place of the whole data set at path, which it may read.

    The rows are stored as the next version below path, so a lost job leaves the old ones.
    """
    root, _, name = path.rstrip("/").rpartition("/")
    return VersionedTables(df.sparkSession, root).write(name, df)


def with_defaults(df: DataFrame, table: str, loaded_at: str) -> DataFrame:
    """df with all columns of the table: `created_at` is the load's time where df brings none.

    Other absent columns are NULL where the table allows that, and an error where it does not.
    A column that is present keeps its values, NULLs included, for the audits to find.
    """
    out = []
    for part in SHOP_DDL[table].split(", "):
        name, kind = part.split(" ", 1)
        if name in df.columns:
            out.append(F.col(name))
        elif name == "created_at":
            out.append(F.lit(loaded_at).cast(kind).alias(name))
        elif name in NULLABLE.get(table, set()):
            out.append(F.lit(None).cast(kind).alias(name))
        else:
            raise ValueError(f"{table} needs a column {name}")
    return df.select(*out)
