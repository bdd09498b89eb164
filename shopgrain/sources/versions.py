"""Numbered copies of a table: write the next one, read the newest complete one.

A load that reads a table and replaces it must not overwrite its own input, and a lost job must
not leave half a table behind. Spark writes `_SUCCESS` last, which marks a copy as complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CODEC = "zstd"  # versions stay side by side, so they are packed tighter than Spark's default


class VersionedTables:
    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str] | None = None):
        """`schemas` gives the DDL of known tables, which spares their schema inference."""
        self._spark = spark
        self._root = root.rstrip("/")
        self._schemas = schemas or {}

    def _newest(self, name: str) -> int:
        jvm = self._spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}")
        fs = folder.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())
        done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}/v*/_SUCCESS"))
        numbers = [int(s.getPath().getParent().getName()[1:]) for s in (done or [])]
        return max(numbers, default=0)

    def _path(self, name: str, number: int) -> str:
        return f"{self._root}/{name}/v{number:06d}"

    def exists(self, name: str) -> bool:
        return self._newest(name) > 0

    def read(self, name: str) -> DataFrame:
        number = self._newest(name)
        if number == 0:
            raise FileNotFoundError(f"no complete version of {name} under {self._root}")
        reader = self._spark.read
        if name in self._schemas:
            reader = reader.schema(self._schemas[name])
        return reader.parquet(self._path(name, number))

    def write(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Store df as the next version. A failed attempt left no marker, so it is replaced."""
        path = self._path(name, self._newest(name) + 1)
        writer = df.write.mode("overwrite").option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        return self.read(name)
