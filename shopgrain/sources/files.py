"""A table as a list of files, so that a load rewrites only the files it touches.

A version of the table is a manifest that names its data files, with the row count and the range of
the cut column of each. A merge reads the files whose range holds an incoming value, writes them
anew, and carries all others over by reference. A manifest is written aside and then renamed to its
number, which fails if another load was faster; so two loads never take one number, and a reader
never sees half a version. Data files are never overwritten.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.operators.merge import reject_duplicate_keys, upsert
from shopgrain.session import materialise


class CommitConflict(RuntimeError):
    """Another load has stored the next version first; read it and merge again."""


class FileTable:
    def __init__(self, spark: SparkSession, root: str, schema: str, keys: list[str], cut: str,
                 file_rows: int = 1 << 21):
        """`cut` is an integer column that files are cut by, such as a date id; `keys` are unique.

        A file has at most file_rows rows, so that a merge rewrites little around what it changes.
        """
        self._spark, self._root, self._schema = spark, root.rstrip("/"), schema
        self._keys, self._cut, self._file_rows = keys, cut, file_rows
        jvm = spark.sparkContext._jvm
        self._fs_api, self._conf = jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()

    # --- the file system

    def _path(self, name: str):
        return self._fs_api.Path(f"{self._root}/{name}")

    def _fs(self):
        return self._path("manifest").getFileSystem(self._conf)

    def versions(self) -> list[int]:
        """The numbers of all stored versions, ascending."""
        done = self._fs().globStatus(self._path("manifest/v*.json"))
        return sorted(int(s.getPath().getName()[1:-5]) for s in (done or []))

    def files(self, version: int | None = None) -> list[dict]:
        """path, rows, low and high of each file of a version, the newest by default."""
        numbers = self.versions()
        if not numbers:
            return []
        text = self._spark.read.text(
            f"{self._root}/manifest/v{version or numbers[-1]:09d}.json", wholetext=True).first()[0]
        return json.loads(text)["files"]

    def _commit(self, version: int, files: list[dict]) -> None:
        fs, aside = self._fs(), self._path(f"manifest/.{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps({"files": files}).encode()))
        out.close()
        context = self._fs_api.FileContext.getFileContext(fs.getUri(), self._conf)
        none = self._spark.sparkContext._gateway.new_array(
            self._spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(aside, self._path(f"manifest/v{version:09d}.json"), none)
        except Exception as error:
            fs.delete(aside, False)
            if version in self.versions():
                raise CommitConflict(f"version {version} of {self._root} exists already") from error
            raise

    def _store(self, df: DataFrame) -> list[dict]:
        """Write rows as new files, cut and sorted, and list them."""
        folder = f"{self._root}/data/{uuid.uuid4().hex}"
        order = [self._cut, *self._keys]
        df.repartitionByRange(*order).sortWithinPartitions(*order).write.option(
            "maxRecordsPerFile", self._file_rows).parquet(folder)
        rows = self._spark.read.schema(self._schema).parquet(folder).groupBy(
            F.input_file_name().alias("path")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(self._cut).alias("low"), F.max(self._cut).alias("high"))
        return [r.asDict() for r in rows.orderBy("low", "path").collect()]

    # --- reading and writing

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, first: int | None = None, last: int | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version, or those of a range of the cut column: other files are not opened."""
        found = [f for f in self.files(version)
                 if (first is None or f["high"] >= first) and (last is None or f["low"] <= last)]
        rows = self._read(found)
        if first is not None:
            rows = rows.where(F.col(self._cut) >= first)
        return rows if last is None else rows.where(F.col(self._cut) <= last)

    def _read(self, files: list[dict]) -> DataFrame:
        if not files:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*[f["path"] for f in files])

    def write(self, df: DataFrame) -> None:
        """Store df as the whole next version. Keys must be unique, the cut column not NULL."""
        base = max(self.versions(), default=0)
        columns = self._read([]).columns
        self._commit(base + 1, self._store(reject_duplicate_keys(df.select(*columns), self._keys)))

    def merge(
        self, incoming: DataFrame, update_cols: list[str] | None = None, moves: bool = False,
    ) -> dict[str, int]:
        """Upsert rows by key into the files whose range they fall in; says what became of files.

        A key's cut value does not change, as an order's date does not. With `moves` it may: files
        that hold an incoming key elsewhere are rewritten too, which reads the key columns of the
        whole table. The distinct cut values of a load and the list of files go through the driver.
        """
        base, held = max(self.versions(), default=0), self.files()
        columns = self._read([]).columns
        incoming = materialise(incoming.select(*columns), "incoming")
        values = sorted(r[0] for r in incoming.select(self._cut).distinct().collect())
        if not values:
            return {"kept": len(held), "rewritten": 0, "written": 0}

        def holds(f: dict) -> bool:
            at = bisect_left(values, f["low"])
            return at < len(values) and values[at] <= f["high"]

        touched = [f for f in held if holds(f)]
        others = [f for f in held if not holds(f)]
        if moves and others:
            path = F.input_file_name().alias("path")
            strays = self._read(others).select(*self._keys, path).join(
                incoming.select(*self._keys), self._keys, "left_semi")
            moved = {r["path"] for r in strays.select("path").distinct().collect()}
            touched += [f for f in others if f["path"] in moved]
            others = [f for f in others if f["path"] not in moved]
        merged = upsert(self._read(touched), incoming, self._keys, update_cols)
        written = self._store(merged)
        self._commit(base + 1, sorted(others + written, key=lambda f: (f["low"], f["path"])))
        return {"kept": len(others), "rewritten": len(touched), "written": len(written)}

    def expire(self, keep: int) -> int:
        """Forget all but the newest `keep` versions and delete the files only they have; says how many.

        Not to be run while a load is on its way: its files belong to no version yet.
        """
        if keep < 1:
            raise ValueError("at least one version stays")
        numbers = self.versions()
        gone, stay = numbers[:-keep], numbers[-keep:]
        needed = {f["path"] for n in stay for f in self.files(n)}
        unused = {f["path"] for n in gone for f in self.files(n)} - needed
        fs = self._fs()
        # Manifests first: a version that can be read has all its files.
        for n in gone:
            fs.delete(self._path(f"manifest/v{n:09d}.json"), False)
        for path in unused:
            fs.delete(self._fs_api.Path(path), False)
        return len(unused)
