"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Skew splitting is forced because several joins feed an
# aggregation on the join key, where AQE would otherwise skip the split to save a shuffle.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# What one task of a join or grouping takes in, as shuffled, and input bytes per initial partition.
# A shuffled megabyte is up to forty in sorts and hash maps, so larger pieces spill.
TASK_BYTES = 4 << 20
INPUT_BYTES_PER_PARTITION = 2 << 20


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, folder: str) -> SparkSession:
    """Shuffle into a number of partitions that grows with the tables of a folder.

    With a fixed number a task grows with its input and spills. AQE merges what is small, up to
    TASK_BYTES; a session that asks for smaller tasks or more partitions keeps them.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    asked = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get(advisory))
    spark.conf.set(advisory, str(min(asked, TASK_BYTES)))
    spark.conf.set(initial, str(max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                    -(-held // INPUT_BYTES_PER_PARTITION))))
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime setting for what is run inside, and the one before it afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def local_session(cores: int | str = 8, name: str = "shopgrain", **conf: str) -> SparkSession:
    """A session for tests and the local bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables: the one the cluster names in `spark.checkpoint.dir`.

    Where that is unset, as in tests, a folder of the warehouse, if executors share it as well.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        own_disk = warehouse.startswith(("file:", "/")) and not sc.master.startswith("local")
        if own_disk:
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share: the "
                             f"warehouse {warehouse} is one of each machine")
        root = f"{warehouse}/_scratch"
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{sc.applicationId}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the scratch folder and read it back.

    Used where one costly aggregate feeds several jobs. A written table survives lost executors,
    and unlike a cached one keeps column pruning and filter pushdown for its readers.
    """
    path = f"{scratch_dir(df.sparkSession)}/tmp/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
