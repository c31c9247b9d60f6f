"""Session construction and the shared scratch location.

On a cluster the checkpoint directory comes from ``spark.checkpoint.dir``
(a shared, fault-tolerant file system). Only a local session without that
setting gets a fresh directory under the machine's temp folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


# Settings for a large cluster (~100 TB inputs). Shuffle partitions are an
# upper bound: AQE coalesces them from measured sizes, splits skewed join
# partitions and rebalanced writes. The checkpoint folder must be shared.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str = "local[8]",
    app: str = "starloom",
    shuffle_partitions: int = 8,
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting one only for local runs."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder on the cluster"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path beside the checkpoints for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/starloom-scratch/{name}-{uuid.uuid4().hex}"


#: A table of known size gets a file for so many rows (of documents), but up to LEAST_FILES.
ROWS_A_FILE, LEAST_FILES = 4096, 6


def few_parts(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many partitions, and so files, as about ``rows`` rows are worth, at
    most in those it has. A part file written to a local file system costs the
    executor three new processes (Hadoop sets modes by ``chmod``)."""
    return df.coalesce(max(LEAST_FILES, rows // ROWS_A_FILE))


def cut_lineage(df: DataFrame, name: str = "cut", rows: int | None = None, **options: str) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and read it back.

    Unlike ``DataFrame.checkpoint`` the plan runs once (no second job to
    save the data), the copy is columnar (later reads prune columns) and
    the re-read table carries file-size statistics for the planner. The
    folder is the cluster's ``spark.checkpoint.dir``, never a local temp dir.
    ``options`` are the writer's. ``rows``, about how many rows there are, keeps a
    small table from being written as one file for each shuffle partition.
    """
    if rows is not None:
        df = few_parts(df, rows)
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_counted(df: DataFrame, name: str = "cut", narrow: int = 1) -> tuple[DataFrame, int]:
    """:func:`cut_lineage` for a table whose size is not known before, and its number
    of rows. The rows wait on the executors' disks while they are counted, so the plan
    runs once, with all its tasks. ``narrow`` rows count as one of a document."""
    held = df.persist(StorageLevel.DISK_ONLY)
    n = held.count()
    table = cut_lineage(held, name, n // narrow)
    held.unpersist()
    return table, n
