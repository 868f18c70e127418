"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# SQL settings the operators rely on; safe to apply to a session somebody else created.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Two byte keys may decode to the same text; the later one wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A batch of long texts is held by the JVM and by the Python worker at once.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # Keys seen by a deduplicating stream live on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, name: str = "tidemark", **settings: str) -> SparkSession:
    """Session for tests and the bench. On a cluster the submitted session is used as it is."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may go without that setting; it gets a temporary folder instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        # Not local-cluster[...], whose executors are processes of their own.
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root()
    return root.rstrip("/")


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a frame."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, label: str) -> DataFrame:
    """A frame as a table in the shared folder: computed once, read back with column pruning."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, at = _located(spark, path)
    return files.exists(at)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders in a folder; none if it is not there."""
    files, at = _located(spark, path)
    return [s.getPath().toString() for s in files.listStatus(at) if s.isDirectory()] if files.exists(at) else []


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder that nothing is computed from any more, in whatever file system it lies; whether it was there."""
    files, at = _located(spark, path)
    return files.delete(at, True)
