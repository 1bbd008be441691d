"""Shared scratch space, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows above which a side is never hinted for broadcast.
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster
    session without it is an error, because a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return _qualified(spark, configured)
    if sc.getCheckpointDir() is not None:
        return _qualified(spark, sc.getCheckpointDir().rsplit("/", 1)[0])
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="deltaloom-"))
    return _qualified(spark, sc.getCheckpointDir().rsplit("/", 1)[0])


def _qualified(spark: SparkSession, path: str) -> str:
    """Path with its file system, so that tasks and driver mean the same place."""
    fs, hadoop_path = file_system(spark, path)
    return fs.makeQualified(hadoop_path).toString().rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write the frame to the shared folder and go on from the files.

    Survives lost executors, and unlike a checkpoint the Parquet files keep
    column pruning and filter pushdown for whatever reads them next.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def compiled_in_parts(spark: SparkSession) -> Iterator[None]:
    """For jobs of many long expressions: a stage compiled to a method above 8000 bytes of code is never optimised by the JVM, so such ones go expression by expression."""
    name, limit = "spark.sql.codegen.hugeMethodLimit", "8000"
    before = spark.conf.get(name, None)
    spark.conf.set(name, limit)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def broadcast_counted(df: DataFrame, rows: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the known row count allows it."""
    return F.broadcast(df) if rows <= max_rows else df


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` stays within ``max_rows``.

    Beyond the bound the frame is returned without a hint and Spark joins by
    shuffling. The count stops as soon as the bound is passed.
    """
    return broadcast_counted(df, df.limit(max_rows + 1).count(), max_rows)


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object for a driver-side listing."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_dir(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))
