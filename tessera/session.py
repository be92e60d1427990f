"""Shared folder, lineage cuts and size checks."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="tessera-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Ends the lineage, survives the loss of executors, and gives the planner the true size.
    """
    path = work_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()


def bounded_rows(df: DataFrame, max_rows: int, max_bytes: int = 256 << 20) -> pa.Table | None:
    """The rows of ``df`` if there are at most ``max_rows`` of them, else None.

    Never more than ``max_rows + 1`` rows reach the driver.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > max_bytes:
        return None
    return rows


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash a scan over all cores if it comes in fewer splits than that; else leave it alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
