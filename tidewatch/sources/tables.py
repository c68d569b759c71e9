"""Sinks: tables, and copies of intermediate results on shared storage."""

from __future__ import annotations

import logging
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

logger = logging.getLogger(__name__)


def write_table(
    df: DataFrame, name: str, partition_by: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Replaces a catalog table by the rows of ``df`` and returns a scan of it.

    With a partition column the rows are first brought together by it. AQE splits a
    large partition value over several tasks (rebalance), so a hot month is not one file.
    """
    writer = df
    if partition_by is not None:
        writer = df.hint("rebalance", partition_by)
    writer = writer.write.mode("overwrite").format(fmt)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in spark.checkpoint.dir.

    Only a session within one process may go without the setting; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidewatch-")
    context.setCheckpointDir(folder)
    return folder


def write_once(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and returns a scan of the copy.

    For results that several branches of a plan read: they are computed once, survive the
    loss of executors, and have a known size when the rest is planned. The copy stays for as
    long as its readers may come, which only the caller knows: see ``Copies`` for one that ends
    with a job. The folder belongs to the cluster, which clears it.
    """
    return _written(df)[1]


def _written(df: DataFrame) -> tuple[str, DataFrame]:
    path = f"{shared_folder(df.sparkSession)}/once-{uuid.uuid4().hex}"
    df.write.parquet(path)
    logger.info("copy written to %s", path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


class Copies:
    """Copies as ``write_once`` makes them, removed at the end of the ``with`` block."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        path, copy = _written(df)
        self.paths.append(path)
        return copy

    def __enter__(self) -> Copies:
        return self

    def __exit__(self, *_) -> None:
        self.remove()

    def remove(self) -> None:
        while self.paths:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
