"""Session settings that the operators read."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Rows of a task that does costly work on each.
SPREAD_ROWS = 50_000


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if path:
        return path
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def settle(df: DataFrame) -> DataFrame:
    """The rows of ``df`` computed once and kept in the shared folder, for frames that are used several times."""
    context = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or a folder of any file system that Spark knows; nothing if there is none."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder of any file system that Spark knows; none if there is no such folder."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(context._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def spread(df: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """A scan dealt out evenly over all cores, in partitions of about ``rows`` rows at most.

    For costly work per row. A scan may have as many partitions as there are cores and yet hold all rows in one of them,
    for row groups and some files can't be split; and partitions by bytes hold more rows the better these compress. So
    rows are counted first, which Parquet has in its footers, and a task's work stays the same as the table grows.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows)))
