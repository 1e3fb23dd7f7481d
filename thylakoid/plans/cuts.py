"""Durable cuts of long plans, in the folder that all executors share, and what bounds a task whatever the size of the tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Arrow batches to Python workers are cut at this size, so that long texts can't pile up.
ARROW_BYTES = 8 << 20
#: Partitions that a shuffle begins with, and the size up to which Spark joins them, so that there are more tasks for more data.
PARTITIONS, JOINED_BYTES = 1024, 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; one of our own only in local mode, where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="thylakoid-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder, without its lineage.

    Spark deletes the files when the frame is let go of, where the cluster sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def let_go(spark: SparkSession) -> None:
    """From here on Spark deletes a query's shuffle files when the query ends, not when the driver happens to collect its garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that a plan wrote and no frame reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark: SparkSession, size: int = ARROW_BYTES) -> None:
    """Cut what goes to Python workers by bytes, not only by rows: a session's tighter limit stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    found = spark.conf.get(name, None)
    if found is None or not found.isdigit() or int(found) > size:
        spark.conf.set(name, str(size))


def bounded_shuffles(spark: SparkSession, partitions: int = PARTITIONS, joined: int = JOINED_BYTES) -> None:
    """Let shuffles begin with many partitions, which Spark joins up to a size: what a session sets itself stays.

    Narrow rows take some twenty times as much in a sort as in a shuffle.
    """
    for name, value in (("coalescePartitions.initialPartitionNum", partitions), ("advisoryPartitionSizeInBytes", joined)):
        if not spark.conf.get(f"spark.sql.adaptive.{name}", None):
            spark.conf.set(f"spark.sql.adaptive.{name}", str(value))
