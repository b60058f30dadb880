"""Cutting a plan's lineage, and ordering rows in blocks, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a temporary folder is set if all runs in one process; on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="factloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the application's scratch folder, which goes when the application ends."""
    root = f"{shared_dir(spark)}/factloom-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in spark.checkpoint.dir."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def in_blocks(df: DataFrame, *keys) -> DataFrame:
    """``df`` with a column _block, the number of the range partition of its rows in the order of the keys.

    Windows by a key and its blocks, with a row a block carried over, take the place of a window by the
    key alone: a key that holds most of the rows is then the work of many tasks.
    """
    return cut(df.repartitionByRange(*keys).withColumn("_block", F.spark_partition_id()))
