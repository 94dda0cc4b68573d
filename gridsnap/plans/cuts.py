"""Lineage cuts that survive the loss of an executor, and the shared folder they and other passing files live in."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; unset, a folder of this machine if all of Spark runs on it, else an error."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if where:
        return where.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return os.path.join(tempfile.gettempdir(), "gridsnap-checkpoints")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(jpath)
    files.deleteOnExit(jpath)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and return it read from the shared checkpoint folder.

    A checkpoint folder that is set already stays; else it is the shared folder.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
