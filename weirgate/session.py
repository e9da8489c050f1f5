"""Session helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def share_code(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    A cluster whose nodes lack that path gets the package by ``--py-files``."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Where unset, a temporary one
    is set for a master that is this machine alone; a cluster needs the setting."""
    at = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes see")
        at = "file://" + tempfile.mkdtemp(prefix="weirgate-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    """The name of a new folder below the shared one."""
    return f"{shared_dir(spark)}/weirgate/{tag}-{uuid.uuid4().hex}"


def durable(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends
    there, so a lost executor costs no more than a reread."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._weirgate_folder = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the folder of a durable table that nothing reads any more."""
    if at := getattr(df, "_weirgate_folder", None):
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
