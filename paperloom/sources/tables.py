"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share; a temporary one only where all is one machine and no folder is named."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{(root or tempfile.mkdtemp(prefix='paperloom-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def delete(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: write it in the shared folder and read it again. The files outlive lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of ``written`` tables that nothing reads any more."""
    for table in tables:
        delete(table.sparkSession, table.written_to)
