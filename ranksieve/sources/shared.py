"""Tables in the folder that driver and executors share, which cut lineage and are computed once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset a temporary folder in local mode, and an error elsewhere, as executors would not see it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    found = getattr(context, "_ranksieve_tables", None)
    if not found:
        found = context._ranksieve_tables = "file://" + tempfile.mkdtemp(prefix="ranksieve-")
        file_system(spark, found).deleteOnExit(path_of(spark, found))
    return found


def path_of(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return path_of(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(path_of(spark, path))


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written to the shared folder and read back; it goes when the application ends."""
    spark = df.sparkSession
    path = f"{folder(spark)}/ranksieve/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    file_system(spark, path).deleteOnExit(path_of(spark, path))
    return spark.read.schema(df.schema).parquet(path)
