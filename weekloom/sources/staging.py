"""Staged tables: lineage cuts and single-computation points in shared storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``, or its checkpoint folder.

    The library never picks a folder itself: one on a single machine would be lost with
    its executor, so a missing setting is an error under every master.
    """
    named = spark.sparkContext.getConf().get(SETTING, None) or spark.conf.get(SETTING, None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    raise RuntimeError(f"{SETTING} must name a folder that all executors share")


def staged_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/weekloom-{spark.sparkContext.applicationId}"


def staged_path(spark: SparkSession, label: str) -> str:
    return f"{staged_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: survives lost executors, keeps pruning and pushdown.

    Used where a result has several consumers or where lineage must be cut. The
    table that comes back has known size, which lets AQE choose its joins.
    """
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> bool:
    """Delete every table this application has staged; results read from them go too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(staged_root(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(path, True)
