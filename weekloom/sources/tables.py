"""Stored tables: splits, metric files, per-key outputs and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions.text import lookup_key, slug

# Folders that keys share, whatever their number.
KEY_BUCKETS = 512


def save_splits(labelled: DataFrame, path: str) -> None:
    """One dataset, one folder per split: a reader of one split lists only its files."""
    labelled.write.mode("overwrite").partitionBy("split").parquet(path)


def load_splits(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    table = spark.read.parquet(path)
    return {
        name: table.filter(F.col("split") == name).drop("split")
        for name in ("train", "val", "test")
    }


def save_report(df: DataFrame, path: str) -> None:
    """A report table as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def save_metrics(metrics: DataFrame, folder: str, family: str) -> None:
    metrics.write.mode("overwrite").parquet(f"{folder}/{family}")


def load_all_metrics(spark: SparkSession, folder: str, families: Sequence[str]) -> DataFrame:
    """The union of the families' stored metrics; absent families are skipped."""
    found = []
    for family in families:
        try:
            found.append(spark.read.parquet(f"{folder}/{family}"))
        except AnalysisException as failure:
            if "PATH_NOT_FOUND" not in str(failure.getCondition()):
                raise
    if not found:
        raise FileNotFoundError(f"No model metrics in {folder}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def _bucket(folded: Column) -> Column:
    return F.pmod(F.xxhash64(folded), F.lit(KEY_BUCKETS)).cast("int")


def save_by_key(df: DataFrame, path: str, key: str = "state") -> str:
    """Store a table so that one key can be read without reading the others.

    Keys share ``KEY_BUCKETS`` hash folders and are sorted within them, where Parquet
    statistics find them; the layout is the same for ten keys and for ten million.
    Returns the partition column.
    """
    keyed = df.withColumns({f"{key}_slug": slug(F.col(key)), f"{key}_folded": lookup_key(F.col(key))})
    spread = F.pmod(F.xxhash64(f"{key}_folded", F.lit(1)), F.lit(8))
    (
        keyed.withColumn("key_bucket", _bucket(F.col(f"{key}_folded")))
        .repartition("key_bucket", spread)
        .sortWithinPartitions("key_bucket", f"{key}_folded")
        .write.mode("overwrite")
        .partitionBy("key_bucket")
        .parquet(path)
    )
    return "key_bucket"


def load_key(spark: SparkSession, path: str, value: str, key: str = "state") -> DataFrame:
    """The rows of one key from ``save_by_key``, pruned to its folder.

    Keys are told apart by their folded text, so two that share a slug stay apart.
    """
    wanted = lookup_key(F.lit(value))
    table = spark.read.parquet(path).filter(F.col("key_bucket") == _bucket(wanted))
    return table.filter(F.col(f"{key}_folded") == wanted)


def save_selection_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """The reports of a model selection, each as CSV under its name."""
    for name, table in tables.items():
        save_report(table, f"{folder}/{name}")
