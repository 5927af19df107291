"""Raw record sources and the mapping from a star schema to raw sales records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.functions.text import normalise_headers

RAW_SCHEMA = T.StructType(
    [
        T.StructField("state", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("sales", T.DoubleType()),
    ]
)


def load_raw(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Read raw records and normalise their headers (``total`` becomes ``sales``).

    Nothing is inferred by scanning: a CSV is read as text from its header line and
    only the target is cast, or an explicit ``schema`` is applied.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":  # columns go by the header's names, not by position
        df = reader.option("header", True).option("enforceSchema", False).csv(path)
    else:
        df = reader.format(fmt).load(path)
    df = normalise_headers(df, {"total": "sales"} if rename is None else rename)
    if "sales" in df.columns:
        df = df.withColumn("sales", F.col("sales").cast("double"))
    return df


class StarSchema:
    """Sales records out of lineitem, orders, customer and nation.

    lineitem is reduced to one exact (decimal) total per order before any join, so the
    join on the order key moves one row per order and reuses the aggregate's shuffle.
    Customers get their state before they meet the orders, so the large side is joined
    once. No side carries a broadcast hint: a small one is broadcast by its measured
    size, otherwise the join shuffles and adaptive execution splits the partition of a
    customer that holds a large share of all orders.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def orders(self, *extra: str) -> DataFrame:
        """One row per order: order_id, state, date, total (decimal), extra customer columns."""
        totals = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total"))
        )
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            "o_custkey",
            F.col("o_orderdate").cast("date").alias("date"),
        )
        nation = self.table("nation").select("n_nationkey", F.col("n_name").alias("state"))
        customer = (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "state", *extra)
        )
        return (
            totals.join(orders, "order_id")
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select("order_id", "state", "date", "total", *extra)
        )

    def daily_sales(self, *extra: str) -> DataFrame:
        """One record per (state, [extra keys,] day): the sum of the day's orders."""
        return (
            self.orders(*extra)
            .groupBy("state", *extra, "date")
            .agg(F.sum("total").cast("double").alias("sales"))
        )

    def order_records(self) -> DataFrame:
        """Messy raw records: text dates in two layouts, repeats, a constant column.

        ``seq`` stands for file order, which a distributed table does not have.
        """
        iso = F.date_format("date", "yyyy-MM-dd")
        day_first = F.date_format("date", "dd-MM-yyyy")
        return self.orders().select(
            "state",
            F.when(F.col("order_id") % 2 == 0, iso).otherwise(day_first).alias("date"),
            F.lit("Goods").alias("category"),
            F.col("total").cast("double").alias("sales"),
            F.col("order_id").alias("seq"),
        )
