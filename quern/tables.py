"""The input tables and the few derived dimensions that many queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy readers for one data directory: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def geography(self) -> DataFrame:
        """nation key -> nation name and region name; both tables are a few rows."""
        return self.nation.join(
            self.region, F.col("n_regionkey") == F.col("r_regionkey")
        ).select("n_nationkey", "n_name", "r_name")

    def customer_geo(self) -> DataFrame:
        return self.customer.join(
            self.geography(), F.col("c_nationkey") == F.col("n_nationkey")
        ).select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name")

    def order_revenue(self) -> DataFrame:
        """One row per order key: revenue and number of lines."""
        return self.lineitem.groupBy("l_orderkey").agg(
            F.sum(revenue()).alias("revenue"), F.count(F.lit(1)).alias("lines")
        )


def revenue() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def cents(column: str) -> Column:
    """Money held as a double, as whole cents: sums stay exact in any order."""
    return F.round(F.col(column) * 100).cast("bigint")


def day(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM-dd")


def month(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM")


def micros(column: str) -> Column:
    """Time of day zone-free timestamps as microseconds, for integer arithmetic."""
    return F.unix_micros(F.col(column).cast("timestamp"))
