"""Tables of a data folder, and copies of them with known defects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.specs import ForeignKey, Key, Table

ORDERS = Table(
    "orders",
    keys=(Key("pk_orders", ("o_orderkey",)),),
    foreign_keys=(ForeignKey("fk_customer", "orders", ("o_custkey",), "customer", ("c_custkey",)),),
    scales={"o_totalprice": 2},
)
CUSTOMER = Table("customer", keys=(Key("pk_customer", ("c_custkey",)),), scales={"c_acctbal": 2})


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def altered_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a faulty copy: some rows lost, some prices off by one, some rows twice."""
    key = F.col("o_orderkey")
    copies = F.when(key % 101 == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        read(spark, folder, "orders")
        .where(key % 97 != 5)
        .withColumn(
            "o_totalprice", F.when(key % 89 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
        )
        .withColumn("_copy", F.explode(copies))
        .drop("_copy")
    )


def broken_order_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with some customer keys null and some unknown."""
    key = F.col("o_orderkey")
    broken = (
        F.when(key % 127 == 0, None)
        .when(key % 113 == 0, F.col("o_custkey") + 1_000_000)
        .otherwise(F.col("o_custkey"))
    )
    return read(spark, folder, "orders").withColumn("o_custkey", broken)


def broken_line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with part of their composite key null or unknown."""
    part = F.col("l_partkey")
    broken = (
        F.when(part % 50 == 0, None)
        .when(part % 77 == 0, F.col("l_linenumber") + 100)
        .otherwise(F.col("l_linenumber"))
    )
    return read(spark, folder, "lineitem").withColumn("l_linenumber", broken)
