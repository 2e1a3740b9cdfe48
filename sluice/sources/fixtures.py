"""Fixture bronze built from the driver's TPC-H-style tables.

The reference feeds its pipeline from a wide, dirty "bronze" sales table.  Here
the same shape is derived from ``lineitem ⋈ orders ⋈ customer ⋈ part`` with
planted defects (null keys, an out-of-list address, out-of-range dates and
non-positive quantities), so every rule really fails for some rows and the work
grows with the tables.  The exact derivation is pinned in FIXTURES.md §3 and the
oracle SQL repeats it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .tables import read_table

# Silver projections of the fixture bronze (target -> columns, keys, order).
SALES_COLUMNS = ["date", "sales_id", "client_id", "product_id", "quantity", "sale_amount"]
CLIENT_COLUMNS = ["client_id", "address", "signup_date"]
PRODUCT_COLUMNS = ["product_id", "product_name", "category", "price"]

# Latest-row order used for batch dedupe; (date, sale_amount, l_suppkey) is a total
# order within one sales_id on the driver tables.
SALES_ORDER = ["date", "sale_amount", "l_suppkey"]


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty bronze table: one row per lineitem (duplicates of ``sales_id`` included)."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_extendedprice", "l_shipdate"])
    # a date and an int are narrower in the shuffles than the timestamp and the double they come from
    li = li.withColumn("l_shipdate", F.col("l_shipdate").cast("date")).withColumn("l_quantity", F.col("l_quantity").cast("int"))
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    od = od.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    cu = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    pa = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_retailprice"])

    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    # the orders meet their customers first: the line items, many times as many, are shuffled for two joins, not three
    buyers = od.join(cu, od.o_custkey == cu.c_custkey)
    joined = (li.join(buyers, li.l_orderkey == od.o_orderkey)
                .join(pa, li.l_partkey == pa.p_partkey))
    return joined.select(
        (ok * 10 + F.col("l_linenumber")).alias("sales_id"),
        _null_when((ok * 7 + pk) % 10 < 3, F.col("o_custkey")).alias("client_id"),
        _null_when((ok + pk * 3) % 10 < 2, pk).alias("product_id"),
        _null_when(pk % 50 == 0, F.col("c_mktsegment")).alias("address"),
        _null_when((ok + pk) % 10 < 4, F.col("o_orderdate")).alias("signup_date"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("l_shipdate").alias("date"),
        (F.col("l_quantity") - 2).alias("quantity"),
        F.col("l_extendedprice").alias("sale_amount"),
        F.col("l_suppkey"),
        F.col("l_linenumber"),
    )


def stored_bronze(spark: SparkSession, sf_dir: str, columns: Sequence[str] = ("*",)) -> DataFrame:
    """The bronze, or those of its columns that a plan reads, as a stored table, for plans that read it more than once."""
    path = scratch_path(spark, "bronze")
    bronze(spark, sf_dir).select(*columns).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def declared(keys: list[str]) -> T.StructType:
    """The declared schema of a silver's keys: none of them may be null."""
    return T.StructType([T.StructField(k, T.LongType(), nullable=False) for k in keys])
