"""Adapters from the star-schema test tables to the transaction shape.

The library works on any transaction table described by a
:class:`~orderlens.config.TransactionSchema`.  The driver's test tables carry
no such table, so this module *derives* one from them with plain joins:
one row per order, with customer, nation and region attributes and
per-order line totals.  Its size grows with ``orders`` and ``lineitem``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.config import RollupSpec, TransactionSchema

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table by name."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order line totals; partial aggregation runs before the shuffle."""
    return (table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(F.sum("l_quantity").alias("line_qty"),
                 F.count(F.lit(1)).alias("n_lines")))


def transactions(spark: SparkSession, sf_dir: str, *, with_lines: bool = True) -> DataFrame:
    """orders ⋈ customer ⋈ nation ⋈ region (⋈ per-order line totals).

    Joins are declared plainly; Catalyst broadcasts nation/region by their
    file statistics (autoBroadcastJoinThreshold is the size check) and
    shuffles the order/customer and order/line joins on their keys.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    df = (orders
          .join(customer, orders.o_custkey == customer.c_custkey, "left")
          .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
          .join(region, F.col("n_regionkey") == region.r_regionkey, "left"))
    if with_lines:
        lines = order_lines(spark, sf_dir)
        df = df.join(lines, df.o_orderkey == lines.l_orderkey, "left")
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
            "o_orderpriority", "c_nationkey", "c_mktsegment", "c_acctbal", "n_name", "r_name"]
    if with_lines:
        cols += ["line_qty", "n_lines"]
    return df.select(*cols)


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-level facts: orders ⋈ per-order line totals (1:1 on the order key)."""
    orders = table(spark, sf_dir, "orders")
    lines = order_lines(spark, sf_dir)
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey")


def customer_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer-level attributes, one row per customer key (named o_custkey)."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment", "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (customer.join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
            .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
            .select("o_custkey", "c_nationkey", "c_mktsegment", "c_acctbal", "n_name", "r_name"))


# Column roles of the derived transaction table.
TPCH_SCHEMA = TransactionSchema(key="o_custkey", date="o_orderdate", label="o_orderstatus",
                                tiebreak="o_orderkey")

# Roll-up spec over the derived table: first / sum / max / last, as in the
# customer roll-up of the reference (descriptive attributes first, money and
# volume summed, last order date, last channel/label).
TPCH_ROLLUP = RollupSpec({
    "n_name": "first",
    "r_name": "first",
    "c_mktsegment": "first",
    "c_nationkey": "first",
    "o_orderpriority": "first",
    "priority_num": "first",
    "o_totalprice": "sum",
    "line_qty": "sum",
    "n_lines": "sum",
    "o_orderdate": "max",
    "o_orderstatus": "last",
})
