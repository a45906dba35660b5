"""Domain-neutral facts on the driver's tables, in Spark and as SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillflow.sources.tables import table

#: The day that is compared with prior years.
TARGET = "2001-07-31"

FACT = """fact AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, o.o_orderstatus, CAST(o.o_orderdate AS DATE) AS d, CAST(EXTRACT(year FROM o.o_orderdate) AS INT) AS season,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount, n.n_name AS nation, r.r_name AS region
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey)"""
TO_DATE = "(EXTRACT(month FROM d) = 6 OR EXTRACT(month FROM d) = 7)"


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations of nations and regions."""
    orders, customer, nation, region = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    places = customer.select("c_custkey", "c_nationkey").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    return orders.join(places, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", F.to_date("o_orderdate").alias("d"), F.year("o_orderdate").alias("season"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), "nation", "region"
    )
