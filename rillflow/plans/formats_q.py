"""Queries over files that Spark writes from the given tables and reads back: binary formats, drifting types, versions."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from rillflow.session import ship_package, work_dir
from rillflow.sources import drift, features, fixed_width, versions
from rillflow.sources.tables import table


def fixed_width_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns of customers from .dta files, their required ones checked from the header."""
    path = f"{work_dir(spark)}/customer-{uuid.uuid4().hex}"
    fixed_width.register(spark)
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_acctbal", "c_mktsegment").write.format("fixed_width").mode("append").save(path)
    found = fixed_width.scan(spark, path, columns=["c_mktsegment", "no_such_column"], required=["c_custkey", "c_nationkey"])
    return found.select(F.col("c_custkey").cast("long").alias("c_custkey"), F.col("c_nationkey").cast("long").alias("c_nationkey"), "c_mktsegment")


def feature_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' squares with holes from GeoPackage files, those of one segment, picked in the files by a prefix of the key."""
    path = f"{work_dir(spark)}/features-{uuid.uuid4().hex}"
    os.makedirs(features.local(path), exist_ok=True)
    ship_package(spark)

    def written(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        def rows():
            for frame in frames:
                for key, n, x in zip(frame["key"].tolist(), frame["n"].tolist(), frame["x"].tolist(), strict=True):
                    ring = lambda lo, hi, x=x: [[x + lo, lo], [x + hi, lo], [x + hi, hi], [x + lo, hi], [x + lo, lo]]
                    yield key, n, [[ring(0.0, 8.0), ring(3.0, 6.0)]] if n % 3 else [[ring(0.0, 2.0)], [ring(4.0, 5.0)]]

        name = f"part-{TaskContext.get().partitionId():05d}.gpkg"
        features.write_file(f"{path}/{name}", "squares", [("key", "TEXT"), ("n", "INTEGER")], rows())
        yield pd.DataFrame({"name": [name]})

    c = table(spark, sf_dir, "customer").select(F.concat_ws("-", "c_mktsegment", "c_custkey").alias("key"), F.col("c_custkey").alias("n"), (F.col("c_custkey") % 100).cast("double").alias("x"))
    c.mapInPandas(written, "name string").write.format("noop").mode("overwrite").save()
    found = features.scan(spark, path, layer="squares", where="key LIKE 'BUILDING-%'")
    sides = F.transform("geometry", lambda polygon: F.struct(F.size(polygon).alias("rings"), F.array_min(F.transform(polygon[0], lambda p: p[0])).alias("west"), F.array_max(F.transform(polygon[0], lambda p: p[0])).alias("east")))
    first = F.get(sides, F.lit(0))
    return found.select(F.col("n").alias("c_custkey"), F.size("geometry").alias("polygons"), first["rings"].alias("rings"), first["west"].alias("west"), F.array_max(F.transform(sides, lambda s: s["east"])).alias("east"))


def drifting_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in files whose key, total and status are of other types in each, scanned as one table."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.floor("o_totalprice").alias("total"), F.col("o_orderstatus").alias("status"))
    path, part = f"{work_dir(spark)}/drift-{uuid.uuid4().hex}", F.pmod("k", F.lit(4))
    o.where(part == 0).select(F.col("k").cast("int").alias("k"), F.col("total").cast("int").alias("total")).write.parquet(f"{path}/a")
    o.where(part == 1).select("status", F.col("total").cast("decimal(12,2)").alias("total"), "k").write.parquet(f"{path}/b")
    o.where(part == 2).select("k", F.col("total").cast("long").alias("total"), (F.col("status") == "F").alias("done")).write.parquet(f"{path}/c")
    o.where(part == 3).select("k", F.col("total").cast("long").alias("total"), F.lit(None).cast("string").alias("status")).write.parquet(f"{path}/d")
    found = drift.scan(spark, f"{path}/*")
    return found.select("k", F.col("total").cast("double").alias("total"), "status", "done")


def versioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published with two of their parts as one version, then rows of a second load in place of those with their keys."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    store = versions.VersionedTables(spark, f"{work_dir(spark)}/store-{uuid.uuid4().hex}")
    store.publish(o.where("o_orderkey % 3 <> 0"), {"orders": None, "open": "o_orderstatus = 'O'"})
    store.upsert("orders", o.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("X")), ["o_orderkey"])
    return store.read("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit("orders").alias("part")).unionByName(store.read("open").withColumn("part", F.lit("open")))


QUERIES = {f.__name__: f for f in (fixed_width_scan, feature_scan, drifting_types, versioned_upsert)}
ORACLES = {
    "drifting_types": "SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS DOUBLE) AS total, CASE WHEN o_orderkey % 4 = 1 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 4 = 2 THEN o_orderstatus = 'F' END AS done FROM orders",
    "versioned_upsert": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, 'orders' AS part FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 'open' FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderstatus = 'O'",
    "fixed_width_scan": "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer",
    "feature_scan": """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS polygons, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END AS rings, CAST(c_custkey % 100 AS DOUBLE) AS west,
 CAST(c_custkey % 100 + CASE WHEN c_custkey % 3 = 0 THEN 5 ELSE 8 END AS DOUBLE) AS east FROM customer WHERE c_mktsegment = 'BUILDING'""",
}
