"""Named parquet tables below one folder, by any path that Spark's readers open."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; the scan stays lazy, so filters and column choice reach parquet."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
