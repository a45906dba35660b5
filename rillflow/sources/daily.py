"""Reading and writing of daily files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any file system that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at))


def scan(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Parquet files by column name against one explicit schema: columns that older files lack are null. Without files an
    empty frame of that schema."""
    empty = spark.createDataFrame([], schema)
    if not exists(spark, path):
        return empty
    return spark.read.schema(empty.schema).parquet(path)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows; columns by name, missing ones null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_csv(spark: SparkSession, path: str, schema: str, need: Sequence[str] = ()) -> DataFrame | None:
    """A CSV with a header, columns by name; None if one of the needed columns isn't in the header."""
    found = spark.read.option("header", True).csv(path)
    if set(need) - set(found.columns):
        return None
    wanted = spark.createDataFrame([], schema).schema
    return found.select(*((F.col(f.name).try_cast(f.dataType) if f.name in found.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted))


def newest(rows: DataFrame, date: str = "report_date") -> DataFrame:
    """The newest date, from partition values where the table is partitioned by it."""
    return rows.agg(F.max(date).alias(date))


def write_days(rows: DataFrame, path: str, partition: str = "report_date") -> None:
    """Replaces the days that the rows have and no other: running it again changes nothing."""
    rows.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def write_csv(rows: DataFrame, path: str, dry_run: bool = False) -> bool:
    """One CSV file with a header, for reports; nothing in a dry run."""
    if dry_run:
        return False
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return True


def publish(rows: DataFrame, views: dict[str, str | None]) -> None:
    """Temp views from one frame: name -> predicate, None for all rows."""
    for name, predicate in views.items():
        (rows.where(predicate) if predicate else rows).createOrReplaceTempView(name)


def dates_held(spark: SparkSession, path: str, partition: str = "report_date") -> DataFrame:
    """The dates that a folder written by write_days() holds, from the names of its folders: no file is opened."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []
    days = sorted(n.partition("=")[2] for n in names if n.startswith(f"{partition}="))
    return spark.createDataFrame([(d,) for d in days], f"{partition} string").select(F.col(partition).cast("date").alias(partition))


def publish_tables(rows: DataFrame, path: str, parts: dict[str, str | None]) -> None:
    """Tables from one frame below a folder, each replaced whole: name -> predicate, None for all rows."""
    for name, predicate in parts.items():
        (rows.where(predicate) if predicate else rows).write.mode("overwrite").parquet(f"{path}/{name}")
