"""Queries: what is written and read again, as days, CSV and JSON, in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillflow.operators import model
from rillflow.plans.facts import FACT, fact
from rillflow.session import work_dir
from rillflow.sources import daily, layouts
from rillflow.sources.tables import table


def _folder(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/rillflow/{name}-{uuid.uuid4().hex}"


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir).groupBy(F.col("d").alias("report_date"), "region").agg(F.count(F.lit(1)).alias("n")).where("report_date >= DATE '2001-07-01' and report_date <= DATE '2001-07-20'")


def rewritten_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days written, two of them written again twice over with other figures, read back with a column that the files lack."""
    path, rows = _folder(spark, "days"), _days(spark, sf_dir)
    daily.write_days(rows, path)
    again = rows.where("report_date in (DATE '2001-07-03', DATE '2001-07-04')").withColumn("n", F.col("n") + 1000)
    for _ in range(2):
        daily.write_days(again, path)
    return daily.scan(spark, path, "region string, n long, report_date date, later string")


def listed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates that a folder of days holds, from its listing alone, and whether each is the newest."""
    path = _folder(spark, "days")
    daily.write_days(_days(spark, sf_dir), path)
    return daily.dates_held(spark, path).withColumn("newest", F.col("report_date") == F.max("report_date").over(_every()))


def _every():
    from pyspark.sql import Window as W

    return W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)


def optional_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days left-joined with rain files that are not there: a typed empty table stands for them."""
    rain = daily.scan(spark, _folder(spark, "none"), "report_date date, rain double")
    return _days(spark, sf_dir).join(rain, "report_date", "left").select("report_date", "region", "n", "rain")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger through CSV: dates stay text, figures that don't read as such are null, a dry run writes nothing, and a file
    without a needed column is refused."""
    path, dry = _folder(spark, "csv"), _folder(spark, "dry")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.format_string("2001-07-%02d", (F.col("c_custkey") % 28 + 1).cast("int")).alias("day"), F.when(F.col("c_custkey") % 6 == 0, "n/a").otherwise(F.col("c_nationkey").cast("string")).alias("figure"))
    daily.write_csv(c, path)
    wrote = daily.write_csv(c, dry, dry_run=True)
    back = daily.read_csv(spark, path, "id long, day string, figure int, absent double", ["id", "day"])
    refused = daily.read_csv(spark, path, "id long", ["status"]) is None
    return back.withColumn("refused", F.lit(refused and not wrote and not daily.exists(spark, dry)))


def sql_copy_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a query copied to CSV and read back."""
    path = _folder(spark, "copy")
    daily.publish(table(spark, sf_dir, "nation"), {"rillflow_nation": None, "rillflow_nation_some": "n_regionkey in (1, 2)"})
    daily.write_csv(spark.sql("SELECT n_regionkey, count(*) AS n FROM rillflow_nation_some GROUP BY n_regionkey"), path)
    return daily.read_csv(spark, path, "n_regionkey int, n long")


def published_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table published as a base, a subset and a pilot, stored as tables and replaced when it comes again."""
    path, n = _folder(spark, "publish"), table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    parts = {"base": None, "subset": "n_regionkey < 3", "pilot": "n_nationkey = 7"}
    daily.publish_tables(n.where("n_nationkey < 3"), path, parts)
    daily.publish_tables(n, path, parts)
    out = None
    for name in parts:
        one = spark.read.parquet(f"{path}/{name}").withColumn("part", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.select("part", "n_nationkey")


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A serving document written as JSON and read back as a table."""
    path = _folder(spark, "json")
    n = table(spark, sf_dir, "nation").select(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.struct(F.col("n_regionkey").alias("region")).alias("at")).alias("s"))
    n.agg(F.array_sort(F.collect_list("s")).alias("nations")).write.json(path)
    return layouts.json_rows(spark, path, "nations").select(F.col("key").cast("long").alias("key"), "name", F.col("at.region").cast("long").alias("region"))


def semi_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose nation has a supplier, and sets that agree on both sides."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return c.join(table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey")).distinct(), "c_nationkey", "left_semi")


def replaced_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger kept as a file: merged with later rows, which win, sorted, and written anew."""
    first, second = _folder(spark, "ledger"), _folder(spark, "ledger")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("status"))
    rows.where("id % 2 = 0").write.parquet(first)
    later = rows.where("id % 3 = 0").withColumn("status", F.lit("later"))
    model.merge_ledger([spark.read.parquet(first), later], "id").orderBy("id").write.parquet(second)
    return spark.read.parquet(second)


QUERIES = {f.__name__: f for f in (rewritten_days, listed_dates, optional_input, csv_roundtrip, sql_copy_csv, published_views, json_roundtrip, semi_joined, replaced_ledger)}
_DAYS = f"{FACT}, r AS (SELECT d AS report_date, region, count(*) AS n FROM fact WHERE d BETWEEN DATE '2001-07-01' AND DATE '2001-07-20' GROUP BY 1, 2)"
ORACLES = {
    "rewritten_days": f"WITH {_DAYS} SELECT region, n + CASE WHEN report_date IN (DATE '2001-07-03', DATE '2001-07-04') THEN 1000 ELSE 0 END AS n, report_date, CAST(NULL AS VARCHAR) AS later FROM r",
    "listed_dates": f"WITH {_DAYS} SELECT DISTINCT report_date, report_date = (SELECT max(report_date) FROM r) AS newest FROM r",
    "optional_input": f"WITH {_DAYS} SELECT report_date, region, n, CAST(NULL AS DOUBLE) AS rain FROM r",
    "csv_roundtrip": "SELECT c_custkey AS id, '2001-07-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS day, CASE WHEN c_custkey % 6 <> 0 THEN c_nationkey END AS figure, CAST(NULL AS DOUBLE) AS absent, TRUE AS refused FROM customer",
    "sql_copy_csv": "SELECT n_regionkey, count(*) AS n FROM nation WHERE n_regionkey IN (1, 2) GROUP BY 1",
    "published_views": "SELECT 'base' AS part, n_nationkey FROM nation UNION ALL SELECT 'subset', n_nationkey FROM nation WHERE n_regionkey < 3 UNION ALL SELECT 'pilot', n_nationkey FROM nation WHERE n_nationkey = 7",
    "json_roundtrip": "SELECT CAST(n_nationkey AS BIGINT) AS key, n_name AS name, CAST(n_regionkey AS BIGINT) AS region FROM nation",
    "semi_joined": "SELECT c_nationkey, c_custkey FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)",
    "replaced_ledger": "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'later' ELSE c_mktsegment END AS status FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0",
}
