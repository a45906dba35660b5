"""Queries on streams with state of their own."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillflow.operators import integrity
from rillflow.session import work_dir
from rillflow.sources.tables import table
from rillflow.streaming import readings


def _readings(events: DataFrame) -> DataFrame:
    return events.where("ts is not null").select("user_id", F.to_date("ts").alias("day"), "value", F.floor("value").cast("double").alias("own"))


def stream_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as daily readings of each user, judged on a stream: whether one falls below the last, or its rise isn't its own figure."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir.rstrip('/')}/events*.parquet")
    return readings.run_gate(_readings(stream), f"{work_dir(spark)}/readings-{uuid.uuid4().hex}", ["user_id"], "day", "value", "own", late="40 days", keep=60)


def batch_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same verdicts from one pass over all events."""
    return integrity.judged_readings(_readings(table(spark, sf_dir, "events")), ["user_id"], "day", "value", "own")


QUERIES = {f.__name__: f for f in (stream_readings, batch_readings)}
_JUDGED = """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, min(value) AS value FROM events WHERE ts IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2),
 p AS (SELECT *, lag(value) OVER w AS before, day - lag(day) OVER w AS gap FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day)),
 r AS (SELECT *, CASE WHEN gap = 1 THEN abs((value - before) - floor(value)) END AS residual FROM p)
 SELECT user_id, day, value, value < before - CAST(0.001 AS DOUBLE) AS fell, residual, residual > CAST(1.001 AS DOUBLE) AS broken FROM r"""
ORACLES = {"stream_readings": _JUDGED, "batch_readings": _JUDGED}
