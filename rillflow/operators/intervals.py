"""Values joined with the intervals that hold them, edges as rows: every group with edges of its own, of any number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def between_edges(edges: DataFrame, group: Sequence[str], edge: str) -> DataFrame:
    """(group, index, low, high): the half-open intervals between a group's distinct edges, in order, from 0."""
    w = W.partitionBy(*group).orderBy("low")
    each = edges.where(F.col(edge).isNotNull()).select(*group, F.col(edge).cast("double").alias("low")).distinct()
    return each.select(*group, (F.row_number().over(w) - 1).alias("index"), "low", F.lead("low").over(w).alias("high")).where("high is not null")


def bin_width(intervals: DataFrame) -> float:
    """A width that gives an interval about one bin: the mean length; 1 without intervals."""
    mean = intervals.agg(F.avg(F.col("high") - F.col("low")).alias("w")).first()["w"]
    return float(mean) if mean else 1.0


def interval_join(rows: DataFrame, value: Column, intervals: DataFrame, group: Sequence[str], index: str, width: float | None = None) -> DataFrame:
    """rows with `index`, the interval of their group that holds the value (low <= value < high); rows in none are left out, a
    row in several comes once for each.

    Intervals are dealt to the bins of `width` that they touch, a value lies in one bin: a join by group and bin, not of all
    edges with all values. Nulls and not-a-number lie nowhere.
    """
    width = width or bin_width(intervals)
    binned = intervals.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor(F.col("high") / width))))
    names = [F.col(g).alias(f"__g{k}") for k, g in enumerate(group)]
    table = binned.select(*names, "__bin", F.col("low").alias("__low"), F.col("high").alias("__high"), F.col("index").alias(index))
    placed = rows.withColumn("__value", value.cast("double")).where(F.col("__value").isNotNull() & ~F.isnan("__value")).withColumn("__at", F.floor(F.col("__value") / width))
    on = (F.col("__at") == F.col("__bin")) & (F.col("__low") <= F.col("__value")) & (F.col("__value") < F.col("__high"))
    for k, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"__g{k}"))
    return placed.join(table, on).select(*rows.columns, index)
