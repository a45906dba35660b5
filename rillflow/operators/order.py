"""Places in order within groups of any size: ranks, quantiles, medians, exact, without a group in one task.

The distinct values of all groups are counted, so that a value that very many rows share is one row, and sorted by range: a
task has a run of the order, whichever groups it spans. Counts of runs by group give where each run starts in its group, and a
value's place is that plus its place in the run. Order statistics and ranks are then look-ups by place.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rillflow.session import written

#: Values of a run, about, and tasks that share the rows of one value.
RUN, SALTS = 1 << 20, 8


def positions(rows: DataFrame, group: Sequence[str], value: str, run: int | None = None) -> DataFrame:
    """(group, value, n, before, total): each distinct value of each group, how many rows have it, how many have a lesser one,
    and how many the group has. Null values have no place; null groups are a group. Not-a-number is above all numbers."""
    run = run or RUN
    counted = written(rows.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n")), "order-counts")
    parts = max(1, -(-2 * counted.count() // run))
    # in a plan of its own: the partition's number is that of the sorted run
    runs = counted.repartitionByRange(parts, *group, value).sortWithinPartitions(*group, value).withColumn("__run", F.spark_partition_id())
    runs = written(runs, "order-runs")
    of_group = W.partitionBy(*group)
    sums = runs.groupBy("__run", *group).agg(F.sum("n").alias("__n"))
    starts = sums.select(
        F.col("__run").alias("__of"), *(F.col(g).alias(f"__g{k}") for k, g in enumerate(group)),
        F.coalesce(F.sum("__n").over(of_group.orderBy("__run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__start"), F.sum("__n").over(of_group).alias("total"),
    )
    inside = F.coalesce(F.sum("n").over(W.partitionBy("__run", *group).orderBy(value).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    on = F.col("__run") == F.col("__of")
    for k, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"__g{k}"))
    return runs.withColumn("__inside", inside).join(starts, on).select(*group, value, "n", (F.col("__start") + F.col("__inside")).alias("before"), "total")


def percent_ranks(rows: DataFrame, group: Sequence[str], value: str, rank: str, key: str, run: int | None = None) -> DataFrame:
    """rows with `rank`: the place among the group's non-null values as a share, ties sharing their mean place; null for null.

    key tells rows apart: by it the rows of one value are dealt to SALTS tasks.
    """
    place = positions(rows, group, value, run)
    share = (F.col("before") + (F.col("n") + 1) / 2.0) / F.col("total")
    table = place.select(*(F.col(g).alias(f"__g{k}") for k, g in enumerate(group)), F.col(value).alias("__value"), share.alias("__rank"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__turn"))
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    on = (F.col(value) == F.col("__value")) & (F.col("__salt") == F.col("__turn"))
    for k, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"__g{k}"))
    return dealt.join(table, on, "left").select(*rows.columns, F.col("__rank").alias(rank))


def at_place(place: Column, value: str) -> Column:
    """Aggregate over positions(): the value at a place of its group, counted from 0."""
    return F.max(F.when((F.col("before") <= place) & (place < F.col("before") + F.col("n")), F.col(value)))


def quantiles(rows: DataFrame, group: Sequence[str], value: str, shares: Mapping[str, float], run: int | None = None) -> DataFrame:
    """One row per group with values: the quantile of each share, by name, between the two values at its place in proportion."""
    place = positions(rows, group, value, run)
    aggregates = []
    for k, share in enumerate(shares.values()):
        at = (F.col("total") - 1) * F.lit(float(share))
        aggregates += [at_place(F.floor(at), value).alias(f"__low{k}"), at_place(F.ceil(at), value).alias(f"__high{k}"), F.max(at - F.floor(at)).alias(f"__part{k}")]
    found = place.groupBy(*group).agg(*aggregates)
    between = lambda k: F.col(f"__low{k}").cast("double") * (1 - F.col(f"__part{k}")) + F.col(f"__high{k}").cast("double") * F.col(f"__part{k}")
    exact = lambda k: F.when(F.col(f"__part{k}") == 0, F.col(f"__low{k}").cast("double")).otherwise(between(k))
    return found.select(*group, *(exact(k).alias(name) for k, name in enumerate(shares)))


def upper_medians(rows: DataFrame, group: Sequence[str], value: str, median: str, run: int | None = None) -> DataFrame:
    """(group, median, n): the middle value, the upper of two, and how many values the group has."""
    place = positions(rows, group, value, run)
    return place.groupBy(*group).agg(at_place(F.floor(F.col("total") / 2), value).alias(median), F.max("total").alias("n"))
