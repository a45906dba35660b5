"""Run summaries of daily series that merge: one day's load adds to them, and seasons aren't read again.

A summary is rows (key, start, end, value): runs of one value, null included, over days that follow each other without a gap.
It holds a series whole in a few rows. Summaries of disjoint days merge to the summary of all of them, in any grouping and any
order, since no run reaches over a day that is still to come. What needs the series (classes of capacities, crossings, runs)
unfolds it again by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from rillflow.operators import capacity, crossover
from rillflow.session import written
from rillflow.sources import daily

RUN = ("start", "end", "value")


def _after(day: Column, kind: str) -> Column:
    """The day after one: of dates or of numbers of days."""
    return F.date_add(day, 1) if kind == "date" else day + 1


def _joined(runs: DataFrame, key: Sequence[str]) -> DataFrame:
    """Runs that follow each other at once with one value, as one; days in several runs stay in several."""
    kind = dict(runs.dtypes)["start"]
    w = W.partitionBy(*key).orderBy("start", "end")
    goes_on = (F.lag("end").over(w).isNotNull()) & (F.col("start") == _after(F.lag("end").over(w), kind)) & F.col("value").eqNullSafe(F.lag("value").over(w))
    numbered = runs.withColumn("__run", F.sum((~F.coalesce(goes_on, F.lit(False))).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*key, "__run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.first("value").alias("value")).drop("__run")


def summarize(rows: DataFrame, key: Sequence[str], day: str, value: str) -> DataFrame:
    """The summary of rows; of several rows of a day the least value counts, null only if there is no other. Null days are left out."""
    each = rows.where(F.col(day).isNotNull()).groupBy(*key, F.col(day).alias("start")).agg(F.min(value).alias("value"))
    return _joined(each.select(*key, "start", F.col("start").alias("end"), "value"), key)


def merge(key: Sequence[str], *summaries: DataFrame) -> DataFrame:
    """The summary of all days of some summaries of disjoint days."""
    every = summaries[0].select(*key, *RUN)
    for more in summaries[1:]:
        every = every.unionByName(more.select(*key, *RUN))
    return _joined(every, key)


def clashes(summary: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose merged summary has a day twice: their parts weren't disjoint, and they are to be summarized from rows again."""
    before = F.max("end").over(W.partitionBy(*key).orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1))
    return summary.withColumn("__before", before).where(F.col("start") <= F.col("__before")).select(*key).distinct()


def unfold(summary: DataFrame, key: Sequence[str], day: str, value: str) -> DataFrame:
    """The series again: (key, day, value), one row a day."""
    return summary.select(*key, F.explode(F.sequence("start", "end")).alias(day), F.col("value").alias(value))


def classify(summary: DataFrame, key: Sequence[str], **how) -> DataFrame:
    """capacity.classify() of the series that a summary holds."""
    return capacity.classify(unfold(summary, key, "__day", "__value"), key, ["__day"], "__value", **how)


def crossings(summary: DataFrame, entities: DataFrame, key: str, min_run: int) -> DataFrame:
    """crossover.crossover() of a summary of evaluable days, whose values are whether the day is below."""
    days = unfold(summary, [key], "day", "below")
    days = days.withColumn("seq", F.row_number().over(W.partitionBy(key).orderBy("day")) - 1)
    return crossover.crossover(entities, days, key, "day", min_run)


def add_day(spark: SparkSession, path: str, rows: DataFrame, key: Sequence[str], day: str, value: str, season: str) -> DataFrame:
    """Fold rows of new days into the stored summary at a path, kept by season; the summaries of the seasons they belong to.

    Only the folders of those seasons are read and replaced. Days that are there already are replaced by the new rows: the runs
    that hold them are unfolded first. Folding the same rows again changes nothing.
    """
    new = summarize(rows, key, day, value)
    kinds = {f.name: f.dataType.simpleString() for f in new.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*[k for k in key if k != season], *RUN, season])
    seasons = [r[0] for r in new.select(season).distinct().collect()]  # a load's seasons: one, as a rule
    old = daily.scan(spark, path, schema).where(F.col(season).isin(seasons)) if seasons else spark.createDataFrame([], schema)
    days = unfold(old.select(*key, *RUN), key, "start", "value").withColumn("end", F.col("start"))
    kept = days.join(unfold(new, key, "start", "__v").select(*key, "start"), [*key, "start"], "left_anti")
    done = written(merge(key, kept.select(*key, *RUN), new), "summary")  # what is read is about to be replaced
    daily.write_days(done, path, season)
    return done
