"""When a season first stays below all prior ones: gaps and islands on the days that can be compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from rillflow.config import CROSSOVER_MIN_RUN


def evaluable_days(current: DataFrame, priors: DataFrame, key: str, day: str, season: str, value: str, n_priors: int) -> DataFrame:
    """Days on which the current season and all priors have a value: key, day, seq (from 0), below.

    Other days are left out, and so don't break a run. below: strictly less than the least prior value.
    """
    least = priors.where(F.col(value).isNotNull()).groupBy(key, day).agg(F.count_distinct(season).alias("__n"), F.min(value).alias("__least")).where(F.col("__n") == n_priors)
    both = current.where(F.col(value).isNotNull()).select(key, day, value).join(least, [key, day])
    return both.select(key, day, (F.row_number().over(W.partitionBy(key).orderBy(day)) - 1).alias("seq"), (F.col(value) < F.col("__least")).alias("below"))


def below_runs(days: DataFrame, key: str, day: str, min_run: int = CROSSOVER_MIN_RUN) -> DataFrame:
    """Runs below: first and last day, sequence numbers, length, whether it qualifies, whether it reaches the last day."""
    last = F.max("seq").over(W.partitionBy(key))
    next_day = F.lead(day).over(W.partitionBy(key).orderBy("seq"))
    marked = days.select(key, day, "seq", "below", last.alias("__last"), next_day.alias("__next"))
    island = F.col("seq") - F.row_number().over(W.partitionBy(key).orderBy("seq"))
    return (
        marked.where("below")
        .withColumn("__island", island)
        .groupBy(key, "__island")
        .agg(F.min(day).alias("start_day"), F.max(day).alias("end_day"), F.min("seq").alias("start_seq"), F.count(F.lit(1)).alias("run_length"), (F.max("seq") == F.max("__last")).alias("is_current"), F.max_by("__next", "seq").alias("next_day"))
        .withColumn("qualifies", F.col("run_length") >= min_run)
        .drop("__island")
    )


def crossover(entities: DataFrame, days: DataFrame, key: str, day: str, min_run: int = CROSSOVER_MIN_RUN) -> DataFrame:
    """One row per entity: case, cross_day, run_end_day, recovered_day, currently_below and current_run.

    Only the first qualifying run is looked at: from the first day on it marks no crossing; if it ended, the next evaluable
    day is the recovery. Entities without evaluable days are not_evaluable.
    """
    found = below_runs(days, key, day, min_run)
    best = F.min(F.when(F.col("qualifies"), F.struct("start_seq", "start_day", "end_day", "is_current", "next_day")))
    per = found.groupBy(key).agg(best.alias("run"), F.max(F.when(F.col("is_current"), F.struct("start_day", F.col("run_length").alias("length"), "qualifies"))).alias("current_run"))
    seen = days.groupBy(key).agg(F.count(F.lit(1)).alias("n_days"))
    case = F.when(F.col("n_days").isNull(), "not_evaluable").when(F.col("run").isNull(), "never_below").when(F.col("run.start_seq") == 0, "below_from_start").otherwise("crossed")
    ended = F.col("run").isNotNull() & ~F.col("run.is_current")
    return (
        entities.select(key)
        .join(seen, key, "left")
        .join(per, key, "left")
        .select(
            key,
            case.alias("case"),
            F.when(F.col("run.start_seq") > 0, F.col("run.start_day")).alias("cross_day"),
            F.when(ended, F.col("run.end_day")).alias("run_end_day"),
            F.when(ended, F.col("run.next_day")).alias("recovered_day"),
            F.col("current_run").isNotNull().alias("currently_below"),
            "current_run",
        )
    )
