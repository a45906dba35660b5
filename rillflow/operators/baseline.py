"""How a day compares with the same date of prior years, like with like."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillflow.config import CAPACITY_EPS
from rillflow.functions.numeric import near_equal


def comparable(prior: DataFrame, today: DataFrame, entity: str, capacity: str, mid_season: str | None = None, eps: float = CAPACITY_EPS) -> DataFrame:
    """Prior rows of today's entities with matches (capacity near today's), mid and comparable (matches, not mid).

    capacity names the column in both frames; unknown capacities don't match.
    """
    now = today.select(entity, F.col(capacity).alias("__today"))
    mid = F.coalesce(F.col(mid_season), F.lit(False)) if mid_season else F.lit(False)
    joined = prior.join(now, entity).withColumn("matches", near_equal(F.col(capacity), F.col("__today"), eps)).withColumn("mid", mid)
    return joined.withColumn("comparable", F.col("matches") & ~F.col("mid")).drop("__today")


def years_listed(condition: Column, season: str) -> Column:
    """Aggregate: seasons of the rows for which it holds, ascending, duplicates kept, comma-joined; "" for none."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(condition, F.col(season)))), lambda y: y.cast("string")), ",")


def baseline(marked: DataFrame, entity: str, season: str, value: str) -> DataFrame:
    """Per entity with a comparable year: mean, least and largest prior value, years used and dropped by reason."""
    ok = F.col("comparable")
    return marked.groupBy(entity).agg(
        F.avg(F.when(ok, F.col(value))).alias("prior_mean"),
        F.min(F.when(ok, F.col(value))).alias("prior_min"),
        F.max(F.when(ok, F.col(value))).alias("prior_max"),
        F.count_if(ok).alias("n_used"),
        years_listed(ok, season).alias("years_used"),
        F.count_if(~F.col("matches")).alias("n_dropped_capacity"),
        F.count_if(F.col("matches") & F.col("mid")).alias("n_dropped_mid"),
        years_listed(~ok, season).alias("years_dropped"),
    )


def deviations(today: DataFrame, found: DataFrame, entity: str, value: str) -> DataFrame:
    """Today's rows beside their baseline: deviation, null without a comparable year; no row is lost."""
    return today.join(found, entity, "left").withColumn("deviation", F.when(F.col("n_used") > 0, F.col(value) - F.col("prior_mean"))).withColumn("orphan", F.coalesce(F.col("n_used"), F.lit(0)) == 0)


def proportional(value: Column, mean: Column) -> Column:
    """Deviation in percent of the mean; null unless that is positive."""
    return F.when(mean > 0, 100.0 * (value - mean) / mean)


def shortfall(deviation_points: Column, capacity: Column) -> Column:
    """What a deficit in points of capacity amounts to; 0 for a surplus; null if unknown."""
    return F.when(deviation_points.isNotNull() & capacity.isNotNull(), F.greatest(-deviation_points / 100 * capacity, F.lit(0.0)))


def coverage(release: Column, short: Column) -> Column:
    """What share of a shortfall the season's release makes up, to two places; null without a shortfall."""
    return F.when(short > 0, F.round(release / short, 2))


def ranked(rows: DataFrame, by: str, key: str, n: int, largest: bool = False) -> DataFrame:
    """The n rows least (or largest) in `by`, nulls left out, ties by key."""
    order = F.desc(by) if largest else F.asc(by)
    return rows.where(F.col(by).isNotNull()).orderBy(order, key).limit(n)


def rank_column(rows: DataFrame, preferred: str, other: str) -> str:
    """The preferred column if every row has it, else the other."""
    return preferred if not rows.where(F.col(preferred).isNull()).limit(1).count() else other


def quadrant_grid(rows: DataFrame, rain: str, storage: str, rain_bands: list[float], storage_bands: list[float]) -> DataFrame:
    """Counts of the two-axis classes for each pair of bands, from one scan: the bands are a small literal array."""
    from rillflow.functions.numeric import quadrant

    grid = F.array(*(F.struct(F.lit(float(r)).alias("rain_band"), F.lit(float(s)).alias("storage_band")) for r in rain_bands for s in storage_bands))
    cells = rows.select(rain, storage, F.explode(grid).alias("g")).select("g.*", quadrant(F.col(rain), F.col(storage), F.col("g.rain_band"), F.col("g.storage_band")).alias("quadrant"))
    return cells.groupBy("rain_band", "storage_band").agg(*(F.count_if(F.col("quadrant") == q).alias(f"n_{q}") for q in ("rain_explains", "low_despite_rain", "held_up", "both_normal")), F.count_if(F.col("quadrant").isNull()).alias("n_unknown"))
