"""Guarded arithmetic: undefined stays null, never zero and never infinite."""

from __future__ import annotations

from pyspark.sql import Column, Window as W, functions as F

from rillflow.config import CUSEC_DAY_MCM


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole where whole is positive."""
    return F.when(whole > 0, 100.0 * part / whole)


def days_of_water(live: Column, canal: Column) -> Column:
    """Days that the live store lasts at the canal's flow; null without a flow."""
    return F.when(canal > 0, live / (canal * CUSEC_DAY_MCM))


def relative_difference(a: Column, b: Column) -> Column:
    """|a - b| / |b|; null where b is 0."""
    return F.when(b != 0, F.abs(a - b) / F.abs(b))


def near_equal(a: Column, b: Column, eps: float) -> Column:
    """Null-safe: false where either is null or b is 0."""
    return F.coalesce(relative_difference(a, b) <= eps, F.lit(False))


def at_least_one(value: Column) -> Column:
    """A denominator that is never below 1."""
    return F.greatest(value, F.lit(1))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: sum(w * x) / sum(w) over rows that have both; null if the weights sum to 0."""
    w = F.sum(F.when(value.isNotNull(), weight))
    return F.when(w != 0, F.sum(value * weight) / w)


def quadrant(rain: Column, storage: Column, rain_band: Column | float, storage_band: Column | float) -> Column:
    """Two-axis class; a deviation counts as low strictly below minus its band; null where either is null."""
    rain_band, storage_band = (b if isinstance(b, Column) else F.lit(b) for b in (rain_band, storage_band))
    dry, low = rain < -rain_band, storage < -storage_band
    return F.when(rain.isNull() | storage.isNull(), F.lit(None).cast("string")).when(dry & low, "rain_explains").when(low, "low_despite_rain").when(dry, "held_up").otherwise("both_normal")


def moments(value: Column) -> tuple[Column, Column, Column]:
    """Aggregates: mean, median and sample deviation; the last is null for a single value."""
    return F.avg(value), F.median(value), F.stddev_samp(value)


def band_holds(value: Column, flags: list[tuple[float, float, Column]]) -> Column:
    """Whether exactly one flagged band (low, high, flag) holds the value, above low and not above high, the first from zero on.
    Nothing flagged goes with zero alone; null for null."""
    flagged = F.filter(F.array(*(F.struct(F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"), on.alias("on")) for lo, hi, on in flags)), lambda b: b["on"])
    one = F.get(flagged, F.lit(0))
    holds = ((value > one["lo"]) | (one["lo"] == 0)) & (value <= one["hi"])
    return F.when(value.isNull(), F.lit(None).cast("boolean")).when(F.size(flagged) != 1, (F.size(flagged) == 0) & (value == 0)).otherwise(holds)


def total_holds(total: Column, part: Column, tolerance: float = 0.001) -> Column:
    """Whether a running total is no less than one of its parts, but for rounding; null where either is."""
    return total >= part - tolerance


def class_of_value(value: Column, breaks: list[float]) -> Column:
    """Index of the first break above the value; beyond the last one len(breaks); null stays null."""
    out = F.when(value.isNull(), F.lit(None).cast("int"))
    for k, b in enumerate(breaks):
        out = out.when(value < b, k)
    return out.otherwise(len(breaks))


def histogram_bin(value: Column, bins: int) -> Column:
    """Bin of a value in [0, 1], the last one closed; null outside."""
    return F.when((value >= 0) & (value <= 1), F.least(F.floor(value * bins), F.lit(bins - 1)).cast("int"))


def percent_rank_average(value: Column, *partition: str) -> Column:
    """Rank among the non-null values as a share, ties sharing their mean rank; null for null."""
    ordered = W.partitionBy(*partition, value.isNull()).orderBy(value)
    ties = W.partitionBy(*partition, value)
    whole = W.partitionBy(*partition, value.isNull())
    return F.when(value.isNotNull(), (F.rank().over(ordered) + (F.count(F.lit(1)).over(ties) - 1) / 2.0) / F.count(F.lit(1)).over(whole))


def upper_median(values: Column) -> Column:
    """Aggregate: the middle value, the upper of two; never between values."""
    kept = F.array_sort(F.collect_list(values))
    return F.element_at(kept, (F.floor(F.size(kept) / 2) + 1).cast("int"))


def shares(columns: list[Column]) -> Column:
    """The columns' shares of their sum, nulls as 0; null if the sum isn't positive."""
    values = F.array(*(F.coalesce(c, F.lit(0.0)) for c in columns))
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.transform(values, lambda x: x / total))


def entropy(columns: list[Column]) -> Column:
    """Shannon entropy of the shares, in nats; undefined without a positive total."""
    return F.aggregate(shares(columns), F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.ln(p)).otherwise(F.lit(0.0)))


def dominance(columns: list[Column]) -> Column:
    """The largest share."""
    return F.array_max(shares(columns))


def two_way_variance(part: Column, rest: Column) -> Column:
    """4p(1 - p) of part in part + rest; undefined without a positive total."""
    p = part / (part + rest)
    return F.when(part + rest > 0, 4 * p * (1 - p))


def composite(weights: dict[Column, float] | list[tuple[Column, float]]) -> Column:
    """Weighted mean of components that must all be there: no component's weight goes to others."""
    pairs = list(weights.items()) if isinstance(weights, dict) else weights
    total = sum(w for _, w in pairs)
    out = F.lit(0.0)
    for c, w in pairs:
        out = out + c * w
    return out / total
