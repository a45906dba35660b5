"""Composite index of units: components, ranks, status, verdicts, sensitivity."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rillflow import config
from rillflow.functions.numeric import composite, entropy, two_way_variance
from rillflow.operators import order

#: Limits of the verdict ladder.
RECONCILIATION_MAX, ABSENT_MAX_IQR, WEAK_MAX_IQR, SINGLE_MAX = 0.05, 0.05, 0.15, 0.70


def components(units: DataFrame, key: str, group: str, sources: Sequence[str], irrigated: str, rainfed: str, area: str, unreliable: Sequence = ()) -> DataFrame:
    """units, told apart by key, with c_diversity, c_source, c_size; each in [0, 1] or unknown.

    Negative areas are unknown. c_diversity: 4p(1-p) of the rainfed share, over the aggregate irrigated area. c_source:
    entropy of the sources over ln of their number; 0 for wholly rainfed units; null without any source, and in groups whose
    sources don't reconcile. c_size: average-tie percent rank of the area within the group.
    """
    positive = {c: F.when(F.col(c) >= 0, F.col(c).cast("double")) for c in (*sources, irrigated, rainfed)}
    listed = [positive[c] for c in sources]
    mix = F.when(F.coalesce(*listed).isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(entropy(listed) / math.log(len(sources)), F.lit(0.0)))
    known = ~F.col(group).isin(*unreliable) if unreliable else F.lit(True)
    told = units.withColumn("c_diversity", two_way_variance(positive[rainfed], positive[irrigated])).withColumn("c_source", F.when(known, mix))
    return order.percent_ranks(told, [group], area, "c_size", key)


def index_of(weights: Mapping[str, float] = config.INDEX_WEIGHTS) -> Column:
    """Weighted mean of the components; null unless all that weigh are there."""
    return composite([(F.col(f"c_{name}"), w) for name, w in weights.items() if w])


def status(index: Column, source: Column, diversity: Column, unreliable: Column, no_data: Column) -> Column:
    """Why a unit has no index; issued beats all other reasons."""
    return F.when(index.isNotNull(), "issued").when(no_data, "no_land_use_data").when(diversity.isNull(), "no_mechanism_component").when(source.isNull() & unreliable, "withheld_source_data_unreliable").otherwise("issued")


def integrity_mask(sown: Column, irrigated: Column, rainfed: Column, area: Column) -> Column:
    """Whether any of six null-safe checks fails."""
    checks = (sown == 0, sown.isNull(), rainfed.isNull(), area == 0, irrigated > area, sown > area)
    out = F.lit(False)
    for c in checks:
        out = out | F.coalesce(c, F.lit(False))
    return out


def top_decile(units: DataFrame, key: str, group: Sequence[str], index: str, covered: Column, top: str = "top") -> DataFrame:
    """units with `top`: 1 in the top decile of its group, 0 below, null outside the coverage or without an index."""
    ranked = order.percent_ranks(units.withColumn("__covered", covered), group, index, "__decile", key)
    return ranked.withColumn(top, F.when(F.col("__covered") & F.col(index).isNotNull(), (F.col("__decile") >= config.TOP_DECILE).cast("int"))).drop("__covered", "__decile")


def verdict(n_rows: Column, n_defined: Column, failing: Column, iqr: Column, single: Column, least_rows: int = 0) -> Column:
    """First that holds: too few rows, no data, unreliable, absent, weak, fails; else passes."""
    return (
        F.when(n_rows < least_rows, "TOO FEW ROWS")
        .when(n_defined == 0, "NO DATA")
        .when(failing > RECONCILIATION_MAX, "SOURCE DATA UNRELIABLE")
        .when(iqr < ABSENT_MAX_IQR, "MECHANISM ABSENT")
        .when(iqr < WEAK_MAX_IQR, "MECHANISM WEAK")
        .when(single > SINGLE_MAX, "FAILS")
        .otherwise("PASSES")
    )


#: Parts that the values of a column are cut into when they are ranked.
RANK_PARTS = 256


def average_ranks(rows: DataFrame, value: str, rank: str) -> DataFrame:
    """(value, rank) of each distinct value among all rows, ties sharing their mean rank; no task sees all values.

    Values are counted first, then cut into RANK_PARTS ranges at approximate quantiles, which shift no rank: each range
    numbers its own values, starting from the counts of the ranges before it, one row a range.
    """
    counted = rows.groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
    cuts = counted.approxQuantile(value, [k / RANK_PARTS for k in range(1, RANK_PARTS)], 1 / (4 * RANK_PARTS))
    marks = F.array(*(F.lit(float(c)) for c in sorted(set(cuts)))) if cuts else F.array().cast("array<double>")
    parted = counted.withColumn("__part", F.size(F.filter(marks, lambda m: m < F.col(value))))
    starts = parted.groupBy("__part").agg(F.sum("__n").alias("__all"))
    starts = starts.select(F.col("__part").alias("__p"), F.coalesce(F.sum("__all").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__start"))
    before = F.coalesce(F.sum("__n").over(W.partitionBy("__part").orderBy(value).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return parted.withColumn("__before", before).join(starts, F.col("__part") == F.col("__p")).select(F.col(value).alias(f"__{rank}_of"), (F.col("__start") + F.col("__before") + (F.col("__n") + 1) / 2.0).alias(rank))


def spearman(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation over rows that have both: average-tie ranks, then Pearson."""
    both = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
    ranked = both.join(average_ranks(both, "a", "ra"), F.col("a") == F.col("__ra_of")).join(average_ranks(both, "b", "rb"), F.col("b") == F.col("__rb_of"))
    return ranked.agg(F.corr("ra", "rb").alias("spearman"), F.count(F.lit(1)).alias("n"))


def sensitivity(units: DataFrame, key: str, schemes: Mapping[str, Mapping[str, float]], base: Mapping[str, float] = config.INDEX_WEIGHTS) -> DataFrame:
    """Per alternative weighting: rank correlation with the base index and the share of the top decile that changes.

    All weightings come from one scan: each unit is unpacked into one row per scheme.
    """
    options = F.array(*(F.struct(F.lit(n).alias("scheme"), index_of(w).alias("alt")) for n, w in schemes.items()))
    # to twelve places: values that are equal but for the order of addition are ties
    long = units.select(key, F.round(index_of(base), 12).alias("base"), F.explode(options).alias("o")).select(key, "base", "o.scheme", F.round("o.alt", 12).alias("alt")).where("base is not null and alt is not null")
    ranked = order.percent_ranks(order.percent_ranks(long, ["scheme"], "base", "rb", key), ["scheme"], "alt", "ra", key)
    top_base, top_alt = F.col("rb") >= config.TOP_DECILE, F.col("ra") >= config.TOP_DECILE
    return ranked.groupBy("scheme").agg(F.corr("rb", "ra").alias("spearman"), (F.count_if(top_base & ~top_alt) / F.nullif(F.count_if(top_base), F.lit(0))).alias("decile_churn"))
