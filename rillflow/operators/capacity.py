"""One denominator for each entity and season: near-equal clustering, runs, classes, restatements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rillflow.config import CAPACITY_EPS, EDGE_MAX_DAYS


def clusters(values: Column, eps: float = CAPACITY_EPS) -> Column:
    """Aggregate: array of struct(lo, rep), ascending. A value opens a cluster when it differs from the cluster's least
    member by more than eps of itself; clusters don't chain; 0 opens none; the largest member represents it."""
    kind = "array<struct<lo:double,rep:double>>"

    def add(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        opens = (F.size(acc) == 0) | ((x != 0) & (F.abs(x - last["lo"]) / F.abs(x) > eps))
        wider = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last["lo"].alias("lo"), x.alias("rep"))))
        return F.when(opens, F.concat(acc, F.array(F.struct(x.alias("lo"), x.alias("rep"))))).otherwise(wider)

    return F.aggregate(F.array_sort(F.collect_set(values.cast("double"))), F.array().cast(kind), add)


def canonical_values(rows: DataFrame, key: Sequence[str], value: str, eps: float = CAPACITY_EPS) -> DataFrame:
    """rows with `canon`, the representative of the value's cluster within its key; null stays null.

    The array per key holds distinct values of one entity and season, at most one a day.
    """
    found = rows.where(F.col(value).isNotNull()).groupBy(*key).agg(clusters(F.col(value), eps).alias("__clusters"))
    v = F.col(value).cast("double")
    mine = F.filter("__clusters", lambda c: (c["lo"] <= v) & (v <= c["rep"]))
    return rows.join(found, list(key), "left").withColumn("canon", F.get(mine, F.lit(0))["rep"]).drop("__clusters")


def runs(rows: DataFrame, key: Sequence[str], order: Sequence[str], value: str = "canon") -> DataFrame:
    """Runs of one value in order: start and end of the first order column, value, length. A null never continues a run."""
    w = W.partitionBy(*key).orderBy(*order)
    same = F.coalesce(F.col(value) == F.lag(value).over(w), F.lit(False))
    numbered = rows.withColumn("__run", F.sum((~same).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*key, "__run").agg(F.min(order[0]).alias("run_start"), F.max(order[0]).alias("run_end"), F.first(value).alias("run_value"), F.count(F.lit(1)).alias("run_length")).withColumnRenamed("__run", "run_no")


def classify(rows: DataFrame, key: Sequence[str], order: Sequence[str], value: str, eps: float = CAPACITY_EPS, edge_max: int = EDGE_MAX_DAYS) -> DataFrame:
    """One row per key: capacity_class, capacity, n_days, n_values, n_major, n_minor, values, change_dates.

    clean: one value at most. edge_exception: one run beside the majority's, at the very start, no longer than edge_max,
    all the minority there is, and smaller than the majority. Else mid_season, without a capacity. A key whose values are
    all null has neither class nor capacity.
    """
    canon = canonical_values(rows, key, value, eps)
    counts = canon.where("canon is not null").groupBy(*key, "canon").agg(F.count(F.lit(1)).alias("n"))
    major = counts.groupBy(*key).agg(F.max_by("canon", F.struct("n", "canon")).alias("major"), F.max("n").alias("n_major"), F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("n_values"), F.array_join(F.transform(F.array_sort(F.collect_list("canon")), lambda x: x.cast("string")), "/").alias("values"))
    parts = runs(canon, key, order)
    start = canon.groupBy(*key).agg(F.min(order[0]).alias("season_start"), F.count(F.lit(1)).alias("n_days"))
    odd = (
        parts.join(major.select(*key, "major"), list(key))
        .groupBy(*key)
        .agg(
            F.count_if(F.coalesce(F.col("run_value") != F.col("major"), F.lit(True))).alias("n_odd"),
            F.min(F.when(F.col("run_value") != F.col("major"), F.col("run_no"))).alias("odd_no"),
            F.max(F.when(F.col("run_value") != F.col("major"), F.col("run_length"))).alias("odd_length"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("run_no") > 1, F.col("run_start").cast("string")))), lambda x: x), ",").alias("change_dates"),
        )
    )
    n_minor = F.col("n_all") - F.col("n_major")
    edge = (F.col("n_odd") == 1) & (F.col("odd_no") == 1) & (F.col("odd_length") <= edge_max) & (F.col("odd_length") == n_minor) & (F.col("n_major") > n_minor)
    kind = F.when(F.col("n_values").isNull(), F.lit(None).cast("string")).when(F.col("n_values") <= 1, "clean").when(edge, "edge_exception").otherwise("mid_season")
    return (
        start.join(major, list(key), "left")
        .join(odd, list(key), "left")
        .select(*key, kind.alias("capacity_class"), F.when(kind.isin("clean", "edge_exception"), F.col("major")).alias("capacity"), "n_days", F.coalesce("n_values", F.lit(0)).cast("long").alias("n_values"), F.coalesce("n_major", F.lit(0)).cast("long").alias("n_major"), F.coalesce(n_minor, F.lit(0)).cast("long").alias("n_minor"), "values", "change_dates")
    )


def restatements(seasons: DataFrame, entity: str, season: str, value: str, first: str, last: str, eps: float = CAPACITY_EPS) -> DataFrame:
    """Changes between consecutive available seasons of an entity, with direction, gap and the series' shape.

    shape: oscillating if the series, repeats in a row collapsed, comes back to a value; single_step with one change; else
    multi_step.
    """
    w = W.partitionBy(entity).orderBy(season)
    every = W.partitionBy(entity)
    stepped = seasons.where(F.col(value).isNotNull()).select(entity, season, value, last, F.lag(season).over(w).alias("season_before"), F.lag(value).over(w).alias("before"), F.lag(last).over(w).alias("last_seen_before"), F.col(first).alias("first_seen_after"))
    changed = F.abs(F.col(value) - F.col("before")) / F.col("before") > eps
    series = F.transform(F.array_sort(F.collect_list(F.struct(season, F.round(value, 4).alias("v"))).over(every)), lambda s: s["v"])
    marked = stepped.withColumn("__series", series).withColumn("__changes", F.count_if(F.coalesce(changed, F.lit(False))).over(every))
    collapsed = F.filter("__series", lambda x, i: (i == 0) | (x != F.get("__series", i - 1)))
    shape = F.when(F.size(collapsed) != F.size(F.array_distinct(collapsed)), "oscillating").when(F.col("__changes") == 1, "single_step").otherwise("multi_step")
    return marked.where(changed).select(
        entity, "season_before", F.col(season).alias("season_after"), F.col("before").alias("value_before"), F.col(value).alias("value_after"),
        F.when(F.col(value) > F.col("before"), "up").otherwise("down").alias("direction"), shape.alias("shape"), "last_seen_before", "first_seen_after", F.datediff("first_seen_after", "last_seen_before").alias("gap_days"),
    )


def change_date(rows: DataFrame, key: Sequence[str], date: str, value: str, old: str, new: str, eps: float = CAPACITY_EPS) -> DataFrame:
    """Last day that reads the old value and first that reads the new one, with the days that read neither."""
    is_old, is_new = (F.abs(F.col(value) - F.col(x)) <= eps * F.abs(F.col(x)) for x in (old, new))
    return rows.groupBy(*key).agg(F.max(F.when(is_old, F.col(date))).alias("last_old"), F.min(F.when(is_new, F.col(date))).alias("first_new"), F.count_if(~is_old & ~is_new).alias("n_neither"))


def change_bracket(rows: DataFrame, key: Sequence[str], date: str, value: str, old: str, new: str, eps: float = CAPACITY_EPS) -> DataFrame:
    """Where a value changed from old to new, and how far that can be said: key, last_old, first_new, n_third, n_unread, n_absent, verdict.

    n_third and n_unread count the days between the two that read another value, or nothing; n_absent the days without a row.
    verdict, the first that holds: never_new, never_old, old_again (the old value is read on or after the first day of the new),
    third_value, exact (no day between), else bracket. Days without a date don't count.
    """
    near = lambda x: F.coalesce(F.abs(F.col(value) - F.col(x)) <= eps * F.abs(F.col(x)), F.lit(False))
    day = F.col(date)
    ends = rows.where(day.isNotNull()).groupBy(*key).agg(F.max(F.when(near(old), day)).alias("last_old"), F.min(F.when(near(new), day)).alias("first_new"))
    names = [F.col(k).alias(f"__k{n}") for n, k in enumerate(key)]
    on = (day > F.col("__from")) & (day < F.col("__to"))
    for n, k in enumerate(key):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{n}"))
    inner = rows.join(ends.where("last_old < first_new").select(*names, F.col("last_old").alias("__from"), F.col("first_new").alias("__to")), on)
    between = inner.groupBy(*(F.col(k).alias(f"__k{n}") for n, k in enumerate(key))).agg(
        F.count_distinct(F.when(F.col(value).isNotNull(), day)).alias("n_third"),
        F.count_distinct(F.when(F.col(value).isNull(), day)).alias("n_unread"),
        F.count_distinct(day).alias("__days"),
    )
    same = F.lit(True)
    for n, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{n}"))
    gap = F.datediff("first_new", "last_old") - 1
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    verdict = (
        F.when(F.col("first_new").isNull(), "never_new")
        .when(F.col("last_old").isNull(), "never_old")
        .when(F.col("last_old") >= F.col("first_new"), "old_again")
        .when(count(F.col("n_third")) > 0, "third_value")
        .when(gap == 0, "exact")
        .otherwise("bracket")
    )
    absent = F.when(F.col("last_old") < F.col("first_new"), gap - count(F.col("__days"))).otherwise(0).cast("long")
    return ends.join(between, same, "left").select(*key, "last_old", "first_new", count(F.col("n_third")).alias("n_third"), count(F.col("n_unread")).alias("n_unread"), F.coalesce(absent, F.lit(0)).alias("n_absent"), verdict.alias("verdict"))
