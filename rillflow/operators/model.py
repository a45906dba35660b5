"""Facts, dimensions and coverage of daily observations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def latest_per_key(rows: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The columns of each key's last row by `order`, in one aggregation: no window, no self-join."""
    last = F.max_by(F.struct(*columns), F.struct(*order))
    return rows.groupBy(key).agg(last.alias("__last")).select(key, *(F.col(f"__last.{c}").alias(c) for c in columns))


def dimension_with_drift(rows: DataFrame, key: str, order: Sequence[str], latest: Sequence[str], variants: Mapping[str, str]) -> DataFrame:
    """Latest values of each key, and how many distinct values each column of `variants` (column -> name) has had."""
    aggregates = [F.size(F.collect_set(c)).cast("long").alias(name) for c, name in variants.items()]
    out = rows.groupBy(key).agg(F.max_by(F.struct(*latest), F.struct(*order)).alias("__last"), *aggregates)
    return out.select(key, *(F.col(f"__last.{c}").alias(f"{c}_latest") for c in latest), *variants.values())


def coverage(rows: DataFrame, date: str, entity: str, counters: Mapping[str, Column]) -> DataFrame:
    """Per date: rows, distinct entities, and rows for which each condition holds (null counts as no)."""
    return rows.groupBy(date).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(entity).alias("n_entities"), *(F.count_if(c).alias(n) for n, c in counters.items()))


def missing_dates(spine: DataFrame, present: DataFrame, reasons: DataFrame, date: str = "d") -> DataFrame:
    """Days of the spine that are not present, with the reason where one is on record."""
    return spine.join(present.select(date).distinct(), date, "left_anti").join(reasons, date, "left")


def gap_runs(missing: DataFrame, date: str = "d") -> DataFrame:
    """Runs of consecutive missing days: first, last, length."""
    run = F.date_sub(date, F.row_number().over(W.partitionBy(F.year(date)).orderBy(date)))
    return missing.select(date, run.alias("__run")).groupBy("__run").agg(F.min(date).alias("first_day"), F.max(date).alias("last_day"), F.count(F.lit(1)).alias("n_days")).drop("__run")


def checked_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One-to-one join; duplicate keys on either side raise."""
    for side, df in (("left", left), ("right", right)):
        if (bad := df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()) != []:
            raise ValueError(f"{side} side repeats {key}={bad[0][0]!r}")
    return left.join(right, key)


def join_audit(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: keys on both sides, only left, only right; each key counts once."""
    a = left.select(key).distinct().withColumn("__l", F.lit(True))
    b = right.select(key).distinct().withColumn("__r", F.lit(True))
    both = a.join(b, key, "full_outer")
    return both.agg(F.count_if(F.col("__l") & F.col("__r")).alias("matched"), F.count_if(F.col("__l") & F.col("__r").isNull()).alias("left_only"), F.count_if(F.col("__r") & F.col("__l").isNull()).alias("right_only"))


def set_audit(**pairs: tuple[DataFrame, DataFrame, str]) -> DataFrame:
    """(difference, key): for each name -> (a, b, column), keys of a that b lacks. Keys are told as text; nulls are no keys."""
    out = None
    for name, (a, b, column) in pairs.items():
        left = a.select(F.col(column).cast("string").alias("key")).where("key is not null").distinct()
        found = left.join(b.select(F.col(column).cast("string").alias("key")), "key", "left_anti").select(F.lit(name).alias("difference"), "key")
        out = found if out is None else out.unionByName(found)
    return out


def ambiguous_keys_dropped(names: DataFrame, key: str, value: str) -> DataFrame:
    """key -> value where the key has one value only."""
    return names.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("__other")).where(F.col(value) == F.col("__other")).drop("__other")


def drop_all_duplicates(rows: DataFrame, *key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key occurs once, and all rows of the others. Nulls count as equal."""
    marked = rows.withColumn("__n", F.count(F.lit(1)).over(W.partitionBy(*key)))
    return marked.where("__n = 1").drop("__n"), marked.where("__n > 1").drop("__n")


def merge_ledger(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows by key, those of later parts winning; columns by name, missing ones null."""
    union = None
    for k, part in enumerate(parts):
        part = part.withColumn("__from", F.lit(k))
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)
    first = F.row_number().over(W.partitionBy(key).orderBy(F.desc("__from")))
    return union.withColumn("__place", first).where("__place = 1").drop("__place", "__from")


def append_absent(log: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The log and those new rows whose key it lacks: never twice for one key."""
    return log.unionByName(new.join(log.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """Old rows whose key isn't in new, and all new rows."""
    return old.join(new.select(*key).distinct(), list(key), "left_anti").unionByName(new)


def absent_roles(attempts: DataFrame, key: str, outcome: str) -> DataFrame:
    """What a key's attempts say: found; else missing if any says so; else upstream's emptiness only if all were empty."""
    return attempts.groupBy(key).agg(
        F.when(F.count_if(F.col(outcome) == "ok") > 0, "found")
        .when(F.count_if(F.col(outcome) == "missing") > 0, "missing")
        .when(F.count_if(F.col(outcome) == "empty") == F.count(F.lit(1)), "empty_upstream")
        .otherwise("failed")
        .alias("status")
    )


def failure_runs(attempts: DataFrame, order: Sequence[str], failed: str, run: int, *partition: str) -> DataFrame:
    """Rows at which `run` failures in a row are reached; a success starts the count anew."""
    w = W.partitionBy(*partition).orderBy(*order)
    block = F.sum(F.when(F.col(failed), 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0))
    length = F.sum(F.when(F.col(failed), 1).otherwise(0)).over(W.partitionBy(*partition, "__block").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return attempts.withColumn("__block", block).withColumn("__length", length).where(F.col(failed) & (F.col("__length") % run == 0)).drop("__block", "__length")
