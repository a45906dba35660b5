"""Gates: each measures, and raises only when asked to, with all problems named."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rillflow import config


class GateError(RuntimeError):
    """A gate that halts a load. code is the process's exit code of the command-line tools."""

    def __init__(self, message: str, code: int):
        super().__init__(message)
        self.code = code


def judged_readings(rows: DataFrame, series: Sequence[str], date: str, value: str, daily: str, fall: float = config.FALL_TOLERANCE, step: float = config.STEP_TOLERANCE) -> DataFrame:
    """Each day's reading of a running total beside the one before: fell, and residual and broken where the step is of one day.

    Days without a value are no readings; of several readings of a day the least (value, daily) counts. fell is null for the
    first reading; residual and broken are null where the day's own figure is missing or the step is longer.
    """
    day = rows.where(F.col(value).isNotNull() & F.col(date).isNotNull()).groupBy(*series, date).agg(F.min(F.struct(F.col(value).cast("double").alias("v"), F.col(daily).cast("double").alias("d"))).alias("__r"))
    w = W.partitionBy(*series).orderBy(date)
    before, gap = F.lag("__r.v").over(w), F.datediff(F.col(date), F.lag(date).over(w))
    residual = F.when(gap == 1, F.abs((F.col("__r.v") - before) - F.col("__r.d")))
    return day.select(*series, date, F.col("__r.v").alias(value), (F.col("__r.v") < before - fall).alias("fell"), residual.alias("residual"), (residual > step).alias("broken"))


def monotonicity(rows: DataFrame, series: Sequence[str], order: Sequence[str], value: str, tolerance: float = config.FALL_TOLERANCE) -> DataFrame:
    """One row: steps (the first of each series counts), falls beyond the tolerance, and the largest fall of any size."""
    before = F.lag(value).over(W.partitionBy(*series).orderBy(*order))
    stepped = rows.select(F.col(value).alias("v"), before.alias("p"))
    return stepped.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < F.col("p") - tolerance).alias("n_falls"), F.coalesce(F.max(F.when(F.col("v") < F.col("p"), F.col("p") - F.col("v"))), F.lit(0.0)).alias("worst_fall"))


def step_identity(rows: DataFrame, series: Sequence[str], date: str, value: str, daily: str, tolerance: float = config.STEP_TOLERANCE) -> DataFrame:
    """One row: steps of exactly one day, those whose rise differs from the day's own figure, and the worst residual."""
    w = W.partitionBy(*series).orderBy(date)
    stepped = rows.select(F.col(value).alias("v"), F.col(daily).alias("d"), F.lag(value).over(w).alias("p"), F.datediff(F.col(date), F.lag(date).over(w)).alias("gap")).where("gap = 1 and v is not null and p is not null and d is not null")
    residual = F.abs((F.col("v") - F.col("p")) - F.col("d"))
    return stepped.agg(F.count(F.lit(1)).alias("n"), F.count_if(residual > tolerance).alias("n_broken"), F.coalesce(F.max(residual), F.lit(0.0)).alias("worst_residual"))


def cross_check(a: DataFrame, b: DataFrame, key: Sequence[str], left: str, right: str, tolerance: float) -> DataFrame:
    """One row: keys that both statements have, and those on which they differ by more than the tolerance."""
    both = a.select(*key, F.col(left).alias("__a")).join(b.select(*key, F.col(right).alias("__b")), list(key))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("__a") - F.col("__b")) > tolerance).alias("n_differ"))


def share_gate(metrics: DataFrame, bad: str, total: str, limit_pct: float, name: str, code: int = 3) -> float:
    """The bad share in percent; raises if it is strictly above the limit. Without rows it is 0."""
    row = metrics.select(bad, total).first()
    pct = 100.0 * row[0] / row[1] if row[1] else 0.0
    if pct > limit_pct:
        raise GateError(f"{name}: {row[0]} of {row[1]} ({pct:.3f} %), limit {limit_pct} %", code)
    return pct


def reconcile(parts: DataFrame, printed: DataFrame, entity: str, columns: Sequence[str], label: str, count: str, tolerance: float | None = None) -> DataFrame:
    """Sums of the parts beside the printed grand total: of rows labelled Total, the one over the most entities.

    ok: same count, and every residual within the tolerance (by default what rounding of that many figures can make).
    """
    grand = printed.where(F.lower(F.trim(F.col(label))) == "total").agg(F.max_by(F.struct(count, *columns), F.struct(count, *columns)).alias("g"))
    sums = parts.agg(F.count_distinct(entity).alias("n_parts"), *(F.sum(c).alias(f"sum_{c}") for c in columns))
    joined = sums.crossJoin(grand)  # one row each
    allowed = F.lit(tolerance) if tolerance is not None else F.col("n_parts") * 2 * config.ROUNDING
    residual = [F.abs(F.col(f"sum_{c}") - F.col(f"g.{c}")) for c in columns]
    ok = F.coalesce(F.col("n_parts") == F.col(f"g.{count}"), F.lit(False))
    for r in residual:
        ok = ok & F.coalesce(r <= allowed, F.lit(False))
    return joined.select("n_parts", F.col(f"g.{count}").alias("n_printed"), *(r.alias(f"residual_{c}") for r, c in zip(residual, columns, strict=True)), ok.alias("ok"))


def reconcile_days(parts: DataFrame, printed: DataFrame, date: str, entity: str, columns: Sequence[str], label: str, count: str, tolerance: float | None = None) -> DataFrame:
    """reconcile() for each day of the parts: (date, n_parts, n_printed, residual_*, ok).

    ok is false where the day has no printed total, or one of its figures is missing: a day that can't be checked doesn't pass.
    """
    total = printed.where(F.lower(F.trim(F.col(label))) == "total")
    grand = total.groupBy(F.col(date).alias("__day")).agg(F.max_by(F.struct(F.col(count).alias("n"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(columns))), F.struct(count, *columns)).alias("g"))
    sums = parts.groupBy(date).agg(F.count_distinct(entity).alias("n_parts"), *(F.sum(c).alias(f"__sum{k}") for k, c in enumerate(columns)))
    joined = sums.join(grand, F.col(date) == F.col("__day"), "left")
    allowed = F.lit(tolerance) if tolerance is not None else F.col("n_parts") * 2 * config.ROUNDING
    residual = [F.abs(F.col(f"__sum{k}") - F.col(f"g.c{k}")) for k in range(len(columns))]
    ok = F.coalesce(F.col("n_parts") == F.col("g.n"), F.lit(False))
    for r in residual:
        ok = ok & F.coalesce(r <= allowed, F.lit(False))
    return joined.select(date, "n_parts", F.col("g.n").alias("n_printed"), *(r.alias(f"residual_{c}") for r, c in zip(residual, columns, strict=True)), ok.alias("ok"))


def outside_vocabulary(rows: DataFrame, column: str, vocabulary: Sequence[str]) -> DataFrame:
    """Values outside a closed vocabulary, with counts; null is outside."""
    return rows.where(~F.coalesce(F.col(column).isin(*vocabulary), F.lit(False))).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def reasons(*rules: tuple[Column, str]) -> Column:
    """Array of the texts of all rules that hold, in order; null conditions don't hold."""
    return F.array_compact(F.array(*(F.when(condition, F.lit(text)) for condition, text in rules)))


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The text of the first rule that holds, else null."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for condition, text in rules:
        out = out.when(F.coalesce(condition, F.lit(False)), F.lit(text))
    return out


def verify_days(rows: DataFrame, date: str, entity: str, expected: int, vocabularies: dict[str, Sequence[str]]) -> DataFrame:
    """Per day all problems at once: problems array<struct<check, summary>>, empty if none."""
    counts = rows.groupBy(date).agg(F.count(F.lit(1)).alias("__n"), F.count_distinct(entity).alias("__e"), *(F.count_if(~F.coalesce(F.col(c).isin(*v), F.lit(False))).alias(f"__{c}") for c, v in vocabularies.items()))

    def problem(condition: Column, check: str, summary: Column) -> Column:
        return F.when(condition, F.struct(F.lit(check).alias("check"), summary.alias("summary")))

    found = [problem((F.col("__n") != expected) | (F.col("__e") != expected), "row_count", F.format_string("%d rows, %d entities", "__n", "__e"))]
    found += [problem(F.col(f"__{c}") > 0, f"vocabulary:{c}", F.format_string("%d values outside", f"__{c}")) for c in vocabularies]
    return counts.select(date, F.array_compact(F.array(*found)).alias("problems"))


def add_problems(verdicts: DataFrame, date: str, *more: DataFrame) -> DataFrame:
    """verify_days() verdicts with further problems (date, check, summary), after its own and in the order given; days without
    a verdict get one."""
    out = verdicts
    for found in more:
        extra = found.groupBy(F.col(date).alias("__day")).agg(F.array_sort(F.collect_set(F.struct("check", "summary"))).alias("__more"))
        both = out.join(extra, F.col(date) == F.col("__day"), "full_outer")
        none = F.array().cast("array<struct<check:string,summary:string>>")
        out = both.select(F.coalesce(date, "__day").alias(date), F.concat(F.coalesce("problems", none), F.coalesce("__more", none)).alias("problems"))
    return out


def quarantine(rows: DataFrame, verdicts: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """Rows of days without problems, and the others."""
    good = verdicts.where(F.size("problems") == 0).select(date)
    return rows.join(good, date, "left_semi"), rows.join(good, date, "left_anti")


def require_known(found: DataFrame, acknowledged: DataFrame, key: Sequence[str], name: str, code: int = 2) -> None:
    """Raises if anything is found that isn't acknowledged."""
    new = found.join(acknowledged, list(key), "left_anti").select(*key).limit(5).collect()
    if new:
        raise GateError(f"{name}: not acknowledged: {[tuple(r) for r in new]}", code)


def require_complete(spine: DataFrame, *held: DataFrame, date: str = "d", code: int = 3) -> None:
    """Raises if a day of the spine is in none of the held sets."""
    left = spine
    for part in held:
        left = left.join(part.select(date), date, "left_anti")
    missing = [str(r[0]) for r in left.orderBy(date).limit(5).collect()]
    if missing:
        raise GateError(f"missing days: {missing}", code)


def date_agreement(requested: Column, printed: Column) -> Column:
    """Status of a document by its own date line: ok, date_mismatch, or no_date where it has none that reads as a date."""
    from rillflow.functions.seasons import parse_day_first

    own = parse_day_first(printed)
    return F.when(own.isNull(), "no_date").when(own == requested, "ok").otherwise("date_mismatch")


def require_not_absent(day: str, absent: DataFrame, date: str = "d", code: int = 1) -> None:
    """Raises if the day that is reported on is listed as absent: the two can't both be true."""
    if absent.where(F.col(date) == F.lit(day).cast("date")).limit(1).count():
        raise GateError(f"{day} is reported and listed as absent", code)


def canonical_labels(rows: DataFrame, dimension: DataFrame, key: str, label: str) -> DataFrame:
    """rows with `label` as the dimension has it and `repaired`, whether that changed it. Keys that it lacks keep theirs."""
    known = dimension.select(F.col(key).alias("__key"), F.col(label).alias("__label"))
    joined = rows.join(known, F.col(key) == F.col("__key"), "left")
    changed = F.col("__key").isNotNull() & ~F.col(label).eqNullSafe(F.col("__label"))
    return joined.withColumn("repaired", changed).withColumn(label, F.when(changed, F.col("__label")).otherwise(F.col(label))).drop("__key", "__label")


def outside_box(points: DataFrame, lon: str, lat: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Points outside (least lon, least lat, largest lon, largest lat); those without a position are none."""
    return points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull() & ~(F.col(lon).between(box[0], box[2]) & F.col(lat).between(box[1], box[3])))


def require_in_box(points: DataFrame, key: str, lon: str, lat: str, box: tuple[float, float, float, float], code: int = 1) -> None:
    """Raises if a source's point lies outside."""
    bad = outside_box(points, lon, lat, box).select(key).orderBy(key).limit(5).collect()
    if bad:
        raise GateError(f"outside the box: {[r[0] for r in bad]}", code)


def require_total(differences: DataFrame, code: int = 1) -> None:
    """Raises if model.set_audit() finds anything."""
    bad = differences.orderBy("difference", "key").limit(5).collect()
    if bad:
        raise GateError(f"crosswalk not total: {[tuple(r) for r in bad]}", code)


def staleness_days(rows: DataFrame, date: str, today: str) -> int:
    """Days from the newest row to today."""
    newest = rows.agg(F.datediff(F.lit(today).cast("date"), F.max(date)).alias("gap")).first()["gap"]
    if newest is None:
        raise GateError("nothing loaded", 1)
    return newest
