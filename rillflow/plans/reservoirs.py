"""The whole job on daily reservoir reports: ingest, star schema, gates, deviation report, serving document, daily update.

Each step is a function over frames with the knobs of a command line; gates raise GateError with the process's exit code.
Run on other data by renaming columns: nothing here depends on one region's names but the vocabularies.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillflow import config
from rillflow.functions import names, numeric, seasons, text
from rillflow.operators import baseline, capacity, crossover, document, integrity, model
from rillflow.plans.journal import Journal
from rillflow.session import written
from rillflow.sources import daily, layouts

#: Columns of the detail statement, in the order of the wide layout; the narrow one lacks taluka.
DETAIL = (
    "sr_no", "scheme_id", "district", "taluka", "scheme_name", "region", "dam_type", "osl_m", "frl_m", "pwl_m", "design_gross_mcm", "design_live_mcm", "design_dead_mcm", "present_gross_mcm", "present_live_mcm", "present_dead_mcm",
    "pct_filling_src", "rf", "crf", "warning", "inflow_cusecs", "outflow_river_cusecs", "outflow_canal_cusecs", "location_id",
)
TEXT, WHOLE = ("district", "taluka", "scheme_name", "region", "dam_type", "warning"), ("sr_no", "scheme_id", "location_id")
STORAGE = "report_date date, " + ", ".join(f"{c} {'string' if c in TEXT else 'int' if c in WHOLE else 'double'}" for c in DETAIL) + ", source_layout int"
RAIN = "report_date date, scheme_id int, scheme_name string, district string, region_full string, cumm_rainfall_mm double, rain_last_24h_mm double, band_consistent boolean, rain_col0_meaning string"
LEDGER = "report_date date, status string, note string"


def ingest(grids: DataFrame, cells: str = "cells", date: str = "report_date") -> tuple[DataFrame, DataFrame]:
    """Typed rows of the detail statement, and failures (report_date, scheme_id, reason), from extracted cell grids.

    Layouts are told apart by width. A field that can't be read stays null and is named among the failures; a repaired
    warning is named too; unknown labels stay as printed.
    """
    narrow = [c for c in DETAIL if c != "taluka"]
    known, other = layouts.by_width(grids.select(date, cells), cells, {len(DETAIL): DETAIL, len(narrow): narrow})
    rows, headers = layouts.valid_rows(known, "sr_no")
    label = text.repair_label(F.col("warning"), names.WARNINGS)
    region = text.canonical(F.col("region"), names.REGIONS, lambda c: F.upper(text.clean_text(c)))
    district = text.canonical(F.col("district"), names.DISTRICTS)

    def read(c: str) -> Column:
        if c in ("warning", "region", "district"):
            return {"warning": label, "region": region, "district": district}[c]["value"]
        if c in TEXT:
            return text.clean_text(F.col(c))
        return text.to_number(text.clean_number(F.col(c))).cast("int" if c in WHOLE else "double")

    why = [(label["repaired"], F.lit("warning repaired")), (~label["known"], F.lit("warning unknown")), (~region["known"], F.lit("region unknown"))]
    why += [(text.clean_number(F.col(c)).isNotNull() & ~text.clean_number(F.col(c)).isin(*text.NULL_TOKENS) & text.to_number(text.clean_number(F.col(c))).isNull(), F.lit(f"{c} unreadable")) for c in DETAIL if c not in TEXT]
    reasons = F.array_compact(F.array(*(F.when(F.coalesce(cond, F.lit(False)), what) for cond, what in why)))
    typed = rows.select(date, *(read(c).alias(c) for c in DETAIL), F.col("source_layout").cast("int").alias("source_layout"), reasons.alias("__why"))
    failures = typed.select(date, "scheme_id", F.explode("__why").alias("reason"))
    failures = failures.unionByName(headers.where("reason <> 'header'").select(date, F.lit(None).cast("int").alias("scheme_id"), "reason"))
    failures = failures.unionByName(other.select(date, F.lit(None).cast("int").alias("scheme_id"), F.lit("unknown width").alias("reason")))
    return typed.drop("__why"), failures


@dataclass
class Star:
    """storage and rain facts, schemes, ledger and coverage."""

    storage: DataFrame
    rain: DataFrame
    schemes: DataFrame
    ledger: DataFrame
    coverage: DataFrame


def build_star(spark: SparkSession, storage: str, rain: str = "", ledger: str = "") -> Star:
    """The star schema over day files: columns by name, a typed empty frame where files are missing. Raises without storage."""
    if not daily.exists(spark, storage):
        raise integrity.GateError(f"no day files at {storage}", 1)
    raw = daily.scan(spark, storage, STORAGE)
    facts = raw.withColumn("pct_filling", numeric.percent(F.col("present_gross_mcm"), F.col("design_gross_mcm"))).withColumn("days_water_at_release", numeric.days_of_water(F.col("present_live_mcm"), F.col("outflow_canal_cusecs")))
    wet = daily.scan(spark, rain, RAIN) if rain else spark.createDataFrame([], RAIN)
    log = (daily.read_csv(spark, ledger, LEDGER, ["report_date", "status"]) if ledger and daily.exists(spark, ledger) else None) or spark.createDataFrame([], LEDGER)
    schemes = model.dimension_with_drift(facts, "scheme_id", ["report_date"], ["scheme_name", "district", "region", "design_gross_mcm", "design_live_mcm"], {"scheme_name": "n_name_variants", "district": "n_district_variants", "design_gross_mcm": "n_design_variants"})
    covered = model.coverage(facts, "report_date", "scheme_id", {"n_releasing": F.col("outflow_canal_cusecs") > 0, "n_alert": F.col("warning") != "NIL", "n_no_design": F.col("design_gross_mcm").isNull()})
    star = Star(facts, wet, schemes, log, covered.join(log.select("report_date", "status"), "report_date", "full_outer"))
    daily.publish(facts, {"fact_storage": None})
    daily.publish(wet, {"fact_rainfall": None})
    daily.publish(schemes, {"dim_scheme": None})
    daily.publish(star.coverage, {"v_coverage": None})
    return star


def check_capacity(storage: DataFrame, acknowledged: DataFrame | None = None, *, eps: float = config.CAPACITY_EPS, edge_max_days: int = config.EDGE_MAX_DAYS, out_dir: str | None = None, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """Season capacities (gross and live) and restatements; raises (2) on a mid-season change that isn't acknowledged.

    Only months of the season and rows with a gross design count; live never trips the gate.
    """
    rows = storage.where(seasons.in_season(F.col("report_date")) & F.col("design_gross_mcm").isNotNull()).withColumn("season", F.year("report_date"))
    key, order = ["scheme_id", "season"], ["report_date"]
    gross = capacity.classify(rows, key, order, "design_gross_mcm", eps, edge_max_days).withColumnRenamed("capacity", "season_capacity_mcm")
    live = capacity.classify(rows, key, order, "design_live_mcm", eps, edge_max_days).select(*key, F.col("capacity_class").alias("live_capacity_class"), F.col("capacity").alias("season_live_capacity_mcm"))
    dates = rows.groupBy(*key).agg(F.min("report_date").alias("first_date"), F.max("report_date").alias("last_date"), F.max_by("scheme_name", "report_date").alias("scheme_name"))
    found = gross.join(live, key).join(dates, key)
    changes = capacity.restatements(found, "scheme_id", "season", "season_capacity_mcm", "first_date", "last_date", eps)
    if out_dir:
        for name, frame in (("season_capacity", found), ("capacity_restatements", changes)):
            daily.write_csv(frame, f"{out_dir}/{name}.csv", dry_run)
    odd = found.where("capacity_class = 'mid_season'").select(*key)
    integrity.require_known(odd, acknowledged if acknowledged is not None else odd.limit(0), key, "capacity changed in mid-season")
    return found, changes


def check_rainfall(storage: DataFrame, rain: DataFrame, *, max_backward_pct: float = config.MAX_BACKWARD_PCT, max_disagree_pct: float = config.MAX_DISAGREE_PCT, max_step_break_pct: float = config.MAX_STEP_BREAK_PCT) -> DataFrame:
    """One row per test; raises (3) if one is above its limit. The running total never falls, two statements agree, and a
    day's rise is the day's own figure."""
    wet = storage.where(seasons.in_season(F.col("report_date")) & F.col("crf").isNotNull()).select("scheme_id", "report_date", "crf", F.coalesce("rf", F.lit(0.0)).alias("rf"), F.year("report_date").alias("season"))
    falls = integrity.monotonicity(wet, ["scheme_id", "season"], ["report_date"], "crf")
    agree = integrity.cross_check(wet, rain.where("cumm_rainfall_mm is not null"), ["report_date", "scheme_id"], "crf", "cumm_rainfall_mm", 1.0)
    steps = integrity.step_identity(wet, ["scheme_id", "season"], "report_date", "crf", "rf")
    out = []
    for test, frame, bad, limit in (("backward", falls, "n_falls", max_backward_pct), ("disagree", agree, "n_differ", max_disagree_pct), ("step", steps, "n_broken", max_step_break_pct)):
        out.append((test, integrity.share_gate(frame, bad, "n", limit, f"rainfall {test}"), limit))
    return storage.sparkSession.createDataFrame(out, "test string, pct double, limit_pct double")


def _target(storage: DataFrame, date: str | None) -> str:
    """The date asked for, or the newest one in season; raises (1) off season."""
    if date is None:
        newest = storage.where(seasons.in_season(F.col("report_date"))).agg(F.max("report_date")).first()[0]
        if newest is None:
            raise integrity.GateError("nothing loaded in season", 1)
        return str(newest)
    if not config.SEASON_MONTHS[0] <= int(date[5:7]) <= config.SEASON_MONTHS[1]:
        raise integrity.GateError(f"{date} is off season", 1)
    return date


def season_release(storage: DataFrame, target: Column) -> DataFrame:
    """(scheme_id, release_mcm): what left a scheme in the target's season up to the day, each report's flow for one day;
    unknown flows count as 0, and only here."""
    rows = storage.where(seasons.season_to_date(F.col("report_date"), target) & (F.year("report_date") == F.year(target)))
    flow = F.coalesce("outflow_river_cusecs", F.lit(0.0)) + F.coalesce("outflow_canal_cusecs", F.lit(0.0))
    return rows.groupBy("scheme_id").agg((F.sum(flow) * config.CUSEC_DAY_MCM_INTEGRAL).alias("release_mcm"))


def report_deviation(storage: DataFrame, season_capacity: DataFrame, date: str | None = None, *, top: int = 20, eps: float = config.CAPACITY_EPS) -> dict[str, DataFrame]:
    """today (each scheme beside its comparable years, gross and live), worst (ranked), orphans, regions and state on the day.

    Live deviations have a like-for-like test on live capacities of their own. worst is ranked by them where every scheme has
    one, else by gross ones; its column ranked_by says which. A shortfall is of live capacity where that and the live deviation
    are known, and release_covers the share of it that the season's release makes up.
    """
    day = _target(storage, date)
    target = F.lit(day).cast("date")
    live = ["season_live_capacity_mcm", "live_capacity_class"]
    have = [c for c in live if c in season_capacity.columns]
    caps = season_capacity.select("scheme_id", "season", "season_capacity_mcm", (F.col("capacity_class") == "mid_season").alias("mid"), *have)
    for c in live:
        if c not in have:
            caps = caps.withColumn(c, F.lit(None).cast("double" if c.endswith("mcm") else "string"))
    caps = caps.withColumn("live_mid", F.coalesce(F.col("live_capacity_class") == "mid_season", F.lit(False)))
    rows = storage.withColumn("season", F.year("report_date")).withColumn("live_pct", numeric.percent(F.col("present_live_mcm"), F.col("design_live_mcm"))).join(caps, ["scheme_id", "season"], "left")
    today = rows.where(F.col("report_date") == target)
    prior = rows.where(seasons.same_calendar_date(F.col("report_date"), target))

    def found(capacity: str, pct: str, mid: str) -> DataFrame:
        marked = baseline.comparable(prior.where(F.col(pct).isNotNull()).select("scheme_id", "season", capacity, pct, mid), today.select("scheme_id", capacity), "scheme_id", capacity, mid, eps)
        return baseline.baseline(marked, "scheme_id", "season", pct)

    out = baseline.deviations(today.select("scheme_id", "scheme_name", "district", "region", "season_capacity_mcm", "pct_filling", "live_pct", "design_live_mcm", "days_water_at_release"), found("season_capacity_mcm", "pct_filling", "mid"), "scheme_id", "pct_filling")
    alive = found("season_live_capacity_mcm", "live_pct", "live_mid").select("scheme_id", F.col("n_used").alias("live_years"), F.col("prior_mean").alias("live_mean"))
    out = out.join(alive, "scheme_id", "left").withColumn("live_deviation", F.when(F.col("live_years") > 0, F.col("live_pct") - F.col("live_mean"))).drop("live_years", "live_mean")
    gross_short, live_short = baseline.shortfall(F.col("deviation"), F.col("season_capacity_mcm")), baseline.shortfall(F.col("live_deviation"), F.col("design_live_mcm"))
    out = out.withColumn("shortfall_mcm", gross_short).withColumn("live_shortfall_mcm", live_short).join(season_release(storage, target), "scheme_id", "left")
    out = written(out.withColumn("release_covers", baseline.coverage(F.col("release_mcm"), F.col("live_shortfall_mcm"))), "deviation")
    by = baseline.rank_column(out, "live_deviation", "deviation")
    region = today.groupBy("region").agg(F.count(F.lit(1)).alias("n"), numeric.percent(F.sum("present_gross_mcm"), F.sum("design_gross_mcm")).alias("pct"))
    years = rows.where((F.col("report_date") == target) | seasons.same_calendar_date(F.col("report_date"), target)).groupBy("season").agg(numeric.percent(F.sum("present_gross_mcm"), F.sum("design_gross_mcm")).alias("pct"), F.count(F.lit(1)).alias("n"))
    return {"today": out, "worst": baseline.ranked(out, by, "scheme_id", top).withColumn("ranked_by", F.lit(by)), "orphans": out.where("orphan").select("scheme_id", "years_dropped"), "regions": region, "state": years}


def _season_series(storage: DataFrame, season_capacity: DataFrame, target: Column, n_priors: int) -> DataFrame:
    """Per region, season and day of season: present over season capacities, today's substituted where one is missing."""
    caps = season_capacity.select("scheme_id", "season", "season_capacity_mcm")
    now = storage.where(F.col("report_date") == target).select("scheme_id", F.col("design_gross_mcm").alias("__now"))
    rows = storage.where(seasons.in_season(F.col("report_date")) & (F.year("report_date") >= F.year(target) - n_priors) & (F.col("report_date") <= target)).withColumn("season", F.year("report_date"))
    joined = rows.join(caps, ["scheme_id", "season"], "left").join(now, "scheme_id", "left")
    base = F.coalesce("season_capacity_mcm", "__now")
    return joined.groupBy("region", "season", seasons.day_of_season(F.col("report_date")).cast("int").alias("dos")).agg(F.sum("present_gross_mcm").alias("mcm"), F.sum(base).alias("base_mcm"), F.count_if(F.col("season_capacity_mcm").isNull()).alias("n_substituted"), numeric.percent(F.sum("present_gross_mcm"), F.sum(base)).alias("pct"))


def build_view(star: Star, season_capacity: DataFrame, date: str | None = None, *, n_priors: int = 4, min_run: int = config.CROSSOVER_MIN_RUN) -> DataFrame:
    """The serving document, one row of JSON: meta, state, regions with series and crossover, ranked deviations, quadrants.

    All regions come from one grouped query. Nulls are written out.
    """
    day = _target(star.storage, date)
    target, year = F.lit(day).cast("date"), int(day[:4])
    series = _season_series(star.storage, season_capacity, target, n_priors).where("pct is not null")
    state = series.groupBy("season", "dos").agg(numeric.percent(F.sum("mcm"), F.sum("base_mcm")).alias("pct")).withColumn("region", F.lit("all"))

    def told(rows: DataFrame) -> DataFrame:
        days = crossover.evaluable_days(rows.where(F.col("season") == year), rows.where(F.col("season") < year), "region", "dos", "season", "pct", n_priors)
        cross = crossover.crossover(rows.select("region").distinct(), days, "region", "dos", min_run)
        return document.attach(document.nested_series(rows, "region", "season", "dos", "pct"), cross, "region", "crossover")

    report = report_deviation(star.storage, season_capacity, day)
    rain_now = star.storage.where(F.col("report_date") == target).select("scheme_id", "crf")
    rain_before = star.storage.where(seasons.same_calendar_date(F.col("report_date"), target)).groupBy("scheme_id").agg(F.avg("crf").alias("crf_mean"))
    schemes = report["today"].join(rain_now, "scheme_id").join(rain_before, "scheme_id", "left").withColumn("rain_dev_pct", baseline.proportional(F.col("crf"), F.col("crf_mean")))
    schemes = schemes.withColumn("quadrant", numeric.quadrant(F.col("rain_dev_pct"), F.coalesce("live_deviation", "deviation"), config.RAIN_BAND, config.STORAGE_BAND))
    counts = schemes.groupBy("quadrant").agg(F.count(F.lit(1)).alias("n"))
    meta = star.storage.agg(F.struct(F.lit(day).alias("report_date"), F.count_distinct("report_date").alias("dates_loaded"), F.count_distinct("scheme_id").alias("n_schemes"), F.min("report_date").cast("string").alias("first"), F.max("report_date").cast("string").alias("last")).alias("meta"))
    worst = report["worst"].select("deviation", "scheme_id", "scheme_name", "pct_filling", "prior_mean", "live_deviation", "ranked_by")
    volume = baseline.ranked(report["today"], "shortfall_mcm", "scheme_id", 10, largest=True).select("shortfall_mcm", "scheme_id", "scheme_name")
    columns = ["scheme_id", "scheme_name", "region", "pct_filling", "deviation", "years_used", "years_dropped", "rain_dev_pct", "quadrant", "live_pct", "live_deviation", "live_shortfall_mcm", "release_mcm", "release_covers", "days_water_at_release"]
    return document.to_document(("meta", meta), ("state", document.records(told(state), "region")), ("regions", document.records(told(series.select("region", "season", "dos", "pct")), "region")), ("deviation_pp", document.records(worst, "deviation", "scheme_id")), ("deviation_volume", document.records(volume, "shortfall_mcm", "scheme_id")), ("schemes", document.records(schemes.select(*columns), "scheme_id")), ("quadrants", document.records(counts, "quadrant")))


#: Figures of the statement that the printed grand total repeats.
RECONCILED = ("design_gross_mcm", "present_gross_mcm")


def rain_failures(rain: DataFrame) -> DataFrame:
    """(report_date, scheme_id, reason) of rain rows that contradict themselves: a running total below the day's own figure."""
    holds = numeric.total_holds(F.col("cumm_rainfall_mm"), F.col("rain_last_24h_mm"))
    reason = F.format_string("cumulative rainfall %s is less than the 24-hour figure %s", "cumm_rainfall_mm", "rain_last_24h_mm")
    return rain.where(~holds).select("report_date", "scheme_id", reason.alias("reason"))


def day_problems(rows: DataFrame, *, printed: DataFrame | None = None, documents: DataFrame | None = None, rain: DataFrame | None = None) -> list[DataFrame]:
    """Problems (report_date, check, summary) of whole days beyond counts and vocabularies.

    printed: (report_date, label, n_schemes, design_gross_mcm, present_gross_mcm), the abstract's rows, whose total the day's
    rows must make. documents: (report_date, date_line), whose own date must be the day. rain: rows of the rain statement.
    """
    out = []
    if printed is not None:
        bad = integrity.reconcile_days(rows, printed, "report_date", "scheme_id", RECONCILED, "label", "n_schemes").where(~F.col("ok"))
        why = F.when(F.col("n_printed").isNull(), "no total printed").otherwise(F.concat_ws(", ", F.format_string("%d of %d schemes", "n_parts", "n_printed"), *(F.format_string(f"{c} off by %.3f", f"residual_{c}") for c in RECONCILED)))
        out.append(bad.select("report_date", F.lit("reconcile").alias("check"), why.alias("summary")))
    if documents is not None:
        status = integrity.date_agreement(F.col("report_date"), F.col("date_line"))
        # a document without a readable date says nothing against the day
        out.append(documents.where(status == "date_mismatch").select("report_date", F.lit("date").alias("check"), F.format_string("the document says %s", "date_line").alias("summary")))
    if rain is not None:
        out.append(rain_failures(rain).groupBy("report_date").agg(F.count(F.lit(1)).alias("n")).select("report_date", F.lit("rain").alias("check"), F.format_string("%d running totals below their day", "n").alias("summary")))
    return out


def load_days(rows: DataFrame, path: str, *, expected: int = config.EXPECTED_ENTITIES, printed: DataFrame | None = None, documents: DataFrame | None = None, rain: DataFrame | None = None, districts: DataFrame | None = None) -> DataFrame:
    """Verifies whole days and writes those without problems, replacing only them; returns all verdicts (date, problems).

    districts: (scheme_id, district) as they are to be; labels that drifted from them are put right before anything is judged.
    The others are those of day_problems().
    """
    if districts is not None:
        rows = integrity.canonical_labels(rows, districts, "scheme_id", "district").drop("repaired")
    judged = integrity.verify_days(rows, "report_date", "scheme_id", expected, {"warning": names.WARNINGS, "region": tuple(dict.fromkeys(names.REGIONS.values()))})
    verdicts = written(integrity.add_problems(judged, "report_date", *day_problems(rows, printed=printed, documents=documents, rain=rain)), "verdicts")
    good, _ = integrity.quarantine(rows, verdicts, "report_date")
    daily.write_days(good, path)
    return verdicts


def work_list(spine: DataFrame, held: DataFrame, ledger: DataFrame, absent: DataFrame, date: str = "report_date") -> DataFrame:
    """Days to parse: wanted and not known absent, and either not held or held without an ok in the ledger."""
    ok = held.select(date).join(ledger.where("status like 'ok%'").select(date), date, "left_semi")
    return spine.select(date).join(absent.select(date), date, "left_anti").join(ok, date, "left_anti")


def confirm_flip(storage: DataFrame, transitions: DataFrame, before: str, after: str, eps: float = config.CAPACITY_EPS) -> DataFrame:
    """Whether each scheme of the transitions (scheme_id, value_before, value_after) reads the old value on one day and the
    new one on the other; null where a day lacks it."""
    at = lambda day, name: storage.where(F.col("report_date") == F.lit(day).cast("date")).select("scheme_id", F.col("design_gross_mcm").alias(name))
    both = transitions.join(at(before, "__b"), "scheme_id", "left").join(at(after, "__a"), "scheme_id", "left")
    near = lambda x, y: F.abs(F.col(x) - F.col(y)) <= eps * F.abs(F.col(y))
    return both.select("scheme_id", (near("__b", "value_before") & near("__a", "value_after")).alias("flipped"))


def update_day(spark: SparkSession, rows: DataFrame, path: str, *, rain: str = "", today: str, expected: int = config.EXPECTED_ENTITIES, max_stale_days: int = config.MAX_STALE_DAYS, acknowledged: DataFrame | None = None, printed: DataFrame | None = None, documents: DataFrame | None = None, rain_rows: DataFrame | None = None, districts: DataFrame | None = None, absent: DataFrame | None = None) -> Star:
    """One day's rows in: verified, written, and the loaded data held to every gate.

    Raises (4) if a day fails one of load_days()'s checks, and (1) if a day that came is listed in absent (report_date).
    """
    if absent is not None:
        for (day,) in rows.select("report_date").distinct().join(absent.select("report_date"), "report_date", "left_semi").orderBy("report_date").limit(1).collect():
            integrity.require_not_absent(str(day), absent, "report_date")
    bad = load_days(rows, path, expected=expected, printed=printed, documents=documents, rain=rain_rows, districts=districts).where(F.size("problems") > 0).orderBy("report_date").limit(5).collect()
    if bad:
        raise integrity.GateError(f"unverified days: {[(str(r[0]), [p['check'] for p in r['problems']]) for r in bad]}", 4)
    star = build_star(spark, path, rain)
    check_capacity(star.storage, acknowledged)
    check_rainfall(star.storage, star.rain)
    if (gap := integrity.staleness_days(star.storage, "report_date", today)) > max_stale_days:
        raise integrity.GateError(f"newest day is {gap} days old", 1)
    return star


def resume_update(spark: SparkSession, rows: DataFrame, path: str, journal: str, out_dir: str, *, rain: str = "", today: str, top: int = 20, acknowledged: DataFrame | None = None, **checks) -> dict[str, int]:
    """A load in steps that a journal remembers: load (verified days written), gates, report (worst and orphans as CSV).

    A run that died goes on with the step it died in, and one that is done does nothing; rows that differ in anything are
    another load. A gate that trips leaves a halt, and nothing runs until Journal.lift(). checks are those of load_days().
    Each step's number: rows loaded, capacities classified, schemes ranked.
    """
    book = Journal(spark, journal)
    # the same rows in any order have the same sums
    mark = rows.select(F.xxhash64(*rows.columns).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod("h", F.lit(1_000_000_007))).alias("a"), F.sum(F.pmod("h", F.lit(998_244_353))).alias("b")).first()
    key = {"path": path, "rows": [mark["n"], mark["a"], mark["b"]]}

    def load() -> int:
        verdicts = load_days(rows, path, **checks)
        bad = verdicts.where(F.size("problems") > 0).orderBy("report_date").limit(5).collect()
        if bad:
            raise integrity.GateError(f"unverified days: {[(str(r[0]), [p['check'] for p in r['problems']]) for r in bad]}", 4)
        return mark["n"]

    def gates() -> int:
        star = build_star(spark, path, rain)
        found, _ = check_capacity(star.storage, acknowledged)
        check_rainfall(star.storage, star.rain)
        return found.count()

    def report() -> int:
        star = build_star(spark, path, rain)
        caps, _ = check_capacity(star.storage, acknowledged)
        out = report_deviation(star.storage, caps, today, top=top)
        daily.write_csv(out["worst"].select("scheme_id", "deviation", "live_deviation", "ranked_by"), f"{out_dir}/worst.csv")
        daily.write_csv(out["orphans"], f"{out_dir}/orphans.csv")
        return out["today"].count()

    return {"load": book.step("load", key, load), "gates": book.step("gates", key, gates), "report": book.step("report", {**key, "today": today, "top": top}, report)}


def run_pipeline(spark: SparkSession, storage: str, rain: str = "", *, date: str | None = None, top: int = 20, acknowledged: DataFrame | None = None, out_dir: str | None = None, after: Sequence[Callable[[Star], None]] = ()) -> tuple[dict[str, DataFrame], DataFrame]:
    """Star schema, both gates, report and document, in order; the first gate that trips halts the rest."""
    star = build_star(spark, storage, rain)
    caps, _ = check_capacity(star.storage, acknowledged, out_dir=out_dir)
    check_rainfall(star.storage, star.rain)
    report = report_deviation(star.storage, caps, date, top=top)
    view = build_view(star, caps, date)
    for step in after:
        step(star)
    return report, view
