"""Queries: the same calendar date in prior years, live and gross; gates, audits and guards of a load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillflow.functions import names, numeric, seasons, text
from rillflow.operators import baseline, document, integrity, matching, model
from rillflow.plans import reservoirs
from rillflow.plans.facts import FACT, TARGET, fact
from rillflow.plans.matching_q import micro
from rillflow.sources import layouts
from rillflow.sources.tables import table

#: Share by which orders of two seasons may differ and still be compared.
EPS = 0.25


def _report(spark: SparkSession, sf_dir: str, preferred: str = "live") -> tuple[DataFrame, DataFrame, str]:
    """Regions on the target's calendar date: today's rows and prior ones, each with gross and live capacity of its season.

    A region's capacity is its season's orders up to the day, live ones those not of low priority; the day's store is what it
    took in.
    """
    rows = fact(spark, sf_dir).where(seasons.season_to_date(F.col("d"), F.lit(TARGET).cast("date")))
    live = F.col("o_orderpriority") != "5-LOW"
    caps = rows.groupBy("region", "season").agg(F.count(F.lit(1)).cast("double").alias("gross"), F.count_if(live).cast("double").alias("live"))
    days = rows.groupBy("region", "season", "d").agg(F.count(F.lit(1)).cast("double").alias("n"), F.count_if(live).cast("double").alias("n_live"))
    # one region reports no live figures
    held = days.join(caps, ["region", "season"]).withColumn("live", F.when(F.col("region") != "ASIA", F.col("live")))
    held = held.withColumn("gross_pct", numeric.percent(F.col("n"), F.col("gross"))).withColumn("live_pct", numeric.percent(F.col("n_live"), F.col("live")))
    target = F.lit(TARGET).cast("date")
    return held.where(F.col("d") == target), held.where(seasons.same_calendar_date(F.col("d"), target)), preferred


def _told(today: DataFrame, prior: DataFrame, capacity: str, pct: str) -> DataFrame:
    marked = baseline.comparable(prior.where(F.col(pct).isNotNull()).select("region", "season", capacity, pct), today.select("region", capacity), "region", capacity, None, EPS)
    return baseline.deviations(today.select("region", capacity, pct, "n", "n_live"), baseline.baseline(marked, "region", "season", pct), "region", pct)


def same_calendar_date_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each region on the target's day beside the same calendar date of comparable years: mean, deviation, shortfall and the
    share of it that the day's live intake makes up."""
    today, prior, _ = _report(spark, sf_dir)
    out = _told(today, prior, "gross", "gross_pct")
    short = baseline.shortfall(F.col("deviation"), F.col("gross"))
    return out.select("region", micro(F.col("gross_pct")).alias("pct_micro"), micro(F.col("prior_mean")).alias("mean_micro"), micro(F.col("deviation")).alias("deviation_micro"), F.coalesce("n_used", F.lit(0)).cast("long").alias("n_used"), "years_used", "orphan", micro(short).alias("short_micro"), F.round(baseline.coverage(F.col("n_live"), short) * 100).cast("long").alias("coverage_pct"))


def live_capacity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on live capacities, with a like-for-like test of their own, ranked by live deviations if every region has one,
    else by gross ones."""
    today, prior, _ = _report(spark, sf_dir)
    gross = _told(today, prior, "gross", "gross_pct").select("region", F.col("deviation").alias("gross_dev"))
    live = _told(today, prior, "live", "live_pct").select("region", F.col("deviation").alias("live_dev"), F.coalesce("n_used", F.lit(0)).cast("long").alias("n_live_years"))
    both = gross.join(live, "region")
    by = baseline.rank_column(both, "live_dev", "gross_dev")
    ranked = both.withColumn("ranked_by", F.lit(by)).withColumn("rank_micro", micro(F.col(by)))
    return ranked.select("region", micro(F.col("gross_dev")).alias("gross_micro"), micro(F.col("live_dev")).alias("live_micro"), "n_live_years", "ranked_by", "rank_micro")


def days_of_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long a balance lasts at a flow; null without one, and a share whose denominator is never below one."""
    c = table(spark, sf_dir, "customer")
    flow = (F.col("c_custkey") % 4).cast("double") * 100
    return c.select("c_custkey", micro(numeric.days_of_water(F.col("c_acctbal"), flow)).alias("days_micro"), (F.floor(F.col("c_acctbal") / numeric.at_least_one(F.col("c_custkey") % 3))).cast("long").alias("share"))


def total_below_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rain rows made of order lines whose running total is below the day's own figure, with the reason."""
    line = table(spark, sf_dir, "lineitem")
    rain = line.select(F.to_date("l_shipdate").alias("report_date"), F.col("l_orderkey").alias("scheme_id"), F.when(F.col("l_linenumber") < 6, F.floor("l_quantity").cast("int")).alias("cumm_rainfall_mm"), (F.col("l_linenumber") * 5).cast("int").alias("rain_last_24h_mm"))
    return reservoirs.rain_failures(rain)


def day_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of each day against totals printed for it: some without one, some off by more than rounding can make."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.lit(1).alias("one"))
    k = F.dayofmonth("day")
    sums = o.groupBy("day").agg(F.count_distinct("o_orderkey").alias("n"), F.sum("price").alias("price"), F.sum("one").alias("one"))
    printed = sums.where(k % 7 != 0).select("day", F.when(k % 2 == 0, " TOTAL ").otherwise("Total").alias("label"), (F.col("n") + (k % 11 == 0).cast("int")).alias("n"), (F.col("price") + F.when(k % 5 == 0, 1000).otherwise(0)).alias("price"), F.col("one"))
    part = printed.withColumn("label", F.lit("a part")).withColumn("n", F.col("n") + 1)
    smaller = printed.withColumn("n", F.lit(0).cast("long")).withColumn("price", F.lit(-1).cast("decimal(18,2)"))
    found = integrity.reconcile_days(o, printed.unionByName(part).unionByName(smaller), "day", "o_orderkey", ["price", "one"], "label", "n")
    return found.select("day", "n_parts", "n_printed", F.col("residual_price").cast("double").alias("residual_price"), "ok")


def date_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a document's own date line names the day that was asked for."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    k = F.col("o_orderkey") % 6
    line = F.when(k == 0, F.concat(F.lit("Date :- "), F.date_format(F.date_add("d", 1), "dd-MM-yyyy"))).when(k == 1, F.lit("no date here")).when(k == 2, F.lit("Date: 31-02-2001")).when(k == 3, F.lit(None).cast("string")).otherwise(F.concat(F.lit("report of DATE :"), F.date_format("d", "dd-MM-yyyy"), F.lit(" (final)")))
    return o.select("o_orderkey", integrity.date_agreement(F.col("d"), line).alias("status"))


def contradicted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that are reported and listed as absent: the report on such a day is refused."""
    rows = fact(spark, sf_dir)
    held = rows.where("nation = 'NATION_6'").select("d").distinct()
    absent = rows.where("nation = 'NATION_7'").select("d").distinct()
    first = held.agg(F.min("d")).first()[0]
    refused = False
    try:
        integrity.require_not_absent(str(first), absent)
    except integrity.GateError:
        refused = True
    return held.join(absent, "d", "left_semi").select("d", (F.lit(refused) & (F.col("d") == F.lit(first))).alias("refused"))


def label_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that drifted from their canonical form, put right and marked."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 4 == 0, F.lower("c_mktsegment")).when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("label"))
    canonical = table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select("c_custkey", F.col("c_mktsegment").alias("label"))
    return integrity.canonical_labels(c, canonical, "c_custkey", "label").select("c_custkey", "label", "repaired")


def outside_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points outside the box; a load that has one is refused."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, (F.col("c_custkey") % 50).cast("double")).alias("lon"), (F.col("c_custkey") % 31).cast("double").alias("lat"))
    box = (2.0, 1.0, 45.0, 29.0)
    halted = False
    try:
        integrity.require_in_box(c, "c_custkey", "lon", "lat", box)
    except integrity.GateError:
        halted = True
    return integrity.outside_box(c, "lon", "lat", box).withColumn("halted", F.lit(halted))


def crosswalk_totality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four differences between two sets and the crosswalk between them; any of them halts a load."""
    old = table(spark, sf_dir, "supplier").where("s_suppkey % 11 <> 0").select(F.col("s_suppkey").alias("old"))
    new = table(spark, sf_dir, "customer").where("c_custkey % 13 <> 0").select(F.col("c_custkey").alias("new"))
    walk = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("old"), (F.col("p_partkey") + 1).alias("new"))
    found = model.set_audit(old_not_in_crosswalk=(old, walk, "old"), crosswalk_not_in_old=(walk, old, "old"), new_not_in_crosswalk=(new, walk, "new"), crosswalk_not_in_new=(walk, new, "new"))
    halted = False
    try:
        integrity.require_total(found)
    except integrity.GateError:
        halted = True
    return found.withColumn("halted", F.lit(halted))


def id_cross_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose printed id isn't what their name resolves to."""
    p = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 10 == 0, F.col("c_custkey") + 1).when(F.col("c_custkey") % 17 == 0, F.lit(None).cast("long")).otherwise(F.col("c_custkey")).alias("printed"), F.col("c_name").alias("name"))
    named = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("resolved"))
    return matching.id_mismatches(p, named, "printed", "name", "resolved").select("c_custkey", "printed", "by_name")


SPELLINGS = ("Kachchh", "  MAHESANA ", "Devbhumi  Dwarka", "Rajkot", "", "Sabar Kantha", "Dohad")


def parent_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts by the names of older pages, joined to their number."""
    spelt = F.element_at(F.array(*(F.lit(s) for s in SPELLINGS)), (F.col("c_custkey") % len(SPELLINGS) + 1).cast("int"))
    c = table(spark, sf_dir, "customer").select("c_custkey", text.parent_district(spelt).alias("district"))
    known = spark.createDataFrame([("kutch", 1), ("mehsana", 2), ("jamnagar", 3), ("rajkot", 4), ("sabarkantha", 5)], "district string, number int")
    return c.join(known, "district", "left").select("c_custkey", "district", "number")


def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of a closed vocabulary and districts of an open one."""
    region = F.element_at(F.array(*(F.lit(s) for s in ("south gujarat", " NG ", "Kachchh", "Nowhere  Land", "SAU"))), (F.col("c_custkey") % 5 + 1).cast("int"))
    district = F.element_at(F.array(*(F.lit(s) for s in ("D.B. Dwarka", "aravalli", "Mehsana", "New  Town"))), (F.col("c_custkey") % 4 + 1).cast("int"))
    c = table(spark, sf_dir, "customer").select("c_custkey", text.canonical(region, names.REGIONS, lambda x: F.upper(text.clean_text(x))).alias("r"), text.canonical(district, names.DISTRICTS).alias("d"))
    return c.select("c_custkey", F.col("r.value").alias("region"), F.col("r.known").alias("region_known"), F.col("d.value").alias("district"), F.col("d.known").alias("district_known"))


def key_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a compound key, a prefix flag, and the band of a category."""
    c = table(spark, sf_dir, "customer")
    key = F.concat_ws("-", F.lit("11"), F.col("c_nationkey").cast("string"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey").cast("string")))
    band = text.band_of(F.when(F.col("c_custkey") % 8 != 0, F.substring("c_mktsegment", 1, 1)), {"deficit": ("A", "B"), "surplus": ("F", "M")})
    return c.select("c_custkey", text.key_part(key, 1).alias("second"), text.key_part(key, 2).alias("third"), text.has_prefix(text.key_part(key, 1), "1").alias("first_is_one"), band.alias("band"))


def header_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which id a heading promises, and how many villages a cell lists."""
    n = table(spark, sf_dir, "customer")
    heading = F.element_at(F.array(F.lit("Sr.\nNo"), F.lit("SR NO."), F.lit("Scheme  ID"), F.lit("Name")), (F.col("c_custkey") % 4 + 1).cast("int"))
    cell = F.array_join(F.slice(F.array(F.lit("Alpha"), F.lit(" "), F.lit("Beta"), F.lit("Gamma"), F.lit("")), F.lit(1), (F.col("c_custkey") % 6).cast("int")), ",")
    return n.select("c_custkey", text.header_kind(heading).alias("kind"), text.count_listed(cell, 6).cast("int").alias("villages"))


def group_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, median and sample deviation per kind of event."""
    mean, median, sd = numeric.moments(F.col("value"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(micro(mean).alias("mean_micro"), micro(median).alias("median_micro"), micro(sd).alias("sd_micro"))


def children_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions with their nations as a JSON array, empty text where none qualifies."""
    child = table(spark, sf_dir, "nation").where("n_nationkey > 6").select(F.col("n_regionkey").alias("r_regionkey"), "n_nationkey", F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name")).alias("n_name"))
    return document.children(table(spark, sf_dir, "region").select("r_regionkey", "r_name"), child.where("r_regionkey <> 4"), "r_regionkey", "n_nationkey")


def string_date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days as text in windows that are open at one end, at the other, or at neither."""
    o = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    flags = {"since": ("2000-06-01", None), "until": (None, "1996-02-29"), "within": ("1998-01-01", "1998-12-31")}
    return o.groupBy(F.substring("d", 1, 4).alias("year")).agg(*(F.count_if(seasons.in_window(F.col("d"), *w)).alias(n) for n, w in flags.items()))


def fallback_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by ruled lines, and by alignment for pages without any."""
    p = table(spark, sf_dir, "part").select((F.col("p_partkey") % 50).alias("page"), "p_partkey", "p_name")
    return layouts.with_fallback(p.where("page % 3 <> 0"), p.where("p_partkey % 2 = 0"), "page")


def quarantined_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that pass all checks and days kept apart, with their rows: none is lost."""
    rows = fact(spark, sf_dir).groupBy("d", "region").agg(F.min("o_orderpriority").alias("p"))
    verdicts = integrity.verify_days(rows, "d", "region", 5, {"p": ("1-URGENT", "2-HIGH")})
    good, bad = integrity.quarantine(rows, verdicts, "d")
    count = lambda part, kind: part.groupBy("d").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
    return count(good, "kept").unionByName(count(bad, "quarantined"))


def gate_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which gates halt a load, each tried as the job runs it: rises, agreement, capacity changes, completeness, season, staleness."""
    rows = fact(spark, sf_dir)
    days = rows.groupBy("region", "season", "d").agg(F.count(F.lit(1)).cast("double").alias("v"))
    storage = days.select(F.col("d").alias("report_date"), F.col("region").alias("scheme_id"), F.col("v").alias("design_gross_mcm"))
    known = rows.groupBy("nation").agg(F.count(F.lit(1)).alias("n"))
    spine = seasons.spine(spark, "2000-06-01", "2000-06-30")
    held = rows.where("nation = 'NATION_6'").select("d").distinct()
    tries = {
        "backward_loose": lambda: integrity.share_gate(integrity.monotonicity(days, ["region", "season"], ["d"], "v"), "n_falls", "n", 100.0, "falls"),
        "backward_strict": lambda: integrity.share_gate(integrity.monotonicity(days, ["region", "season"], ["d"], "v"), "n_falls", "n", 0.0, "falls"),
        "acknowledged": lambda: integrity.require_known(known.select("nation"), rows.select("nation").distinct(), ["nation"], "known"),
        "not_acknowledged": lambda: integrity.require_known(known.select("nation"), rows.where("nation <> 'NATION_18'").select("nation").distinct(), ["nation"], "known"),
        "complete": lambda: integrity.require_complete(spine, held, spine),
        "incomplete": lambda: integrity.require_complete(spine, held.where("d <> DATE '2000-06-15'")),
        "off_season": lambda: reservoirs._target(storage, "2001-01-15"),
        "in_season": lambda: reservoirs._target(storage, "2001-07-15"),
    }
    out = []
    for name, attempt in tries.items():
        try:
            attempt()
            out.append((name, 0))
        except integrity.GateError as error:
            out.append((name, error.code))
    newest = reservoirs._target(storage, None)
    return spark.createDataFrame([*out, (f"newest {newest}", integrity.staleness_days(storage, "report_date", "2001-12-31"))], "gate string, code int")


def parse_work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days to parse: wanted, not known absent, and either not held or held without an ok: a bad status heals itself."""
    rows = fact(spark, sf_dir)
    spine = seasons.spine(spark, "1999-06-01", "1999-10-31", "report_date")
    held = rows.where("nation = 'NATION_6'").select(F.col("d").alias("report_date")).distinct()
    ledger = held.select("report_date", F.when(F.dayofmonth("report_date") % 4 == 0, "date_mismatch").when(F.dayofmonth("report_date") % 4 == 1, "ok_repaired").otherwise("ok").alias("status"))
    absent = spine.where(F.dayofmonth("report_date") == 9)
    return reservoirs.work_list(spine, held, ledger, absent)


def confirmed_flips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every member reads the old value before a change and the new one after it."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("scheme_id"), (F.col("c_custkey") * 10).cast("double").alias("old"))
    new = F.when(F.col("scheme_id") % 5 == 0, F.col("old")).otherwise(F.col("old") * 2)
    before = c.select(F.lit("2001-06-30").cast("date").alias("report_date"), "scheme_id", F.col("old").alias("design_gross_mcm"))
    after = c.where("scheme_id % 7 <> 0").select(F.lit("2001-07-01").cast("date").alias("report_date"), "scheme_id", new.alias("design_gross_mcm"))
    wanted = c.select("scheme_id", F.col("old").alias("value_before"), (F.col("old") * 2).alias("value_after"))
    return reservoirs.confirm_flip(before.unionByName(after), wanted, "2001-06-30", "2001-07-01")


def checked_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join that must be one to one."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return model.checked_join(c, counts, "c_custkey")


def appended_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with a column more than it began with, never twice for a day."""
    rows = fact(spark, sf_dir)
    log = rows.where("nation = 'NATION_6'").groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    new = rows.where("nation = 'NATION_7'").groupBy("d").agg(F.count(F.lit(1)).alias("n")).withColumn("note", F.lit("late"))
    once = model.append_absent(log, new, "d")
    return model.append_absent(once, new, "d")


def bound_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL with bound parameters."""
    query = "SELECT o_orderstatus, count(*) AS n FROM {orders} WHERE o_totalprice > :least AND o_orderdate < cast(:until AS timestamp) GROUP BY o_orderstatus"
    return spark.sql(query, args={"least": 100000.0, "until": "2000-01-01"}, orders=table(spark, sf_dir, "orders"))


QUERIES = {
    f.__name__: f
    for f in (
        total_below_part, day_reconciliation, same_calendar_date_report, live_capacity_report, days_of_water, date_agreement, contradicted_days, label_regression, outside_box, crosswalk_totality, id_cross_check, parent_districts, canonical_names, key_parts, header_kinds, group_moments, children_json, string_date_window,
        fallback_tables, quarantined_days, gate_verdicts, parse_work_list, confirmed_flips, checked_join, appended_log, bound_parameters,
    )
}

_DBL = "CAST({} AS DOUBLE)".format
_MICRO = "CAST(floor(({}) * 1e6 + 0.5) AS BIGINT)".format
_HELD = f"""{FACT}, s AS (SELECT * FROM fact WHERE EXTRACT(month FROM d) BETWEEN 6 AND 7),
 caps AS (SELECT region, season, CAST(count(*) AS DOUBLE) AS gross, CASE WHEN region <> 'ASIA' THEN CAST(count(*) FILTER (WHERE o_orderpriority <> '5-LOW') AS DOUBLE) END AS live FROM s GROUP BY 1, 2),
 dd AS (SELECT region, season, d, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE o_orderpriority <> '5-LOW') AS DOUBLE) AS n_live FROM s GROUP BY 1, 2, 3),
 h AS (SELECT dd.*, caps.gross, caps.live, CASE WHEN gross > 0 THEN {_DBL(100)} * n / gross END AS gross_pct, CASE WHEN live > 0 THEN {_DBL(100)} * n_live / live END AS live_pct FROM dd JOIN caps ON caps.region = dd.region AND caps.season = dd.season),
 t AS (SELECT * FROM h WHERE d = DATE '{TARGET}'), p AS (SELECT * FROM h WHERE EXTRACT(month FROM d) = 7 AND EXTRACT(day FROM d) = 31 AND d < DATE '{TARGET}'),
 g AS (SELECT t.region, t.gross, t.gross_pct, t.n_live, count(*) FILTER (WHERE ok) AS n_used, avg(CASE WHEN ok THEN q.gross_pct END) AS mean, CASE WHEN count(q.season) > 0 THEN COALESCE(string_agg(CASE WHEN ok THEN CAST(q.season AS VARCHAR) END, ',' ORDER BY q.season), '') END AS years_used
   FROM t LEFT JOIN (SELECT p.*, t2.gross <> 0 AND abs(p.gross - t2.gross) / abs(t2.gross) <= {EPS} AS ok FROM p JOIN t t2 ON t2.region = p.region) q ON q.region = t.region GROUP BY 1, 2, 3, 4),
 l AS (SELECT t.region, t.live_pct, count(*) FILTER (WHERE ok) AS n_used, avg(CASE WHEN ok THEN q.live_pct END) AS mean
   FROM t LEFT JOIN (SELECT p.*, COALESCE(t2.live <> 0 AND abs(p.live - t2.live) / abs(t2.live) <= {EPS}, FALSE) AS ok FROM p JOIN t t2 ON t2.region = p.region WHERE p.live_pct IS NOT NULL) q ON q.region = t.region GROUP BY 1, 2)"""
_PARENT = "CASE f " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.PARENT_DISTRICTS.items()) + " ELSE f END"
ORACLES = {
    "total_below_part": """WITH r AS (SELECT CAST(l_shipdate AS DATE) AS report_date, l_orderkey AS scheme_id, CASE WHEN l_linenumber < 6 THEN CAST(floor(l_quantity) AS INT) END AS c, CAST(l_linenumber * 5 AS INT) AS d FROM lineitem)
 SELECT report_date, scheme_id, 'cumulative rainfall ' || CAST(c AS VARCHAR) || ' is less than the 24-hour figure ' || CAST(d AS VARCHAR) AS reason FROM r WHERE c < d - CAST(0.001 AS DOUBLE)""",
    "day_reconciliation": """WITH s AS (SELECT CAST(o_orderdate AS DATE) AS day, count(DISTINCT o_orderkey) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS price FROM orders GROUP BY 1),
 p AS (SELECT *, day(day) AS k FROM s), q AS (SELECT *, CASE WHEN k % 7 <> 0 THEN n + CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END END AS n_printed, CASE WHEN k % 7 <> 0 THEN CAST(CASE WHEN k % 5 = 0 THEN 1000 ELSE 0 END AS DOUBLE) END AS residual_price FROM p)
 SELECT day, n AS n_parts, n_printed, residual_price, COALESCE(n = n_printed AND residual_price <= n * 2 * CAST(0.005 AS DOUBLE), FALSE) AS ok FROM q""",
    "same_calendar_date_report": f"""WITH {_HELD}, e AS (SELECT *, gross_pct - mean AS dev, CASE WHEN n_used > 0 THEN greatest(-(gross_pct - mean) / 100 * gross, 0) END AS short FROM g)
 SELECT region, {_MICRO('gross_pct')} AS pct_micro, {_MICRO('mean')} AS mean_micro, {_MICRO('dev')} AS deviation_micro, n_used, years_used, n_used = 0 AS orphan, {_MICRO('short')} AS short_micro, CASE WHEN short > 0 THEN CAST(round(round(n_live / short, 2) * 100) AS BIGINT) END AS coverage_pct FROM e""",
    "live_capacity_report": f"""WITH {_HELD}, b AS (SELECT g.region, g.gross_pct - g.mean AS gd, l.live_pct - l.mean AS ld, l.n_used AS n_live_years FROM g JOIN l ON l.region = g.region), w AS (SELECT count(*) = count(ld) AS every FROM b)
 SELECT region, {_MICRO('gd')} AS gross_micro, {_MICRO('ld')} AS live_micro, n_live_years, CASE WHEN every THEN 'live_dev' ELSE 'gross_dev' END AS ranked_by, {_MICRO('CASE WHEN every THEN ld ELSE gd END')} AS rank_micro FROM b, w""",
    "days_of_water": f"SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 THEN {_MICRO('c_acctbal / (CAST(c_custkey % 4 AS DOUBLE) * 100 * CAST(0.00244658 AS DOUBLE))')} END AS days_micro, CAST(floor(c_acctbal / greatest(c_custkey % 3, 1)) AS BIGINT) AS share FROM customer",
    "date_agreement": "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'date_mismatch' WHEN 1 THEN 'no_date' WHEN 2 THEN 'no_date' WHEN 3 THEN 'no_date' ELSE 'ok' END AS status FROM orders",
    "contradicted_days": f"WITH {FACT}, h AS (SELECT DISTINCT d FROM fact WHERE nation = 'NATION_6'), a AS (SELECT DISTINCT d FROM fact WHERE nation = 'NATION_7') SELECT d, d = (SELECT min(d) FROM h) AS refused FROM h WHERE d IN (SELECT d FROM a)",
    "label_regression": "WITH c AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 4 = 0 THEN lower(c_mktsegment) WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS l FROM customer) SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment ELSE l END AS label, c_custkey % 5 <> 0 AND l IS DISTINCT FROM c_mktsegment AS repaired FROM c",
    "outside_box": "WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey % 50 AS DOUBLE) END AS lon, CAST(c_custkey % 31 AS DOUBLE) AS lat FROM customer) SELECT c_custkey, lon, lat, TRUE AS halted FROM c WHERE lon IS NOT NULL AND NOT (lon BETWEEN 2 AND 45 AND lat BETWEEN 1 AND 29)",
    "crosswalk_totality": """WITH o AS (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey % 11 <> 0), n AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 13 <> 0), w AS (SELECT p_partkey AS o, p_partkey + 1 AS n FROM part),
 f AS (SELECT 'old_not_in_crosswalk' AS difference, k FROM o WHERE k NOT IN (SELECT o FROM w) UNION SELECT 'crosswalk_not_in_old', o FROM w WHERE o NOT IN (SELECT k FROM o) UNION SELECT 'new_not_in_crosswalk', k FROM n WHERE k NOT IN (SELECT n FROM w) UNION SELECT 'crosswalk_not_in_new', n FROM w WHERE n NOT IN (SELECT k FROM n))
 SELECT difference, CAST(k AS VARCHAR) AS key, TRUE AS halted FROM f""",
    "id_cross_check": "WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN c_custkey + 1 WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey END AS printed FROM customer WHERE c_custkey % 3 <> 0) SELECT c_custkey, printed, c_custkey AS by_name FROM c WHERE printed IS DISTINCT FROM c_custkey",
    "parent_districts": f"""WITH s AS (SELECT c_custkey, nullif(trim(regexp_replace(lower(CASE c_custkey % {len(SPELLINGS)} {' '.join(f"WHEN {k} THEN '{s}'" for k, s in enumerate(SPELLINGS))} END), '\\s+', ' ', 'g')), '') AS f FROM customer), d AS (SELECT c_custkey, {_PARENT} AS district FROM s)
 SELECT c_custkey, district, CAST(CASE district WHEN 'kutch' THEN 1 WHEN 'mehsana' THEN 2 WHEN 'jamnagar' THEN 3 WHEN 'rajkot' THEN 4 WHEN 'sabarkantha' THEN 5 END AS INT) AS number FROM d""",
    "canonical_names": "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'SG' WHEN 1 THEN 'NG' WHEN 2 THEN 'Kutch' WHEN 3 THEN 'Nowhere Land' ELSE 'Sau' END AS region, c_custkey % 5 <> 3 AS region_known, CASE c_custkey % 4 WHEN 0 THEN 'Devbhumi Dwarka' WHEN 1 THEN 'Arvalli' WHEN 2 THEN 'Mahesana' ELSE 'New Town' END AS district, c_custkey % 4 <> 3 AS district_known FROM customer",
    "key_parts": "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS second, CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS third, CAST(c_nationkey AS VARCHAR) LIKE '1%' AS first_is_one, CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN left(c_mktsegment, 1) IN ('A', 'B') THEN 'deficit' WHEN left(c_mktsegment, 1) IN ('F', 'M') THEN 'surplus' ELSE 'normal' END AS band FROM customer",
    "header_kinds": "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'sr_no' WHEN 1 THEN 'sr_no' WHEN 2 THEN 'scheme_id' END AS kind, CAST(CASE c_custkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 ELSE 3 END AS INT) AS villages FROM customer",
    "group_moments": f"SELECT event_type, {_MICRO('avg(value)')} AS mean_micro, {_MICRO('median(value)')} AS median_micro, {_MICRO('stddev_samp(value)')} AS sd_micro FROM events GROUP BY 1",
    "children_json": """WITH c AS (SELECT n_regionkey, CAST(to_json(list({'n_nationkey': n_nationkey, 'n_name': CASE WHEN n_nationkey % 3 <> 0 THEN n_name END} ORDER BY n_nationkey)) AS VARCHAR) AS j FROM nation WHERE n_nationkey > 6 AND n_regionkey <> 4 GROUP BY 1) SELECT r_regionkey, r_name, COALESCE(j, '') AS children FROM region LEFT JOIN c ON n_regionkey = r_regionkey""",
    "string_date_window": "WITH o AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders) SELECT substr(d, 1, 4) AS year, count(*) FILTER (WHERE d >= '2000-06-01') AS since, count(*) FILTER (WHERE d <= '1996-02-29') AS until, count(*) FILTER (WHERE d BETWEEN '1998-01-01' AND '1998-12-31') AS within FROM o GROUP BY 1",
    "fallback_tables": "SELECT p_partkey % 50 AS page, p_partkey, p_name, CASE WHEN p_partkey % 50 % 3 <> 0 THEN 'ruled' ELSE 'aligned' END AS method FROM part WHERE p_partkey % 50 % 3 <> 0 OR p_partkey % 2 = 0",
    "quarantined_days": f"WITH {FACT}, r AS (SELECT d, region, min(o_orderpriority) AS p FROM fact GROUP BY 1, 2) SELECT d, count(*) AS n, CASE WHEN count(*) = 5 AND count(*) FILTER (WHERE p NOT IN ('1-URGENT','2-HIGH')) = 0 THEN 'kept' ELSE 'quarantined' END AS kind FROM r GROUP BY d",
    "gate_verdicts": f"""WITH {FACT}, y AS (SELECT region, season, d, CAST(count(*) AS DOUBLE) AS v FROM fact GROUP BY 1, 2, 3), f AS (SELECT count(*) FILTER (WHERE v < p - CAST(0.001 AS DOUBLE)) AS falls FROM (SELECT v, lag(v) OVER (PARTITION BY region, season ORDER BY d) AS p FROM y) z),
 w AS (SELECT max(d) AS newest, max(CASE WHEN EXTRACT(month FROM d) BETWEEN 6 AND 10 THEN d END) AS n6 FROM fact)
 SELECT 'backward_loose' AS gate, CAST(0 AS INT) AS code UNION ALL SELECT 'backward_strict', CASE WHEN falls > 0 THEN 3 ELSE 0 END FROM f UNION ALL SELECT 'acknowledged', 0 UNION ALL SELECT 'not_acknowledged', CASE WHEN count(*) > 0 THEN 2 ELSE 0 END FROM fact WHERE nation = 'NATION_18' UNION ALL SELECT 'complete', 0 UNION ALL SELECT 'incomplete', 3 UNION ALL SELECT 'off_season', 1
 UNION ALL SELECT 'in_season', 0 UNION ALL SELECT 'newest ' || CAST(n6 AS VARCHAR), CAST(date_diff('day', newest, DATE '2001-12-31') AS INT) FROM w""",
    "parse_work_list": f"WITH {FACT}, sp AS (SELECT CAST(unnest(generate_series(DATE '1999-06-01', DATE '1999-10-31', INTERVAL 1 DAY)) AS DATE) AS report_date), h AS (SELECT DISTINCT d FROM fact WHERE nation = 'NATION_6' AND EXTRACT(day FROM d) % 4 <> 0) SELECT report_date FROM sp WHERE EXTRACT(day FROM report_date) <> 9 AND report_date NOT IN (SELECT d FROM h)",
    "confirmed_flips": "SELECT c_custkey AS scheme_id, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 5 <> 0 END AS flipped FROM customer",
    "checked_join": "SELECT c_custkey, c_name, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2",
    "appended_log": f"WITH {FACT}, a AS (SELECT d, count(*) AS n FROM fact WHERE nation = 'NATION_6' GROUP BY d) SELECT d, n, NULL AS note FROM a UNION ALL SELECT d, count(*), 'late' FROM fact WHERE nation = 'NATION_7' AND d NOT IN (SELECT d FROM a) GROUP BY d",
    "bound_parameters": "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 AND o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1",
}
