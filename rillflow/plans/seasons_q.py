"""Queries: the same date in prior years, baselines, series, ranks and classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillflow.functions import numeric, seasons
from rillflow.operators import baseline, crossover, document, order
from rillflow.plans.facts import FACT, TARGET, TO_DATE, fact

EPS = 0.25  # of a nation's orders in the window; shares of real capacities are far closer


def _window(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.lit(TARGET).cast("date")
    return fact(spark, sf_dir).where(seasons.season_to_date(F.col("d"), target) & (F.col("d") <= target))


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation and season up to the target's day: capacity (orders), pct (share of open ones), mid (a share of odd ids)."""
    return _window(spark, sf_dir).groupBy("nation", "season").agg(
        F.count(F.lit(1)).cast("double").alias("capacity"),
        (100.0 * F.count_if(F.col("o_orderstatus") == "O") / F.count(F.lit(1))).alias("pct"),
        (F.count_if(F.col("o_orderkey") % 2 == 1) % 5 == 0).alias("mid"),
    )


_NATIONS = f"""{FACT}, ns AS (SELECT nation, season, CAST(count(*) AS DOUBLE) AS capacity,
  CAST(100.0 AS DOUBLE) * CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS pct,
  (count(*) FILTER (WHERE o_orderkey % 2 = 1)) % 5 = 0 AS mid FROM fact WHERE {TO_DATE} AND d <= DATE '{TARGET}' GROUP BY nation, season),
 m AS (SELECT p.nation, p.season, p.pct, p.mid, COALESCE(abs(p.capacity - t.capacity) / t.capacity <= {EPS}, FALSE) AS matches
       FROM ns p JOIN ns t ON t.nation = p.nation AND t.season = 2001 WHERE p.season < 2001)"""


def same_date_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season-to-date totals by region beside the four prior years, worst first."""
    sums = _window(spark, sf_dir).where(F.col("season").between(1997, 2001)).groupBy("region", "season").agg(F.sum("amount").alias("total"))
    out = sums.groupBy("region").agg(
        F.max(F.when(F.col("season") == 2001, F.col("total"))).cast("double").alias("current_total"),
        F.count_if(F.col("season") < 2001).alias("n_years"),
        F.sum(F.when(F.col("season") < 2001, F.col("total"))).cast("double").alias("prior_sum"),
        F.min(F.when(F.col("season") < 2001, F.col("total"))).cast("double").alias("prior_min"),
        F.max(F.when(F.col("season") < 2001, F.col("total"))).cast("double").alias("prior_max"),
    )
    mean = F.col("prior_sum") / F.col("n_years")
    return out.select("region", "current_total", "n_years", mean.alias("prior_mean"), "prior_min", "prior_max", baseline.proportional(F.col("current_total"), mean).alias("deviation_pct")).orderBy("deviation_pct", "region")


def like_for_like_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation's share beside the mean of comparable seasons."""
    rows = _nations(spark, sf_dir)
    today = rows.where("season = 2001").select("nation", "capacity", "pct")
    marked = baseline.comparable(rows.where("season < 2001"), today, "nation", "capacity", "mid", EPS)
    out = baseline.deviations(today, baseline.baseline(marked, "nation", "season", "pct"), "nation", "pct")
    return out.select("nation", "pct", F.coalesce("n_used", F.lit(0)).cast("long").alias("n_used"), "prior_min", "prior_max", "years_used", "orphan")


def baseline_dropped_and_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasons left out by reason; orphans have none left."""
    rows = _nations(spark, sf_dir)
    marked = baseline.comparable(rows.where("season < 2001"), rows.where("season = 2001"), "nation", "capacity", "mid", EPS)
    found = baseline.baseline(marked, "nation", "season", "pct")
    return found.select("nation", "n_dropped_capacity", "n_dropped_mid", "years_dropped", (F.col("n_used") == 0).alias("orphan"))


def region_series_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratio of sums by region and day of season, with a substituted denominator where a season's own is missing."""
    rows = fact(spark, sf_dir).where(seasons.in_season(F.col("d")))
    own = rows.where("season <> 2000").groupBy("region", "season").agg(F.count(F.lit(1)).alias("own"))
    latest = rows.where("season = 2001").groupBy("region").agg(F.count(F.lit(1)).alias("latest"))
    days = rows.groupBy("region", "season", seasons.day_of_season(F.col("d")).cast("int").alias("dos")).agg(F.sum("amount").alias("present"))
    joined = days.join(own, ["region", "season"], "left").join(latest, "region")
    base = F.coalesce("own", "latest")
    return joined.select("region", "season", "dos", F.col("own").isNull().alias("substituted"), numeric.percent(F.col("present").cast("double"), base.cast("double")).alias("pct"))


def state_year_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All regions together, by year."""
    return _window(spark, sf_dir).groupBy("season").agg(F.sum("amount").cast("double").alias("total"), F.count(F.lit(1)).alias("n"))


def rain_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unweighted daily counts by region: rows and distinct customers."""
    return fact(spark, sf_dir).where(seasons.in_season(F.col("d"))).groupBy("region", "d").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_custkey").alias("n_customers"))


def release_integral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow summed over the season; unknown flows count as 0, and only here."""
    flow = F.coalesce(F.when(F.col("o_orderpriority") != "5-LOW", F.col("amount")), F.lit(0).cast("decimal(18,2)"))
    return _window(spark, sf_dir).groupBy("nation", "season").agg(F.sum(flow).cast("double").alias("released"))


def thin_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third day, and the last one."""
    days = _window(spark, sf_dir).where("season = 2001").groupBy(seasons.day_of_season(F.col("d")).cast("int").alias("dos")).agg(F.count(F.lit(1)).alias("n"))
    return document.thin(days, "dos", 3)


def _deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation: percent deviation of counts (rain) and of high-priority counts (storage) from the mean of prior years."""
    rows = _window(spark, sf_dir).where(F.col("season").between(1997, 2001)).withColumn("hi", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("long"))
    now, then = F.col("season") == 2001, F.col("season") < 2001
    agg = rows.groupBy("nation", "region").agg(F.count_if(now).alias("n_now"), F.count_if(then).alias("n_then"), F.sum(F.when(now, F.col("hi"))).alias("h_now"), F.sum(F.when(then, F.col("hi"))).alias("h_then"))
    pct = lambda a, b: F.when(F.col(b) > 0, 100.0 * (4 * F.col(a) - F.col(b)) / F.col(b))
    return agg.select("nation", "region", pct("n_now", "n_then").alias("rain"), pct("h_now", "h_then").alias("storage"), (F.col("n_then") / 4 - F.col("n_now")).alias("short"))


_DEVIATION = f"""{FACT}, w AS (SELECT nation, region, season, CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1 ELSE 0 END AS hi FROM fact WHERE {TO_DATE} AND d <= DATE '{TARGET}' AND season BETWEEN 1997 AND 2001),
 a AS (SELECT nation, region, count(*) FILTER (WHERE season = 2001) AS n_now, count(*) FILTER (WHERE season < 2001) AS n_then, sum(CASE WHEN season = 2001 THEN hi END) AS h_now, sum(CASE WHEN season < 2001 THEN hi END) AS h_then FROM w GROUP BY nation, region),
 dev AS (SELECT nation, region, CASE WHEN n_then > 0 THEN CAST(100.0 AS DOUBLE) * CAST(4 * n_now - n_then AS DOUBLE) / CAST(n_then AS DOUBLE) END AS rain,
   CASE WHEN h_then > 0 THEN CAST(100.0 AS DOUBLE) * CAST(4 * h_now - h_then AS DOUBLE) / CAST(h_then AS DOUBLE) END AS storage, CAST(n_then AS DOUBLE) / 4 - CAST(n_now AS DOUBLE) AS short FROM a)"""


def topk_pp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nations furthest below."""
    return baseline.ranked(_deviation(spark, sf_dir), "rain", "nation", 10).select("nation", "rain")


def topk_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest shortfalls."""
    return baseline.ranked(_deviation(spark, sf_dir), "short", "nation", 5, largest=True).select("nation", "short")


def quadrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-axis class of each nation."""
    return _deviation(spark, sf_dir).select("nation", numeric.quadrant(F.col("rain"), F.col("storage"), 20.0, 10.0).alias("quadrant"))


RAIN_GRID, STORAGE_GRID = [10.0, 15.0, 20.0, 25.0, 30.0], [5.0, 10.0, 15.0, 20.0]


def quadrant_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class counts over twenty pairs of bands."""
    return baseline.quadrant_grid(_deviation(spark, sf_dir), "rain", "storage", RAIN_GRID, STORAGE_GRID)


def upper_median_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upper median deviation of a region's nations."""
    return order.upper_medians(_deviation(spark, sf_dir), ["region"], "rain", "median_rain")


def facet_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions in the order of their facets: worst mean first, unknown as 0; with a dense place."""
    from pyspark.sql import Window as W

    means = _deviation(spark, sf_dir).groupBy("region").agg(F.sum("short").alias("short"), F.count(F.lit(1)).alias("n"))
    return means.select("region", "short", F.row_number().over(W.orderBy(F.desc(F.coalesce("short", F.lit(0.0))), "region")).alias("place"))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season-to-date counts of orders by region on every day of the window: a densified running sum."""
    from pyspark.sql import Window as W

    days = _window(spark, sf_dir).groupBy("region", "season", seasons.day_of_season(F.col("d")).cast("int").alias("dos")).agg(F.count(F.lit(1)).alias("n"))
    spine = days.select("region", "season").distinct().withColumn("dos", F.explode(F.sequence(F.lit(1), F.lit(61))))
    dense = spine.join(days, ["region", "season", "dos"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return dense.withColumn("total", F.sum("n").over(W.partitionBy("region", "season").orderBy("dos").rowsBetween(W.unboundedPreceding, 0)))


_DAILY = f"""{FACT}, dd AS (SELECT region, season, CAST(date_diff('day', make_date(season, 6, 1), d) AS INT) + 1 AS dos, count(*) AS n FROM fact WHERE {TO_DATE} AND d <= DATE '{TARGET}' GROUP BY 1, 2, 3),
 sp AS (SELECT k.region, k.season, CAST(g.i AS INT) AS dos FROM (SELECT DISTINCT region, season FROM dd) k CROSS JOIN (SELECT unnest(generate_series(1, 61)) AS i) g),
 cum AS (SELECT sp.region, sp.season, sp.dos, sum(COALESCE(dd.n, 0)) OVER (PARTITION BY sp.region, sp.season ORDER BY sp.dos ROWS UNBOUNDED PRECEDING) AS total FROM sp LEFT JOIN dd ON dd.region = sp.region AND dd.season = sp.season AND dd.dos = sp.dos),
 ev AS (SELECT c.region, c.dos, row_number() OVER (PARTITION BY c.region ORDER BY c.dos) - 1 AS seq, c.total < min(p.total) AS below FROM cum c JOIN cum p ON p.region = c.region AND p.dos = c.dos AND p.season BETWEEN 1997 AND 2000 WHERE c.season = 2001 GROUP BY c.region, c.dos, c.total HAVING count(*) = 4),
 isl AS (SELECT region, dos, seq, seq - row_number() OVER (PARTITION BY region ORDER BY seq) AS g, max(seq) OVER (PARTITION BY region) AS last_seq FROM ev WHERE below),
 lastseq AS (SELECT region, max(seq) AS ls FROM ev GROUP BY region),
 runs AS (SELECT i.region, min(i.dos) AS start_day, max(i.dos) AS end_day, min(i.seq) AS start_seq, max(i.seq) AS end_seq, count(*) AS run_length, max(i.seq) = max(l.ls) AS is_current, count(*) >= 5 AS qualifies FROM isl i JOIN lastseq l ON l.region = i.region GROUP BY i.region, i.g)"""


def _evaluable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _daily(spark, sf_dir)
    return crossover.evaluable_days(rows.where("season = 2001"), rows.where("season between 1997 and 2000"), "region", "dos", "season", "total", 4)


def crossover_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of days below all four prior seasons."""
    return crossover.below_runs(_evaluable(spark, sf_dir), "region", "dos").select("region", "start_day", "end_day", F.col("start_seq").cast("long").alias("start_seq"), "run_length", "is_current", "qualifies")


def crossover_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case of each region."""
    rows = _daily(spark, sf_dir)
    out = crossover.crossover(rows.select("region").distinct(), _evaluable(spark, sf_dir), "region", "dos")
    return out.select("region", "case", "cross_day", "run_end_day", "recovered_day", "currently_below", F.col("current_run.length").alias("current_length"))


def view_document_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested document: meta, regions with series and crossover, ranked nations, quadrant counts."""
    rows = _daily(spark, sf_dir)
    series = document.nested_series(rows.where("season >= 1997"), "region", "season", "dos", "total")
    cross = crossover.crossover(rows.select("region").distinct(), _evaluable(spark, sf_dir), "region", "dos")
    regions = document.attach(series, cross, "region", "crossover")
    dev = _deviation(spark, sf_dir)
    meta = dev.agg(F.struct(F.lit(TARGET).alias("report_date"), F.count(F.lit(1)).alias("n_entities"), F.array_sort(F.collect_set("region")).alias("regions")).alias("meta"))
    counts = dev.select(numeric.quadrant(F.col("rain"), F.col("storage"), 20.0, 10.0).alias("q")).groupBy("q").agg(F.count(F.lit(1)).alias("n"))
    return document.to_document(("meta", meta), ("regions", document.records(regions, "region")), ("lowest", document.records(topk_pp(spark, sf_dir), "rain", "nation")), ("quadrants", document.records(counts, "q")))


QUERIES = {
    f.__name__: f
    for f in (same_date_deviation, like_for_like_baseline, baseline_dropped_and_orphans, region_series_ratio, state_year_total, rain_strip, release_integral, thin_series, topk_pp, topk_volume, quadrants, quadrant_grid, upper_median_by_region, facet_order, crossover_runs, crossover_case, view_document_json)
}

_QUADRANT = """CASE WHEN rain IS NULL OR storage IS NULL THEN NULL WHEN rain < -{r} AND storage < -{s} THEN 'rain_explains' WHEN storage < -{s} THEN 'low_despite_rain' WHEN rain < -{r} THEN 'held_up' ELSE 'both_normal' END"""
_GRID_SQL = " UNION ALL ".join(
    f"SELECT CAST({r} AS DOUBLE) AS rain_band, CAST({s} AS DOUBLE) AS storage_band, " + ", ".join(f"count(*) FILTER (WHERE q = '{q}') AS n_{q}" for q in ("rain_explains", "low_despite_rain", "held_up", "both_normal")) + f", count(*) FILTER (WHERE q IS NULL) AS n_unknown FROM (SELECT {_QUADRANT.format(r=r, s=s)} AS q FROM dev) z"
    for r in RAIN_GRID
    for s in STORAGE_GRID
)
_JSON = "COALESCE(CAST({} AS VARCHAR), 'null')".format
_FLAG = "CASE WHEN {} THEN 'true' ELSE 'false' END".format
#: The nested document, put together as text.
_DOCUMENT = f"""WITH {_DAILY}, {_DEVIATION.removeprefix(FACT + ", ")},
 q AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY start_seq) AS k FROM runs WHERE qualifies), c AS (SELECT * FROM runs WHERE is_current), reg AS (SELECT DISTINCT region FROM cum),
 x AS (SELECT reg.region, CASE WHEN l.ls IS NULL THEN 'not_evaluable' WHEN q.region IS NULL THEN 'never_below' WHEN q.start_seq = 0 THEN 'below_from_start' ELSE 'crossed' END AS kind, CASE WHEN q.start_seq > 0 THEN q.start_day END AS cross_day, CASE WHEN NOT q.is_current THEN q.end_day END AS run_end_day,
   CASE WHEN NOT q.is_current THEN (SELECT min(e.dos) FROM ev e WHERE e.region = reg.region AND e.seq = q.end_seq + 1) END AS recovered_day, c.region IS NOT NULL AS below, c.start_day AS c_start, c.run_length AS c_length, c.qualifies AS c_qualifies
   FROM reg LEFT JOIN lastseq l ON l.region = reg.region LEFT JOIN q ON q.region = reg.region AND q.k = 1 LEFT JOIN c ON c.region = reg.region),
 days AS (SELECT region, season, '{{' || string_agg('"' || dos || '":' || total, ',' ORDER BY dos) || '}}' AS j FROM cum WHERE season >= 1997 GROUP BY 1, 2),
 series AS (SELECT region, '{{' || string_agg('"' || season || '":' || j, ',' ORDER BY season) || '}}' AS j FROM days GROUP BY 1),
 regions AS (SELECT string_agg('{{"region":"' || s.region || '","series":' || s.j || ',"crossover":{{"case":"' || x.kind || '","cross_day":' || {_JSON('cross_day')} || ',"run_end_day":' || {_JSON('run_end_day')} || ',"recovered_day":' || {_JSON('recovered_day')} || ',"currently_below":' || {_FLAG('below')}
   || ',"current_run":' || CASE WHEN below THEN '{{"start_day":' || c_start || ',"length":' || c_length || ',"qualifies":' || {_FLAG('c_qualifies')} || '}}' ELSE 'null' END || '}}}}', ',' ORDER BY s.region) AS j FROM series s JOIN x ON x.region = s.region),
 low AS (SELECT string_agg('{{"rain":' || rain || ',"nation":"' || nation || '"}}', ',' ORDER BY rain, nation) AS j FROM (SELECT * FROM dev WHERE rain IS NOT NULL ORDER BY rain, nation LIMIT 10) z),
 quads AS (SELECT string_agg('{{"q":' || COALESCE('"' || q || '"', 'null') || ',"n":' || n || '}}', ',' ORDER BY q NULLS FIRST) AS j FROM (SELECT {_QUADRANT.format(r=20.0, s=10.0)} AS q, count(*) AS n FROM dev GROUP BY 1) z),
 meta AS (SELECT '{{"report_date":"{TARGET}","n_entities":' || count(*) || ',"regions":[' || string_agg(DISTINCT '"' || region || '"', ',' ORDER BY '"' || region || '"') || ']}}' AS j FROM dev)
 SELECT '{{"meta":' || meta.j || ',"regions":[' || regions.j || '],"lowest":[' || low.j || '],"quadrants":[' || quads.j || ']}}' AS document FROM meta, regions, low, quads"""
ORACLES = {
    "view_document_json": _DOCUMENT,
    "same_date_deviation": f"""WITH {FACT}, s AS (SELECT region, season, sum(amount) AS total FROM fact WHERE {TO_DATE} AND d <= DATE '{TARGET}' AND season BETWEEN 1997 AND 2001 GROUP BY region, season),
 a AS (SELECT region, CAST(max(CASE WHEN season = 2001 THEN total END) AS DOUBLE) AS current_total, count(*) FILTER (WHERE season < 2001) AS n_years, CAST(sum(CASE WHEN season < 2001 THEN total END) AS DOUBLE) AS ps, CAST(min(CASE WHEN season < 2001 THEN total END) AS DOUBLE) AS prior_min, CAST(max(CASE WHEN season < 2001 THEN total END) AS DOUBLE) AS prior_max FROM s GROUP BY region)
 SELECT region, current_total, n_years, ps / n_years AS prior_mean, prior_min, prior_max, CASE WHEN ps / n_years > 0 THEN CAST(100.0 AS DOUBLE) * (current_total - ps / n_years) / (ps / n_years) END AS deviation_pct FROM a""",
    "like_for_like_baseline": f"""WITH {_NATIONS} SELECT t.nation, t.pct, count(*) FILTER (WHERE m.matches AND NOT m.mid) AS n_used, min(CASE WHEN m.matches AND NOT m.mid THEN m.pct END) AS prior_min, max(CASE WHEN m.matches AND NOT m.mid THEN m.pct END) AS prior_max,
 COALESCE(string_agg(CASE WHEN m.matches AND NOT m.mid THEN CAST(m.season AS VARCHAR) END, ',' ORDER BY m.season), CASE WHEN count(m.season) > 0 THEN '' END) AS years_used, count(*) FILTER (WHERE m.matches AND NOT m.mid) = 0 AS orphan FROM ns t LEFT JOIN m ON m.nation = t.nation WHERE t.season = 2001 GROUP BY t.nation, t.pct""",
    "baseline_dropped_and_orphans": f"""WITH {_NATIONS} SELECT nation, count(*) FILTER (WHERE NOT matches) AS n_dropped_capacity, count(*) FILTER (WHERE matches AND mid) AS n_dropped_mid, COALESCE(string_agg(CASE WHEN NOT (matches AND NOT mid) THEN CAST(season AS VARCHAR) END, ',' ORDER BY season), '') AS years_dropped, count(*) FILTER (WHERE matches AND NOT mid) = 0 AS orphan FROM m GROUP BY nation""",
    "region_series_ratio": f"""WITH {FACT}, s AS (SELECT * FROM fact WHERE EXTRACT(month FROM d) BETWEEN 6 AND 10), own AS (SELECT region, season, count(*) AS own FROM s WHERE season <> 2000 GROUP BY 1, 2), lat AS (SELECT region, count(*) AS latest FROM s WHERE season = 2001 GROUP BY 1),
 dd AS (SELECT region, season, CAST(date_diff('day', make_date(season, 6, 1), d) AS INT) + 1 AS dos, sum(amount) AS present FROM s GROUP BY 1, 2, 3)
 SELECT dd.region, dd.season, dd.dos, own.own IS NULL AS substituted, CASE WHEN COALESCE(own.own, lat.latest) > 0 THEN CAST(100.0 AS DOUBLE) * CAST(dd.present AS DOUBLE) / CAST(COALESCE(own.own, lat.latest) AS DOUBLE) END AS pct FROM dd LEFT JOIN own ON own.region = dd.region AND own.season = dd.season JOIN lat ON lat.region = dd.region""",
    "state_year_total": f"WITH {FACT} SELECT season, CAST(sum(amount) AS DOUBLE) AS total, count(*) AS n FROM fact WHERE {TO_DATE} AND d <= DATE '{TARGET}' GROUP BY season",
    "rain_strip": f"WITH {FACT} SELECT region, d, count(*) AS n, count(DISTINCT o_custkey) AS n_customers FROM fact WHERE EXTRACT(month FROM d) BETWEEN 6 AND 10 GROUP BY region, d",
    "release_integral": f"WITH {FACT} SELECT nation, season, CAST(sum(CASE WHEN o_orderpriority <> '5-LOW' THEN amount ELSE 0 END) AS DOUBLE) AS released FROM fact WHERE {TO_DATE} AND d <= DATE '{TARGET}' GROUP BY nation, season",
    "thin_series": f"WITH {FACT}, s AS (SELECT CAST(date_diff('day', make_date(season, 6, 1), d) AS INT) + 1 AS dos, count(*) AS n FROM fact WHERE {TO_DATE} AND d <= DATE '{TARGET}' AND season = 2001 GROUP BY 1) SELECT dos, n FROM s WHERE dos % 3 = 1 OR dos = (SELECT max(dos) FROM s)",
    "topk_pp": f"WITH {_DEVIATION} SELECT nation, rain FROM dev WHERE rain IS NOT NULL ORDER BY rain, nation LIMIT 10",
    "topk_volume": f"WITH {_DEVIATION} SELECT nation, short FROM dev WHERE short IS NOT NULL ORDER BY short DESC, nation LIMIT 5",
    "quadrants": f"WITH {_DEVIATION} SELECT nation, {_QUADRANT.format(r=20.0, s=10.0)} AS quadrant FROM dev",
    "quadrant_grid": f"WITH {_DEVIATION} {_GRID_SQL}",
    "upper_median_by_region": f"WITH {_DEVIATION}, r AS (SELECT region, rain, row_number() OVER (PARTITION BY region ORDER BY rain) AS k, count(*) OVER (PARTITION BY region) AS n FROM dev WHERE rain IS NOT NULL) SELECT region, rain AS median_rain, n FROM r WHERE k = n // 2 + 1",
    "facet_order": f"WITH {_DEVIATION}, s AS (SELECT region, sum(short) AS short FROM dev GROUP BY region) SELECT region, short, CAST(row_number() OVER (ORDER BY COALESCE(short, 0) DESC, region) AS INT) AS place FROM s",
    "crossover_runs": f"WITH {_DAILY} SELECT region, start_day, end_day, start_seq, run_length, is_current, qualifies FROM runs",
    "crossover_case": f"""WITH {_DAILY}, q AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY start_seq) AS k FROM runs WHERE qualifies), c AS (SELECT * FROM runs WHERE is_current), reg AS (SELECT DISTINCT region FROM cum)
 SELECT reg.region, CASE WHEN l.ls IS NULL THEN 'not_evaluable' WHEN q.region IS NULL THEN 'never_below' WHEN q.start_seq = 0 THEN 'below_from_start' ELSE 'crossed' END AS "case", CASE WHEN q.start_seq > 0 THEN q.start_day END AS cross_day, CASE WHEN NOT q.is_current THEN q.end_day END AS run_end_day,
 CASE WHEN NOT q.is_current THEN (SELECT min(e.dos) FROM ev e WHERE e.region = reg.region AND e.seq = q.end_seq + 1) END AS recovered_day, c.region IS NOT NULL AS currently_below, c.run_length AS current_length
 FROM reg LEFT JOIN lastseq l ON l.region = reg.region LEFT JOIN q ON q.region = reg.region AND q.k = 1 LEFT JOIN c ON c.region = reg.region""",
}
