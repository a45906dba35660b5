"""Queries: clustering, runs, classes and restatements of a value per entity and season."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillflow.operators import capacity, summaries
from rillflow.sources.tables import table

KEY, ORDER = ["l_partkey", "season"], ["d", "l_orderkey", "l_linenumber"]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounts of a part within a season, in the order of shipping."""
    line = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("d"), F.col("l_discount").alias("v"))
    return line.where(F.month("d").between(6, 10)).withColumn("season", F.year("d"))


def capacity_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of one discount."""
    out = capacity.runs(_lines(spark, sf_dir), KEY, ORDER, "v")
    return out.select(*KEY, F.col("run_no").cast("long").alias("run_no"), "run_start", "run_end", "run_value", "run_length")


def season_capacity_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of each part and season. Discounts are whole hundredths, so no two of them are near-equal but equal ones."""
    out = capacity.classify(_lines(spark, sf_dir), KEY, ORDER, "v")
    return out.select(*KEY, "capacity_class", F.col("capacity").alias("season_capacity"), "n_days", "n_values", "n_major", "n_minor")


def near_equal_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of unit prices per part and year."""
    price = table(spark, sf_dir, "lineitem").select("l_partkey", F.year("l_shipdate").alias("season"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("v"))
    found = price.groupBy("l_partkey", "season").agg(capacity.clusters(F.col("v")).alias("c"))
    return found.select("l_partkey", "season", F.explode("c").alias("c")).select("l_partkey", "season", "c.lo", "c.rep")


def restatements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the largest quantity that a supplier ships in a season."""
    line = table(spark, sf_dir, "lineitem").withColumn("d", F.to_date("l_shipdate")).where(F.month("d").between(6, 10))
    seasons = line.groupBy("l_suppkey", F.year("d").alias("season")).agg(F.max("l_quantity").alias("cap"), F.min("d").alias("first_day"), F.max("d").alias("last_day"))
    out = capacity.restatements(seasons, "l_suppkey", "season", "cap", "first_day", "last_day", 0.02)
    return out.withColumn("gap_days", F.col("gap_days").cast("long"))


def change_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last day of an old and first day of a new discount, by part."""
    rows = _lines(spark, sf_dir).withColumn("old", F.lit(0.02)).withColumn("new", F.lit(0.05))
    return capacity.change_date(rows, ["l_partkey"], "d", "v", "old", "new")


def change_bracket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Between which days a part's discount turned from one value to another, and whether that can be said; some days are unread."""
    rows = _lines(spark, sf_dir).withColumn("v", F.when(F.col("l_orderkey") % 3 != 0, F.col("v"))).withColumn("old", F.lit(0.02)).withColumn("new", F.lit(0.05))
    return capacity.change_bracket(rows, ["l_partkey"], "d", "v", "old", "new")


def folded_capacity_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of each part and season from summaries of three sets of days, merged: the same as from all rows at once."""
    lines = _lines(spark, sf_dir)
    parts = [summaries.summarize(lines.where(F.dayofmonth("d") % 3 == k), KEY, "d", "v") for k in range(3)]
    out = summaries.classify(summaries.merge(KEY, parts[2], summaries.merge(KEY, parts[0], parts[1])), KEY)
    return out.select(*KEY, "capacity_class", F.col("capacity").alias("season_capacity"), "n_days", "n_values", "n_major", "n_minor")


QUERIES = {f.__name__: f for f in (capacity_runs, season_capacity_class, near_equal_clusters, restatements, change_date, change_bracket, folded_capacity_class)}

_LINES = """li AS (SELECT l_partkey, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d, CAST(EXTRACT(year FROM l_shipdate) AS INT) AS season, l_discount AS v FROM lineitem WHERE EXTRACT(month FROM l_shipdate) BETWEEN 6 AND 10),
 st AS (SELECT *, CASE WHEN v = lag(v) OVER (PARTITION BY l_partkey, season ORDER BY d, l_orderkey, l_linenumber) THEN 0 ELSE 1 END AS s FROM li),
 rn AS (SELECT *, sum(s) OVER (PARTITION BY l_partkey, season ORDER BY d, l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING) AS run_no FROM st),
 runs AS (SELECT l_partkey, season, run_no, min(d) AS run_start, max(d) AS run_end, min(v) AS run_value, count(*) AS run_length FROM rn GROUP BY l_partkey, season, run_no)"""
ORACLES = {
    "capacity_runs": f"WITH {_LINES} SELECT l_partkey, season, CAST(run_no AS BIGINT) AS run_no, run_start, run_end, run_value, run_length FROM runs",
    "season_capacity_class": f"""WITH {_LINES}, cnt AS (SELECT l_partkey, season, v, count(*) AS n FROM li GROUP BY 1, 2, 3), rk AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, season ORDER BY n DESC, v DESC) AS k FROM cnt),
 mj AS (SELECT l_partkey, season, max(CASE WHEN k = 1 THEN v END) AS major, max(n) AS n_major, CAST(sum(n) AS BIGINT) AS n_days, count(*) AS n_values FROM rk GROUP BY 1, 2),
 od AS (SELECT r.l_partkey, r.season, count(*) FILTER (WHERE r.run_value <> m.major) AS n_odd, min(CASE WHEN r.run_value <> m.major THEN r.run_no END) AS odd_no, max(CASE WHEN r.run_value <> m.major THEN r.run_length END) AS odd_length FROM runs r JOIN mj m ON m.l_partkey = r.l_partkey AND m.season = r.season GROUP BY 1, 2),
 cl AS (SELECT m.*, CASE WHEN n_values <= 1 THEN 'clean' WHEN n_odd = 1 AND odd_no = 1 AND odd_length <= 2 AND odd_length = n_days - n_major AND n_major > n_days - n_major THEN 'edge_exception' ELSE 'mid_season' END AS capacity_class FROM mj m JOIN od o ON o.l_partkey = m.l_partkey AND o.season = m.season)
 SELECT l_partkey, season, capacity_class, CASE WHEN capacity_class <> 'mid_season' THEN major END AS season_capacity, n_days, n_values, n_major, n_days - n_major AS n_minor FROM cl""",
    "near_equal_clusters": """WITH RECURSIVE p AS (SELECT DISTINCT l_partkey, CAST(EXTRACT(year FROM l_shipdate) AS INT) AS season, l_extendedprice / l_quantity AS v FROM lineitem),
 o AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, season ORDER BY v) AS k FROM p),
 w AS (SELECT l_partkey, season, v, k, v AS lo FROM o WHERE k = 1 UNION ALL SELECT o.l_partkey, o.season, o.v, o.k, CASE WHEN o.v <> 0 AND abs(o.v - w.lo) / abs(o.v) > 0.005 THEN o.v ELSE w.lo END FROM w JOIN o ON o.l_partkey = w.l_partkey AND o.season = w.season AND o.k = w.k + 1)
 SELECT l_partkey, season, lo, max(v) AS rep FROM w GROUP BY l_partkey, season, lo""",
    "restatements": """WITH s AS (SELECT l_suppkey, CAST(EXTRACT(year FROM l_shipdate) AS INT) AS season, max(l_quantity) AS cap, min(CAST(l_shipdate AS DATE)) AS fd, max(CAST(l_shipdate AS DATE)) AS ld FROM lineitem WHERE EXTRACT(month FROM l_shipdate) BETWEEN 6 AND 10 GROUP BY 1, 2),
 t AS (SELECT *, lag(season) OVER w AS sb, lag(cap) OVER w AS b, lag(ld) OVER w AS lsb FROM s WINDOW w AS (PARTITION BY l_suppkey ORDER BY season)),
 c AS (SELECT *, COALESCE(abs(cap - b) / b > 0.02, FALSE) AS changed, CASE WHEN cap = b THEN 0 ELSE 1 END AS kept FROM t),
 sh AS (SELECT l_suppkey, CASE WHEN sum(kept) <> count(DISTINCT cap) THEN 'oscillating' WHEN count(*) FILTER (WHERE changed) = 1 THEN 'single_step' ELSE 'multi_step' END AS shape FROM c GROUP BY 1)
 SELECT c.l_suppkey, sb AS season_before, season AS season_after, b AS value_before, cap AS value_after, CASE WHEN cap > b THEN 'up' ELSE 'down' END AS direction, sh.shape, lsb AS last_seen_before, fd AS first_seen_after, date_diff('day', lsb, fd) AS gap_days FROM c JOIN sh ON sh.l_suppkey = c.l_suppkey WHERE changed""",
    "change_date": f"""WITH {_LINES} SELECT l_partkey, max(CASE WHEN abs(v - CAST(0.02 AS DOUBLE)) <= CAST(0.005 AS DOUBLE) * CAST(0.02 AS DOUBLE) THEN d END) AS last_old, min(CASE WHEN abs(v - CAST(0.05 AS DOUBLE)) <= CAST(0.005 AS DOUBLE) * CAST(0.05 AS DOUBLE) THEN d END) AS first_new,
 count(*) FILTER (WHERE NOT abs(v - CAST(0.02 AS DOUBLE)) <= CAST(0.005 AS DOUBLE) * CAST(0.02 AS DOUBLE) AND NOT abs(v - CAST(0.05 AS DOUBLE)) <= CAST(0.005 AS DOUBLE) * CAST(0.05 AS DOUBLE)) AS n_neither FROM li GROUP BY l_partkey""",
}
#: One row a day: the least discount of it.
ORACLES["folded_capacity_class"] = ORACLES["season_capacity_class"].replace(
    "SELECT l_partkey, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d, CAST(EXTRACT(year FROM l_shipdate) AS INT) AS season, l_discount AS v FROM lineitem WHERE EXTRACT(month FROM l_shipdate) BETWEEN 6 AND 10",
    "SELECT l_partkey, 0 AS l_orderkey, 0 AS l_linenumber, CAST(l_shipdate AS DATE) AS d, CAST(EXTRACT(year FROM l_shipdate) AS INT) AS season, min(l_discount) AS v FROM lineitem WHERE EXTRACT(month FROM l_shipdate) BETWEEN 6 AND 10 GROUP BY ALL",
)
ORACLES["change_bracket"] = """WITH r AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS d, CASE WHEN l_orderkey % 3 <> 0 THEN l_discount END AS v FROM lineitem WHERE EXTRACT(month FROM l_shipdate) BETWEEN 6 AND 10),
 n AS (SELECT *, COALESCE(abs(v - CAST(0.02 AS DOUBLE)) <= CAST(0.005 AS DOUBLE) * CAST(0.02 AS DOUBLE), FALSE) AS o, COALESCE(abs(v - CAST(0.05 AS DOUBLE)) <= CAST(0.005 AS DOUBLE) * CAST(0.05 AS DOUBLE), FALSE) AS w FROM r),
 e AS (SELECT l_partkey, max(CASE WHEN o THEN d END) AS last_old, min(CASE WHEN w THEN d END) AS first_new FROM n GROUP BY 1),
 b AS (SELECT n.l_partkey, count(DISTINCT CASE WHEN v IS NOT NULL THEN d END) AS third, count(DISTINCT CASE WHEN v IS NULL THEN d END) AS unread, count(DISTINCT d) AS days FROM n JOIN e ON e.l_partkey = n.l_partkey AND d > last_old AND d < first_new GROUP BY 1)
 SELECT e.l_partkey, last_old, first_new, COALESCE(third, 0) AS n_third, COALESCE(unread, 0) AS n_unread, CAST(CASE WHEN last_old < first_new THEN first_new - last_old - 1 - COALESCE(days, 0) ELSE 0 END AS BIGINT) AS n_absent,
 CASE WHEN first_new IS NULL THEN 'never_new' WHEN last_old IS NULL THEN 'never_old' WHEN last_old >= first_new THEN 'old_again' WHEN COALESCE(third, 0) > 0 THEN 'third_value' WHEN first_new - last_old = 1 THEN 'exact' ELSE 'bracket' END AS verdict FROM e LEFT JOIN b ON b.l_partkey = e.l_partkey"""
