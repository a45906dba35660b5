"""Queries: dimensions, coverage, gates, joins, sets and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from rillflow.functions import numeric, seasons, text
from rillflow.operators import integrity, model, order
from rillflow.plans.facts import FACT, fact
from rillflow.plans.seasons_q import _DAILY, _daily
from rillflow.sources.daily import union_by_name
from rillflow.sources.tables import table


def coverage_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, customers and conditional counts per day."""
    return model.coverage(fact(spark, sf_dir), "d", "o_custkey", {"n_open": F.col("o_orderstatus") == "O", "n_large": F.col("amount") > 100000})


def calendar_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which a nation ordered nothing, of one season."""
    spine = seasons.spine(spark, "2000-06-01", "2000-10-31")
    present = fact(spark, sf_dir).where("nation = 'NATION_6'")
    reasons = fact(spark, sf_dir).where("nation = 'NATION_7'").groupBy("d").agg(F.count(F.lit(1)).alias("n_other"))
    return model.missing_dates(spine, present, reasons)


def calendar_gap_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as runs."""
    return model.gap_runs(calendar_gaps(spark, sf_dir).select("d"))


def dim_latest_with_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's last order, and how many priorities and statuses it has had."""
    return model.dimension_with_drift(fact(spark, sf_dir), "o_custkey", ["d", "o_orderkey"], ["d", "amount", "o_orderpriority"], {"o_orderpriority": "n_priorities", "o_orderstatus": "n_statuses"}).withColumn("amount_latest", F.col("amount_latest").cast("double"))


def latest_by_max_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's last event."""
    return model.latest_per_key(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], ["event_id", "event_type", "value"])


def monotonicity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season-to-date totals never fall; a spoiled copy, with the totals of day 40 halved, does."""
    rows = _daily(spark, sf_dir).withColumn("v", F.col("total").cast("double"))
    bad = rows.withColumn("v", F.when(F.col("dos") == 40, F.col("v") / 2).otherwise(F.col("v")))
    good, spoiled = (integrity.monotonicity(r, ["region", "season"], ["dos"], "v").withColumn("copy", F.lit(n)) for r, n in ((rows, "as is"), (bad, "spoiled")))
    return good.unionByName(spoiled)


def step_identity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's rise is the day's own count; against a count that is off by two on one day it isn't."""
    rows = _daily(spark, sf_dir).select("region", "season", F.date_add(F.make_date("season", F.lit(6), F.lit(1)), F.col("dos") - 1).alias("d"), F.col("total").cast("double").alias("v"), F.col("n").cast("double").alias("n"), "dos")
    bad = rows.withColumn("n", F.when(F.col("dos") == 30, F.col("n") + 2).otherwise(F.col("n")))
    good, spoiled = (integrity.step_identity(r, ["region", "season"], "d", "v", "n").withColumn("copy", F.lit(n)) for r, n in ((rows, "as is"), (bad, "spoiled")))
    return good.unionByName(spoiled)


def cross_check_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals against the sums of their lines: the negative control, as they never agree; and against themselves."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("a"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("b"))
    a = integrity.cross_check(orders, lines, ["k"], "a", "b", 1.0).withColumn("statement", F.lit("lines"))
    return a.unionByName(integrity.cross_check(orders, orders.withColumnRenamed("a", "b"), ["k"], "a", "b", 1.0).withColumn("statement", F.lit("itself")))


def reconcile_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations against a printed statement with a sub-total and a grand total."""
    rows = fact(spark, sf_dir)
    parts = rows.groupBy("nation", "region").agg(F.sum("amount").alias("amount"))
    sub = parts.where("region in ('ASIA', 'EUROPE')").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    grand = parts.agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    printed = sub.unionByName(grand).withColumn("label", F.lit(" Total "))
    out = integrity.reconcile(parts, printed, "nation", ["amount"], "label", "n")
    return out.select("n_parts", "n_printed", F.col("residual_amount").cast("double").alias("residual_amount"), "ok")


def verify_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All problems of each day at once: here a day should have the five regions, once each."""
    rows = fact(spark, sf_dir).groupBy("d", "region").agg(F.min("o_orderpriority").alias("p"))
    out = integrity.verify_days(rows, "d", "region", 5, {"p": ("1-URGENT", "2-HIGH")})
    return out.select("d", F.size("problems").cast("long").alias("n_problems"), F.array_join(F.transform("problems", lambda p: p["check"]), ",").alias("checks"))


def nested_agg_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, least and largest of daily totals, per season."""
    days = fact(spark, sf_dir).groupBy("season", "d").agg(F.sum("amount").alias("t"))
    return days.groupBy("season").agg((F.sum("t").cast("double") / F.count(F.lit(1))).alias("avg_total"), F.min("t").cast("double").alias("min_total"), F.max("t").cast("double").alias("max_total"), F.count(F.lit(1)).alias("n_days"))


def filter_clause_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct days by condition."""
    fact(spark, sf_dir).createOrReplaceTempView("rillflow_fact")
    return spark.sql("SELECT season, count(DISTINCT d) FILTER (WHERE month(d) BETWEEN 6 AND 10) AS n_season_days, count(DISTINCT d) FILTER (WHERE o_orderstatus = 'P') AS n_p_days, count(DISTINCT o_custkey) AS n_customers FROM rillflow_fact GROUP BY season")


def having_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with more than the given share of orders in part delivery, most first."""
    rows = fact(spark, sf_dir).groupBy("nation").agg(F.count_if(F.col("o_orderstatus") == "P").alias("differ"), F.count(F.lit(1)).alias("n"))
    return rows.where("differ > 0").orderBy(F.desc("differ"), "nation").limit(12)


def sort_by_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight customers whose balance is furthest from zero."""
    return table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc(F.abs("c_acctbal")), "c_custkey").limit(8)


def join_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders, without, and orders without customer."""
    return model.join_audit(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "k")


def union_by_name_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layouts of suppliers in one frame: the older lacks a column."""
    s = table(spark, sf_dir, "supplier")
    old = s.where("s_suppkey % 2 = 0").select("s_name", "s_suppkey").withColumn("layout", F.lit(23))
    new = s.where("s_suppkey % 2 = 1").select("s_suppkey", "s_name", "s_acctbal").withColumn("layout", F.lit(24))
    return union_by_name([new, old])


def set_ops_ack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Found keys: acknowledged, or novel."""
    found = fact(spark, sf_dir).where("o_orderstatus = 'P'").select("nation", "season").distinct()
    known = fact(spark, sf_dir).where("amount > 400000").select("nation", "season").distinct()
    return found.intersect(known).withColumn("kind", F.lit("acknowledged")).unionByName(found.subtract(known).withColumn("kind", F.lit("novel")))


def distinct_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user and kind by id."""
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min_by(F.struct("event_id", "value"), "event_id").alias("f")).select("user_id", "event_type", "f.event_id", "f.value")


def weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discount weighted by quantity, rows of returned goods without a value."""
    line = table(spark, sf_dir, "lineitem").select("l_suppkey", F.when(F.col("l_returnflag") != "R", (F.col("l_discount") * 100).cast("decimal(6,0)")).alias("x"), F.col("l_quantity").cast("decimal(6,0)").alias("w"))
    w = F.sum(F.when(F.col("x").isNotNull(), F.col("w")))
    return line.groupBy("l_suppkey").agg(F.when(w != 0, F.sum(F.col("x") * F.col("w")).cast("double") / w.cast("double")).alias("mean_discount"))


def iqr_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles with linear interpolation, and the interquartile range."""
    found = order.quantiles(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity"), ["l_returnflag"], "l_quantity", {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95})
    return found.withColumn("iqr", F.col("p75") - F.col("p25"))


def hist20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty bins of a share in [0, 1]."""
    share = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") / 50).alias("v"))
    return share.select(numeric.histogram_bin(F.col("v"), 20).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


BREAKS = [10.0, 20.0, 30.0, 40.0]


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over half-open classes."""
    return table(spark, sf_dir, "lineitem").select(numeric.class_of_value(F.col("l_quantity"), BREAKS).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def rollup_without_multiple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the region of their suppliers, without those of several, and the total with them."""
    line, sup, nation = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    regions = line.select("l_orderkey", "l_suppkey").join(sup, F.col("l_suppkey") == F.col("s_suppkey")).join(nation, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("l_orderkey").agg(F.collect_set("n_regionkey").alias("r"))
    named = regions.select(F.when(F.size("r") > 1, "multiple").otherwise(F.get("r", F.lit(0)).cast("string")).alias("region"))
    by = named.where("region <> 'multiple'").groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    return by.unionByName(named.agg(F.lit("all").alias("region"), F.count(F.lit(1)).alias("n")))


def set_valued_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regions that a part's suppliers come from; 'multiple' if several."""
    line, sup, nation = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    regions = line.select("l_partkey", "l_suppkey").join(sup, F.col("l_suppkey") == F.col("s_suppkey")).join(nation, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("l_partkey").agg(F.collect_set("n_regionkey").alias("r"))
    return regions.select("l_partkey", F.size("r").cast("long").alias("n_regions"), F.when(F.size("r") > 1, "multiple").otherwise(F.get("r", F.lit(0)).cast("string")).alias("region"))


def duplicate_keys_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer's only order on its day; copies of a key go all together."""
    once, _ = model.drop_all_duplicates(fact(spark, sf_dir).select("o_custkey", "d", "o_orderkey"), "o_custkey", "d")
    return once


def ledger_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ledgers of days: later ones win, and days that are only downloaded come in if absent."""
    rows = fact(spark, sf_dir)
    first = rows.where("nation = 'NATION_6'").groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.lit("ok").alias("status"))
    second = rows.where("nation = 'NATION_7'").groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.lit("again").alias("status"))
    only = rows.where("nation = 'NATION_18'").groupBy("d").agg(F.lit("downloaded").alias("status"))
    return model.append_absent(model.merge_ledger([first, second], "d"), only, "d")


def upsert_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete and insert by key."""
    rows = fact(spark, sf_dir)
    old, new = rows.where("season <= 2000").groupBy("nation", "season").agg(F.count(F.lit(1)).alias("n")), rows.where("season >= 2000").groupBy("nation", "season").agg(F.count_if(F.col("amount") > 150000).alias("n"))
    return model.upsert(old, new, "nation", "season")


def absence_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What attempts say about a user: found, missing, empty upstream or failed."""
    attempts = table(spark, sf_dir, "events").select("user_id", F.when(F.col("value") > 95, "ok").when(F.col("value") < 2, "missing").when(F.col("event_type") == "view", "empty").otherwise("error").alias("outcome"))
    return model.absent_roles(attempts, "user_id", "outcome")


def failure_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events at which three low values in a row are reached, by user."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", (F.col("value") < 40).alias("failed"))
    return model.failure_runs(e.where("failed is not null"), ["ts", "event_id"], "failed", 3, "user_id").select("user_id", "event_id")


def anniversary_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A work list of all days, the target's anniversaries ahead, with each day's place."""
    days = fact(spark, sf_dir).select("d").distinct()
    anniversary = (F.month("d") == 7) & (F.dayofmonth("d") == 31)
    return days.select("d", anniversary.alias("anniversary")).orderBy(F.when(anniversary, 0).otherwise(1), "d")


def token_and_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date tokens and content hashes."""
    days = fact(spark, sf_dir).select("d").distinct()
    return days.select("d", seasons.date_token(F.col("d")).alias("token"), text.content_hash(F.date_format("d", "yyyy-MM-dd")).alias("sha"))


QUERIES = {
    f.__name__: f
    for f in (
        coverage_by_date, calendar_gaps, calendar_gap_runs, dim_latest_with_drift, latest_by_max_by, monotonicity_gate, step_identity_gate, cross_check_gate, reconcile_total, verify_days, nested_agg_totals, filter_clause_counts, having_alias, sort_by_absolute,
        join_audit, union_by_name_drift, set_ops_ack, distinct_keep_first, weighted_mean, iqr_quantiles, hist20, class_counts, rollup_without_multiple, set_valued_groups, duplicate_keys_dropped, ledger_merge, upsert_days, absence_classes, failure_runs, anniversary_first, token_and_hash,
    )
}

_GATES = f"""{_DAILY}, v AS (SELECT c.region, c.season, c.dos, CAST(c.total AS DOUBLE) AS v, CAST(COALESCE(dd.n, 0) AS DOUBLE) AS n FROM cum c LEFT JOIN dd ON dd.region = c.region AND dd.season = c.season AND dd.dos = c.dos),
 both_ AS (SELECT 'as is' AS copy, region, season, dos, v, n FROM v UNION ALL SELECT 'spoiled', region, season, dos, {{v}}, {{n}} FROM v),
 l AS (SELECT *, lag(v) OVER (PARTITION BY copy, region, season ORDER BY dos) AS p FROM both_)"""
ORACLES = {
    "coverage_by_date": f"WITH {FACT} SELECT d, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_entities, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open, count(*) FILTER (WHERE amount > 100000) AS n_large FROM fact GROUP BY d",
    "calendar_gaps": f"WITH {FACT}, sp AS (SELECT CAST(unnest(generate_series(DATE '2000-06-01', DATE '2000-10-31', INTERVAL 1 DAY)) AS DATE) AS d), g AS (SELECT d, count(*) AS n_other FROM fact WHERE nation = 'NATION_7' GROUP BY d) SELECT sp.d, g.n_other FROM sp LEFT JOIN (SELECT DISTINCT d FROM fact WHERE nation = 'NATION_6') f ON f.d = sp.d LEFT JOIN g ON g.d = sp.d WHERE f.d IS NULL",
    "calendar_gap_runs": f"WITH {FACT}, sp AS (SELECT CAST(unnest(generate_series(DATE '2000-06-01', DATE '2000-10-31', INTERVAL 1 DAY)) AS DATE) AS d), m AS (SELECT sp.d FROM sp LEFT JOIN (SELECT DISTINCT d FROM fact WHERE nation = 'NATION_6') f ON f.d = sp.d WHERE f.d IS NULL), r AS (SELECT d, date_diff('day', DATE '2000-01-01', d) - row_number() OVER (ORDER BY d) AS g FROM m) SELECT min(d) AS first_day, max(d) AS last_day, count(*) AS n_days FROM r GROUP BY g",
    "dim_latest_with_drift": f"WITH {FACT}, r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC, o_orderkey DESC) AS k FROM fact), a AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_priorities, count(DISTINCT o_orderstatus) AS n_statuses FROM fact GROUP BY 1) SELECT r.o_custkey, d AS d_latest, CAST(amount AS DOUBLE) AS amount_latest, o_orderpriority AS o_orderpriority_latest, n_priorities, n_statuses FROM r JOIN a ON a.o_custkey = r.o_custkey WHERE k = 1",
    "latest_by_max_by": "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) z WHERE k = 1",
    "monotonicity_gate": f"WITH {_GATES.format(v='CASE WHEN dos = 40 THEN v / 2 ELSE v END', n='n')} SELECT copy, count(*) AS n, count(*) FILTER (WHERE v < p - CAST(0.001 AS DOUBLE)) AS n_falls, COALESCE(max(CASE WHEN v < p THEN p - v END), 0) AS worst_fall FROM l GROUP BY copy",
    "step_identity_gate": f"WITH {_GATES.format(v='v', n='CASE WHEN dos = 30 THEN n + 2 ELSE n END')} SELECT copy, count(*) AS n, count(*) FILTER (WHERE abs((v - p) - n) > CAST(1.001 AS DOUBLE)) AS n_broken, COALESCE(max(abs((v - p) - n)), 0) AS worst_residual FROM l WHERE p IS NOT NULL GROUP BY copy",
    "cross_check_gate": "WITH li AS (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS b FROM lineitem GROUP BY 1) SELECT 'lines' AS statement, count(*) AS n, count(*) FILTER (WHERE abs(o_totalprice - b) > 1.0) AS n_differ FROM orders JOIN li ON l_orderkey = o_orderkey UNION ALL SELECT 'itself', count(*), 0 FROM orders",
    "reconcile_total": f"WITH {FACT} SELECT count(DISTINCT nation) AS n_parts, count(DISTINCT nation) AS n_printed, CAST(0 AS DOUBLE) AS residual_amount, TRUE AS ok FROM fact",
    "verify_days": f"WITH {FACT}, r AS (SELECT d, region, min(o_orderpriority) AS p FROM fact GROUP BY 1, 2), a AS (SELECT d, count(*) AS n, count(*) FILTER (WHERE p NOT IN ('1-URGENT','2-HIGH')) AS b FROM r GROUP BY d) SELECT d, CAST(CASE WHEN n <> 5 THEN 1 ELSE 0 END + CASE WHEN b > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_problems, CASE WHEN n <> 5 AND b > 0 THEN 'row_count,vocabulary:p' WHEN n <> 5 THEN 'row_count' WHEN b > 0 THEN 'vocabulary:p' ELSE '' END AS checks FROM a",
    "nested_agg_totals": f"WITH {FACT}, t AS (SELECT season, d, sum(amount) AS t FROM fact GROUP BY 1, 2) SELECT season, CAST(sum(t) AS DOUBLE) / count(*) AS avg_total, CAST(min(t) AS DOUBLE) AS min_total, CAST(max(t) AS DOUBLE) AS max_total, count(*) AS n_days FROM t GROUP BY season",
    "filter_clause_counts": f"WITH {FACT} SELECT season, count(DISTINCT d) FILTER (WHERE EXTRACT(month FROM d) BETWEEN 6 AND 10) AS n_season_days, count(DISTINCT d) FILTER (WHERE o_orderstatus = 'P') AS n_p_days, count(DISTINCT o_custkey) AS n_customers FROM fact GROUP BY season",
    "having_alias": f"WITH {FACT} SELECT nation, count(*) FILTER (WHERE o_orderstatus = 'P') AS differ, count(*) AS n FROM fact GROUP BY nation HAVING differ > 0 ORDER BY differ DESC, nation LIMIT 12",
    "sort_by_absolute": "SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey LIMIT 8",
    "join_audit": "WITH o AS (SELECT DISTINCT o_custkey AS k FROM orders) SELECT count(*) FILTER (WHERE c.c_custkey IS NOT NULL AND o.k IS NOT NULL) AS matched, count(*) FILTER (WHERE o.k IS NULL) AS left_only, count(*) FILTER (WHERE c.c_custkey IS NULL) AS right_only FROM customer c FULL OUTER JOIN o ON o.k = c.c_custkey",
    "union_by_name_drift": "SELECT s_suppkey, s_name, s_acctbal, 24 AS layout FROM supplier WHERE s_suppkey % 2 = 1 UNION ALL SELECT s_suppkey, s_name, NULL, 23 FROM supplier WHERE s_suppkey % 2 = 0",
    "set_ops_ack": f"WITH {FACT}, f AS (SELECT DISTINCT nation, season FROM fact WHERE o_orderstatus = 'P'), k AS (SELECT DISTINCT nation, season FROM fact WHERE amount > 400000) SELECT f.nation, f.season, CASE WHEN k.nation IS NULL THEN 'novel' ELSE 'acknowledged' END AS kind FROM f LEFT JOIN k ON k.nation = f.nation AND k.season = f.season",
    "distinct_keep_first": "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events) z WHERE k = 1",
    "weighted_mean": "SELECT l_suppkey, CASE WHEN sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) <> 0 THEN CAST(sum(CASE WHEN l_returnflag <> 'R' THEN round(l_discount * 100) * l_quantity END) AS DOUBLE) / sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) END AS mean_discount FROM lineitem GROUP BY l_suppkey",
    "iqr_quantiles": "SELECT l_returnflag, quantile_cont(l_quantity, 0.05) AS p5, quantile_cont(l_quantity, 0.25) AS p25, quantile_cont(l_quantity, 0.5) AS p50, quantile_cont(l_quantity, 0.75) AS p75, quantile_cont(l_quantity, 0.95) AS p95, quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) AS iqr FROM lineitem GROUP BY l_returnflag",
    "hist20": "SELECT CAST(least(floor(l_quantity / 50 * 20), 19) AS INT) AS bin, count(*) AS n FROM lineitem GROUP BY 1",
    "class_counts": "SELECT CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 20 THEN 1 WHEN l_quantity < 30 THEN 2 WHEN l_quantity < 40 THEN 3 ELSE 4 END AS class, count(*) AS n FROM lineitem GROUP BY 1",
    "rollup_without_multiple": "WITH s AS (SELECT l_orderkey, count(DISTINCT n_regionkey) AS k, min(n_regionkey) AS r FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY l_orderkey) SELECT CAST(r AS VARCHAR) AS region, count(*) AS n FROM s WHERE k = 1 GROUP BY r UNION ALL SELECT 'all', count(*) FROM s",
    "set_valued_groups": "SELECT l_partkey, count(DISTINCT n_regionkey) AS n_regions, CASE WHEN count(DISTINCT n_regionkey) > 1 THEN 'multiple' ELSE CAST(min(n_regionkey) AS VARCHAR) END AS region FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY l_partkey",
    "duplicate_keys_dropped": f"WITH {FACT} SELECT o_custkey, d, o_orderkey FROM (SELECT o_custkey, d, o_orderkey, count(*) OVER (PARTITION BY o_custkey, d) AS n FROM fact) z WHERE n = 1",
    "ledger_merge": f"WITH {FACT}, a AS (SELECT d, count(*) AS n, 'ok' AS status FROM fact WHERE nation = 'NATION_6' GROUP BY d), b AS (SELECT d, count(*) AS n, 'again' AS status FROM fact WHERE nation = 'NATION_7' GROUP BY d), m AS (SELECT * FROM b UNION ALL SELECT * FROM a WHERE d NOT IN (SELECT d FROM b)) SELECT d, n, status FROM m UNION ALL SELECT DISTINCT d, NULL, 'downloaded' FROM fact WHERE nation = 'NATION_18' AND d NOT IN (SELECT d FROM m)",
    "upsert_days": f"WITH {FACT}, nw AS (SELECT nation, season, count(*) FILTER (WHERE amount > 150000) AS n FROM fact WHERE season >= 2000 GROUP BY 1, 2), od AS (SELECT nation, season, count(*) AS n FROM fact WHERE season <= 2000 GROUP BY 1, 2) SELECT * FROM nw UNION ALL SELECT od.* FROM od LEFT JOIN nw ON nw.nation = od.nation AND nw.season = od.season WHERE nw.nation IS NULL",
    "absence_classes": "WITH a AS (SELECT user_id, CASE WHEN value > 95 THEN 'ok' WHEN value < 2 THEN 'missing' WHEN event_type = 'view' THEN 'empty' ELSE 'error' END AS o FROM events) SELECT user_id, CASE WHEN count(*) FILTER (WHERE o = 'ok') > 0 THEN 'found' WHEN count(*) FILTER (WHERE o = 'missing') > 0 THEN 'missing' WHEN count(*) FILTER (WHERE o = 'empty') = count(*) THEN 'empty_upstream' ELSE 'failed' END AS status FROM a GROUP BY user_id",
    "failure_runs": "WITH e AS (SELECT user_id, ts, event_id, value < 40 AS f, sum(CASE WHEN value < 40 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS b FROM events WHERE value IS NOT NULL), r AS (SELECT *, sum(CASE WHEN f THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, b ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, event_id FROM r WHERE f AND k % 3 = 0",
    "anniversary_first": f"WITH {FACT}, x AS (SELECT DISTINCT d FROM fact) SELECT d, EXTRACT(month FROM d) = 7 AND EXTRACT(day FROM d) = 31 AS anniversary FROM x ORDER BY CASE WHEN EXTRACT(month FROM d) = 7 AND EXTRACT(day FROM d) = 31 THEN 0 ELSE 1 END, d",
    "token_and_hash": f"WITH {FACT}, x AS (SELECT DISTINCT d FROM fact) SELECT d, to_base64(encode(CAST(d AS VARCHAR))) AS token, upper(sha256(CAST(d AS VARCHAR))) AS sha FROM x",
}
