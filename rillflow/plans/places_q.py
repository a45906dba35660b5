"""Queries on places: distances to outlines of several parents, a placement run with its exclusions, grids of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillflow.operators import outlines, placement
from rillflow.sources import layouts
from rillflow.sources.tables import table


def _shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A square with a square hole for each nation, in a grid of ten degrees."""
    n = table(spark, sf_dir, "nation")
    west, south = F.col("n_nationkey") % 5 * 10.0, F.floor(F.col("n_nationkey") / 5) * 10.0
    square = lambda lo, hi: F.array(*(F.array(west + x, south + y) for x, y in ((lo, lo), (hi, lo), (hi, hi), (lo, hi), (lo, lo))))
    return n.select(F.col("n_name").alias("name"), F.array(F.array(square(0.0, 8.0), square(3.0, 6.0))).alias("geometry"))


def outline_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metres from customers' points to the nearest of two nations' outlines, and how many of these hold the point."""
    n = table(spark, sf_dir, "nation")
    own, other = n.select(F.col("n_nationkey").alias("own"), F.col("n_name").alias("a")), n.select(F.col("n_nationkey").alias("other"), F.col("n_name").alias("b"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("own"), ((F.col("c_nationkey") + 1 + F.col("c_custkey") % 3) % 25).alias("other"))
    lon, lat = F.col("own") % 5 * 10.0 + F.col("c_custkey") % 10, F.floor(F.col("own") / 5) * 10.0 + F.col("c_custkey") % 9
    points = c.join(own, "own").join(other, "other").select("c_custkey", F.array("a", "b").alias("parents"), lon.alias("lon"), lat.alias("lat"))
    found = outlines.km_outside(points, _shapes(spark, sf_dir), parents="parents", lon="lon", lat="lat", step=0.5)
    return found.select("c_custkey", F.round(F.col("km") * 1000, 0).cast("long").alias("metres"), F.size("inside").cast("long").alias("n_inside"))


def placement_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers placed by a register made of customers, of equal names: tiers, claims and reasons of all that are left out."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    known = c.join(n, nation == F.col("n_nationkey"))
    # every seventh shares the name before it; every fifth has no nation; names of some have a letter in parentheses
    name = F.concat(F.lit("weir "), F.when(k % 7 == 0, k - 1).otherwise(k).cast("string"), F.when(k % 11 == 0, " (b)").otherwise(""))
    entities = known.select(k.alias("id"), name.alias("name"), F.when(k % 5 == 0, F.array(F.lit("nowhere"))).otherwise(F.array("n_name")).alias("parents"), (F.lit(100.0) + k % 13).alias("capacity"), "c_mktsegment")
    entities = entities.withColumnRenamed("c_mktsegment", "subdistrict")
    west, south = nation % 5 * 10.0, F.floor(nation / 5) * 10.0
    printed = F.concat(F.lit("Weir "), k.cast("string"), F.when(k % 11 == 0, " (b)").otherwise(""))
    register = c.where(k % 17 != 0).select(k.alias("id"), printed.alias("name"), F.when(k % 3 == 0, 100.0 + k % 13).when(k % 3 == 1, 300.0).alias("capacity"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("subdistrict"), (west + 0.5 + k % 9).alias("lon"), (south + 1.5).alias("lat"))
    done = placement.place(entities, register, _shapes(spark, sf_dir), box=(-180.0, -90.0, 180.0, 90.0), least=1.0, step=0.5)
    return done.placed.select("id", "source_id", "tier", F.lit(None).cast("string").alias("reason")).unionByName(done.excluded.select("id", "source_id", F.lit(None).cast("string").alias("tier"), "reason"))


def page_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' names as characters on pages, each page with a ruled grid of its own place and width, put together by cells."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("page"), (2 + F.col("c_custkey") % 3).alias("w"), (F.col("c_custkey") % 7 * 1.3).alias("shift"), "c_name")
    chars = c.select("page", "w", "shift", F.posexplode(F.split("c_name", "")).alias("at", "char")).withColumn("x0", F.col("shift") + F.col("at") * 3.0 + 0.5)
    # two lines of a cell: the second half of a cell's characters stands below the first and further left
    line = (F.col("at") % F.col("w") >= F.floor(F.col("w") / 2 + 0.5)).cast("int")
    characters = chars.select("page", "x0", (F.col("x0") + 2).alias("x1"), (F.col("shift") + line * 6.0 + 1).alias("top"), (F.col("shift") + line * 6.0 + 6).alias("bottom"), "char")
    rule = lambda x0, x1, top, bottom: F.struct(x0.alias("x0"), x1.alias("x1"), top.alias("top"), bottom.alias("bottom"))
    s, w = F.col("shift"), F.col("w")
    upright = F.transform(F.sequence(F.lit(0), F.floor(12 / w).cast("int")), lambda k: rule(s + k * w * 3.0, s + k * w * 3.0 + 1, s, s + 30.0))
    flat = F.transform(F.array(F.lit(0), F.lit(15)), lambda k: rule(s, s + 60.0, s + k, s + k + 1.0))
    rects = c.select("page", F.explode(F.concat(upright, flat)).alias("r")).select("page", "r.*")
    return layouts.reassemble_pages(characters, rects, "page").select("page", F.col("col").cast("long").alias("col"), "cell")


QUERIES = {f.__name__: f for f in (outline_parents, placement_run, page_grids)}
_KM = "sqrt((greatest(-{x}, {x} - 8, 0) * kx) ** 2 + (greatest(-{y}, {y} - 8, 0) * 110.57) ** 2)"
_HOLE = "({x} > 3 AND {x} < 6 AND {y} > 3 AND {y} < 6)"
_IN = "({x} >= 0 AND {x} < 8 AND {y} >= 0 AND {y} < 8 AND NOT ({x} >= 3 AND {x} < 6 AND {y} >= 3 AND {y} < 6))"


def _metres(x: str, y: str) -> str:
    return f"CASE WHEN {_HOLE.format(x=x, y=y)} THEN least(({x} - 3) * kx, (6 - {x}) * kx, ({y} - 3) * 110.57, (6 - {y}) * 110.57) ELSE {_KM.format(x=x, y=y)} END"


ORACLES = {
    "page_grids": """WITH c AS (SELECT c_custkey AS page, 2 + c_custkey % 3 AS w, c_name FROM customer), k AS (SELECT page, w, c_name, unnest(generate_series(0, 12 // w - 1)) AS col FROM c)
 SELECT page, CAST(col AS BIGINT) AS col, substr(c_name, col * w + 1, w) AS cell FROM k WHERE col * w < length(c_name)""",
    "outline_parents": f"""WITH c AS (SELECT c_custkey, c_nationkey AS o, (c_nationkey + 1 + c_custkey % 3) % 25 AS p FROM customer),
 x AS (SELECT *, CAST(o % 5 * 10 + c_custkey % 10 AS DOUBLE) AS lon, CAST(o // 5 * 10 + c_custkey % 9 AS DOUBLE) AS lat FROM c),
 y AS (SELECT *, lon - o % 5 * 10 AS xa, lat - o // 5 * 10 AS ya, lon - p % 5 * 10 AS xb, lat - p // 5 * 10 AS yb, 111.32 * cos(radians(lat)) AS kx FROM x)
 SELECT c_custkey, CAST(round(1000 * least({_metres('xa', 'ya')}, {_metres('xb', 'yb')})) AS BIGINT) AS metres, CAST({_IN.format(x='xa', y='ya')} AS BIGINT) + CAST({_IN.format(x='xb', y='yb')} AS BIGINT) AS n_inside FROM y""",
    "placement_run": """WITH e AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN c_custkey - 1 ELSE c_custkey END AS num, c_custkey % 11 = 0 AS paren, c_custkey % 5 = 0 AS nowhere, c_nationkey AS nation, 100 + c_custkey % 13 AS cap, c_mktsegment AS seg FROM customer),
 r AS (SELECT c_custkey AS source_id, c_custkey % 11 = 0 AS rparen, c_nationkey AS rnation, CASE c_custkey % 3 WHEN 0 THEN 100 + c_custkey % 13 WHEN 1 THEN 300 END AS rcap, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS rseg, CAST(c_custkey % 9 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS dx FROM customer WHERE c_custkey % 17 <> 0),
 j AS (SELECT e.*, r.*, rnation % 5 * 10 + dx - nation % 5 * 10 AS x, rnation // 5 * 10 + CAST(1.5 AS DOUBLE) - nation // 5 * 10 AS y, rnation // 5 * 10 + CAST(1.5 AS DOUBLE) AS lat, CASE WHEN rcap IS NOT NULL THEN abs(cap - rcap) / CAST(greatest(cap, rcap) AS DOUBLE) END AS diff FROM e LEFT JOIN r ON r.source_id = e.num AND r.rparen = e.paren),
 k AS (SELECT *, CASE WHEN nowhere THEN NULL ELSE sqrt((greatest(-x, x - 8, 0) * 111.32 * cos(radians(lat))) ** 2 + (greatest(-y, y - 8, 0) * 110.57) ** 2) END AS km, COALESCE(diff <= CAST(0.10 AS DOUBLE), FALSE) AS cok, COALESCE(rseg = seg, FALSE) AS sok FROM j),
 t AS (SELECT *, CASE WHEN source_id IS NULL OR (paren AND NOT cok) THEN NULL WHEN km IS NULL THEN CASE WHEN cok THEN 'B2' END WHEN km = 0 THEN CASE WHEN cok THEN 'A' WHEN sok THEN 'B' ELSE 'C' END WHEN km <= 7 AND cok THEN 'A-bdy' END AS tier FROM k),
 p AS (SELECT *, row_number() OVER (PARTITION BY source_id, tier IS NULL ORDER BY COALESCE(diff, 1e9), CAST(sok AS INT) DESC, id) AS place FROM t)
 SELECT id, source_id, CASE WHEN place = 1 OR tier IS NULL THEN tier END AS tier, CASE WHEN source_id IS NULL THEN 'no row of the register found' WHEN tier IS NOT NULL THEN CASE WHEN place > 1 THEN 'another has the better claim to its row' END WHEN paren AND NOT cok THEN 'variant in parentheses, capacity disagrees' WHEN km IS NULL OR km = 0 THEN 'nothing corroborates the match' WHEN km > 7 THEN 'position contradicts the district' ELSE 'near the district''s edge, capacity disagrees' END AS reason FROM p""",
}
