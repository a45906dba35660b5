"""Points against outlines of any number and size, by cells: containment and kilometres to the nearest edge.

Outlines are taken apart to edges, edges to the strips and cells of a grid that they touch. A point is inside where a ray to the
west crosses an odd number of its outline's edges; those that can cross it lie in the point's strip. For the distance, cells
bound it from both sides before any edge is looked at: the nearest edge is no farther than the far corner of any cell that has
one, so only cells nearer than the least of these count, blocks of cells first and then their cells. Everything is joined by
name and place. Nothing is collected or sent whole to the tasks, and rows of a place that many points share are dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rillflow import config
from rillflow.session import written

#: Degrees of a cell, cells of a block in each direction as a power of two, and tasks that share a place's points.
CELL, BLOCK_BITS, SALTS = 0.05, 4, 8
#: Room for rounding in bounds, as a share.
ROOM = 1e-9


def edges(outlines: DataFrame, name: str, geometry: str) -> DataFrame:
    """(name, polygon, x1, y1, x2, y2): each edge of each ring, holes included; rings closed or not.

    geometry is an array of polygons, a polygon an array of rings, a ring one of points [lon, lat]. Null names, geometries and
    empty rings have no edges.
    """
    whole = outlines.where(F.col(name).isNotNull()).select(F.col(name).alias("name"), F.monotonically_increasing_id().alias("__row"), F.posexplode(geometry).alias("__part", "rings"))
    ring = whole.select("name", F.struct("__row", "__part").alias("polygon"), F.explode("rings").alias("ring")).where(F.size("ring") > 0)
    turned = F.concat(F.slice("ring", 2, F.greatest(F.size("ring") - 1, F.lit(0))), F.slice("ring", 1, 1))
    pair = ring.select("name", "polygon", F.explode(F.arrays_zip(F.col("ring").alias("a"), turned.alias("b"))).alias("e"))
    return pair.select("name", "polygon", *(F.col(f"e.{end}")[k].cast("double").alias(f"{axis}{n}") for n, end in ((1, "a"), (2, "b")) for k, axis in enumerate("xy")))


def _cell(value: Column, step: float) -> Column:
    return F.floor(value / F.lit(step))


def stripped(rows: DataFrame, step: float) -> DataFrame:
    """Edges in each strip that they reach."""
    return rows.withColumn("cy", F.explode(F.sequence(_cell(F.least("y1", "y2"), step), _cell(F.greatest("y1", "y2"), step))))


def touched(rows: DataFrame, step: float) -> DataFrame:
    """Edges in each cell (cy, cx) that they pass: within a strip, from the cell where the edge enters to that where it leaves."""
    low, high = (pick(F.col("y1"), F.col("y2")) for pick in (F.least, F.greatest))
    at = lambda y: F.greatest(F.least("x1", "x2"), F.least(F.greatest("x1", "x2"), F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0)))))
    flat = F.col("y1") == F.col("y2")
    enters, leaves = at(F.greatest(low, F.col("cy") * step)), at(F.least(high, (F.col("cy") + 1) * step))
    a, b = F.when(flat, F.col("x1")).otherwise(enters), F.when(flat, F.col("x2")).otherwise(leaves)
    return stripped(rows, step).withColumn("cx", F.explode(F.sequence(_cell(F.least(a, b), step), _cell(F.greatest(a, b), step))))


def _met(points: DataFrame, table: DataFrame, on: list[str], salts: int) -> DataFrame:
    """Points joined with a table by place; the points of one place are dealt to `salts` tasks."""
    dealt = points.withColumn("__salt", F.pmod(F.xxhash64("pid"), F.lit(salts)).cast("int"))
    return dealt.join(table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), [*on, "__salt"]).drop("__salt")


def _scales() -> tuple[Column, Column]:
    """Kilometres of a degree east and north at a point."""
    return config.KM_PER_DEGREE * F.cos(F.radians("y")), F.lit(config.KM_PER_DEGREE_NORTH)


def _box(cy: str, cx: str, size: float) -> tuple[Column, Column, Column]:
    """Least and largest kilometres, and least degrees, from a point to a cell."""
    west, south = F.col(cx) * size, F.col(cy) * size
    dx = F.greatest(west - F.col("x"), F.lit(0.0), F.col("x") - west - size)
    dy = F.greatest(south - F.col("y"), F.lit(0.0), F.col("y") - south - size)
    fx = F.greatest(F.abs(F.col("x") - west), F.abs(F.col("x") - west - size))
    fy = F.greatest(F.abs(F.col("y") - south), F.abs(F.col("y") - south - size))
    kx, ky = _scales()
    return F.hypot(dx * kx, dy * ky), F.hypot(fx * kx, fy * ky), F.hypot(dx, dy)


def _near(rows: DataFrame, cy: str, cx: str, size: float, buffer: float) -> DataFrame:
    """The cells of each point that can hold its nearest edge or one within the buffer."""
    least, most, degrees = _box(cy, cx, size)
    bound = F.min(most).over(W.partitionBy("pid"))
    return rows.withColumn("__bound", bound).where((least <= F.col("__bound") * (1 + ROOM) + ROOM) | (degrees <= buffer + ROOM)).drop("__bound")


def contained(points: DataFrame, rows: DataFrame, step: float = CELL, salts: int = SALTS) -> DataFrame:
    """(pid, name) of points (pid, name, x, y) that lie inside a polygon of that name: even-odd over its rings, so not in holes."""
    strips = stripped(rows.where("y1 <> y2"), step)
    met = _met(points.withColumn("cy", _cell(F.col("y"), step)), strips, ["name", "cy"], salts)
    east = F.col("x") < (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    crossed = met.where(((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))) & east)
    return crossed.groupBy("pid", "name", "polygon").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1").select("pid", "name").distinct()


def nearest_edge(points: DataFrame, rows: DataFrame, step: float = CELL, buffer: float = config.OUTLINE_BUFFER, salts: int = SALTS) -> DataFrame:
    """(pid, degrees, km) of points (pid, name, x, y) to the nearest edge of any outline they are given with.

    degrees is exact where it is at most the buffer, and no less than the truth else.
    """
    fine = written(touched(rows, step), "outline-cells")
    block = lambda c: F.shiftright(F.col(c), BLOCK_BITS)
    cells = fine.select("name", "cy", "cx", block("cy").alias("by"), block("cx").alias("bx")).distinct()
    blocks = _near(_met(points, cells.select("name", "by", "bx").distinct(), ["name"], salts), "by", "bx", step * (1 << BLOCK_BITS), buffer)
    kept = _near(_met(blocks, cells, ["name", "by", "bx"], salts), "cy", "cx", step, buffer).select("pid", "name", "x", "y", "cy", "cx")
    met = _met(kept, fine.drop("polygon"), ["name", "cy", "cx"], salts)

    def apart(kx: Column, ky: Column) -> Column:
        px, py, dx, dy = (F.col("x1") - F.col("x")) * kx, (F.col("y1") - F.col("y")) * ky, (F.col("x2") - F.col("x1")) * kx, (F.col("y2") - F.col("y1")) * ky
        length = dx * dx + dy * dy
        t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(px * dx + py * dy) / length))).otherwise(0.0)
        return F.hypot(px + t * dx, py + t * dy)

    return met.groupBy("pid").agg(F.min(apart(F.lit(1.0), F.lit(1.0))).alias("degrees"), F.min(apart(*_scales())).alias("km"))


def km_outside(points: DataFrame, outlines: DataFrame, *, parents: str, lon: str, lat: str, name: str = "name", geometry: str = "geometry", step: float = CELL, buffer: float = config.OUTLINE_BUFFER, salts: int = SALTS) -> DataFrame:
    """points with `km`: 0 inside an outline of any of its parents, or within the buffer around one, else kilometres to the
    nearest edge of them; and `inside`, the parents that hold it, in their order. Both null where no parent has an outline or
    the place is unknown.

    parents is an array of names. Rows that repeat are judged each. Without outlines all is null.
    """
    placed = written(points.withColumn("__pid", F.monotonically_increasing_id()), "outline-points")
    rows = written(edges(outlines, name, geometry), "outline-edges")
    each = placed.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(F.col("__pid").alias("pid"), F.explode(F.array_distinct(parents)).alias("name"), F.col(lon).cast("double").alias("x"), F.col(lat).cast("double").alias("y"))
    known = written(each.join(rows.select("name").distinct(), "name", "left_semi"), "outline-known")
    held = written(contained(known, rows, step, salts), "outline-held")
    far = nearest_edge(known.join(held.select("pid").distinct(), "pid", "left_anti"), rows, step, buffer, salts)
    where = held.groupBy("pid").agg(F.collect_set("name").alias("names"))
    told = known.select("pid").distinct().join(where, "pid", "left").join(far, "pid", "left")
    km = F.when(F.col("names").isNotNull() | (F.col("degrees") <= buffer), 0.0).otherwise(F.col("km"))
    told = told.select(F.col("pid").alias("__pid"), km.alias("km"), F.coalesce("names", F.array().cast("array<string>")).alias("__names"))
    return placed.join(told, "__pid", "left").withColumn("inside", F.when(F.col("__names").isNotNull(), F.filter(F.array_distinct(parents), lambda p: F.array_contains("__names", p)))).drop("__pid", "__names")
