"""Outlines by cells against every point and edge in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.operators import geo, outlines

SCHEMA = "name string, geometry array<array<array<array<double>>>>"


def star(rng, x, y, size, n, closed=True):
    ring = [[x + size * (0.4 + 0.6 * rng.random()) * math.cos(2 * math.pi * k / n), y + size * (0.4 + 0.6 * rng.random()) * math.sin(2 * math.pi * k / n)] for k in range(n)]
    return [*ring, ring[0]] if closed else ring


def brute(shapes, parents, x, y, buffer):
    """(km, names that hold the point), by the functions on whole outlines."""
    names = [p for p in dict.fromkeys(parents) if p in shapes]
    if not names or x is None or y is None:
        return None, None
    at = np.array([x]), np.array([y])
    polygons = {n: [[np.asarray(r, float) for r in p if r] for p in shapes[n]] for n in names}
    inside = [n for n in names if any(geo.inside(p, *at)[0] for p in polygons[n])]
    return min(geo.km_outside(polygons[n], *at, buffer)[0] for n in names), inside


def compare(spark, shapes, points, buffer=0.01, **how):
    frame = spark.createDataFrame([(n, [p]) for n, polygons in shapes.items() for p in polygons], SCHEMA)  # a part of an outline in each row
    got = outlines.km_outside(spark.createDataFrame(points, "k long, parents array<string>, lon double, lat double"), frame, parents="parents", lon="lon", lat="lat", buffer=buffer, **how).collect()
    assert sorted(r["k"] for r in got) == sorted(p[0] for p in points)
    by = {r["k"]: r for r in got}
    for k, parents, x, y in points:
        km, inside = brute(shapes, parents or [], x, y, buffer)
        assert by[k]["inside"] == inside, (k, parents, x, y)
        assert by[k]["km"] == (km if km is None else pytest.approx(km, rel=1e-9, abs=1e-9)), (k, parents, x, y)


@pytest.mark.parametrize("step", [0.05, 0.7, 5.0])
def test_stars_with_holes_and_parts(spark, step):
    rng = random.Random(3)
    shapes = {f"s{k}": [[star(rng, 72 + k, 22 + k % 3, 0.9, 40), star(rng, 72 + k, 22 + k % 3, 0.2, 9, False)], [star(rng, 73 + k, 24, 0.3, 7)]] for k in range(5)}
    corners = [(n, p) for n, polygons in shapes.items() for polygon in polygons for ring in polygon for p in ring]
    points = [(k, rng.sample([*shapes, "nowhere"], rng.choice([1, 2, 3])), 71.5 + 6 * rng.random(), 20.5 + 4.5 * rng.random()) for k in range(150)]
    points += [(1000 + k, [n], *p) for k, (n, p) in enumerate(rng.sample(corners, 40))]  # on corners
    points += [(2000 + k, [n, "s0"], p[0] + rng.choice([-1, 1]) * 0.009, p[1]) for k, (n, p) in enumerate(rng.sample(corners, 40))]  # about the buffer's edge
    compare(spark, shapes, points, step=step)


def test_points_in_on_and_beside_the_edges_of_squares(spark):
    """Whole numbers on the borders of cells, horizontal and upright edges, a hole, far points, negative places."""
    square = lambda lo, hi: [[lo, lo], [hi, lo], [hi, hi], [lo, hi], [lo, lo]]
    shapes = {"a": [[square(0.0, 8.0), square(3.0, 6.0)]], "b": [[square(-4.0, -1.0)], [square(10.0, 11.0)]]}
    points = [(100 * x + y + 5000, ["a", "b"] if (x + y) % 2 else ["a"], x / 2, y / 2) for x in range(-12, 26, 3) for y in range(-12, 26, 2)]
    points += [(1, ["b"], 150.0, 60.0), (2, ["b", "a"], -170.0, -80.0)]
    compare(spark, shapes, points, buffer=0.0, step=0.5)
    compare(spark, shapes, points, step=0.25, salts=1)


def test_odd_points_and_outlines(spark):
    shapes = {"a": [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]], []]], "dot": [[[[5.0, 5.0]]]]}
    points = [(1, None, 0.5, 0.2), (2, [], 0.5, 0.2), (3, ["a", "a"], None, 0.2), (4, ["a"], 0.5, None), (5, ["a", "a", "x"], 0.9, 0.2), (6, ["dot"], 5.0, 6.0), (7, ["x"], 0.5, 0.2), (8, [None, "a"], 2.0, 0.5)]
    compare(spark, shapes, points)
    frame = spark.createDataFrame([("a", None), (None, [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]]]])], SCHEMA)
    where = spark.createDataFrame(points, "k long, parents array<string>, lon double, lat double").withColumns({c: F.lit("x") for c in ("name", "x", "pid", "cy")})
    assert {(r["km"], r["inside"]) for r in outlines.km_outside(where, frame, parents="parents", lon="lon", lat="lat").collect()} == {(None, None)}
    assert outlines.km_outside(where.limit(0), frame, parents="parents", lon="lon", lat="lat").collect() == []


def test_a_hot_cell_and_repeated_rows(spark):
    shapes = {"a": [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]]}
    frame = spark.createDataFrame(list(shapes.items()), SCHEMA)
    points = spark.range(3000).selectExpr("0 AS k", "array('a') AS parents", "if(id < 2000, 0.5D, 1.5D) AS lon", "0.5D AS lat")
    got = outlines.km_outside(points, frame, parents="parents", lon="lon", lat="lat")
    assert {(r["n"], r["km"]) for r in got.groupBy(F.round("km", 3).alias("km")).agg(F.count(F.lit(1)).alias("n")).collect()} == {(2000, 0.0), (1000, round(0.5 * 111.32 * math.cos(math.radians(0.5)), 3))}
