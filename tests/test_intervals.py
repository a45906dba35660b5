"""Interval joins with edges as rows against plain loops."""

import random

from pyspark.sql import functions as F

from rillflow.operators import intervals
from rillflow.sources import layouts


def test_every_group_has_its_own_edges(spark):
    rng = random.Random(2)
    edges = {g: sorted({round(rng.uniform(-50, 50) * 3**k, 1) for _ in range(rng.randint(1, 30))}) for k, g in enumerate(["a", "b", None])}
    values = [(k, rng.choice(["a", "b", "c", None]), rng.choice([rng.uniform(-400, 400), rng.choice(edges["a"]), rng.choice(edges[None]), None, float("nan"), float("inf")])) for k in range(600)]
    frame = spark.createDataFrame([(g, e) for g, es in edges.items() for e in [*es, None, es[0]]], "g string, e double")
    rows = spark.createDataFrame(values, "k int, g string, v double")
    want = {(k, i) for k, g, v in values if v is not None for es in [edges.get(g, [])] for i in range(len(es) - 1) if es[i] <= v < es[i + 1]}
    for width in (None, 0.7, 1000.0):
        got = intervals.interval_join(rows, F.col("v"), intervals.between_edges(frame, ["g"], "e"), ["g"], "i", width).collect()
        assert {(r["k"], r["i"]) for r in got} == want and len(got) == len(want)
    assert intervals.interval_join(rows, F.col("v"), intervals.between_edges(frame.limit(0), ["g"], "e"), ["g"], "i").collect() == []


def test_intervals_that_overlap_and_characters_on_edges(spark):
    spans = spark.createDataFrame([(0, 0.0, 10.0), (1, 5.0, 6.0), (2, 9.0, 30.0)], "index int, low double, high double")
    rows = spark.createDataFrame([(v,) for v in (0.0, 5.5, 9.5, 10.0, 30.0)], "v double")
    got = intervals.interval_join(rows, F.col("v"), spans, [], "i").collect()
    assert sorted((r["v"], r["i"]) for r in got) == [(0.0, 0), (5.5, 0), (5.5, 1), (9.5, 0), (9.5, 2), (10.0, 2)]
    # a character's centre on a rule belongs to what begins there; a page with one rule has no cells
    rects = spark.createDataFrame([(p, x, x + 1, 0.0, 20.0) for p, xs in ((1, (0.0, 10.0, 20.0)), (2, (5.0,))) for x in xs] + [(1, 0.0, 20.0, y, y + 1) for y in (0.0, 9.0)] + [(1, 4.0, 8.0, 4.0, 8.0)], "page int, x0 double, x1 double, top double, bottom double")
    chars = spark.createDataFrame([(1, 9.0, 11.0, 1.0, 3.0, "b"), (1, 1.0, 3.0, 1.0, 3.0, "a"), (1, 12.0, 13.0, 1.0, 3.0, "c"), (1, 19.0, 21.0, 1.0, 3.0, "out"), (2, 5.0, 6.0, 1.0, 2.0, "x")], "page int, x0 double, x1 double, top double, bottom double, char string")
    assert {(r["page"], r["row"], r["col"], r["cell"]) for r in layouts.reassemble_pages(chars, rects, "page").collect()} == {(1, 0, 0, "a"), (1, 0, 1, "bc")}
