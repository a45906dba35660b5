"""Ranks and order statistics in groups of any size against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.operators import order

SCHEMA = "k long, g string, v double"


def made(n, groups, values, seed=0):
    rng = random.Random(seed)
    return [(k, rng.choice(groups), None if rng.random() < 0.05 else float(rng.choice(values))) for k in range(n)]


def by_group(rows):
    out = {}
    for _, g, v in rows:
        if v is not None:
            out.setdefault(g, []).append(v)
    return out


CASES = {
    "many groups": made(400, [None, "", *"abcdefgh"], range(30)),
    "one group of distinct values": [(k, "a", float(v)) for k, v in enumerate(random.Random(1).sample(range(10_000), 1500))],
    "one value in a third of all rows": made(600, ["a"], [7] * 5 + list(range(10)), 3),
    "odd numbers": [(k, "a", v) for k, v in enumerate([0.0, -0.0, float("inf"), float("-inf"), 1e-300, None, -1.5, 1.5, 1.5])],
}


@pytest.mark.parametrize("case", CASES)
def test_positions_ranks_and_quantiles(spark, case):
    rows = CASES[case]
    frame, groups = spark.createDataFrame(rows, SCHEMA).repartition(5), by_group(rows)
    got = {(r["g"], r["v"]): (r["n"], r["before"], r["total"]) for r in order.positions(frame, ["g"], "v", run=64).collect()}
    assert got == {(g, v): (values.count(v), sum(x < v for x in values), len(values)) for g, values in groups.items() for v in values}
    ranked = {r["k"]: r["rank"] for r in order.percent_ranks(frame, ["g"], "v", "rank", "k", run=64).collect()}
    assert len(ranked) == len(rows)
    for k, g, v in rows:
        values = groups.get(g, [])
        assert ranked[k] == (None if v is None else (sum(x < v for x in values) + (values.count(v) + 1) / 2) / len(values))
    if case != "odd numbers":
        shares = {"least": 0.0, "p1": 0.1, "half": 0.5, "p9": 0.9, "most": 1.0}
        for r in order.quantiles(frame, ["g"], "v", shares, run=64).collect():
            assert [r[n] for n in shares] == pytest.approx(np.quantile(groups[r["g"]], list(shares.values())).tolist(), rel=1e-15)
    for r in order.upper_medians(frame, ["g"], "v", "median", run=64).collect():
        assert (r["median"], r["n"]) == (sorted(groups[r["g"]])[len(groups[r["g"]]) // 2], len(groups[r["g"]]))


def test_no_task_holds_a_group(spark, monkeypatch):
    """One group of all rows: runs of the order stay small, and so does what a task sorts."""
    held = []
    real = order.written
    monkeypatch.setattr(order, "written", lambda df, label: held.append(real(df, label)) or held[-1])
    rows = spark.range(200_000).selectExpr("id AS k", "'a' AS g", "double(pmod(id * 7919, 200000)) AS v")
    found = order.positions(rows, ["g"], "v", run=10_000)
    assert found.agg(F.max(F.abs(F.col("v") - F.col("before")))).first()[0] == 0
    sizes = [r["count"] for r in held[-1].groupBy("__run").count().collect()]
    assert len(sizes) > 20 and max(sizes) <= 10_000


def test_nothing_and_whole_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert order.positions(empty, ["g"], "v").collect() == [] and order.quantiles(empty, ["g"], "v", {"half": 0.5}).collect() == []
    assert order.percent_ranks(empty, ["g"], "v", "r", "k").collect() == [] and order.upper_medians(empty, ["g"], "v", "m").collect() == []
    rows = spark.createDataFrame([(1, "a", None), (2, "a", 5.0), (3, "b", 1.0)], SCHEMA).withColumn("n", F.lit("x")).withColumn("before", F.lit("y"))
    assert {(r["k"], r["r"], r["n"]) for r in order.percent_ranks(rows, [], "v", "r", "k").collect()} == {(1, None, "x"), (2, 1.0, "x"), (3, 0.5, "x")}
    assert order.quantiles(rows, [], "v", {"half": 0.5}).first()["half"] == 3.0
