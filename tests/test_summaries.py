"""Summaries merged in any grouping against the whole series."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from rillflow.operators import capacity, crossover, summaries

KEY, DAY = ["k", "season"], datetime.date(2024, 6, 1)
SCHEMA = "k int, season int, d date, v double"


def made(seed):
    rng, out = random.Random(seed), []
    for k in range(8):
        value, odd = 100.0 + k, rng.random()
        for n in range(60):
            if rng.random() < 0.15:
                continue
            v = value * (1.3 if (odd < 0.3 and n < 2) or (odd > 0.7 and n > 40) else 1.0) * (1.001 if rng.random() < 0.2 else 1)
            out.append((k, 2024 - k % 2, DAY + datetime.timedelta(n), None if rng.random() < 0.05 else v))
    rng.shuffle(out)
    return out


def rows_of(frame):
    return sorted(map(str, (tuple(r[c] for c in sorted(frame.columns)) for r in frame.collect())))


@pytest.mark.parametrize("seed", range(2))
def test_any_grouping_is_the_whole(spark, seed):
    rng, rows = random.Random(seed), made(seed)
    whole = spark.createDataFrame(rows, SCHEMA)
    want = summaries.summarize(whole, KEY, "d", "v")
    assert rows_of(summaries.unfold(want, KEY, "d", "v")) == rows_of(whole) and want.count() < len(rows) / 1.5
    days = sorted({r[2] for r in rows})
    rng.shuffle(days)
    cuts = [set(days[k::4]) for k in range(4)]
    parts = [summaries.summarize(spark.createDataFrame([r for r in rows if r[2] in cut], SCHEMA), KEY, "d", "v") for cut in cuts]
    for grouping in (summaries.merge(KEY, *parts), summaries.merge(KEY, summaries.merge(KEY, parts[3], parts[1]), summaries.merge(KEY, parts[0], parts[2])), summaries.merge(KEY, parts[2], summaries.merge(KEY, parts[1], summaries.merge(KEY, parts[0], parts[3])))):
        assert rows_of(grouping) == rows_of(want) and summaries.clashes(grouping, KEY).count() == 0
    assert rows_of(summaries.classify(want, KEY)) == rows_of(capacity.classify(whole, KEY, ["d"], "v"))
    twice = summaries.merge(KEY, parts[0], parts[0])
    assert summaries.clashes(twice, KEY).count() == len({r[:2] for r in rows if r[2] in cuts[0]})


def test_crossings_of_a_summary(spark):
    rng = random.Random(5)
    flags = [(k, day, rng.random() < (0.8 if day > 20 * (k % 3) else 0.1)) for k in range(9) for day in range(1, 80) if rng.random() < 0.8]
    entities = spark.createDataFrame([(k,) for k in range(11)], "k int")
    days = spark.createDataFrame([(k, day, n, below) for (k, day, below), n in zip(flags, [sum(1 for f in flags if f[0] == k and f[1] < day) for k, day, _ in flags], strict=True)], "k int, day int, seq int, below boolean")
    parts = [summaries.summarize(spark.createDataFrame(flags[k::3], "k int, day int, below boolean"), ["k"], "day", "below") for k in range(3)]
    got = summaries.crossings(summaries.merge(["k"], *parts), entities, "k", 4)
    assert rows_of(got) == rows_of(crossover.crossover(entities, days, "k", "day", 4))


def test_a_day_is_folded_into_its_season_alone(spark, tmp_path):
    rows, path = made(7), f"{tmp_path}/summary"
    frame = lambda picked: spark.createDataFrame(picked, SCHEMA)
    early = [r for r in rows if r[2] < DAY + datetime.timedelta(40)]
    summaries.add_day(spark, path, frame(early), KEY, "d", "v", "season")
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "summary/season=2023").iterdir()}
    for n in range(40, 43):
        day = [r for r in rows if r[2] == DAY + datetime.timedelta(n) and r[1] == 2024]
        for _ in range(2):  # again changes nothing
            summaries.add_day(spark, path, frame(day), KEY, "d", "v", "season")
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "summary/season=2023").iterdir()} == stamps
    held = [*early, *(r for r in rows if DAY + datetime.timedelta(40) <= r[2] < DAY + datetime.timedelta(43) and r[1] == 2024)]
    stored = spark.read.parquet(path).select(*KEY, *summaries.RUN)
    assert rows_of(stored) == rows_of(summaries.summarize(frame(held), KEY, "d", "v"))
    changed = [(*r[:3], 1.0) if r[2] == DAY + datetime.timedelta(10) and r[1] == 2024 else r for r in held]
    summaries.add_day(spark, path, frame([r for r in changed if r not in held]), KEY, "d", "v", "season")  # a day that is loaded anew
    assert rows_of(spark.read.parquet(path).select(*KEY, *summaries.RUN)) == rows_of(summaries.summarize(frame(changed), KEY, "d", "v"))
    assert summaries.add_day(spark, path, frame(rows).limit(0), KEY, "d", "v", "season").count() == 0
    assert rows_of(summaries.classify(spark.read.parquet(path).select(*KEY, *summaries.RUN), KEY)) == rows_of(capacity.classify(frame(changed), KEY, ["d"], "v")) and F


def test_where_a_value_changed_and_how_far_that_can_be_said(spark):
    """Exact, with unread and absent days between, a third value, the old one again, and values that never come."""
    series = {
        "exact": {0: 1.0, 1: 1.0, 2: 2.0}, "bracket": {0: 1.0, 1: None, 4: 2.0, 5: None}, "third": {0: 1.0, 1: 7.0, 2: None, 3: 2.0}, "again": {0: 1.0, 1: 2.0, 2: 1.0}, "never_new": {0: 1.0, 1: None}, "never_old": {0: None, 1: 2.0}, "near": {0: 1.001, 1: 1.999},
    }
    rows = [(k, DAY + datetime.timedelta(n), v, 1.0, 2.0) for k, days in series.items() for n, v in days.items()] + [("exact", None, 1.0, 1.0, 2.0), (None, DAY, 1.0, 1.0, 2.0)]
    got = {r["k"]: (r["n_third"], r["n_unread"], r["n_absent"], r["verdict"]) for r in capacity.change_bracket(spark.createDataFrame(rows, "k string, d date, v double, o double, w double"), ["k"], "d", "v", "o", "w").collect()}
    assert got == {"exact": (0, 0, 0, "exact"), "bracket": (0, 1, 2, "bracket"), "third": (1, 1, 0, "third_value"), "again": (0, 0, 0, "old_again"), "never_new": (0, 0, 0, "never_new"), "never_old": (0, 0, 0, "never_old"), "near": (0, 0, 0, "exact"), None: (0, 0, 0, "never_new")}
