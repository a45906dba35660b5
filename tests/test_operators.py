"""Composite operators on hand-written rows."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.operators import baseline, capacity, composite, crossover, document, geo, integrity, matching, model
from rillflow.sources import daily, layouts
from rillflow.streaming import daily as streams

DAY = dt.date(2024, 6, 1)


def season(spark, values, entity=1):
    return spark.createDataFrame([(entity, 2024, DAY + dt.timedelta(k), v) for k, v in enumerate(values)], "e int, season int, d date, v double")


@pytest.mark.parametrize(
    "values, kind, value",
    [
        ([5.0] * 4, "clean", 5.0),
        ([4.0] + [5.0] * 4, "edge_exception", 5.0),
        ([4.0] * 2 + [5.0] * 4, "edge_exception", 5.0),
        ([4.0] * 3 + [5.0] * 9, "mid_season", None),
        ([4.0] * 2 + [5.0] * 2, "mid_season", None),
        ([5.0] * 3 + [4.0] + [5.0] * 3, "mid_season", None),
        ([24.44, 24.45, 24.45], "clean", 24.45),
        ([None, None], None, None),
        ([0.0, 0.0], "clean", 0.0),
        ([28.65] * 67 + [24.45] * 85, "mid_season", None),
    ],
)
def test_season_class(spark, values, kind, value):
    row = capacity.classify(season(spark, values), ["e", "season"], ["d"], "v").first()
    assert (row["capacity_class"], row["capacity"]) == (kind, value)


def test_clusters_do_not_chain(spark):
    out = season(spark, [24.44, 24.45, 24.84, 28.65, 0.0]).agg(capacity.clusters(F.col("v"))).first()[0]
    assert [(r["lo"], r["rep"]) for r in out] == [(0.0, 0.0), (24.44, 24.45), (24.84, 24.84), (28.65, 28.65)]


def test_restatement_shapes(spark):
    rows = [(1, 2020, 5.0), (1, 2021, 6.0), (1, 2022, 5.0), (2, 2020, 5.0), (2, 2022, 7.0), (3, 2020, 5.0), (3, 2021, 5.0)]
    frame = spark.createDataFrame([(e, s, v, dt.date(s, 6, 1), dt.date(s, 10, 1)) for e, s, v in rows], "e int, s int, v double, a date, b date")
    out = {(r["e"], r["season_after"]): (r["shape"], r["direction"]) for r in capacity.restatements(frame, "e", "s", "v", "a", "b").collect()}
    assert out == {(1, 2021): ("oscillating", "up"), (1, 2022): ("oscillating", "down"), (2, 2022): ("single_step", "up")}


def test_baseline_tests_each_row(spark):
    today = spark.createDataFrame([(1, 100.0, 50.0), (2, None, 10.0)], "e int, c double, pct double")
    prior = spark.createDataFrame([(1, 2020, 100.4, 60.0, False), (1, 2021, 100.6, 70.0, False), (1, 2022, 100.0, 80.0, True), (1, 2023, None, 90.0, None), (2, 2020, 5.0, 1.0, False)], "e int, s int, c double, pct double, mid boolean")
    marked = baseline.comparable(prior, today, "e", "c", "mid")
    out = {r["e"]: r for r in baseline.deviations(today, baseline.baseline(marked, "e", "s", "pct"), "e", "pct").collect()}
    assert (out[1]["years_used"], out[1]["prior_mean"], out[1]["deviation"], out[1]["n_dropped_mid"], out[1]["n_dropped_capacity"]) == ("2020", 60.0, -10.0, 1, 2)
    assert out[2]["orphan"] and out[2]["deviation"] is None


def test_crossover_cases(spark):
    priors = spark.createDataFrame([(e, d, s, 10.0) for e in range(6) for d in range(1, 13) for s in (1, 2) if not (e == 3 and d == 6 and s == 2)], "e int, d int, s int, v double")
    below = {0: set(), 1: set(range(1, 8)), 2: set(range(4, 9)), 3: set(range(4, 10)), 4: set(range(10, 13))}
    current = spark.createDataFrame([(e, d, 3, 9.0 if d in days else 10.0) for e, days in below.items() for d in range(1, 13)], "e int, d int, s int, v double")
    days = crossover.evaluable_days(current, priors, "e", "d", "s", "v", 2)
    out = {r["e"]: r for r in crossover.crossover(spark.range(6).select(F.col("id").cast("int").alias("e")), days, "e", "d").collect()}
    assert [out[e]["case"] for e in range(6)] == ["never_below", "below_from_start", "crossed", "crossed", "never_below", "not_evaluable"]
    assert (out[2]["cross_day"], out[2]["run_end_day"], out[2]["recovered_day"], out[2]["currently_below"]) == (4, 8, 9, False)
    assert out[3]["cross_day"] == 4 and out[3]["run_end_day"] == 9  # day 6 can't be compared and breaks nothing
    assert tuple(out[4]["current_run"]) == (10, 3, False)
    assert out[1]["recovered_day"] == 8 and out[1]["cross_day"] is None


def test_gates(spark):
    rows = spark.createDataFrame([(1, DAY, 10.0, 0.0), (1, DAY + dt.timedelta(1), 9.9995, 1.0), (1, DAY + dt.timedelta(3), 9.9, 5.0), (1, DAY + dt.timedelta(4), 12.0, 1.09)], "e int, d date, v double, n double")
    m = integrity.monotonicity(rows, ["e"], ["d"], "v").first()
    assert (m["n"], m["n_falls"]) == (4, 1) and m["worst_fall"] == pytest.approx(0.0995)
    s = integrity.step_identity(rows, ["e"], "d", "v", "n").first()
    assert (s["n"], s["n_broken"]) == (2, 1)
    with pytest.raises(integrity.GateError) as error:
        integrity.share_gate(integrity.monotonicity(rows, ["e"], ["d"], "v"), "n_falls", "n", 0.1, "falls")
    assert error.value.code == 3
    assert integrity.share_gate(spark.createDataFrame([(0, 0)], "bad long, n long"), "bad", "n", 0.1, "empty") == 0.0
    with pytest.raises(integrity.GateError):
        integrity.require_known(rows.select("e"), rows.select("e").where("e > 1"), ["e"], "new")
    with pytest.raises(integrity.GateError):
        integrity.require_complete(rows.select("d"), rows.select("d").limit(1))
    assert integrity.staleness_days(rows, "d", "2024-06-08") == 3


@pytest.mark.parametrize("printed, n, ok", [(2.0, 2, True), (2.015, 2, True), (2.03, 2, False), (2.0, 3, False)])
def test_reconcile(spark, printed, n, ok):
    parts = spark.createDataFrame([(1, 1.0), (2, 1.0)], "e int, v double")
    total = spark.createDataFrame([("Total", 1, 1.0), (" total ", n, printed)], "label string, n int, v double")
    assert integrity.reconcile(parts, total, "e", ["v"], "label", "n").first()["ok"] is ok


def test_days_are_verified_and_kept_apart(spark):
    rows = spark.createDataFrame([(DAY, 1, "NIL"), (DAY, 2, "NIL"), (DAY + dt.timedelta(1), 1, "?")], "d date, e int, w string")
    verdicts = integrity.verify_days(rows, "d", "e", 2, {"w": ["NIL"]})
    good, bad = integrity.quarantine(rows, verdicts, "d")
    assert (good.count(), bad.count()) == (2, 1)
    assert {p["check"] for r in verdicts.collect() for p in r["problems"]} == {"row_count", "vocabulary:w"}


def test_claims_and_tiers(spark):
    claims = spark.createDataFrame([("a", 1, 0.05), ("b", 1, 0.01), ("c", 2, 0.2)], "e string, r int, diff double")
    kept, lost = matching.resolve_claims(claims, "r", F.asc("diff"), F.col("e"))
    assert sorted(r["e"] for r in kept.collect()) == ["b", "c"] and [r["e"] for r in lost.collect()] == ["a"]
    rows = [(0.0, 0.05, None, False, False), (0.0, None, 0.9, False, False), (0.0, None, 0.1, True, False), (0.0, None, 0.1, False, False), (3.0, 0.05, None, True, False), (8.0, 0.05, None, True, False), (None, 0.05, None, True, False), (0.0, 0.5, 0.9, True, True)]
    frame = spark.createDataFrame(rows, "km double, cap double, sub double, exact boolean, paren boolean")
    assert [r[0] for r in frame.select(matching.tier(*(F.col(c) for c in frame.columns))).collect()] == ["A", "B", "C", None, "A-bdy", None, "B2", None]


def test_likeness_only_where_no_exact_partner(spark):
    left = spark.createDataFrame([("1", "machhu"), ("2", "machhu")], "o string, stem string")
    right = spark.createDataFrame([("1", "machhu"), ("2", "machchhu"), ("3", "machhu")], "o string, stem string")
    out = {(r["l_o"], r["r_stem"]): r["score"] for r in matching.blocked_pairs(left, right, ["o"], "stem").collect()}
    assert out == {("1", "machhu"): 1.0, ("2", "machchhu"): pytest.approx(12 / 14)} or out == {("1", "machhu"): 1.0}


@pytest.mark.parametrize("least", [0.6, 0.7, 0.86])
def test_blocks_lose_no_likeness(spark, least):
    """Against all pairs of a block, at ratios that allow short runs."""
    from difflib import SequenceMatcher

    rng = np.random.default_rng(6)
    stems = ["".join(rng.choice(list("abcd"), rng.integers(1, 9))) for _ in range(120)]
    left = [(k % 2, s, k) for k, s in enumerate(stems[:60])] + [(0, None, 98), (0, stems[0], 99)]
    right = [(k % 2, s, k) for k, s in enumerate(stems[60:])] + [(1, None, 98)]
    got = matching.blocked_pairs(spark.createDataFrame(left, "b int, s string, k int"), spark.createDataFrame(right, "b int, s string, k int"), ["b"], "s", least).collect()
    held = {(b, s) for b, s, _ in right}
    want = {(i, j) for b, s, i in left for c, t, j in right if b == c and s and t and (s == t or ((b, s) not in held and SequenceMatcher(None, s, t).ratio() >= least))}
    assert {(r["l_k"], r["r_k"]) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("least", [0.67, 0.8, 0.86, 0.95])
def test_long_stems_lose_no_likeness(spark, least):
    """Names of 8 to 40 letters, misspelt, with letters that repeat and one pair of letters that most have."""
    from difflib import SequenceMatcher

    rng = np.random.default_rng(8)
    letters = list("aaeiknrst")
    base = ["".join(rng.choice(letters, rng.integers(8, 40))) + "ra" for _ in range(25)] + ["banana" * 5, "anan" * 8]

    def misspelt(s):
        out = list(s)
        for _ in range(rng.integers(0, 5)):
            at = int(rng.integers(0, len(out)))
            out[at : at + 1] = [str(rng.choice(letters))] * int(rng.integers(0, 3))
        return "".join(out)

    left, right = [(0, misspelt(s), k) for k, s in enumerate(base * 2)], [(0, misspelt(s), k) for k, s in enumerate(base * 2)]
    got = matching.blocked_pairs(spark.createDataFrame(left, "b int, s string, k int"), spark.createDataFrame(right, "b int, s string, k int"), ["b"], "s", least).collect()
    held = {s for _, s, _ in right}
    want = {(i, j) for _, s, i in left for _, t, j in right if s == t or (s not in held and SequenceMatcher(None, s, t).ratio() >= least)}
    assert {(r["l_k"], r["r_k"]) for r in got} == want and len(got) == len(want) > 10


def test_assignment_uses_each_once(spark):
    pairs = spark.createDataFrame([("x", 1, 10, 0.1), ("x", 2, 10, 0.2), ("x", 2, 11, 0.3)], "b string, l int, r int, s double")
    assert {tuple(r)[1:] for r in matching.assign_in_order(pairs, "b", "l", "r", ["s", "l", "r"]).collect()} == {(1, 10), (2, 11)}


def test_verdicts(spark):
    rows = [(9, 0, 0.0, 0.5, 0.0), (9, 9, 0.06, 0.5, 0.0), (9, 9, 0.0, 0.04, 0.0), (9, 9, 0.0, 0.10, 0.0), (9, 9, 0.0, 0.5, 0.71), (9, 9, 0.0, 0.5, 0.1)]
    frame = spark.createDataFrame(rows, "n int, d int, f double, i double, s double")
    assert [r[0] for r in frame.select(composite.verdict(*(F.col(c) for c in frame.columns))).collect()] == ["NO DATA", "SOURCE DATA UNRELIABLE", "MECHANISM ABSENT", "MECHANISM WEAK", "FAILS", "PASSES"]


def test_outlines():
    square = lambda lo, hi: np.array([(lo, lo), (hi, lo), (hi, hi), (lo, hi)])
    at = lambda polygons, *points: geo.km_outside(polygons, *(np.array(c, float) for c in zip(*points, strict=True))).tolist()
    assert at([[square(0.0, 1.0)]], (0.5, 0.5), (1.005, 0.5)) == [0, 0]
    assert at([[square(0.0, 1.0)]], (2.0, 0.5))[0] == pytest.approx(111.32, rel=1e-3)
    ring = [square(0.0, 8.0), square(3.0, 6.0)]
    hole, solid, edge = at([ring], (4.0, 4.5), (1.0, 1.0), (3.005, 4.0))
    assert hole == pytest.approx(111.32 * np.cos(np.radians(4.5)), rel=1e-6) and solid == 0 and edge == 0  # a hole is outside
    assert at([ring, [square(3.0, 6.0)]], (4.0, 4.5)) == [0]  # filled by an island


def test_outlines_from_features(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "a"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [8, 0], [8, 8], [0, 8], [0, 0]], [[3, 3], [6, 3], [6, 6], [3, 6], [3, 3]]]}},
        {"type": "Feature", "properties": {"name": "b"}, "geometry": {"type": "Polygon", "coordinates": [[[20, 0], [21, 0], [21, 1], [20, 1], [20, 0]]]}}]}))
    km = geo.distance_function(spark, geo.outlines_of(layouts.geojson_features(spark, str(tmp_path / "f.json")), "name"))
    rows = spark.createDataFrame([(1, "a", 1.0, 1.0), (2, "a", 4.5, 4.5), (3, "b", 20.5, 0.5), (4, "c", 0.0, 0.0), (5, "a", None, 1.0), (6, None, 1.0, 1.0)], "k int, n string, x double, y double")
    got = {r["k"]: r["km"] for r in rows.select("k", km("n", "x", "y").alias("km")).collect()}
    assert got[1] == 0 and got[2] > 100 and got[3] == 0 and got[4] is None and got[5] is None and got[6] is None


def test_guards_raise(spark):
    days = spark.createDataFrame([(DAY,)], "d date")
    with pytest.raises(integrity.GateError):
        integrity.require_not_absent(str(DAY), days)
    integrity.require_not_absent("2024-06-02", days)
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 50.0, 5.0), (3, None, 5.0)], "k int, lon double, lat double")
    with pytest.raises(integrity.GateError, match="2"):
        integrity.require_in_box(points, "k", "lon", "lat", (0, 0, 10, 10))
    integrity.require_in_box(points.where("k <> 2"), "k", "lon", "lat", (0, 0, 10, 10))
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (None,)], "k int")
    found = model.set_audit(only_a=(a, b, "k"), only_b=(b, a, "k"))
    assert [tuple(r) for r in found.collect()] == [("only_a", "1")]
    with pytest.raises(integrity.GateError):
        integrity.require_total(found)
    integrity.require_total(model.set_audit(same=(a, a, "k")))


def test_ranks_of_parts_are_ranks(spark):
    values = [float(v) for v in np.random.default_rng(4).integers(0, 40, 300)] + [None]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r[0]: r[1] for r in composite.average_ranks(rows.where("v is not null"), "v", "rk").collect()}
    for v in set(values[:-1]):
        below = sum(x < v for x in values[:-1])
        assert got[v] == below + (values.count(v) + 1) / 2
    assert composite.spearman(rows.limit(0).withColumn("w", F.col("v")), "v", "w").first()["n"] == 0


def test_a_stream_of_nothing_is_split_into_nothing(spark, tmp_path):
    from rillflow.plans import matching_q

    spark.createDataFrame([], "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    assert matching_q.stream_gate(spark, str(tmp_path)).count() == 0


def test_document(spark):
    rows = spark.createDataFrame([("a", 2023, 2, 1.5), ("a", 2023, 1, None), ("a", 2024, 1, 2.0)], "k string, s int, d int, v double")
    assert document.nested_series(rows, "k", "s", "d", "v").first()["series"] == {"2023": {2: 1.5}, "2024": {1: 2.0}}
    out = document.to_document(("rows", document.records(rows.select("s", "d", "v"), "s", "d"))).first()["document"]
    assert out == '{"rows":[{"s":2023,"d":1,"v":null},{"s":2023,"d":2,"v":1.5},{"s":2024,"d":1,"v":2.0}]}'


def test_joins_and_ledgers(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    with pytest.raises(ValueError):
        model.checked_join(a.union(a), a.withColumnRenamed("v", "w"), "k")
    merged = model.merge_ledger([a, spark.createDataFrame([(2, "z", 5)], "k int, v string, n int")], "k")
    assert {tuple(r) for r in merged.select("k", "v", "n").collect()} == {(1, "x", None), (2, "z", 5)}
    assert model.append_absent(a, spark.createDataFrame([(2, "q"), (3, "r")], "k int, v string"), "k").count() == 3


def test_daily_files(spark, tmp_path):
    schema = "report_date date, e int, v double"
    assert daily.scan(spark, f"{tmp_path}/none/*.parquet", schema).count() == 0
    rows = spark.createDataFrame([(DAY, 1, 1.0), (DAY + dt.timedelta(1), 1, 2.0)], schema)
    daily.write_days(rows, f"{tmp_path}/days")
    daily.write_days(rows.where(F.col("report_date") == DAY).withColumn("v", F.lit(9.0)), f"{tmp_path}/days")
    back = daily.scan(spark, f"{tmp_path}/days", schema)
    assert sorted(r["v"] for r in back.collect()) == [2.0, 9.0] and daily.newest(back).first()[0] == DAY + dt.timedelta(1)
    assert not daily.write_csv(rows, f"{tmp_path}/csv", dry_run=True) and daily.write_csv(rows, f"{tmp_path}/csv")
    assert daily.read_csv(spark, f"{tmp_path}/csv", "e int, v double", need=["e"]).count() == 2
    assert daily.read_csv(spark, f"{tmp_path}/csv", "e int", need=["missing"]) is None


def test_html_tables():
    html = "<table><tr><td>outer<table><tr><th>a</th><th> b\n c</th></tr><tr><td>1<td>2</table></td></tr></table>"
    assert layouts.leaf_tables(html) == [[["a", "b c"], ["1", "2"]]]
    assert layouts.leaf_tables(None) == [] and layouts.leaf_tables("<td>x</td></table>") == []


def test_late_events_and_seasons(spark, tmp_path):
    rows = spark.createDataFrame([(1, dt.datetime(2024, 6, 1)), (1, dt.datetime(2024, 6, 1)), (2, dt.datetime(2024, 3, 1)), (3, None)], "e int, t timestamp")
    inside, outside = streams.route_season(rows, "t", (6, 10))
    assert (inside.count(), outside.count()) == (2, 2)
    rows.where("t is not null").write.parquet(f"{tmp_path}/s")
    stream = streams.files(spark, f"{tmp_path}/s", rows.schema)
    assert streams.drain(streams.first_seen(stream, "t", "400 days", "e"), "late", "append").count() == 2
    assert streams.drain(streams.sessions(streams.files(spark, f"{tmp_path}/s", rows.schema), "t", "1 day", "400 days", "e"), "sess", "complete").count() == 2


def test_documents_are_read_back(spark, tmp_path):
    (tmp_path / "v.json").write_text('{"schemes": [{"id": 1, "p": 2.5}, {"id": 2, "p": null}], "features": [{"properties": {"n": "a"}, "geometry": {"type": "Point"}}]}')
    assert [tuple(r) for r in layouts.json_rows(spark, f"{tmp_path}/v.json", "schemes").orderBy("id").collect()] == [(1, 2.5), (2, None)]
    assert layouts.geojson_features(spark, f"{tmp_path}/v.json").select("properties.n").first()[0] == "a"


def test_sensitivity_has_all_five_weightings(spark, sf):
    from rillflow.plans import matching_q

    rows = {r["scheme"]: r for r in matching_q.index_sensitivity(spark, sf).collect()}
    assert set(rows) == {"equal", "mechanism_only", "mechanism_heavy", "drop_size", "restore_c3"}
    assert 0 < rows["restore_c3"]["spearman_micro"] < 1_000_000 and 0 <= rows["restore_c3"]["churn_micro"] <= 1_000_000
