"""The whole job on a small made-up archive."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rillflow.operators.integrity import GateError
from rillflow.plans import reservoirs as job


def archive(spark, bad_capacity=False, falling=False):
    rows = []
    for year in range(2020, 2025):
        for k in range(0, 40):
            day = dt.date(year, 6, 1) + dt.timedelta(k)
            for s in (1, 2, 3):
                design = 100.0 * s + (50 if s == 3 and year < 2022 else 0) + (7 if bad_capacity and s == 2 and year == 2023 and k > 20 else 0)
                pct = 50 + s - (2024 - year) + (-20 if year == 2024 and k >= 10 and s == 1 else 0)
                crf = float(3 * k) - (30 if falling and k % 5 == 4 else 0)
                rows.append((day, s, s, "Botad", None, f"Dam {s}", ["SG", "NG", "CG"][s - 1], "x", 1.0, 1.0, 1.0, design, design * 0.9, design * 0.1, design * pct / 100, design * pct / 110, 1.0, float(pct), 3.0, crf, "NIL", 0.0, 0.0, 80.0 if s == 1 else 0.0, s, 24))
    names = ["report_date", *job.DETAIL, "source_layout"]
    order = ["report_date", "sr_no", "scheme_id", "district", "taluka", "scheme_name", "region", "dam_type", "osl_m", "frl_m", "pwl_m", "design_gross_mcm", "design_live_mcm", "design_dead_mcm", "present_gross_mcm", "present_live_mcm", "present_dead_mcm", "pct_filling_src", "rf", "crf", "warning", "inflow_cusecs", "outflow_river_cusecs", "outflow_canal_cusecs", "location_id", "source_layout"]
    assert sorted(names) == sorted(order)
    kinds = dict(c.strip().split(" ") for c in job.STORAGE.split(","))
    return spark.createDataFrame(rows, ", ".join(f"{c} {kinds[c]}" for c in order))


def test_pipeline(spark, tmp_path):
    rows = archive(spark)
    verdicts = job.load_days(rows, f"{tmp_path}/days", expected=3)
    assert verdicts.where(F.size("problems") > 0).count() == 0
    rain = rows.select("report_date", "scheme_id", F.col("crf").alias("cumm_rainfall_mm"))
    rain.write.parquet(f"{tmp_path}/rain")
    report, view = job.run_pipeline(spark, f"{tmp_path}/days", f"{tmp_path}/rain", out_dir=f"{tmp_path}/out")
    today = {r["scheme_id"]: r for r in report["today"].collect()}
    assert today[1]["years_used"] == "2020,2021,2022,2023" and today[1]["deviation"] == pytest.approx(31 - (51 - 2.5))
    assert today[3]["years_used"] == "2022,2023" and today[3]["years_dropped"] == "2020,2021"
    assert report["worst"].first()["scheme_id"] == 1 and report["orphans"].count() == 0
    doc = json.loads(view.first()["document"])
    by = {r["region"]: r["crossover"] for r in doc["regions"]}
    assert by["SG"]["case"] == "crossed" and by["SG"]["cross_day"] == 11 and by["NG"]["case"] == "never_below"
    assert len(doc["schemes"]) == 3 and doc["meta"]["dates_loaded"] == 200 and doc["state"][0]["region"] == "all"
    star = job.build_star(spark, f"{tmp_path}/days")
    assert {r["n_design_variants"] for r in star.schemes.collect()} == {1, 2} and star.rain.count() == 0
    changes = job.check_capacity(star.storage)[1].collect()
    assert [(r["scheme_id"], r["season_after"], r["direction"], r["shape"]) for r in changes] == [(3, 2022, "down", "single_step")]
    flips = job.confirm_flip(star.storage, spark.createDataFrame([(3, 350.0, 300.0), (1, 350.0, 300.0)], "scheme_id int, value_before double, value_after double"), "2021-06-10", "2022-06-10")
    assert {r["scheme_id"]: r["flipped"] for r in flips.collect()} == {3: True, 1: False}


def test_gates_halt(spark, tmp_path):
    bad = archive(spark, bad_capacity=True)
    with pytest.raises(GateError) as error:
        job.check_capacity(bad)
    assert error.value.code == 2
    known = spark.createDataFrame([(2, 2023)], "scheme_id int, season int")
    caps, _ = job.check_capacity(bad, known)
    assert caps.where("capacity_class = 'mid_season'").count() == 1
    rows = archive(spark, falling=True)
    with pytest.raises(GateError) as error:
        job.check_rainfall(rows, spark.createDataFrame([], job.RAIN))
    assert error.value.code == 3
    with pytest.raises(GateError) as error:
        job.build_star(spark, f"{tmp_path}/none")
    assert error.value.code == 1
    with pytest.raises(GateError):
        job.report_deviation(rows, caps, "2024-03-01")
    short = archive(spark).where("not (report_date = '2024-06-05' and scheme_id = 3)")
    with pytest.raises(GateError) as error:
        job.update_day(spark, short, f"{tmp_path}/d", today="2024-07-11", expected=3)
    assert error.value.code == 4
    star = job.update_day(spark, archive(spark), f"{tmp_path}/d", today="2024-07-11", expected=3)
    assert star.storage.count() == 600
    with pytest.raises(GateError):
        job.update_day(spark, archive(spark), f"{tmp_path}/d", today="2024-08-11", expected=3)


def test_ingest(spark):
    wide = ["1", "7", "Surendranaga r", "x", "Aji - II", "South  Gujarat", "t", *["1"] * 3, "7414.2\n9", *["2"] * 5, "65 %", "1", "2", "WARNI\nNG", "1,200", "-", "abc", "9"]
    narrow = [c for k, c in enumerate(wide) if k != 3]
    header = ["Sr No", *["h"] * 23]
    grids = spark.createDataFrame([("2024-06-01", g) for g in (wide, narrow, header, ["only"], [None] * 24)], "report_date string, cells array<string>").withColumn("report_date", F.col("report_date").cast("date"))
    rows, failures = job.ingest(grids)
    out = rows.orderBy("source_layout").collect()
    assert [(r["source_layout"], r["taluka"]) for r in out] == [(23, None), (24, "x")]
    assert (out[1]["scheme_id"], out[1]["design_gross_mcm"], out[1]["region"], out[1]["district"], out[1]["warning"], out[1]["inflow_cusecs"], out[1]["outflow_river_cusecs"], out[1]["outflow_canal_cusecs"]) == (7, 7414.29, "SG", "Surendranagar", "WARNING", 1200.0, None, None)
    assert sorted(r["reason"] for r in failures.collect()) == ["no first cell", "outflow_canal_cusecs unreadable", "outflow_canal_cusecs unreadable", "unknown width"]


def test_work_list(spark):
    frame = lambda days, **more: spark.createDataFrame([(d, *more.values()) for d in days], ["report_date", *more])
    out = job.work_list(frame(["a", "b", "c", "d"]), frame(["a", "b"]), frame(["a"], status="ok").unionByName(frame(["b"], status="unverified")), frame(["d"]))
    assert sorted(r[0] for r in out.collect()) == ["b", "c"]


def printed_of(rows, **wrong):
    """The abstract's lines of each day: parts and their total, some figures wrong."""
    total = rows.groupBy("report_date").agg(F.lit("Total").alias("label"), F.count(F.lit(1)).cast("int").alias("n_schemes"), F.sum("design_gross_mcm").alias("design_gross_mcm"), F.sum("present_gross_mcm").alias("present_gross_mcm"))
    part = total.withColumn("label", F.lit("SG")).withColumn("n_schemes", F.lit(1))
    return total.withColumns(wrong).unionByName(part)


def halted(spark, tmp_path, rows, **how):
    with pytest.raises(GateError) as error:
        job.update_day(spark, rows, f"{tmp_path}/d", today="2024-07-11", expected=3, **how)
    return error.value.code, str(error.value)


def test_each_check_alone_stops_the_load(spark, tmp_path):
    """Reconciliation, the document's date, rain below its day, a day listed as absent: each with its code, and nothing written."""
    rows = archive(spark).where("report_date >= '2024-07-01'").persist()
    fine = {"printed": printed_of(rows), "documents": rows.select("report_date", F.concat(F.lit("Date :- "), F.date_format("report_date", "dd-MM-yyyy")).alias("date_line")).distinct(), "rain_rows": rows.select("report_date", "scheme_id", F.col("crf").alias("cumm_rainfall_mm"), F.col("rf").alias("rain_last_24h_mm"))}
    at = F.col("report_date") == "2024-07-04"
    wrong = {
        "reconcile": {"printed": printed_of(rows, design_gross_mcm=F.col("design_gross_mcm") + F.when(at, 5).otherwise(0))},
        "date": {"documents": fine["documents"].withColumn("date_line", F.when(at, "Date :- 03-07-2024").otherwise(F.lit("no date")))},
        "rain": {"rain_rows": fine["rain_rows"].withColumn("cumm_rainfall_mm", F.when(at & (F.col("scheme_id") == 2), 2.9).otherwise(F.col("cumm_rainfall_mm")))},
    }
    for check, change in wrong.items():
        code, message = halted(spark, tmp_path, rows, **(fine | change))
        assert code == 4 and "2024-07-04" in message and f"['{check}']" in message and message.count("2024-") == 1
    code, message = halted(spark, tmp_path, rows.where("report_date = '2024-07-04'"), printed=printed_of(rows).where("label = 'SG'"))
    assert code == 4 and "reconcile" in message  # a day without a printed total
    assert halted(spark, tmp_path, rows, absent=rows.where(at).select("report_date"))[0] == 1
    drifted = rows.withColumn("district", F.when(at, "Bot ad").otherwise(F.col("district")))
    star = job.update_day(spark, drifted, f"{tmp_path}/e", today="2024-07-11", expected=3, districts=spark.createDataFrame([(s, "Botad") for s in (1, 2, 3)], "scheme_id int, district string"), absent=rows.where("false").select("report_date"), **fine)
    assert {r["district"] for r in star.storage.select("district").distinct().collect()} == {"Botad"} and star.storage.count() == 30
    # days that fail stay out, the others are there
    verdicts = job.load_days(rows, f"{tmp_path}/f", expected=3, **{k.removesuffix("_rows"): v for k, v in (fine | wrong["rain"]).items()})
    assert {str(r["report_date"]): [p["summary"] for p in r["problems"]] for r in verdicts.where("size(problems) > 0").collect()} == {"2024-07-04": ["1 running totals below their day"]}
    assert spark.read.parquet(f"{tmp_path}/f").select("report_date").distinct().count() == 9


def test_rain_that_contradicts_itself_is_named(spark):
    rain = spark.createDataFrame([(1, 5.0, 5.0005), (2, 5.0, 5.002), (3, None, 9.0), (4, 1.0, None)], "scheme_id int, cumm_rainfall_mm double, rain_last_24h_mm double").withColumn("report_date", F.lit("2024-07-01").cast("date"))
    assert [(r["scheme_id"], r["reason"]) for r in job.rain_failures(rain).collect()] == [(2, "cumulative rainfall 5.0 is less than the 24-hour figure 5.002")]


def test_live_figures_rank_where_every_scheme_has_them(spark, tmp_path):
    archive(spark).withColumn("pct_filling", F.col("pct_filling_src")).withColumn("days_water_at_release", F.lit(None).cast("double")).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    caps, _ = job.check_capacity(rows)
    report = job.report_deviation(rows, caps, "2024-07-10")
    today = {r["scheme_id"]: r for r in report["today"].collect()}
    live = lambda s, year: 100 * (100.0 * s + (50 if s == 3 and year < 2022 else 0)) * (50 + s - (2024 - year) + (-20 if s == 1 and year == 2024 else 0)) / 110 / ((100.0 * s + (50 if s == 3 and year < 2022 else 0)) * 0.9)
    want = live(1, 2024) - sum(live(1, y) for y in range(2020, 2024)) / 4
    assert today[1]["live_deviation"] == pytest.approx(want) and today[1]["live_shortfall_mcm"] == pytest.approx(-want / 100 * 90)
    assert today[1]["release_mcm"] == pytest.approx(80 * 40 * 0.0024466) and today[1]["release_covers"] == round(today[1]["release_mcm"] / today[1]["live_shortfall_mcm"], 2)
    assert {r["ranked_by"] for r in report["worst"].collect()} == {"live_deviation"} and today[2]["release_mcm"] == 0
    some = rows.withColumn("present_live_mcm", F.when((F.col("scheme_id") == 2) & (F.col("report_date") == "2024-07-10"), None).otherwise(F.col("present_live_mcm")))
    report = job.report_deviation(some, caps, "2024-07-10")
    assert {r["ranked_by"] for r in report["worst"].collect()} == {"deviation"} and report["worst"].count() == 3


def test_a_load_that_dies_goes_on(spark, tmp_path, monkeypatch):
    """Killed in each step in turn, and halted by a gate: the end is that of an undisturbed run."""
    archive(spark).where("report_date >= '2023-07-01' and day(report_date) in (1, 5, 10)").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    run = lambda at, rows=rows: job.resume_update(spark, rows, f"{tmp_path}/{at}/days", f"{tmp_path}/{at}/journal", f"{tmp_path}/{at}/out", today="2024-07-10", expected=3)
    state = lambda at: (sorted(map(str, spark.read.parquet(f"{tmp_path}/{at}/days").collect())), sorted(map(str, spark.read.csv(f"{tmp_path}/{at}/out/worst.csv").collect())))
    want = run("whole")
    assert want == {"load": rows.count(), "gates": 6, "report": 3}

    class Killed(Exception):
        pass

    for k, name in enumerate(("load_days", "check_rainfall", "report_deviation")):
        real, calls = getattr(job, name), []

        def dies(*a, real=real, calls=calls, **b):
            calls.append(1)
            out = real(*a, **b)
            if len(calls) == 1:
                raise Killed
            return out

        monkeypatch.setattr(job, name, dies)
        with pytest.raises(Killed):
            run(f"killed-{k}")
        assert run(f"killed-{k}") == want and state(f"killed-{k}") == state("whole") and len(calls) == 2
        monkeypatch.setattr(job, name, real)
    short = rows.where("not (scheme_id = 3 and report_date = '2024-07-05')")
    with pytest.raises(GateError) as error:
        run("halted", short)
    assert error.value.code == 4
    with pytest.raises(GateError, match="halted at load"):
        run("halted")
    job.Journal(spark, f"{tmp_path}/halted/journal").lift()
    assert run("halted") == want and state("halted") == state("whole")
