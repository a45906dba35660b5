"""The gate on a stream against the gate on all rows: any split, any order, corrections, restarts, state that goes."""

import datetime
import random
import shutil

import pytest
from pyspark.sql import functions as F

from rillflow.operators import integrity
from rillflow.streaming import readings

SCHEMA = "scheme int, season int, day date, total double, rain double"
DAY = datetime.date(2024, 7, 1)


def made(seed, schemes=6, days=25):
    rng, out = random.Random(seed), []
    for s in range(schemes):
        total = 0.0
        for k in range(days):
            if rng.random() < 0.2:
                continue
            rain = rng.choice([0.0, 2.0, 5.5, None])
            total += (rain or 0.0) + rng.choice([0.0, 0.0, 0.0, -3.0, 4.0])
            out.append((s, 2024, DAY + datetime.timedelta(k), None if rng.random() < 0.05 else total, rain))
            if rng.random() < 0.1:  # a second reading of the day
                out.append((s, 2024, DAY + datetime.timedelta(k), total - 1, rain))
    rng.shuffle(out)
    return out


def files(spark, folder, rows, parts):
    for k in range(parts):
        spark.createDataFrame(rows[k::parts], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def gate(spark, folder, path, per=1, **how):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per).parquet(folder)
    return readings.run_gate(stream, path, ["scheme", "season"], "day", "total", "rain", **how)


def rows_of(frame):
    return sorted(map(str, (tuple(r[c] for c in ("scheme", "season", "day", "fell", "residual", "broken")) for r in frame.collect())))


@pytest.mark.parametrize(("seed", "parts", "per"), [(1, 1, 1), (2, 4, 1), (3, 5, 2)])
def test_any_split_gives_the_verdicts_of_the_whole(spark, tmp_path, seed, parts, per):
    rows = made(seed)
    files(spark, f"{tmp_path}/in", rows, parts)
    want = integrity.judged_readings(spark.createDataFrame(rows, SCHEMA), ["scheme", "season"], "day", "total", "rain")
    assert rows_of(gate(spark, f"{tmp_path}/in", f"{tmp_path}/out", per)) == rows_of(want)
    # the sums over verdicts are the gates' own figures
    clean = spark.createDataFrame(rows, SCHEMA).where("total is not null").groupBy("scheme", "season", "day").agg(F.min(F.struct("total", "rain")).alias("r")).select("scheme", "season", "day", "r.*")
    falls = integrity.monotonicity(clean, ["scheme", "season"], ["day"], "total").first()
    steps = integrity.step_identity(clean, ["scheme", "season"], "day", "total", "rain").first()
    assert want.selectExpr("count(*)", "count_if(fell)", "count(residual)", "count_if(broken)").first()[:] == (falls["n"], falls["n_falls"], steps["n"], steps["n_broken"])


def test_a_restart_goes_on_from_its_checkpoint(spark, tmp_path):
    rows = sorted(made(4), key=lambda r: r[2])
    half = len(rows) // 2
    files(spark, f"{tmp_path}/in", rows[half:], 1)  # later days first
    gate(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    files(spark, f"{tmp_path}/in", rows[:half], 2)
    got = gate(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    want = integrity.judged_readings(spark.createDataFrame(rows, SCHEMA), ["scheme", "season"], "day", "total", "rain")
    assert rows_of(got) == rows_of(want)
    # the last batch died before it was recorded: it is run again and replaces its part
    last = max(int(p.name) for p in (tmp_path / "out/checkpoint/commits").iterdir() if p.name.isdigit())
    (tmp_path / f"out/checkpoint/commits/{last}").unlink()
    (tmp_path / f"out/checkpoint/commits/.{last}.crc").unlink(missing_ok=True)
    shutil.rmtree(tmp_path / f"out/verdicts/batch={last}")
    assert rows_of(gate(spark, f"{tmp_path}/in", f"{tmp_path}/out")) == rows_of(want)


def test_old_state_goes_and_the_setting_comes_back(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    day = lambda k: DAY + datetime.timedelta(k)
    for k, part in enumerate([[(1, 2024, day(0), 5.0, 1.0)], [(2, 2024, day(40), 1.0, 1.0)], [(2, 2024, day(41), 2.0, 1.0)], [(1, 2024, day(50), 1.0, 0.0), (1, 2024, day(2), 1.0, 0.0)]]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        got = gate(spark, f"{tmp_path}/in", f"{tmp_path}/out", late="5 days", keep=10)
    by = {(r["scheme"], str(r["day"])): r["fell"] for r in got.collect()}
    # 1's state went after ten days, so that its next reading is a first one; a day far behind the watermark is dropped
    assert by == {(1, str(day(0))): None, (2, str(day(40))): None, (2, str(day(41))): False, (1, str(day(50))): None}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
