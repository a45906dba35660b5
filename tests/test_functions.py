"""Scalar functions on hand-written cells."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rillflow.functions import names, numeric, seasons, text


def column(spark, values, kind, f):
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r[0] for r in frame.select("k", f(F.col("v")).alias("out")).orderBy("k").select("out").collect()]


def test_cells(spark):
    assert column(spark, ["7414.2\n9", " 1 ", "", None], "string", lambda c: text.to_number(text.clean_number(c))) == [7414.29, 1.0, None, None]
    assert column(spark, ["HIGH\nALERT", "  a \t b ", "  ", None], "string", text.clean_text) == ["HIGH ALERT", "a b", None, None]
    assert column(spark, ["-", "NIL", "1,234.5%", "abc", "nan", None], "string", text.to_number) == [None, None, 1234.5, None, None, None]


def test_vocabulary(spark):
    text.check_prefix_free(names.WARNINGS)
    out = column(spark, ["WARNI\nNG", "HIGH", "WARNI", "XYZ", None, " "], "string", lambda c: text.repair_label(c, names.WARNINGS))
    assert [tuple(r) for r in out] == [("WARNING", True, False), ("HIGH ALERT", True, True), ("WARNING", True, True), ("XYZ", False, False), (None, False, False), ("", False, False)]
    with pytest.raises(ValueError):
        text.check_prefix_free(["HIGH", "HIGH ALERT"])


def test_canonical_names(spark):
    region = column(spark, ["South  Gujarat", "kutch", "elsewhere"], "string", lambda c: text.canonical(c, names.REGIONS, lambda x: F.upper(text.clean_text(x))))
    assert [tuple(r) for r in region] == [("SG", True), ("Kutch", True), ("elsewhere", False)]
    district = column(spark, ["D.B.Dwarka", "Surendranaga r", "Botad", None], "string", lambda c: text.canonical(c, names.DISTRICTS))
    assert [tuple(r) for r in district] == [("Devbhumi Dwarka", True), ("Surendranagar", True), ("Botad", False), (None, False)]


def test_names(spark):
    out = column(spark, ["Aji - II", "Bhadar (P)", "Raval-2", "Machchhu Dam", None], "string", text.split_name)
    assert [tuple(r) for r in out] == [("aji", "2", False), ("bhadar", "p", True), ("raval", "2", False), ("machchhu", "", False), ("", "", False)]
    names = ["ii", "xii", "Shetrunji  iv ", "Und (a) ", "Dam 8", "Dam7", "Ozat–2", "Venu (II)", "a-vii", "Moj & Co. (left bank) 3", "(b)", "Phophal_ii"]
    found = [("", "2", False), ("xii", "", False), ("shetrunji", "4", False), ("und", "a", True), ("8", "", False), ("dam7", "", False), ("ozat", "2", False), ("venuii", "", False), ("a", "7", False), ("mojandco", "3", False), ("", "b", True), ("phophalii", "", False)]
    assert [tuple(r) for r in column(spark, names, "string", text.split_name)] == found
    assert column(spark, ["  Kachchh", "DEVBHUMI  dwarka", "Surat", " ", None], "string", text.parent_district) == ["kutch", "jamnagar", "surat", None, None]
    assert column(spark, ["a-b-c", "a", None], "string", lambda c: text.key_part(c, 2)) == ["c", None, None]
    assert column(spark, ["81", "18", None], "string", lambda c: text.has_prefix(c, "8")) == [True, False, False]
    assert column(spark, ["D", "E", "N", None], "string", lambda c: text.band_of(c, {"deficit": ("D", "LD"), "surplus": ("E",)})) == ["deficit", "surplus", "normal", None]
    assert column(spark, ["machchhu", "machhu", "phodarness", "fodaraness"], "string", text.fold_sounds) == ["mc", "mc", "fdrns", "fdrns"]


def test_degrees(spark):
    assert column(spark, ["22° 24' 20\"", "21° 43' 60\"", "x", "10° 60'", "10° 61'", None], "string", text.dms_to_degrees) == [22.405556, 21.733333, None, 11.0, None, None]


def test_dates(spark):
    days = [dt.date(2024, 6, 1), dt.date(2024, 10, 31), dt.date(2024, 5, 31)]
    assert column(spark, days, "date", seasons.day_of_season) == [1, 153, 0]
    assert column(spark, days, "date", seasons.in_season) == [True, True, False]
    assert column(spark, ["Date :- 05-09-2024", "Date :- 31-02-2024", "none"], "string", seasons.parse_day_first) == [dt.date(2024, 9, 5), None, None]
    assert seasons.spine(spark, "2024-06-01", "2024-10-31").count() == 153


def test_guards(spark):
    frame = spark.createDataFrame([(397.82, 80.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in frame.select(numeric.days_of_water(F.col("a"), F.col("b"))).collect()] == [2032.531125080725, None, None]
    assert [r[0] for r in frame.select(numeric.percent(F.col("a"), F.col("b"))).collect()] == [397.82 / 80 * 100, None, None]


def test_quadrants(spark):
    frame = spark.createDataFrame([(-20.0, -10.0), (-20.1, -10.1), (0.0, -11.0), (None, 1.0), (-21.0, 0.0)], "r double, s double")
    assert [r[0] for r in frame.select(numeric.quadrant(F.col("r"), F.col("s"), 20.0, 10.0)).collect()] == ["both_normal", "rain_explains", "low_despite_rain", None, "held_up"]


def test_ranks_and_shares(spark):
    ranks = column(spark, [1.0, 2.0, 2.0, None], "double", numeric.percent_rank_average)
    assert ranks == [pytest.approx(1 / 3), pytest.approx(2.5 / 3), pytest.approx(2.5 / 3), None]
    frame = spark.createDataFrame([(0.0, 0.0), (5.0, 0.0), (None, 2.0)], "a double, b double")
    both = [F.col("a"), F.col("b")]
    assert [tuple(r) for r in frame.select(numeric.entropy(both), numeric.dominance(both)).collect()] == [(None, None), (0.0, 1.0), (0.0, 1.0)]
    assert [r[0] for r in frame.select(numeric.composite([(F.col("a"), 0.5), (F.col("b"), 0.5)])).collect()] == [0.0, 2.5, None]
    assert frame.agg(numeric.upper_median(F.col("b"))).first()[0] == 0.0
    assert column(spark, [0.0, 1.0, 0.5, 1.1, None], "double", lambda c: numeric.histogram_bin(c, 20)) == [0, 19, 10, None, None]
