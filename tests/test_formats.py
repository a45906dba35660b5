"""Sources of binary formats against files of other writers and hand-made ones."""

import struct

import numpy as np
import pandas as pd
import pytest

from pyspark.sql.datasource import EqualTo, Not, StringStartsWith

from rillflow.sources import features, fixed_width


def made(n, seed=0):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({"id": np.arange(n, dtype=np.int32), "small": rng.integers(-100, 100, n).astype(np.int8), "mid": rng.integers(-30000, 30000, n).astype(np.int16), "x": rng.normal(size=n), "y": rng.normal(size=n).astype(np.float32), "name": [f"n{k % 97}" + "é" * (k % 3) for k in range(n)]})
    if n > 3:
        frame.loc[1, "x"] = np.nan
        frame.loc[2, "y"] = np.nan
    return frame


def rows_of(frame):
    return [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in frame.itertuples(index=False)]


@pytest.mark.parametrize("version", [114, 117, 118, 119])
@pytest.mark.parametrize("n", [0, 1, 1000])
def test_files_equal_their_twins(spark, tmp_path, version, n):
    frame, path = made(n), f"{tmp_path}/a.dta"
    frame.to_stata(path, write_index=False, version=version, byteorder="big" if version == 117 else "little", data_label="a label" * (version > 114))
    assert fixed_width.layout(path).rows == n
    got = fixed_width.scan(spark, path)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema][:5] == [("id", "int"), ("small", "tinyint"), ("mid", "smallint"), ("x", "double"), ("y", "float")]
    twin = spark.createDataFrame(rows_of(frame), got.schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, twin.collect()))


def test_byte_ranges_cover_every_row_once(spark, tmp_path):
    n = 1_000_000
    path = f"{tmp_path}/a.dta"
    pd.DataFrame({"id": np.arange(n, dtype=np.int32), "x": np.arange(n) * 0.5, "s": "abc"}).to_stata(path, write_index=False, version=118)
    fixed_width.register(spark)
    got = spark.read.format("fixed_width").option("partition_bytes", 1 << 20).schema("x double, id int").load(path)
    assert got.rdd.getNumPartitions() == 15 and got.columns == ["x", "id"]
    assert got.selectExpr("count(*)", "count(distinct id)", "sum(x)", "sum(int(x = id * 0.5D))").first()[:] == (n, n, sum(range(n)) * 0.5, n)


def test_only_wanted_columns_are_decoded_and_missing_ones_are_named(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/a.dta"
    made(10).to_stata(path, write_index=False, version=118)
    got = fixed_width.scan(spark, path, columns=["name", "nowhere"], required=["id"])
    assert got.columns == ["id", "name"] and got.count() == 10 and len(got.collect()) == 10
    assert fixed_width.columns_of(path)[0] == ("id", "int")
    with pytest.raises(ValueError, match="lost.*gone"):
        fixed_width.scan(spark, path, required=["lost", "id", "gone"])
    at = fixed_width.layout(path)
    some = fixed_width.wanted(at, ["y"])
    with open(path, "rb") as file:
        file.seek(at.start)
        assert fixed_width.decoded(file.read(3 * at.width), at, some).schema.names == ["y"]


def test_missing_codes_are_null(tmp_path):
    """All codes of missing values, beside the largest numbers that are none."""
    path = f"{tmp_path}/a.dta"
    pd.DataFrame({"b": np.array([100], np.int8), "h": np.array([32740], np.int16), "l": np.array([2147483620], np.int32), "f": np.array([1.0], np.float32), "d": np.array([1.0])}).to_stata(path, write_index=False, version=118)
    at = fixed_width.layout(path)
    codes = [struct.pack("<bhifd", 100, 32740, 2147483620, 1.7e38, 8.9e307), *(struct.pack("<bhi", 101 + k, 32741 + k, 2147483621 + k) + struct.pack("<I", 0x7F000000 + 0x800 * k) + struct.pack("<Q", 0x7FE0000000000000 + 0x10000000000 * k) for k in range(27))]
    got = fixed_width.decoded(b"".join(codes), at, at.columns).to_pylist()
    assert all(v is not None for v in got[0].values()) and all(v is None for row in got[1:] for v in row.values())


def test_what_is_no_file_of_the_format_is_refused(spark, tmp_path):
    for name, content in (("a.dta", b"PAR1 not this"), ("b.dta", b""), ("c.dta", b"<stata_dta><header><release>120</release>")):
        (tmp_path / name).write_bytes(content)
        with pytest.raises(ValueError):
            fixed_width.layout(f"{tmp_path}/{name}")
    with pytest.raises(FileNotFoundError):
        fixed_width.columns_of(f"{tmp_path}/none.dta")
    path = f"{tmp_path}/d.dta"
    pd.DataFrame({"id": np.arange(5, dtype=np.int32), "s": ["x" * 3000] * 5}).to_stata(path, write_index=False, version=118, convert_strl=["s"])
    assert fixed_width.scan(spark, path, columns=["id"]).count() == 5
    with pytest.raises(ValueError, match="long strings"):
        fixed_width.wanted(fixed_width.layout(path), ["s"])


def test_written_files_are_read_back(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    frame = spark.range(1000).selectExpr("id", "cast(id % 7 as int) k", "if(id % 5 = 0, null, id / 3) x", "concat('r', id) s")
    fixed_width.register(spark)
    for mode in ("append", "overwrite", "append"):
        frame.repartition(3).write.format("fixed_width").mode(mode).save(path)
    back = pd.concat(pd.read_stata(f.removeprefix("file://")) for f in fixed_width.files_of(path))
    assert len(back) == 2000 and not (tmp_path / "out/_written").exists()
    got = fixed_width.scan(spark, path, ["id", "k", "x", "s"]).distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, frame.selectExpr("double(id)", "k", "x", "s").collect()))


SQUARE = [[0.0, 0.0], [8.0, 0.0], [8.0, 8.0], [0.0, 8.0], [0.0, 0.0]]
HOLE = [[3.0, 3.0], [3.0, 6.0], [6.0, 6.0], [6.0, 3.0], [3.0, 3.0]]
FEATURES = [(f"{11 + k % 3}-{k % 40:02d}-{k:05d}", k * 0.5 if k % 7 else None, [[SQUARE, HOLE]] if k % 2 else [[SQUARE], [HOLE]]) for k in range(600)]


@pytest.fixture
def package(tmp_path):
    path = f"{tmp_path}/a.gpkg"
    features.write_file(path, "shapes", [("key", "TEXT"), ("size", "DOUBLE")], sorted(FEATURES, key=lambda r: r[0]))
    return path


def test_features_with_holes_and_parts(spark, package):
    got = features.scan(spark, package, partition_rows=100)
    assert got.columns == ["fid", "key", "size", "geometry"] and got.rdd.getNumPartitions() == 6
    assert sorted(((r["key"], r["size"], r["geometry"]) for r in got.collect()), key=str) == sorted(FEATURES, key=str)
    few = features.scan(spark, package, columns=["size", "key"])
    assert few.columns == ["size", "key"] and few.count() == 600
    with pytest.raises(ValueError, match="absent"):
        features.scan(spark, package, columns=["key", "absent"])


def test_a_filter_in_the_file_skips_partitions(spark, package):
    want = {r[0] for r in FEATURES if r[0].startswith("11-24-")}
    told = features.scan(spark, package, where="key LIKE '11-24-%'", partition_rows=5)
    every = features.scan(spark, package, partition_rows=5)
    assert {r["key"] for r in told.collect()} == want and told.rdd.getNumPartitions() < every.rdd.getNumPartitions() / 20
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pushed = features.scan(spark, package, partition_rows=5).where("key like '11-24-%' and size > 10")
        assert {r["key"] for r in pushed.collect()} == {r[0] for r in FEATURES if r[0] in want and r[1] is not None and r[1] > 10}
        assert pushed.rdd.getNumPartitions() < every.rdd.getNumPartitions() / 20  # Spark's filter reached the file
        assert features.scan(spark, package).where("key = '11-0A'").count() == 0 and features.scan(spark, package).where("key in ('11-00-00000', 'x') or size < 0").count() == 1
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert features.condition(StringStartsWith(("a",), "x")) == ('substr("a", 1, ?) = ?', [1, "x"]) and features.condition(Not(EqualTo(("a",), 1))) is None


def test_coordinate_systems(spark, tmp_path):
    """Undefined ones are refused, as are those without a formula; metres of web maps become degrees."""
    for name, srs in (("none", 0), ("other", 32643), ("web", 3857)):
        features.write_file(f"{tmp_path}/{name}.gpkg", "shapes", [("key", "TEXT")], [("a", [[[[0.0, 0.0], [111319.49079327358, 0.0], [0.0, 111325.1428663851], [0.0, 0.0]]]])], srs)
    with pytest.raises(Exception, match="no coordinate system"):
        features.scan(spark, f"{tmp_path}/none.gpkg").collect()
    with pytest.raises(Exception, match="no transformation from EPSG:32643"):
        features.scan(spark, f"{tmp_path}/other.gpkg").collect()
    ring = features.scan(spark, f"{tmp_path}/web.gpkg").first()["geometry"][0][0]
    assert np.allclose(ring, [[0, 0], [1, 0], [0, 1], [0, 0]])


def test_binary_geometries(tmp_path):
    """Byte orders, envelopes, heights, empty and null ones, and what is no polygon."""
    ring = struct.pack(">IIddd", 1, 3, 1.0, 2.0, 9.0) + struct.pack(">6d", 3, 4, 9, 1, 2, 9)
    high = b"GP" + bytes([0, 3]) + struct.pack("<i4d", 4326, 0, 1, 0, 1) + b"\0" + struct.pack(">I", 1003) + ring
    assert features.geometry(high) == [[[[1.0, 2.0], [3.0, 4.0], [1.0, 2.0]]]]
    flagged = b"GP" + bytes([0, 1]) + struct.pack("<i", 4326) + b"\0" + struct.pack(">I", 0x80000003) + ring
    assert features.geometry(flagged) == [[[[1.0, 2.0], [3.0, 4.0], [1.0, 2.0]]]]
    assert features.geometry(None) is None and features.geometry(features.encoded([], 1)) is None
    assert features.geometry(features.encoded([[SQUARE, HOLE], [SQUARE]], 4326)) == [[SQUARE, HOLE], [SQUARE]]
    with pytest.raises(ValueError, match="no polygon"):
        features.geometry(b"GP\0\1" + struct.pack("<iBIdd", 4326, 1, 1, 0, 0))
    with pytest.raises(ValueError):
        features.geometry(b"XX")
