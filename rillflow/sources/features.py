"""Polygon features in GeoPackage files: filters pushed into the file, row ranges as partitions, coordinate systems checked.

A file is a database with an index on the row number, so that a filter picks rows where they lie and a task reads its range of
rows alone. A layer without a known coordinate system is refused, never guessed; a system other than the wanted one is
transformed where the formula is known here, and refused else. Files must be on a path that driver and executors mount.
"""

from __future__ import annotations

import math
import os
import sqlite3
import struct
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import quote, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith
from pyspark.sql.types import ArrayType, DataType, DoubleType, LongType, StringType, StructField, StructType

from rillflow.session import ship_package

GEOMETRY = ArrayType(ArrayType(ArrayType(ArrayType(DoubleType()))))
#: Rows of one partition.
PARTITION_ROWS = 20_000
#: Radius of the sphere of web maps, in metres (fixed value).
RADIUS = 6378137.0
_TYPES: dict[str, DataType] = {"INTEGER": LongType(), "INT": LongType(), "MEDIUMINT": LongType(), "SMALLINT": LongType(), "TINYINT": LongType(), "BOOLEAN": LongType(), "DOUBLE": DoubleType(), "REAL": DoubleType(), "FLOAT": DoubleType()}
_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}

Polygons = list[list[list[list[float]]]]


def local(path: str) -> str:
    """The mounted path of a file: URI or a plain path; other stores raise."""
    parts = urlsplit(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{path}: feature files must be on a mounted path")
    return unquote(parts.path)


def files_of(path: str) -> list[str]:
    """The .gpkg files of a path, in order."""
    at = local(path)
    if os.path.isdir(at):
        return [os.path.join(at, n) for n in sorted(os.listdir(at)) if n.endswith(".gpkg")]
    if not os.path.exists(at):
        raise FileNotFoundError(path)
    return [at]


def connected(path: str) -> sqlite3.Connection:
    """A connection that reads only."""
    return sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass(frozen=True)
class Layer:
    """A file's layer: its key and geometry columns, attributes with types, and coordinate system as authority:code."""

    path: str
    name: str
    key: str
    geometry: str
    attributes: tuple[tuple[str, DataType], ...]
    crs: str


def layer_of(path: str, name: str | None = None) -> Layer:
    """The layer of this name, or the first. Raises ValueError without one, or where its coordinate system is undefined."""
    con = connected(path)
    try:
        rows = con.execute("SELECT table_name, column_name, srs_id FROM gpkg_geometry_columns ORDER BY table_name").fetchall()
        found = next((r for r in rows if name is None or r[0] == name), None)
        if found is None:
            raise ValueError(f"{path}: no layer {name or ''} among {[r[0] for r in rows]}")
        table, geometry, srs = found
        system = con.execute("SELECT organization, organization_coordsys_id FROM gpkg_spatial_ref_sys WHERE srs_id = ?", (srs,)).fetchone()
        if srs in (0, -1) or system is None or str(system[0]).upper() == "NONE":
            raise ValueError(f"{path}: layer {table} has no coordinate system; refusing to guess one")
        info = con.execute(f"PRAGMA table_info({quoted(table)})").fetchall()
        key = next((r[1] for r in info if r[5]), "rowid")
        plain = tuple((r[1], _TYPES.get(r[2].upper().partition("(")[0], StringType())) for r in info if r[1] not in (key, geometry))
        return Layer(path, table, key, geometry, plain, f"{system[0].upper()}:{system[1]}")
    finally:
        con.close()


def geometry(blob: bytes | None) -> Polygons | None:
    """Polygons (outer ring, then holes; points of x and y) of a geometry column's value; None for null and empty ones.

    Heights and measures are left out. Geometries other than polygons raise.
    """
    if blob is None:
        return None
    if blob[:2] != b"GP":
        raise ValueError("not a geometry of the format")
    flags = blob[3]
    if flags & 0x10:
        return None
    envelope = (0, 32, 48, 48, 64)[flags >> 1 & 7]
    out, _ = _shape(blob, 8 + envelope)
    return out


def _shape(blob: bytes, at: int) -> tuple[Polygons, int]:
    order = "<" if blob[at] else ">"
    (kind,) = struct.unpack_from(f"{order}I", blob, at + 1)
    at += 5
    more = (kind >> 31) + (kind >> 30 & 1) if kind >> 28 else {0: 0, 1: 1, 2: 1, 3: 2}[kind // 1000]
    if kind >> 29 & 1:
        at += 4
    base = (kind & 0xFFFFFFF) % 1000
    (count,) = struct.unpack_from(f"{order}I", blob, at)
    at += 4
    if base == 6:
        polygons: Polygons = []
        for _ in range(count):
            part, at = _shape(blob, at)
            polygons += part
        return polygons, at
    if base != 3:
        raise ValueError(f"geometry of type {base} is no polygon")
    rings, wide = [], 2 + more
    for _ in range(count):
        (n,) = struct.unpack_from(f"{order}I", blob, at)
        values = struct.unpack_from(f"{order}{n * wide}d", blob, at + 4)
        rings.append([[values[k], values[k + 1]] for k in range(0, n * wide, wide)])
        at += 4 + 8 * n * wide
    return [rings], at


def encoded(polygons: Polygons, srs: int) -> bytes:
    """A geometry column's value: a polygon, or several as one multipolygon."""
    def one(rings: list) -> bytes:
        return struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack(f"<I{2 * len(r)}d", len(r), *(c for p in r for c in p)) for r in rings)

    body = one(polygons[0]) if len(polygons) == 1 else struct.pack("<BII", 1, 6, len(polygons)) + b"".join(map(one, polygons))
    return b"GP" + struct.pack("<BBi", 0, 1 | (0x10 if not polygons else 0), srs) + body


def transformation(source: str, target: str):
    """A function (x, y) -> [x, y] from one coordinate system to another; raises ValueError where none is known here."""
    if source == target:
        return None
    if (source, target) == ("EPSG:3857", "EPSG:4326"):
        return lambda x, y: [math.degrees(x / RADIUS), math.degrees(2 * math.atan(math.exp(y / RADIUS)) - math.pi / 2)]
    if (source, target) == ("EPSG:4326", "EPSG:3857"):
        return lambda x, y: [RADIUS * math.radians(x), RADIUS * math.log(math.tan(math.pi / 4 + math.radians(y) / 2))]
    raise ValueError(f"no transformation from {source} to {target}")


def condition(found: Filter) -> tuple[str, list] | None:
    """SQL and parameters of a filter, or None if it can't be said exactly there."""
    if isinstance(found, IsNotNull):
        return f"{quoted(found.attribute[0])} IS NOT NULL", []
    if isinstance(found, StringStartsWith):
        # LIKE takes A for a; a comparison of the beginning doesn't
        return f"substr({quoted(found.attribute[0])}, 1, ?) = ?", [len(found.value), found.value]
    if isinstance(found, In) and all(isinstance(v, (int, float, str)) for v in found.value):
        return f"{quoted(found.attribute[0])} IN ({', '.join('?' * len(found.value))})", list(found.value)
    sign = _COMPARED.get(type(found))
    if sign and isinstance(found.value, (int, float, str)):
        return f"{quoted(found.attribute[0])} {sign} ?", [found.value]
    return None


@dataclass
class Range(InputPartition):
    """Rows of a file whose key lies between two numbers, both included."""

    layer: Layer
    low: int
    high: int


@dataclass
class FeatureReader(DataSourceReader):
    """Reads the columns of a schema; `where` is SQL over attributes, filters come from the plan."""

    path: str
    schema: StructType
    layer: str | None
    where: str
    crs: str
    rows: int
    pushed: list[tuple[str, list]] = field(default_factory=list)

    def picked(self) -> tuple[str, list]:
        parts = [f"({self.where})"] * bool(self.where) + [f"({sql})" for sql, _ in self.pushed]
        return " AND ".join(parts) or "1", [v for _, values in self.pushed for v in values]

    def partitions(self) -> list[Range]:
        out, (where, values) = [], self.picked()
        for path in files_of(self.path):
            layer = layer_of(path, self.layer)
            transformation(layer.crs, self.crs)
            con = connected(path)
            key, table = quoted(layer.key), quoted(layer.name)
            n, low, high = con.execute(f"SELECT count(*), min({key}), max({key}) FROM {table} WHERE {where}", values).fetchone()
            con.close()
            parts = -(-n // self.rows)
            step = -(-(high - low + 1) // parts) if parts else 0
            out += [Range(layer, low + k * step, min(high, low + (k + 1) * step - 1)) for k in range(parts)]
        return out

    def read(self, partition: Range | None) -> Iterator[tuple]:
        if partition is None:
            return
        layer, (where, values) = partition.layer, self.picked()
        moved, con = transformation(layer.crs, self.crs), connected(layer.path)
        columns = ", ".join(quoted({"fid": layer.key, "geometry": layer.geometry}.get(n, n)) for n in self.schema.names)
        key = quoted(layer.key)
        for row in con.execute(f"SELECT {columns or key} FROM {quoted(layer.name)} WHERE {key} BETWEEN ? AND ? AND ({where}) ORDER BY {key}", [partition.low, partition.high, *values]):
            yield tuple(self.value(v, f, moved) for v, f in zip(row, self.schema, strict=False))
        con.close()

    @staticmethod
    def value(v, column: StructField, moved):
        if column.name == "geometry":
            shape = geometry(v)
            return shape if moved is None or shape is None else [[[moved(*p) for p in ring] for ring in polygon] for polygon in shape]
        return None if v is None else float(v) if isinstance(column.dataType, DoubleType) else str(v) if isinstance(column.dataType, StringType) else int(v)


class PushingReader(FeatureReader):
    """With filters of the plan, where the session's spark.sql.python.filterPushdown.enabled lets them through."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            told = condition(one) if len(one.attribute) == 1 and one.attribute[0] not in ("fid", "geometry") else None
            if told is None:
                yield one
            else:
                self.pushed.append(told)


class FeatureSource(DataSource):
    """spark.read.format("polygon_features"): options layer, where, crs, partition_rows, push."""

    @classmethod
    def name(cls) -> str:
        return "polygon_features"

    def schema(self) -> StructType:
        first = next(iter(files_of(self.options["path"])), None)
        if first is None:
            raise ValueError(f"no .gpkg files in {self.options['path']}")
        layer = layer_of(first, self.options.get("layer"))
        return StructType([StructField("fid", LongType()), *(StructField(n, t) for n, t in layer.attributes), StructField("geometry", GEOMETRY)])

    def reader(self, schema: StructType) -> FeatureReader:
        kind = PushingReader if self.options.get("push") == "true" else FeatureReader
        return kind(self.options["path"], schema, self.options.get("layer"), self.options.get("where", ""), self.options.get("crs", "EPSG:4326"), int(self.options.get("partition_rows", PARTITION_ROWS)))


def scan(spark: SparkSession, path: str, *, layer: str | None = None, where: str = "", crs: str = "EPSG:4326", columns: Sequence[str] | None = None, partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """Features of a file or folder as fid, attributes and geometry (polygons of rings of points) in the wanted system.

    where: SQL over attributes, evaluated in the file. Filters of the plan go there too where the session allows it.
    """
    ship_package(spark)
    spark.dataSource.register(FeatureSource)
    options = {"where": where, "crs": crs, "partition_rows": partition_rows, "push": spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")}
    reader = spark.read.format("polygon_features").options(**options, **({"layer": layer} if layer else {}))
    if columns is not None:
        known = FeatureSource({"path": path, **({"layer": layer} if layer else {})}).schema()
        if missing := [c for c in columns if c not in known.names]:
            raise ValueError(f"{path} lacks {missing}; it has {known.names}")
        reader = reader.schema(StructType([known[c] for c in columns]))
    return reader.load(path)


def write_file(path: str, layer: str, attributes: Sequence[tuple[str, str]], rows: Iterable[tuple], srs: int = 4326) -> None:
    """A new file with one layer: rows are the attributes, in order, and the polygons. It is there whole or not at all."""
    at = local(path)
    made = f"{at}.{os.getpid()}.tmp"
    con = sqlite3.connect(made)
    con.executescript("""
        PRAGMA application_id = 1196444487;
        CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT, organization_coordsys_id INTEGER, definition TEXT);
        CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, srs_id INTEGER);
        CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z INTEGER, m INTEGER);
    """)
    con.executemany("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, 'undefined')", [("undefined", -1, "NONE", -1), ("undefined", 0, "NONE", 0), *([("system", srs, "EPSG", srs)] if srs > 0 else [])])
    con.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, ?)", (layer, layer, srs))
    con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'MULTIPOLYGON', ?, 0, 0)", (layer, srs))
    con.execute(f"CREATE TABLE {quoted(layer)} (fid INTEGER PRIMARY KEY, {', '.join(f'{quoted(n)} {t}' for n, t in attributes)}, geom BLOB)")
    marks = ", ".join("?" * (len(attributes) + 1))
    con.executemany(f"INSERT INTO {quoted(layer)} VALUES (NULL, {marks})", ((*r[:-1], None if r[-1] is None else encoded(r[-1], srs)) for r in rows))
    con.commit()
    con.close()
    os.replace(made, at)
