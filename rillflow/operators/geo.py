"""Points against outlines: containment and distance in kilometres, in vectorised Python over broadcast outlines."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillflow import config
from rillflow.session import ship_package

Ring = Sequence[tuple[float, float]]


def _rings(polygon: Sequence[Ring]) -> list[np.ndarray]:
    return [np.asarray(r, float) for r in polygon]


def inside(polygon: Sequence[np.ndarray], lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    """Whether points lie in a polygon (outer ring, then holes; rings of (lon, lat), closed or not): even-odd over all its rings."""
    crossings = np.zeros(len(lon), np.int64)
    for ring in polygon:
        for (x, y), (x2, y2) in zip(ring, np.roll(ring, -1, 0), strict=True):
            if y != y2:
                crossings += ((y > lat) != (y2 > lat)) & (lon < (x2 - x) * (lat - y) / (y2 - y) + x)
    return crossings % 2 == 1


def edge_distance(polygon: Sequence[np.ndarray], lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(degrees, kilometres) of points to the nearest edge of any ring, on a plane scaled by each point's latitude."""

    def least(kx: np.ndarray | float, ky: float) -> np.ndarray:
        best = np.full(len(lon), np.inf)
        for ring in polygon:
            for (x, y), (x2, y2) in zip(ring, np.roll(ring, -1, 0), strict=True):
                px, py, dx, dy = (x - lon) * kx, (y - lat) * ky, (x2 - x) * kx, (y2 - y) * ky
                length = dx * dx + dy * dy
                t = np.clip(np.where(length > 0, -(px * dx + py * dy) / np.where(length > 0, length, 1), 0), 0, 1)
                best = np.minimum(best, np.hypot(px + t * dx, py + t * dy))
        return best

    return least(1.0, 1.0), least(config.KM_PER_DEGREE * np.cos(np.radians(lat)), config.KM_PER_DEGREE_NORTH)


def km_outside(polygons: Sequence[Sequence[np.ndarray]], lon: np.ndarray, lat: np.ndarray, buffer: float = config.OUTLINE_BUFFER) -> np.ndarray:
    """0 within a polygon or the buffer around it, else kilometres to the nearest edge; a point in a hole is outside."""
    best = np.full(len(lon), np.inf)
    for polygon in polygons:
        degrees, km = edge_distance(polygon, lon, lat)
        best = np.minimum(best, np.where(inside(polygon, lon, lat) | (degrees <= buffer), 0.0, km))
    return best


#: Vertices of all outlines together that are sent to the executors.
MOST_VERTICES = 2_000_000


def distance_function(spark: SparkSession, outlines: Mapping[str, Sequence[Sequence[Ring]]]):
    """A column function (name, lon, lat) -> km outside the outline of that name; null if it is unknown or the point is.

    An outline is a list of polygons, a polygon its outer ring and its holes. Points are judged an outline at a time. Outlines
    are districts, whose number doesn't grow with the rows; more than MOST_VERTICES of them raise.
    """
    ship_package(spark)
    known = {k: [_rings(p) for p in polygons] for k, polygons in outlines.items()}
    if (n := sum(len(r) for polygons in known.values() for p in polygons for r in p)) > MOST_VERTICES:
        raise ValueError(f"{n} vertices; simplify the outlines or raise MOST_VERTICES")
    sent = spark.sparkContext.broadcast(known)

    @F.pandas_udf("double")
    def km(name: pd.Series, lon: pd.Series, lat: pd.Series) -> pd.Series:
        out = np.full(len(name), np.nan)
        good = lon.notna().to_numpy() & lat.notna().to_numpy()
        x, y = lon.to_numpy(float, na_value=np.nan), lat.to_numpy(float, na_value=np.nan)
        for one in name.dropna().unique():
            if one in sent.value:
                rows = np.nonzero((name == one).to_numpy() & good)[0]
                out[rows] = km_outside(sent.value[one], x[rows], y[rows])
        return pd.Series(out).astype("Float64")  # NaN becomes null

    return km


def outlines_of(features: DataFrame, name: str) -> dict[str, list[list[Ring]]]:
    """Outlines by a property's value, from the features of a GeoJSON collection: polygons and multipolygons, holes kept."""
    shape = F.to_json(F.col("geometry.coordinates"))
    # a vertex has two commas at most, so that what is too much for the driver is seen before it gets there
    commas = features.agg(F.sum(F.char_length(shape) - F.char_length(F.replace(shape, F.lit(","), F.lit("")))).alias("n")).first()["n"] or 0
    if commas // 2 > MOST_VERTICES:
        raise ValueError(f"about {commas // 2} vertices; outlines.km_outside() takes any number")
    out: dict[str, list[list[Ring]]] = {}
    for n, kind, text in features.select(F.col(f"properties.{name}"), F.col("geometry.type"), shape).collect():
        at = json.loads(text)
        out.setdefault(n, []).extend([at] if kind == "Polygon" else at)
    return out


def parents(primary: Column, others: Column) -> Column:
    """Names that a point may lie in: the primary parent and a comma list of others; blanks left out."""
    listed = F.transform(F.split(F.coalesce(others, F.lit("")), ","), lambda x: F.trim(x))
    return F.array_distinct(F.filter(F.concat(F.array(primary), listed), lambda x: x.isNotNull() & (x != "")))
