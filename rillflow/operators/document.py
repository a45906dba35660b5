"""The nested document that a page is served from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def series_map(day: str, value: str) -> Column:
    """Aggregate: map(day -> value), nulls left out, days ascending."""
    pairs = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col(day).cast("int").alias("k"), F.col(value).alias("v")))))
    return F.map_from_entries(pairs)


def nested_series(rows: DataFrame, key: str, season: str, day: str, value: str) -> DataFrame:
    """Per key: map(season -> map(day -> value)); two aggregations, no loop over keys."""
    inner = rows.groupBy(key, season).agg(series_map(day, value).alias("__days"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(season).cast("string").alias("k"), F.map_entries("__days").alias("e"))))
    return inner.groupBy(key).agg(F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["k"].alias("k"), F.map_from_entries(p["e"]).alias("v")))).alias("series"))


def thin(rows: DataFrame, day: str, every: int = 3) -> DataFrame:
    """Every so-manieth day from the first, and the last one always."""
    latest = rows.agg(F.max(day).alias("__latest"))  # one row
    return rows.crossJoin(latest).where((F.col(day) % every == 1) | (F.col(day) == F.col("__latest"))).drop("__latest")


def attach(rows: DataFrame, part: DataFrame, key: str, name: str) -> DataFrame:
    """rows with the part's other columns as one struct, null where it has no row."""
    packed = part.select(F.col(key).alias("__key"), F.struct(*(c for c in part.columns if c != key)).alias(name))
    return rows.join(packed, F.col(key) == F.col("__key"), "left").drop("__key")


def children(rows: DataFrame, child: DataFrame, key: str, *order: str, name: str = "children") -> DataFrame:
    """rows with their child rows as a JSON array of objects in order, "" where there are none."""
    fields = [c for c in child.columns if c != key]
    listed = F.array_sort(F.collect_list(F.struct(*order, *(c for c in fields if c not in order))))
    packed = child.groupBy(F.col(key).alias("__key")).agg(F.to_json(listed, {"ignoreNullFields": "false"}).alias(name))
    return rows.join(packed, F.col(key) == F.col("__key"), "left").drop("__key").withColumn(name, F.coalesce(name, F.lit("")))


def records(rows: DataFrame, *order: str) -> DataFrame:
    """One row: all rows as an array of structs, in order. For report tables only, whose length is fixed."""
    names = [c for c in rows.columns if c not in order]

    def compare(a: Column, b: Column) -> Column:
        x, y = (F.struct(*(side[c].alias(c) for c in order)) for side in (a, b))
        return F.when(x < y, -1).when(x > y, 1).otherwise(0)

    return rows.agg(F.array_sort(F.collect_list(F.struct(*order, *names)), compare).alias("records"))


def to_document(*parts: tuple[str, DataFrame]) -> DataFrame:
    """One row with one JSON text: each part is a frame of one row and one column; nulls are written out."""
    out = None
    for name, part in parts:
        one = part.select(F.col(part.columns[0]).alias(name))
        out = one if out is None else out.crossJoin(one)
    return out.select(F.to_json(F.struct(*(n for n, _ in parts)), {"ignoreNullFields": "false"}).alias("document"))
