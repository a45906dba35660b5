"""Parquet files whose columns and types drifted apart, read as one table.

Tasks read the files' footers; the driver gets the distinct schemas and which files have them. A column's type is the
narrowest that holds all its variants; files of one schema are scanned together and cast. What can't be widened is named.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType, ShortType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from rillflow.session import ship_package

WHOLE = (ByteType, ShortType, IntegerType, LongType)
TIMES = (DateType, TimestampNTZType, TimestampType)
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}


def wider(a: DataType, b: DataType) -> DataType | None:
    """The narrowest type that holds both, None without one. Whole numbers widen among themselves, to decimals and to doubles,
    dates to timestamps, and all simple types to text."""
    if a == b:
        return a
    if isinstance(a, NullType) or isinstance(b, NullType):
        return b if isinstance(a, NullType) else a
    for order in (WHOLE, TIMES):
        if isinstance(a, order) and isinstance(b, order):
            return a if order.index(type(a)) > order.index(type(b)) else b
    if isinstance(a, (*WHOLE, DecimalType)) and isinstance(b, (*WHOLE, DecimalType)):
        whole, scale = (max(n) for n in zip(*((t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)), strict=True))
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()
    numbers = (*WHOLE, FloatType, DoubleType, DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return DoubleType()
    nested = any(hasattr(t, "elementType") or hasattr(t, "fields") or hasattr(t, "keyType") for t in (a, b))
    return None if nested else StringType()


def schemas_of(spark: SparkSession, paths: Sequence[str]) -> list[tuple[StructType, list[str]]]:
    """(schema, files) of each distinct schema of some files, footers read by tasks."""
    ship_package(spark)

    def footers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        from rillflow.sources.fixed_width import opened

        for frame in frames:
            out = []
            for path in frame["path"]:
                system, at = opened(path)
                with system.open_input_file(at) as file:
                    out.append(from_arrow_schema(pq.read_schema(file)).json())
            yield pd.DataFrame({"path": frame["path"], "schema": out})

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), spark.sparkContext.defaultParallelism * 4)))
    found = files.mapInPandas(footers, "path string, schema string").groupBy("schema").agg(F.array_sort(F.collect_list("path")).alias("paths")).orderBy("schema").collect()
    return [(StructType.fromJson(json.loads(r["schema"])), list(r["paths"])) for r in found]


def files_below(spark: SparkSession, path: str) -> list[str]:
    """The parquet files of a folder or a pattern, hidden ones left out."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for status in files.globStatus(at) or []:
        inner = files.listStatus(status.getPath()) if status.isDirectory() else [status]
        out += [s.getPath().toString() for s in inner if s.isFile() and s.getPath().getName()[0] not in "._"]
    return sorted(out)


def common_schema(found: Sequence[tuple[StructType, Sequence[str]]]) -> StructType:
    """All columns of all schemas, in the order in which they first come, each as wide as it has to be.

    Raises ValueError with the column, the two types and the files of the second where no type holds both.
    """
    kinds: dict[str, DataType] = {}
    for schema, paths in found:
        for f in schema:
            kind = wider(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
            if kind is None:
                raise ValueError(f"column {f.name}: {kinds[f.name].simpleString()} and {f.dataType.simpleString()} can't be one, in {list(paths)[:20]}")
            kinds[f.name] = kind
    return StructType([StructField(n, t) for n, t in kinds.items()])


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the files below a path, columns by name, missing ones null, types as wide as they have to be.

    One scan for each distinct schema. A folder without files raises.
    """
    paths = files_below(spark, path)
    if not paths:
        raise FileNotFoundError(path)
    found = schemas_of(spark, paths)
    target = common_schema(found)

    def one(schema: StructType, files: Sequence[str]) -> DataFrame:
        rows = spark.read.schema(schema).parquet(*files)
        return rows.select(*((F.col(f"`{f.name}`").cast(f.dataType) if f.name in schema.names else F.lit(None).cast(f.dataType)).alias(f.name) for f in target))

    return reduce(DataFrame.unionByName, (one(*x) for x in found))
