"""Statistical files of fixed-width records (.dta): the header alone for metadata, byte ranges of records as partitions.

A record is a run of bytes with a column at a fixed offset, so a task reads its range in blocks and decodes the wanted columns
alone; the driver reads headers only. Releases 113 to 115 and 117 to 119 are read. Codes of missing values become null.
"""

from __future__ import annotations

import io
import posixpath
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from rillflow.session import ship_package

#: Bytes of one partition and of one read; rows of one written file.
PARTITION_BYTES, READ_BYTES, FILE_ROWS = 64 << 20, 8 << 20, 200_000
#: Rows of the smallest and largest numbers that are values; what lies beyond stands for a missing one (fixed values of the format).
LARGEST = {"i1": 100, "i2": 32740, "i4": 2147483620, "f4": struct.unpack("<f", b"\xff\xff\xff\x7e")[0], "f8": struct.unpack("<d", b"\xff\xff\xff\xff\xff\xff\xdf\x7f")[0]}
#: Type codes of numbers in old and new releases (fixed values of the format).
OLD_CODES = {251: "i1", 252: "i2", 253: "i4", 254: "f4", 255: "f8"}
NEW_CODES = {65530: "i1", 65529: "i2", 65528: "i4", 65527: "f4", 65526: "f8"}
LONG_STRINGS = 32768
SPARK_TYPES: dict[str, DataType] = {"i1": ByteType(), "i2": ShortType(), "i4": IntegerType(), "f4": FloatType(), "f8": DoubleType()}
ARROW_TYPES = {"i1": pa.int8(), "i2": pa.int16(), "i4": pa.int32(), "f4": pa.float32(), "f8": pa.float64()}


@dataclass(frozen=True)
class Column:
    """kind: i1, i2, i4, f4, f8, S<bytes>, or L for a long string kept elsewhere in the file."""

    name: str
    kind: str
    offset: int

    @property
    def spark_type(self) -> DataType:
        return SPARK_TYPES.get(self.kind, StringType())


@dataclass(frozen=True)
class Layout:
    """Where a file's records are: order is < or >, start the first record's byte."""

    path: str
    order: str
    encoding: str
    rows: int
    width: int
    start: int
    columns: tuple[Column, ...]


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it, of a URI or a local path."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def files_of(path: str) -> list[str]:
    """The .dta files of a path: itself, or those of a folder in order, hidden ones left out."""
    system, at = opened(path)
    info = system.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [path]
    names = sorted(f.base_name for f in system.get_file_info(fs.FileSelector(at)) if f.type == fs.FileType.File and f.base_name.endswith(".dta") and f.base_name[0] not in "._")
    return [posixpath.join(path, n) for n in names]


def _laid_out(names: Sequence[str], codes: Sequence[int], numbers: dict[int, str]) -> tuple[tuple[Column, ...], int]:
    columns, at = [], 0
    for name, code in zip(names, codes, strict=True):
        kind = numbers.get(code) or ("L" if code == LONG_STRINGS else f"S{code}")
        columns.append(Column(name, kind, at))
        at += 8 if kind == "L" else int(kind[1:])
    return tuple(columns), at


def _until_zero(raw: bytes, encoding: str) -> str:
    return raw.partition(b"\0")[0].decode(encoding)


def layout(path: str) -> Layout:
    """A file's layout, from its header alone. Files that are none raise ValueError."""
    system, at = opened(path)
    with system.open_input_file(at) as file:
        first = file.read(1)
        return _new_layout(path, file) if first == b"<" else _old_layout(path, file, first)


def _old_layout(path: str, file: pa.NativeFile, first: bytes) -> Layout:
    release = first[0] if first else 0
    if release not in (113, 114, 115):
        raise ValueError(f"{path}: not a file of release 113 to 119")
    order = "<" if file.read(1)[0] == 2 else ">"
    file.read(2)
    k, n = struct.unpack(f"{order}Hi", file.read(6))
    file.read(81 + 18)
    codes = list(file.read(k))
    names = [_until_zero(file.read(33), "latin-1") for _ in range(k)]
    file.read(2 * (k + 1) + (49 if release > 113 else 12) * k + 33 * k + 81 * k)
    while True:  # expansion fields, each with its length
        kind, size = struct.unpack(f"{order}bi", file.read(5))
        if not kind and not size:
            break
        file.seek(file.tell() + size)
    columns, width = _laid_out(names, codes, OLD_CODES)
    return Layout(path, order, "latin-1", n, width, file.tell(), columns)


def _new_layout(path: str, file: pa.NativeFile) -> Layout:
    head = b"<" + file.read(160)
    stream = io.BytesIO(head)

    def after(tag: bytes, size: int) -> bytes:
        place = head.find(tag)
        if place < 0:
            raise ValueError(f"{path}: no {tag.decode()} in the header")
        stream.seek(place + len(tag))
        return stream.read(size)

    release = int(after(b"<release>", 3))
    if release not in (117, 118, 119):
        raise ValueError(f"{path}: release {release} is not one of 117 to 119")
    order = "<" if after(b"<byteorder>", 3) == b"LSF" else ">"
    k = struct.unpack(f"{order}{'I' if release == 119 else 'H'}", after(b"<K>", 4 if release == 119 else 2))[0]
    n = struct.unpack(f"{order}{'I' if release == 117 else 'Q'}", after(b"<N>", 4 if release == 117 else 8))[0]
    # a label of any length may follow; the map after it says where all parts start
    size = struct.unpack(f"{order}{'B' if release == 117 else 'H'}", after(b"<label>", 1 if release == 117 else 2))[0]
    file.seek(head.find(b"<label>"))
    rest = file.read(size + 400)
    places = struct.unpack(f"{order}14q", rest[rest.index(b"<map>", size) + 5 :][:112])

    def part(index: int, tag: bytes, count: int) -> bytes:
        file.seek(places[index] + len(tag))
        return file.read(count)

    codes = struct.unpack(f"{order}{k}H", part(2, b"<variable_types>", 2 * k))
    each = 33 if release == 117 else 129
    raw = part(3, b"<varnames>", each * k)
    encoding = "latin-1" if release == 117 else "utf-8"
    names = [_until_zero(raw[i * each : (i + 1) * each], encoding) for i in range(k)]
    columns, width = _laid_out(names, codes, NEW_CODES)
    return Layout(path, order, encoding, n, width, places[9] + len(b"<data>"), columns)


def decoded(block: bytes, at: Layout, wanted: Sequence[Column]) -> pa.RecordBatch:
    """Rows of whole records, the wanted columns alone."""
    if not wanted:
        rows = len(block) // at.width if at.width else 0
        return pa.RecordBatch.from_arrays([pa.array(np.zeros(rows, np.int8))], names=["__none"])
    kinds = [c.kind if c.kind[0] == "S" else at.order + c.kind for c in wanted]
    rows = np.frombuffer(block, np.dtype({"names": [c.name for c in wanted], "formats": kinds, "offsets": [c.offset for c in wanted], "itemsize": at.width}))
    out = []
    for c in wanted:
        values = rows[c.name]
        if c.kind[0] == "S":
            out.append(pa.array([_until_zero(v, at.encoding) for v in values.tolist()], pa.string()))
        else:
            values = values.astype(values.dtype.newbyteorder("="))
            with np.errstate(invalid="ignore"):
                out.append(pa.array(values, ARROW_TYPES[c.kind], mask=~(values <= LARGEST[c.kind])))
    return pa.RecordBatch.from_arrays(out, names=[c.name for c in wanted])


@dataclass
class Records(InputPartition):
    """Rows first to first + count of a file."""

    at: Layout
    first: int
    count: int


class RecordReader(DataSourceReader):
    """Reads the columns of a schema, by name."""

    def __init__(self, path: str, schema: StructType, size: int):
        self.path, self.schema, self.size = path, schema, size

    def partitions(self) -> list[Records]:
        out = []
        for path in files_of(self.path):
            at = layout(path)
            wanted(at, self.schema.names)
            step = max(1, self.size // max(1, at.width))
            out += [Records(at, k, min(step, at.rows - k)) for k in range(0, at.rows, step)]
        return out

    def read(self, partition: Records | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark asks for where there are no partitions
            return
        at, columns = partition.at, wanted(partition.at, self.schema.names)
        system, path = opened(at.path)
        step = max(1, READ_BYTES // max(1, at.width))
        with system.open_input_file(path) as file:
            for k in range(partition.first, partition.first + partition.count, step):
                rows = min(step, partition.first + partition.count - k)
                file.seek(at.start + k * at.width)
                block = file.read(rows * at.width)
                if len(block) != rows * at.width:
                    raise ValueError(f"{at.path}: the file ends before row {k + rows}")
                batch = decoded(block, at, columns)
                yield pa.RecordBatch.from_arrays([batch.column(i).cast(_arrow_of(f.dataType)) for i, f in enumerate(self.schema)], names=self.schema.names)


def _arrow_of(kind: DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def wanted(at: Layout, names: Sequence[str]) -> list[Column]:
    """The columns of these names, in order; missing ones and long strings raise, all of them named."""
    known = {c.name: c for c in at.columns}
    if missing := [n for n in names if n not in known]:
        raise ValueError(f"{at.path} lacks {missing}; it has {list(known)[:60]}")
    if far := [n for n in names if known[n].kind == "L"]:
        raise ValueError(f"{at.path}: {far} are long strings, which lie outside of the records")
    return [known[n] for n in names]


class _Writer(DataSourceWriter):
    """Files of at most FILE_ROWS rows, written beside and moved to their place when all tasks are done."""

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        import pandas as pd
        from pyspark import TaskContext

        context = TaskContext.get()
        system, at = opened(self.path)
        system.create_dir(f"{at}/_written", recursive=True)
        names, rows = [], []

        def out() -> None:
            name = f"part-{context.partitionId():05d}-{len(names):03d}-{context.taskAttemptId()}.dta"
            frame = pd.DataFrame({f.name: _fitting([r[k] for r in rows], f.dataType) for k, f in enumerate(self.schema)})
            with system.open_output_stream(f"{at}/_written/{name}") as file:
                buffer = io.BytesIO()
                frame.to_stata(buffer, write_index=False, version=118)
                file.write(buffer.getvalue())
            names.append(name)
            rows.clear()

        for row in iterator:
            rows.append(row)
            if len(rows) >= FILE_ROWS:
                out()
        if rows:
            out()
        return _Files(names)

    def commit(self, messages: list) -> None:
        system, at = opened(self.path)
        if self.overwrite:
            for old in files_of(self.path):
                system.delete_file(opened(old)[1])
        for message in messages:
            for name in message.names if message else []:
                system.move(f"{at}/_written/{name}", f"{at}/{name}")
        self.abort(messages)

    def abort(self, messages: list) -> None:
        system, at = opened(self.path)
        if system.get_file_info(f"{at}/_written").type == fs.FileType.Directory:
            system.delete_dir(f"{at}/_written")


@dataclass
class _Files(WriterCommitMessage):
    names: list[str]


def _fitting(values: list, kind: DataType):
    """A column that the format can hold: whole numbers of 64 bits as doubles, if they are exact there; nulls as missing ones."""
    import pandas as pd

    if isinstance(kind, StringType):
        return pd.Series(["" if v is None else v for v in values], dtype=object)
    if isinstance(kind, LongType) and any(v is not None and abs(v) > 1 << 53 for v in values):
        raise ValueError("a number beyond 2^53 has no exact double")
    small = {ByteType: "Int8", ShortType: "Int16", IntegerType: "Int32"}.get(type(kind))
    if small and all(v is not None for v in values):
        return pd.Series(values, dtype=small.lower())
    return pd.Series([float("nan") if v is None else float(v) for v in values], dtype="float32" if isinstance(kind, FloatType) else "float64")


class FixedWidthSource(DataSource):
    """spark.read.format("fixed_width"): load(path) of a file or a folder; a schema given reads only its columns."""

    @classmethod
    def name(cls) -> str:
        return "fixed_width"

    def schema(self) -> StructType:
        first = next(iter(files_of(self.options["path"])), None)
        if first is None:
            raise ValueError(f"no .dta files in {self.options['path']}")
        return StructType([StructField(c.name, c.spark_type) for c in layout(first).columns if c.kind != "L"])

    def reader(self, schema: StructType) -> RecordReader:
        return RecordReader(self.options["path"], schema, int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], schema, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session and its executors."""
    ship_package(spark)
    spark.dataSource.register(FixedWidthSource)


def columns_of(path: str) -> list[tuple[str, str]]:
    """(name, Spark type) of a file's or a folder's first file's columns; no record is read."""
    return [(c.name, c.spark_type.simpleString()) for c in layout(files_of(path)[0]).columns]


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None, required: Sequence[str] = ()) -> DataFrame:
    """The columns of a file or folder, those of `columns` that it has; raises ValueError, all named, where a required one is
    missing, before any record is read. Types are the first file's; numbers of other files are cast to them."""
    known = dict(columns_of(path))
    if missing := [c for c in required if c not in known]:
        raise ValueError(f"required columns absent: {missing}; the first of {len(known)} are {list(known)[:60]}")
    names = list(dict.fromkeys([*required, *(c for c in columns if c in known)])) if columns is not None else [c for c in known]
    register(spark)
    return spark.read.format("fixed_width").schema(", ".join(f"`{n}` {known[n]}" for n in names)).load(path)
