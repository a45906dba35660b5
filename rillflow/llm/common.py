"""What the operators of this subpackage share: the shared folder, cut lineage and Arrow passes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillflow.session import ship_package

#: A word, here and in the contracts: a run of characters other than blank, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one task writes of a table whose size is known, and tasks that such a table has at least, if its plan has as many.
TABLE_ROWS, TABLE_TASKS = 1 << 16, 8
#: Rows in one Arrow batch; texts may hold 100 kB and more each, so far fewer than Spark's 10,000.
BATCH_ROWS = 512


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset a folder made for local runs.

    Off local mode an unset folder is an error: executors can't see a folder of the driver's machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    made = spark.sparkContext.getCheckpointDir()
    if made:
        return made.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="rillflow-")
    atexit.register(shutil.rmtree, own, True)
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def own_dir(spark: SparkSession) -> str:
    """The folder of this application's tables within the shared one."""
    return f"{shared_dir(spark)}/rillflow/{spark.sparkContext.applicationId}"


def remove_tables(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the tables of these frames, if they are of stored(), or, without any, all tables of this application.

    Results that are still to be computed from them fail: save those first.
    """
    at = lambda path: spark._jvm.org.apache.hadoop.fs.Path(path)
    own = own_dir(spark)
    files = at(own).getFileSystem(spark._jsc.hadoopConfiguration())
    for path in [getattr(f, "_rillflow_path", None) for f in frames] if frames else [own]:
        if path:
            files.delete(at(path), True)


def stored(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write df as a parquet table in the shared folder and read it back: lineage ends there, and lost executors cost no recomputation.

    rows: a bound of its rows, where one is known. Tasks that would write less than TABLE_ROWS each are then run as one, so that a
    small table isn't hundreds of files; a larger one keeps its partitions.
    """
    path = f"{own_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(TABLE_TASKS, -(-rows // TABLE_ROWS)))
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._rillflow_path = path  # for remove_tables()
    return out


def arrow_pass(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """mapInArrow, each batch cut to so many rows: Spark bounds the bytes it sends at once, this what a task makes of them at once."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(batch.slice(k, rows) for batch in batches for k in range(0, batch.num_rows, rows))

    return df.mapInArrow(run, schema)


def salted(rows: DataFrame, key: str, by: str, table: DataFrame, key_of_table: str, salts: int, how: str = "inner") -> DataFrame:
    """rows joined with a narrow table that has one row per key; the rows of any one key are dealt to `salts` tasks by `by`."""
    spread = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    mine = rows.withColumn("__turn", F.pmod(F.xxhash64(by, F.lit(3)), F.lit(salts)).cast("int"))
    return mine.join(spread, (F.col(key) == F.col(key_of_table)) & (F.col("__turn") == F.col("__salt")), how).drop("__turn", "__salt")


def rows_pass(fn: Callable[..., tuple], names: list[str], types: list[pa.DataType], keep: int = 1) -> Callable:
    """A mapInArrow function from fn(text) -> tuple. Input: `keep` columns passed through as they are, then the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [fn(text) for text in batch.column(keep).to_pylist()]
            columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:keep], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=[*batch.schema.names[:keep], *names],
            )

    return run


def unit_hash(seed: str, *columns: Column) -> Column:
    """A number in [0, 1) from the md5 of the columns' text: 52 bits, the same in Spark, DuckDB and Python."""
    text = F.concat_ws("|", F.lit(seed), *(F.coalesce(c.cast("string"), F.lit("\\N")) for c in columns))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def crc_of_id(column: Column) -> Column:
    """crc32 of an id's decimal text."""
    return F.crc32(column.cast("string"))
