"""Days as a stream: duplicates within a watermark, windows, gates on each batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def files(spark: SparkSession, path: str, schema, max_files: int = 8) -> DataFrame:
    """A stream of parquet files below a path."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def daily_counts(events: DataFrame, time: str, late: str = "1 day", *keys: str) -> DataFrame:
    """Events per day and key. Watermarks need a zoned timestamp, so the time is cast."""
    return events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late).groupBy(F.window("__t", "1 day").alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").cast("date").alias("day"), *keys, "n")


def first_seen(events: DataFrame, time: str, late: str, *keys: str) -> DataFrame:
    """Each key once within the watermark: never twice for one day."""
    return events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late).dropDuplicatesWithinWatermark(list(keys)).drop("__t")


def sessions(events: DataFrame, time: str, gap: str, late: str, *keys: str) -> DataFrame:
    """Sessions of a key, closed by a gap."""
    return events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late).groupBy(F.session_window("__t", gap).alias("s"), *keys).agg(F.count(F.lit(1)).alias("n")).select(*keys, F.col("s.start").alias("started"), F.col("s.end").alias("ended"), "n")


def drain(stream: DataFrame, name: str, mode: str = "complete", checkpoint: str | None = None) -> DataFrame:
    """Runs a stream over what is there now and returns its memory table, which the driver holds: for tests. Jobs use landed()."""
    writer = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    query = writer.start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def landed(stream: DataFrame, path: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Runs a stream over what is there now into a folder, each batch to a part of its own, and returns the rows that hold.

    mode append: the rows of all batches; complete: those of the last. A batch that is run again replaces its part. Nothing
    passes through the driver.
    """
    spark = stream.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.outputMode(mode).foreachBatch(step).option("checkpointLocation", checkpoint or f"{path}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = [int(f.getPath().getName().removeprefix("batch=")) for f in files.listStatus(at)] if files.exists(at) else []
    if not numbers:
        return spark.createDataFrame([], stream.schema)
    if mode == "complete":
        return spark.read.schema(stream.schema).parquet(f"{path}/batch={max(numbers)}")
    return spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in stream.schema)}, batch long").parquet(path)


def gated(stream: DataFrame, gate: Callable[[DataFrame], tuple[DataFrame, DataFrame]], accept: Callable[[DataFrame, int], None], reject: Callable[[DataFrame, int], None], checkpoint: str):
    """Each batch is split by the gate into rows to accept and rows to reject; both are written, none is dropped."""

    def step(batch: DataFrame, number: int) -> None:
        batch.persist()
        good, bad = gate(batch)
        accept(good, number)
        reject(bad, number)
        batch.unpersist()

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def route_season(rows: DataFrame, date: str, months: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Rows in and out of season: the latter are kept apart, not dropped. Rows without a date are out of season."""
    inside = F.coalesce(F.month(date).between(*months), F.lit(False))
    return rows.where(inside), rows.where(~inside)


def distinct_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch form of first_seen: one row per key, the least in all columns."""
    rest = [c for c in frame.columns if c not in keys]
    return frame.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r")).select(*keys, *(F.col(f"__r.{c}").alias(c) for c in rest))
