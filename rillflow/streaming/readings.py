"""The gate on running totals as a stream: each reading is judged against the one before it, whatever batch either came in.

State is kept for each series: its readings by day. A new or corrected reading changes its own verdict and that of the next
one; both are sent, and of several verdicts for a day the last holds. So the verdicts after any split into batches, days in any
order, are those of integrity.judged_readings() on all rows. State of a series goes once event time has passed its last reading
by `keep`; rows later than that are dropped by the watermark, and counted by Spark as such.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillflow import config
from rillflow.session import ship_package

VERDICT = "value double, fell boolean, residual double, broken boolean"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class ReadingGate(StatefulProcessor):
    """series: names of the key's columns. keep: days of event time after which a series' state goes."""

    def __init__(self, series: Sequence[str], date: str, value: str, daily: str, fall: float, step: float, keep: int):
        self.series, self.date, self.value, self.daily = list(series), date, value, daily
        self.fall, self.step, self.keep = fall, step, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day date", "value double, daily double")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {k[0]: (v[0], v[1]) for k, v in self.days.iterator()}
        new: set[datetime.date] = set()
        for frame in rows:
            for day, value, daily in zip(frame[self.date], frame[self.value], frame[self.daily], strict=True):
                if pd.isna(value) or pd.isna(day):
                    continue
                reading = (float(value), None if pd.isna(daily) else float(daily))
                if day not in held or _order(reading) < _order(held[day]):
                    held[day] = reading
                    self.days.updateValue((day,), reading)
                    new.add(day)
        if not new:
            return
        self._wait(max(held))
        days = sorted(held)
        place = {d: k for k, d in enumerate(days)}
        judged = sorted({d for n in new for d in days[place[n] : place[n] + 2]})
        out = [self._verdict(days, place[d], held) for d in judged]
        frame = pd.DataFrame(out, columns=[self.date, "value", "fell", "residual", "broken"]).astype({"fell": object, "broken": object})
        for k, name in enumerate(self.series):
            frame.insert(k, name, [key[k]] * len(frame))
        yield frame

    def _verdict(self, days: list, k: int, held: dict) -> tuple:
        value, daily = held[days[k]]
        if not k:
            return days[k], value, None, None, None
        before, _ = held[days[k - 1]]
        residual = abs((value - before) - daily) if (days[k] - days[k - 1]).days == 1 and daily is not None else None
        return days[k], value, value < before - self.fall, residual, None if residual is None else residual > self.step

    def _wait(self, last: datetime.date) -> None:
        """One timer a series, at the end of what its state is kept for."""
        at = int(datetime.datetime(last.year, last.month, last.day, tzinfo=datetime.UTC).timestamp() * 1000) + self.keep * 86_400_000
        old = self.timer.get()[0] if self.timer.exists() else None
        if old == at:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.days.clear()
        self.timer.clear()
        return iter(())


def _order(reading: tuple) -> tuple:
    """Readings of a day by value, then by the day's figure, none first, as Spark orders them."""
    return reading[0], reading[1] is not None, reading[1] or 0.0


@contextmanager
def state_store(spark: SparkSession):
    """While a query starts: the state store that such state needs; the session's own setting comes back."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before is not None else spark.conf.unset(_STORE)


def judged(stream: DataFrame, series: Sequence[str], date: str, value: str, daily: str, *, late: str = "30 days", keep: int = 60, fall: float = config.FALL_TOLERANCE, step: float = config.STEP_TOLERANCE) -> DataFrame:
    """Verdicts (series, date, value, fell, residual, broken) of a stream of readings, new ones for days whose verdict changes.

    late: how far behind the newest day one may come. keep must be more than that, so that no row meets a series whose state
    has gone. Null days and values are no readings.
    """
    spark = stream.sparkSession
    ship_package(spark)
    kinds = dict(stream.dtypes)
    rows = stream.select(*series, F.col(date).cast("date").alias(date), F.col(value).cast("double").alias(value), F.col(daily).cast("double").alias(daily), F.col(date).cast("date").cast("timestamp").alias("__at"))
    gate = ReadingGate(series, date, value, daily, fall, step, keep)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in series), f"`{date}` date", VERDICT])
    return rows.withWatermark("__at", late).groupBy(*series).transformWithStateInPandas(gate, schema, "Update", "EventTime")


def run_gate(stream: DataFrame, path: str, series: Sequence[str], date: str, value: str, daily: str, **how) -> DataFrame:
    """Runs the gate over what is there now, on from where the folder's checkpoint is; all verdicts that hold.

    Each batch is a part of the folder, replaced where it is run again after a failure.
    """
    spark = stream.sparkSession
    verdicts = judged(stream, series, date, value, daily, **how)

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/verdicts/batch={number}")

    with state_store(spark):
        query = verdicts.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in verdicts.schema)
    every = spark.read.schema(f"{kinds}, batch long").parquet(f"{path}/verdicts")
    last = F.row_number().over(W.partitionBy(*series, date).orderBy(F.desc("batch")))
    return every.withColumn("__place", last).where("__place = 1").drop("__place", "batch")
