"""Session settings shared by tests, the benchmark and stand-alone use."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "rillflow", cpus: int | None = None, partitions: int | None = None) -> SparkSession:
    """A session for local use. On a cluster, pass the session that the cluster made instead."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, for what is written on the way: spark.checkpoint.dir, or in local mode, where
    that is unset, a folder of its own that goes with the process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_rillflow_work", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark._rillflow_work = tempfile.mkdtemp(prefix="rillflow-")
    atexit.register(shutil.rmtree, spark._rillflow_work, True)
    return spark._rillflow_work


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each context: their Python workers need no copy of their own."""
    context = spark.sparkContext
    if getattr(context, "_rillflow_shipped", False):
        return
    here, folder = Path(__file__).resolve().parent, tempfile.mkdtemp(prefix="rillflow-")
    with zipfile.ZipFile(f"{folder}/rillflow.zip", "w") as out:
        for file in sorted(here.rglob("*.py")):
            out.write(file, file.relative_to(here.parent))
    context.addPyFile(f"{folder}/rillflow.zip")
    atexit.register(shutil.rmtree, folder, True)
    context._rillflow_shipped = True


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a parquet table in the shared folder, read back: what follows is computed from it, and lost executors cost no more."""
    path = f"{work_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
