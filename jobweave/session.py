"""Session helpers: local sessions for tests and benches, checkpoints, table reads."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "jobweave", cpus: int | str = 8, partitions: int = 8, **conf: str) -> SparkSession:
    """A local[*] session with the settings that the tests and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("JOBWEAVE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only in local mode, where there is one machine."""
    have = spark.sparkContext._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="jobweave-checkpoint-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, with its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_table(df: DataFrame, most: int) -> list:
    """The rows of a reference table that does not grow with the data; raises where it has more than ``most``."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a reference table is meant to have at most {most} rows")
    return rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table. Zoneless timestamps mean UTC, so the session zone is pinned to it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
