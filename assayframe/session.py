"""Session construction and the shared working folder.

Library code never creates its own session: every operator takes and returns
DataFrames. ``build_session`` is for tests, benchmarks and scripts only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "assayframe") -> SparkSession:
    """A session tuned for the operators here: AQE on (coalescing, skew join,
    runtime broadcast), UI off, UTC, ANSI left at the Spark 4 default."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    cores = int(master[6:-1]) if master.startswith("local[") and master[6:-1].isdigit() else 8
    parts = shuffle_partitions or max(8, 2 * cores)
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("ASSAY_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can see, taken from ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage; it is read from the
    session and never replaced. Only a local-mode session without the setting
    (tests, a laptop) gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="assayframe-"))
    return sc.getCheckpointDir().rstrip("/")


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: several
    readers share one evaluation, a lost executor recomputes nothing before it,
    and the planner knows its size in bytes when it chooses a join."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path under the shared folder; ``unique`` adds a random suffix."""
    suffix = f"-{uuid.uuid4().hex[:12]}" if unique else ""
    return f"{shared_dir(spark)}/{name}{suffix}"
