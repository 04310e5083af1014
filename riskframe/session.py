"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on; safe to apply to a session someone else built.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(app: str = "riskframe", cpus: int | str = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a folder of its own, which goes when the process ends; on a
    cluster a machine-local folder would vanish with its machine, so the setting is required there. A cluster job calls
    :func:`clear_work` when its results are written.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        base = tempfile.mkdtemp(prefix="riskframe-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/riskframe-{spark.sparkContext.applicationId}"


def clear_work(spark: SparkSession) -> None:
    """Remove this application's intermediate tables. Frames that still read them cannot be used any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables materialized inside are removed at the end; what is needed later has been written elsewhere by then."""
    paths: list[str] = []
    before = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(before)
        for path in paths:
            remove(spark, path)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage before a frame is scanned by several statistics passes. The table outlives
    lost executors, and later passes read only the columns they need.
    """
    path = new_path(df.sparkSession, name)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if (paths := _passing.get()) is not None:
        paths.append(path)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FEW_ROWS = 50_000
ROWS_PER_TASK = 1_000_000


def spread(df: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows dealt evenly over every core, ``ROWS_PER_TASK`` at most to a task.

    For frames whose rows cost much more to work on than to read: by its bytes alone such a frame ends in one or two tasks.
    ``FEW_ROWS`` stay as they lie: trees break ties by the order of their sums, which follows the rows' order.
    """
    if rows <= FEW_ROWS:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * max(1, math.ceil(rows / (cores * ROWS_PER_TASK))))
