"""Session set-up, shared scratch space and size-checked broadcasts."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 100_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs assume: UTC, adaptive execution, skew-join splitting."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that workers can import it from any folder."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tidemill-code-"), "tidemill_code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in sorted(f for f in files if f.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.join(os.path.basename(root), os.path.relpath(path, root)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``.

    Only a session whose driver is its one executor may go without the setting and use a temporary folder;
    elsewhere that would lose data, and is an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not re.fullmatch(r"local(\[[^-\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tidemill-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    It survives the loss of any executor, is computed once (an eager checkpoint computes its input
    twice), carries no growing plan or constraints into the next round of a loop, and its file sizes tell
    the planner which sides are small. Nothing asks for its shuffles again, so Spark deletes them after the write.
    The folder's owner clears it between runs.
    """
    path = scratch_path(df.sparkSession, "stage")
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of each query that runs inside as soon as the query ends."""
    before = spark.conf.get(CLEANUP, "false")
    try:
        spark.conf.set(CLEANUP, "true")
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose results nothing refers to.

    Its cleaner follows the driver's garbage collection, which a loop of many jobs and few objects does not set off.
    """
    gc.collect()  # objects of this process hold those of the driver's JVM
    spark.sparkContext._jvm.System.gc()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def shuffles_for(spark: SparkSession, rows: int, each: int = 250_000) -> Iterator[None]:
    """Shuffles that run inside have a partition for every ``each`` of ``rows`` rows, so that a task's memory does not follow the input,
    and no fewer than the session's own number, which comes back afterwards."""
    before = shuffle_width(spark)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(max(before, -(-rows // each))))
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(before))


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True if ``df`` has at most ``max_rows`` rows (reads no more than needed to tell)."""
    return df.limit(max_rows + 1).count() <= max_rows


def small_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its row count was checked to be small, else unmarked.

    Unmarked sides still join, by a shuffle whose hot keys adaptive execution splits.
    """
    return F.broadcast(df) if fits(df, max_rows) else df
