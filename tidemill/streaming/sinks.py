"""Sinks for streaming jobs. Every batch writes its own epoch folder with overwrite, so a batch that is run
again after a failure replaces its rows instead of adding them."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path

BatchWriter = Callable[[DataFrame, int], None]


def start(
    df: DataFrame,
    mode: str,
    writer: BatchWriter | None = None,
    kind: str = "parquet",
    path: str | None = None,
    partition_by: str | None = None,
    checkpoint: str | None = None,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query. Without ``every`` it takes what is there now and ends, else it runs on that interval.

    The checkpoint is below the shared folder unless given; a restart with the same one resumes.
    """
    out = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint or scratch_path(df.sparkSession, "ckpt"))
    if name:
        out = out.queryName(name)
    out = out.trigger(processingTime=every) if every else out.trigger(availableNow=True)
    if writer is not None:
        return out.foreachBatch(writer).start()
    out = out.format(kind)
    if partition_by:
        out = out.partitionBy(partition_by)
    return out.start(path) if path else out.start()


def run_now(df: DataFrame, mode: str, writer: BatchWriter | None = None, **options: Any) -> StreamingQuery:
    """Process everything available and wait for the end."""
    query = start(df, mode, writer, **options)
    query.awaitTermination()
    return query


def console(df: DataFrame, mode: str, every: str, name: str) -> StreamingQuery:
    return start(df, mode, kind="console", every=every, name=name)


def _epoch(path: str, epoch: int) -> str:
    return f"{path}/epoch={epoch}"


def append_epochs(path: str) -> BatchWriter:
    """Each batch's rows under its epoch."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(_epoch(path, epoch))

    return write


def ranking(path: str, key: str, n: int) -> BatchWriter:
    """Each batch's ``n`` best totals (count descending, key ascending) as the new ranking."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.orderBy(F.desc("cnt"), key).limit(n).write.mode("overwrite").parquet(_epoch(path, epoch))

    return write


def per_batch(path: str, job: Callable[[DataFrame], DataFrame]) -> BatchWriter:
    """A stateless job on each batch by itself."""

    def write(batch: DataFrame, epoch: int) -> None:
        job(batch).write.mode("overwrite").parquet(_epoch(path, epoch))

    return write


def fan_out(*writers: BatchWriter) -> BatchWriter:
    """Several sinks from one computation of the batch."""

    def write(batch: DataFrame, epoch: int) -> None:
        kept = batch.persist()
        try:
            for w in writers:
                w(kept, epoch)
        finally:
            kept.unpersist()

    return write


def read_epochs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def latest_epoch(spark: SparkSession, path: str) -> DataFrame:
    """The table as the last batch left it."""
    rows = read_epochs(spark, path)
    return rows.where(F.col("epoch") == rows.agg(F.max("epoch").alias("e")).scalar()).drop("epoch")


def latest_values(spark: SparkSession, path: str, keys: Sequence[str], value: str = "cnt") -> DataFrame:
    """Newest value per key of an update-mode log: an upsert without rewriting old rows."""
    return read_epochs(spark, path).groupBy(*keys).agg(F.max_by(value, "epoch").alias(value))


def read_ranking(table: DataFrame, key: str) -> DataFrame:
    return table.orderBy(F.desc("cnt"), F.asc(key))


class Reloaded:
    """A value loaded again once it is older than ``max_age`` seconds; ask once per batch so that one batch
    never mixes two versions."""

    def __init__(self, load: Callable[[], Any], max_age: float = 60.0, clock: Callable[[], float] = time.monotonic):
        self.load, self.max_age, self.clock = load, max_age, clock
        self.value: Any = None
        self.loaded_at: float | None = None

    def get(self) -> Any:
        now = self.clock()
        if self.loaded_at is None or now - self.loaded_at >= self.max_age:
            self.value, self.loaded_at = self.load(), now
        return self.value


def scored_batches(path: str, model: Reloaded, score: Callable[[DataFrame, Any], DataFrame]) -> BatchWriter:
    """Score each batch with the model current at its start."""

    def write(batch: DataFrame, epoch: int) -> None:
        score(batch, model.get()).write.mode("overwrite").parquet(_epoch(path, epoch))

    return write
