"""Streaming transformations. They are plain DataFrame functions and work on batch tables as well."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_width


def window_label(window: Column) -> Column:
    """``HHMMSS-HHMMSS`` of a window."""
    parts = [F.date_format(window.getField(end), "HHmmss") for end in ("start", "end")]
    return F.concat_ws("-", *parts)


def running_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Total per key since the start; the engine keeps one number per key as state."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


def words_of(df: DataFrame, tokens: Column, name: str = "word") -> DataFrame:
    return df.select(F.explode(tokens).alias(name))


def ranked(counts: DataFrame, key: str) -> DataFrame:
    """Sorted totals; allowed on a stream only in complete output mode."""
    return counts.orderBy(F.desc("cnt"), key)


def window_counts(
    df: DataFrame, ts: str, keys: list[str], size: str, slide: str | None = None, late: str | None = None
) -> DataFrame:
    """Count per key and (sliding) event-time window. With ``late``, rows older than the watermark are
    dropped and state of closed windows is freed."""
    source = df.withWatermark(ts, late) if late else df
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return source.groupBy(window.alias("window"), *keys).agg(F.count(F.lit(1)).alias("cnt"))


def windows_of_panes(panes: DataFrame, keys: list[str], pane: int, size: int) -> DataFrame:
    """(keys..., start, cnt) of the windows of ``size`` seconds that begin with each pane, from counts of panes (keys..., start, cnt) of
    ``pane`` seconds, which divide ``size``. Rows are dealt by key before each pane goes to its windows, so these are not shuffled."""
    if size <= 0 or size % pane:
        raise ValueError("pane must divide size")
    dealt = panes.repartition(shuffle_width(panes.sparkSession), *keys)
    back = F.explode(F.sequence(F.lit(0), F.lit(size // pane - 1)))
    placed = dealt.select(*keys, "start", "cnt", back.alias("_k")).withColumn("start", F.col("start") - F.col("_k") * pane)
    return placed.groupBy(*keys, "start").agg(F.sum("cnt").alias("cnt"))


def arrival_numbers(df: DataFrame) -> DataFrame:
    """Passthrough of (number, timestamp of arrival)."""
    return df.withColumnRenamed("value", "number")


def processing_time(df: DataFrame, name: str = "timestamp") -> DataFrame:
    """Adds the time of the micro-batch, one constant per batch."""
    return df.withColumn(name, F.current_timestamp())


def embedded_time(df: DataFrame, column: str = "value", schema: str = "number int, timestamp string") -> DataFrame:
    """Fields of a JSON text, its ``timestamp`` text made a timestamp (NULL if it is none)."""
    parsed = df.withColumn("data", F.from_json(column, schema))
    rest = [c for c in df.columns if c != column]
    return parsed.select(*rest, "data.*").withColumn("timestamp", F.try_to_timestamp("timestamp"))


def clicks(df: DataFrame, column: str = "value") -> DataFrame:
    """Click events ``{ts, user_id, page_id}`` parsed from JSON; malformed ones are skipped."""
    parsed = df.select(F.from_json(column, "ts string, user_id long, page_id long").alias("c")).select("c.*")
    return parsed.where("user_id IS NOT NULL AND page_id IS NOT NULL").withColumn("ts", F.try_to_timestamp("ts"))


def scored(df: DataFrame, model: PipelineModel, names: tuple[str, str] = ("ham", "spam")) -> DataFrame:
    """Class name per row by a fitted pipeline; the model's parameters ship with the tasks."""
    label = F.when(F.col("prediction") == 1.0, names[1]).otherwise(names[0])
    return model.transform(df).withColumn("label", label)
