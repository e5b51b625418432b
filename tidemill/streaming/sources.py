"""Streaming readers. Jobs take any streaming DataFrame, so a source can be swapped without touching them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def socket_lines(spark: SparkSession, host: str, port: int, arrival_time: bool = False) -> DataFrame:
    """Lines of a socket as ``value`` (and ``timestamp`` of arrival). For trials: a socket cannot be replayed."""
    reader = spark.readStream.format("socket").option("host", host).option("port", port)
    return reader.option("includeTimestamp", arrival_time).load()


def kafka_messages(spark: SparkSession, servers: str, topics: str, **options: str) -> DataFrame:
    """Message texts of the topics as ``value`` with ``key`` and ``timestamp`` (the connector jar is the user's to add)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics)
    raw = reader.options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"), F.col("key").cast("string").alias("key"), "timestamp")


def file_stream(
    spark: SparkSession, path: str, schema: str, kind: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """New files below ``path`` as a stream; used to replay tables."""
    reader = spark.readStream.format(kind).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    return file_stream(spark, path, "value string", "text", files_per_batch)


def envelope_text(messages: DataFrame, field: str = "content") -> DataFrame:
    """The text field of JSON messages; messages without it are skipped."""
    text = F.get_json_object("value", f"$.{field}")
    return messages.withColumn("value", text).where(F.col("value").isNotNull())
