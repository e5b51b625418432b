"""Parquet table access by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """``Tables(spark, dir).orders`` reads ``dir/orders.parquet``; column pruning is left to the scan."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}.parquet"

    def pattern(self, name: str) -> str:
        """Path for a streaming reader, which takes folders and globs but no single file."""
        return f"{self.path(name)}*"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))
