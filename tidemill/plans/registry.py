"""Name -> (job, equivalent SQL) registry filled by the modules of this package."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from ..sources.tables import Tables

JOBS: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}

MODULES = [
    "basics",
    "joins",
    "aggregates",
    "windows",
    "scalars",
    "reviews",
    "recommend",
    "graphs",
    "geo",
    "experiments",
    "features",
    "learning",
    "streams",
]


def job(name: str, sql: str | None = None):
    """Register a job under ``name``; ``sql`` is its twin, absent where SQL cannot express it."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in JOBS:
            raise ValueError(f"duplicate query name {name}")
        JOBS[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def load_all() -> None:
    for module in MODULES:
        import_module(f"{__package__}.{module}")


def runner(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)
        return fn(Tables(spark, sf_dir))

    return run
