"""Writers and read-back."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_pairs(df: DataFrame, path: str, *columns: str, files: int | None = None, sep: str = "\t") -> None:
    """Text lines of the columns joined by ``sep``, in as many files as the result has parts.

    ``files=1`` gives one file for a small report; only the finished lines are gathered for it."""
    line = df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value"))
    (line.repartition(files) if files else line).write.mode("overwrite").text(path)


def write_csv(
    df: DataFrame, path: str, header: bool = True, null_value: str | None = None, files: int | None = None
) -> None:
    writer = (df.repartition(files) if files else df).write.mode("overwrite").option("header", header)
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def report(df: DataFrame, rows: int):
    """At most ``rows`` rows as a pandas frame for display; larger results belong in a sink."""
    return df.limit(rows).toPandas()


def read_back(spark: SparkSession, path: str, schema, **options) -> DataFrame:
    """A written folder (or its ``part*`` files) read as CSV with the schema it was written with."""
    return spark.read.schema(schema).options(**options).csv(path)
