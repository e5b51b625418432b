"""Batch readers. Every reader takes an explicit schema; inference is an option because it costs a pass."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StringType, StructField, StructType

REVIEW = "asin string, overall double, reviewText string"


def from_rows(spark: SparkSession, rows: Iterable, schema=None, partitions: int | None = None) -> DataFrame:
    """Small in-memory rows as a table, optionally spread over ``partitions``."""
    df = spark.createDataFrame(list(rows), schema) if schema else spark.createDataFrame(list(rows))
    return df.repartition(partitions) if partitions else df


def from_pandas(spark: SparkSession, frame: pd.DataFrame, schema=None) -> DataFrame:
    return spark.createDataFrame(frame, schema) if schema else spark.createDataFrame(frame)


def from_images(spark: SparkSession, images: Iterable[tuple[int, Sequence[float], str]]) -> DataFrame:
    """(label, pixels, filename) rows with float32 pixels scaled by the caller."""
    schema = StructType(
        [
            StructField("label", IntegerType()),
            StructField("image", ArrayType(FloatType())),
            StructField("filename", StringType()),
        ]
    )
    return spark.createDataFrame([(int(a), [float(p) for p in b], c) for a, b, c in images], schema)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines of a file, a folder or a glob as column ``value``."""
    return spark.read.text(path)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | StructType | None = None,
    header: bool = False,
    sep: str = ",",
    null_value: str | None = "null",
    drop_malformed: bool = True,
) -> DataFrame:
    """CSV with a null token (the empty string is NULL too); rows that do not parse are dropped.

    Without ``schema`` the header names the columns and the types are inferred.
    """
    reader = spark.read.options(header=header, sep=sep, mode="DROPMALFORMED" if drop_malformed else "PERMISSIVE")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def split_records(lines: DataFrame, fields: Sequence[tuple[str, str]], sep: str = ",", null: str = "null") -> DataFrame:
    """Delimited ``value`` lines to typed columns; the null token, '' and uncastable text become NULL."""
    parts = F.split(F.col("value"), sep, -1)
    cols = []
    for i, (name, kind) in enumerate(fields):
        text = F.nullif(F.nullif(F.trim(F.get(parts, F.lit(i))), F.lit(null)), F.lit(""))
        cols.append(text.try_cast(kind).alias(name))
    return lines.select(*cols)


def read_reviews(spark: SparkSession, path: str | list[str], schema: str = REVIEW) -> DataFrame:
    """JSON-lines records; malformed lines are dropped, unknown fields ignored."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED")


def parse_json(lines: DataFrame, schema: str = REVIEW, column: str = "value") -> DataFrame:
    """``column`` parsed to typed columns; lines that are not JSON objects are skipped."""
    parsed = F.from_json(F.col(column), schema)
    whole = F.try_parse_json(F.col(column)).isNotNull()
    return lines.where(whole).select(parsed.alias("_r")).select("_r.*")


def read_labelled_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``label<TAB>text`` lines; quotes are ordinary characters."""
    return spark.read.csv(path, sep="\t", quote="", schema="label string, text string")


def read_libsvm(spark: SparkSession, path: str, features: int | None = None) -> DataFrame:
    reader = spark.read.format("libsvm")
    return (reader.option("numFeatures", features) if features else reader).load(path)


def read_zones(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """GeoJSON MultiPolygon features: the ``properties`` columns and ``rings``, the outer ring of each polygon.

    Holes are ignored. Ring points are (x, y) = (longitude, latitude).
    """
    shape = (
        f"features array<struct<properties: struct<{properties}>, "
        "geometry: struct<coordinates: array<array<array<array<double>>>>>>>"
    )
    feature = spark.read.schema(shape).json(path, multiLine=True).select(F.explode("features").alias("f"))
    outer = F.transform(
        "f.geometry.coordinates",
        lambda polygon: F.transform(
            polygon[0], lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
        ),
    )
    return feature.select("f.properties.*", outer.alias("rings"))


def read_sections(spark: SparkSession, paths: str | list[str], schema: str, section: str = "section") -> DataFrame:
    """Files where a header line ``id:`` starts each section; its id is carried down to the lines below.

    Position is the byte order inside one file, taken from the line's place in its scan task: the
    text source hands a task consecutive lines, and ``(file, block start, id in task)`` sorts them. The
    carry runs over slices of the file, so one huge file is not one task.
    """
    from ..operators.ordered import forward_fill

    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    head = F.nullif(F.regexp_extract("value", r"^\s*(\d+):\s*$", 1), F.lit("")).cast("long")
    marked = lines.withColumn("_head", head)
    filled = forward_fill(marked, ["_file"], ["_block", "_at"], "_head", section)
    rows = filled.where(F.col("_head").isNull() & (F.trim("value") != ""))
    return rows.select(section, F.from_csv("value", F.lit(schema)).alias("_r")).select(section, "_r.*")
