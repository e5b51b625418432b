"""Grouped and global aggregation. Everything combines partially before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import exact_quantiles
from .relational import chunked_lists


def group_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """min, max, avg (NULLs skipped) and row count per group."""
    return df.groupBy(*keys).agg(
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("avg_value"),
        F.count(F.lit(1)).alias("cnt"),
    )


def sum_and_count(df: DataFrame, key: str, value: str) -> DataFrame:
    """The mergeable (sum, count) pair per key behind an average."""
    return df.groupBy(key).agg(F.sum(value).alias("total"), F.count(value).alias("cnt"))


def average_by_key(df: DataFrame, key: str, value: str, min_count: int = 0) -> DataFrame:
    """Average and count per key, keeping keys with more than ``min_count`` values. NULLs are skipped."""
    out = df.groupBy(key).agg(F.avg(value).alias("avg_value"), F.count(value).alias("cnt"))
    return out.where(F.col("cnt") > min_count)


def share_of_total(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count per group and its share of all rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    total = counts.agg(F.sum("cnt").alias("n")).scalar()
    return counts.withColumn("share", F.col("cnt") / total)


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values per column, exact by default."""
    fn = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[fn(c).alias(c) for c in columns])


def sorted_lists(df: DataFrame, key: str, value: str, chunk: int = 10_000, sep: str = ", ", zero: str = "") -> DataFrame:
    """Sorted values per key joined to text, ``zero`` put before the first piece once per key.

    A key with more than ``chunk`` values yields several pieces (see ``chunked_lists``).
    """
    lists = chunked_lists(df, key, value, "items", chunk)
    text = F.array_join(F.col("items").cast("array<string>"), sep)
    start = F.when(F.col("piece") == 0, F.lit(zero)).otherwise(F.lit(""))
    return lists.select(key, "piece", F.size("items").alias("cnt"), F.concat(start, text).alias("items"))


def first_by(df: DataFrame, key: str, order: str, columns: Sequence[str], counted: str) -> DataFrame:
    """The columns of the row with the least ``order`` per key, and the count of ``counted``."""
    first = F.min_by(F.struct(*columns), order)
    out = df.groupBy(key).agg(first.alias("_f"), F.count(counted).alias("cnt"))
    return out.select(key, "_f.*", "cnt")


def describe_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev (sample), min, max per column in one pass, one row per column."""
    stats = {"cnt": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    one = df.agg(*[fn(c).cast("double").alias(f"{c}__{s}") for c in columns for s, fn in stats.items()])
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{s}").alias(s) for s in stats]) for c in columns
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def histogram(df: DataFrame, value: Column | str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal bins from min to max; the last bin is closed. Empty bins are absent."""
    v = F.col(value) if isinstance(value, str) else value
    rows = df.select(v.alias("_v")).where(F.col("_v").isNotNull())
    low = rows.agg(F.min("_v").alias("m")).scalar()
    width = rows.agg(((F.max("_v") - F.min("_v")) / bins).alias("w")).scalar()
    place = F.when(width == 0, F.lit(0)).otherwise(F.floor((F.col("_v") - low) / F.nullif(width, F.lit(0.0))))
    return (
        rows.select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair in one pass, long form (a, b, corr)."""
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def confusion(df: DataFrame, target: str, prediction: str) -> DataFrame:
    """Count per (target, prediction) and its share within the target (one row per class pair)."""
    counts = df.groupBy(target, prediction).agg(F.count(F.lit(1)).alias("cnt"))
    totals = counts.groupBy(target).agg(F.sum("cnt").alias("_n"))
    return counts.join(totals, target).select(target, prediction, "cnt", (F.col("cnt") / F.col("_n")).alias("share"))


def cross_counts(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """One row per ``row`` value, one count column per listed ``column`` value (0 where absent)."""
    return df.groupBy(row).pivot(column, list(values)).count().na.fill(0)


def rows_per_partition(df: DataFrame) -> DataFrame:
    """Rows held by each partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("cnt"))


def rowwise(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Row statistics across columns: mean, median, min, max, population std (no NULLs expected)."""
    values = F.sort_array(F.array(*[F.col(c).cast("double") for c in columns]))
    n = len(columns)
    mean = sum((F.col(c) for c in columns), F.lit(0.0)) / n
    middle = (F.get(values, F.lit((n - 1) // 2)) + F.get(values, F.lit(n // 2))) / 2
    var = sum(((F.col(c) - mean) * (F.col(c) - mean) for c in columns), F.lit(0.0)) / n
    return {
        "row_mean": mean,
        "row_median": middle,
        "row_min": F.array_min(values),
        "row_max": F.array_max(values),
        "row_std": F.sqrt(var),
    }


def value_parts(df: DataFrame, column: str, sep: str, name: str) -> DataFrame:
    """One row per part of a multi-valued text field."""
    return df.withColumn(name, F.explode(F.split(column, sep)))


DAY_PARTS = ("night", "morning", "afternoon", "evening")  # hours 00-05, 06-11, 12-17, 18-23


def day_part(ts: Column | str) -> Column:
    """Six-hour part of the day."""
    return F.get(F.array(*[F.lit(p) for p in DAY_PARTS]), F.floor(F.hour(ts) / 6).cast("int"))


def mean_per_day(df: DataFrame, ts: str) -> DataFrame:
    """Mean events per calendar day: overall, per day part, and per day part on Wednesdays and Sundays.

    Days without events count as zero: the divisor is the number of such days in the calendar
    between the first and the last event, not the number of days seen.
    """
    counts = df.groupBy(F.to_date(ts).alias("day"), day_part(ts).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    span = counts.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    calendar = span.select(F.explode(F.sequence("lo", "hi")).alias("day")).withColumn("dow", F.weekday("day"))
    days = calendar.agg(F.count(F.lit(1)).alias("d")).scalar()
    overall = counts.agg(F.sum("n").alias("n")).select(
        F.lit("all").alias("weekday"), F.lit("all").alias("part"), (F.col("n") / days).alias("mean_cnt")
    )
    parts = counts.groupBy("part").agg(F.sum("n").alias("n")).select(
        F.lit("all").alias("weekday"), "part", (F.col("n") / days).alias("mean_cnt")
    )
    out = overall.unionByName(parts)
    for number, label in ((2, "Wed"), (6, "Sun")):
        such = calendar.where(F.col("dow") == number).agg(F.count(F.lit(1)).alias("d")).scalar()
        some = counts.where(F.weekday("day") == number).groupBy("part").agg(F.sum("n").alias("n"))
        out = out.unionByName(some.select(F.lit(label).alias("weekday"), "part", (F.col("n") / such).alias("mean_cnt")))
    return out


def quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), interpolate: bool = True):
    return exact_quantiles(df, value, probs, by, interpolate)


def quick_quantiles(df: DataFrame, value: str, probs: Sequence[float], error: float = 0.0) -> list[float]:
    """Quantiles that are elements of the data, by the built-in sketch; ``error=0`` is exact."""
    return df.approxQuantile(value, list(probs), error)
