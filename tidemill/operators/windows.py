"""Top-N per group, ranking and rolling features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ordered


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "rn") -> DataFrame:
    """Exactly ``n`` rows per group. ``order`` must be total.

    The row-number filter lets every task keep its own best ``n`` per group before the shuffle, so a hot
    group sends at most ``n`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def rank_per_group(df: DataFrame, keys: Sequence[str], value: str, n: int, name: str = "rank") -> DataFrame:
    """Rows with descending rank <= ``n`` of ``value`` per group, ties kept.

    Ranks come from the best ``n`` rows of each group (bounded per task, as above); all rows that tie
    with one of those values are then found by an equi-join on (group, value), whose hot keys split.
    """
    best = top_per_group(df.select(*keys, value), keys, [F.desc(value)], n, "_rn")
    ranks = best.groupBy(*keys, value).agg(F.min("_rn").alias(name))
    return df.join(ranks, [*keys, value])


def top_share(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    return top_per_group(df, keys, order, n).drop("rn")


def secondary_sort(df: DataFrame, keys: Sequence[str], n: int | None = None) -> DataFrame:
    """Rows ordered by the keys within partitions that are contiguous ranges of them.

    Range partitions keep the order of a hot first key while letting it span several tasks.
    """
    placed = df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)
    return placed.sortWithinPartitions(*keys)


rolling_ranges = ordered.rolling_ranges
running_totals = ordered.running_totals
forward_fill = ordered.forward_fill
previous_value = ordered.previous_value
row_numbers = ordered.row_numbers
