"""Samples and splits that repeat exactly under any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import bucket, digest, poisson, uniform


def sample(df: DataFrame, key: str, fraction: float, seed: int, with_replacement: bool = False) -> DataFrame:
    """Bernoulli sample; with replacement, Poisson(``fraction``) copies of the rows."""
    u = uniform(seed, key)
    if not with_replacement:
        return df.where(u < fraction)
    if fraction == 0:
        return df.where(F.lit(False)).withColumn("copy", F.lit(1))
    drawn = poisson(u, fraction)
    # sequence(1, 0) would count down, so rows without copies are dropped first.
    return df.where(drawn > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), drawn)))


def take_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A sample of exactly ``n`` rows (all rows when there are fewer), uniform over unique keys."""
    return df.withColumn("_d", digest(seed, key)).orderBy("_d", key).limit(n).drop("_d")


def split(df: DataFrame, key: str, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Disjoint parts in the given proportions."""
    marked = split_column(df, key, weights, seed)
    return [marked.where(F.col("part") == i).drop("part") for i in range(len(weights))]


def split_column(df: DataFrame, key: str, weights: Sequence[float], seed: int) -> DataFrame:
    """The part number of each row as column ``part``."""
    u, total, edge, part = uniform(seed, key), sum(weights), 0.0, F.lit(0)
    for w in weights[:-1]:
        edge += w / total
        part = part + F.when(u >= edge, 1).otherwise(0)
    return df.withColumn("part", part)


def folds(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """Column ``fold`` in 0..k-1."""
    return df.withColumn("fold", bucket(k, seed, key).cast("int"))


def sample_by(df: DataFrame, column: str, fractions: dict, key: str, seed: int) -> DataFrame:
    """Per-class sampling to rebalance classes; classes not listed are kept whole."""
    share = F.lit(1.0)
    for value, fraction in fractions.items():
        share = F.when(F.col(column) == value, F.lit(float(fraction))).otherwise(share)
    return df.where(uniform(seed, key) < share)
