"""Projections, null handling, joins and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_side
from .ordered import exact_quantiles

# --- null handling -----------------------------------------------------------------------------


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the number of NULLs of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that hold any NULL (one pass to find them)."""
    found = null_counts(df).first()
    return df.drop(*[c for c in df.columns if found[c]])


def fill_with_statistic(df: DataFrame, columns: Sequence[str], statistic: str = "mean") -> DataFrame:
    """Fill NULLs by the column's mean, min, max or (interpolated) median over its non-NULL values."""
    if statistic == "median":
        picks = {c: exact_quantiles(df, c, {"m": 0.5}).select("m").scalar() for c in columns}
    else:
        fn = {"mean": F.avg, "min": F.min, "max": F.max}[statistic]
        picks = {c: df.agg(fn(c).alias("m")).scalar() for c in columns}
    return df.withColumns({c: F.coalesce(F.col(c), picks[c]) for c in columns})


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """One row with the most frequent non-NULL value; the smallest wins a tie."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return counts.orderBy(F.desc("count"), column).limit(1).select(column)


def fill_with_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), most_frequent(df, c).scalar()) for c in columns})


def drop_by_key(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Drop the rows whose key is in ``keys``."""
    return df.join(keys.select(on).distinct(), on, "left_anti")


# --- column rewriting --------------------------------------------------------------------------


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def order_columns(df: DataFrame, fitted: Sequence[str]) -> DataFrame:
    """The columns a model was fitted on, in that order; a missing one is an error."""
    return df.select(*fitted)


def in_list(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``column`` occurs in the one-column table ``ids`` (broadcast only if checked small)."""
    wanted = ids.toDF(column).distinct()
    return df.join(small_side(wanted), column, "left_semi")


def top_or_other(df: DataFrame, column: str, top: int, other: str = "other", name: str | None = None) -> DataFrame:
    """Keep the ``top`` most frequent values (ties by value), replace the rest; NULL becomes ``other``."""
    best = top_values(df, column, top).select(F.col(column).alias("_kept"))
    hit = df.join(F.broadcast(best), F.col(column) == F.col("_kept"), "left")  # at most `top` rows
    return hit.withColumn(name or column, F.coalesce("_kept", F.lit(other))).drop("_kept")


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values with their counts; ties by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), column).limit(n)


# --- joins ---------------------------------------------------------------------------------------


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k] == right[k] for k in keys])


def outer_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "full") -> DataFrame:
    """Left, right or full outer equi-join whose hot keys can be split on either side.

    Adaptive execution can split a hot key on the outer-preserved side only (and never for a full
    join), so the join is stated as an inner join, splittable on both sides, plus the unmatched rows of
    each preserved side found against the *distinct* keys of the other.
    """
    keys = [on] if isinstance(on, str) else list(on)
    parts = [left.join(right, keys, "inner")]
    columns = parts[0].columns
    if how in ("left", "full"):
        alone = left.join(right.select(*keys).distinct(), keys, "left_anti")
        parts.append(_pad(alone, right, columns))
    if how in ("right", "full"):
        alone = right.join(left.select(*keys).distinct(), keys, "left_anti")
        parts.append(_pad(alone, left, columns))
    return reduce(DataFrame.unionByName, parts)


def _pad(rows: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    kinds = dict(other.dtypes)
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(kinds[c]).alias(c) for c in columns])


def semi_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    return left.join(right.select(on).distinct(), on, "left_semi")


def join_roles(
    facts: DataFrame, dimension: DataFrame, key: str, roles: dict[str, str], attributes: Sequence[str]
) -> DataFrame:
    """Join one dimension several times: ``roles`` maps a prefix to the fact column holding its key."""
    out = facts
    for prefix, fact_key in roles.items():
        side = dimension.select(
            F.col(key).alias(f"_{prefix}_key"), *[F.col(a).alias(f"{prefix}_{a}") for a in attributes]
        )
        out = out.join(side, F.col(fact_key) == F.col(f"_{prefix}_key")).drop(f"_{prefix}_key")
    return out


def attach_names(aggregated: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Join names after the aggregation, when there is one row per key left."""
    return aggregated.join(names, key)


def cogroup_lists(
    left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str, chunk: int = 10_000
) -> DataFrame:
    """Both sides' sorted value lists per key, in pieces of at most ``chunk`` values.

    Columns ``key, piece, left_values, right_values``; piece p holds values p*chunk+1..(p+1)*chunk of
    each side, so a key with any number of values spans several rows instead of one huge one.
    """
    a = chunked_lists(left, key, left_value, "left_values", chunk)
    b = chunked_lists(right, key, right_value, "right_values", chunk)
    both = outer_join(a, b, [key, "piece"], "full")
    empty = {
        c: F.coalesce(F.col(c), F.array().cast(dict(both.dtypes)[c])) for c in ("left_values", "right_values")
    }
    return both.withColumns(empty)


def chunked_lists(df: DataFrame, key: str, value: str, name: str, chunk: int = 10_000) -> DataFrame:
    """Sorted list of the non-NULL values per key in pieces of at most ``chunk`` values: ``key, piece, name``."""
    from .ordered import row_numbers

    pairs = df.where(F.col(value).isNotNull()).select(key, value)
    numbered = row_numbers(pairs.withColumn("_u", F.monotonically_increasing_id()), [key], [value, "_u"], "_rn")
    piece = F.floor((F.col("_rn") - 1) / chunk).alias("piece")
    return numbered.groupBy(key, piece).agg(F.sort_array(F.collect_list(value)).alias(name))


# --- sets ----------------------------------------------------------------------------------------


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.union(right).distinct()


def intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct common rows. Both sides lose their copies before the shuffle of the semi-join."""
    return left.distinct().intersect(right.distinct())


def subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` not in ``right``."""
    return left.distinct().subtract(right.distinct())
