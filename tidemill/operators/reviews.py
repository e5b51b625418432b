"""Review analytics: histograms, parse states and rating intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import secondary_sort


def rating_histogram(df: DataFrame, key: str, rating: str) -> DataFrame:
    """Count per (key, rating), ordered by both within range partitions."""
    counts = df.groupBy(key, rating).agg(F.count(F.lit(1)).alias("cnt"))
    return secondary_sort(counts, [key, rating])


def max_and_count(df: DataFrame, key: str, rating: str) -> DataFrame:
    """Greatest rating and number of ratings per key."""
    return df.groupBy(key).agg(F.max(rating).alias("max_value"), F.count(rating).alias("cnt"))


def parse_states(lines: DataFrame, schema: str, required: list[str], column: str = "value") -> DataFrame:
    """One row of counters: lines that are not JSON, lines missing a required field, good lines."""
    good_json = F.try_parse_json(F.col(column)).isNotNull()
    rec = F.from_json(F.col(column), schema)
    complete = F.lit(True)
    for name in required:
        complete = complete & rec.getField(name).isNotNull()
    return lines.select(good_json.alias("j"), F.coalesce(complete, F.lit(False)).alias("c")).agg(
        F.count_if(~F.col("j")).alias("bad_json"),
        F.count_if(F.col("j") & ~F.col("c")).alias("missing_value"),
        F.count_if(F.col("j") & F.col("c")).alias("correct"),
    )


def rating_interval(rating: Column | str, legacy_labels: bool = False) -> Column:
    """Label of the half-open unit interval a rating falls in: '1' up to 1, '2' for (1, 2], ... '5' above 4.

    ``legacy_labels`` gives (3, 4] the label '3', as an older published counter list did.
    """
    r = F.col(rating) if isinstance(rating, str) else rating
    fourth = "3" if legacy_labels else "4"
    return F.when(r > 4, "5").when(r > 3, fourth).when(r > 2, "3").when(r > 1, "2").otherwise("1")
