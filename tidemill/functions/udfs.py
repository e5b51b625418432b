"""The function forms a job may use, native expression first."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType


def letter(mark: Column | str, bound: float) -> Column:
    """'F' below the bound, else 'A'. A NULL mark gives 'A', so fill NULLs first."""
    return F.when((F.col(mark) if isinstance(mark, str) else mark) < bound, "F").otherwise("A")


def register_letter(spark: SparkSession, name: str, bound: float) -> None:
    """The same for SQL text; it is inlined by the optimiser, no Python or jar involved."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(mark DOUBLE) RETURNS STRING "
        f"RETURN CASE WHEN mark < {float(bound)} THEN 'F' ELSE 'A' END"
    )


letter_row = F.udf(lambda mark: "F" if mark is None or mark < 5 else "A", StringType(), useArrow=True)
"""Row form of ``letter(…, 5)`` with a NULL guard ('F'), for comparison of the plans."""


@pandas_udf(DoubleType())
def discounted(price: pd.Series, discount: pd.Series) -> pd.Series:
    return price * (1 - discount)


@pandas_udf(DoubleType())
def weighted_mean(value: pd.Series, weight: pd.Series) -> float:
    """Grouped aggregate form; use built-in sums for real work, they combine before the shuffle."""
    total = float(weight.sum())
    return float((value * weight).sum()) / total if total else float("nan")


def scorer(params: dict[str, np.ndarray], predict: Callable[[dict, np.ndarray], np.ndarray], returns: str = "double"):
    """A batch scoring function over feature columns; ``params`` travels once per Python worker."""

    @pandas_udf(returns)
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(predict(params, np.column_stack([c.to_numpy(dtype=float) for c in columns])))

    return score


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """One-to-many partition function over Arrow batches."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(over, schema)


def plan_text(df: DataFrame) -> str:
    """The formatted physical plan, to check which form a function took."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
