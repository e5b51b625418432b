"""Model quality from (target, prediction / score) columns, each a single aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import running_totals


def regression(df: DataFrame, target: str, prediction: str) -> DataFrame:
    """mse, rmse, mae and r2 in one row."""
    e = F.col(target) - F.col(prediction)
    spread = F.var_pop(target)
    mse = F.avg(e * e)
    return df.agg(
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (1 - mse / F.nullif(spread, F.lit(0.0))).alias("r2"),
    )


def binary(df: DataFrame, target: str, prediction: str, beta: float = 1.0) -> DataFrame:
    """Accuracy, precision, recall, F1 and F-beta of 0/1 columns; 0 where a denominator is 0."""
    t, p = F.col(target), F.col(prediction)
    counts = df.agg(
        F.count_if((t == 1) & (p == 1)).alias("tp"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    zero = F.lit(0).cast("long")

    def ratio(a, b):
        return F.coalesce(a / F.nullif(b, zero), F.lit(0.0))

    b2 = beta * beta
    fbeta = F.coalesce(((1 + b2) * tp) / F.nullif((1 + b2) * tp + b2 * fn + fp, F.lit(0.0)), F.lit(0.0))
    return counts.select(
        "tp", "fp", "fn", "tn",
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        fbeta.alias("f_beta"),
    )


def curve(df: DataFrame, target: str, score: str) -> DataFrame:
    """One row per distinct score, highest first: counts, running tp and fp, precision, recall, fpr.

    Running totals go over the distinct scores, in range slices, never over single rows.
    """
    per = df.groupBy(score).agg(F.count_if(F.col(target) == 1).alias("pos"), F.count_if(F.col(target) == 0).alias("neg"))
    total = per.agg(F.sum("pos").alias("p")).scalar(), per.agg(F.sum("neg").alias("n")).scalar()
    run = running_totals(per, [], [F.col(score).desc()], {"tp": F.col("pos"), "fp": F.col("neg")})
    return run.select(
        score, "pos", "neg", "tp", "fp",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp"), total[0]).alias("recall"),
        F.try_divide(F.col("fp"), total[1]).alias("fpr"),
    )


def areas(points: DataFrame) -> DataFrame:
    """ROC area (trapezoids, ties at half) and average precision from a ``curve``; NULL where a class is missing."""
    roc = F.try_divide(F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2)), F.sum("pos") * F.sum("neg"))
    ap = F.try_divide(F.sum(F.col("pos") * F.col("precision")), F.sum("pos"))
    return points.agg(roc.alias("roc_auc"), ap.alias("average_precision"))


def majority(train: DataFrame, label: str):
    """Scalar column: the most frequent label (least label on a tie)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.desc("_n"), label).limit(1).select(label).scalar()
