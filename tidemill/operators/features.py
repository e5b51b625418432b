"""Feature transforms, stated as expressions or as ``pyspark.ml`` stages."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    HashingTF,
    NGram,
    OneHotEncoder,
    PolynomialExpansion,
    RegexTokenizer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WORD_PATTERN
from ..session import cut_lineage, shuffle_width, small_side
from .ordered import row_numbers

# --- text ----------------------------------------------------------------------------------------


def text_stages(
    text: str, stop_words: Sequence[str] | None = None, size: int = 1 << 16, ngram: int | None = None, binary: bool = False
) -> list:
    """Tokenise, drop stop words, optionally form n-grams, hash to counts and weigh by IDF -> ``features``."""
    stages = [RegexTokenizer(inputCol=text, outputCol="tokens", gaps=False, pattern=WORD_PATTERN)]
    remover = StopWordsRemover(inputCol="tokens", outputCol="words")
    stages.append(remover.setStopWords(list(stop_words)) if stop_words is not None else remover)
    last = "words"
    if ngram:
        stages.append(NGram(n=ngram, inputCol="words", outputCol="grams"))
        last = "grams"
    stages.append(HashingTF(inputCol=last, outputCol="tf", numFeatures=size, binary=binary))
    stages.append(IDF(inputCol="tf", outputCol="features"))
    return stages


def character_stages(text_array: str, out: str, min_df: float = 1.0, binary: bool = False) -> CountVectorizer:
    """Counts (or presence) over the vocabulary of an array column."""
    return CountVectorizer(inputCol=text_array, outputCol=out, minDF=min_df, binary=binary)


def tf_idf(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """Exact-vocabulary weights: count of the word in the row times ln((rows + 1) / (rows with it + 1)).

    Rows are dealt by key before they are split, so their words are counted where they are; a text is less to send than its words.
    """
    dealt = df.repartition(shuffle_width(df.sparkSession), key)
    tf = dealt.select(key, F.explode(tokens).alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("tf"))
    seen = small_side(cut_lineage(tf.groupBy("word").agg(F.count(F.lit(1)).alias("df"))))
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    weight = F.col("tf") * F.ln((rows + 1) / (F.col("df") + 1))
    return tf.join(seen, "word").select(key, "word", "tf", weight.alias("tfidf"))


# --- categories ----------------------------------------------------------------------------------


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """Value -> index by falling frequency, ties by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    numbered = row_numbers(counts, [], [F.desc("cnt"), F.asc(column)], "_rn")
    return numbered.select(column, "cnt", (F.col("_rn") - 1).alias("idx"))


def alphabetic_index(df: DataFrame, column: str) -> DataFrame:
    """Value -> index in sorted order."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return row_numbers(values, [], [column], "_rn").select(column, (F.col("_rn") - 1).alias("idx"))


def ordinal(column: str, codes: dict) -> Column:
    """Fixed codes by value; others NULL."""
    parts = [F.lit(x) for pair in codes.items() for x in pair]
    return F.try_element_at(F.create_map(*parts), F.col(column))


def dummies(df: DataFrame, column: str, values: Sequence, drop_first: bool = False) -> DataFrame:
    """One 0/1 column per listed value, named ``column_value``."""
    used = list(values)[1:] if drop_first else list(values)
    return df.withColumns({f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("int") for v in used})


def encoded_stages(categorical: Sequence[str], numeric: Sequence[str], out: str = "features", drop_last: bool = True) -> list:
    """Index and one-hot the categories (unknown values get their own slot), then assemble with the numbers."""
    index = StringIndexer(
        inputCols=list(categorical), outputCols=[f"{c}_ix" for c in categorical], handleInvalid="keep"
    )
    hot = OneHotEncoder(
        inputCols=[f"{c}_ix" for c in categorical], outputCols=[f"{c}_hot" for c in categorical], dropLast=drop_last
    )
    join = VectorAssembler(inputCols=[f"{c}_hot" for c in categorical] + list(numeric), outputCol=out)
    return [index, hot, join]


# --- numbers -------------------------------------------------------------------------------------


def standardize(df: DataFrame, columns: Sequence[str], ddof: int = 1) -> DataFrame:
    """(x - mean) / std per column; ``ddof=0`` uses the population deviation. Constant columns become 0."""
    spread = F.stddev_samp if ddof else F.stddev_pop
    out = {}
    for c in columns:
        mean, std = df.agg(F.avg(c).alias("m")).scalar(), df.agg(spread(c).alias("s")).scalar()
        out[c] = F.when(std == 0, F.lit(0.0)).otherwise((F.col(c) - mean) / F.nullif(std, F.lit(0.0)))
    return df.withColumns(out)


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min) per column. Constant columns become 0.5."""
    out = {}
    for c in columns:
        low, high = df.agg(F.min(c).alias("a")).scalar(), df.agg(F.max(c).alias("b")).scalar()
        out[c] = F.when(low == high, F.lit(0.5)).otherwise((F.col(c) - low) / F.nullif(high - low, F.lit(0.0)))
    return df.withColumns(out)


def scaler_stage(column: str, out: str) -> StandardScaler:
    return StandardScaler(inputCol=column, outputCol=out, withMean=True, withStd=True)


def polynomial(df: DataFrame, columns: Sequence[str], degree: int, out: str = "poly") -> DataFrame:
    """All powers and cross terms up to ``degree`` as an array column (no constant term)."""
    from pyspark.ml.functions import vector_to_array

    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="_v"),
        PolynomialExpansion(degree=degree, inputCol="_v", outputCol="_p"),
    ]
    done = Pipeline(stages=stages).fit(df).transform(df)
    return done.withColumn(out, vector_to_array("_p")).drop("_v", "_p")


def powers(column: str, degree: int) -> dict[str, Column]:
    """x, x^2, ... as columns ``column_1``, ``column_2``, ..."""
    return {f"{column}_{i}": F.pow(F.col(column), F.lit(float(i))) for i in range(1, degree + 1)}


# --- sums of products and closed-form fits ---------------------------------------------------------


def gram(df: DataFrame, features: Sequence[str], target: str, by: str | None = None) -> dict:
    """Sums of products of (1, features..., target) per ``by`` value: (p + 2)^2 numbers, one pass.

    Rows with a NULL in any used column are skipped.
    """
    names = [F.lit(1.0), *[F.col(c).cast("double") for c in [*features, target]]]
    n = len(names)
    sums = [F.sum(names[i] * names[j]).alias(f"s{i}_{j}") for i in range(n) for j in range(i, n)]
    rows = df.na.drop(subset=[*features, target])
    grouped = rows.groupBy(by).agg(*sums) if by else rows.agg(*sums).withColumn("_all", F.lit(0))
    out = {}
    for r in grouped.collect():  # one row per fold, (p + 2)^2 numbers each
        m = np.zeros((n, n))
        for i in range(n):
            for j in range(i, n):
                m[i, j] = m[j, i] = r[f"s{i}_{j}"]
        out[r[by or "_all"]] = m
    return out


def least_squares(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Ordinary least squares by the normal equation: one row per coefficient."""
    m = gram(df, features, target)[0]
    beta = np.linalg.pinv(m[:-1, :-1]) @ m[:-1, -1]
    rows = [(name, float(b)) for name, b in zip(["intercept", *features], beta)]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double")


def ridge_grid(df: DataFrame, features: Sequence[str], target: str, strengths: Sequence[float], folds: int, key: str, seed: int) -> DataFrame:
    """Cross-validated error of ridge regression per strength.

    The data is read once: each fold's sums of products are enough to fit and to score every point of the
    grid, so no task ever needs a whole fold's rows.
    """
    from .sampling import folds as add_folds

    parts = gram(add_folds(df, key, folds, seed), features, target, "fold")
    total = sum(parts.values())
    rows = []
    for strength in strengths:
        errors, n = 0.0, 0.0
        for held in parts.values():
            train = total - held
            penalty = np.eye(len(features) + 1) * strength
            penalty[0, 0] = 0.0
            beta = np.linalg.solve(train[:-1, :-1] + penalty, train[:-1, -1])
            full = np.append(beta, -1.0)
            errors += float(full @ held @ full)
            n += held[0, 0]
        rows.append((float(strength), float(np.sqrt(errors / n))))
    return df.sparkSession.createDataFrame(rows, "strength double, rmse double")


def descend(
    df: DataFrame, features: Sequence[str], target: str, rate: float, steps: int, loss: str = "linear"
) -> DataFrame:
    """Batch gradient descent from zero weights for the mean squared or the logistic loss.

    Each step is one aggregation over the cached rows; only the weights travel.
    """
    rows = df.select(*[F.col(c).cast("double") for c in [*features, target]]).na.drop().persist()
    weights = [0.0] * (len(features) + 1)
    try:
        for _ in range(steps):
            score = sum((F.col(c) * F.lit(w) for c, w in zip(features, weights[1:])), F.lit(weights[0]))
            guess = score if loss == "linear" else 1 / (1 + F.exp(-score))
            err = guess - F.col(target)
            step = rows.agg(F.avg(err).alias("g0"), *[F.avg(err * F.col(c)).alias(f"g{i}") for i, c in enumerate(features, 1)])
            g = step.first()
            weights = [w - rate * g[f"g{i}"] for i, w in enumerate(weights)]
    finally:
        rows.unpersist()
    named = [(name, float(w)) for name, w in zip(["intercept", *features], weights)]
    return df.sparkSession.createDataFrame(named, "term string, weight double")


def information_gain(df: DataFrame, split: str, label: str) -> DataFrame:
    """Entropy of the label, entropy after the split, and their difference (bits)."""
    cells = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    total = cells.agg(F.sum("n").alias("n")).scalar()
    by_label = cells.groupBy(label).agg(F.sum("n").alias("n"))
    p = F.col("n") / total
    before = by_label.agg((-F.sum(p * F.log2(p))).alias("h")).scalar()
    parts = cells.groupBy(split).agg(F.sum("n").alias("part"))
    q = F.col("n") / F.col("part")
    after = cells.join(parts, split).agg((-F.sum(F.col("n") / total * F.log2(q))).alias("after"))
    return after.select(before.alias("entropy"), F.col("after"), (before - F.col("after")).alias("gain"))
