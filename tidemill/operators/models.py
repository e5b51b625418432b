"""Model jobs: pipelines of ``pyspark.ml`` stages, split by key, compared by quality tables."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import CountVectorizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls
from ..sources.sinks import load_model, save_model
from . import metrics
from .features import encoded_stages, text_stages
from .relational import fill_with_mode
from .sampling import split


def _parts(df: DataFrame, key: str, test: float = 0.2, seed: int = 81) -> tuple[DataFrame, DataFrame]:
    train, held = split(df, key, [1 - test, test], seed)
    return train.persist(), held.persist()


#: Rows to a task, and the least number of tasks, of the rows that a model is fitted on.
TASK_ROWS, TASKS = 10_000, 8


def _gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of ``rows`` rows in as many parts as these are worth: each of the many small jobs of a fit starts a task for every part."""
    return df.coalesce(max(TASKS, -(-rows // TASK_ROWS)))


#: Fits that run side by side where rows are few, and up to how many rows these are.
FITS_AT_ONCE, SMALL_ROWS = 8, 500_000


class _FoldsAtOnce:
    """Put before ``CrossValidator``: the points of all folds are fitted side by side, on rows that are kept already.

    A fit of few rows is a chain of hundreds of jobs that each leave most cores idle; one fold after the other, so do the folds.
    """

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        model, judge, grid = (self.getOrDefault(p) for p in (self.estimator, self.evaluator, self.estimatorParamMaps))
        folds = self._kFold(dataset)

        def value(at: tuple[int, int]) -> float:
            (train, held), point = folds[at[0]], grid[at[1]]
            return judge.evaluate(model.fit(train, point).transform(held))

        tasks = [(fold, point) for point in reversed(range(len(grid))) for fold in range(len(folds))]
        with ThreadPool(min(FITS_AT_ONCE, len(tasks))) as pool:
            found = dict(zip(tasks, pool.map(inheritable_thread_target(dataset.sparkSession)(value), tasks, chunksize=1)))
        values = np.array([[found[fold, point] for point in range(len(grid))] for fold in range(len(folds))])
        means = values.mean(axis=0)
        best = int(np.argmax(means) if judge.isLargerBetter() else np.argmin(means))
        out = CrossValidatorModel(model.fit(dataset, grid[best]), means.tolist(), None, values.std(axis=0).tolist())
        return self._copyValues(out)


def _table(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A small quality table (one row per model)."""
    return df.sparkSession.createDataFrame(rows, schema)


def accuracy(scored: DataFrame, label: str = "label") -> float:
    return float(scored.agg(F.avg((F.col(label) == F.col("prediction")).cast("int"))).first()[0] or 0.0)


def majority_accuracy(train: DataFrame, test: DataFrame, label: str = "label") -> float:
    return accuracy(test.withColumn("prediction", metrics.majority(train, label)), label)


# --- text --------------------------------------------------------------------------------------------


#: Hash buckets of words.
BUCKETS = 200_000


def classify_text(
    df: DataFrame,
    key: str,
    text: str,
    target: str,
    stop_words: Sequence[str] | None,
    ngram: int | None = None,
    buckets: int = BUCKETS,
    smoothing: float = 1.0,
) -> DataFrame:
    """Test accuracy of naive Bayes on hashed TF-IDF and of the majority class, over the same test rows.

    A class that the train part does not have counts as wrong.
    """
    train, test = _parts(df, key)
    index = StringIndexer(inputCol=target, outputCol="label", handleInvalid="keep")
    front = Pipeline(stages=[index, *text_stages(text, stop_words, buckets, ngram)]).fit(train)
    model = NaiveBayes(smoothing=smoothing, modelType="multinomial").fit(front.transform(train))
    scored = model.transform(front.transform(test))
    base = majority_accuracy(train, test, target)
    sizes = int(train.count()), int(test.count())
    rows = [("majority", *sizes, base), ("naive_bayes", *sizes, accuracy(scored))]
    train.unpersist(), test.unpersist()
    return _table(df, rows, "model string, n_train long, n_test long, accuracy double")


def choose_text_model(
    df: DataFrame,
    key: str,
    text: str,
    target: str,
    stop_words: Sequence[str] | None,
    buckets: Sequence[int] = (10_000, 100_000, 200_000),
    smoothing: Sequence[float] = (0.5, 1.0),
    folds: int | None = None,
    parallelism: int = 2,
) -> tuple[PipelineModel, DataFrame, list[str]]:
    """The text classifier whose number of hash buckets and smoothing do best, by one split or by ``folds`` folds.

    Returns the fitted pipeline, a table (buckets, smoothing, accuracy) and the class names in index order.
    Texts are split once, and hashed once for each number of buckets, before the fits, which keep the counts and choose among them.
    """
    names = StringIndexer(inputCol=target, outputCol="label", handleInvalid="keep").fit(df)
    *front, first, weights = text_stages(text, stop_words, buckets[0])
    hashing = {f"tf_{n}": first.copy({first.numFeatures: n, first.outputCol: f"tf_{n}"}) for n in buckets}
    rows = PipelineModel([*front, *hashing.values()]).transform(names.transform(df).select(key, text, "label"))
    rows = rows.select(key, "label", *hashing)
    bayes = NaiveBayes(modelType="multinomial")
    grid = ParamGridBuilder().addGrid(weights.inputCol, list(hashing)).addGrid(bayes.smoothing, list(smoothing)).build()
    judge = MulticlassClassificationEvaluator(metricName="accuracy")
    settings = {"estimator": Pipeline(stages=[weights, bayes]), "estimatorParamMaps": grid, "evaluator": judge, "seed": 7}
    if folds:
        tuned = CrossValidator(numFolds=folds, parallelism=parallelism, **settings).fit(rows)
        found = tuned.avgMetrics
    else:
        tuned = TrainValidationSplit(trainRatio=0.8, parallelism=parallelism, **settings).fit(rows)
        found = tuned.validationMetrics
    table = [(hashing[g[weights.inputCol]].getNumFeatures(), float(g[bayes.smoothing]), float(v)) for g, v in zip(grid, found)]
    best = PipelineModel([*front, hashing[tuned.bestModel.stages[0].getInputCol()], *tuned.bestModel.stages])
    return best, _table(df, table, "buckets int, smoothing double, accuracy double"), list(names.labels)


def label_of(model: PipelineModel, texts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Class names for new documents by a fitted ``classify_text`` pipeline (without its label stage)."""
    names = F.array(*[F.lit(v) for v in labels])
    stages = [s for s in model.stages if not s.__class__.__name__.startswith("StringIndexer")]
    return PipelineModel(stages).transform(texts).withColumn("label", F.get(names, F.col("prediction").cast("int")))


def spam_report(df: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """Accuracy and ROC area of binary-count naive Bayes against the majority class.

    The area ranks by the log odds of class 1: one class's raw prediction is a likelihood that follows text length, and the
    probability is 0 or 1 for all but the shortest texts.
    """
    train, test = _parts(df, key)
    scored = score_spam(train, test, text, label).persist()
    area = metrics.areas(metrics.curve(scored, label, "score")).first()["roc_auc"]
    rows = [("majority", majority_accuracy(train, test, label), 0.5), ("naive_bayes", accuracy(scored, label), area)]
    scored.unpersist(), train.unpersist(), test.unpersist()
    return _table(df, rows, "model string, accuracy double, auc double")


def score_spam(train: DataFrame, test: DataFrame, text: str, label: str, buckets: int = 1 << 14) -> DataFrame:
    """``test`` with ``prediction`` and ``score``, the log odds of class 1 by binary-count naive Bayes."""
    stages = [*text_stages(text, [], buckets, binary=True)[:-1], NaiveBayes(featuresCol="tf", labelCol=label, modelType="bernoulli")]
    scored = Pipeline(stages=stages).fit(train).transform(test)
    raw = vector_to_array("rawPrediction")
    return scored.withColumn("score", raw[1] - raw[0])


def text_model_candidates(label: str) -> dict[str, Estimator]:
    return {
        "naive_bayes": NaiveBayes(featuresCol="tf", labelCol=label),
        "bernoulli_bayes": NaiveBayes(featuresCol="tf", labelCol=label, modelType="bernoulli"),
        "logistic": LogisticRegression(featuresCol="tf", labelCol=label, regParam=0.01, maxIter=20),
    }


def fit_best_text_model(
    df: DataFrame, key: str, text: str, label: str, buckets: int = BUCKETS
) -> tuple[str, PipelineModel, dict[str, float]]:
    """The candidate with the best test accuracy (first on a tie), refitted on all rows."""
    train, test = _parts(df, key)
    front = Pipeline(stages=text_stages(text, [], buckets, binary=True)[:-1]).fit(train)
    a, b = front.transform(train).persist(), front.transform(test).persist()
    found = {name: accuracy(est.fit(a).transform(b), label) for name, est in text_model_candidates(label).items()}
    best = max(found, key=lambda name: found[name])
    refit = Pipeline(stages=[front, text_model_candidates(label)[best]]).fit(df)
    a.unpersist(), b.unpersist()
    return best, refit, found


def compare_text_models(df: DataFrame, key: str, text: str, label: str, buckets: int = BUCKETS) -> DataFrame:
    best, refit, found = fit_best_text_model(df, key, text, label, buckets)
    seen = accuracy(refit.transform(df), label)
    rows = [(name, value, name == best, seen if name == best else None) for name, value in found.items()]
    return _table(df, rows, "model string, accuracy double, chosen boolean, refit_accuracy double")


# --- URLs --------------------------------------------------------------------------------------------


def _url_pipeline(
    df: DataFrame, url: str, label: str, features: Sequence[str], trees: int = 100, depth: int = 5
) -> tuple[Pipeline, DataFrame]:
    """One-hot scheme, numbers, and character counts of host and path, each with its own vocabulary, into a forest."""
    parts = urls.parts(url)
    rows = df.withColumns({f"{p}_chars": F.coalesce(X.characters(parts[p]), F.array().cast("array<string>")) for p in ("netloc", "path")})
    hot = encoded_stages(["scheme"], list(features), out="basic")
    counts = [CountVectorizer(inputCol=f"{p}_chars", outputCol=f"{p}_counts") for p in ("netloc", "path")]
    join = VectorAssembler(inputCols=["basic", "netloc_counts", "path_counts"], outputCol="features")
    forest = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=7)
    return Pipeline(stages=[*hot, *counts, join, forest]), rows


def url_report(df: DataFrame, key: str, url: str, label: str, features: Sequence[str]) -> DataFrame:
    """Accuracy, precision, recall and F1 of the forest on the test part."""
    pipeline, rows = _url_pipeline(df, url, label, features)
    train, test = _parts(rows, key)
    scored = pipeline.fit(train).transform(test)
    return metrics.binary(scored, label, "prediction")


def url_scores(df: DataFrame, key: str, url: str, label: str, features: Sequence[str]) -> DataFrame:
    pipeline, rows = _url_pipeline(df, url, label, features)
    return pipeline.fit(rows).transform(rows).select(key, "prediction")


# --- regression --------------------------------------------------------------------------------------


def elastic_net_report(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    regs: Sequence[float] = (0.01, 1.0),
    nets: Sequence[float] = (0.0, 0.5, 1.0),
    folds: int = 5,
    iterations: int = 100,
) -> DataFrame:
    """One row: chosen parameters, test mae and r2, and the training summary of the best model (by L-BFGS)."""
    join = VectorAssembler(inputCols=list(features), outputCol="features")
    # Only what is fitted is kept: the splits of the folds keep it once more.
    train, test = (join.transform(part).select("features", label).persist() for part in split(df, key, [0.8, 0.2], 81))
    lr = LinearRegression(labelCol=label, maxIter=iterations, solver="l-bfgs")
    grid = ParamGridBuilder().addGrid(lr.regParam, list(regs)).addGrid(lr.elasticNetParam, list(nets)).build()
    cv = CrossValidator(
        estimator=lr, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol=label, metricName="mae"), numFolds=folds, seed=7, parallelism=2
    )
    best = cv.fit(train).bestModel
    quality = metrics.regression(best.transform(test), label, "prediction").first()
    s = best.summary
    row = (
        float(best.getRegParam()), float(best.getElasticNetParam()), [float(c) for c in best.coefficients], float(best.intercept),
        int(s.totalIterations), [float(x) for x in s.objectiveHistory], float(s.meanAbsoluteError), quality["mae"], quality["r2"],
    )
    schema = (
        "reg double, elastic_net double, coefficients array<double>, intercept double, iterations int, "
        "objective array<double>, train_mae double, test_mae double, test_r2 double"
    )
    return _table(df, [row], schema)


def tree_regression_report(
    df: DataFrame,
    key: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str,
    trees: int = 10,
    depths: Sequence[int] = (5, 10),
    rounds: Sequence[int] = (10, 20),
    folds: int = 4,
) -> DataFrame:
    """Test rmse and r2 of the train mean, and of a random forest and boosted trees, both chosen by cross-validation."""
    train, test = _parts(df, key)
    front = Pipeline(stages=encoded_stages(categorical, numeric)).fit(train)
    count = train.count()
    a, b = (_gathered(front.transform(part), n).persist() for part, n in ((train, count), (test, test.count())))
    few = count <= SMALL_ROWS
    forest = RandomForestRegressor(labelCol=label, numTrees=trees, seed=7)
    boosted = GBTRegressor(labelCol=label, maxDepth=3, seed=7, checkpointInterval=10)
    evaluator = RegressionEvaluator(labelCol=label, metricName="rmse")

    def best(model: Estimator, param, values: Sequence[int]):
        grid = ParamGridBuilder().addGrid(param, list(values)).build()
        kinds = (_FoldsAtOnce, CrossValidator) if few else (CrossValidator,)
        validator = type("Validator", kinds, {})
        cv = validator(estimator=model, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, seed=7, parallelism=2)
        return cv.fit(a).bestModel

    asked = [(forest, forest.maxDepth, depths), (boosted, boosted.maxIter, rounds)]
    with ThreadPool(len(asked) if few else 1) as pool:
        chosen = pool.starmap(inheritable_thread_target(df.sparkSession)(best), asked, chunksize=1)
    scored = {
        "mean": b.withColumn("prediction", train.agg(F.avg(label).alias("m")).scalar()),
        "forest": chosen[0].transform(b),
        "boosted": chosen[1].transform(b),
    }
    rows = []
    for name, out in scored.items():
        q = metrics.regression(out, label, "prediction").first()
        rows.append((name, q["rmse"], q["r2"]))
    a.unpersist(), b.unpersist()
    return _table(df, rows, "model string, rmse double, r2 double")


def grid_regression_report(
    df: DataFrame,
    key: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    label: str,
    path: str,
    regs: Sequence[float] = (0.001, 0.01, 0.1, 1.0, 10.0),
    nets: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0),
) -> DataFrame:
    """Validation rmse for each of the points (intercept or not, ``regs``, ``nets``), and the test rmse of the best model
    after saving and loading it."""
    train, test = _parts(df, key)
    lr = LinearRegression(labelCol=label, maxIter=20)
    grid = (
        ParamGridBuilder()
        .addGrid(lr.fitIntercept, [False, True])
        .addGrid(lr.regParam, list(regs))
        .addGrid(lr.elasticNetParam, list(nets))
        .build()
    )
    tuned = TrainValidationSplit(
        estimator=Pipeline(stages=[*encoded_stages(categorical, numeric), lr]),
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=label),
        trainRatio=0.8,
        parallelism=2,
        seed=7,
    ).fit(train)
    save_model(tuned.bestModel, path)
    rmse = RegressionEvaluator(labelCol=label).evaluate(load_model(path).transform(test))
    rows = []
    for params, value in zip(grid, tuned.validationMetrics):
        point = bool(params[lr.fitIntercept]), float(params[lr.regParam]), float(params[lr.elasticNetParam])
        rows.append((*point, float(value), float(rmse)))
    return _table(df, rows, "intercept boolean, reg double, elastic_net double, validation_rmse double, best_test_rmse double")


def vector_regression_grid(df: DataFrame) -> DataFrame:
    """Train-validation split over twelve (regularisation, intercept, elastic net) points."""
    lr = LinearRegression(maxIter=10)
    grid = (
        ParamGridBuilder()
        .addGrid(lr.regParam, [0.1, 0.01])
        .addGrid(lr.fitIntercept, [False, True])
        .addGrid(lr.elasticNetParam, [0.0, 0.5, 1.0])
        .build()
    )
    tuned = TrainValidationSplit(
        estimator=lr, estimatorParamMaps=grid, evaluator=RegressionEvaluator(), trainRatio=0.8, seed=7, parallelism=4
    ).fit(df.persist())
    rows = [
        (float(p[lr.regParam]), bool(p[lr.fitIntercept]), float(p[lr.elasticNetParam]), float(v))
        for p, v in zip(grid, tuned.validationMetrics)
    ]
    return _table(df, rows, "reg double, intercept boolean, elastic_net double, rmse double")


def nested_models_report(df: DataFrame, key: str, small: Sequence[str], large: Sequence[str], label: str) -> DataFrame:
    """Test mse of a linear model on few and on more features, and of a tree."""
    train, test = _parts(df, key)
    rows = []
    for name, cols, est in (
        ("linear_small", small, LinearRegression(labelCol=label)),
        ("linear_large", large, LinearRegression(labelCol=label)),
        ("tree", large, DecisionTreeRegressor(labelCol=label, maxDepth=4)),
    ):
        model = Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="features"), est]).fit(train)
        rows.append((name, metrics.regression(model.transform(test), label, "prediction").first()["mse"]))
    return _table(df, rows, "model string, mse double")


# --- clustering and classification of vectors ------------------------------------------------------------


def kmeans_report(df: DataFrame, k: int) -> DataFrame:
    """Cluster sizes with the training cost of k-means|| on ``id, vec``."""
    rows = df.select("id", array_to_vector("vec").alias("features")).persist()
    model = KMeans(k=k, seed=7, initMode="k-means||").fit(rows)
    sizes = model.transform(rows).groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("cnt"))
    return sizes.withColumn("cost", F.lit(float(model.summary.trainingCost)))


def mixture_report(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    rows = VectorAssembler(inputCols=list(columns), outputCol="features").transform(df).persist()
    model = GaussianMixture(k=k, seed=7, maxIter=20).fit(rows)
    sizes = model.transform(rows).groupBy(F.col("prediction").alias("component")).agg(F.count(F.lit(1)).alias("cnt"))
    return sizes.withColumn("log_likelihood", F.lit(float(model.summary.logLikelihood)))


def compare_vector_models(df: DataFrame, key: str, width: int, classes: int) -> DataFrame:
    """Test accuracy of several classifiers on ``features, label``."""
    train, test = _parts(df, key)
    candidates = {
        "logistic": LogisticRegression(maxIter=30, regParam=0.01),
        "tree": DecisionTreeClassifier(maxDepth=5, impurity="entropy", seed=7),
        "forest": RandomForestClassifier(numTrees=20, maxDepth=5, seed=7),
        "perceptron": MultilayerPerceptronClassifier(layers=[width, 36, classes], maxIter=50, seed=7),
    }
    rows = [("majority", majority_accuracy(train, test))]
    rows += [(name, accuracy(est.fit(train).transform(test))) for name, est in candidates.items()]
    return _table(df, rows, "model string, accuracy double")


def mixed_pipeline_report(
    df: DataFrame, key: str, imputed: str, categorical: Sequence[str], numeric: Sequence[str], label: str
) -> DataFrame:
    """Quality of logistic regression on a mode-imputed category, other categories and numbers."""
    train, test = _parts(fill_with_mode(df, [imputed]), key)
    stages = [*encoded_stages([imputed, *categorical], numeric), LogisticRegression(labelCol=label, maxIter=20)]
    scored = Pipeline(stages=stages).fit(train).transform(test)
    return metrics.binary(scored, label, "prediction")
