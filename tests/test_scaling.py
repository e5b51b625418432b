"""Work that must not grow with settings or faster than the rows."""

import threading
import time

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tidemill.operators import graph as G
from tidemill.operators import models as L
from tidemill.operators import recommend as C
from tidemill.operators.sampling import split
from tidemill.session import cut_lineage
from tidemill.streaming import panes as P
from tidemill.streaming import sinks as K
from tidemill.streaming.sources import file_stream


class _Seen(Exception):
    pass


def test_fits_get_no_more_parts_than_rows_are_worth(spark, monkeypatch):
    """Every job of a fit starts a task for each part, so 200 shuffle partitions of few rows cost minutes."""

    class Cv:
        def __init__(self, **_):
            pass

        def fit(self, df):
            raise _Seen(df.rdd.getNumPartitions(), df.count())

    monkeypatch.setattr(L, "CrossValidator", Cv)
    rows = spark.range(1000).selectExpr("id AS k", "concat('g', id % 3) AS g", "id * 1.0D AS x", "id * 2.0D AS label").repartition(60)
    with pytest.raises(_Seen) as seen:
        L.tree_regression_report(rows, "k", ["g"], ["x"], "label")
    parts, n = seen.value.args
    assert parts == L.TASKS and 700 < n < 900
    many = L._gathered(spark.range(1000).repartition(60), 30 * L.TASK_ROWS)
    assert many.rdd.getNumPartitions() == 30 and many.count() == 1000


def test_points_of_the_factorisation_are_fitted_side_by_side(spark, monkeypatch):
    """A fit of few ratings is a chain of small stages; fits one after the other leave most cores idle."""
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(10) if (u + i) % 4]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double")
    monkeypatch.setattr(C, "FITS_AT_ONCE", 1, raising=False)
    alone = C.als_choose(ratings, [2], [0.1, 1.0], folds=2, iterations=2).collect()
    both = threading.Barrier(2)

    class Waits(ALS):
        def _fit(self, dataset):
            both.wait(60)
            return super()._fit(dataset)

    monkeypatch.setattr(C, "FITS_AT_ONCE", 4, raising=False)
    monkeypatch.setattr(C, "ALS", Waits)
    found = C.als_choose(ratings, [2], [0.1, 1.0], folds=2, iterations=2).collect()
    assert [r[:3] for r in found] == [r[:3] for r in alone] == [(2, 0.1, 90), (2, 1.0, 90)]
    assert [r.rmse for r in found] == pytest.approx([r.rmse for r in alone])


def test_blocks_of_the_factorisation_follow_the_ratings():
    """A task holds the ratings of a block; with ten blocks whatever the input, an executor's memory follows it."""
    few, many = C._als(100, 2, 0.1, 3), C._als(50 * C.BLOCK_RATINGS, 2, 0.1, 3)
    assert (few.getNumUserBlocks(), few.getNumItemBlocks(), few.getCheckpointInterval()) == (10, 10, 10)
    assert (many.getNumUserBlocks(), many.getNumItemBlocks(), many.getCheckpointInterval()) == (50, 50, 1)


def test_folds_are_fitted_side_by_side(spark):
    """All four fits are under way at once; values and choice are those of the folds one after the other."""
    all_of_them, waiting = threading.Barrier(4), []

    class Waits(LinearRegression):
        def _fit(self, dataset):
            if len(waiting) < 4:
                waiting.append(1)
                all_of_them.wait(60)
            return super()._fit(dataset)

    rows = spark.range(200).selectExpr("id * 1.0D AS x", "id * 2.0D + id % 7 AS label").coalesce(2)
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows).persist()
    grid = ParamGridBuilder().addGrid(LinearRegression.regParam, [0.1, 1000.0]).build()

    def fitted(kind, model):
        points = [{model.regParam: v for v in point.values()} for point in grid]
        return kind(estimator=model, estimatorParamMaps=points, evaluator=RegressionEvaluator(), numFolds=2, seed=7).fit(rows)

    plain, together = fitted(CrossValidator, LinearRegression()), fitted(type("Validator", (L._FoldsAtOnce, CrossValidator), {}), Waits())
    assert together.avgMetrics == pytest.approx(plain.avgMetrics) and together.bestModel.getRegParam() == plain.bestModel.getRegParam() == 0.1
    rows.unpersist()


@pytest.mark.parametrize(("light", "at_once"), [(9, 30), (256, 500)])
def test_pairs_and_predictions_by_slices(spark, light, at_once):
    """Slices together are the whole result, whether or not there are users that go through blocks."""
    rows = [(None if u == 3 else u, None if i == 4 else i, float(1 + (u * i) % 5)) for u in range(30) for i in range(20) if (u * 7 + i * 3) % 5 and (u % 3 or i < 9)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double")
    as_set = lambda df: sorted(map(tuple, df.collect()), key=str)
    whole = C.item_similarity(ratings, digits=8, light=light)
    slices = C.similarity_slices(ratings, digits=8, light=light, at_once=at_once)
    assert len(slices) > 3 and sorted(r for s in slices for r in as_set(s)) == sorted(as_set(whole))
    sims = C.truncate(whole, 4)
    assert as_set(C.similar_items(ratings, 4, digits=8, light=light, at_once=at_once)) == as_set(sims)
    known = ratings.where("user is not null and item is not null")
    train, test = split(known.withColumn("k", F.concat_ws(":", "user", "item")), "k", [0.8, 0.2], 1)
    train, test = train.drop("k"), test.drop("k")
    one, many = C.predict(train, sims), C.predict_slices(train, sims, at_once=500)
    assert len(many) > 3
    best = lambda df: C.recommend(df, 3)
    assert as_set(C.each_slice(many, best)) == as_set(best(one))
    a, b = C.rmse(many, test).first(), C.rmse(one, test).first()
    assert a.pairs == b.pairs > 0 and a.rmse == pytest.approx(b.rmse)
    assert tuple(C.rmse(one.limit(0), test).first()) == (0, None)
    gap = spark.createDataFrame([(1, 1, 2.0), (1, 2, None)], "user long, item long, rating double")
    assert tuple(C.rmse([gap.selectExpr("user", "item", "3.0D AS prediction")], gap).first()) == (2, 1.0)


def test_a_written_stage_leaves_no_shuffles(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    before = blocks.getAllBlocks().size()
    out = cut_lineage(spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).count())
    end = time.time() + 20  # files go beside the driver
    while blocks.getAllBlocks().size() > before and time.time() < end:
        time.sleep(0.2)
    assert blocks.getAllBlocks().size() <= before and out.count() == 10


def test_edges_are_written_before_their_ends_are_looked_up(spark, monkeypatch):
    """The shuffles of the counts, of either end and of the flow are on disk one after the other, not all at once."""
    written = []

    def cut(df):
        written.append(df.columns)
        return cut_lineage(df)

    monkeypatch.setattr(G, "cut_lineage", cut)
    v = spark.createDataFrame([(i,) for i in "abc"], "id string")
    e = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "c"), ("b", "x"), (None, "a")], "src string, dst string")
    ranks = {r.id: r.pagerank for r in G.pagerank(v, e, steps=2, normalize=False).collect()}
    assert [sorted(c) for c in written] == [["id"], ["dst", "src", "w"], ["dst", "src", "w"], ["dst", "p", "src"]]
    assert ranks == {"a": pytest.approx(0.1), "b": pytest.approx(0.1 + 0.9 * 0.1 * 2 / 3), "c": pytest.approx(0.1 + 0.9 * 0.1 / 3)}


def test_state_partitions_follow_rows(spark, monkeypatch):
    """Each state partition opens a store and a worker in every batch, however few rows there are."""
    monkeypatch.setattr(P, "shuffle_width", lambda _: 200)
    assert P.state_parts(spark, 0) == P.state_parts(spark, 100_000) == P.STATE_PARTS
    assert P.state_parts(spark, 20 * P.STATE_ROWS) == 20 and P.state_parts(spark, 10**12) == 200
    before = spark.conf.get(P.WIDTH)
    with P.keyed_state(spark, 3):
        assert spark.conf.get(P.WIDTH) == "3"
    assert spark.conf.get(P.WIDTH) == before


def test_panes_of_many_keys_share_a_state(spark, tmp_path, monkeypatch):
    """Keys come back as they were, nulls and long numbers too, and no more states are kept than there are buckets."""
    monkeypatch.setattr(P, "BUCKETS", 2)
    big = 2**60 + 1
    rows = [(k, n, 1000 + 20 * i) for i in range(6) for k, n in ((big, "a"), (big + 1, "a"), (None, ""), (None, None))]
    rows += [(u if u % 7 else None, None, 1000 + u * 37 % 1000) for u in range(200)]  # nulls among many keys and panes
    source = spark.createDataFrame([*rows, (7, "end", 100_000)], "user long, name string, at long")
    source.select("user", "name", F.timestamp_seconds("at").alias("ts")).write.parquet(str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), "user long, name string, ts timestamp")
    with P.keyed_state(spark, 2):
        counts = P.pane_counts(stream, "ts", ["user", "name"], 60, 120, "15 seconds")
        query = K.run_now(counts, "append", path=str(tmp_path / "out"), checkpoint=str(tmp_path / "ckpt"))
    states = [s.get("numRowsTotal", 0) for p in query.recentProgress for s in p.get("stateOperators", [])]
    assert max(states) <= 4  # a value and a timer for each of two buckets
    got = {(r.user, r.name, r.end_ms): r.cnt for r in P.summed(spark.read.parquet(str(tmp_path / "out")), ["user", "name"]).collect()}
    want = {}
    for user, name, at in rows:
        for end in ((at // 60 + 1) * 60, (at // 60 + 2) * 60):
            want[user, name, end * 1000] = want.get((user, name, end * 1000), 0) + 1
    assert got == want


def test_edges_are_cut_by_the_end_predicates_before_they_are_counted(spark, monkeypatch):
    """Counting takes memory for every distinct edge; only edges from the starts and to the ends are needed."""
    v = spark.createDataFrame([(x,) for x in "abcdez"], "id string")
    e = spark.createDataFrame([*[tuple(p) for p in ("ab", "ab", "bc", "db", "be", "be", "ax", "xc", "cd", "ez")], ("a", None), (None, "c")], "src string, dst string")
    counted, weighted = [], G.weighted
    monkeypatch.setattr(G, "weighted", lambda vertices, edges: counted.append(edges.count()) or weighted(vertices, edges))
    rows = {(r.a, r.b, r.c): r.cnt for r in G.two_hops(v, e, "id = 'a'", "id = 'e'").collect()}
    assert rows == {("a", "b", "e"): 4} and counted == [4, 2]


def test_baskets_are_made_once(spark):
    """The counts and the fit read the baskets some ten times; what they are made of is worked out once."""
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = [(u, i) for u in range(20) for i in "abc" if u % 4 or i != "c"] + [(3, "a"), (None, "a"), (5, None)]
    rows = spark.createDataFrame(rows, "user long, item string")
    baskets = rows.mapInPandas(watched, rows.schema)
    rules = C.association_rules(baskets, 0.2, 0.3).collect()
    assert seen.value == rows.count()
    assert {(tuple(sorted(r.antecedent)), *r.consequent): round(r.confidence, 3) for r in rules}[("a", "b"), "c"] == 0.75
    assert C.pair_rules(baskets, 0.2, 0.3).count() and seen.value == 2 * rows.count()


@pytest.mark.parametrize("folds", [None, 2])
def test_texts_are_hashed_before_the_grid(spark, monkeypatch, folds):
    """The fits get counts, not texts, and the points, the model and its labels are those of whole pipelines."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit

    words = ["red", "green", "blue", "one", "two", "three"]
    rows = [(i, " ".join(words[(i * k + i // 3) % 6] for k in range(1, 6)), "ab"[(i * i + i // 5) % 2]) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, text string, lang string").coalesce(2)
    given = []
    kind = CrossValidator if folds else TrainValidationSplit
    fit = kind.fit
    monkeypatch.setattr(kind, "fit", lambda self, data, *a: given.append(data.columns) or fit(self, data, *a))
    model, table, names = L.choose_text_model(df, "id", "text", "lang", [], [4, 32], [0.5, 1.0], folds)
    assert set(given[0]) == {"id", "label", "tf_4", "tf_32"}

    stages, bayes = L.text_stages("text", [], 4), NaiveBayes(modelType="multinomial")
    grid = ParamGridBuilder().addGrid(stages[-2].numFeatures, [4, 32]).addGrid(bayes.smoothing, [0.5, 1.0]).build()
    plain = {"estimator": Pipeline(stages=[*stages, bayes]), "estimatorParamMaps": grid, "seed": 7}
    plain["evaluator"] = MulticlassClassificationEvaluator(metricName="accuracy")
    index = StringIndexer(inputCol="lang", outputCol="label", handleInvalid="keep").fit(df)
    tuned = (CrossValidator(numFolds=folds, **plain) if folds else TrainValidationSplit(trainRatio=0.8, **plain)).fit(
        index.transform(df).select("id", "text", "label")
    )
    want = [(p[stages[-2].numFeatures], p[bayes.smoothing], v) for p, v in zip(grid, tuned.avgMetrics if folds else tuned.validationMetrics)]
    assert sorted(tuple(r) for r in table.collect()) == sorted(want) and names == index.labels
    labels = [{r.id: r.label for r in L.label_of(m, df.drop("lang"), names).collect()} for m in (model, tuned.bestModel)]
    assert labels[0] == labels[1]


def test_folds_keep_only_what_is_fitted(spark, monkeypatch):
    """Keys and single features are kept by the split and again by each fold if they are passed on."""

    class Cv:
        def __init__(self, **_):
            pass

        def fit(self, df):
            raise _Seen(df.columns, df.count())

    monkeypatch.setattr(L, "CrossValidator", Cv)
    rows = spark.range(1000).selectExpr("concat('k', id) AS k", "id * 1.0D AS x", "id % 7 * 1.0D AS y", "id * 2.0D AS label")
    with pytest.raises(_Seen) as seen:
        L.elastic_net_report(rows, "k", ["x", "y"], "label")
    columns, n = seen.value.args
    assert columns == ["features", "label"] and 700 < n < 900


def test_pairs_of_words_are_dealt_by_the_number_of_texts(spark, monkeypatch):
    """Query ``ngrams`` counts in as many tasks as its texts ask for, and the session's own number of partitions comes back."""
    from collections import Counter

    from tidemill.functions import text as X
    from tidemill.plans import registry
    from tidemill.session import shuffle_width

    registry.load_all()
    texts = ["a b a b", "", None, "One one", *[f"a b {chr(97 + i)}x" for i in range(20)]]
    docs = spark.createDataFrame([(i % 7 or None, text) for i, text in enumerate(texts)], "doc_id long, text string")
    before, seen, written = shuffle_width(spark), [], X.cut_lineage
    monkeypatch.setattr(X, "TASK_TEXTS", 2)
    monkeypatch.setattr(X, "cut_lineage", lambda df: seen.append(shuffle_width(spark)) or written(df))
    got = registry.JOBS["ngrams"](type("T", (), {"documents": docs})())
    words = [(text or "").lower().split() for text in texts]
    assert Counter({r.gram: r.cnt for r in got.collect()}) == Counter(" ".join(p) for w in words for p in zip(w, w[1:]))
    assert seen == [12] and shuffle_width(spark) == before
