"""Degenerate input gives NULL or nothing, never an error; ids of any size; jobs run from any folder."""

import math
import os
import subprocess
import sys
import textwrap

import pytest

from tidemill.operators import metrics as Q
from tidemill.operators import models as L
from tidemill.operators import recommend as C
from tidemill.operators import sampling as S
from tidemill.operators import stats as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_item_rated_zero(spark):
    rows = [(1, 1, 0.0), (2, 1, 0.0), (1, 2, 3.0), (2, 2, 4.0), (1, 3, 1.0)]
    df = spark.createDataFrame(rows, "user int, item int, rating double")
    got = {(r.p1, r.p2): r.sim for r in C.item_similarity(df).collect()}
    assert set(got) == {(2, 3)} and got[2, 3] == pytest.approx(3 / 5)


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double")
    row = Q.areas(Q.curve(df, "y", "s")).first()
    assert row.roc_auc is None and row.average_precision == 1.0
    assert {r.fpr for r in Q.curve(df, "y", "s").collect()} == {None}


def test_constant_and_empty_columns(spark):
    flat = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 2.0), ("b", 2.0)], "g string, v double")
    assert E.one_sample_stats(flat, "v", 1.0).first().t is None
    assert E.t_test(E.two_sample_stats(flat, "g", "v", "a", "b")).first().p_value is None
    assert E.z_outliers(flat, "v").count() == 0
    assert E.threshold_counts(flat.limit(0), "v").first().share_at_max is None
    one = E.mean_interval(flat.limit(1), "v").first()
    assert (one.n, one.mean, one.low, one.high) == (1, 2.0, None, None)


def test_resample_of_any_size(spark):
    df = spark.range(4000)
    for fraction in (0.25, 1.0, 2.5):
        n = S.sample(df, "id", fraction, 3, with_replacement=True).count()
        assert abs(n - 4000 * fraction) < 5 * math.sqrt(4000 * fraction)
    assert S.sample(df, "id", 0, 3, with_replacement=True).count() == 0


def test_factors_of_large_and_text_ids(spark):
    rows = [(3_000_000_000 + u, f"i{i}", float((u * i) % 5 + 1)) for u in range(8) for i in range(6) if (u + i) % 4]
    df = spark.createDataFrame(rows, "user long, item string, rating double")
    factors = C.als_fit(df, rank=2, iterations=2)
    ask = spark.createDataFrame([(3_000_000_000, "i1", 1.0), (7, "i1", 2.0), (3_000_000_001, "new", 3.0)], "user long, item string, rating double")
    got = {(r.user, r.item): r.prediction for r in C.als_predict(factors, ask).collect()}
    assert len(got) == 3 and got[7, "i1"] == got[3_000_000_001, "new"] == pytest.approx(factors.mean)
    recs = C.als_recommend(factors, df.where("user = 3000000000"), 3).collect()
    assert sorted(r.pos for r in recs) == [0, 1, 2] and all(r.item.startswith("i") for r in recs)
    grid = C.als_choose(df, [2], [0.1, 1.0], folds=2, iterations=2).collect()
    assert len(grid) == 2 and all(r.pairs == len(rows) and r.rmse > 0 for r in grid)


def test_unknown_class_counts_as_wrong(spark):
    rows = [(i, f"word{i % 3} other{i % 3}", f"c{i % 3}") for i in range(60)] + [(1000 + i, "word0", f"rare{i}") for i in range(15)]
    df = spark.createDataFrame(rows, "k int, text string, lang string")
    got = {r.model: r for r in L.classify_text(df, "k", "text", "lang", []).collect()}
    test = S.split(df, "k", [0.8, 0.2], 81)[1]
    assert got["naive_bayes"].n_test == got["majority"].n_test == test.count()
    assert got["naive_bayes"].accuracy <= test.where("lang not like 'rare%'").count() / test.count() + 1e-9


def test_spam_area_follows_the_log_odds(spark):
    rows = [(i, ("win cash now " if i % 2 else "see you soon ") * (1 + i % 7), float(i % 2)) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, text string, label double")
    got = {r.model: r for r in L.spam_report(df, "k", "text", "label").collect()}
    assert got["naive_bayes"].auc == 1.0 and got["majority"].auc == 0.5


def test_job_runs_from_another_folder(tmp_path):
    code = textwrap.dedent(f"""
        import importlib.util, sys
        spec = importlib.util.spec_from_file_location("__spark_entry__", {ROOT!r} + "/__spark_entry__.py")
        entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
        print("rows", entry.queries()["knn_vote"](spark, "/root/testdata/sf0.001").count())
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "rows " in done.stdout, done.stderr[-2000:]


def test_buckets_of_the_text_models(spark, monkeypatch):
    from tidemill.plans import streams as P
    from tidemill.sources.tables import Tables

    rows = [(i, f"word{i % 7} other{i % 3}", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, text string, label int")
    size = lambda model: next(s for s in model.stages if s.hasParam("numFeatures")).getNumFeatures()
    _, refit, _ = L.fit_best_text_model(df, "k", "text", "label")
    _, small, _ = L.fit_best_text_model(df, "k", "text", "label", buckets=64)
    assert (size(refit.stages[0]), size(small.stages[0])) == (200_000, 64)
    models, scored = [], P.J.scored
    monkeypatch.setattr(P.J, "scored", lambda stream, model: models.append(model) or scored(stream, model))
    assert P.stream_score(Tables(spark, "/root/testdata/sf0.001")).count() == 200 and size(models[0]) == 200_000
