"""Tests and intervals against published values."""

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.functions import special as S
from tidemill.functions import udfs
from tidemill.operators import metrics as Q
from tidemill.operators import stats as E


def test_anova_published(spark):
    table = [(25, 45, 30, 54), (30, 55, 29, 60), (28, 29, 33, 51), (36, 56, 37, 62), (29, 40, 27, 73)]
    wide = spark.createDataFrame([(i, *r) for i, r in enumerate(table)], "id int, A int, B int, C int, D int")
    row = E.anova(E.melt(wide, ["id"], list("ABCD")), "variable", "value").first()
    assert row["f"] == pytest.approx(17.492810457516338, rel=1e-12)
    assert row["p_value"] == pytest.approx(2.639241146210922e-05, rel=1e-9)


def test_tails():
    assert S.normal_tail(1.959963984540054) == pytest.approx(0.025, rel=1e-12)
    assert S.t_tail(2.0, 1) == pytest.approx(0.5 - math.atan(2.0) / math.pi, rel=1e-12)
    assert S.t_quantile(0.975, 10) == pytest.approx(2.228138851964939, rel=1e-10)
    assert S.chi2_tail(3.0, 2) == pytest.approx(math.exp(-1.5), rel=1e-12)
    assert S.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-10)
    assert S.f_tail(4.0, 2, 2) == pytest.approx(0.2, rel=1e-12)
    assert S.t_tail(-2.0, 7) + S.t_tail(2.0, 7) == pytest.approx(1.0)


def test_fisher():
    def brute(a, b, c, d):
        row, col, n = a + b, a + c, a + b + c + d
        pmf = {k: math.comb(row, k) * math.comb(n - row, col - k) / math.comb(n, col) for k in range(max(0, col - n + row), min(row, col) + 1)}
        return sum(p for p in pmf.values() if p <= pmf[a] * (1 + 1e-7))

    for t in [(8, 2, 1, 5), (3, 1, 1, 3), (0, 10, 12, 2), (40, 60, 55, 45)]:
        assert S.fisher_two_sided(*t) == pytest.approx(brute(*t), rel=1e-9)


def test_interval_and_t(spark):
    v = [5, 7, 7, 9, 10, 16, 7, 14, 13, 15, 16, 15]
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    se = np.std(v, ddof=1) / math.sqrt(len(v))
    for dof, n in (("n-1", 11), ("n", 12)):
        row = E.mean_interval(df, "x", 0.95, dof).first()
        assert row["high"] - row["mean"] == pytest.approx(se * S.t_quantile(0.975, n))
    one = E.t_test(E.one_sample_stats(df, "x", 10.0)).first()
    assert one["t"] == pytest.approx((np.mean(v) - 10) / se)
    assert one["p_value"] == pytest.approx(2 * S.t_tail(abs(one["t"]), 11))


def test_two_sample_sides(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4)] + [("b", float(x)) for x in (3, 4, 5, 7)], "g string, x double")
    stats = E.two_sample_stats(df, "g", "x", "a", "b")
    p = {side: E.t_test(stats, side).first()["p_value"] for side in ("two-sided", "less", "greater")}
    assert p["less"] == pytest.approx(p["two-sided"] / 2) and p["less"] + p["greater"] == pytest.approx(1.0)


def test_chi_square(spark):
    cells = {("x", "a"): 10, ("x", "b"): 20, ("x", "c"): 30, ("y", "a"): 6, ("y", "b"): 9, ("y", "c"): 0}
    rows = [k for k, n in cells.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "r string, c string")
    obs = np.array([[10, 20, 30], [6, 9, 0]])
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    row = E.chi_square(df, "r", "c").first()
    assert row["chi2"] == pytest.approx(((obs - exp) ** 2 / exp).sum()) and row["dof"] == 2
    two = df.where("c <> 'c'")
    obs = obs[:, :2]
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    shift = np.minimum(0.5, np.abs(obs - exp))
    assert E.chi_square(two, "r", "c").first()["chi2"] == pytest.approx(((np.abs(obs - exp) - shift) ** 2 / exp).sum())


def test_rank_tests(spark):
    a, b = [21, 27, 23, 25, 29, 26, 29, 27], [20, 26, 22, 24, 28, 28, 26, 25, 28]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b], "g string, x int")
    ranks = pd.Series(a + b).rank()
    u = ranks[: len(a)].sum() - len(a) * (len(a) + 1) / 2
    assert E.rank_sum(df, "g", "x", "a", "b").first()["u"] == u
    pairs = spark.createDataFrame([(29, 32), (23, 24), (22, 24), (16, 15), (23, 25), (23, 24), (22, 23), (24, 27), (25, 27), (20, 21), (21, 22), (22, 24), (5, 5)], "x int, y int")
    row = E.signed_rank(pairs, "x", "y").first()
    d = np.array([-3, -1, -2, 1, -2, -1, -1, -3, -2, -1, -1, -2])
    r = pd.Series(np.abs(d)).rank().to_numpy()
    assert (row["n"], row["w"]) == (12, min(r[d > 0].sum(), r[d < 0].sum()))
    assert 0 < row["p_value"] < 0.01


def test_bootstrap_sums_by_hand(spark):
    values = [(i, "ab"[i % 2] if i % 5 else None, None if i % 7 == 0 else 1000.0 + i + 0.01 * (i % 3)) for i in range(40)]
    df = spark.createDataFrame([*values, (None, "a", 5.0)], "id long, g string, v double")
    want: dict = {}
    for i, g, v in [*values, (None, "a", 5.0)]:
        for q in range(3):
            drawn = hashlib.md5("-".join(["9", *([str(i)] if i is not None else []), str(q)]).encode()).hexdigest()
            for j in range(4):
                u, w, term, total = int(drawn[8 * j : 8 * j + 8], 16) / 2**32, 0, math.exp(-1), 0.0
                while u >= (total := total + term):
                    w, term = w + 1, term / (w + 1)
                if 4 * q + j < 10 and w:
                    want.setdefault((4 * q + j, g), []).append((w, v))
    plan = E.bootstrap_means(df, "id", "g", "v", 10, 9)
    got = {(r["replicate"], r["g"]): r["mean_value"] for r in plan.collect()}
    means = {k: sum(w * v for w, v in x if v is not None) / sum(w for w, _ in x) for k, x in want.items()}
    assert got == {k: pytest.approx(v, rel=1e-13) for k, v in means.items()}
    assert "MapInArrow" in udfs.plan_text(plan)  # replicates are made and added up in arrays, not as rows


def test_bootstrap(spark):
    df = spark.createDataFrame([(i, "g", float(i % 10)) for i in range(500)], "id int, g string, v double")
    means = [r["mean_value"] for r in E.bootstrap_means(df, "id", "g", "v", 60, 1).collect()]
    assert len(means) == 60 and abs(np.mean(means) - 4.5) < 0.1
    assert 0.6 < np.std(means) / (np.std(np.arange(500) % 10) / math.sqrt(500)) < 1.5
    cells = spark.createDataFrame([(1, 1, 40), (1, 0, 10), (0, 1, 5), (0, 0, 45)], "y int, p int, n long")
    one = E.replicate_scores(E.bootstrap_cells(cells, "n", 200, 3), "y", "p")
    two = E.replicate_scores(E.bootstrap_cells(cells.repartition(4), "n", 200, 3), "y", "p")
    assert sorted(one.collect()) == sorted(two.collect())
    row = E.three_sigma(one, ["accuracy"]).first()
    assert row["low"] < 0.85 < row["high"] and abs(row["mean"] - 0.85) < 0.02


def test_auc_and_curve(spark):
    y = [1, 0, 1, 1, 0, 0, 1, 0]
    s = [0.9, 0.8, 0.8, 0.6, 0.6, 0.3, 0.3, 0.1]
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double")
    pos, neg = [b for a, b in zip(y, s) if a], [b for a, b in zip(y, s) if not a]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert Q.areas(Q.curve(df, "y", "s")).first()["roc_auc"] == pytest.approx(want)
    row = Q.binary(df.withColumn("p", F.lit(0)), "y", "p").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_outliers(spark):
    v = [1.0] * 30 + [1.1] * 30 + [9.0]
    df = spark.createDataFrame([(x,) for x in v], "v double")
    assert [r["v"] for r in E.z_outliers(df, "v").collect()] == [9.0]
    assert [r["v"] for r in E.iqr_outliers(df, "v").collect()] == [9.0]
    assert 9.0 in [r["v"] for r in E.density_outliers(df, "v", 0.014).collect()]
    spread = np.std(v, ddof=1)
    std = sum(np.exp(-(((x - np.mean(v)) / spread) ** 2) / 2) / (spread * math.sqrt(2 * math.pi)) < 0.3 for x in v)
    assert E.density_outliers(df, "v", 0.3).count() == std


def test_replicates_of_the_queries(spark, monkeypatch):
    from tidemill.plans import experiments as P
    from tidemill.sources.tables import Tables

    t, seen = Tables(spark, "/root/testdata/sf0.001"), []
    keep = lambda scores, columns: seen.append(scores) or scores
    monkeypatch.setattr(P.E, "three_sigma", keep)
    P.bootstrap_interval(t), P.bootstrap_auc(t)
    assert [s.select("replicate").distinct().count() for s in seen] == [1000, 1000]
    every = P.bootstrap_mean_all(t).collect()
    assert {r.replicate for r in every} == set(range(1000))
    assert {tuple(r) for r in P.bootstrap_mean(t).collect()} == {tuple(r) for r in every if r.replicate < 40}
