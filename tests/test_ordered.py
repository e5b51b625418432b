"""Sliced window operators against pandas, with one key holding most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.operators import ordered as O


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 600
    pdf = pd.DataFrame(
        {
            "k": np.where(rng.random(n) < 0.6, "hot", rng.choice(list("abcde"), n)),
            "t": rng.integers(0, 80, n),
            "id": np.arange(n),
            "v": rng.integers(1, 9, n).astype(float),
        }
    )
    pdf["known"] = pdf.v.where(rng.random(n) < 0.1)
    known = pdf.known.astype(object).where(pdf.known.notna(), None)
    rows = [(k, int(t), int(i), float(v), x) for (k, t, i, v), x in zip(pdf[["k", "t", "id", "v"]].itertuples(index=False), known)]
    df = spark.createDataFrame(rows, "k string, t int, id int, v double, known double")
    return pdf.sort_values(["k", "t", "id"]).reset_index(drop=True), df


def _by_id(df, column):
    return {r["id"]: r[column] for r in df.collect()}


@pytest.mark.parametrize("slices", [1, 7, 40])
def test_running_totals(skewed, slices):
    pdf, df = skewed
    out = O.running_totals(
        df, ["k"], ["t", "id"], {"s": F.col("v"), "n": F.lit(1)}, {"p": 1 + F.col("v") / 1000}, slices=slices
    )
    got = {r["id"]: (r["s"], r["n"], r["p"]) for r in out.collect()}
    for _, g in pdf.groupby("k"):
        for i, s, n, p in zip(g.id, g.v.cumsum(), range(1, len(g) + 1), (1 + g.v / 1000).cumprod()):
            assert got[i][:2] == (s, n)
            assert got[i][2] == pytest.approx(p)


@pytest.mark.parametrize("slices", [1, 9, 40])
def test_forward_fill_and_previous(skewed, slices):
    pdf, df = skewed
    filled = _by_id(O.forward_fill(df, ["k"], ["t", "id"], "known", "f", slices), "f")
    before = _by_id(O.previous_value(df, ["k"], ["t", "id"], "v", "p", slices), "p")
    for _, g in pdf.groupby("k"):
        for i, f, p in zip(g.id, g.known.ffill(), g.v.shift()):
            assert filled[i] == (None if np.isnan(f) else f)
            assert before[i] == (None if np.isnan(p) else p)


def test_descending_row_numbers(skewed):
    pdf, df = skewed
    got = _by_id(O.row_numbers(df, [], [F.desc("t"), F.asc("id")], "rn", slices=11), "rn")
    order = pdf.sort_values(["t", "id"], ascending=[False, True]).id
    assert [got[i] for i in order] == list(range(1, len(pdf) + 1))


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, i, 1) for i in range(20)], "k string, t int, v int")
    out = O.running_totals(df, ["k"], ["t"], {"s": F.col("v")}, slices=6)
    assert sorted(r["s"] for r in out.collect()) == list(range(1, 21))


def test_quantiles(skewed):
    pdf, df = skewed
    got = {r["k"]: (r["q"], r["m"]) for r in O.exact_quantiles(df, "v", {"q": 0.3, "m": 0.5}, by=["k"]).collect()}
    for k, g in pdf.groupby("k"):
        assert got[k] == (pytest.approx(g.v.quantile(0.3)), pytest.approx(g.v.median()))
    low = O.exact_quantiles(df, "v", {"m": 0.5}, interpolate=False).first()["m"]
    assert low == sorted(pdf.v)[(len(pdf) + 1) // 2 - 1]
    assert df.approxQuantile("v", [0.5], 0.0) == [low]


def test_mid_ranks(skewed):
    pdf, df = skewed
    got = {r["v"]: (r["mid_rank"], r["hot"]) for r in O.mid_ranks(df, "v", {"hot": (F.col("k") == "hot").cast("int")}).collect()}
    ranks = pdf.v.rank()
    for v in pdf.v.unique():
        assert got[v] == (ranks[pdf.v == v].iloc[0], int(((pdf.v == v) & (pdf.k == "hot")).sum()))


def test_rolling_ranges(skewed, spark):
    pdf, df = skewed
    stamped = df.withColumn("ts", F.timestamp_seconds(F.col("t") * 60))
    out = O.rolling_ranges(stamped, "k", "ts", "id", "v", {"a": 120, "b": 1200}, slices=13)
    got = {r["id"]: r for r in out.collect()}
    for _, g in pdf.groupby("k"):
        for i, t in zip(g.id, g.t):
            for name, width in (("a", 2), ("b", 20)):
                inside = g[(g.t >= t - width) & (g.t <= t)]
                assert got[i][f"cnt_{name}"] == len(inside)
                assert got[i][f"sum_{name}"] == pytest.approx(inside.v.sum())
