"""Experiment statistics: one distributed pass makes the sufficient statistics (a one-row table), a
scalar finish adds the p-value. Functions named ``*_stats`` return the one-row table alone."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import md5
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import special as S
from ..functions.hashing import poisson_edges
from .ordered import exact_quantiles, mid_ranks, running_totals


def with_p(stats: DataFrame, p: Callable[[dict], float], name: str = "p_value") -> DataFrame:
    """The one-row table with a p-value worked out from its values; NULL where one of them is missing."""
    row = stats.first()
    out = stats.sparkSession.createDataFrame([row], stats.schema)
    found = None if None in row.asDict().values() else float(p(row.asDict()))
    return out.withColumn(name, F.lit(found).cast("double"))


# --- intervals and sample size ---------------------------------------------------------------------


def mean_stats(df: DataFrame, value: str) -> DataFrame:
    return df.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.try_divide(F.stddev_samp(value), F.sqrt(F.count(value))).alias("se"),
    )


def mean_interval(df: DataFrame, value: str, confidence: float = 0.95, dof: str = "n-1") -> DataFrame:
    """Student interval of the mean; ``dof="n"`` uses n instead of n - 1 degrees of freedom."""
    row = mean_stats(df, value).first()
    schema = "n long, mean double, low double, high double"
    if row["se"] is None:  # fewer than two values have no interval
        return df.sparkSession.createDataFrame([(row["n"], row["mean"], None, None)], schema)
    t = S.t_quantile((1 + confidence) / 2, row["n"] if dof == "n" else row["n"] - 1)
    out = (row["n"], row["mean"], row["mean"] - t * row["se"], row["mean"] + t * row["se"])
    return df.sparkSession.createDataFrame([out], schema)


def sample_size(df: DataFrame, value: str, error: float, z: float = 1.96) -> DataFrame:
    """Rows needed to know the mean to ``error``: (z * std / error) ** 2, cut to a whole number."""
    need = F.pow(F.lit(z) * F.stddev_samp(value) / F.lit(error), F.lit(2.0))
    return df.agg(F.floor(need).alias("sample_size"))


# --- t-tests and analysis of variance ----------------------------------------------------------------


def _group(df: DataFrame, group: str, value: str, names: Sequence) -> dict[str, Column]:
    out = {}
    for i, g in enumerate(names, start=1):
        v = F.when(F.col(group) == g, F.col(value))
        out |= {f"n{i}": F.count(v), f"m{i}": F.avg(v), f"v{i}": F.var_samp(v)}
    return out


def two_sample_stats(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """Pooled-variance t statistic of group ``a`` against ``b`` and its degrees of freedom."""
    one = df.agg(*[c.alias(n) for n, c in _group(df, group, value, [a, b]).items()])
    dof = F.col("n1") + F.col("n2") - 2
    pooled = ((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2"))
    pooled = F.try_divide(pooled, dof)
    spread = F.sqrt(pooled * (F.try_divide(F.lit(1), F.col("n1")) + F.try_divide(F.lit(1), F.col("n2"))))
    t = F.try_divide(F.col("m1") - F.col("m2"), spread)
    return one.select("n1", "n2", "m1", "m2", t.alias("t"), dof.alias("dof"))


def one_sample_stats(df: DataFrame, value: str, mean: float) -> DataFrame:
    t = F.try_divide((F.avg(value) - F.lit(mean)) * F.sqrt(F.count(value)), F.stddev_samp(value))
    return df.agg(F.count(value).alias("n"), t.alias("t"), (F.count(value) - 1).alias("dof"))


def paired_stats(df: DataFrame, before: str, after: str) -> DataFrame:
    """t statistic of ``before - after``; rows with a NULL on either side are skipped."""
    return one_sample_stats(df.select((F.col(before) - F.col(after)).alias("_d")), "_d", 0.0)


def t_test(stats: DataFrame, alternative: str = "two-sided") -> DataFrame:
    def p(r: dict) -> float:
        above, below = S.t_tail(r["t"], r["dof"]), S.t_tail(-r["t"], r["dof"])
        return {"greater": above, "less": below}.get(alternative, min(1.0, 2 * min(above, below)))

    return with_p(stats, p)


def anova_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way F statistic from count, mean and variance per group."""
    per = df.where(F.col(value).isNotNull()).groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v")
    )
    total = per.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n")).alias("grand"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"),
    )
    grand = total.select("grand").scalar()
    between = per.agg(F.sum(F.col("n") * (F.col("m") - grand) * (F.col("m") - grand)).alias("ssb"))
    ssb = between.scalar()
    f = F.try_divide(F.try_divide(ssb, F.col("k") - 1), F.try_divide(F.col("ssw"), F.col("n") - F.col("k")))
    return total.select("k", "n", f.alias("f"), (F.col("k") - 1).alias("d1"), (F.col("n") - F.col("k")).alias("d2"))


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    return with_p(anova_stats(df, group, value), lambda r: S.f_tail(r["f"], r["d1"], r["d2"]))


# --- contingency tables -----------------------------------------------------------------------------


def expected_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """Observed and expected count of every cell that occurs."""
    cells = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("observed"))
    rows = cells.groupBy(row).agg(F.sum("observed").alias("_r"))
    cols = cells.groupBy(column).agg(F.sum("observed").alias("_c"))
    n = cells.agg(F.sum("observed").alias("n")).scalar()
    out = cells.join(rows, row).join(cols, column)
    return out.select(row, column, "observed", (F.col("_r") * F.col("_c") / n).alias("expected"))


def chi_square_stats(df: DataFrame, row: str, column: str) -> DataFrame:
    """Chi-square statistic and degrees of freedom.

    Uses n * (sum(observed^2 / (row total * column total)) - 1), to which empty cells add nothing. A 2x2
    table, in which all cells deviate equally, gets the continuity correction.
    """
    cells = expected_counts(df, row, column)
    one = cells.agg(
        F.sum("observed").alias("n"),
        F.count_distinct(row).alias("rows"),
        F.count_distinct(column).alias("cols"),
        F.sum(F.col("observed") * F.col("observed") / F.col("expected")).alias("_s"),
        F.max(F.abs(F.col("observed") - F.col("expected"))).alias("_d"),
    )
    plain = F.col("_s") - F.col("n")
    dof = (F.col("rows") - 1) * (F.col("cols") - 1)
    shrink = F.pow(F.greatest(F.col("_d") - 0.5, F.lit(0.0)) / F.col("_d"), F.lit(2.0))
    corrected = F.when((dof == 1) & (F.col("_d") > 0), plain * shrink).otherwise(plain)
    return one.select("n", corrected.alias("chi2"), dof.alias("dof"))


def chi_square(df: DataFrame, row: str, column: str) -> DataFrame:
    return with_p(chi_square_stats(df, row, column), lambda r: S.chi2_tail(r["chi2"], r["dof"]))


def fisher_exact(df: DataFrame, row: str, column: str) -> DataFrame:
    """Odds ratio and two-sided exact p of two 0/1 columns."""
    cell = lambda r, c: F.count_if((F.col(row) == r) & (F.col(column) == c))
    one = df.agg(cell(0, 0).alias("a"), cell(0, 1).alias("b"), cell(1, 0).alias("c"), cell(1, 1).alias("d"))
    odds = one.withColumn("odds_ratio", F.col("a") * F.col("d") / F.nullif(F.col("b") * F.col("c"), F.lit(0).cast("long")))
    return with_p(odds, lambda r: S.fisher_two_sided(r["a"], r["b"], r["c"], r["d"]))


# --- rank tests -----------------------------------------------------------------------------------


def rank_sum_stats(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """Mann-Whitney U of group ``a`` with the tie-corrected, continuity-corrected normal score."""
    rows = df.where(F.col(group).isin(a, b) & F.col(value).isNotNull())
    ranks = mid_ranks(rows, value, {"n1": F.when(F.col(group) == a, 1).otherwise(0).cast("long")})
    one = ranks.agg(
        F.sum("n1").alias("n1"),
        (F.sum("ties") - F.sum("n1")).alias("n2"),
        F.sum(F.col("mid_rank") * F.col("n1")).alias("r1"),
        F.sum(F.pow(F.col("ties").cast("double"), F.lit(3.0)) - F.col("ties")).alias("tie"),
    )
    n = (F.col("n1") + F.col("n2")).cast("double")
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2
    half = F.col("n1") * F.col("n2") / F.lit(2.0)
    sd = F.sqrt(F.col("n1") * F.col("n2") / F.lit(12.0) * (n + 1 - F.col("tie") / (n * (n - 1))))
    z = (F.greatest(u, 2 * half - u) - half - 0.5) / sd
    return one.select("n1", "n2", u.alias("u"), z.alias("z"))


def rank_sum(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    return with_p(rank_sum_stats(df, group, value, a, b), lambda r: min(1.0, 2 * S.normal_tail(r["z"])))


def signed_rank_stats(df: DataFrame, before: str, after: str) -> DataFrame:
    """Wilcoxon W = min(W+, W-) over non-zero differences with its tie-corrected normal score."""
    d = df.select((F.col(before) - F.col(after)).alias("_d")).where("_d <> 0")
    plus = F.when(F.col("_d") > 0, 1).otherwise(0).cast("long")
    ranks = mid_ranks(d.withColumn("_a", F.abs("_d")), "_a", {"plus": plus})
    one = ranks.agg(
        F.sum("ties").alias("n"),
        F.sum(F.col("mid_rank") * F.col("plus")).alias("wp"),
        F.sum(F.col("mid_rank") * (F.col("ties") - F.col("plus"))).alias("wm"),
        F.sum(F.pow(F.col("ties").cast("double"), F.lit(3.0)) - F.col("ties")).alias("tie"),
    )
    n = F.col("n").cast("double")
    sd = F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("tie") / 48)
    w = F.least("wp", "wm")
    return one.select("n", w.alias("w"), ((w - n * (n + 1) / 4) / sd).alias("z"))


def signed_rank(df: DataFrame, before: str, after: str) -> DataFrame:
    return with_p(signed_rank_stats(df, before, after), lambda r: min(1.0, 2 * S.normal_tail(abs(r["z"]))))


# --- bootstrap ---------------------------------------------------------------------------------------


#: Replicates of a bootstrap.
REPLICATES = 1_000
#: Rows that one task of a bootstrap takes, about, rows whose weights are laid out at a time, and groups that it holds.
BOOTSTRAP_TASK, BOOTSTRAP_ROWS, BOOTSTRAP_GROUPS = 20_000, 1_000, 256
_ONE_EDGES = np.ceil(np.array(poisson_edges(1.0)) * 2**32).astype("int64")


def _replicate_weights(prefixes: Sequence[str], replicates: int) -> np.ndarray:
    """Poisson(1) weights, (rows, replicates): four 32-bit numbers come from the md5 digest of each ``prefix-quarter``."""
    names = [f"-{q}".encode() for q in range((replicates + 3) // 4)]
    drawn = b"".join([md5(prefix + name).digest() for prefix in (p.encode() for p in prefixes) for name in names])
    words = np.frombuffer(drawn, dtype=">u4").astype("int64").reshape(len(prefixes), -1)[:, :replicates]
    return np.searchsorted(_ONE_EDGES, words, side="right").astype("float64")


def bootstrap_means(df: DataFrame, key: str, group: str, value: str, replicates: int = REPLICATES, seed: int = 51) -> DataFrame:
    """Mean of ``value`` per (replicate, group): in a replicate every row has a Poisson(1) weight by its key, so a replicate is
    the same on any cluster.

    A task adds up the weights and the weighted values of its rows, row by row, and sends one row for each group.
    """
    prefix = F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string"))
    rows = df.select(prefix.alias("prefix"), F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
    tasks = ceil(rows.count() / BOOTSTRAP_TASK)  # few bytes, but much work for each row
    spread = rows.repartition(tasks, "prefix") if tasks > 1 else rows
    names = ("n", "known", "total")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}

        def sent() -> pa.RecordBatch:
            lists = [pa.array([t[i] for t in totals.values()], pa.list_(pa.float64())) for i in range(len(names))]
            return pa.record_batch([pa.array(list(totals), kind), *lists], names=["g", *names])

        for b in (batch.slice(i, BOOTSTRAP_ROWS) for batch in batches for i in range(0, batch.num_rows, BOOTSTRAP_ROWS)):
            w = _replicate_weights(b.column("prefix").to_pylist(), replicates)
            known = b.column("v").is_valid().to_numpy(zero_copy_only=False)
            v = np.where(known, b.column("v").to_numpy(zero_copy_only=False), 0.0)
            coded, kind = b.column("g").dictionary_encode(null_encoding="encode"), b.column("g").type
            code = coded.indices.to_numpy()
            for c, g in enumerate(coded.dictionary.to_pylist()):
                mine = code == c
                some = w[mine]
                with np.errstate(invalid="ignore"):
                    weighed = np.where(some > 0, some * v[mine, None], 0.0)
                added = [np.add.reduce(x, axis=0) for x in (some, some[known[mine]])]
                before = totals.get(g, np.zeros((len(names), replicates)))
                total = np.add.reduce(np.concatenate([before[-1:], weighed]), axis=0)  # in the order of the rows
                totals[g] = np.stack([before[0] + added[0], before[1] + added[1], total])
            if len(totals) > BOOTSTRAP_GROUPS:
                yield sent()
                totals = {}
        if totals:
            yield sent()

    shape = f"g {dict(rows.dtypes)['g']}, " + ", ".join(f"{c} array<double>" for c in names)
    each = spread.mapInArrow(add_up, shape).select("g", F.posexplode(F.arrays_zip(*names)).alias("replicate", "t"))
    added = each.groupBy("replicate", "g").agg(*[F.sum(F.col(f"t.{c}")).alias(c) for c in names]).where("n > 0")
    mean = F.when(F.col("known") > 0, F.col("total") / F.col("n"))
    return added.select("replicate", F.col("g").alias(group), mean.alias("mean_value"))


def bootstrap_cells(cells: DataFrame, count: str, replicates: int = REPLICATES, seed: int = 61) -> DataFrame:
    """Replicate counts of an aggregated table: a cell of ``n`` rows weighs Poisson(n) in a replicate.

    For metrics of few distinct outcomes this costs cells x replicates instead of rows x replicates. The
    generator is keyed by the cell's values, so the draw does not depend on the partitioning.
    """
    names = [c for c in cells.columns if c != count]
    keyed = cells.withColumn("_k", F.xxhash64(F.lit(seed), *names))
    schema = keyed.drop("_k", count).schema.add("replicate", "integer").add("w", "long")

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, 1_000_000 // max(replicates, 1))  # cells whose replicates are held at a time
        for b in (batch.iloc[i : i + step] for batch in batches for i in range(0, len(batch), step)):
            out = []
            for k, n in zip(b["_k"], b[count]):
                gen = np.random.Generator(np.random.Philox(key=int(k) & (2**64 - 1)))
                out.append(gen.poisson(n, replicates))
            wide = b[names].loc[b.index.repeat(replicates)].reset_index(drop=True)
            wide["replicate"] = np.tile(np.arange(replicates, dtype="int32"), len(b))
            wide["w"] = np.concatenate(out) if out else np.array([], dtype="int64")
            yield wide[wide.w > 0]

    return keyed.mapInPandas(draw, schema)


def replicate_scores(drawn: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Accuracy and F1 per replicate of 0/1 columns with weight ``w``."""
    hit = lambda t, p: F.sum(F.when((F.col(truth) == t) & (F.col(prediction) == p), F.col("w")).otherwise(0))
    tp, fp, fn, tn = hit(1, 1), hit(0, 1), hit(1, 0), hit(0, 0)
    f1 = F.coalesce(2 * tp / F.nullif(2 * tp + fp + fn, F.lit(0).cast("long")), F.lit(0.0))
    return drawn.groupBy("replicate").agg(((tp + tn) / F.sum("w")).alias("accuracy"), f1.alias("f1"))


def replicate_auc(drawn: DataFrame, truth: str, score: str) -> DataFrame:
    """ROC-AUC per replicate: sums over distinct scores only."""
    per = drawn.groupBy("replicate", score).agg(
        F.sum(F.when(F.col(truth) == 1, F.col("w")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(truth) == 0, F.col("w")).otherwise(0)).alias("neg"),
    )
    run = running_totals(per, ["replicate"], [F.col(score).desc()], {"cp": F.col("pos")})
    area = F.sum(F.col("neg") * (F.col("cp") - F.col("pos") / 2))
    return run.groupBy("replicate").agg(F.try_divide(area, F.sum("pos") * F.sum("neg")).alias("auc"))


def three_sigma(scores: DataFrame, columns: Sequence[str]) -> DataFrame:
    """mean - 3 std, mean, mean + 3 std (population) of the replicates, one row per metric."""
    rows = []
    for c in columns:
        m, s = F.avg(c), F.stddev_pop(c)
        rows.append(scores.agg(F.lit(c).alias("metric"), (m - 3 * s).alias("low"), m.alias("mean"), (m + 3 * s).alias("high")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def better_candidate(base: DataFrame, candidate: DataFrame, metric: str, alpha: float, looks: int) -> DataFrame:
    """One-sided t-test that the base's replicates are below the candidate's, at alpha / looks."""
    both = base.select(F.lit("base").alias("g"), metric).unionByName(candidate.select(F.lit("cand").alias("g"), metric))
    tested = t_test(two_sample_stats(both, "g", metric, "base", "cand"), "less")
    return tested.withColumn("accepted", F.col("p_value") < alpha / looks)


# --- outliers ------------------------------------------------------------------------------------


def threshold_counts(df: DataFrame, value: str) -> DataFrame:
    """Rows below zero, at zero, and the share of rows at the maximum."""
    top = df.agg(F.max(value).alias("m")).scalar()
    return df.agg(
        F.count_if(F.col(value) < 0).alias("below_zero"),
        F.count_if(F.col(value) == 0).alias("at_zero"),
        F.try_divide(F.count_if(F.col(value) == top), F.count(value)).alias("share_at_max"),
    )


def z_outliers(df: DataFrame, value: str, threshold: float = 3.0) -> DataFrame:
    """Rows further than ``threshold`` population standard deviations from the mean."""
    mean, std = df.agg(F.avg(value).alias("m")).scalar(), df.agg(F.stddev_pop(value).alias("s")).scalar()
    return df.where(F.abs(F.col(value) - mean) > F.lit(threshold) * std)


def iqr_outliers(df: DataFrame, value: str, reach: float = 1.5) -> DataFrame:
    """Rows outside the quartiles by more than ``reach`` interquartile ranges (linear percentiles)."""
    row = exact_quantiles(df, value, {"q1": 0.25, "q3": 0.75}).first()
    if row is None or row["q1"] is None:
        return df.limit(0)
    width = row["q3"] - row["q1"]
    return df.where((F.col(value) < row["q1"] - reach * width) | (F.col(value) > row["q3"] + reach * width))


def density_outliers(df: DataFrame, value: str, epsilon: float, sigma: str = "std") -> DataFrame:
    """Rows whose normal density is below ``epsilon``. ``sigma="variance"`` uses the sample variance
    where the standard deviation belongs, as a published variant does."""
    mean = df.agg(F.avg(value).alias("m")).scalar()
    spread = df.agg((F.stddev_samp(value) if sigma == "std" else F.var_samp(value)).alias("s")).scalar()
    z = (F.col(value) - mean) / spread
    density = F.exp(-z * z / 2) / (spread * F.lit(sqrt(2 * np.pi)))
    return df.where(density < epsilon)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Wide to long: one row per id and value column, as (ids, variable, value)."""
    return df.unpivot(list(ids), list(values), "variable", "value")
