"""Statistics and experiment queries. Tail probabilities have no SQL twin; they are tested against known values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import stats as E
from ..sources.tables import Tables
from .registry import job


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, k in df.dtypes if k == "double"})


@job(
    "mean_se",
    """SELECT count(*) AS n, round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS std,
    round(stddev_samp(o_totalprice) / sqrt(count(*)), 6) AS se FROM orders""",
)
def mean_se(t: Tables) -> DataFrame:
    """The sufficient statistics of the interval."""
    return _rounded(E.mean_stats(t.orders, "o_totalprice"))


@job("mean_ci")
def mean_ci(t: Tables) -> DataFrame:
    """95 % Student interval of the mean."""
    return E.mean_interval(t.orders, "o_totalprice")


@job(
    "sample_size",
    "SELECT CAST(floor(pow(1.96 * stddev_samp(o_totalprice) / 1000, 2)) AS BIGINT) AS sample_size FROM orders",
)
def sample_size(t: Tables) -> DataFrame:
    """E02."""
    return E.sample_size(t.orders, "o_totalprice", 1000.0)


_TWO = """WITH s AS (SELECT count(*) FILTER (p = '1-URGENT') AS n1, count(*) FILTER (p = '5-LOW') AS n2,
 avg(x) FILTER (p = '1-URGENT') AS m1, avg(x) FILTER (p = '5-LOW') AS m2, var_samp(x) FILTER (p = '1-URGENT') AS v1,
 var_samp(x) FILTER (p = '5-LOW') AS v2 FROM (SELECT o_orderpriority AS p, o_totalprice AS x FROM orders {where}))
 SELECT n1, n2, round(m1, 4) AS m1, round(m2, 4) AS m2,
 round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)), 6) AS t, n1 + n2 - 2 AS dof FROM s"""


def _two(df: DataFrame) -> DataFrame:
    out = E.two_sample_stats(df, "o_orderpriority", "o_totalprice", "1-URGENT", "5-LOW")
    return out.withColumns({"m1": F.round("m1", 4), "m2": F.round("m2", 4), "t": F.round("t", 6)})


@job("t_two_sample", _TWO.format(where=""))
def t_two_sample(t: Tables) -> DataFrame:
    """Pooled two-sample statistic."""
    return _two(t.orders)


@job("t_two_sample_p")
def t_two_sample_p(t: Tables) -> DataFrame:
    """E03 with its two-sided p-value."""
    return E.t_test(E.two_sample_stats(t.orders, "o_orderpriority", "o_totalprice", "1-URGENT", "5-LOW"))


@job("trimmed_groups", _TWO.format(where="WHERE o_totalprice <= 450000"))
def trimmed_groups(t: Tables) -> DataFrame:
    """Outliers trimmed before the groups are compared."""
    return _two(t.orders.where("o_totalprice <= 450000"))


@job(
    "t_one_sample",
    """SELECT count(*) AS n, round((avg(l_quantity) - 25) / (stddev_samp(l_quantity) / sqrt(count(*))), 6) AS t,
    count(*) - 1 AS dof FROM lineitem""",
)
def t_one_sample(t: Tables) -> DataFrame:
    """E04."""
    return _rounded(E.one_sample_stats(t.lineitem, "l_quantity", 25.0))


PAIRS = """p AS (SELECT l_partkey, avg(l_quantity) FILTER (l_returnflag = 'R') AS before, avg(l_quantity) FILTER (l_returnflag = 'A') AS after
 FROM lineitem GROUP BY 1)"""


def _pairs(t: Tables) -> DataFrame:
    mean = lambda flag: F.avg(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")))
    return t.lineitem.groupBy("l_partkey").agg(mean("R").alias("before"), mean("A").alias("after"))


@job(
    "t_paired",
    f"""WITH {PAIRS} SELECT count(before - after) AS n,
    round(avg(before - after) / (stddev_samp(before - after) / sqrt(count(before - after))), 6) AS t, count(before - after) - 1 AS dof FROM p""",
)
def t_paired(t: Tables) -> DataFrame:
    """E05."""
    return _rounded(E.paired_stats(_pairs(t), "before", "after"))


_CELLS = """c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS observed FROM orders GROUP BY ALL),
 x AS (SELECT *, sum(observed) OVER (PARTITION BY o_orderstatus) * sum(observed) OVER (PARTITION BY o_orderpriority) / sum(observed) OVER () AS expected FROM c)"""


@job(
    "chi_square_expected",
    f"WITH {_CELLS} SELECT o_orderstatus, o_orderpriority, observed, round(expected, 6) AS expected FROM x",
)
def chi_square_expected(t: Tables) -> DataFrame:
    """Expected counts."""
    return _rounded(E.expected_counts(t.orders, "o_orderstatus", "o_orderpriority"))


@job(
    "chi_square",
    f"""WITH {_CELLS} SELECT CAST(sum(observed) AS BIGINT) AS n, round(sum((observed - expected) * (observed - expected) / expected), 6) AS chi2,
    (count(DISTINCT o_orderstatus) - 1) * (count(DISTINCT o_orderpriority) - 1) AS dof FROM x""",
)
def chi_square(t: Tables) -> DataFrame:
    """Statistic and degrees of freedom."""
    return _rounded(E.chi_square_stats(t.orders, "o_orderstatus", "o_orderpriority"))


@job(
    "chi_square_2x2",
    """WITH c AS (SELECT quality, toxic, count(*) AS o FROM labels GROUP BY ALL),
    x AS (SELECT o, sum(o) OVER (PARTITION BY quality) * sum(o) OVER (PARTITION BY toxic) / sum(o) OVER () AS e FROM c)
    SELECT CAST(sum(o) AS BIGINT) AS n, round(sum(pow(greatest(abs(o - e) - 0.5, 0), 2) / e), 6) AS chi2, 1::BIGINT AS dof FROM x""",
)
def chi_square_2x2(t: Tables) -> DataFrame:
    """A 2x2 table gets the continuity correction."""
    return _rounded(E.chi_square_stats(t.labels, "quality", "toxic"))


@job(
    "fisher_exact",
    """WITH o AS (SELECT count(*) FILTER (quality = 0 AND toxic = 0) AS a, count(*) FILTER (quality = 0 AND toxic = 1) AS b,
    count(*) FILTER (quality = 1 AND toxic = 0) AS c, count(*) FILTER (quality = 1 AND toxic = 1) AS d FROM labels),
    k AS (SELECT *, unnest(range(greatest(0, (a + c) - (c + d)), least(a + b, a + c) + 1)) AS k FROM o),
    w AS (SELECT *, lgamma(a + b + 1) - lgamma(k + 1) - lgamma(a + b - k + 1) + lgamma(c + d + 1) - lgamma(a + c - k + 1)
    - lgamma(c + d - (a + c - k) + 1) - (lgamma(a + b + c + d + 1) - lgamma(a + c + 1) - lgamma(b + d + 1)) AS w FROM k)
    SELECT a, b, c, d, round(any_value(a * d / nullif(b * c, 0)), 6) AS odds_ratio,
    round(least(1.0, sum(CASE WHEN w <= (SELECT w FROM w WHERE k = a) + 1e-7 THEN exp(w) ELSE 0 END)), 6) AS p_value FROM w GROUP BY ALL""",
)
def fisher_exact(t: Tables) -> DataFrame:
    """E07."""
    return _rounded(E.fisher_exact(t.labels, "quality", "toxic"))


@job(
    "anova_f",
    """WITH g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM orders GROUP BY 1),
    s AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(n * m) / sum(n) AS grand, sum(n * v) AS ssw FROM g)
    SELECT k, s.n, round((SELECT sum(g.n * (m - grand) * (m - grand)) FROM g) / (k - 1) / (ssw / (s.n - k)), 6) AS f,
    k - 1 AS d1, s.n - k AS d2 FROM s""",
)
def anova_f(t: Tables) -> DataFrame:
    """E08."""
    return _rounded(E.anova_stats(t.orders, "o_orderpriority", "o_totalprice"))


@job("anova_p")
def anova_p(t: Tables) -> DataFrame:
    """E08 with its p-value."""
    return E.anova(t.orders, "o_orderpriority", "o_totalprice")


_RANKS = """SELECT {cols}, v, (rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2) AS r,
 count(*) OVER (PARTITION BY v) AS ties FROM {src}"""


@job(
    "mann_whitney",
    "WITH x AS (SELECT l_returnflag AS g, l_quantity AS v FROM lineitem WHERE l_returnflag IN ('R', 'A')), y AS ("
    + _RANKS.format(cols="g", src="x")
    + """), s AS (SELECT CAST(count(*) FILTER (g = 'R') AS DOUBLE) AS n1, CAST(count(*) FILTER (g = 'A') AS DOUBLE) AS n2,
    sum(r) FILTER (g = 'R') AS r1, sum(CAST(ties AS DOUBLE) * ties - 1) AS tie FROM y)
    SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(r1 - n1 * (n1 + 1) / 2, 2) AS u,
    round((greatest(r1 - n1 * (n1 + 1) / 2, n1 * n2 - (r1 - n1 * (n1 + 1) / 2)) - n1 * n2 / 2 - 0.5)
    / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - tie / ((n1 + n2) * (n1 + n2 - 1)))), 6) AS z FROM s""",
)
def mann_whitney(t: Tables) -> DataFrame:
    """Mid-ranks come from counts per distinct value."""
    out = E.rank_sum_stats(t.lineitem, "l_returnflag", "l_quantity", "R", "A")
    return out.withColumns({"u": F.round("u", 2), "z": F.round("z", 6)})


@job(
    "wilcoxon",
    f"WITH {PAIRS}, x AS (SELECT abs(before - after) AS v, before > after AS plus FROM p WHERE before - after <> 0), y AS ("
    + _RANKS.format(cols="plus", src="x")
    + """), s AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(r) FILTER (plus) AS wp, sum(r) FILTER (NOT plus) AS wm,
    sum(CAST(ties AS DOUBLE) * ties - 1) AS tie FROM y)
    SELECT CAST(n AS BIGINT) AS n, round(least(wp, wm), 2) AS w,
    round((least(wp, wm) - n * (n + 1) / 4) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - tie / 48), 6) AS z FROM s""",
)
def wilcoxon(t: Tables) -> DataFrame:
    """E10."""
    out = E.signed_rank_stats(_pairs(t), "before", "after")
    return out.withColumns({"w": F.round("w", 2), "z": F.round("z", 6)})


def _edges() -> list[float]:
    total, term, out = 0.0, 0.36787944117144233, []
    for k in range(13):
        total += term
        out.append(total)
        term /= k + 1
    return out


_DRAW = " + ".join(f"CASE WHEN u >= {e!r}::DOUBLE THEN 1 ELSE 0 END" for e in _edges())


def _mean_sql(replicates: int) -> str:
    return f"""WITH h AS (SELECT o_orderpriority AS g, o_totalprice AS v, q, md5('51-' || o_orderkey || '-' || q) AS h
    FROM orders, range({replicates // 4}) r(q)),
    d AS (SELECT g, v, q * 4 + i AS replicate, CAST(('0x' || substr(h, CAST(8 * i + 1 AS INTEGER), 8)) AS UBIGINT) / 4294967296.0 AS u FROM h, range(4) s(i)),
    w AS (SELECT g, v, replicate, {_DRAW} AS w FROM d)
    SELECT CAST(replicate AS INTEGER) AS replicate, g AS o_orderpriority, round(sum(w * v) / sum(w), 4) AS mean_value FROM w WHERE w > 0 GROUP BY ALL"""


@job("bootstrap_mean", _mean_sql(40))
def bootstrap_mean(t: Tables) -> DataFrame:
    """The first 40 replicates of the group means."""
    return _mean_replicates(t, 40)


@job("bootstrap_mean_all", _mean_sql(E.REPLICATES))
def bootstrap_mean_all(t: Tables) -> DataFrame:
    """All replicates of the group means."""
    return _mean_replicates(t)


def _mean_replicates(t: Tables, replicates: int = E.REPLICATES) -> DataFrame:
    out = E.bootstrap_means(t.orders, "o_orderkey", "o_orderpriority", "o_totalprice", replicates, 51)
    # Rounded as SQL does: the product with 10,000, which is a double, goes to a whole number.
    return out.withColumn("mean_value", F.round(F.col("mean_value") * F.lit(1e4)) / F.lit(1e4))


def _scored(t: Tables, bound: int) -> DataFrame:
    """A rule classifier: longer documents are called good."""
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return rows.select("quality", (F.col("n_chars") > bound).cast("int").alias("predicted"), F.floor(F.col("n_chars") / 100).alias("score"))


def _replicates(t: Tables, bound: int, seed: int, replicates: int = E.REPLICATES) -> DataFrame:
    cells = _scored(t, bound).groupBy("quality", "predicted").agg(F.count(F.lit(1)).alias("n"))
    return E.replicate_scores(E.bootstrap_cells(cells, "n", replicates, seed), "quality", "predicted")


@job("bootstrap_interval")
def bootstrap_interval(t: Tables) -> DataFrame:
    """Mean and three-sigma interval of accuracy and F1 over the replicates."""
    return E.three_sigma(_replicates(t, 200, 61), ["accuracy", "f1"])


@job("bootstrap_auc")
def bootstrap_auc(t: Tables) -> DataFrame:
    """The same for the ROC area."""
    cells = _scored(t, 200).groupBy("quality", "score").agg(F.count(F.lit(1)).alias("n"))
    return E.three_sigma(E.replicate_auc(E.bootstrap_cells(cells, "n", seed=62), "quality", "score"), ["auc"])


@job("candidate_vs_base")
def candidate_vs_base(t: Tables) -> DataFrame:
    """Is the candidate rule's F1 above the base rule's?"""
    return E.better_candidate(_replicates(t, 800, 63, 100), _replicates(t, 200, 64, 100), "f1", 0.001, 10)


@job(
    "melt_groups",
    """SELECT l_orderkey, l_partkey, l_linenumber, variable, value FROM (UNPIVOT (SELECT l_orderkey, l_partkey, l_linenumber, l_discount, l_tax FROM lineitem)
    ON l_discount, l_tax INTO NAME variable VALUE value)""",
)
def melt_groups(t: Tables) -> DataFrame:
    """E14."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_discount", "l_tax")
    return E.melt(rows, ["l_orderkey", "l_partkey", "l_linenumber"], ["l_discount", "l_tax"])


@job(
    "outliers_threshold",
    """SELECT count(*) FILTER (c_acctbal < 0) AS below_zero, count(*) FILTER (c_acctbal = 0) AS at_zero,
    round(count(*) FILTER (c_acctbal = (SELECT max(c_acctbal) FROM customer)) / count(*), 6) AS share_at_max FROM customer""",
)
def outliers_threshold(t: Tables) -> DataFrame:
    """E15."""
    return _rounded(E.threshold_counts(t.customer, "c_acctbal"))


@job(
    "outliers_z",
    """SELECT event_id, value FROM events WHERE abs((value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events)) > 3""",
)
def outliers_z(t: Tables) -> DataFrame:
    """E16."""
    return E.z_outliers(t.events.select("event_id", "value"), "value", 3.0)


@job(
    "outliers_iqr",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
    SELECT event_id, value FROM events, q WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)""",
)
def outliers_iqr(t: Tables) -> DataFrame:
    """E17."""
    return E.iqr_outliers(t.events.select("event_id", "value"), "value")


@job(
    "outliers_density",
    """WITH m AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
    SELECT event_id, value FROM events, m WHERE exp(-((value - m) / s) * ((value - m) / s) / 2) / (s * sqrt(2 * pi())) < 0.002""",
)
def outliers_density(t: Tables) -> DataFrame:
    """E18."""
    return E.density_outliers(t.events.select("event_id", "value"), "value", 0.002)


@job(
    "error_list",
    """SELECT doc_id, CASE WHEN quality = 1 THEN 'false negative' ELSE 'false positive' END AS kind FROM labels JOIN documents USING (doc_id)
    WHERE (quality = 1) <> (n_chars > 200)""",
)
def error_list(t: Tables) -> DataFrame:
    """Rows a rule gets wrong."""
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    wrong = rows.withColumn("predicted", (F.col("n_chars") > 200).cast("int")).where("quality <> predicted")
    return wrong.select("doc_id", F.when(F.col("quality") == 1, "false negative").otherwise("false positive").alias("kind"))
