"""Grouped and global aggregation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import relational as R
from ..sources.tables import Tables
from .registry import job


@job(
    "group_stats",
    """SELECT c_mktsegment, min(c_acctbal) AS min_value, max(c_acctbal) AS max_value, round(avg(c_acctbal), 6) AS avg_value,
    count(*) AS cnt FROM customer GROUP BY 1""",
)
def group_stats(t: Tables) -> DataFrame:
    """A01, A02, A32."""
    out = A.group_stats(t.customer, ["c_mktsegment"], "c_acctbal")
    return out.withColumn("avg_value", F.round("avg_value", 6))


@job(
    "global_stats",
    """SELECT max(o_totalprice) AS max_value, round(avg(o_totalprice), 4) AS avg_value, count(*) AS cnt,
    CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders""",
)
def global_stats(t: Tables) -> DataFrame:
    """One global pass; sum and count combine per task."""
    return t.orders.agg(
        F.max("o_totalprice").alias("max_value"),
        F.round(F.avg("o_totalprice"), 4).alias("avg_value"),
        F.count(F.lit(1)).alias("cnt"),
        F.sum("o_orderkey").alias("total"),
    )


@job(
    "distinct_counts",
    """SELECT count(DISTINCT o_custkey) AS o_custkey, count(DISTINCT o_orderstatus) AS o_orderstatus,
    count(DISTINCT o_orderpriority) AS o_orderpriority FROM orders""",
)
def distinct_counts(t: Tables) -> DataFrame:
    """A04."""
    return A.distinct_counts(t.orders, ["o_custkey", "o_orderstatus", "o_orderpriority"])


@job("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    """A05."""
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@job(
    "collect_sorted",
    """SELECT c_nationkey, piece, CAST(count(*) AS INTEGER) AS cnt, string_agg(c_name, ', ' ORDER BY c_name) AS items
    FROM (SELECT c_nationkey, c_name, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) - 1) // 25 AS piece
    FROM customer) GROUP BY ALL""",
)
def collect_sorted(t: Tables) -> DataFrame:
    """Sorted list per group, in pieces of bounded length."""
    return A.sorted_lists(t.customer, "c_nationkey", "c_name", chunk=25)


@job(
    "concat_by_key",
    """SELECT n_regionkey, 0::BIGINT AS piece, CAST(count(*) AS INTEGER) AS cnt,
    'x' || string_agg(n_name, ' ' ORDER BY n_name) AS items FROM nation GROUP BY 1""",
)
def concat_by_key(t: Tables) -> DataFrame:
    """Text reduction per key in sorted order, zero value applied once per key."""
    return A.sorted_lists(t.nation, "n_regionkey", "n_name", sep=" ", zero="x")


@job(
    "share_of_total",
    """SELECT o_orderpriority, count(*) AS cnt, round(count(*) / (SELECT count(*) FROM orders), 6) AS share
    FROM orders GROUP BY 1""",
)
def share_of_total(t: Tables) -> DataFrame:
    """A07, A08, W06, E20."""
    return A.share_of_total(t.orders, ["o_orderpriority"]).withColumn("share", F.round("share", 6))


@job(
    "count_two_keys",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS cnt FROM orders GROUP BY ALL",
)
def count_two_keys(t: Tables) -> DataFrame:
    """Counts per key pair stay distributed."""
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("cnt"))


@job(
    "having_count",
    """SELECT l_partkey, round(avg(l_quantity), 6) AS avg_value, count(*) AS cnt FROM lineitem GROUP BY 1
    HAVING count(*) > 30""",
)
def having_count(t: Tables) -> DataFrame:
    """A09."""
    out = A.average_by_key(t.lineitem, "l_partkey", "l_quantity", min_count=30)
    return out.withColumn("avg_value", F.round("avg_value", 6))


@job(
    "avg_by_key",
    "SELECT l_partkey, round(avg(l_quantity), 6) AS avg_value, count(*) AS cnt FROM lineitem GROUP BY 1",
)
def avg_by_key(t: Tables) -> DataFrame:
    """Average per key by partial (sum, count)."""
    return A.average_by_key(t.lineitem, "l_partkey", "l_quantity").withColumn("avg_value", F.round("avg_value", 6))


@job(
    "sum_count_by_key",
    "SELECT l_suppkey, round(sum(l_quantity), 4) AS total, count(l_quantity) AS cnt FROM lineitem GROUP BY 1",
)
def sum_count_by_key(t: Tables) -> DataFrame:
    """The mergeable pair itself."""
    return A.sum_and_count(t.lineitem, "l_suppkey", "l_quantity").withColumn("total", F.round("total", 4))


@job(
    "grouped_udf_mean",
    """SELECT p_type, round(sum(p_retailprice * p_size) / sum(p_size), 4) AS weighted FROM part GROUP BY 1""",
)
def grouped_udf_mean(t: Tables) -> DataFrame:
    """A user-defined aggregate. It is algebraic, so it is stated as two combining sums."""
    num, den = F.sum(F.col("p_retailprice") * F.col("p_size")), F.sum("p_size")
    return t.part.groupBy("p_type").agg(F.round(num / den, 4).alias("weighted"))


@job(
    "first_by_group",
    """SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus,
    arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, count(o_orderkey) AS cnt FROM orders GROUP BY 1""",
)
def first_by_group(t: Tables) -> DataFrame:
    """A10: first row's values per group (least key) and the count."""
    return A.first_by(t.orders, "o_custkey", "o_orderkey", ["o_orderstatus", "o_orderpriority"], "o_orderkey")


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@job(
    "describe_long",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(count({c}) AS DOUBLE) AS cnt, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem"""
        for c in NUMERIC
    ),
)
def describe_long(t: Tables) -> DataFrame:
    """A26."""
    out = A.describe_long(t.lineitem, NUMERIC)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@job(
    "median_quantiles",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(median(l_extendedprice), 6) AS q50,
    round(quantile_cont(l_extendedprice, 0.9), 6) AS q90 FROM lineitem GROUP BY 1""",
)
def median_quantiles(t: Tables) -> DataFrame:
    """Interpolated exact quantiles per group without a per-group buffer."""
    out = A.quantiles(t.lineitem, "l_extendedprice", {"q25": 0.25, "q50": 0.5, "q90": 0.9}, by=["l_returnflag"])
    return out.withColumns({c: F.round(c, 6) for c in ("q25", "q50", "q90")})


@job(
    "quantile_elements",
    """SELECT quantile_disc(o_totalprice, 0.5) AS q50, quantile_disc(o_totalprice, 0.99) AS q99 FROM orders""",
)
def quantile_elements(t: Tables) -> DataFrame:
    """Quantiles that are elements of the data."""
    return A.quantiles(t.orders, "o_totalprice", {"q50": 0.5, "q99": 0.99}, interpolate=False)


@job(
    "histogram_bins",
    """WITH x AS (SELECT ln(1 + l_extendedprice) AS v FROM lineitem WHERE l_extendedprice > 0),
    b AS (SELECT min(v) AS lo, (max(v) - min(v)) / 100 AS w FROM x)
    SELECT CAST(least(floor((v - lo) / w), 99) AS INTEGER) AS bin, count(*) AS cnt FROM x, b GROUP BY 1""",
)
def histogram_bins(t: Tables) -> DataFrame:
    """100 equal bins of the logarithm after a filter."""
    return A.histogram(t.lineitem.where("l_extendedprice > 0"), F.ln(1 + F.col("l_extendedprice")), 100)


@job(
    "top_values",
    "SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY 1 ORDER BY cnt DESC, l_partkey LIMIT 10",
)
def top_values(t: Tables) -> DataFrame:
    """A31."""
    return R.top_values(t.lineitem, "l_partkey", 10)


@job(
    "target_mean",
    "SELECT lang, round(avg(quality), 6) AS quality_rate, count(*) AS cnt FROM documents JOIN labels USING (doc_id) GROUP BY 1",
)
def target_mean(t: Tables) -> DataFrame:
    """Mean of a target per category."""
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id")
    return rows.groupBy("lang").agg(F.round(F.avg("quality"), 6).alias("quality_rate"), F.count(F.lit(1)).alias("cnt"))


@job(
    "crosstab_pivot",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
    count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""",
)
def crosstab_pivot(t: Tables) -> DataFrame:
    """A33."""
    return A.cross_counts(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@job(
    "confusion_matrix",
    """SELECT quality, toxic, count(*) AS cnt, round(count(*) / sum(count(*)) OVER (PARTITION BY quality), 6) AS share
    FROM labels GROUP BY quality, toxic""",
)
def confusion_matrix(t: Tables) -> DataFrame:
    """Counts and row-normalised shares."""
    return A.confusion(t.labels, "quality", "toxic").withColumn("share", F.round("share", 6))


@job(
    "correlations",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for i, a in enumerate(NUMERIC)
        for b in NUMERIC[i + 1 :]
    ),
)
def correlations(t: Tables) -> DataFrame:
    """A34."""
    return A.correlations(t.lineitem, NUMERIC).withColumn("corr", F.round("corr", 6))


@job(
    "group_all_columns",
    """SELECT l_returnflag, count(*) AS cnt, round(sum(l_quantity), 2) AS l_quantity, round(sum(l_discount), 4) AS l_discount,
    round(sum(l_tax), 4) AS l_tax FROM lineitem GROUP BY 1""",
)
def group_all_columns(t: Tables) -> DataFrame:
    """A35."""
    sums = {"l_quantity": 2, "l_discount": 4, "l_tax": 4}
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("cnt"), *[F.round(F.sum(c), d).alias(c) for c, d in sums.items()]
    )


@job("partition_rows", "SELECT count(*) AS cnt FROM lineitem")
def partition_rows(t: Tables) -> DataFrame:
    """Rows per partition; the layout depends on the cluster, so the query reports their sum."""
    return A.rows_per_partition(t.lineitem).agg(F.sum("cnt").alias("cnt"))


_PARTS = """WITH c AS (SELECT CAST(ts AS DATE) AS day, ['night', 'morning', 'afternoon', 'evening'][CAST(hour(ts) // 6 AS INTEGER) + 1] AS part,
 count(*) AS n FROM events GROUP BY ALL),
 cal AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM c)"""


@job(
    "day_part_means",
    f"""{_PARTS} SELECT 'all' AS weekday, 'all' AS part, round(sum(n) / (SELECT count(*) FROM cal), 6) AS mean_cnt FROM c
    UNION ALL SELECT 'all', part, round(sum(n) / (SELECT count(*) FROM cal), 6) FROM c GROUP BY part
    UNION ALL SELECT 'Wed', part, round(sum(n) / (SELECT count(*) FROM cal WHERE isodow(day) = 3), 6) FROM c
    WHERE isodow(day) = 3 GROUP BY part
    UNION ALL SELECT 'Sun', part, round(sum(n) / (SELECT count(*) FROM cal WHERE isodow(day) = 7), 6) FROM c
    WHERE isodow(day) = 7 GROUP BY part""",
)
def day_part_means(t: Tables) -> DataFrame:
    """A39."""
    return A.mean_per_day(t.events, "ts").withColumn("mean_cnt", F.round("mean_cnt", 6))


@job(
    "count_per_genre",
    """SELECT genre, count(*) AS cnt FROM (SELECT unnest(string_split(p_name, ' ')) AS genre FROM part) GROUP BY 1""",
)
def count_per_genre(t: Tables) -> DataFrame:
    """Items per value of a multi-valued field."""
    return A.value_parts(t.part, "p_name", " ", "genre").groupBy("genre").agg(F.count(F.lit(1)).alias("cnt"))


@job(
    "rowwise_stats",
    """SELECT l_orderkey, l_partkey, l_linenumber, round((l_quantity + l_discount + l_tax) / 3, 6) AS row_mean,
    list_median([l_quantity, l_discount, l_tax]) AS row_median, least(l_quantity, l_discount, l_tax) AS row_min,
    greatest(l_quantity, l_discount, l_tax) AS row_max, round(list_stddev_pop([l_quantity, l_discount, l_tax]), 5) AS row_std
    FROM lineitem""",
)
def rowwise_stats(t: Tables) -> DataFrame:
    """A41."""
    cols = A.rowwise(t.lineitem, ["l_quantity", "l_discount", "l_tax"])
    cols |= {"row_mean": F.round(cols["row_mean"], 6), "row_std": F.round(cols["row_std"], 5)}
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", *[c.alias(n) for n, c in cols.items()])
