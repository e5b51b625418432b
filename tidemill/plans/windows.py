"""Window, top-k, sampling, partitioning and set queries."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import relational as R
from ..operators import sampling as S
from ..operators import windows as W
from ..sources.tables import Tables
from .registry import job


@job(
    "rank_topn",
    """SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, CAST(rk AS INTEGER) AS rank FROM (SELECT *,
    rank() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC) AS rk FROM lineitem) WHERE rk <= 3""",
)
def rank_topn(t: Tables) -> DataFrame:
    """Rank within group, ties kept."""
    rows = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    return W.rank_per_group(rows, ["l_partkey"], "l_quantity", 3)


@job(
    "topn_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice, CAST(rn AS INTEGER) AS rn FROM (SELECT *,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3""",
)
def topn_per_group(t: Tables) -> DataFrame:
    """Exactly N per group."""
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return W.top_per_group(rows, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


GENRES = """WITH m AS (SELECT genre, l_partkey, count(*) AS cnt, avg(l_quantity) AS mean_value FROM lineitem
 JOIN (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS genre FROM part) ON p_partkey = l_partkey GROUP BY ALL)"""
RANKINGS = {
    "most_rated": ("cnt DESC", "cnt > 0"),
    "least_rated": ("cnt", "cnt > 0"),
    "best_mean": ("round(mean_value, 6) DESC", "cnt > 10"),
    "worst_mean": ("round(mean_value, 6)", "cnt > 10"),
}


@job(
    "genre_rankings",
    GENRES
    + " UNION ALL ".join(
        f""" SELECT * FROM (SELECT '{name}' AS ranking, genre, l_partkey, cnt, round(mean_value, 6) AS mean_value,
        CAST(row_number() OVER (PARTITION BY genre ORDER BY {order}, l_partkey) AS INTEGER) AS rn FROM m WHERE {cond})
        WHERE rn <= 10"""
        for name, (order, cond) in RANKINGS.items()
    ),
)
def genre_rankings(t: Tables) -> DataFrame:
    """Four top-10 rankings per genre."""
    # One row per product before the genres fan out.
    stats = t.lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("cnt"), F.round(F.avg("l_quantity"), 6).alias("mean_value")
    )
    genres = t.part.select(F.col("p_partkey").alias("l_partkey"), F.explode(F.split("p_name", " ")).alias("genre"))
    rows = stats.join(genres.distinct(), "l_partkey")
    orders = {
        "most_rated": (F.desc("cnt"), 0),
        "least_rated": (F.asc("cnt"), 0),
        "best_mean": (F.desc("mean_value"), 10),
        "worst_mean": (F.asc("mean_value"), 10),
    }
    out = None
    for name, (order, least) in orders.items():
        top = W.top_per_group(rows.where(F.col("cnt") > least), ["genre"], [order, F.asc("l_partkey")], 10)
        top = top.select(F.lit(name).alias("ranking"), "genre", "l_partkey", "cnt", "mean_value", "rn")
        out = top if out is None else out.unionByName(top)
    return out


@job(
    "forward_fill",
    """SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER
    (PARTITION BY user_id ORDER BY ts, event_id) AS last_purchase FROM events""",
)
def forward_fill(t: Tables) -> DataFrame:
    """Latest known value carried down."""
    rows = t.events.select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("known")
    )
    out = W.forward_fill(rows, ["user_id"], ["ts", "event_id"], "known", "last_purchase")
    return out.select("event_id", "user_id", "last_purchase")


@job(
    "running_sum_product",
    """SELECT event_id, user_id, round(sum(value) OVER w, 4) AS running_sum,
    round(product(1 + value / 10000) OVER w, 6) AS running_product FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def running_sum_product(t: Tables) -> DataFrame:
    """Running sum and product per key."""
    rows = t.events.select("event_id", "user_id", "ts", "value")
    out = W.running_totals(
        rows,
        ["user_id"],
        ["ts", "event_id"],
        {"running_sum": F.col("value")},
        {"running_product": 1 + F.col("value") / 10000},
    )
    return out.select(
        "event_id", "user_id", F.round("running_sum", 4).alias("running_sum"),
        F.round("running_product", 6).alias("running_product"),
    )


@job(
    "neighbour_diff",
    """SELECT event_id, user_id, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS diff
    FROM events""",
)
def neighbour_diff(t: Tables) -> DataFrame:
    """Difference to the row before."""
    rows = t.events.select("event_id", "user_id", "ts", "value")
    out = W.previous_value(rows, ["user_id"], ["ts", "event_id"], "value", "prev")
    return out.select("event_id", "user_id", F.round(F.col("value") - F.col("prev"), 6).alias("diff"))


DAYS = {"1d": 86_400, "7d": 7 * 86_400, "30d": 30 * 86_400}


@job(
    "rolling_1_7_30d",
    "SELECT event_id, user_id, "
    + ", ".join(
        f"count(*) OVER w{n} AS cnt_{n}, CAST(sum(CAST(value AS DECIMAL(28, 4))) OVER w{n} AS DOUBLE) AS sum_{n}, "
        f"CAST(sum(CAST(value AS DECIMAL(28, 4))) OVER w{n} AS DOUBLE) / count(*) OVER w{n} AS mean_{n}"
        for n in DAYS
    )
    + " FROM events WINDOW "
    + ", ".join(
        f"w{n} AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {s} SECOND PRECEDING AND CURRENT ROW)"
        for n, s in DAYS.items()
    ),
)
def rolling_1_7_30d(t: Tables) -> DataFrame:
    """Count, sum and mean over the last 1, 7 and 30 days per user."""
    out = W.rolling_ranges(t.events, "user_id", "ts", "event_id", "value", DAYS, scale=4)
    cols = []
    for n in DAYS:
        cols += [
            F.col(f"cnt_{n}"),
            F.col(f"sum_{n}"),
            (F.col(f"sum_{n}") / F.col(f"cnt_{n}")).alias(f"mean_{n}"),
        ]
    return out.select("event_id", "user_id", *cols)


@job(
    "index_rows",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders",
)
def index_rows(t: Tables) -> DataFrame:
    """A global row index without a single-task window."""
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return W.row_numbers(rows, [], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "rn")


@job(
    "topk_desc",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def topk_desc(t: Tables) -> DataFrame:
    """T01, T02, T04, T05."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@job("topk_asc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20")
def topk_asc(t: Tables) -> DataFrame:
    """T04 ascending."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey").limit(20)


@job("sorted_rows", "SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def sorted_rows(t: Tables) -> DataFrame:
    """Total order; the key as tie-break lets equal values spread over range partitions."""
    return t.supplier.select("s_suppkey", "s_name", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey")


@job(
    "secondary_sort",
    "SELECT l_partkey, l_quantity, count(*) AS cnt FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2",
)
def secondary_sort(t: Tables) -> DataFrame:
    """Ordered by (key, value) within range partitions."""
    counts = t.lineitem.groupBy("l_partkey", "l_quantity").agg(F.count(F.lit(1)).alias("cnt"))
    return W.secondary_sort(counts, ["l_partkey", "l_quantity"])


U32 = "CAST(('0x' || substr(md5('{seed}-' || {key}), 1, 8)) AS UBIGINT)"


def _u(seed: int, key: str) -> str:
    return U32.format(seed=seed, key=key) + " / 4294967296.0"


@job("sample_rows", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {_u(17, 'o_orderkey')} < 0.1")
def sample_rows(t: Tables) -> DataFrame:
    """T08 without replacement."""
    return S.sample(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 0.1, 17)


@job(
    "resample_rows",
    """WITH p AS (SELECT o_orderkey, """
    + _u(18, "o_orderkey")
    + """ AS u FROM orders), c AS (SELECT sum(exp(-1) / g) OVER (ORDER BY k) AS edge FROM
    (SELECT k, factorial(CAST(k AS INTEGER)) AS g FROM range(13) r(k)))
    SELECT CAST(copies AS INTEGER) AS copies, count(*) AS cnt, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM
    (SELECT o_orderkey, (SELECT count(*) FROM c WHERE edge <= u) AS copies FROM p) WHERE copies > 0 GROUP BY 1""",
)
def resample_rows(t: Tables) -> DataFrame:
    """T08 with replacement: Poisson(1) copies."""
    drawn = S.sample(t.orders.select("o_orderkey"), "o_orderkey", 1.0, 18, with_replacement=True)
    per_row = drawn.groupBy("o_orderkey").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    return per_row.groupBy("copies").agg(F.count(F.lit(1)).alias("cnt"), F.sum("o_orderkey").alias("key_sum"))


@job(
    "take_sample",
    "SELECT o_orderkey FROM orders ORDER BY md5('19-' || o_orderkey), o_orderkey LIMIT 100",
)
def take_sample(t: Tables) -> DataFrame:
    """Fixed-size sample."""
    return S.take_sample(t.orders.select("o_orderkey"), "o_orderkey", 100, 19)


@job(
    "split_rows",
    f"""SELECT CASE WHEN {_u(20, 'o_orderkey')} >= 0.8 THEN 1 ELSE 0 END AS part, count(*) AS cnt,
    CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1""",
)
def split_rows(t: Tables) -> DataFrame:
    """80/20 split."""
    marked = S.split_column(t.orders.select("o_orderkey"), "o_orderkey", [0.8, 0.2], 20)
    return marked.groupBy("part").agg(F.count(F.lit(1)).alias("cnt"), F.sum("o_orderkey").alias("key_sum"))


@job(
    "kfold_counts",
    f"""SELECT CAST({U32.format(seed=21, key='o_orderkey')} % 5 AS INTEGER) AS fold, count(*) AS cnt,
    round(avg(o_totalprice), 4) AS mean_price FROM orders GROUP BY 1""",
)
def kfold_counts(t: Tables) -> DataFrame:
    """T11."""
    out = S.folds(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 5, 21)
    return out.groupBy("fold").agg(
        F.count(F.lit(1)).alias("cnt"), F.round(F.avg("o_totalprice"), 4).alias("mean_price")
    )


@job(
    "rebalanced_classes",
    f"""SELECT o_orderstatus, count(*) AS cnt FROM orders WHERE {_u(22, 'o_orderkey')} <
    CASE o_orderstatus WHEN 'F' THEN 0.2 WHEN 'O' THEN 0.5 ELSE 1.0 END GROUP BY 1""",
)
def rebalanced_classes(t: Tables) -> DataFrame:
    """T18."""
    kept = S.sample_by(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": 0.2, "O": 0.5}, "o_orderkey", 22)
    return kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("cnt"))


@job(
    "partition_map",
    "SELECT l_returnflag, count(*) AS cnt, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY 1",
)
def partition_map(t: Tables) -> DataFrame:
    """A function over whole partitions emits partial sums, which are then merged."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.groupby("l_returnflag").agg(n=("l_quantity", "size"), s=("l_quantity", "sum")).reset_index()

    parts = t.lineitem.select("l_returnflag", "l_quantity").mapInPandas(partial, "l_returnflag string, n long, s double")
    return parts.groupBy("l_returnflag").agg(F.sum("n").alias("cnt"), F.round(F.sum("s"), 2).alias("total"))


@job(
    "pair_values",
    "SELECT p_type, unnest(string_split(p_name, ' ')) AS word, p_size * 2 AS doubled FROM part",
)
def pair_values(t: Tables) -> DataFrame:
    """Keys, mapped values and flattened values of (key, value) rows."""
    return t.part.select("p_type", F.explode(F.split("p_name", " ")).alias("word"), (F.col("p_size") * 2).alias("doubled"))


SETS = """a AS (SELECT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_totalprice > 250000),
 b AS (SELECT o_custkey AS k, o_orderstatus AS s FROM orders WHERE o_orderpriority = '1-URGENT')"""


def _sets(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"), "o_totalprice", "o_orderpriority")
    return rows.where("o_totalprice > 250000").select("k", "s"), rows.where("o_orderpriority = '1-URGENT'").select("k", "s")


@job("union_all", f"WITH {SETS} SELECT * FROM a UNION ALL SELECT * FROM b")
def union_all(t: Tables) -> DataFrame:
    """U01."""
    a, b = _sets(t)
    return a.union(b)


@job("union_distinct", f"WITH {SETS} SELECT * FROM a UNION SELECT * FROM b")
def union_distinct(t: Tables) -> DataFrame:
    """U02."""
    return R.union_distinct(*_sets(t))


@job("intersect_rows", f"WITH {SETS} SELECT * FROM a INTERSECT SELECT * FROM b")
def intersect_rows(t: Tables) -> DataFrame:
    """U03."""
    return R.intersect(*_sets(t))


@job("subtract_rows", f"WITH {SETS} SELECT * FROM a EXCEPT SELECT * FROM b")
def subtract_rows(t: Tables) -> DataFrame:
    """U04."""
    return R.subtract(*_sets(t))


@job("subtract_reverse", f"WITH {SETS} SELECT * FROM b EXCEPT SELECT * FROM a")
def subtract_reverse(t: Tables) -> DataFrame:
    """U04, the other direction."""
    a, b = _sets(t)
    return R.subtract(b, a)
