"""Equi-joins of all kinds, role joins and grouped lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import relational as R
from ..sources.tables import Tables
from .registry import job

# Customers of one segment against high-value orders: both sides have unmatched rows.
SIDES = """WITH c AS (SELECT c_custkey AS custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'),
 o AS (SELECT o_custkey AS custkey, o_orderkey FROM orders WHERE o_totalprice > 400000)"""


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    c = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("custkey"), "c_name")
    o = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    return c, o


@job("join_inner", f"{SIDES} SELECT custkey, c_name, o_orderkey FROM c JOIN o USING (custkey)")
def join_inner(t: Tables) -> DataFrame:
    """J01, J06."""
    c, o = _sides(t)
    return c.join(o, "custkey")


@job("join_left", f"{SIDES} SELECT custkey, c_name, o_orderkey FROM c LEFT JOIN o USING (custkey)")
def join_left(t: Tables) -> DataFrame:
    """J03."""
    return R.outer_join(*_sides(t), "custkey", "left")


@job("join_right", f"{SIDES} SELECT custkey, c_name, o_orderkey FROM c RIGHT JOIN o USING (custkey)")
def join_right(t: Tables) -> DataFrame:
    """J04."""
    return R.outer_join(*_sides(t), "custkey", "right")


@job("join_full", f"{SIDES} SELECT custkey, c_name, o_orderkey FROM c FULL JOIN o USING (custkey)")
def join_full(t: Tables) -> DataFrame:
    """J02."""
    return R.outer_join(*_sides(t), "custkey", "full")


@job("join_semi", f"{SIDES} SELECT custkey, c_name FROM c WHERE custkey IN (SELECT custkey FROM o)")
def join_semi(t: Tables) -> DataFrame:
    """J05."""
    return R.semi_join(*_sides(t), "custkey")


@job(
    "cogroup_lists",
    f"""{SIDES},
    a AS (SELECT custkey, (row_number() OVER (PARTITION BY custkey ORDER BY c_name) - 1) // 2 AS piece, c_name FROM c),
    b AS (SELECT custkey, (row_number() OVER (PARTITION BY custkey ORDER BY o_orderkey) - 1) // 2 AS piece, o_orderkey FROM o),
    ga AS (SELECT custkey, piece, string_agg(c_name, ',' ORDER BY c_name) AS names FROM a GROUP BY ALL),
    gb AS (SELECT custkey, piece, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS order_keys FROM b GROUP BY ALL)
    SELECT custkey, piece, coalesce(names, '') AS names, coalesce(order_keys, '') AS order_keys
    FROM ga FULL JOIN gb USING (custkey, piece)""",
)
def cogroup_lists(t: Tables) -> DataFrame:
    """Both value lists per key, in pieces of bounded length."""
    c, o = _sides(t)
    lists = R.cogroup_lists(c, o, "custkey", "c_name", "o_orderkey", chunk=2)
    return lists.select(
        "custkey",
        "piece",
        F.array_join("left_values", ",").alias("names"),
        F.array_join(F.col("right_values").cast("array<string>"), ",").alias("order_keys"),
    )


@job(
    "join_two_keys",
    """WITH s AS (SELECT l_partkey, l_suppkey, count(*) AS cnt FROM lineitem GROUP BY ALL),
    r AS (SELECT l_partkey AS pk, l_suppkey AS sk, count(*) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
    SELECT l_partkey, l_suppkey, cnt, returned FROM s JOIN r ON l_partkey = pk AND l_suppkey = sk""",
)
def join_two_keys(t: Tables) -> DataFrame:
    """Two keys under different names."""
    sold = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("cnt"))
    back = (
        t.lineitem.where("l_returnflag = 'R'")
        .groupBy(F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"))
        .agg(F.count(F.lit(1)).alias("returned"))
    )
    return sold.join(back, (F.col("l_partkey") == F.col("pk")) & (F.col("l_suppkey") == F.col("sk"))).drop("pk", "sk")


@job(
    "dim_twice",
    """SELECT b.n_name AS buyer_n_name, s.n_name AS seller_n_name, count(*) AS cnt
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation b ON c_nationkey = b.n_nationkey
    JOIN nation s ON s_nationkey = s.n_nationkey GROUP BY ALL""",
)
def dim_twice(t: Tables) -> DataFrame:
    """One dimension joined under two roles."""
    lines = (
        t.lineitem.select("l_orderkey", "l_suppkey")
        .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    # One row per nation pair before the names are joined.
    flows = lines.groupBy("c_nationkey", "s_nationkey").agg(F.count(F.lit(1)).alias("cnt"))
    named = R.join_roles(flows, t.nation, "n_nationkey", {"buyer": "c_nationkey", "seller": "s_nationkey"}, ["n_name"])
    return named.select("buyer_n_name", "seller_n_name", "cnt")


@job(
    "join_on_row_key",
    "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def join_on_row_key(t: Tables) -> DataFrame:
    """Columns of aligned tables put side by side by row key."""
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id")


@job(
    "avg_with_names",
    """SELECT l_partkey, p_name, round(avg_value, 6) AS avg_value, cnt FROM
    (SELECT l_partkey, avg(l_quantity) AS avg_value, count(l_quantity) AS cnt FROM lineitem GROUP BY 1) a
    JOIN part ON p_partkey = l_partkey WHERE cnt > 2 ORDER BY cnt DESC, l_partkey LIMIT 100""",
)
def avg_with_names(t: Tables) -> DataFrame:
    """Average per product, names joined afterwards, best-supported first."""
    means = A.average_by_key(t.lineitem, "l_partkey", "l_quantity", min_count=2)
    names = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    named = R.attach_names(means, names, "l_partkey")
    return named.select("l_partkey", "p_name", F.round("avg_value", 6).alias("avg_value"), "cnt").orderBy(
        F.desc("cnt"), "l_partkey"
    ).limit(100)
