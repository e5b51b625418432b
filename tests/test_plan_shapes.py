"""Physical plans: what reaches the scan, what combines early, what stays out of Python."""

import math
import re

import pytest
from pyspark.sql import functions as F

from tidemill.functions import udfs
from tidemill.operators import aggregates as A
from tidemill.operators import features as M
from tidemill.operators import recommend as C
from tidemill.operators import relational as R
from tidemill.operators import spatial as P
from tidemill.operators import windows as W
from tidemill.plans import registry
from tidemill.session import fits, shared_dir, small_side
from tidemill.sources.tables import Tables

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    registry.load_all()
    return Tables(spark, BASE)


def test_average_prunes_and_combines(t):
    plan = udfs.plan_text(A.average_by_key(t.lineitem, "l_partkey", "l_quantity", 2))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan
    assert "partial_avg" in plan and "BatchEvalPython" not in plan


def test_filter_is_pushed(t):
    plan = udfs.plan_text(registry.JOBS["union_all"](t))
    assert "GreaterThan(o_totalprice,250000.0)]" in plan and "EqualTo(o_orderpriority,1-URGENT)]" in plan


def test_top_n_limits_before_the_shuffle(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    plan = udfs.plan_text(W.top_per_group(rows, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3))
    assert plan.count("WindowGroupLimit") >= 2


def test_function_forms(t):
    rows = t.lineitem.select("l_quantity")
    native = udfs.plan_text(rows.select(udfs.letter("l_quantity", 25)))
    assert "Python" not in native
    assert "ArrowEvalPython" in udfs.plan_text(rows.select(udfs.discounted("l_quantity", "l_quantity")))
    assert "EvalPython" in udfs.plan_text(rows.select(udfs.letter_row("l_quantity")))
    udfs.register_letter(t.spark, "plan_letter", 25)
    assert "Python" not in udfs.plan_text(rows.selectExpr("plan_letter(l_quantity)"))


def test_top_k_does_not_sort_everything(t):
    assert "TakeOrderedAndProject" in udfs.plan_text(registry.JOBS["topk_desc"](t))


def test_no_job_crosses_tables(t):
    for name in ("avg_with_names", "dim_twice", "word_count_ws", "chi_square_expected", "share_of_total", "outliers_z", "confusion_matrix"):
        plan = udfs.plan_text(registry.JOBS[name](t))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_broadcast_is_checked(spark):
    big = spark.range(50)
    assert fits(big, 50) and not fits(big, 49)
    joined = spark.range(10_000_000).join(small_side(big, 49), "id")
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()


def test_outer_join_never_plans_a_full_join(t):
    c, o = t.customer.select(F.col("c_custkey").alias("k")), t.orders.select(F.col("o_custkey").alias("k"), "o_orderkey")
    assert "FullOuter" not in udfs.plan_text(R.outer_join(c, o, "k", "full"))


def test_shared_folder_comes_from_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir") in shared_dir(spark)


def test_pairs_and_predictions_are_made_where_they_are_added_up(spark):
    ratings = spark.createDataFrame([(u, i, 1.0 + u + i) for u in range(6) for i in range(5) if (u + i) % 3], "user int, item long, rating double")
    plan = udfs.plan_text(C.item_similarity(ratings))
    assert "hashpartitioning(p1#" in plan and not re.search(r"hashpartitioning\(p1#\w+, p2#", plan)
    sims = spark.createDataFrame([(1, 2, 0.5), (2, 3, 0.2)], "p1 long, p2 long, sim double")
    plan = udfs.plan_text(C.recommend(C.predict(ratings, sims), 2))
    assert "hashpartitioning(user#" in plan and not re.search(r"hashpartitioning\(user#\w+, (item|target)#", plan)


def test_words_are_counted_where_their_text_is(spark):
    rows = [(1, "a b a"), (2, "b c"), (1, "a c"), (None, "c"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc long, text string")
    out = M.tf_idf(df, "doc", F.filter(F.split("text", " "), lambda w: w != ""))
    assert not re.search(r"hashpartitioning\(doc#\w+, word#", udfs.plan_text(out))
    got = {(r["doc"], r["word"]): (r["tf"], r["tfidf"]) for r in out.collect()}
    held = {"a": 1, "b": 2, "c": 3}
    counts = {(1, "a"): 3, (1, "b"): 1, (1, "c"): 1, (2, "b"): 1, (2, "c"): 1, (None, "c"): 1}
    assert got == {k: (n, pytest.approx(n * math.log(7 / (held[k[1]] + 1)))) for k, n in counts.items()}


def test_zone_totals_count_trips_once(spark):
    zones = spark.createDataFrame([(1, [[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]])], "zone int, rings array<array<struct<x: double, y: double>>>")
    starts = spark.range(30).select((F.col("id") % 3).alias("s"), (F.col("id") % 3 + 0.5).alias("x"), F.lit(0.5).alias("y"))
    ends = spark.range(10).select((F.col("id") % 2 + 2).alias("s"), (F.col("id") % 2 + 2.5).alias("x"), F.lit(0.5).alias("y"))
    out = P.zone_totals(starts, ends, zones, "s", "zone", "x", "y", 0.7)
    assert [tuple(r) for r in out.collect()] == [(None, 10, 10), (1, 20, 0)]
    assert "Range" not in udfs.plan_text(out)  # what the joins read again is not the trips
