"""Collaborative filtering and association rules.

Item pairs are summed over users in two exact ways. A user with few ratings sends its list, bounded by that
limit, to the tasks of its items, which make the pairs. The ratings of a heavier user never meet as
pairs of rows: they are laid out as matrix blocks (item block x item block x user slice) and each
block adds up all its users inside one task, emitting one row per item pair.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from math import ceil, sqrt
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, fits, release_shuffles, shuffle_width, small_side
from .ordered import row_numbers
from .sampling import folds as folds_of
from .sampling import split_column, take_sample
from .top_products import Found, top_products
from .windows import top_per_group

LIGHT_USER = 256
BLOCK_ITEMS = 1024
GROUP_ROWS = 1_000_000
USERS_AT_ONCE = 2048
#: Pairs that one task makes, about.
TASK_PAIRS = 2_000_000
#: Pairs, or candidates of predictions, whose shuffles lie on disk at a time where only the best of each item or user are kept, about.
PAIRS_AT_ONCE = 400_000_000
#: Neighbours of an item that go with a rating in one row, about.
NEAR_PIECE = 256
#: Blocks of users and of items that a factorisation has at least, and ratings of a block, about.
BLOCKS, BLOCK_RATINGS = 10, 4_000_000
#: Factorisations of so few blocks that are fitted side by side.
FITS_AT_ONCE = 4


def ratings_of(df: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """(user, item, rating) with one averaged rating per pair, materialised because it is read many times."""
    rows = df.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).cast("double").alias("rating"))
    means = rows.groupBy("user", "item").agg(F.avg("rating").alias("rating"))
    # The pair joins multiply these rows, so they keep the full width however few bytes they are.
    return cut_lineage(means.repartition(shuffle_width(df.sparkSession), "user", "item"))


def pair_sums(
    ratings: DataFrame, light: int = LIGHT_USER, block: int = BLOCK_ITEMS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """For every item pair p1 < p2 rated by a common user: ``dot``, the number of co-raters ``n`` and the
    squared norms ``s1``, ``s2`` over the co-raters. ``ratings`` has one row per (user, item)."""
    return pair_slices(ratings, light, block, group_rows, None)[0]


def pair_slices(
    ratings: DataFrame,
    light: int = LIGHT_USER,
    block: int = BLOCK_ITEMS,
    group_rows: int = GROUP_ROWS,
    at_once: int | None = PAIRS_AT_ONCE,
) -> list[DataFrame]:
    """``pair_sums`` in slices by p1, each with about ``at_once`` of the pairs of light users, so that one can be used up
    and its shuffles deleted before the next is asked for."""
    known, degrees = _known(ratings)
    heavy_users = degrees.where(F.col("d") > light).select("user")
    few, heavy = known, None
    if not fits(heavy_users, 0):
        names = small_side(heavy_users)
        few = known.join(names, "user", "left_anti")
        heavy = _blocked_pairs(known.join(names, "user", "left_semi"), block, group_rows)
        degrees = degrees.where(F.col("d") <= light)
    total = _pairs(degrees)
    slices = max(1, ceil(total / at_once)) if at_once else 1
    if slices == 1:
        return [_added(_list_pairs(_lists(few, total), total), heavy)]
    lists, heavy, out = cut_lineage(_lists(few, total)), heavy and cut_lineage(heavy), []
    for number in range(slices):
        mine = F.pmod(F.xxhash64("p1", F.lit("slice")), F.lit(slices)) == number
        out.append(_added(_list_pairs(lists, total // slices, mine), heavy and heavy.where(mine)))
    return out


def _known(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ratings without null ids, and (user, d) with how many each user has."""
    known = ratings.where("user is not null and item is not null")
    return known, known.groupBy("user").agg(F.count(F.lit(1)).alias("d"))


def _pairs(degrees: DataFrame) -> int:
    return degrees.agg(F.sum(F.expr("d * (d - 1) div 2"))).first()[0] or 0


def _joined_pairs(ratings: DataFrame, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """All pairs of all users, taken as light ones."""
    known, degrees = _known(ratings)
    total = _pairs(degrees)
    return _list_pairs(_lists(known, total, task_pairs), total, None, task_pairs)


def _added(sums: DataFrame, more: DataFrame | None) -> DataFrame:
    if more is None:
        return sums
    return sums.unionByName(more).groupBy("p1", "p2").agg(*[F.sum(c).alias(c) for c in ("dot", "n", "s1", "s2")])


def _lists(ratings: DataFrame, total: int, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(user, l): the user's ratings as one list, sorted by item; they come to ``total`` pairs."""
    tasks = max(shuffle_width(ratings.sparkSession), ceil(total / task_pairs))
    rows = ratings.repartition(tasks, "user").groupBy("user")
    return rows.agg(F.sort_array(F.collect_list(F.struct("item", "rating"))).alias("l"))


def _list_pairs(lists: DataFrame, total: int, mine: Column | None = None, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """The pairs of users with few ratings, by the smaller item; of the items that meet ``mine`` only, if it is given.

    Each rating goes to the task of its item with the rest of the user's sorted list as two arrays. All pairs of an item are
    made and added up there, so neither pairs nor partial sums are shuffled. The number of tasks follows the number of
    pairs, and an item with more pairs than a task should hold is split by its partners.
    """
    tasks = max(shuffle_width(lists.sparkSession), ceil(total / task_pairs))
    placed = lists.select(F.posexplode("l").alias("at", "own"), F.col("l.item").alias("p2"), F.col("l.rating").alias("v2"))
    rest = [F.slice(c, F.col("at") + 2, F.size("p2")).alias(c) for c in ("p2", "v2")]
    rows = placed.select(F.col("own.item").alias("p1"), F.col("own.rating").alias("v1"), *rest).where(F.size("p2") > 0)
    if mine is not None:
        rows = rows.where(mine)
    keys = ["p1"]
    if total > task_pairs:
        loads = rows.groupBy("p1").agg(F.ceil(F.sum(F.size("p2")) / task_pairs).cast("int").alias("parts"))
        hot = cut_lineage(loads.where("parts > 1"))
        if not fits(hot, 0):
            keys.append("part")
            split = rows.join(small_side(hot), "p1", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
            split = split.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            mine = F.filter(F.arrays_zip("p2", "v2"), lambda x: F.pmod(F.xxhash64(x.p2), F.col("parts")) == F.col("part"))
            split = split.withColumn("of", F.when(F.col("parts") > 1, mine).otherwise(F.arrays_zip("p2", "v2")))
            rows = split.select(*keys, "v1", F.col("of.p2").alias("p2"), F.col("of.v2").alias("v2"))
    pairs = rows.repartition(tasks, *keys).select(*keys, "v1", F.explode(F.arrays_zip("p2", "v2")).alias("o"))
    return (
        pairs.select(*keys, "v1", F.col("o.p2").alias("p2"), F.col("o.v2").alias("v2"))
        .where("p1 < p2")
        .groupBy(*keys, "p2")
        .agg(
            F.sum(F.col("v1") * F.col("v2")).alias("dot"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("v1") * F.col("v1")).alias("s1"),
            F.sum(F.col("v2") * F.col("v2")).alias("s2"),
        )
        .select("p1", "p2", "dot", "n", "s1", "s2")
    )


def _blocked_pairs(ratings: DataFrame, block: int, group_rows: int) -> DataFrame:
    items = ratings.agg(F.count_distinct("item").alias("items")).first()["items"]
    blocks = max(1, ceil(items / block))
    kind = dict(ratings.dtypes)["item"]
    placed = ratings.select("user", "item", "rating", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("b"))
    # A rating meets only the blocks that its user has items in.
    reached = placed.select("user", F.col("b").alias("o")).distinct()
    spread = placed.join(reached, "user").select("user", "item", "rating", "b", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"))
    # A pair of blocks is cut into slices of users by its own number of rows, so a hot item's raters are many groups; a
    # hot user has at most `block` items of each side in one.
    slices = spread.groupBy("bi", "bj").agg(F.ceil(F.count(F.lit(1)) / group_rows).alias("slices"))
    keyed = spread.join(small_side(slices), ["bi", "bj"]).withColumn("s", F.pmod(F.xxhash64("user"), F.col("slices")))

    def gram(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf[pdf.b == pdf.bi]
        right = pdf[pdf.b == pdf.bj]
        users, _ = pd.factorize(pdf.user)
        pdf_user = pd.Series(users, index=pdf.index)
        li, lnames = pd.factorize(left.item)
        ri, rnames = pd.factorize(right.item)
        sums = {c: np.zeros((len(lnames), len(rnames))) for c in ("dot", "n", "s1", "s2")}
        lu, ru = pdf_user[left.index].to_numpy(), pdf_user[right.index].to_numpy()
        lv, rv = left.rating.to_numpy(), right.rating.to_numpy()
        for start in range(0, int(users.max()) + 1, USERS_AT_ONCE):
            a = np.zeros((USERS_AT_ONCE, len(lnames)))
            b = np.zeros((USERS_AT_ONCE, len(rnames)))
            ia, ib = np.zeros_like(a), np.zeros_like(b)
            m = (lu >= start) & (lu < start + USERS_AT_ONCE)
            a[lu[m] - start, li[m]], ia[lu[m] - start, li[m]] = lv[m], 1
            m = (ru >= start) & (ru < start + USERS_AT_ONCE)
            b[ru[m] - start, ri[m]], ib[ru[m] - start, ri[m]] = rv[m], 1
            sums["dot"] += a.T @ b
            sums["n"] += ia.T @ ib
            sums["s1"] += (a * a).T @ ib
            sums["s2"] += ia.T @ (b * b)
        x, y = np.nonzero(sums["n"])
        p1, p2 = np.asarray(lnames)[x], np.asarray(rnames)[y]
        out = pd.DataFrame({"p1": p1, "p2": p2, **{c: v[x, y] for c, v in sums.items()}})
        if pdf.bi.iloc[0] == pdf.bj.iloc[0]:
            return out[out.p1 < out.p2].astype({"n": "int64"})
        turn = (out.p1 > out.p2).to_numpy()
        for one, other in (("p1", "p2"), ("s1", "s2")):
            a, b = out[one].to_numpy(), out[other].to_numpy()
            out[one], out[other] = np.where(turn, b, a), np.where(turn, a, b)
        return out.astype({"n": "int64"})

    schema = f"p1 {kind}, p2 {kind}, dot double, n long, s1 double, s2 double"
    return keyed.groupBy("bi", "bj", "s").applyInPandas(gram, schema)


def item_similarity(ratings: DataFrame, digits: int | None = None, **limits: int) -> DataFrame:
    """Cosine similarity of item pairs p1 < p2 over all ratings of an item.

    Ratings are scaled to unit items first, so a pair's sum over co-raters is its similarity. Items rated 0 throughout have none.
    """
    return similarity_slices(ratings, digits, at_once=None, **limits)[0]


def similarity_slices(ratings: DataFrame, digits: int | None = None, **limits: int | None) -> list[DataFrame]:
    """``item_similarity`` in slices by p1 (see ``pair_slices``)."""
    length = ratings.groupBy("item").agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("length")).where("length > 0")
    unit = ratings.join(length, "item").select("user", "item", (F.col("rating") / F.col("length")).alias("rating"))
    close = F.col("dot")
    slices = pair_slices(cut_lineage(unit), **limits)  # read for the degrees, the loads and the pairs
    return [sums.select("p1", "p2", (F.round(close, digits) if digits else close).alias("sim")) for sums in slices]


def similar_items(ratings: DataFrame, top: int, digits: int | None = None, **limits: int | None) -> DataFrame:
    """``truncate`` of ``item_similarity``, slice by slice: of all pairs, those of one slice are on disk at a time."""
    return reduce(DataFrame.unionByName, [truncate(sims, top) for sims in similarity_slices(ratings, digits, **limits)])


def truncate(sims: DataFrame, top: int) -> DataFrame:
    """Pairs of rank <= ``top`` per p1, ties kept. Only p1's side of the upper triangle is limited.

    Tasks drop what cannot rank before the shuffle; a p1 has at most one pair per item. The short result is
    written, as the prediction reads it in both directions.
    """
    ranked = sims.withColumn("_rank", F.rank().over(Window.partitionBy("p1").orderBy(F.desc("sim"))))
    return cut_lineage(ranked.where(F.col("_rank") <= top).select("p1", "p2", "sim"))


def both_ways(sims: DataFrame) -> DataFrame:
    return sims.unionByName(sims.select(F.col("p2").alias("p1"), F.col("p1").alias("p2"), "sim"))


def predict(ratings: DataFrame, sims: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Similarity-weighted mean of the user's own ratings for each item the user has not rated.

    ``sims`` holds each pair once. Only positive predictions are returned.
    """
    return predict_slices(ratings, sims, users, None)[0]


def predict_slices(
    ratings: DataFrame, sims: DataFrame, users: DataFrame | None = None, at_once: int | None = PAIRS_AT_ONCE
) -> list[DataFrame]:
    """``predict`` in slices of users, each with about ``at_once`` candidates, so that one can be used up and its shuffles deleted
    before the next is asked for."""
    own = ratings.join(small_side(users.select("user").distinct()), "user", "left_semi") if users is not None else ratings
    near = both_ways(sims).select(F.col("p1").alias("item"), F.col("p2").alias("target"), "sim")
    counts = cut_lineage(near.groupBy("item").agg(F.count(F.lit(1)).alias("c")))
    asked = own.groupBy("item").agg(F.count(F.lit(1)).alias("r")).join(counts, "item")
    total = asked.agg(F.sum(F.col("r") * F.col("c"))).first()[0] or 0
    piece = F.pmod(F.xxhash64("target"), F.ceil(F.col("c") / NEAR_PIECE))
    near = near.join(counts, "item").groupBy("item", piece.alias("piece")).agg(F.collect_list(F.struct("target", "sim")).alias("l"))
    near = near.select("item", F.col("l.target").alias("target"), F.col("l.sim").alias("sim"))
    slices = max(1, ceil(total / at_once)) if at_once else 1
    tasks = max(shuffle_width(ratings.sparkSession), ceil(total / slices / TASK_PAIRS))
    if slices == 1:
        return [_predicted(own, near, tasks)]
    own, near, at = cut_lineage(own), cut_lineage(near), F.pmod(F.xxhash64("user", F.lit("slice")), F.lit(slices))
    return [_predicted(own.where(at == number), near, tasks) for number in range(slices)]


def _predicted(own: DataFrame, near: DataFrame, tasks: int) -> DataFrame:
    """Predictions for the users of ``own`` from the lists of ``near`` items."""
    # An own item goes along as a marked target without similarity, so nothing needs to be joined with the predictions.
    marks = own.where("user is not null and item is not null").select(
        "user", F.lit(None).cast("double").alias("rating"), F.array("item").alias("target"),
        F.array(F.lit(None).cast("double")).alias("sim"), F.lit(1).alias("own"),
    )
    rows = own.repartition(tasks, "item").join(near, "item").select("user", "rating", "target", "sim", F.lit(0).alias("own"))
    sent = rows.unionByName(marks).repartition(tasks, "user")
    each = sent.select("user", "rating", "own", F.explode(F.arrays_zip("target", "sim")).alias("o"))
    return (
        each.select("user", F.col("o.target").alias("item"), F.col("o.sim").alias("sim"), "rating", "own")
        .groupBy("user", "item")
        .agg(F.sum(F.col("sim") * F.col("rating")).alias("num"), F.sum("sim").alias("den"), F.max("own").alias("own"))
        .where("own = 0 and den > 0")
        .select("user", "item", (F.col("num") / F.col("den")).alias("prediction"))
        .where("prediction > 0")
    )


def each_slice(slices: Sequence[DataFrame], use: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All rows that ``use`` makes of the slices; where there are several, each is written before the next is worked out."""
    if len(slices) == 1:
        return use(slices[0])
    return reduce(DataFrame.unionByName, [cut_lineage(use(one)) for one in slices])


def recommend(predictions: DataFrame, top: int, digits: int = 6) -> DataFrame:
    """Best ``top`` predictions per user; equal predictions (to ``digits``) go by item."""
    rounded = predictions.withColumn("prediction", F.round("prediction", digits))
    return top_per_group(rounded, ["user"], [F.desc("prediction"), F.asc("item")], top)


def grouped(recommendations: DataFrame) -> DataFrame:
    """One row per user with its ranked items (at most the top N, so the list is bounded)."""
    ordered = F.sort_array(F.collect_list(F.struct("rn", "item", "prediction")))
    return recommendations.groupBy("user").agg(ordered.alias("recommendations"))


def similar_to(ratings: DataFrame, item, top: int, digits: int = 8) -> DataFrame:
    """The items most similar to one item, straight from that item's raters; no pair table is built."""
    squares = ratings.groupBy("item").agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("norm"))
    mine = ratings.where(F.col("item") == item).select("user", F.col("rating").alias("own"))
    dots = (
        ratings.where(F.col("item") != item).join(mine, "user").groupBy("item")
        .agg(F.sum(F.col("rating") * F.col("own")).alias("dot"))
    )
    own_norm = squares.where(F.col("item") == item).select("norm").scalar()
    sims = dots.join(squares, "item").select(
        "item", F.round(F.try_divide(F.col("dot"), own_norm * F.col("norm")), digits).alias("sim")
    )
    return sims.orderBy(F.desc("sim"), "item").limit(top)


def swapped(ratings: DataFrame) -> DataFrame:
    """User and item exchanged, which turns the item-based functions into user-based ones."""
    return ratings.select(F.col("item").alias("user"), F.col("user").alias("item"), "rating")


def squared_errors(predictions: DataFrame, test: DataFrame) -> DataFrame:
    """One row: pairs predicted and tested, how many of them have an error, and the sum of its squares."""
    both = test.select("user", "item", "rating").join(predictions, ["user", "item"])
    err = F.col("rating") - F.col("prediction")
    return both.agg(F.count(F.lit(1)).alias("pairs"), F.count(err).alias("known"), F.sum(err * err).alias("squares"))


def rmse(predictions: DataFrame | Sequence[DataFrame], test: DataFrame) -> DataFrame:
    """One row: pairs predicted and tested, and the root mean squared error over them; ``predictions`` may come in slices."""
    slices = [predictions] if isinstance(predictions, DataFrame) else predictions
    sums = each_slice(slices, lambda one: squared_errors(one, test)).agg(*[F.sum(c).alias(c) for c in ("pairs", "known", "squares")])
    return sums.select("pairs", F.sqrt(F.try_divide("squares", "known")).alias("rmse"))


def knn_on_sample(ratings: DataFrame, users: int, items: int, k: int, seed: int) -> DataFrame:
    """kNN collaborative filtering on a sample of users and items, norms over co-raters only.

    Predicts every unrated sampled pair that has at least one similar rated item, from its ``k`` most similar.
    """
    some_users = take_sample(ratings.select("user").distinct(), "user", users, seed)
    some_items = take_sample(ratings.select("item").distinct(), "item", items, seed + 1)
    rows = cut_lineage(
        ratings.join(small_side(some_users), "user", "left_semi").join(small_side(some_items), "item", "left_semi")
    )
    sim = F.round(F.try_divide(F.col("dot"), F.sqrt(F.col("s1") * F.col("s2"))), 9)
    sims = pair_sums(rows).select("p1", "p2", sim.alias("sim"))
    near = both_ways(sims).select(F.col("p1").alias("item"), F.col("p2").alias("target"), "sim")
    pairs = rows.join(near, "item").join(
        rows.select("user", F.col("item").alias("target")), ["user", "target"], "left_anti"
    )
    best = top_per_group(pairs, ["user", "target"], [F.desc("sim"), F.asc("item")], k)
    return best.groupBy("user", F.col("target").alias("item")).agg(
        (F.sum(F.col("sim") * F.col("rating")) / F.sum("sim")).alias("prediction")
    )


# --- factorisation -------------------------------------------------------------------------------


def dense_ids(ratings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``ratings`` with users and items as ints from 0 (what the factorisation takes, at most 2**31 of each), and the tables
    (user, user_id) and (item, item_id) that lead back."""
    maps = []
    for name in ("user", "item"):
        numbered = row_numbers(ratings.select(name).where(F.col(name).isNotNull()).distinct(), [], [name], f"{name}_id")
        maps.append(cut_lineage(numbered.withColumn(f"{name}_id", (F.col(f"{name}_id") - 1).cast("int"))))
    return _numbered(ratings, *maps), *maps


def _numbered(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``pairs`` with user_id and item_id; -1 for what the maps do not have."""
    out = pairs.join(users, "user", "left").join(items, "item", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("user_id", "item_id")})


class Factors(NamedTuple):
    """A fitted factorisation with its id tables and the mean rating, which unknown users and items get."""

    model: ALSModel
    users: DataFrame
    items: DataFrame
    mean: float | None


def _als(ratings: int, rank: int, reg: float, iterations: int) -> ALS:
    """A factorisation for so many ratings. A task holds a block's ratings and the factors that they meet, so the number of blocks follows the ratings.
    Where there are many, the factors are written in every iteration, upon which Spark deletes the shuffles that led to them."""
    blocks = max(BLOCKS, ceil(ratings / BLOCK_RATINGS))
    return ALS(
        userCol="user_id", itemCol="item_id", ratingCol="rating", rank=rank, maxIter=iterations, regParam=reg, seed=7,
        numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=1 if ratings > BLOCK_RATINGS else 10,
    )


def als_fit(train: DataFrame, rank: int = 10, reg: float = 0.1, iterations: int = 10) -> Factors:
    """Factorisation of (user, item, rating); ids may be of any type."""
    rows, users, items = dense_ids(train)
    count, mean = train.agg(F.count(F.lit(1)), F.avg("rating")).first()
    if count > BLOCK_RATINGS:
        # Blocks are dealt out of one written table, and the joins that gave the ids leave nothing behind.
        rows = cut_lineage(rows.select("user_id", "item_id", "rating"))
        release_shuffles(train.sparkSession)
    model = _als(count, rank, reg, iterations).fit(rows)
    del rows
    release_shuffles(train.sparkSession)
    return Factors(model, users, items, mean)


def als_predict(factors: Factors, test: DataFrame) -> DataFrame:
    """Predictions with unknown users and items at the train mean."""
    raw = factors.model.transform(_numbered(test, factors.users, factors.items))
    known = F.when(F.isnan("prediction"), F.lit(None)).otherwise(F.col("prediction").cast("double"))
    return raw.withColumn("prediction", F.coalesce(known, F.lit(factors.mean))).drop("user_id", "item_id")


def als_choose(ratings: DataFrame, ranks: Sequence[int], regs: Sequence[float], folds: int = 4, iterations: int = 5) -> DataFrame:
    """(rank, reg, pairs, rmse) of each point: all pairs of each fold are scored, unknown users and items at the fold's mean.

    Each fit shuffles the ratings and, in every iteration, factors; its files go before the next fit.
    """
    spark = ratings.sparkSession
    keyed = folds_of(ratings.withColumn("_k", F.concat_ws(":", "user", "item")), "_k", folds, 71).drop("_k").persist()
    total: dict[tuple, list[float]] = {(rank, reg): [0, 0.0] for rank in ranks for reg in regs}
    for fold in range(folds):
        train, test = (keyed.where(c).drop("fold") for c in (F.col("fold") != fold, F.col("fold") == fold))
        rows, users, items = dense_ids(train)
        rows, asked = rows.persist(), _numbered(test, users, items).select("user_id", "item_id", "rating").persist()
        count, mean = train.agg(F.count(F.lit(1)), F.avg("rating")).first()

        def scored(point: tuple[int, float]) -> tuple:
            found = als_error(_als(count, *point, iterations).fit(rows), asked, mean)
            release_shuffles(spark)
            return point, found

        # The many small stages of a fit leave cores idle; where there are many ratings, one fit has enough of its own, and files too.
        with ThreadPool(FITS_AT_ONCE if count <= BLOCK_RATINGS else 1) as pool:
            for point, (n, error) in pool.imap_unordered(inheritable_thread_target(spark)(scored), list(total)):
                sums = total[point]
                sums[0], sums[1] = sums[0] + n, sums[1] + (error or 0.0)
        rows.unpersist(), asked.unpersist()
    keyed.unpersist()
    out = [(rank, reg, n, sqrt(e / n) if n else None) for (rank, reg), (n, e) in total.items()]
    return spark.createDataFrame(out, "rank int, reg double, pairs long, rmse double")


def als_error(model: ALSModel, asked: DataFrame, mean: float | None) -> tuple[int, float | None]:
    """Pairs of ``asked`` (user_id, item_id, rating) and the sum of their squared errors; what the model does not know is at ``mean``."""
    error = F.col("rating") - F.coalesce(F.nanvl("prediction", F.lit(None)), F.lit(mean))
    return tuple(model.transform(asked).agg(F.count(F.lit(1)), F.sum(error * error)).first())


def als_products(factors: Factors, users: DataFrame, top: int) -> Found:
    """The ``top`` items of the given users by the factors, found exactly without all products, and how many were needed."""
    asked = factors.users.join(users.select("user").distinct(), "user", "left_semi")
    mine = factors.model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("vec")).join(asked, "user_id")
    theirs = factors.model.itemFactors.select(F.col("id").alias("item_id"), F.col("features").alias("vec")).join(factors.items, "item_id")
    return top_products(mine.select("user", "vec"), theirs.select("item", "vec"), top)


def als_recommend(factors: Factors, users: DataFrame, top: int) -> DataFrame:
    """(user, pos, item, rating): the ``top`` items of the given users by the factors, ties by item; users without factors get none."""
    found = als_products(factors, users, top).rows
    return found.select("user", (F.col("rn") - 1).alias("pos"), "item", F.col("score").alias("rating"))


# --- association rules -----------------------------------------------------------------------------


def frequent_rows(baskets: DataFrame, min_support: float) -> DataFrame:
    """Distinct (user, item) rows of the items that reach the support; at most
    (mean basket size / support) items are left, which bounds every basket."""
    rows = baskets.select("user", "item").distinct()
    need = rows.agg((F.count_distinct("user") * F.lit(min_support)).alias("n")).scalar()
    counts = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= need)
    return rows.join(counts.select("item"), "item", "left_semi")


def pair_rules(
    baskets: DataFrame, min_support: float, min_confidence: float, min_lift: float = 0.0
) -> DataFrame:
    """One-to-one rules ``antecedent -> consequent`` with support, confidence and lift."""
    baskets = cut_lineage(baskets.select("user", "item").distinct())
    total = baskets.select(F.count_distinct("user").alias("n"))
    rows = cut_lineage(frequent_rows(baskets, min_support))
    counts = rows.groupBy("item").agg(F.count(F.lit(1)).alias("cnt"))
    pairs = pair_sums(rows.withColumn("rating", F.lit(1.0))).select("p1", "p2", "n")
    way = pairs.select(F.col("p1").alias("antecedent"), F.col("p2").alias("consequent"), "n").unionByName(
        pairs.select(F.col("p2").alias("antecedent"), F.col("p1").alias("consequent"), "n")
    )
    n = total.scalar()
    out = (
        way.where(F.col("n") >= n * F.lit(min_support))
        .join(counts.select(F.col("item").alias("antecedent"), F.col("cnt").alias("ca")), "antecedent")
        .join(counts.select(F.col("item").alias("consequent"), F.col("cnt").alias("cc")), "consequent")
        .select(
            "antecedent",
            "consequent",
            (F.col("n") / n).alias("support"),
            (F.col("n") / F.col("ca")).alias("confidence"),
            (F.col("n") / F.col("ca") / (F.col("cc") / n)).alias("lift"),
        )
    )
    return out.where((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))


def association_rules(
    baskets: DataFrame, min_support: float, min_confidence: float, min_lift: float = 0.0
) -> DataFrame:
    """Rules of any length by FP-growth over the baskets pruned to frequent items.

    Baskets and lists are each written once: the counts and the fit read them some ten times.
    """
    baskets = cut_lineage(baskets.select("user", "item").distinct())
    total = baskets.agg(F.count_distinct("user").alias("n")).first()["n"]
    rows = frequent_rows(baskets, min_support)
    lists = cut_lineage(rows.groupBy("user").agg(F.collect_set("item").alias("items")))
    # Baskets that lost all items still count in the support.
    kept = lists.count()
    model = FPGrowth(
        itemsCol="items", minSupport=min(1.0, min_support * total / max(kept, 1)), minConfidence=min_confidence
    ).fit(lists)
    share = F.lit(kept / max(total, 1))
    rules = model.associationRules.withColumns({"support": F.col("support") * share, "lift": F.col("lift") / share})
    return rules.where(F.col("lift") >= min_lift)


def apply_rules(rules: DataFrame, baskets: DataFrame) -> DataFrame:
    """(user, consequent) for every rule whose whole antecedent is in the user's basket.

    ``rules`` has ``antecedent`` and ``consequent`` array columns. The consequents a user already has are left out.
    """
    numbered = rules.select(
        F.array_sort("antecedent").alias("antecedent"), F.explode("consequent").alias("consequent")
    ).distinct()
    need = numbered.select("antecedent", F.size("antecedent").alias("need"), F.explode("antecedent").alias("item"))
    have = baskets.select("user", "item").distinct()
    met = (
        have.join(need.distinct(), "item")
        .groupBy("user", "antecedent")
        .agg(F.count(F.lit(1)).alias("hits"), F.max("need").alias("need"))
        .where("hits = need")
        .select("user", "antecedent")
    )
    suggested = met.join(numbered, "antecedent").select("user", F.col("consequent").alias("item")).distinct()
    return suggested.join(have, ["user", "item"], "left_anti")


def holdout(ratings: DataFrame, share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a repeatable draw per (user, item)."""
    marked = split_column(
        ratings.withColumn("_k", F.concat_ws(":", "user", "item")), "_k", [1 - share, share], seed
    ).drop("_k")
    return marked.where("part = 0").drop("part"), marked.where("part = 1").drop("part")
