"""Recommender and association-rule queries on (customer, part, mean quantity) ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import recommend as C
from ..sources.tables import Tables
from .registry import job

RATINGS = """ratings AS (SELECT o_custkey AS user, l_partkey AS item, avg(l_quantity) AS rating FROM lineitem
 JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""


def _lines(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _ratings(t: Tables) -> DataFrame:
    return C.ratings_of(_lines(t), "o_custkey", "l_partkey", "l_quantity")


def _sim_sql(source: str, user: str = "user", item: str = "item", prefix: str = "") -> str:
    return f"""{prefix}norms AS (SELECT {item} AS item, sqrt(sum(rating * rating)) AS norm FROM {source} GROUP BY 1),
 {prefix}dots AS (SELECT a.{item} AS p1, b.{item} AS p2, sum(a.rating * b.rating) AS dot FROM {source} a
 JOIN {source} b ON a.{user} = b.{user} AND a.{item} < b.{item} GROUP BY ALL),
 {prefix}sims AS (SELECT p1, p2, round(dot / x.norm / y.norm, 8) AS sim FROM {prefix}dots
 JOIN {prefix}norms x ON x.item = p1 JOIN {prefix}norms y ON y.item = p2),
 {prefix}top AS (SELECT p1, p2, sim FROM (SELECT *, rank() OVER (PARTITION BY p1 ORDER BY sim DESC) AS rk FROM {prefix}sims) WHERE rk <= 10)"""


def _pred_sql(source: str) -> str:
    return f"""near AS (SELECT p1 AS item, p2 AS target, sim FROM top UNION ALL SELECT p2, p1, sim FROM top),
 pred AS (SELECT user, target AS item, round(sum(sim * rating) / sum(sim), 6) AS prediction FROM {source}
 JOIN near USING (item) GROUP BY ALL HAVING sum(sim) > 0),
 fresh AS (SELECT p.* FROM pred p ANTI JOIN {source} r ON r.user = p.user AND r.item = p.item WHERE prediction > 0)"""


@job("item_similarity", f"WITH {RATINGS}, {_sim_sql('ratings')} SELECT p1, p2, sim FROM sims")
def item_similarity(t: Tables) -> DataFrame:
    """Cosine of all co-rated item pairs."""
    return C.item_similarity(_ratings(t), digits=8)


@job("similar_topn", f"WITH {RATINGS}, {_sim_sql('ratings')} SELECT p1, p2, sim FROM top")
def similar_topn(t: Tables) -> DataFrame:
    """Ten most similar per item, ties kept."""
    return C.similar_items(_ratings(t), 10, digits=8)


@job(
    "co_rated_pairs",
    f"""WITH {RATINGS} SELECT n, count(*) AS pairs FROM (SELECT a.item AS p1, b.item AS p2, count(*) AS n FROM ratings a
    JOIN ratings b ON a.user = b.user AND a.item < b.item GROUP BY ALL) GROUP BY 1""",
)
def co_rated_pairs(t: Tables) -> DataFrame:
    """Unordered pairs per user, counted; how many pairs share n users."""
    return C.pair_sums(_ratings(t)).groupBy("n").agg(F.count(F.lit(1)).alias("pairs"))


@job(
    "heavy_user_pairs",
    """WITH ratings AS (SELECT l_suppkey AS u, p_brand || ':' || p_size AS item, avg(l_quantity) AS rating FROM lineitem
    JOIN part ON p_partkey = l_partkey GROUP BY ALL)
    SELECT n, count(*) AS pairs, round(sum(dot), 1) AS dot FROM (SELECT a.item AS p1, b.item AS p2, count(*) AS n, sum(a.rating * b.rating) AS dot
    FROM ratings a JOIN ratings b ON a.u = b.u AND a.item < b.item GROUP BY ALL) GROUP BY 1""",
)
def heavy_user_pairs(t: Tables) -> DataFrame:
    """The same for suppliers, who have more kinds of parts than a self-join takes: through matrix blocks."""
    lines = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    kinds = lines.select("l_suppkey", F.concat_ws(":", "p_brand", "p_size").alias("kind"), "l_quantity")
    sums = C.pair_sums(C.ratings_of(kinds, "l_suppkey", "kind", "l_quantity"))
    return sums.groupBy("n").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.sum("dot"), 1).alias("dot"))


@job(
    "cf_predict",
    f"""WITH {RATINGS}, {_sim_sql('ratings')}, {_pred_sql('ratings')} SELECT user, item, prediction, CAST(rn AS INTEGER) AS rn FROM
    (SELECT *, row_number() OVER (PARTITION BY user ORDER BY prediction DESC, item) AS rn FROM fresh) WHERE rn <= 5""",
)
def cf_predict(t: Tables) -> DataFrame:
    """Top five unrated items per user."""
    ratings = _ratings(t)
    sims = C.similar_items(ratings, 10, digits=8)
    return C.each_slice(C.predict_slices(ratings, sims), lambda predictions: C.recommend(predictions, 5))


@job(
    "cf_grouped",
    f"""WITH {RATINGS}, {_sim_sql('ratings')}, {_pred_sql('ratings')} SELECT user, string_agg(CAST(item AS VARCHAR), ',' ORDER BY rn) AS items FROM
    (SELECT *, row_number() OVER (PARTITION BY user ORDER BY prediction DESC, item) AS rn FROM fresh
    WHERE user IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')) WHERE rn <= 3 GROUP BY 1""",
)
def cf_grouped(t: Tables) -> DataFrame:
    """Grouped form for a set of users."""
    ratings = _ratings(t)
    sims = C.similar_items(ratings, 10, digits=8)
    users = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user"))
    lists = C.each_slice(C.predict_slices(ratings, sims, users), lambda predictions: C.grouped(C.recommend(predictions, 3)))
    return lists.select("user", F.array_join(F.col("recommendations.item").cast("array<string>"), ",").alias("items"))


_U = "CAST(('0x' || substr(md5('31-' || user || ':' || item), 1, 8)) AS UBIGINT) / 4294967296.0"


@job(
    "cf_rmse",
    f"""WITH {RATINGS}, train AS (SELECT * FROM ratings WHERE {_U} < 0.8), test AS (SELECT * FROM ratings WHERE {_U} >= 0.8),
    {_sim_sql('train')}, near AS (SELECT p1 AS item, p2 AS target, sim FROM top UNION ALL SELECT p2, p1, sim FROM top),
    pred AS (SELECT user, target AS item, sum(sim * rating) / sum(sim) AS prediction FROM train JOIN near USING (item)
    GROUP BY ALL HAVING sum(sim) > 0)
    SELECT count(*) AS pairs, round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse
    FROM test JOIN pred USING (user, item)""",
)
def cf_rmse(t: Tables) -> DataFrame:
    """Predictions joined with held-out ratings."""
    train, test = C.holdout(_ratings(t), 0.2, 31)
    sims = C.similar_items(train, 10, digits=8)
    out = C.rmse(C.predict_slices(train, sims), test)
    return out.withColumn("rmse", F.round("rmse", 6))


@job("user_similarity", f"WITH {RATINGS}, {_sim_sql('ratings', 'item', 'user')} SELECT p1, p2, sim FROM top")
def user_similarity(t: Tables) -> DataFrame:
    """The same between users."""
    return C.similar_items(C.swapped(_ratings(t)), 10, digits=8)


@job(
    "similar_to_item",
    f"""WITH {RATINGS}, {_sim_sql('ratings')}, s AS (SELECT CASE WHEN p1 = 589 THEN p2 ELSE p1 END AS item, sim FROM sims
    WHERE p1 = 589 OR p2 = 589) SELECT item, p_name, sim FROM s JOIN part ON p_partkey = item ORDER BY sim DESC, item LIMIT 10""",
)
def similar_to_item(t: Tables) -> DataFrame:
    """The ten items most similar to one item, with names."""
    names = t.part.select(F.col("p_partkey").alias("item"), "p_name")
    return C.similar_to(_ratings(t), 589, 10).join(names, "item").select("item", "p_name", "sim")


_PICK = "ORDER BY md5('{s}-' || {c}), {c} LIMIT {n}"


@job(
    "knn_sample",
    f"""WITH {RATINGS}, su AS (SELECT user FROM (SELECT DISTINCT user FROM ratings) {_PICK.format(s=41, c='user', n=200)}),
    si AS (SELECT item FROM (SELECT DISTINCT item FROM ratings) {_PICK.format(s=42, c='item', n=200)}),
    r AS (SELECT * FROM ratings WHERE user IN (SELECT user FROM su) AND item IN (SELECT item FROM si)),
    s AS (SELECT a.item AS p1, b.item AS p2, round(sum(a.rating * b.rating) / sqrt(sum(a.rating * a.rating) * sum(b.rating * b.rating)), 9) AS sim
    FROM r a JOIN r b ON a.user = b.user AND a.item < b.item GROUP BY ALL),
    near AS (SELECT p1 AS item, p2 AS target, sim FROM s UNION ALL SELECT p2, p1, sim FROM s),
    c AS (SELECT r.user, target, sim, rating, row_number() OVER (PARTITION BY r.user, target ORDER BY sim DESC, r.item) AS rn
    FROM r JOIN near USING (item) WHERE NOT EXISTS (SELECT 1 FROM r x WHERE x.user = r.user AND x.item = target))
    SELECT user, target AS item, round(sum(sim * rating) / sum(sim), 6) AS prediction FROM c WHERE rn <= 5 GROUP BY ALL""",
)
def knn_sample(t: Tables) -> DataFrame:
    """Neighbourhood predictions for the unrated pairs of a user and item sample."""
    out = C.knn_on_sample(_ratings(t), 200, 200, 5, 41)
    return out.withColumn("prediction", F.round("prediction", 6))


def _baskets(t: Tables) -> DataFrame:
    """Brands a customer bought in large quantity."""
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("item"))
    big = _lines(t).where("l_quantity >= 40").select(F.col("o_custkey").alias("user"), "l_partkey")
    return big.join(brands, "l_partkey").select("user", "item")


_RULES = """b AS (SELECT DISTINCT o_custkey AS user, p_brand AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 JOIN part ON p_partkey = l_partkey WHERE l_quantity >= 40), n AS (SELECT count(DISTINCT user) AS n FROM b),
 c AS (SELECT item, count(*) AS cnt FROM b GROUP BY 1),
 p AS (SELECT x.item AS antecedent, y.item AS consequent, count(*) AS k FROM b x JOIN b y ON x.user = y.user AND x.item <> y.item GROUP BY ALL),
 rules AS (SELECT antecedent, consequent, k / n AS support, k / ca.cnt AS confidence, k / ca.cnt / (cc.cnt / n) AS lift
 FROM p, n JOIN c ca ON ca.item = antecedent JOIN c cc ON cc.item = consequent
 WHERE k >= n * 0.08 AND k / ca.cnt >= 0.3 AND k / ca.cnt / (cc.cnt / n) >= 1.0)"""


@job(
    "pair_rules",
    f"""WITH {_RULES} SELECT antecedent, consequent, round(support, 6) AS support, round(confidence, 6) AS confidence,
    round(lift, 6) AS lift FROM rules""",
)
def pair_rules(t: Tables) -> DataFrame:
    """One-to-one rules with support, confidence and lift thresholds."""
    out = C.pair_rules(_baskets(t), 0.08, 0.3, 1.0)
    return out.withColumns({c: F.round(c, 6) for c in ("support", "confidence", "lift")})


@job(
    "apply_rules",
    f"""WITH {_RULES} SELECT DISTINCT b.user, consequent AS item FROM b JOIN rules ON b.item = antecedent
    WHERE NOT EXISTS (SELECT 1 FROM b h WHERE h.user = b.user AND h.item = consequent)""",
)
def apply_rules(t: Tables) -> DataFrame:
    """Consequents of the rules whose antecedent is in the basket."""
    baskets = _baskets(t)
    rules = C.pair_rules(baskets, 0.08, 0.3, 1.0).select(
        F.array("antecedent").alias("antecedent"), F.array("consequent").alias("consequent")
    )
    return C.apply_rules(rules, baskets)


@job("association_rules")
def association_rules(t: Tables) -> DataFrame:
    """Rules with antecedents of any length by FP-growth."""
    rules = C.association_rules(_baskets(t), 0.05, 0.3, 1.0)
    return rules.select(
        F.array_join(F.array_sort("antecedent"), ",").alias("antecedent"),
        F.array_join("consequent", ",").alias("consequent"),
        *[F.round(c, 6).alias(c) for c in ("support", "confidence", "lift")],
    )


_AU = _U.replace("'31-'", "'33-'")


@job("als_rmse", f"""WITH {RATINGS}, train AS (SELECT * FROM ratings WHERE {_AU} < 0.8), test AS (SELECT * FROM ratings WHERE {_AU} >= 0.8),
    m AS (SELECT avg(rating) AS m FROM train)
    SELECT count(*) AS pairs, round(sqrt(avg((rating - m) * (rating - m))), 6) AS mean_rmse, TRUE AS in_bounds FROM test, m""")
def als_rmse(t: Tables) -> DataFrame:
    """Matrix factorisation, unknown pairs at the train mean: pairs scored (all), the error of the train mean, and whether that
    of the factors is finite and below twice as much. Fitting draws random numbers, so the error itself is in ``als_error``."""
    return _als_errors(t).select("pairs", "mean_rmse", (F.col("mse") < 4 * F.col("mean_mse")).alias("in_bounds"))


@job("als_error")
def als_error(t: Tables) -> DataFrame:
    """The same with the error of the factors, and whether it is below that of the train mean."""
    beats = (F.col("mse") < F.col("mean_mse")).alias("beats_baseline")
    return _als_errors(t).select("pairs", "mean_rmse", F.round(F.sqrt("mse"), 6).alias("rmse"), beats)


def _als_errors(t: Tables) -> DataFrame:
    train, test = C.holdout(_ratings(t), 0.2, 33)
    factors = C.als_fit(train, rank=10, reg=0.1, iterations=10)
    scored = C.als_predict(factors, test)
    error, own = F.col("rating") - F.lit(factors.mean), F.col("rating") - F.col("prediction")
    sums = scored.where("prediction is not null").agg(
        F.count(F.lit(1)).alias("pairs"), F.avg(error * error).alias("mean_mse"), F.avg(own * own).alias("mse")
    )
    return sums.withColumn("mean_rmse", F.round(F.sqrt("mean_mse"), 6))


@job("als_recommend", f"""WITH {RATINGS} SELECT "user", CAST(unnest(range(least(5, (SELECT count(DISTINCT item) FROM ratings)))) AS INT) AS pos
    FROM (SELECT DISTINCT "user" FROM ratings)""")
def als_recommend(t: Tables) -> DataFrame:
    """Ranks of the top five items of every user, which is what the SQL twin can compare; items and ratings are in
    ``als_recommend_all``, which a test holds against all products of the factors."""
    return als_recommend_all(t).select("user", "pos")


@job("als_recommend_all")
def als_recommend_all(t: Tables) -> DataFrame:
    """Top five items of every user, with the rating by the factors, found by falling length of the items' factors."""
    ratings = _ratings(t)
    return C.als_recommend(C.als_fit(ratings, rank=10, reg=0.1, iterations=10), ratings, 5)


@job("als_recommend_cost")
def als_recommend_cost(t: Tables) -> DataFrame:
    """How many of all products of users and items the exact top five of every user took."""
    ratings = _ratings(t)
    found = C.als_products(C.als_fit(ratings, rank=10, reg=0.1, iterations=10), ratings, 5)
    done = found.rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("user").alias("users"))
    share = F.lit(found.products / max(found.pairs, 1))
    return done.select("users", "rows", F.lit(found.pairs).alias("pairs"), F.round(F.lit(found.products)).cast("long").alias("products"), share.alias("share"))


@job("als_grid")
def als_grid(t: Tables) -> DataFrame:
    """Cross-validated error of each (rank, regularisation) point."""
    return C.als_choose(_ratings(t), [5, 10, 15], [0.001, 0.01, 0.1, 1.0, 10.0], folds=4)


@job("mean_baseline_rmse", f"""WITH {RATINGS}, train AS (SELECT * FROM ratings WHERE {_U} < 0.8),
    test AS (SELECT * FROM ratings WHERE {_U} >= 0.8), m AS (SELECT avg(rating) AS m FROM train)
    SELECT count(*) AS pairs, round(sqrt(avg((rating - m) * (rating - m))), 6) AS rmse FROM test, m""")
def mean_baseline_rmse(t: Tables) -> DataFrame:
    """Train mean as the prediction for every test pair."""
    train, test = C.holdout(_ratings(t), 0.2, 31)
    mean = train.agg(F.avg("rating").alias("m")).scalar()
    out = C.rmse(test.select("user", "item").withColumn("prediction", mean), test)
    return out.withColumn("rmse", F.round("rmse", 6))
