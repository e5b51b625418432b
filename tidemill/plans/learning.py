"""Model-fitting jobs on the given tables. Estimators have no SQL twin; each returns its quality against a baseline."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import models as L
from ..operators import neighbours as N
from ..operators import sampling as S
from ..operators import vector_index as V
from ..session import scratch_path
from ..sources import sinks
from ..sources.tables import Tables
from .features import STOP
from .geo import _customers
from .registry import job


def _vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")


_SPLIT = "CAST(('0x' || substr(md5('81-' || vec_id), 1, 8)) AS UBIGINT) / 4294967296.0"


@job(
    "knn_vote",
    f"""WITH q AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE {_SPLIT} >= 0.8),
    t AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings WHERE {_SPLIT} < 0.8),
    d AS (SELECT q.vec_id AS query_id, t.vec_id AS id, label, round(list_distance(q.e, t.e), 9) AS distance FROM q, t),
    n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, id) <= 5),
    v AS (SELECT query_id, label, count(*) AS votes FROM n GROUP BY ALL)
    SELECT query_id, label FROM v QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, label) = 1""",
)
def knn_vote(t: Tables) -> DataFrame:
    """Exact five nearest neighbours and their majority label."""
    train, test = S.split(_vectors(t), "id", [0.8, 0.2], 81)
    return N.vote(N.nearest(train, test, 5), train)


@job("knn_index")
def knn_index(t: Tables) -> DataFrame:
    """Majority label of about the five nearest neighbours, found by inverted lists with an exact last step."""
    train, test = S.split(_vectors(t), "id", [0.8, 0.2], 81)
    index = V.build(train, 5)
    if index is None:
        return test.select(F.col("id").alias("query_id"), "label").limit(0)
    return N.vote(V.search(index, test, 5), train)


@job("knn_index_report")
def knn_index_report(t: Tables) -> DataFrame:
    """What the index of ``knn_index`` compares, and its recall on 200 queries against the exact neighbours."""
    train, test = S.split(_vectors(t), "id", [0.8, 0.2], 81)
    index = V.build(train, 5)
    some = S.take_sample(test, "id", 200, 5)
    return V.report(index, test, V.search(index, some, 5), N.nearest(train, some, 5), 5)


_PTS = """p AS (SELECT c_custkey AS id, 37 + ((c_custkey * 7919) % 10007) / 10007.0::DOUBLE AS x,
 55 + ((c_custkey * 104729) % 10009) / 10009.0::DOUBLE AS y FROM customer)"""


@job(
    "dbscan",
    f"""WITH RECURSIVE {_PTS}, n AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b
    ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.03 * 0.03),
    core AS (SELECT a AS id FROM n GROUP BY 1 HAVING count(*) >= 5),
    e AS (SELECT a, b FROM n WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    r AS (SELECT id, id AS root FROM core UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id WHERE r.root < e.b),
    l AS (SELECT id, min(root) AS cluster FROM r GROUP BY 1),
    bo AS (SELECT n.a AS id, min(cluster) AS cluster FROM n JOIN l ON l.id = n.b WHERE n.a NOT IN (SELECT id FROM core) GROUP BY 1)
    SELECT p.id, coalesce(l.cluster, bo.cluster, -1) AS cluster FROM p LEFT JOIN l ON l.id = p.id LEFT JOIN bo ON bo.id = p.id""",
)
def dbscan(t: Tables) -> DataFrame:
    """Density clusters of places."""
    points = _customers(t).select("id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    return N.density_clusters(points, 0.03, 5)


def _labelled(t: Tables) -> DataFrame:
    return t.labels.join(t.documents.select("doc_id", "text", "lang", "source", "n_chars"), "doc_id").withColumn(
        "label", F.col("quality").cast("double")
    )


@job("document_classes")
def document_classes(t: Tables) -> DataFrame:
    """Language classification by hashed TF-IDF and naive Bayes, against the majority class."""
    return L.classify_text(t.documents.select("doc_id", "text", "lang"), "doc_id", "text", "lang", STOP)


@job("document_classes_bigrams")
def document_classes_bigrams(t: Tables) -> DataFrame:
    """The same with bigrams as a swapped stage."""
    return L.classify_text(t.documents.select("doc_id", "text", "lang"), "doc_id", "text", "lang", STOP, ngram=2)


@job("text_model_grid")
def text_model_grid(t: Tables) -> DataFrame:
    """Hash buckets x smoothing by one split, the best model's labels of the documents without a quality label counted."""
    rows = t.documents.select("doc_id", "text", "lang")
    new = rows.join(t.labels.select("doc_id"), "doc_id", "left_anti").select("doc_id", "text")
    model, table, names = L.choose_text_model(rows, "doc_id", "text", "lang", STOP)
    counts = L.label_of(model, new, names).groupBy("label").agg(F.count(F.lit(1)).alias("cnt"))
    best = table.agg(F.max("accuracy")).first()[0]
    return counts.withColumns({"accuracy": F.lit(best), "points": F.lit(table.count())})


@job("spam_nb")
def spam_nb(t: Tables) -> DataFrame:
    """Quality labels by naive Bayes; accuracy and area against the majority baseline."""
    return L.spam_report(_labelled(t), "doc_id", "text", "label")


@job("best_model")
def best_model(t: Tables) -> DataFrame:
    """Several models compared by test accuracy."""
    return L.compare_text_models(_labelled(t), "doc_id", "text", "label")


def _urls(t: Tables) -> DataFrame:
    """Long pages are the class to be told from the URL alone, which does not define it."""
    feats = urls.features("url")
    scheme = urls.parts("url")["scheme"].alias("scheme")
    label = (F.length("html") > 4000).cast("double").alias("label")
    return t.pages.select("page_id", "url", label, scheme, *[c.alias(n) for n, c in feats.items()])


@job("url_forest")
def url_forest(t: Tables) -> DataFrame:
    """URL features, one-hot scheme and character counts into a random forest; class report."""
    return L.url_report(_urls(t), "page_id", "url", "label", list(urls.features("url")))


@job("url_scores_csv")
def url_scores_csv(t: Tables) -> DataFrame:
    """Batch scores written as CSV with a header and read back."""
    path = scratch_path(t.spark, "scores")
    sinks.write_csv(L.url_scores(_urls(t), "page_id", "url", "label", list(urls.features("url"))), path, header=True)
    return sinks.read_back(t.spark, path, "page_id long, prediction double", header=True)


def _net() -> Column:
    """Price paid for a line, which its list price and rates explain but not linearly."""
    return F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))


@job("price_regression")
def price_regression(t: Tables) -> DataFrame:
    """Two features, cross-validated elastic net, mae and r2 on the test part, training summary."""
    rows = t.lineitem.select(
        F.concat_ws(":", "l_orderkey", "l_partkey", "l_linenumber").alias("k"), "l_extendedprice", "l_discount", _net().alias("label")
    )
    return L.elastic_net_report(rows, "k", ["l_extendedprice", "l_discount"], "label")


@job("purchase_regression")
def purchase_regression(t: Tables) -> DataFrame:
    """Fill, encode, assemble; mean baseline, forest and boosted trees."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"), F.sum(_net()).alias("label")
    )
    rows = t.orders.join(lines, "o_orderkey").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", F.month("o_orderdate").alias("month"),
        F.nullif(F.weekday("o_orderdate"), F.lit(6)).alias("weekday"), "lines", "quantity", "label",
    ).na.fill({"weekday": -1})
    return L.tree_regression_report(
        rows, "o_orderkey", ["o_orderstatus", "o_orderpriority"], ["month", "weekday", "lines", "quantity"], "label"
    )


@job("duration_regression")
def duration_regression(t: Tables) -> DataFrame:
    """Indexed and one-hot origin plus a number; train-validation grid; model saved and loaded."""
    rows = t.part.select(
        "p_partkey", "p_type", (F.col("p_partkey") % 1000).cast("double").alias("p_size"), F.col("p_retailprice").alias("label")
    )
    path = scratch_path(t.spark, "model")
    return L.grid_regression_report(rows, "p_partkey", ["p_type"], ["p_size"], "label", path)


@job("libsvm_regression")
def libsvm_regression(t: Tables) -> DataFrame:
    """Regression on a libsvm scan with a twelve-point grid."""
    from ..sources.files import read_libsvm

    path = scratch_path(t.spark, "libsvm")
    rows = t.embeddings.select(
        F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    rows.write.format("libsvm").save(path)
    return L.vector_regression_grid(read_libsvm(t.spark, path, 64))


@job("kmeans")
def kmeans(t: Tables) -> DataFrame:
    """K-means; cluster sizes and cost."""
    return L.kmeans_report(_vectors(t), 10)


@job("gaussian_mixture")
def gaussian_mixture(t: Tables) -> DataFrame:
    """Gaussian mixture on two coordinates; component sizes."""
    return L.mixture_report(t.part.select(F.col("p_partkey").alias("id"), "p_size", (F.col("p_retailprice") / 100).alias("price")), ["p_size", "price"], 3)


@job("forest_classes")
def forest_classes(t: Tables) -> DataFrame:
    """Classifiers on dense vectors, test accuracy each and of the majority class."""
    rows = _vectors(t).withColumn("features", array_to_vector("vec")).select("id", "features", F.col("label").cast("double").alias("label"))
    return L.compare_vector_models(rows, "id", 64, 10)


@job("mixed_baseline")
def mixed_baseline(t: Tables) -> DataFrame:
    """Mode-imputed and one-hot categories into logistic regression; accuracy and F1."""
    rows = _labelled(t).select("doc_id", F.nullif(F.col("lang"), F.lit("de")).alias("lang"), "source", "n_chars", "label")
    return L.mixed_pipeline_report(rows, "doc_id", "lang", ["source"], ["n_chars"], "label")


@job("home_models")
def home_models(t: Tables) -> DataFrame:
    """One-feature against extended-feature regression and a tree, test mse each."""
    rows = t.lineitem.select(
        F.concat_ws(":", "l_orderkey", "l_partkey", "l_linenumber").alias("k"), "l_extendedprice", "l_discount", "l_tax", _net().alias("label")
    )
    return L.nested_models_report(rows, "k", ["l_extendedprice"], ["l_extendedprice", "l_discount", "l_tax"], "label")


@job(
    "linear_scores",
    """SELECT l_orderkey, l_partkey, l_linenumber, round(10 + 3 * l_quantity - 50 * l_discount, 6) AS score FROM lineitem""",
)
def linear_scores(t: Tables) -> DataFrame:
    """Batch scoring over Arrow batches with parameters shipped once per worker."""
    import numpy as np

    from ..functions.udfs import scorer

    score = scorer({"w": np.array([3.0, -50.0]), "b": np.array([10.0])}, lambda p, x: x @ p["w"] + p["b"][0])
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount")
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", F.round(score("l_quantity", "l_discount"), 6).alias("score"))
