"""Feature transforms and closed-form fits."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import features as M
from ..operators import metrics as Q
from ..sources.tables import Tables
from .registry import job

STOP = ["the", "and", "of", "to", "in", "is", "for", "with", "that", "this"]
_IN = ", ".join(f"'{w}'" for w in STOP)
_WORDS = "SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z'']+')) AS word FROM documents"


def _texts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text")


@job(
    "stop_words",
    f"SELECT word, count(*) AS cnt FROM ({_WORDS}) WHERE word NOT IN ({_IN}) GROUP BY 1",
)
def stop_words(t: Tables) -> DataFrame:
    """Tokens left after stop-word removal, counted."""
    model = Pipeline(stages=M.text_stages("text", STOP)[:2]).fit(_texts(t))
    return X.word_count(model.transform(_texts(t)), F.col("words"))


@job(
    "hashing_tf",
    f"""SELECT doc_id, CAST(count(word) AS DOUBLE) AS total FROM documents
    LEFT JOIN (SELECT * FROM ({_WORDS}) WHERE word NOT IN ({_IN})) USING (doc_id) GROUP BY 1""",
)
def hashing_tf(t: Tables) -> DataFrame:
    """Hashed counts; buckets differ by hash function, so each row's total is compared."""
    stages = M.text_stages("text", STOP)[:3]
    done = Pipeline(stages=stages).fit(_texts(t)).transform(_texts(t))
    counts = F.unwrap_udt("tf").getField("values")  # the entries of the sparse vector
    total = F.aggregate(counts, F.lit(0.0), lambda acc, x: acc + x)
    return done.select("doc_id", total.alias("total"))


@job(
    "tfidf_sql",
    f"""WITH w AS ({_WORDS}), tf AS (SELECT doc_id, word, count(*) AS tf FROM w GROUP BY ALL),
    d AS (SELECT word, count(*) AS df FROM tf GROUP BY 1), n AS (SELECT count(*) AS n FROM documents)
    SELECT doc_id, word, tf, round(tf * ln((n + 1) / (df + 1)), 6) AS tfidf FROM tf JOIN d USING (word), n""",
)
def tfidf_sql(t: Tables) -> DataFrame:
    """Exact-vocabulary TF-IDF."""
    out = M.tf_idf(_texts(t), "doc_id", X.letter_tokens("text"))
    return out.withColumn("tfidf", F.round("tfidf", 6))


@job("tfidf_hashed")
def tfidf_hashed(t: Tables) -> DataFrame:
    """Hashed TF-IDF vectors by the pipeline stages (non-zero entries and norm per document)."""
    done = Pipeline(stages=M.text_stages("text", STOP)).fit(_texts(t)).transform(_texts(t))
    arr = F.unwrap_udt("features").getField("values")  # the entries of the sparse vector
    used = F.size(F.filter(arr, lambda x: x != 0))
    norm = F.sqrt(F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x * x))
    return done.select("doc_id", used.alias("entries"), F.round(norm, 6).alias("norm"))


@job(
    "char_counts",
    """SELECT page_id, ch, count(*) AS cnt FROM (SELECT page_id, unnest(string_split(lower(url), '')) AS ch FROM pages) WHERE ch <> '' GROUP BY ALL""",
)
def char_counts(t: Tables) -> DataFrame:
    """Character counts per URL through the fitted vocabulary."""
    rows = t.pages.select("page_id", X.characters("url").alias("chars"))
    model = M.character_stages("chars", "counts").fit(rows)
    letters = F.array(*[F.lit(c) for c in model.vocabulary])  # alphabet of the texts
    pairs = F.arrays_zip(letters.alias("ch"), vector_to_array("counts").alias("n"))
    out = model.transform(rows).select("page_id", F.explode(pairs).alias("p"))
    return out.select("page_id", F.col("p.ch").alias("ch"), F.col("p.n").cast("long").alias("cnt")).where("cnt > 0")


@job(
    "ngrams",
    f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z'']+') AS w FROM documents),
    g AS (SELECT w[i] || ' ' || w[i + 1] AS gram FROM (SELECT w, unnest(range(1, len(w))) AS i FROM w))
    SELECT gram, count(*) AS cnt FROM g GROUP BY 1""",
)
def ngrams(t: Tables) -> DataFrame:
    """Bigram counts."""
    return X.many_word_count(_texts(t), X.letter_tokens("text"), X.bigrams(F.col("tokens")), "gram")


@job(
    "string_index",
    """SELECT source, cnt, row_number() OVER (ORDER BY cnt DESC, source) - 1 AS idx FROM (SELECT source, count(*) AS cnt FROM documents GROUP BY 1)""",
)
def string_index(t: Tables) -> DataFrame:
    """Index by falling frequency."""
    return M.frequency_index(t.documents, "source")


@job(
    "string_index_stage",
    """WITH c AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS idx FROM documents GROUP BY 1)
    SELECT doc_id, CAST(idx AS DOUBLE) AS lang_ix FROM documents JOIN c USING (lang)""",
)
def string_index_stage(t: Tables) -> DataFrame:
    """The pipeline stage gives the same order."""
    rows = t.documents.select("doc_id", "lang")
    stage = M.encoded_stages(["lang"], [])[0]
    return stage.fit(rows).transform(rows).select("doc_id", "lang_ix")


@job(
    "ordinal_codes",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS status_code, idx AS priority_code
    FROM orders JOIN (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS idx FROM (SELECT DISTINCT o_orderpriority FROM orders))
    USING (o_orderpriority)""",
)
def ordinal_codes(t: Tables) -> DataFrame:
    """Fixed codes by map, and codes in sorted order joined on."""
    codes = M.alphabetic_index(t.orders, "o_orderpriority").withColumnRenamed("idx", "priority_code")
    rows = t.orders.select("o_orderkey", "o_orderpriority", M.ordinal("o_orderstatus", {"F": 0, "O": 1, "P": 2}).alias("status_code"))
    return rows.join(codes, "o_orderpriority").select("o_orderkey", "status_code", "priority_code")


@job(
    "one_hot",
    """SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O", CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P" FROM orders""",
)
def one_hot(t: Tables) -> DataFrame:
    """0/1 columns, first value dropped."""
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return M.dummies(rows, "o_orderstatus", ["F", "O", "P"], drop_first=True).drop("o_orderstatus")


@job(
    "assembled",
    """SELECT p_partkey, CAST((SELECT count(DISTINCT p_type) FROM part) + 2 AS INTEGER) AS width,
    round(1 + p_size + p_retailprice, 4) AS total FROM part""",
)
def assembled(t: Tables) -> DataFrame:
    """One-hot vector and numbers in one vector (its width and the sum of its entries)."""
    rows = t.part.select("p_partkey", "p_type", "p_size", "p_retailprice")
    done = Pipeline(stages=M.encoded_stages(["p_type"], ["p_size", "p_retailprice"])).fit(rows).transform(rows)
    arr = vector_to_array("features")
    total = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
    return done.select("p_partkey", F.size(arr).alias("width"), F.round(total, 4).alias("total"))


@job(
    "scale_std",
    """SELECT l_orderkey, l_partkey, l_linenumber, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity,
    round((l_tax - (SELECT avg(l_tax) FROM lineitem)) / (SELECT stddev_pop(l_tax) FROM lineitem), 6) AS l_tax FROM lineitem""",
)
def scale_std(t: Tables) -> DataFrame:
    """Standardised by the population deviation."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax")
    out = M.standardize(rows, ["l_quantity", "l_tax"], ddof=0)
    return out.withColumns({c: F.round(c, 6) for c in ("l_quantity", "l_tax")})


@job(
    "scale_std_stage",
    """SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_samp(p_size) FROM part), 6) AS z FROM part""",
)
def scale_std_stage(t: Tables) -> DataFrame:
    """The pipeline stage, which uses the sample deviation."""
    from pyspark.ml.feature import VectorAssembler

    rows = t.part.select("p_partkey", "p_size")
    stages = [VectorAssembler(inputCols=["p_size"], outputCol="v"), M.scaler_stage("v", "s")]
    done = Pipeline(stages=stages).fit(rows).transform(rows)
    return done.select("p_partkey", F.round(F.get(vector_to_array("s"), F.lit(0)), 6).alias("z"))


@job(
    "scale_minmax",
    """SELECT o_orderkey, round((o_totalprice - (SELECT min(o_totalprice) FROM orders)) / (SELECT max(o_totalprice) - min(o_totalprice) FROM orders), 6) AS o_totalprice FROM orders""",
)
def scale_minmax(t: Tables) -> DataFrame:
    """M11."""
    out = M.min_max(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice"])
    return out.withColumn("o_totalprice", F.round("o_totalprice", 6))


@job(
    "poly2",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity AS x, l_quantity * l_quantity AS xx, l_discount AS y, round(l_quantity * l_discount, 6) AS xy,
    round(l_discount * l_discount, 6) AS yy FROM lineitem""",
)
def poly2(t: Tables) -> DataFrame:
    """Powers and cross terms up to degree 2."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount")
    out = M.polynomial(rows, ["l_quantity", "l_discount"], 2)
    at = lambda i: F.get("poly", F.lit(i))
    return out.select(
        "l_orderkey", "l_partkey", "l_linenumber", at(0).alias("x"), at(1).alias("xx"), at(2).alias("y"),
        F.round(at(3), 6).alias("xy"), F.round(at(4), 6).alias("yy"),
    )


@job(
    "ols_1d",
    """WITH r AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem)
    SELECT 'intercept' AS term, round(i, 3) AS coefficient FROM r UNION ALL SELECT 'l_quantity', round(s, 3) FROM r""",
)
def ols_1d(t: Tables) -> DataFrame:
    """Normal equation from one pass of sums."""
    out = M.least_squares(t.lineitem, ["l_quantity"], "l_extendedprice")
    return out.withColumn("coefficient", F.round("coefficient", 3))


def _descent_sql(steps: int, rate: float, logistic: bool) -> str:
    src = (
        "d AS (SELECT l_discount * 10 AS x, CAST(l_returnflag = 'R' AS DOUBLE) AS y FROM lineitem)"
        if logistic
        else "d AS (SELECT l_discount * 10 AS x, l_quantity / 50 AS y FROM lineitem)"
    )
    parts = [src, "w0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    guess = "1 / (1 + exp(-(a + b * x)))" if logistic else "a + b * x"
    for i in range(1, steps + 1):
        parts.append(
            f"w{i} AS (SELECT any_value(a) - {rate} * avg({guess} - y) AS a, any_value(b) - {rate} * avg(({guess} - y) * x) AS b FROM d, w{i - 1})"
        )
    return (
        "WITH " + ", ".join(parts) + f" SELECT 'intercept' AS term, round(a, 6) AS weight FROM w{steps} UNION ALL SELECT 'x', round(b, 6) FROM w{steps}"
    )


@job("descend_linear", _descent_sql(5, 0.5, False))
def descend_linear(t: Tables) -> DataFrame:
    """Gradient descent on the squared error, five steps."""
    rows = t.lineitem.select((F.col("l_discount") * 10).alias("x"), (F.col("l_quantity") / 50).alias("y"))
    return M.descend(rows, ["x"], "y", 0.5, 5).withColumn("weight", F.round("weight", 6))


@job("descend_logistic", _descent_sql(5, 1.0, True))
def descend_logistic(t: Tables) -> DataFrame:
    """Gradient descent on the logistic loss, five steps."""
    rows = t.lineitem.select(
        (F.col("l_discount") * 10).alias("x"), (F.col("l_returnflag") == "R").cast("double").alias("y")
    )
    return M.descend(rows, ["x"], "y", 1.0, 5, "logistic").withColumn("weight", F.round("weight", 6))


@job(
    "info_gain",
    """WITH c AS (SELECT o_orderpriority AS s, o_orderstatus AS l, count(*) AS n FROM orders GROUP BY ALL), t AS (SELECT sum(n) AS t FROM c),
    h AS (SELECT -sum(n / t * log2(n / t)) AS h FROM (SELECT l, sum(n) AS n FROM c GROUP BY 1), t),
    a AS (SELECT -sum(n / t * log2(n / p)) AS a FROM (SELECT n, sum(n) OVER (PARTITION BY s) AS p FROM c), t)
    SELECT round(h, 8) AS entropy, round(a, 8) AS after, round(h - a, 8) AS gain FROM h, a""",
)
def info_gain(t: Tables) -> DataFrame:
    """M19."""
    out = M.information_gain(t.orders, "o_orderpriority", "o_orderstatus")
    return out.select(*[F.round(c, 8).alias(c) for c in out.columns])


@job("ridge_grid")
def ridge_grid(t: Tables) -> DataFrame:
    """Cross-validated error over a grid of ridge strengths from one pass over the data."""
    rows = t.lineitem.select(F.concat_ws(":", "l_orderkey", "l_partkey", "l_linenumber").alias("k"), "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    return M.ridge_grid(rows, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", [0.0, 1.0, 100.0, 10000.0], 5, "k", 71)


@job(
    "baseline_mean",
    """WITH m AS (SELECT avg(l_quantity) AS m FROM lineitem), b AS (SELECT var_pop(l_quantity) AS v FROM lineitem)
    SELECT round(avg((l_quantity - m) * (l_quantity - m)), 6) AS mse, round(sqrt(avg((l_quantity - m) * (l_quantity - m))), 6) AS rmse,
    round(avg(abs(l_quantity - m)), 6) AS mae, round(1 - avg((l_quantity - m) * (l_quantity - m)) / any_value(v), 6) + 0.0 AS r2 FROM lineitem, m, b""",
)
def baseline_mean(t: Tables) -> DataFrame:
    """The mean as prediction, and its errors."""
    mean = t.lineitem.agg(F.avg("l_quantity").alias("m")).scalar()
    out = Q.regression(t.lineitem.select("l_quantity").withColumn("prediction", mean), "l_quantity", "prediction")
    return out.select(*[(F.round(c, 6) + 0.0).alias(c) for c in out.columns])


@job(
    "baseline_majority",
    """WITH m AS (SELECT o_orderstatus AS m FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT m AS prediction, round(avg(CAST(o_orderstatus = m AS INTEGER)), 6) AS accuracy FROM orders, m GROUP BY 1""",
)
def baseline_majority(t: Tables) -> DataFrame:
    """The most frequent class as prediction."""
    rows = t.orders.select("o_orderstatus").withColumn("prediction", Q.majority(t.orders, "o_orderstatus"))
    hit = F.avg((F.col("o_orderstatus") == F.col("prediction")).cast("int"))
    return rows.groupBy("prediction").agg(F.round(hit, 6).alias("accuracy"))


@job(
    "metrics_regression",
    """SELECT round(avg((l_extendedprice - 2000 * l_quantity) ** 2), 2) AS mse, round(sqrt(avg((l_extendedprice - 2000 * l_quantity) ** 2)), 4) AS rmse,
    round(avg(abs(l_extendedprice - 2000 * l_quantity)), 4) AS mae,
    round(1 - avg((l_extendedprice - 2000 * l_quantity) ** 2) / var_pop(l_extendedprice), 6) AS r2 FROM lineitem""",
)
def metrics_regression(t: Tables) -> DataFrame:
    """M31."""
    rows = t.lineitem.select("l_extendedprice", (2000 * F.col("l_quantity")).alias("p"))
    out = Q.regression(rows, "l_extendedprice", "p")
    digits = {"mse": 2, "rmse": 4, "mae": 4, "r2": 6}
    return out.select(*[F.round(c, d).alias(c) for c, d in digits.items()])


_PRED = """r AS (SELECT quality AS y, CAST(n_chars > 200 AS INTEGER) AS p, n_chars AS s FROM labels JOIN documents USING (doc_id))"""


@job(
    "metrics_binary",
    f"""WITH {_PRED}, c AS (SELECT count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 1) AS fp,
    count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 0 AND p = 0) AS tn FROM r)
    SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
    round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
    round(5 * tp / (5 * tp + 4 * fn + fp), 6) AS f_beta FROM c""",
)
def metrics_binary(t: Tables) -> DataFrame:
    """Quality of a rule classifier."""
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    out = Q.binary(rows.withColumn("p", (F.col("n_chars") > 200).cast("int")), "quality", "p", beta=2.0)
    return out.withColumns({c: F.round(c, 6) for c, k in out.dtypes if k == "double"})


_CURVE = f"""{_PRED}, c AS (SELECT s, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM r GROUP BY 1),
 k AS (SELECT s, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM c WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING))"""


@job(
    "roc_pr_points",
    f"""WITH {_CURVE} SELECT s, pos, neg, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tp / (tp + fp), 6) AS precision,
    round(tp / (SELECT sum(pos) FROM c), 6) AS recall, round(fp / (SELECT sum(neg) FROM c), 6) AS fpr FROM k""",
)
def roc_pr_points(t: Tables) -> DataFrame:
    """Points of the ROC and precision-recall curves."""
    rows = t.labels.join(t.documents.select("doc_id", F.col("n_chars").alias("s")), "doc_id")
    out = Q.curve(rows, "quality", "s")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "fpr")})


@job(
    "roc_pr_auc",
    f"""WITH {_CURVE} SELECT round(sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)), 6) AS roc_auc,
    round(sum(pos * tp / (tp + fp)) / sum(pos), 6) AS average_precision FROM k""",
)
def roc_pr_auc(t: Tables) -> DataFrame:
    """Areas under both curves."""
    rows = t.labels.join(t.documents.select("doc_id", F.col("n_chars").alias("s")), "doc_id")
    out = Q.areas(Q.curve(rows, "quality", "s"))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])
