"""Projections, filters, null handling, sources and sinks on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import udfs
from ..operators import relational as R
from ..session import scratch_path
from ..sources import files, sinks
from ..sources.tables import Tables
from .registry import job


@job(
    "project_rename",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_acctbal + 1 AS balance_plus_one,
       c_mktsegment AS segment FROM customer""",
)
def project_rename(t: Tables) -> DataFrame:
    """Project, drop, compute, rename."""
    return (
        t.customer.drop("c_nationkey")
        .select("*", (F.col("c_acctbal") + 1).alias("balance_plus_one"))
        .withColumnRenamed("c_custkey", "id")
        .withColumnsRenamed({"c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"})
    )


@job(
    "filter_predicates",
    """SELECT p_partkey, p_name, p_size FROM part
       WHERE (p_size > 10 AND p_type = 'ECONOMY') OR lower(p_name) LIKE '%ring%'""",
)
def filter_predicates(t: Tables) -> DataFrame:
    """AND / OR and case-insensitive LIKE."""
    wanted = ((F.col("p_size") > 10) & (F.col("p_type") == "ECONOMY")) | F.lower("p_name").like("%ring%")
    return t.part.where(wanted).select("p_partkey", "p_name", "p_size")


@job(
    "case_label",
    """SELECT l_orderkey, l_partkey, l_linenumber,
       CASE WHEN nullif(l_tax, 0.0) > 0.04 THEN 1 ELSE 0 END AS high_tax,
       CASE WHEN coalesce(nullif(l_tax, 0.0), 0.0) < 0.05 THEN 'F' ELSE 'A' END AS grade FROM lineitem""",
)
def case_label(t: Tables) -> DataFrame:
    """NULL compares as not greater; for the letter NULL is filled first."""
    tax = F.nullif(F.col("l_tax"), F.lit(0.0))
    high = F.when(tax > 0.04, True).otherwise(False)
    grade = udfs.letter(F.coalesce(tax, F.lit(0.0)), 0.05)
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", high.cast("int").alias("high_tax"), grade.alias("grade")
    )


@job(
    "replace_values",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open'
       ELSE o_orderstatus END AS status FROM orders""",
)
def replace_values(t: Tables) -> DataFrame:
    """Value replacement list to list."""
    return (
        t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
        .na.replace(["P", "F", "O"], ["pending", "filled", "open"], ["status"])
    )


def _holes(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_quantity",
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag"),
    )


HOLES = """(SELECT l_orderkey, l_partkey, l_quantity, nullif(l_tax, 0.0) AS tax, nullif(l_discount, 0.0) AS discount,
 nullif(l_returnflag, 'R') AS flag FROM lineitem)"""


@job("null_drop_any", f"SELECT * FROM {HOLES} WHERE tax IS NOT NULL AND discount IS NOT NULL AND flag IS NOT NULL")
def null_drop_any(t: Tables) -> DataFrame:
    """P15 how=any."""
    return _holes(t).na.drop("any")


@job("null_drop_all", f"SELECT * FROM {HOLES} WHERE tax IS NOT NULL OR discount IS NOT NULL")
def null_drop_all(t: Tables) -> DataFrame:
    """P15 how=all over a column subset."""
    return _holes(t).na.drop("all", subset=["tax", "discount"])


@job("null_columns_drop", f"SELECT l_orderkey, l_partkey, l_quantity FROM {HOLES}")
def null_columns_drop(t: Tables) -> DataFrame:
    """Drop the columns with any NULL."""
    return R.drop_null_columns(_holes(t))


@job(
    "null_fill_constant",
    f"SELECT l_orderkey, l_partkey, coalesce(tax, -1.0) AS tax, coalesce(discount, 0.5) AS discount, "
    f"coalesce(flag, 'none') AS flag FROM {HOLES}",
)
def null_fill_constant(t: Tables) -> DataFrame:
    """Fill by constant per column."""
    return _holes(t).drop("l_quantity").na.fill({"tax": -1.0, "discount": 0.5, "flag": "none"})


@job(
    "null_fill_statistic",
    f"""SELECT l_orderkey, l_partkey,
       round(coalesce(tax, (SELECT avg(tax) FROM {HOLES})), 6) AS tax_mean,
       round(coalesce(discount, (SELECT median(discount) FROM {HOLES})), 6) AS discount_median,
       round(coalesce(discount, (SELECT max(discount) FROM {HOLES})), 6) AS discount_max FROM {HOLES}""",
)
def null_fill_statistic(t: Tables) -> DataFrame:
    """Fill by mean, median and max."""
    df = _holes(t).select(
        "l_orderkey",
        "l_partkey",
        F.col("tax").alias("tax_mean"),
        F.col("discount").alias("discount_median"),
        F.col("discount").alias("discount_max"),
    )
    df = R.fill_with_statistic(df, ["tax_mean"], "mean")
    df = R.fill_with_statistic(df, ["discount_median"], "median")
    df = R.fill_with_statistic(df, ["discount_max"], "max")
    return df.select(
        "l_orderkey", "l_partkey", *[F.round(c, 6).alias(c) for c in ("tax_mean", "discount_median", "discount_max")]
    )


@job(
    "null_fill_mode",
    f"""SELECT l_orderkey, l_partkey, coalesce(flag, (SELECT flag FROM {HOLES} WHERE flag IS NOT NULL
       GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)) AS flag FROM {HOLES}""",
)
def null_fill_mode(t: Tables) -> DataFrame:
    """Fill by the most frequent value."""
    return R.fill_with_mode(_holes(t).select("l_orderkey", "l_partkey", "flag"), ["flag"])


@job(
    "null_counts",
    f"""SELECT count(*) FILTER (tax IS NULL) AS tax, count(*) FILTER (discount IS NULL) AS discount,
       count(*) FILTER (flag IS NULL) AS flag FROM {HOLES}""",
)
def null_counts(t: Tables) -> DataFrame:
    """P20: NULLs per column in one pass."""
    return R.null_counts(_holes(t), ["tax", "discount", "flag"])


@job("drop_by_key", "SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)")
def drop_by_key(t: Tables) -> DataFrame:
    """Drop the rows whose key is listed."""
    return R.drop_by_key(t.documents, t.labels.where("quality = 0"), "doc_id")


@job(
    "in_list",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer "
    "WHERE c_mktsegment = 'BUILDING') AND o_orderstatus IN ('F', 'O')",
)
def in_list(t: Tables) -> DataFrame:
    """IN over a literal list and over a listed table."""
    listed = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey")
    rows = t.orders.where(F.col("o_orderstatus").isin("F", "O")).select("o_orderkey", "o_custkey")
    return R.in_list(rows, "o_custkey", listed)


@job(
    "sql_view",
    "SELECT c_mktsegment AS segment, count(*) AS cnt FROM customer WHERE c_acctbal > 4 GROUP BY c_mktsegment",
)
def sql_view(t: Tables) -> DataFrame:
    """A temporary view queried by SQL text (names resolve case-insensitively)."""
    t.customer.createOrReplaceTempView("tidemill_customer")
    return t.spark.sql(
        "SELECT C_MKTSEGMENT AS segment, count(*) AS cnt FROM tidemill_customer WHERE C_AcctBal > 4 GROUP BY 1"
    )


@job(
    "sql_function_letters",
    """SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_quantity < 25 THEN 'F' ELSE 'A' END AS letter
       FROM lineitem""",
)
def sql_function_letters(t: Tables) -> DataFrame:
    """A function registered for SQL text, used in a projection expression."""
    udfs.register_letter(t.spark, "tidemill_letter", 25)
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return rows.selectExpr("l_orderkey", "l_partkey", "l_linenumber", "tidemill_letter(l_quantity) AS letter")


@job(
    "arrow_udf_amount",
    """SELECT l_orderkey, l_partkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS amount
       FROM lineitem""",
)
def arrow_udf_amount(t: Tables) -> DataFrame:
    """A several-column vectorised function."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount")
    amount = udfs.discounted("l_extendedprice", "l_discount")
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", F.round(amount, 4).alias("amount"))


@job(
    "json_props",
    """SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events WHERE CAST(props->>'$.k' AS BIGINT) >= 50""",
)
def json_props(t: Tables) -> DataFrame:
    """Typed parse of JSON text; records that miss the field or are malformed are skipped."""
    parsed = F.from_json("props", "k long").getField("k")
    return t.events.select("event_id", parsed.alias("k")).where(F.coalesce(F.col("k") >= 50, F.lit(False)))


@job(
    "csv_roundtrip",
    """SELECT c_custkey AS id, nullif(c_mktsegment, 'MACHINERY') AS segment, c_acctbal AS balance FROM customer""",
)
def csv_roundtrip(t: Tables) -> DataFrame:
    """CSV written with a null token and read back by schema."""
    path = scratch_path(t.spark, "csv")
    rows = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    sinks.write_csv(rows, path, header=True, null_value="null")
    return files.read_csv(t.spark, f"{path}/part*", "id long, segment string, balance double", header=True)


@job(
    "text_roundtrip",
    "SELECT p_type || chr(9) || CAST(count(*) AS VARCHAR) AS value FROM part GROUP BY p_type",
)
def text_roundtrip(t: Tables) -> DataFrame:
    """key<TAB>value report lines."""
    path = scratch_path(t.spark, "text")
    sinks.write_pairs(t.part.groupBy("p_type").count(), path, "p_type", "count")
    return files.read_lines(t.spark, path)


@job(
    "delimited_by_hand",
    """SELECT n_nationkey AS id, n_name AS name, CASE WHEN n_regionkey = 0 THEN NULL ELSE n_regionkey END AS region
       FROM nation""",
)
def delimited_by_hand(t: Tables) -> DataFrame:
    """Split, cast and null tokens by expression."""
    line = F.concat_ws(
        ",", F.col("n_nationkey").cast("string"), "n_name", F.when(F.col("n_regionkey") == 0, "null").otherwise(
            F.col("n_regionkey").cast("string"))
    )
    lines = t.nation.select(line.alias("value"))
    return files.split_records(lines, [("id", "int"), ("name", "string"), ("region", "int")])


@job("libsvm_roundtrip", "SELECT label, CAST(count(*) AS BIGINT) AS cnt FROM embeddings GROUP BY label")
def libsvm_roundtrip(t: Tables) -> DataFrame:
    """Labelled sparse-text vectors written and scanned again."""
    from pyspark.ml.functions import array_to_vector

    path = scratch_path(t.spark, "libsvm")
    rows = t.embeddings.select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )
    rows.write.format("libsvm").save(path)
    return (
        files.read_libsvm(t.spark, path, 64).groupBy(F.col("label").cast("int").alias("label"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


@job(
    "sections_carried",
    """SELECT conv_id AS section, CAST(turn AS BIGINT) AS turn, role FROM conversations""",
)
def sections_carried(t: Tables) -> DataFrame:
    """Many files in which a header line starts each section; its id is carried down."""
    path = scratch_path(t.spark, "sections")
    head = t.conversations.select("conv_id").distinct().select(
        "conv_id", F.lit(-1).cast("long").alias("turn"), F.concat(F.col("conv_id").cast("string"), F.lit(":")).alias("value")
    )
    body = t.conversations.select("conv_id", "turn", F.concat_ws(",", F.col("turn").cast("string"), "role").alias("value"))
    # A section cut by a range boundary would lose its header, so sections are kept whole by hashing.
    lines = head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "turn")
    lines.select("value").write.text(path)
    return files.read_sections(t.spark, path, "turn long, role string")
