"""Scalar function groups applied to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls
from ..operators import relational as R
from ..sources.tables import Tables
from .registry import job


@job(
    "string_ops",
    """SELECT p_partkey, p_name || ', ' || p_brand AS label, p_name || nullif(p_type, 'SMALL') AS maybe,
    lower(trim(' ' || p_brand || ' ')) AS brand, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS words,
    length(p_name) AS chars FROM part""",
)
def string_ops(t: Tables) -> DataFrame:
    """Concat (NULL if any part is NULL), split, lower, trim."""
    return t.part.select(
        "p_partkey",
        F.concat("p_name", F.lit(", "), "p_brand").alias("label"),
        F.concat("p_name", F.nullif(F.col("p_type"), F.lit("SMALL"))).alias("maybe"),
        F.lower(F.trim(F.concat(F.lit(" "), "p_brand", F.lit(" ")))).alias("brand"),
        F.size(F.split("p_name", " ")).alias("words"),
        F.size(F.split("p_name", "")).cast("long").alias("chars"),
    )


@job(
    "split_explode",
    "SELECT ch, count(*) AS cnt FROM (SELECT unnest(string_split(lower(p_name), '')) AS ch FROM part) WHERE ch <> '' GROUP BY 1",
)
def split_explode(t: Tables) -> DataFrame:
    """Characters exploded to rows."""
    return X.word_count(t.part, X.characters("p_name"), "ch")


@job(
    "regex_tokens",
    """SELECT word, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z'']+')) AS word FROM documents)
    GROUP BY 1""",
)
def regex_tokens(t: Tables) -> DataFrame:
    """Letters-and-apostrophe tokens."""
    return X.word_count(t.documents, X.letter_tokens("text"))


@job(
    "array_ops",
    """SELECT l_orderkey, l_partkey, l_linenumber, len([l_quantity, l_tax] || [l_discount]) AS n,
    round(list_sum([l_quantity, l_tax] || [l_discount]), 4) AS total FROM lineitem""",
)
def array_ops(t: Tables) -> DataFrame:
    """Array of columns, concatenation of two arrays."""
    both = F.concat(F.array("l_quantity", "l_tax"), F.array("l_discount"))
    total = F.aggregate(both, F.lit(0.0), lambda acc, x: acc + x)
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", F.size(both).cast("long").alias("n"), F.round(total, 4).alias("total")
    )


@job(
    "vector_array",
    """SELECT vec_id, round(embedding[1], 5) AS first_value, len(embedding) AS dims,
    list_position(embedding, list_max(embedding)) - 1 AS argmax FROM embeddings""",
)
def vector_array(t: Tables) -> DataFrame:
    """Vectors to arrays and back, position of the greatest value."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    back = vector_to_array(array_to_vector(F.col("embedding").cast("array<double>")))
    return t.embeddings.select("vec_id", back.alias("v")).select(
        "vec_id",
        F.round(F.get("v", F.lit(0)).cast("float").cast("double"), 5).cast("float").alias("first_value"),
        F.size("v").cast("long").alias("dims"),
        (F.array_position("v", F.array_max("v")) - 1).cast("int").alias("argmax"),
    )


@job(
    "date_parts",
    """SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday,
    CASE WHEN isodow(o_orderdate) > 5 THEN 1 ELSE 0 END AS is_weekend, CAST(2002 - year(o_orderdate) AS INTEGER) AS age
    FROM orders""",
)
def date_parts(t: Tables) -> DataFrame:
    """Month, weekday (Monday 0), weekend flag, years up to a fixed date."""
    as_of = F.lit("2002-01-01").cast("date")
    day = F.weekday("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.month("o_orderdate").alias("month"),
        day.alias("weekday"),
        (day > 4).cast("int").alias("is_weekend"),
        (F.year(as_of) - F.year("o_orderdate")).alias("age"),
    )


@job(
    "window_labels",
    """SELECT label, count(*) AS cnt FROM (SELECT strftime(time_bucket(INTERVAL 30 SECOND, ts), '%H%M%S') || '-' ||
    strftime(time_bucket(INTERVAL 30 SECOND, ts) + INTERVAL 30 SECOND, '%H%M%S') AS label FROM events) GROUP BY 1""",
)
def window_labels(t: Tables) -> DataFrame:
    """Window written as HHMMSS-HHMMSS."""
    from ..streaming.jobs import window_label

    w = F.window(F.col("ts").cast("timestamp"), "30 seconds")
    return t.events.groupBy(window_label(w).alias("label")).agg(F.count(F.lit(1)).alias("cnt"))


@job(
    "json_time",
    """SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS number, epoch_us(ts) AS micros FROM events""",
)
def json_time(t: Tables) -> DataFrame:
    """JSON envelope parsed to a struct, expanded, its text made a timestamp."""
    envelope = F.to_json(
        F.struct(
            F.get_json_object("props", "$.k").cast("int").alias("number"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        )
    )
    rows = t.events.select("event_id", envelope.alias("value"))
    data = F.from_json("value", "number int, timestamp string")
    out = rows.select("event_id", data.alias("data")).select("event_id", "data.*")
    return out.select("event_id", "number", F.unix_micros(F.try_to_timestamp("timestamp")).alias("micros"))


Q, D = "l_quantity", "l_discount"
MATHS = {
    "plus": ("l_quantity + l_tax", lambda q, d, x: q + x),
    "ratio": ("l_tax / l_quantity", lambda q, d, x: x / q),
    "power": ("pow(l_quantity, 1.5)", lambda q, d, x: F.pow(q, F.lit(1.5))),
    "square": ("l_quantity * l_quantity", lambda q, d, x: q * q),
    "root": ("sqrt(l_quantity)", lambda q, d, x: F.sqrt(q)),
    "reciprocal": ("1 / l_quantity", lambda q, d, x: 1 / q),
    "negated": ("-l_quantity", lambda q, d, x: -q),
    "distance": ("abs(l_discount - l_tax)", lambda q, d, x: F.abs(d - x)),
    "sign": ("CAST(sign(l_discount - l_tax) AS DOUBLE)", lambda q, d, x: F.sign(d - x)),
    "sine": ("sin(l_discount)", lambda q, d, x: F.sin(d)),
    "cosine": ("cos(l_discount)", lambda q, d, x: F.cos(d)),
    "tangent": ("tan(l_discount)", lambda q, d, x: F.tan(d)),
    "arcsine": ("asin(l_discount)", lambda q, d, x: F.asin(d)),
    "arccosine": ("acos(l_discount)", lambda q, d, x: F.acos(d)),
    "arctangent": ("atan(l_discount)", lambda q, d, x: F.atan(d)),
    "arctangent2": ("atan2(l_discount, l_quantity)", lambda q, d, x: F.atan2(d, q)),
    "hypotenuse": ("sqrt(l_discount * l_discount + l_tax * l_tax)", lambda q, d, x: F.hypot(d, x)),
    "sinh": ("sinh(l_discount)", lambda q, d, x: F.sinh(d)),
    "cosh": ("cosh(l_discount)", lambda q, d, x: F.cosh(d)),
    "tanh": ("tanh(l_discount)", lambda q, d, x: F.tanh(d)),
    "asinh": ("asinh(l_discount)", lambda q, d, x: F.asinh(d)),
    "degrees": ("degrees(l_discount)", lambda q, d, x: F.degrees(d)),
    "radians": ("radians(l_quantity)", lambda q, d, x: F.radians(q)),
    "half_even": ("round_even(l_quantity / 2, 0)", lambda q, d, x: F.bround(q / 2, 0)),
    "half_up": ("round(l_quantity / 2, 0)", lambda q, d, x: F.round(q / 2, 0)),
    "floor": ("floor(l_quantity / 3)", lambda q, d, x: F.floor(q / 3).cast("double")),
    "ceil": ("ceil(l_quantity / 3)", lambda q, d, x: F.ceil(q / 3).cast("double")),
    "trunc": ("trunc(-l_quantity / 3)", lambda q, d, x: (-q / 3).cast("long").cast("double")),
    "exponential": ("exp(l_discount)", lambda q, d, x: F.exp(d)),
    "expm1": ("exp(l_discount) - 1", lambda q, d, x: F.expm1(d)),
    "two_power": ("pow(2, l_discount)", lambda q, d, x: F.pow(F.lit(2.0), d)),
    "ln": ("ln(l_quantity)", lambda q, d, x: F.ln(q)),
    "log10": ("log10(l_quantity)", lambda q, d, x: F.log10(q)),
    "log2": ("log2(l_quantity)", lambda q, d, x: F.log2(q)),
    "log1p": ("ln(1 + l_discount)", lambda q, d, x: F.log1p(d)),
    "trunc_mod": ("(-l_quantity) % 7", lambda q, d, x: (-q) % 7),
    "floor_mod": ("((-l_quantity) % 7 + 7) % 7", lambda q, d, x: F.pmod(-q, F.lit(7.0))),
    "clipped": ("greatest(least(l_quantity, 40.0), 10.0)", lambda q, d, x: F.greatest(F.least(q, F.lit(40.0)), F.lit(10.0))),
    "copysign": (
        "abs(l_quantity) * CASE WHEN l_discount - l_tax < 0 THEN -1 ELSE 1 END",
        lambda q, d, x: F.abs(q) * F.when(d - x < 0, -1).otherwise(1),
    ),
}


@job(
    "math_ops",
    "SELECT l_orderkey, l_partkey, l_linenumber, "
    + ", ".join(f"round({sql}, 6) + 0.0 AS {name}" for name, (sql, _) in MATHS.items())
    + " FROM lineitem",
)
def math_ops(t: Tables) -> DataFrame:
    """Arithmetic, trigonometry, rounding, exponentials, modulo, clipping."""
    q, d, x = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    # + 0.0 turns a negative zero into zero, as a sign of zero is not part of the result.
    cols = [(F.round(fn(q, d, x), 6) + 0.0).alias(n) for n, (_, fn) in MATHS.items()]
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", *cols)


_SHAPE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_FULL = r"CASE WHEN regexp_matches(url, '^\w*:?//.+') THEN url ELSE '//' || url END"
_URL_SQL = f"""(SELECT page_id, url, lower(regexp_extract(f, '{_SHAPE}', 1)) AS scheme, regexp_extract(f, '{_SHAPE}', 2) AS netloc,
 regexp_replace(regexp_extract(f, '{_SHAPE}', 3), ';[^/]*$', '') AS path,
 regexp_extract(regexp_extract(f, '{_SHAPE}', 3), ';([^/]*)$', 1) AS params,
 regexp_extract(f, '{_SHAPE}', 4) AS query, regexp_extract(f, '{_SHAPE}', 5) AS fragment
 FROM (SELECT page_id, url, {_FULL} AS f FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN regexp_replace(url, '^https?://', '')
 ELSE url END AS url FROM pages)))"""


def _urls(t: Tables) -> DataFrame:
    """Every third URL written without its scheme, as such lists have both forms."""
    bare = F.regexp_replace("url", "^https?://", "")
    return t.pages.select("page_id", F.when(F.col("page_id") % 3 == 0, bare).otherwise(F.col("url")).alias("url"))


@job("url_parts", f"SELECT page_id, scheme, netloc, path, params, query, fragment FROM {_URL_SQL}")
def url_parts(t: Tables) -> DataFrame:
    """X19."""
    return _urls(t).select("page_id", *[c.alias(n) for n, c in urls.parts("url").items()])


@job(
    "url_features",
    f"""SELECT page_id, CAST(length(url) AS INTEGER) AS len,
    CAST(regexp_matches(netloc, '^\\d{{1,3}}\\.\\d{{1,3}}\\.\\d{{1,3}}\\.\\d{{1,3}}(:\\d+)?$') AS INTEGER) AS is_ip,
    CAST(length(netloc) - length(replace(netloc, '.', '')) + 1 AS INTEGER) AS domain_level, CAST(length(netloc) AS INTEGER) AS domain_len,
    CAST(regexp_matches(netloc, ':\\d+') AS INTEGER) AS has_port,
    CAST(length(path) - length(replace(path, '/', '')) AS INTEGER) AS path_level, CAST(length(path) AS INTEGER) AS path_len,
    CAST(length(query) - length(replace(query, '&', '')) AS INTEGER) AS num_query_params, CAST(length(query) AS INTEGER) AS query_len,
    CAST(length(url) - length(replace(url, '%', '')) AS INTEGER) AS count_percent FROM {_URL_SQL}""",
)
def url_features(t: Tables) -> DataFrame:
    """X20."""
    return _urls(t).select("page_id", *[c.alias(n) for n, c in urls.features("url").items()])


@job(
    "top_or_other",
    """WITH top AS (SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 5)
    SELECT doc_id, coalesce(top.source, 'other') AS source FROM documents d LEFT JOIN top ON d.source = top.source""",
)
def top_or_other(t: Tables) -> DataFrame:
    """X22."""
    return R.top_or_other(t.documents.select("doc_id", "source"), "source", 5)


@job(
    "value_map",
    """SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'south' WHEN 1 THEN 'west' WHEN 2 THEN 'east' END AS side FROM nation""",
)
def value_map(t: Tables) -> DataFrame:
    """Mapped values; unmapped ones become NULL."""
    mapping = F.create_map(F.lit(0), F.lit("south"), F.lit(1), F.lit("west"), F.lit(2), F.lit("east"))
    return t.nation.select("n_nationkey", F.try_element_at(mapping, F.col("n_regionkey")).alias("side"))


@job(
    "derived_flags",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity + l_linenumber + 1 AS size,
    CASE WHEN l_tax = 0 AND l_discount = 0 THEN 1 ELSE 0 END AS is_plain FROM lineitem""",
)
def derived_flags(t: Tables) -> DataFrame:
    """Sum of counts plus one, flag of two zeros."""
    plain = ((F.col("l_tax") == 0) & (F.col("l_discount") == 0)).cast("int")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", (F.col("l_quantity") + F.col("l_linenumber") + 1).alias("size"),
        plain.alias("is_plain"),
    )


PROPER_SQL = f"""WITH tok AS (SELECT doc_id, string_split_regex(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+') AS w FROM documents),
 x AS (SELECT w[i] AS word, w[i - 1] AS before FROM (SELECT w, unnest(range(2, len(w) + 1)) AS i FROM tok)),
 b AS (SELECT regexp_replace(word, '^[^{X.LATIN_UPPER}{X.LATIN_LOWER}]+|[^{X.LATIN_UPPER}{X.LATIN_LOWER}]+$', '', 'g') AS bare, before FROM x),
 s AS (SELECT regexp_replace(bare, '[{X.LATIN_VOWELS}]+$', '') AS noun FROM b
 WHERE regexp_matches(bare, '^[{X.LATIN_UPPER}][{X.LATIN_LOWER}]*$') AND NOT regexp_matches(before, '[.!?]$'))
 SELECT noun, count(*) AS cnt FROM s WHERE noun <> '' AND noun NOT IN ('Th', 'Wh') GROUP BY 1"""


@job("proper_nouns", PROPER_SQL)
def proper_nouns(t: Tables) -> DataFrame:
    """Capitalised words inside sentences, trailing vowels stripped, stop words out."""
    rows = t.documents.select(X.whitespace_tokens("text").alias("tokens"))
    nouns = X.proper_nouns(F.col("tokens"), X.LATIN_UPPER, X.LATIN_LOWER, X.LATIN_VOWELS)
    return X.without(X.word_count(rows, nouns, "noun"), "noun", ["Th", "Wh"])
