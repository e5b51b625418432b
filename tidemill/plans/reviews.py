"""Word counts and review jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import reviews as V
from ..sources.tables import Tables
from .registry import job


@job(
    "word_count_ws",
    """SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1 ORDER BY cnt DESC, word""",
)
def word_count_ws(t: Tables) -> DataFrame:
    """Whitespace tokens, most frequent first."""
    return X.word_count(t.documents, X.whitespace_tokens("text")).orderBy(F.desc("cnt"), "word")


@job(
    "word_count_space",
    """SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1
    ORDER BY cnt DESC, word""",
)
def word_count_space(t: Tables) -> DataFrame:
    """Split at single spaces, empty tokens counted."""
    return X.word_count(t.documents, X.space_tokens("text")).orderBy(F.desc("cnt"), "word")


@job(
    "word_count_trailing",
    """SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split(regexp_replace(text, ' +$', ''), ' ')) AS word
    FROM conversations WHERE regexp_replace(text, ' +$', '') <> '') GROUP BY 1""",
)
def word_count_trailing(t: Tables) -> DataFrame:
    """The variant that drops trailing empty tokens."""
    return X.word_count(t.conversations, X.space_tokens("text", drop_trailing=True))


@job("rating_histogram", "SELECT l_suppkey, l_quantity, count(*) AS cnt FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2")
def rating_histogram(t: Tables) -> DataFrame:
    """A22."""
    return V.rating_histogram(t.lineitem, "l_suppkey", "l_quantity")


@job("max_and_count", "SELECT l_partkey, max(l_quantity) AS max_value, count(l_quantity) AS cnt FROM lineitem GROUP BY 1")
def max_and_count(t: Tables) -> DataFrame:
    """A23."""
    return V.max_and_count(t.lineitem, "l_partkey", "l_quantity")


_RAW = """CASE event_type WHEN 'error' THEN 'x' || props WHEN 'view' THEN '{"q": 1}' ELSE props END"""


@job(
    "parse_counters",
    f"""WITH r AS (SELECT {_RAW} AS value FROM events)
    SELECT count(*) FILTER (NOT json_valid(value)) AS bad_json,
    count(*) FILTER (json_valid(value) AND json_extract_string(CASE WHEN json_valid(value) THEN value END, '$.k') IS NULL) AS missing_value,
    count(*) FILTER (json_valid(value) AND json_extract_string(CASE WHEN json_valid(value) THEN value END, '$.k') IS NOT NULL) AS correct
    FROM r""",
)
def parse_counters(t: Tables) -> DataFrame:
    """Malformed, incomplete and good records counted in one pass."""
    raw = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("x"), "props"))
        .when(F.col("event_type") == "view", F.lit('{"q": 1}'))
        .otherwise(F.col("props"))
    )
    return V.parse_states(t.events.select(raw.alias("value")), "k long", ["k"])


@job(
    "rating_intervals",
    """SELECT label, count(*) AS cnt FROM (SELECT CASE WHEN r > 4 THEN '5' WHEN r > 3 THEN '4' WHEN r > 2 THEN '3' WHEN r > 1
    THEN '2' ELSE '1' END AS label FROM (SELECT l_quantity / 10 AS r FROM lineitem)) GROUP BY 1""",
)
def rating_intervals(t: Tables) -> DataFrame:
    """A25."""
    label = V.rating_interval(F.col("l_quantity") / 10)
    return t.lineitem.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("cnt"))


@job(
    "rating_intervals_legacy",
    """SELECT label, count(*) AS cnt FROM (SELECT CASE WHEN r > 4 THEN '5' WHEN r > 2 THEN '3' WHEN r > 1
    THEN '2' ELSE '1' END AS label FROM (SELECT l_quantity / 10 AS r FROM lineitem)) GROUP BY 1""",
)
def rating_intervals_legacy(t: Tables) -> DataFrame:
    """A25 with the older labels."""
    label = V.rating_interval(F.col("l_quantity") / 10, legacy_labels=True)
    return t.lineitem.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("cnt"))
