"""Streaming queries: a table is replayed through the file source and the final sink table is returned."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.features import text_stages
from ..operators.models import BUCKETS
from ..session import cut_lineage, scratch_path
from ..sources.tables import Tables
from ..streaming import jobs as J
from ..streaming import panes as N
from ..streaming import sinks as K
from ..streaming.sources import envelope_text, file_stream
from ..streaming.upserts import UpsertTable
from .registry import job

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
TALKS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _events(t: Tables) -> DataFrame:
    return file_stream(t.spark, t.pattern("events"), EVENTS).withColumn("ts", F.col("ts").cast("timestamp"))


@job("stream_total_counts", "SELECT event_type, count(*) AS cnt FROM events GROUP BY 1 ORDER BY cnt DESC, event_type")
def stream_total_counts(t: Tables) -> DataFrame:
    """ST02, ST04, ST11, ST17: running totals in complete mode, sorted."""
    path = scratch_path(t.spark, "totals")
    counts = J.ranked(J.running_counts(_events(t), "event_type"), "event_type")
    K.run_now(counts, "complete", K.append_epochs(path))
    return K.read_ranking(K.latest_epoch(t.spark, path), "event_type")


@job("stream_upsert", "SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY ALL")
def stream_upsert(t: Tables) -> DataFrame:
    """ST05, K08: changed totals only, upserted by key."""
    path = scratch_path(t.spark, "upsert")
    K.run_now(J.running_counts(_events(t), "user_id", "event_type"), "update", K.append_epochs(path))
    return K.latest_values(t.spark, path, ["user_id", "event_type"])


@job(
    "stream_word_count",
    """SELECT word, count(*) AS cnt FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM conversations) WHERE word <> '' GROUP BY 1""",
)
def stream_word_count(t: Tables) -> DataFrame:
    """ST01, K11: counts of each batch by itself; the replay is one batch."""
    path = scratch_path(t.spark, "words")
    stream = file_stream(t.spark, t.pattern("conversations"), TALKS)
    K.run_now(stream, "append", K.per_batch(path, lambda b: X.word_count(b, X.whitespace_tokens("text"))))
    return K.read_epochs(t.spark, path).groupBy("word").agg(F.sum("cnt").alias("cnt"))


_WIN = """w AS (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE * k AS s FROM events, range(2) r(k)),
 c AS (SELECT event_type, s, count(*) AS cnt FROM w GROUP BY ALL), m AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 15 SECOND AS wm FROM events)"""


@job(
    "stream_sliding",
    f"""WITH {_WIN} SELECT event_type, epoch_us(s) // 1000000 AS start, cnt FROM c, m WHERE s + INTERVAL 10 MINUTE <= wm""",
)
def stream_sliding(t: Tables) -> DataFrame:
    """ST03, ST09: sliding windows in append mode; a window appears once the watermark has passed its end."""
    path = scratch_path(t.spark, "sliding")
    counts = J.window_counts(_events(t), "ts", ["event_type"], "10 minutes", "5 minutes", "15 seconds")
    out = counts.select("event_type", F.unix_seconds("window.start").alias("start"), "cnt")
    K.run_now(out, "append", path=path)
    return t.spark.read.schema("event_type string, start long, cnt long").parquet(path)


@job(
    "stream_window_csv",
    f"""WITH {_WIN} SELECT strftime(s, '%H%M%S') || '-' || strftime(s + INTERVAL 10 MINUTE, '%H%M%S') AS label, CAST(sum(cnt) AS BIGINT) AS cnt
    FROM c, m WHERE s + INTERVAL 10 MINUTE <= wm GROUP BY 1""",
)
def stream_window_csv(t: Tables) -> DataFrame:
    """The same written as CSV partitioned by the window's label."""
    path = scratch_path(t.spark, "windowcsv")
    counts = J.window_counts(_events(t), "ts", ["event_type"], "10 minutes", "5 minutes", "15 seconds")
    out = counts.select(J.window_label(F.col("window")).alias("label"), "event_type", "cnt")
    K.run_now(out, "append", kind="csv", path=path, partition_by="label")
    back = t.spark.read.schema("event_type string, cnt long, label string").csv(path)
    return back.groupBy("label").agg(F.sum("cnt").alias("cnt"))


@job(
    "stream_user_1m_10m",
    """WITH o AS (SELECT user_id, 60 AS size, time_bucket(INTERVAL 30 SECOND, ts) - INTERVAL 30 SECOND * k AS s FROM events, range(2) r(k)
    UNION ALL SELECT user_id, 600, time_bucket(INTERVAL 30 SECOND, ts) - INTERVAL 30 SECOND * k FROM events, range(20) r(k))
    SELECT user_id, size, epoch_us(s) // 1000000 AS start, count(*) AS cnt FROM o GROUP BY ALL""",
)
def stream_user_1m_10m(t: Tables) -> DataFrame:
    """ST15: messages per user over 1 and 10 minutes, every 30 seconds: the stream counts panes of 30 seconds, of which the windows are
    added up. Panes stay open for 10 minutes more than the hour, as the last window that they belong to."""
    path = scratch_path(t.spark, "users")
    counts = J.window_counts(_events(t), "ts", ["user_id"], "30 seconds", late="70 minutes")
    K.run_now(counts.select("user_id", F.unix_seconds("window.start").alias("start"), "cnt"), "update", K.append_epochs(path))
    panes = cut_lineage(K.latest_values(t.spark, path, ["user_id", "start"]))
    parts = [J.windows_of_panes(panes, ["user_id"], 30, size).withColumn("size", F.lit(size)) for size in (60, 600)]
    return parts[0].unionByName(parts[1]).select("user_id", "size", "start", "cnt")


@job("stream_json_time", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS number, epoch_us(ts) AS micros FROM events")
def stream_json_time(t: Tables) -> DataFrame:
    """ST08, S21, X09, X10: event time read from the message itself."""
    path = scratch_path(t.spark, "json")
    payload = F.to_json(
        F.struct(
            F.get_json_object("props", "$.k").cast("int").alias("number"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        )
    )
    messages = _events(t).select("event_id", F.to_json(F.struct(payload.alias("content"))).alias("value"))
    rows = J.embedded_time(envelope_text(messages))
    K.run_now(rows, "append", path=path)
    back = t.spark.read.schema("event_id long, number int, timestamp timestamp").parquet(path)
    return back.select("event_id", "number", F.unix_micros("timestamp").alias("micros"))


@job("stream_passthrough", "SELECT event_id, value AS number, 1 AS stamped FROM events")
def stream_passthrough(t: Tables) -> DataFrame:
    """ST06, ST07: append mode with arrival time kept and batch time added."""
    path = scratch_path(t.spark, "pass")
    rows = J.processing_time(J.arrival_numbers(_events(t).select("event_id", "value", "ts")), "seen")
    K.run_now(rows, "append", path=path)
    back = t.spark.read.schema("event_id long, number double, ts timestamp, seen timestamp").parquet(path)
    return back.select("event_id", "number", F.col("seen").isNotNull().cast("int").alias("stamped"))


@job("stream_rank", "SELECT user_id, count(*) AS cnt FROM events GROUP BY 1 ORDER BY cnt DESC, user_id LIMIT 10")
def stream_rank(t: Tables) -> DataFrame:
    """ST10, K07, K09, K10: the top-10 ranking is replaced by each batch and read back in order."""
    path = scratch_path(t.spark, "rank")
    K.run_now(J.running_counts(_events(t), "user_id"), "complete", K.ranking(path, "user_id", 10))
    return K.read_ranking(K.latest_epoch(t.spark, path), "user_id")


@job(
    "stream_fan_out",
    """WITH c AS (SELECT event_type, count(*) AS cnt FROM events GROUP BY 1)
    SELECT 'all' AS sink, event_type, cnt FROM c UNION ALL SELECT 'log', event_type, cnt FROM c
    UNION ALL (SELECT 'top', event_type, cnt FROM c ORDER BY cnt DESC, event_type LIMIT 2)""",
)
def stream_fan_out(t: Tables) -> DataFrame:
    """ST14: one stream into three sinks."""
    paths = {n: scratch_path(t.spark, n) for n in ("all", "log", "top")}
    writers = [K.append_epochs(paths["all"]), K.append_epochs(paths["log"]), K.ranking(paths["top"], "event_type", 2)]
    K.run_now(J.running_counts(_events(t), "event_type"), "complete", K.fan_out(*writers))
    out = None
    for name, path in paths.items():
        rows = K.latest_epoch(t.spark, path).select(F.lit(name).alias("sink"), "event_type", "cnt")
        out = rows if out is None else out.unionByName(rows)
    return out


@job("stream_score")
def stream_score(t: Tables) -> DataFrame:
    """ST12, K12: documents scored on the stream by a classifier fitted on the labelled ones."""
    train = t.labels.join(t.documents.select("doc_id", "text"), "doc_id").withColumn("label", F.col("quality").cast("double"))
    stages = [*text_stages("text", [], BUCKETS, binary=True)[:-1], NaiveBayes(featuresCol="tf")]
    model = Pipeline(stages=stages).fit(train)
    path = scratch_path(t.spark, "scores")
    stream = file_stream(t.spark, t.pattern("documents"), DOCS).select("doc_id", "text")
    K.run_now(J.scored(stream, model).select("doc_id", "label"), "append", path=path)
    return t.spark.read.schema("doc_id long, label string").parquet(path)


@job(
    "stream_reload",
    """WITH p AS (SELECT avg(value) AS bound FROM events) SELECT event_id, 2 AS version,
    CASE WHEN value > bound THEN 'high' ELSE 'low' END AS label FROM events, p""",
)
def stream_reload(t: Tables) -> DataFrame:
    """ST13: the model is a table row; each batch is scored by the newest version at its start."""
    params, path = scratch_path(t.spark, "params"), scratch_path(t.spark, "reload")
    bound = t.events.agg(F.avg("value").alias("bound"))
    versions = bound.select(F.lit(1).alias("version"), F.lit(0.0).alias("bound")).unionByName(
        bound.select(F.lit(2).alias("version"), "bound")
    )
    versions.write.parquet(params)

    def newest():
        return t.spark.read.parquet(params).orderBy(F.desc("version")).first()

    def score(batch: DataFrame, model) -> DataFrame:
        label = F.when(F.col("value") > model["bound"], "high").otherwise("low")
        return batch.select("event_id", F.lit(model["version"]).alias("version"), label.alias("label"))

    K.run_now(_events(t).select("event_id", "value"), "append", K.scored_batches(path, K.Reloaded(newest, 60.0), score))
    return K.read_epochs(t.spark, path).drop("epoch")


@job(
    "stream_nouns",
    f"""WITH tok AS (SELECT string_split_regex(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+') AS w FROM documents),
    x AS (SELECT w[i] AS word, w[i - 1] AS before FROM (SELECT w, unnest(range(2, len(w) + 1)) AS i FROM tok)),
    b AS (SELECT regexp_replace(word, '^[^{X.LATIN_UPPER}{X.LATIN_LOWER}]+|[^{X.LATIN_UPPER}{X.LATIN_LOWER}]+$', '', 'g') AS bare, before FROM x),
    s AS (SELECT regexp_replace(bare, '[{X.LATIN_VOWELS}]+$', '') AS noun FROM b
    WHERE regexp_matches(bare, '^[{X.LATIN_UPPER}][{X.LATIN_LOWER}]*$') AND NOT regexp_matches(before, '[.!?]$'))
    SELECT noun, count(*) AS cnt FROM s WHERE noun <> '' GROUP BY 1 ORDER BY cnt DESC, noun LIMIT 10""",
)
def stream_nouns(t: Tables) -> DataFrame:
    """ST16: accumulated proper-noun counts, a sorted snapshot per batch, the ten most frequent at the end."""
    path = scratch_path(t.spark, "nouns")
    rows = file_stream(t.spark, t.pattern("documents"), DOCS).select(X.whitespace_tokens("text").alias("tokens"))
    nouns = J.words_of(rows, X.proper_nouns(F.col("tokens"), X.LATIN_UPPER, X.LATIN_LOWER, X.LATIN_VOWELS), "noun")
    K.run_now(J.ranked(J.running_counts(nouns, "noun"), "noun"), "complete", K.append_epochs(path))
    return K.read_ranking(K.latest_epoch(t.spark, path), "noun").limit(10)


@job(
    "stream_clicks",
    """SELECT user_id, CAST(props->>'$.k' AS BIGINT) AS page_id, count(*) AS cnt FROM events WHERE event_type = 'click' GROUP BY ALL""",
)
def stream_clicks(t: Tables) -> DataFrame:
    """ST18: clicks per user and page from JSON messages."""
    path = scratch_path(t.spark, "clicks")
    message = F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), "user_id",
            F.get_json_object("props", "$.k").cast("long").alias("page_id"),
        )
    )
    stream = _events(t).where("event_type = 'click'").select(message.alias("value"))
    K.run_now(J.running_counts(J.clicks(stream), "user_id", "page_id"), "update", K.append_epochs(path))
    return K.latest_values(t.spark, path, ["user_id", "page_id"])


# --- several batches, with late rows and a restart before each ---------------------------------------------

SLICES = 5
#: Events by the fifth of the time span that they fall into; one in 97 comes three fifths too late, when no window is open for it any more.
_ARRIVED = f"""span AS (SELECT epoch_us(min(ts)) AS first, (epoch_us(max(ts)) - epoch_us(min(ts))) // {SLICES} + 1 AS width FROM events),
 dealt AS (SELECT e.*, (epoch_us(ts) - first) // width AS slice FROM events e, span),
 arrived AS (SELECT *, event_id % 97 = 0 AND slice + 3 < {SLICES} AS late, epoch_us(ts) // 1000 AS ms FROM dealt),
 mark AS (SELECT max(ms) - 15000 AS wm FROM arrived WHERE NOT late), kept AS (SELECT * FROM arrived WHERE NOT late)"""


def _in_slices(t: Tables, run: Callable[[DataFrame, str], None]) -> None:
    """Replays the events in SLICES parts. Each part is taken by a query of its own that resumes from the checkpoint of the one
    before: ``run`` starts it, given the stream and the checkpoint."""
    source, checkpoint = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "ckpt")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    span = t.events.agg(F.min(micros).alias("first"), F.max(micros).alias("last")).first()
    if span["first"] is None:
        return
    width = (span["last"] - span["first"]) // SLICES + 1
    part = F.floor((micros - span["first"]) / width).cast("int")
    late = (F.col("event_id") % 97 == 0) & (part + 3 < SLICES)
    rows = t.events.withColumn("slice", F.when(late, part + 3).otherwise(part))
    for number in range(SLICES):
        rows.where(F.col("slice") == number).drop("slice").write.mode("append").parquet(source)
        stream = file_stream(t.spark, source, EVENTS).withColumn("ts", F.col("ts").cast("timestamp"))
        run(stream, checkpoint)


def _pane_rows(t: Tables, keys: list[str], pane: int, size: int | None, salts: int = 1) -> DataFrame:
    path = scratch_path(t.spark, "panes")
    shape = ", ".join([*[f"{k} {dict(t.events.dtypes)[k]}" for k in keys], "end_ms long", "cnt long"])

    def run(stream: DataFrame, checkpoint: str) -> None:
        counts = N.pane_counts(stream, "ts", keys, pane, size, "15 seconds", salts, "event_id")
        K.run_now(counts, "append", path=path, checkpoint=checkpoint)

    with N.keyed_state(t.spark, N.state_parts(t.spark, t.events.count())):
        _in_slices(t, run)
    return N.summed(t.spark.read.schema(shape).parquet(path), keys)


def _pane_sql(key: str, pane: int, size: int) -> str:
    return f"""SELECT {key}, end_ms, count(*) AS cnt FROM (
        SELECT {key}, (ms // {pane * 1000} + 1 + unnest(range({size // pane}))) * {pane * 1000} AS end_ms FROM kept), mark WHERE end_ms <= wm GROUP BY {key}, end_ms"""


@job("stream_panes", f"WITH {_ARRIVED} {_pane_sql('event_type', 300, 600)}")
def stream_panes(t: Tables) -> DataFrame:
    """ST03, ST09, ST17: windows of 10 minutes each 5 minutes by panes with an inverse step, over five runs that resume each other; hot
    keys in four parts."""
    return _pane_rows(t, ["event_type"], 300, 600, 4)


@job("stream_user_panes", f"""WITH {_ARRIVED} SELECT 60 AS size, * FROM ({_pane_sql('user_id', 30, 60)}) UNION ALL
    SELECT 600, * FROM ({_pane_sql('user_id', 30, 600)})""")
def stream_user_panes(t: Tables) -> DataFrame:
    """ST15: events per user over 1 and 10 minutes every 30 seconds, one addition to one pane for each event."""
    parts = [_pane_rows(t, ["user_id"], 30, size).withColumn("size", F.lit(size)) for size in (60, 600)]
    return parts[0].unionByName(parts[1])


@job("stream_minute_totals", f"""WITH {_ARRIVED}, p AS (SELECT event_type, (ms // 60000 + 1) * 60000 AS end_ms, count(*) AS n FROM kept GROUP BY ALL),
    r AS (SELECT event_type, end_ms, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY end_ms) AS BIGINT) AS cnt FROM p)
    SELECT r.* FROM r, mark WHERE end_ms <= wm""")
def stream_minute_totals(t: Tables) -> DataFrame:
    """ST02, ST16: totals since the start with a snapshot each minute, of the keys that the minute changed; nothing is written twice."""
    return _pane_rows(t, ["event_type"], 60, None)


@job("stream_upsert_table", "SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY ALL")
def stream_upsert_table(t: Tables) -> DataFrame:
    """K08, ST05, ST17: changed totals of five resumed runs upserted into a keyed table whose epochs are merged level by level."""
    shape = "user_id long, event_type string, cnt long"
    table = UpsertTable(t.spark, scratch_path(t.spark, "keyed"), shape, ["user_id", "event_type"], fan=3)

    def run(stream: DataFrame, checkpoint: str) -> None:
        K.run_now(J.running_counts(stream, "user_id", "event_type"), "update", table.write, checkpoint=checkpoint)

    _in_slices(t, run)
    return table.read()
