"""Multi-batch behaviour of the streaming jobs through the file source."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemill.functions import text as X
from tidemill.streaming import jobs as J
from tidemill.streaming import sinks as K
from tidemill.streaming.sources import envelope_text, file_stream, text_stream


def _drop(path, batches):
    """One file per batch, in order of modification time."""
    for i, lines in enumerate(batches):
        f = path / f"{i:03d}.txt"
        f.write_text("\n".join(lines) + "\n")
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))


def _epochs(spark, path):
    out = {}
    for r in K.read_epochs(spark, path).collect():
        out.setdefault(r["epoch"], {})[r["word"]] = r["cnt"]
    return out


@pytest.fixture
def words(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _drop(src, [["b a b a e d c"], ["a a c c"]])
    stream = text_stream(spark, str(src), 1)
    return J.words_of(stream, X.whitespace_tokens("value")), str(tmp_path / "out")


def test_complete_update_and_batch(spark, words):
    rows, out = words
    counts = J.running_counts(rows, "word")
    K.run_now(J.ranked(counts, "word"), "complete", K.append_epochs(out + "c"))
    assert _epochs(spark, out + "c") == {0: {"a": 2, "b": 2, "c": 1, "d": 1, "e": 1}, 1: {"a": 4, "b": 2, "c": 3, "d": 1, "e": 1}}
    K.run_now(counts, "update", K.append_epochs(out + "u"))
    assert _epochs(spark, out + "u")[1] == {"a": 4, "c": 3}
    latest = {r["word"]: r["cnt"] for r in K.latest_values(spark, out + "u", ["word"]).collect()}
    assert latest == {"a": 4, "b": 2, "c": 3, "d": 1, "e": 1}
    K.run_now(rows, "append", K.per_batch(out + "b", lambda b: b.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))))
    assert _epochs(spark, out + "b")[1] == {"a": 2, "c": 2}


def test_sorting_needs_complete_mode(spark, words):
    rows, out = words
    with pytest.raises(Exception, match="[Ss]ort"):
        K.run_now(J.ranked(J.running_counts(rows, "word"), "word"), "update", K.append_epochs(out))


def test_ranking_and_fan_out(spark, words):
    rows, out = words
    K.run_now(J.running_counts(rows, "word"), "complete", K.fan_out(K.ranking(out + "t", "word", 2), K.append_epochs(out + "a")))
    ranked = K.read_ranking(K.latest_epoch(spark, out + "t"), "word").collect()
    assert [(r["word"], r["cnt"]) for r in ranked] == [("a", 4), ("c", 3)]
    assert K.latest_epoch(spark, out + "a").count() == 5


def test_replayed_epoch_replaces(spark, tmp_path):
    out = str(tmp_path / "o")
    write = K.append_epochs(out)
    batch = spark.createDataFrame([("a", 1)], "word string, cnt long")
    write(batch, 0)
    write(batch, 0)
    assert K.read_epochs(spark, out).count() == 1


def test_watermark_drops_late_rows(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    at = lambda s, v: json.dumps({"number": v, "timestamp": f"2024-01-01T00:{s}"})
    _drop(src, [[at("00:20", 1)], [at("01:30", 1)], [at("01:31", 1)], [at("00:06", 1)], [at("10:00", 1)]])
    rows = J.embedded_time(text_stream(spark, str(src), 1))
    counts = J.window_counts(rows, "timestamp", ["number"], "30 seconds", "15 seconds", "15 seconds")
    flat = counts.select("number", J.window_label(F.col("window")).alias("label"), "cnt")
    K.run_now(flat, "append", path=str(tmp_path / "out"))
    got = {r["label"]: r["cnt"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # 00:06 came two batches after 01:30, when its windows were closed; the windows of 10:00 stay open.
    assert got == {"000000-000030": 1, "000015-000045": 1, "000115-000145": 2, "000130-000200": 2}


def test_windows_of_panes(spark):
    rows = [(u, f"2020-01-01 00:{(7 * i * u) % 60:02d}:{(13 * i) % 60:02d}") for u in (1, 2) for i in range(40) if u != 2 or i % 3]
    rows += [(2, "1969-12-31 23:59:40"), (1, None), (None, "2020-01-01 00:00:10"), (None, "2020-01-01 00:00:50")]
    df = spark.createDataFrame(rows, "user long, t string").select("user", F.to_timestamp("t").alias("ts"))
    flat = lambda w: w.select("user", F.unix_seconds("window.start").alias("start"), "cnt")
    panes = flat(J.window_counts(df, "ts", ["user"], "30 seconds"))
    for size in (30, 60, 600):
        want = flat(J.window_counts(df, "ts", ["user"], f"{size} seconds", "30 seconds"))
        got = J.windows_of_panes(panes, ["user"], 30, size)
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    with pytest.raises(ValueError):
        J.windows_of_panes(panes, ["user"], 30, 45)


def test_messages_and_clicks(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    click = json.dumps({"ts": "2024-01-01T00:00:00", "user_id": 3, "page_id": 7})
    _drop(src, [[json.dumps({"content": "hi"}), "broken", click], [click, '{"user_id": 3}']])
    stream = text_stream(spark, str(src), 1)
    K.run_now(envelope_text(stream), "append", path=str(tmp_path / "e"))
    assert [r["value"] for r in spark.read.parquet(str(tmp_path / "e")).collect()] == ["hi"]
    K.run_now(J.running_counts(J.clicks(stream), "user_id", "page_id"), "update", K.append_epochs(str(tmp_path / "c")))
    assert [tuple(r) for r in K.latest_values(spark, str(tmp_path / "c"), ["user_id", "page_id"]).collect()] == [(3, 7, 2)]


def test_reloaded_by_age():
    now, loads = [0.0], []
    model = K.Reloaded(lambda: loads.append(1) or len(loads), 60.0, lambda: now[0])
    assert (model.get(), model.get()) == (1, 1)
    now[0] = 59.0
    assert model.get() == 1
    now[0] = 61.0
    assert model.get() == 2


def test_restart_resumes(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _drop(src, [["a b"]])
    rows = J.words_of(text_stream(spark, str(src)), X.whitespace_tokens("value"))
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    K.run_now(J.running_counts(rows, "word"), "update", K.append_epochs(out), checkpoint=ckpt)
    (src / "zzz.txt").write_text("a c\n")
    K.run_now(J.running_counts(rows, "word"), "update", K.append_epochs(out), checkpoint=ckpt)
    assert {r["word"]: r["cnt"] for r in K.latest_values(spark, out, ["word"]).collect()} == {"a": 2, "b": 1, "c": 1}


def test_stream_reader_is_streaming(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\n')
    assert file_stream(spark, str(tmp_path), "a int", "json").isStreaming
