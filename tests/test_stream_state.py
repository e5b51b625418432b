"""Pane counts and keyed tables of streams: the state by itself, and over several batches."""

import random

import pytest

import __spark_entry__ as entry
from tidemill.streaming.panes import Panes, keyed_state
from tidemill.streaming.upserts import UpsertTable
from tools.check import compare, connect

BASE = "/root/testdata/sf0.001"


def test_panes_equal_plain_windows():
    r = random.Random(1)
    for _ in range(2000):
        pane = r.choice([1, 5])
        size = pane * r.randrange(1, 6)
        events = sorted(r.randrange(0, 120) for _ in range(r.randrange(0, 30)))
        window, total = Panes(pane, size), Panes(pane, None)
        got, sums, i = [], [], 0
        for mark in [*sorted(r.randrange(0, 200) for _ in range(6)), 400]:
            while i < len(events) and events[i] < mark:
                for p in (window, total):
                    p.add(events[i] // pane * pane, 1)
                i += 1
            got += window.close(mark)
            sums += total.close(mark)
            due = window.next_end()
            assert due is None or due > mark  # a timer in the past would never fire
            window = Panes(pane, size, window.closed, window.total, window.counts) if due is not None else Panes(pane, size)
        ends = range(pane, 401, pane)
        assert got == [(e, n) for e in ends if (n := sum(e - size <= x < e for x in events))]
        assert sums == [(e, sum(x < e for x in events)) for e in ends if any(e - pane <= x < e for x in events)]
        assert not window.counts and window.total == 0


def test_a_long_gap_costs_nothing():
    p = Panes(1, 10)
    p.add(5, 2)
    p.add(10**12, 1)
    assert len(p.close(10**12 + 50)) == 20 and p.next_end() is None


@pytest.mark.parametrize("name", ["stream_panes", "stream_user_panes", "stream_minute_totals", "stream_upsert_table"])
def test_streams_over_five_runs(spark, name):
    """Late rows are dropped and each run resumes the one before; equal to SQL over the rows that came in time."""
    df = entry.queries()[name](spark, BASE)
    rows = [tuple(r) for r in df.collect()]
    cur = connect(BASE).execute(entry.oracle_sql()[name])
    assert rows and compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall()) is None


def test_state_store_setting_comes_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with keyed_state(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name, None) == before


def test_upserts_over_twenty_epochs(spark, tmp_path):
    """Segments stay few, a repeated epoch changes nothing, and the table equals the newest value of each key."""
    table = UpsertTable(spark, str(tmp_path / "t"), "k long, name string, cnt long", ["k", "name"], fan=3, buckets=2)
    assert table.read().collect() == []
    rng, want, batches = random.Random(3), {}, {}
    for epoch in range(20):
        keys = rng.sample(range(12), rng.randrange(0, 6)) if epoch != 7 else []
        rows = [(k if k else None, f"n{k % 2}", epoch * 100 + k) for k in keys]
        batches[epoch] = spark.createDataFrame(rows, "k long, name string, cnt long")
        table.write(batches[epoch], epoch)
        want |= {(k, n): c for k, n, c in rows}
        assert len(table.segments()) <= 2 * 4
    held = lambda: {(r.k, r.name): r.cnt for r in table.read().collect()}
    assert held() == want
    before = table.segments()
    for epoch in (0, 5, 19):
        table.write(batches[epoch], epoch)
    assert held() == want and table.segments() == before
    folders = list((tmp_path / "t").glob("level=*/from=*"))
    assert len(folders) <= 2 * 4 + 2 * 3 and max(s[0] for s in before) == 2


def test_half_written_segments_are_not_read(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), "k long, cnt long", ["k"], fan=2, buckets=1)
    for epoch in range(2):
        table.write(spark.createDataFrame([(1, epoch)], "k long, cnt long"), epoch)
    (tmp_path / "t" / "level=1" / "from=0-to=1" / "_SUCCESS").unlink()
    assert table.segments() == [(0, 0, 0), (0, 1, 1)] and table.read().collect()[0].cnt == 1
    table.write(spark.createDataFrame([(1, 9)], "k long, cnt long"), 2)
    assert table.read().collect()[0].cnt == 9
    with pytest.raises(ValueError):
        UpsertTable(spark, "x", "k long", ["k"], fan=1)
